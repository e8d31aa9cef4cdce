"""Hand-made rows for the semantic hazards of the survey (H1–H23) not covered elsewhere."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.plans import facts, features, staging, usage
from ledgerlake.sources.raw import to_raw

CTX = RunContext("2024-03-01 00:00:00")
T = dt.datetime


def raw(spark, rows, ddl, lineage=False):
    df = spark.createDataFrame(rows, ddl)
    return to_raw(df)


def test_h1_h2_staging_null_first_and_lineage_tiebreak(spark):
    # accounts: default DESC → NULL created_at wins (H1); equal times → newest _ts_ms wins (H2)
    rows = [
        (1, 10, "SAVINGS", 5.0, "USD", None, 1), (1, 10, "SAVINGS", 6.0, "USD", T(2024, 1, 1), 2),
        (2, 20, "SAVINGS", 7.0, "USD", T(2024, 1, 1), 1), (2, 20, "SAVINGS", 8.0, "USD", T(2024, 1, 1), 9),
    ]
    df = spark.createDataFrame(rows, "id long, customer_id long, account_type string, balance double, currency string, created_at timestamp_ntz, _ts_ms long")
    out = {r.account_id: r.balance for r in staging.stg_accounts(to_raw(df), CTX).collect()}
    assert out == {"1": 5.0, "2": 8.0}
    # profiles say NULLS LAST: the NULL updated_at row loses
    p = spark.createDataFrame(
        [(1, "12.5", None), (1, "3", T(2024, 1, 1))], "customer_id long, risk_score string, updated_at timestamp_ntz"
    )
    got = staging.stg_customer_profiles(to_raw(p), CTX).first()
    assert got.risk_score == Decimal(3)


def test_h4_safe_cast_rounds_and_scale_keeps(spark):
    p = spark.createDataFrame([(1, "12.5", T(2024, 1, 1)), (2, "abc", T(2024, 1, 1))], "customer_id long, risk_score string, updated_at timestamp_ntz")
    got = {r.customer_id: r.risk_score for r in staging.stg_customer_profiles(to_raw(p), CTX).collect()}
    assert got == {"1": Decimal(13), "2": None}
    kept = {r.customer_id: r.risk_score for r in staging.stg_customer_profiles(to_raw(p), CTX, scale=2).collect()}
    assert kept["1"] == Decimal("12.50")


def test_h7_float_ids_become_integer_text(spark):
    df = spark.createDataFrame([(12.0, 3.0, "DEPOSIT", 1.0), (float("nan"), 4.0, "DEPOSIT", 1.0)], "id double, account_id double, txn_type string, amount double")
    got = sorted((r.transaction_id, r.account_id) for r in staging.stg_transactions(to_raw(df), CTX).collect() if r.transaction_id)
    assert got == [("12", "3")]


def _tx(spark, rows):
    df = spark.createDataFrame(rows, "id long, account_id long, txn_type string, amount double, created_at timestamp_ntz")
    return staging.stg_transactions(to_raw(df), CTX)


def _acc(spark, rows):
    df = spark.createDataFrame(rows, "id long, customer_id long")
    return staging.stg_accounts(to_raw(df.withColumn("created_at", F.lit(None).cast("timestamp_ntz"))), CTX)


def test_h9_h13_h21_transactions_features(spark):
    tx = _tx(spark, [
        (1, 10, "TRANSFER", 100.0, T(2024, 1, 1)), (1, 10, "TRANSFER", 100.0, T(2024, 1, 1)),  # re-captured (H9)
        (2, 10, "DEPOSIT", 50.0, T(2024, 1, 2)), (3, 99, "DEPOSIT", 5.0, T(2024, 1, 3)),  # 99: orphan (H13)
        (4, None, "WITHDRAWAL", 7.0, T(2024, 1, 3)),
    ])
    acc = _acc(spark, [(10, 1), (11, 2)])
    d13 = {r.customer_id: r for r in features.int_customer_transactions(tx, acc).collect()}
    assert d13["1"].total_transactions == 3  # double counted, as staging does not dedupe
    assert d13["1"].total_transfer_amount == 200.0 and d13["1"].preferred_transaction_type == "TRANSFER"
    assert d13[None].total_transactions == 2 and d13[None].preferred_transaction_type is None
    assert "2" not in d13  # customer without transactions never appears (H21)
    ft = facts.fact_transactions(tx, acc, None, CTX)
    assert ft.count() == 4  # fact dedups by transaction_id


def test_h10_strict_vs_recompute(spark):
    acc = _acc(spark, [(10, 1)])
    day1 = _tx(spark, [(1, 10, "DEPOSIT", 1.0, T(2024, 1, 1, 9)), (2, 10, "DEPOSIT", 2.0, T(2024, 1, 2, 9))])
    t1 = facts.fact_customer_activity(day1, acc, None)
    late = _tx(spark, [(1, 10, "DEPOSIT", 1.0, T(2024, 1, 1, 9)), (2, 10, "DEPOSIT", 2.0, T(2024, 1, 2, 9)),
                      (3, 10, "DEPOSIT", 4.0, T(2024, 1, 2, 18)), (4, 10, "DEPOSIT", 8.0, T(2024, 1, 3, 9))])
    strict = {r.activity_date.day: r.transactions_count for r in facts.fact_customer_activity(late, acc, t1, "strict").collect()}
    again = {r.activity_date.day: r.transactions_count for r in facts.fact_customer_activity(late, acc, t1, "recompute").collect()}
    assert strict == {1: 1, 2: 1, 3: 1}  # the late row of day 2 is never counted
    assert again == {1: 1, 2: 2, 3: 1}


def test_h11_metrics_compare_event_time_with_processing_time(spark):
    acc = _acc(spark, [(10, 1)])
    prof = staging.stg_customer_profiles(to_raw(spark.createDataFrame([(1, 5, T(2024, 1, 1))], "customer_id long, risk_score long, updated_at timestamp_ntz")), CTX)
    d14 = features.int_customer_behavior(features.int_customer_transactions(_tx(spark, [(1, 10, "DEPOSIT", 1.0, T(2024, 1, 1))]), acc), prof)
    t1 = features.int_customer_metrics(d14, None, CTX)
    d14b = features.int_customer_behavior(features.int_customer_transactions(_tx(spark, [(1, 10, "DEPOSIT", 900.0, T(2024, 2, 1))]), acc), prof)
    t2 = features.int_customer_metrics(d14b, t1, RunContext("2024-03-02 00:00:00"))
    assert [r.avg_transaction_amount for r in t2.collect()] == [1.0]  # Feb event < March run time: skipped
    d14c = features.int_customer_behavior(features.int_customer_transactions(_tx(spark, [(1, 10, "DEPOSIT", 900.0, T(2024, 3, 5))]), acc), prof)
    t3 = features.int_customer_metrics(d14c, t1, RunContext("2024-03-06 00:00:00"))
    assert [r.avg_transaction_amount for r in t3.collect()] == [900.0]


def test_h12_usage_watermark_is_insert_only(spark):
    svc = spark.createDataFrame([(1, "S1", "svc", "CAT", True, T(2024, 1, 1))], "id long, service_code string, service_name string, category string, is_active boolean, created_at timestamp_ntz")
    from ledgerlake.plans import history

    dim = history.dim_services(history.services_history(staging.stg_services(to_raw(svc), CTX), None, CTX))
    u1 = spark.createDataFrame([(1, 7, None, 1, "WEB", "SUCCESS", T(2024, 1, 1))], "id long, customer_id long, account_id long, service_id long, channel string, status string, used_at timestamp_ntz")
    t1 = usage.fct_service_usage(staging.stg_service_usage(to_raw(u1), CTX), dim, None, CTX)
    u2 = u1.withColumn("status", F.lit("FAILED")).withColumn("used_at", F.lit(T(2024, 1, 2)).cast("timestamp_ntz"))
    t2 = usage.fct_service_usage(staging.stg_service_usage(to_raw(u1.unionByName(u2)), CTX), dim, t1, CTX)
    assert [(r.usage_id, r.status, r.service_name) for r in t2.collect()] == [(1, "SUCCESS", "svc")]


def test_h14_text_and_integer_keys_join_for_checks(spark):
    from ledgerlake.operators import orphans

    child = spark.createDataFrame([(1,), (2,)], "customer_id long")
    parent = spark.createDataFrame([("1",)], "customer_id string")
    assert [r.customer_id for r in orphans(child, parent, "customer_id").collect()] == [2]


def test_h16_bare_envelopes(spark):
    from ledgerlake.sources.cdc import after_image, decode

    df = decode(spark.createDataFrame([("t.public.accounts", '{"op":"c","after":{"id":1}}')], "topic string, value string"))
    assert after_image(df).count() == 0
    assert after_image(df, wrapped=False).count() == 1


def test_h15_timestamps_order_by_value_not_text(spark):
    # as text '2024-01-09T...' > '2024-01-10T...' would pick the older row; typed order picks the newer
    df = spark.createDataFrame(
        [(1, "a", "2024-01-09T23:00:00"), (1, "b", "2024-01-10T01:00:00")], "id long, first_name string, created_at string"
    )
    got = staging.stg_customers(to_raw(df), CTX).first()
    assert got.first_name == "b" and got.created_at == T(2024, 1, 10, 1)


def test_u03_null_timestamp_never_counts_as_newer(spark):
    from ledgerlake.operators import scd2_timestamp

    s1 = spark.createDataFrame([(1, "a", T(2024, 1, 1))], "id int, a string, updated_at timestamp_ntz")
    h1 = scd2_timestamp(None, s1, "id", "updated_at")
    s2 = spark.createDataFrame([(1, "b", None)], "id int, a string, updated_at timestamp_ntz")
    h2 = scd2_timestamp(h1, s2, "id", "updated_at")
    assert [(r.a, r.valid_to) for r in h2.collect()] == [("a", None)]


def test_key_text_stays_as_it_is(spark):
    from ledgerlake.functions.columns import canonical_id

    df = spark.sql("""SELECT parse_json('{"a":"007.0","b":7.0,"c":"1.2E7","d":12000000.0,"e":null,"f":"NaN","g":12}') AS v""")
    got = df.select(*[canonical_id("v", f"$.{c}").alias(c) for c in "abcdefg"]).first()
    assert tuple(got) == ("007.0", "7", "1.2E7", "12000000", None, None, "12")


def test_recent_activity_shows_days_without_a_date_first(spark):
    from ledgerlake.plans.reports import report_recent_activity

    rows = [("1", "2024-01-01", 1, 2.0), ("2", None, 1, 2.0), ("3", "2024-01-02", 1, 2.0)]
    df = spark.createDataFrame(rows, "customer_id string, activity_date string, transactions_count long, total_amount double")
    df = df.withColumn("activity_date", F.col("activity_date").cast("date"))
    assert [r.customer_id for r in report_recent_activity(df, 2).collect()] == ["2", "3"]


def test_an_empty_data_object_is_the_payload(spark):
    from ledgerlake.sources.cdc import normalize_changes

    df = spark.createDataFrame([('{"data":{},"eventType":"INSERT","table":"customers","record":{"id":4}}',)], "s string").select(F.parse_json("s").alias("j"))
    r = normalize_changes(df, F.lit(1)).first()
    assert (r.table, r.op) == (None, "r")
