import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerlake.functions import (
    Rule,
    canonical_id,
    greatest_strict,
    op_code,
    risk_score,
    round_half_up,
    rule_cascade,
    safe_number,
    table_of_topic,
    whole_days_between,
)


def test_safe_number_rounds_half_away_and_nulls_bad_text(spark):
    df = spark.createDataFrame([("abc",), ("12.5",), ("-12.5",), ("1e3",), ("",), ("12.75",), (None,)], "s string")
    got = [r[0] for r in df.select(safe_number("s")).collect()]
    assert got == [None, Decimal(13), Decimal(-13), Decimal(1000), None, Decimal(13), None]
    kept = [r[0] for r in df.select(safe_number("s", 1)).collect()]
    assert kept[5] == Decimal("12.8")


def test_canonical_id_forms(spark):
    df = spark.sql(
        "SELECT parse_json(j) AS v FROM VALUES ('{\"id\": 12}'), ('{\"id\": 12.0}'), ('{\"id\": \"abc\"}'), "
        "('{\"id\": null}'), ('{}'), ('{\"id\": 12.5}') AS t(j)"
    )
    got = [r[0] for r in df.select(canonical_id("v", "$.id")).collect()]
    assert got == ["12", "12", "abc", None, None, "12.5"]
    nan = spark.range(1).select(F.to_variant_object(F.struct(F.lit(float("nan")).alias("id"))).alias("v"))
    assert nan.select(canonical_id("v", "$.id")).first()[0] is None


def test_whole_days_boundary(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-01 00:01:00' AS a, TIMESTAMP_NTZ'2024-01-31 23:59:00' AS b, "
        "TIMESTAMP_NTZ'2024-02-01 00:01:00' AS c"
    )
    r = df.select(whole_days_between("a", "b"), whole_days_between("a", "c")).first()
    assert (r[0], r[1]) == (30, 31)


def test_round_half_up_on_decimal_value(spark):
    r = spark.range(1).select(round_half_up(F.lit(1.005), 2), round_half_up(F.lit(-2.675), 2)).first()
    assert (r[0], r[1]) == (1.01, -2.68)


def test_risk_score_clamps_and_null_inputs(spark):
    df = spark.createDataFrame([(90.0, 20000.0, 10.0), (None, None, None), (-5.0, 0.0, 0.0), (10.0, 1234.0, 55.5)], "r double, t double, a double")
    got = [r[0] for r in df.select(risk_score("r", "t", "a")).collect()]
    assert got == [100.0, 0.0, 0.0, 16.78]


def test_greatest_strict_is_null_on_null(spark):
    r = spark.range(1).select(greatest_strict(F.lit(1), F.lit(None).cast("int")), F.greatest(F.lit(1), F.lit(None).cast("int"))).first()
    assert r[0] is None and r[1] == 1


def test_op_code_and_topic(spark):
    df = spark.createDataFrame([("INSERT",), ("update",), ("Delete",), ("truncate",), (None,)], "e string")
    assert [r[0] for r in df.select(op_code("e")).collect()] == ["c", "u", "d", "r", "r"]
    t = spark.createDataFrame([("banking_server.public.service_usage",)], "t string")
    assert t.select(table_of_topic("t")).first()[0] == "service_usage"


def test_rule_cascade_first_match_wins(spark):
    df = spark.createDataFrame([(90, 5), (10, 50), (90, 50), (1, 1)], "a int, b int")
    label, score = rule_cascade(
        [Rule(F.col("a") > 80, "high_a", "a"), Rule(F.col("b") > 20, "high_b", 7.0)], "none", 1.0
    )
    got = [(r[0], r[1]) for r in df.select(label, score).collect()]
    assert got == [("high_a", 90.0), ("high_b", 7.0), ("high_a", 90.0), ("none", 1.0)]


def test_segment_rules_each_rule(spark):
    from ledgerlake.plans.segmentation import segment_customers

    asof = dt.datetime(2024, 2, 1)
    rows = [
        (1, 85.0, asof, 0, 0.0, 0, None),  # risky
        (2, 10.0, asof - dt.timedelta(days=31), 0, 0.0, 0, None),  # dormant
        (3, 10.0, asof - dt.timedelta(days=30, hours=23, minutes=59), 201, 30001.0, 0, None),  # 30 days: not dormant → VIP
        (4, 10.0, asof, 0, 0.0, 21, None),  # active
        (5, 10.0, asof, 0, 10001.0, 0, "TRANSFER"),  # transfer heavy
        (6, 10.0, asof, 0, 0.0, 0, "TRANSFER"),  # standard
        (7, 95.0, asof - dt.timedelta(days=40), 500, 90000.0, 50, "TRANSFER"),  # several match → risky
    ]
    df = spark.createDataFrame(
        rows,
        "customer_id int, risk_score double, last_active_date timestamp_ntz, total_transactions int, "
        "total_transfer_amount double, login_frequency int, preferred_transaction_type string",
    ).withColumn("updated_at", F.col("last_active_date"))
    got = {r[0]: (r[1], r[2]) for r in segment_customers(df, F.lit("2024-02-01").cast("timestamp_ntz")).collect()}
    assert got[1] == ("Risky User", 85.0)
    assert got[2] == ("Dormant User", 90.0)
    assert got[3] == ("VIP", 95.0)
    assert got[4] == ("Active User", 85.0)
    assert got[5] == ("Transfer Heavy User", 75.0)
    assert got[6] == ("Standard User", 50.0)
    assert got[7] == ("Risky User", 95.0)
