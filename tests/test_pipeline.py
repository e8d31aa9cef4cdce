import os

import pytest

from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.plans.pipeline import PipelineConfig, run
from ledgerlake.sources import fixtures as fx
from ledgerlake.sources.cdc import envelopes

SF = "/root/testdata/sf0.001"


def _feed(spark, path, table, df):
    envelopes(df, table).select("value", "topic").write.mode("append").partitionBy("topic").text(path)


def test_full_pipeline_two_runs(spark, tmp):
    changes = os.path.join(tmp, "changes")
    cfg = PipelineConfig(lake=os.path.join(tmp, "lake"), warehouse=os.path.join(tmp, "wh"), changes=changes)
    for t in ("customers", "accounts", "services", "customer_profiles", "customer_segments"):
        _feed(spark, changes, t, fx.ENTITIES[t](spark, SF))
    _feed(spark, changes, "transactions", fx.transactions_batch1(spark, SF))
    _feed(spark, changes, "service_usage", fx.service_usage_batch1(spark, SF))
    out = run(spark, "full", cfg, RunContext("2024-03-01 00:00:00"))
    n_usage_1 = out["fct_service_usage"].count()
    assert n_usage_1 > 0
    assert out["agg_service_frequency"].count() == 10
    assert out["report_top_services"].count() == 10
    q = {(r.dataset, r.check_name, r.column_name): r.failed_rows for r in out["quality_results"].collect()}
    assert len(q) == 36
    assert q[("stg_customers", "unique", "customer_id")] == 0
    assert q[("fact_customer_activity", "not_null", "customer_id")] > 0  # orphan transactions (H13)

    # second run: the rest of the usage and transactions arrive
    _feed(spark, changes, "transactions", fx.transactions(spark, SF).filter(F.col("created_at") >= F.lit("1999-01-01").cast("timestamp_ntz")))
    _feed(spark, changes, "service_usage", fx.service_usage(spark, SF).subtract(fx.service_usage_batch1(spark, SF)))
    out2 = run(spark, "full", cfg, RunContext("2024-03-02 00:00:00"))
    assert out2["fct_service_usage"].count() == fx.service_usage(spark, SF).count()
    assert out2["fact_transactions"].count() == fx.transactions(spark, SF).count()
    assert out2["accounts_snapshot"].filter(F.col("valid_to").isNotNull()).count() == 0  # nothing changed
    assert out2["accounts_snapshot"].count() == out["accounts_snapshot"].count()


def test_history_step_touches_open_versions_only(spark, tmp):
    from ledgerlake.operators import scd2_check
    from ledgerlake.plans.pipeline import history_step
    from ledgerlake.sources.lake import TableStore

    store = TableStore(spark, os.path.join(tmp, "wh"))
    ts = lambda t: F.lit(t).cast("timestamp_ntz")
    s1 = spark.createDataFrame([(1, "a"), (2, "b")], "id int, a string")
    h1 = history_step(store, "snap", scd2_check(store.read("snap_open"), s1, "id", ["a"], ts("2024-01-01 00:00:00")))
    assert h1.count() == 2 and store.read("snap_closed") is None or store.read("snap_closed").count() == 0
    s2 = spark.createDataFrame([(1, "A"), (2, "b")], "id int, a string")
    h2 = history_step(store, "snap", scd2_check(store.read("snap_open"), s2, "id", ["a"], ts("2024-01-02 00:00:00")))
    assert store.read("snap_open").count() == 2 and store.read("snap_closed").count() == 1
    assert sorted((r.id, r.a, r.valid_to is None) for r in h2.collect()) == [(1, "A", True), (1, "a", False), (2, "b", True)]


def test_marks_kept_for_append_only_targets(spark, tmp):
    from ledgerlake.sources.lake import TableStore

    store = TableStore(spark, os.path.join(tmp, "wh"))
    store.publish(spark.range(5).withColumnRenamed("id", "usage_id"), "fct", mark_col="usage_id")
    assert store.read_mark("fct", "usage_id") == 4
    store.append(spark.range(5, 9).withColumnRenamed("id", "usage_id"), "fct", mark_col="usage_id")
    assert store.read_mark("fct", "usage_id") == 8 and store.read("fct").count() == 9


def test_a_failed_check_stops_the_run_after_its_results_are_stored(spark, tmp):
    from ledgerlake.operators.quality import QualityError
    from ledgerlake.sources.lake import TableStore

    changes = os.path.join(tmp, "changes")
    cfg = PipelineConfig(lake=os.path.join(tmp, "lake"), warehouse=os.path.join(tmp, "wh"), changes=changes, tables=["services"])
    services = fx.services(spark, SF)
    _feed(spark, changes, "services", services.withColumn("service_code", F.lit("SAME")))
    with pytest.raises(QualityError, match="stg_services.service_code unique: 1 failed"):
        run(spark, "full", cfg, RunContext("2024-03-01 00:00:00"))
    results = TableStore(spark, cfg.warehouse).read("quality_results")
    assert results.count() == 36 and results.filter("failed_rows > 0").count() == 1
    assert results.filter("failed_rows IS NULL AND dataset = 'stg_customers'").count() == 2  # reported as absent
    cfg.on_failed_checks = "report"
    assert "quality_results" in run(spark, "warehouse", cfg, RunContext("2024-03-01 01:00:00"))
