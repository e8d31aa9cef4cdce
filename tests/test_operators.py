import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import (
    DuplicateKeyError,
    above_watermark,
    attach_customer,
    global_rank,
    group_mode,
    latest_by,
    orphans,
    present_history,
    scd2_check,
    scd2_from_log,
    scd2_timestamp,
    share_of_total,
    upsert,
    watermark,
)

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
T2 = dt.datetime(2024, 1, 3)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is not None, x) for x in t))


def test_latest_by_null_placement_and_tiebreak(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, T1, "b"), (2, T1, "x"), (2, T1, "a"), (3, T0, "z")], "k int, ts timestamp_ntz, v string"
    )
    first = latest_by(df, ["k"], [F.col("ts").desc_nulls_first()], [F.col("v").asc()])
    assert rows(first, "k", "v") == [(1, "a"), (2, "a"), (3, "z")]
    last = latest_by(df, ["k"], [F.col("ts").desc_nulls_last()], [F.col("v").asc()])
    assert rows(last, "k", "v") == [(1, "b"), (2, "a"), (3, "z")]


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t2"), (None, "n", "tn")], "k int, k2 string, v string")
    batch = spark.createDataFrame([(2, "b", "b2"), (3, "c", "b3"), (None, "n", "bn")], "k int, k2 string, v string")
    out = upsert(target, batch, ["k"])
    got = sorted((r["k"] if r["k"] is not None else -1, r["v"]) for r in out.collect())
    assert got == [(-1, "bn"), (-1, "tn"), (1, "t1"), (2, "b2"), (3, "b3")]
    comp = upsert(target, batch.withColumn("k2", F.lit("zz")), ["k", "k2"])  # composite: nothing matches
    assert comp.count() == 6
    assert upsert(None, batch, ["k"]).count() == 3
    assert upsert(target, batch.limit(0), ["k"]).count() == 3
    with pytest.raises(DuplicateKeyError):
        upsert(target, batch.unionByName(batch), ["k"], check_duplicates=True)


def test_watermark_filters_strictly(spark):
    target = spark.createDataFrame([(1, dt.date(2024, 1, 2))], "id int, d date")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, dt.date(2024, 1, 3))], "id int, d date")
    assert rows(above_watermark(df, target, "d", floor="1970-01-01"), "id") == [(3,)]
    assert rows(above_watermark(df, target, "d", floor="1970-01-01", inclusive=True), "id") == [(2,), (3,)]
    assert rows(above_watermark(df, None, "d"), "id") == [(1,), (2,), (3,)]
    assert watermark(target.limit(0), "d", "1970-01-01") == "1970-01-01"


def test_share_and_rank(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), ("d", 0)], "s string, n long")
    out = global_rank(share_of_total(df, "n", "pct"), "n", "rk")
    assert rows(out, "s", "pct", "rk") == [("a", 38.46, 1), ("b", 38.46, 1), ("c", 23.08, 3), ("d", 0.0, 4)]
    zero = share_of_total(spark.createDataFrame([("a", 0)], "s string, n long"), "n", "pct")
    assert zero.first()["pct"] is None


def test_global_rank_equals_window_without_exchange_reuse(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(0, 5000).select(F.when(F.col("id") % 97 > 0, F.col("id") % 397).alias("v"))
    order = Window.orderBy(F.col("v").desc_nulls_first())
    want = rows(df.withColumn("r", F.rank().over(order)).groupBy("v", "r").count(), "v", "r", "count")
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = rows(global_rank(df, "v", "r", partitions=7).groupBy("v", "r").count(), "v", "r", "count")
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert got == want
    dense = global_rank(df.dropna(), "v", "d", dense=True, partitions=5).select("v", "d").distinct()
    assert rows(dense, "v", "d")[:3] == [(0, 397), (1, 396), (2, 395)]


def test_group_mode_ties_go_to_smallest(spark):
    df = spark.createDataFrame(
        [(1, "TRANSFER"), (1, "DEPOSIT"), (2, "B"), (2, "B"), (2, "A"), (None, "X")], "c int, t string"
    )
    assert rows(group_mode(df, ["c"], "t", "m"), "c", "m") == [(None, "X"), (1, "DEPOSIT"), (2, "B")]


def test_attach_customer_orphans_and_null_keys(spark):
    tx = spark.createDataFrame([("1", "10"), ("2", "-1"), ("3", None)], "tid string, account_id string")
    acc = spark.createDataFrame([("10", "c1")], "account_id string, customer_id string")
    out = attach_customer(tx, acc)
    assert sorted((r["tid"], r["customer_id"]) for r in out.collect()) == [("1", "c1"), ("2", None), ("3", None)]
    assert rows(orphans(tx, acc, "account_id"), "tid") == [("2",)]


def _hist_rows(h):
    return sorted(
        (r["id"], r["a"], r["valid_from"], r["valid_to"]) for r in h.collect()
    )


def test_scd2_check_cases(spark):
    ts = lambda d: F.lit(str(d)).cast("timestamp_ntz")
    s1 = spark.createDataFrame([(1, "x", "o1"), (2, "y", "o2"), (3, None, "o3"), (4, "w", "o4")], "id int, a string, other string")
    h1 = scd2_check(None, s1, "id", ["a"], ts(T0))
    # 1 unchanged but other column changed; 2 changed; 3 null→null unchanged; 4 missing; 5 new
    s2 = spark.createDataFrame([(1, "x", "CHANGED"), (2, "Y", "o2"), (3, None, "o3"), (5, "n", "o5")], "id int, a string, other string")
    h2 = scd2_check(h1, s2, "id", ["a"], ts(T1))
    assert _hist_rows(h2) == [
        (1, "x", T0, None),
        (2, "Y", T1, None),
        (2, "y", T0, T1),
        (3, None, T0, None),
        (4, "w", T0, None),
        (5, "n", T1, None),
    ]
    # a third run: closed rows pass through untouched
    h3 = scd2_check(h2, s2.withColumn("a", F.lit("z")), "id", ["a"], ts(T2))
    assert h3.filter(F.col("valid_to").isNull()).count() == 5
    assert h3.filter(F.col("valid_to") == ts(T1)).count() == 1
    p = present_history(h2)
    assert set(p.columns) >= {"effective_from", "effective_to", "is_current"}


def test_scd2_timestamp(spark):
    s1 = spark.createDataFrame([(1, "a", T0), (2, "b", T0)], "id int, a string, updated_at timestamp_ntz")
    h1 = scd2_timestamp(None, s1, "id", "updated_at")
    s2 = spark.createDataFrame([(1, "a2", T1), (2, "b2", T0)], "id int, a string, updated_at timestamp_ntz")
    h2 = scd2_timestamp(h1, s2, "id", "updated_at")
    assert _hist_rows(h2) == [(1, "a", T0, T1), (1, "a2", T1, None), (2, "b", T0, None)]


def test_scd2_runs_equal_history_from_log(spark):
    """Property: N check-strategy runs over successive versions = history built from the log."""
    versions = [
        [(1, "a"), (2, "b"), (3, "c")],
        [(1, "a"), (2, "B"), (3, "c")],
        [(1, "A"), (2, "B"), (3, "c")],
        [(1, "A"), (2, "b"), (3, "C")],
    ]
    times = [dt.datetime(2024, 1, d + 1) for d in range(len(versions))]
    h = None
    log_rows = []
    for v, t in zip(versions, times):
        src = spark.createDataFrame(v, "id int, a string")
        h = scd2_check(h, src, "id", ["a"], F.lit(str(t)).cast("timestamp_ntz"))
        log_rows += [(i, a, t) for i, a in v]
    log = spark.createDataFrame(log_rows, "id int, a string, ts timestamp_ntz")
    from_log = scd2_from_log(log, "id", ["ts"], ["a"])
    assert _hist_rows(h) == sorted((r["id"], r["a"], r["valid_from"], r["valid_to"]) for r in from_log.collect())


def _plain_history(base, order):
    from pyspark.sql import Window

    w = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    marked = base.withColumn("_p", F.lag(F.struct("a")).over(w))
    ref = marked.filter(F.col("_p").isNull() | ~F.struct("a").eqNullSafe(F.col("_p"))).withColumn("valid_to", F.lead("ts").over(w))
    return sorted(((r.k, r.ts, r.i, r.a, r.valid_to) for r in ref.collect()), key=repr)


@pytest.mark.parametrize("hot", [0, None])
def test_scd2_from_log_cuts_a_hot_key(spark, hot):
    """One key, or the NULL key, holds most rows and half of them share their time; equal to a plain window per key."""
    base = spark.range(0, 3000).select(
        F.when(F.col("id") < 2000, F.lit(hot)).otherwise(F.col("id") % 50 + 1).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("i"),
        F.when(F.col("id") % 70 > 6, (F.col("id") / 7).cast("int") % 3).alias("a"),
    )
    want = _plain_history(base, ["ts", "i"])
    base = base.repartition(5, "i")
    got = scd2_from_log(base, "k", ["ts", "i"], ["a"], partitions=7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "_seg" in plan
    rows = lambda df: sorted(((r.k, r.ts, r.i, r.a, r.valid_to) for r in df.collect()), key=repr)
    assert rows(got) == want
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert rows(scd2_from_log(base, "k", ["ts", "i"], ["a"], partitions=7)) == want
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_heavy_segments_are_few_and_even(spark):
    from ledgerlake.operators.history import heavy_segments

    df = spark.range(0, 9000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("o"))
    seg, heavy = heavy_segments(df, "k", ["o"], 12)
    sizes = [r["count"] for r in df.filter(heavy).groupBy(seg.alias("s")).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) == 4 and max(sizes) < 1200
    assert df.filter(~heavy).select(seg.alias("s")).distinct().collect()[0][0] == 0


def test_null_keys_of_a_history_are_spread(spark):
    src = spark.createDataFrame([(None, str(i)) for i in range(60)] + [(1, "a")], "id int, a string")
    h = scd2_check(None, src, "id", ["a"], F.lit("2024-01-01").cast("timestamp_ntz"))
    again = scd2_check(h, src, "id", ["a"], F.lit("2024-01-02").cast("timestamp_ntz"))
    assert again.count() == 121 and again.filter("id = 1").count() == 1
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "_j_salt" in plan


def test_checks_of_all_kinds_share_one_shuffle(spark):
    from ledgerlake.operators.quality import QualityError, accepted_values, check_datasets, not_null, predicate, relationships, require, unique

    kids = spark.createDataFrame([(1, 10, "a", 5.0), (2, 10, "z", -1.0), (2, None, None, None), (None, 99, "a", 0.0), (None, 98, "b", 1.0)], "id int, up int, kind string, x double")
    ups = spark.createDataFrame([("10",), ("11",), ("11",), (None,)], "key string")
    suite = {
        "kids": [not_null("id"), unique("id"), relationships("up", "ups", "key"), accepted_values("kind", ["a", "b"]), predicate("x", "x >= 0", "x_ok")],
        "ups": [unique("key"), not_null("key")],
        "gone": [not_null("id")],
    }
    out = check_datasets(suite, {"kids": kids, "ups": ups})
    got = {(r.dataset, r.check_name, r.column_name): r.failed_rows for r in out.collect()}
    assert got == {
        ("kids", "not_null", "id"): 2, ("kids", "unique", "id"): 1, ("kids", "relationships", "up"): 2, ("kids", "accepted_values", "kind"): 1,
        ("kids", "x_ok", "x"): 1, ("ups", "unique", "key"): 1, ("ups", "not_null", "key"): 1, ("gone", "not_null", "id"): None,
    }
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(check#") <= 3  # by (check, value), by check, and the few results
    with pytest.raises(QualityError, match="gone.id not_null: absent; .*kids.id not_null: 2 failed"):
        require(out)
    require(out.filter("dataset = 'ups'"), [("unique", "ups", "key"), ("not_null", "ups", "key")])
    assert check_datasets({"gone": [not_null("id")]}, {}, spark).first().failed_rows is None
    fine = check_datasets({"kids": [not_null("kind")]}, {"kids": kids.limit(0)})
    assert fine.first().failed_rows == 0
    require(fine)


def test_rank_of_frequent_ties_is_joined_by_broadcast(spark):
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id")).cast("int").alias("v"))
    for dense in (False, True):
        got = global_rank(df, "v", "r", dense=dense, partitions=6)
        fn = F.dense_rank() if dense else F.rank()
        from pyspark.sql import Window

        want = df.withColumn("r", fn.over(Window.orderBy(F.col("v").desc_nulls_first())))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert "_often" in got._jdf.queryExecution().executedPlan().toString()


def test_tokens_of_checks_are_folded_in_bounded_parts(spark, monkeypatch):
    import pyarrow as pa

    from ledgerlake.operators import quality

    monkeypatch.setattr(quality, "HELD", 1_000)
    batch = lambda lo: pa.RecordBatch.from_pydict(
        {"check": pa.array([0] * 500, pa.int32()), "value": ["often" if k % 2 else str(lo + k) for k in range(500)], "n": pa.array([1] * 500), "parent": [lo == 0] * 500}
    )
    out = list(quality._folded(batch(500 * i) for i in range(5)))
    assert [b.num_rows for b in out] == [501, 501, 251]
    often = [r for b in out for r in b.to_pylist() if r["value"] == "often"]
    assert [(r["check"], r["n"], r["parent"]) for r in often] == [(0, 500, True), (0, 500, False), (0, 250, False)]
    assert sum(r["n"] for b in out for r in b.to_pylist()) == 2_500

    kids = spark.createDataFrame([(i % 7, None if i == 3 else f"v{i % 40}") for i in range(60)], "id int, v string")
    found = quality.check_datasets({"kids": [quality.unique("v"), quality.not_null("v"), quality.relationships("id", "ups")]}, {"kids": kids, "ups": spark.range(5)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    # nothing holds the different values of a task before they are dealt out
    assert "REPARTITION_BY_COL" in plan and "Aggregate" not in plan.split("REPARTITION_BY_COL")[1]
    assert {(r.check_name, r.column_name): r.failed_rows for r in found.collect()} == {("unique", "v"): 19, ("not_null", "v"): 1, ("relationships", "id"): 16}
