"""Faults between writes, replays and foreign stores: nothing is lost, doubled or dropped in silence."""

from __future__ import annotations

import shutil
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.plans import facts
from ledgerlake.plans.pipeline import history_step
from ledgerlake.sources.lake import TableStore, refresh_raw, write_lake
from ledgerlake.sources.partitioned import BucketedTable, PartitionedTable
from ledgerlake.streaming.ingest import run_until_drained, stream_upsert


def ids(df, col="id"):
    return sorted(r[col] for r in df.collect())


def fail_commit(store, monkeypatch, name):
    """The next commit of a batch of table `name` fails, as if the run died there."""
    commit = TableStore._commit

    def failing(self, path, record):
        if f"/{name}/" in path:
            raise OSError("died")
        commit(self, path, record)

    monkeypatch.setattr(TableStore, "_commit", failing)


def test_a_run_that_dies_before_the_commit_can_be_run_again(spark, tmp, monkeypatch):
    store = TableStore(spark, tmp)
    store.publish(spark.range(3), "t", mark_col="id")
    with monkeypatch.context() as m:
        fail_commit(store, m, "t")
        with pytest.raises(OSError):
            store.append(spark.range(3, 5), "t", mark_col="id")
    assert ids(store.read("t")) == [0, 1, 2] and store.read_mark("t", "id") == 2
    store.append(spark.range(3, 5), "t", mark_col="id")
    assert ids(store.read("t")) == [0, 1, 2, 3, 4] and store.read_mark("t", "id") == 4


def test_the_mark_belongs_to_the_version(spark, tmp):
    store = TableStore(spark, tmp)
    store.publish(spark.range(3), "t", mark_col="id")
    store.publish(spark.range(10), "t", mark_col="id")
    assert store.read_mark("t", "id") == 9
    store.publish(spark.range(4), "t")
    assert store.read_mark("t", "id") is None  # the caller then asks the table itself


def test_closed_versions_are_closed_once(spark, tmp, monkeypatch):
    store = TableStore(spark, tmp)
    schema = "id int, v string, valid_to timestamp"
    history_step(store, "s", spark.createDataFrame([(1, "a", None)], schema))
    step = spark.createDataFrame([(1, "a", None), (1, "b", None)], schema)
    for stamp in ("2024-01-02", "2024-01-03"):
        closing = step.withColumn("valid_to", F.when(F.col("v") == "a", F.lit(stamp).cast("timestamp")))
        if stamp == "2024-01-02":
            with monkeypatch.context() as m:
                fail_commit(store, m, "s_open")
                with pytest.raises(OSError):
                    history_step(store, "s", closing)
            assert store.read("s_closed", generation=store.generation("s_open")).count() == 0
        else:
            h = history_step(store, "s", closing)
    got = sorted((r["v"], r["valid_to"] and str(r["valid_to"])) for r in h.collect())
    assert got == [("a", "2024-01-03 00:00:00"), ("b", None)]


ROWS = "id int, v string, ts int"


def upsert(spark, table, source, checkpoint, trigger="availableNow"):
    return stream_upsert(spark.readStream.schema(ROWS).json(source), table, [F.col("ts").desc()], checkpoint, trigger=trigger)


def files(table):
    """The data files of each bucket."""
    root = Path(table.path)
    return {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in root.glob(f"{table.by}=*")}


def values(table):
    return sorted((tuple(r) for r in table.rows().select("id", "v", "ts").collect()), key=repr)


def test_a_new_checkpoint_on_the_same_table_is_another_query(spark, tmp):
    table = BucketedTable(spark, f"{tmp}/t", ["id"], buckets=4)
    for k in (1, 2):
        spark.createDataFrame([(k, "x", k)], ROWS).coalesce(1).write.json(f"{tmp}/in{k}")
        run_until_drained(upsert(spark, table, f"{tmp}/in{k}", f"{tmp}/ck{k}"))
    assert ids(table.rows()) == [1, 2]
    before = files(table)
    run_until_drained(upsert(spark, table, f"{tmp}/in2", f"{tmp}/ck2"))  # nothing new
    assert files(table) == before


def test_an_upsert_leaves_other_buckets_their_files(spark, tmp):
    table = BucketedTable(spark, f"{tmp}/t", ["id"], buckets=8)
    newest = [F.col("ts").desc()]
    table.upsert(spark.createDataFrame([(i, "old", 1) for i in range(100)], ROWS), newest, "a")
    before = files(table)
    assert len(before) == 8
    batch = spark.createDataFrame([(3, "new", 2), (3, "newer", 3), (3, "late", 0)], ROWS)
    table.upsert(batch, newest, "b")
    after = files(table)
    assert sum(after[b] != before[b] for b in before) == 1
    want = sorted([(i, "old", 1) for i in range(100) if i != 3] + [(3, "newer", 3)], key=repr)
    assert values(table) == want
    table.upsert(batch, newest, "b")  # replayed
    assert values(table) == want
    assert BucketedTable(spark, f"{tmp}/t", ["id"], buckets=3).buckets == 8


def test_an_upsert_shuffles_its_rows_once(spark, tmp, monkeypatch):
    table = BucketedTable(spark, f"{tmp}/t", ["id"], buckets=4)
    newest = [F.col("ts").desc()]
    table.upsert(spark.createDataFrame([(i % 50, "old", i) for i in range(100)], ROWS), newest, "a")
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    overwrite, place = BucketedTable.overwrite, BucketedTable._place

    def staging(self, rows, tag, spread=True):
        plans.append(plan(rows.hint("rebalance", self.by) if spread else rows))
        overwrite(self, rows, tag, spread)

    monkeypatch.setattr(BucketedTable, "overwrite", staging)
    monkeypatch.setattr(BucketedTable, "_place", lambda self, rows: (plans.append(plan(rows)), place(self, rows)))
    table.upsert(spark.createDataFrame([(i, "new", 200) for i in range(0, 60, 2)] + [(None, "x", 1)], ROWS), newest, "b")
    assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 0] and "REBALANCE" not in plans[0]
    want = [(i, "new", 200) if i % 2 == 0 else (i, "old", 50 + i) for i in range(50)]
    assert values(table) == sorted(want + [(i, "new", 200) for i in range(50, 60, 2)] + [(None, "x", 1)], key=repr)


def test_an_upsert_reads_only_the_buckets_it_touches(spark, tmp):
    table = BucketedTable(spark, f"{tmp}/t", ["id"], buckets=8)
    table.upsert(spark.createDataFrame([(i, "old", 1) for i in range(100)], ROWS), [F.col("ts").desc()], "a")
    plan = table.read().filter(F.col("bucket").isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan


def test_rows_without_a_key_match_nothing(spark, tmp):
    table = BucketedTable(spark, f"{tmp}/t", ["id"], buckets=4)
    batch = spark.createDataFrame([(None, "a", 1), (None, "b", 1), (1, "c", 1)], ROWS)
    for tag in ("a", "b"):
        table.upsert(batch, [F.col("ts").desc()], tag)
    assert values(table) == sorted([(None, "a", 1), (None, "b", 1), (1, "c", 1)], key=repr)


def test_a_write_that_dies_is_finished_by_the_next_reader(spark, tmp, monkeypatch):
    table = BucketedTable(spark, f"{tmp}/t", ["id"], buckets=4)
    newest = [F.col("ts").desc()]
    table.upsert(spark.createDataFrame([(i, "old", 1) for i in range(20)], ROWS), newest, "a")

    def dies(self, rows):
        for d in Path(self.path).glob("bucket=*"):  # as far as Spark's commit may have come
            shutil.rmtree(d)
            break
        raise OSError("died")

    with monkeypatch.context() as m:
        m.setattr(BucketedTable, "_place", dies)
        with pytest.raises(OSError):
            table.upsert(spark.createDataFrame([(i, "new", 2) for i in range(20)], ROWS), newest, "b")
    assert values(table) == sorted(((i, "new", 2) for i in range(20)), key=repr)
    assert not list((Path(table.path) / "_staged").iterdir())


def test_a_stream_that_is_not_drained_in_time_is_an_error(spark, tmp):
    table = BucketedTable(spark, f"{tmp}/t", ["id"], buckets=4)
    spark.createDataFrame([(1, "x", 1)], "id int, v string, ts int").coalesce(1).write.json(f"{tmp}/in")
    q = upsert(spark, table, f"{tmp}/in", f"{tmp}/ck", trigger=3600)
    with pytest.raises(TimeoutError):
        run_until_drained(q, timeout_s=2)
    assert not q.isActive


def test_batch_rows_are_refused_where_a_stream_writes(spark, tmp):
    spark.createDataFrame([("d",)], "x string").write.text(f"{tmp}/lake/_spark_metadata/0")
    rows = spark.range(1).selectExpr("'t' AS table", "parse_json('{}') AS v")
    with pytest.raises(ValueError, match="stream"):
        write_lake(rows, f"{tmp}/lake", RunContext("2024-01-01 00:00:00"))


def test_foreign_files_of_a_store_that_only_spark_opens(spark, tmp):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.only.link./lake", f"file://{tmp}/lake")
    spark.range(5).coalesce(1).write.parquet(f"{tmp}/lake/t/date=2024-01-01")
    with open(f"{tmp}/lake/t/date=2024-01-01/broken.parquet", "w") as f:
        f.write("no parquet")
    assert refresh_raw(spark, "viewfs://only/lake", "t").count() == 5
    assert refresh_raw(spark, f"file://{tmp}/lake", "t").count() == 5


@pytest.mark.parametrize("unit", ["activity_date", "activity_month"])
def test_late_rows_rewrite_only_the_days_they_change(spark, tmp, unit):
    table = PartitionedTable(spark, f"{tmp}/activity", unit)
    parts = lambda *days: {f"{unit}={d if unit == 'activity_date' or d.startswith('__') else d[:7]}" for d in days}
    tx = lambda rows: spark.createDataFrame(
        [(str(i), acc, float(amount), "DEPOSIT", None, "COMPLETED", at and datetime.fromisoformat(at)) for i, acc, amount, at in rows],
        "transaction_id string, account_id string, amount double, transaction_type string, related_account_id string, status string, transaction_time timestamp_ntz",
    )
    owners = lambda second: spark.createDataFrame([("a", "1"), ("b", second)], "account_id string, customer_id string")
    first = [(1, "a", 1.5, "2024-01-01 10:00:00"), (2, "b", 2, "2024-02-02 10:00:00"), (3, "x", 3, "2024-02-03 10:00:00"), (4, "a", 4, None), (5, "a", 9, "2024-03-04")]
    run = lambda rows, second="2", tag="r": facts.refresh_customer_activity(tx(rows), owners(second), table, tag)
    want = lambda rows, second="2": sorted((tuple(r) for r in facts.customer_daily_activity(tx(rows), owners(second)).collect()), key=repr)
    got = lambda df: sorted((tuple(r) for r in df.select("customer_id", "activity_date", "transactions_count", "total_amount", "avg_amount").collect()), key=repr)
    assert got(run(first)) == want(first)
    before = files(table)
    assert got(run(first)) == want(first) and files(table) == before  # nothing new, nothing written
    late = [*first, (6, "a", 1.5, "2024-01-01 23:00:00"), (7, None, 1, None), (8, "b", 1, "2024-04-09")]
    assert got(run(late)) == want(late)
    after = files(table)
    assert {d for d in after if after[d] != before.get(d)} == parts("2024-01-01", "__HIVE_DEFAULT_PARTITION__", "2024-04-09")
    assert got(run(late, "7")) == want(late, "7")  # an account that changes hands
    assert {d for d, f in files(table).items() if f != after[d]} == parts("2024-02-02", "2024-04-09")
    swapped = [(1, "b", 1.5, "2024-01-01 10:00:00"), *late[1:4], *late[5:]]  # another owner, and a day whose rows are gone
    assert got(run(swapped, "7")) == want(swapped, "7")


def test_compaction_rewrites_only_partitions_with_small_files(spark, tmp):
    table = PartitionedTable(spark, f"{tmp}/t", "day")
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 < 2, (F.col("id") % 3).cast("string")).alias("day"))
    rows.filter("day IS NULL OR day = '1'").repartition(6, "id").write.partitionBy("day").parquet(table.path)
    rows.filter("day = '0'").coalesce(1).write.mode("append").partitionBy("day").parquet(table.path)
    before = files(table)
    assert len(before["day=1"]) > 1 and len(before["day=__HIVE_DEFAULT_PARTITION__"]) > 1 and len(before["day=0"]) == 1
    assert table.compact("c") == 2
    after = files(table)
    assert all(len(f) == 1 for f in after.values()) and after["day=0"] == before["day=0"]
    assert sorted(map(tuple, table.read().select("id", "day").collect()), key=repr) == sorted(((i, i % 3 if i % 3 < 2 else None) for i in range(300)), key=repr)
    assert table.compact("d") == 0 and files(table) == after
