import os

from pyspark.sql import functions as F

from ledgerlake.plans import staging
from ledgerlake.plans.runs import RUN1
from ledgerlake.sources.cdc import after_image, decode, read_changes
from ledgerlake.sources.lake import load_audit, refresh_raw
from ledgerlake.sources.partitioned import BucketedTable
from ledgerlake.streaming.ingest import ingest_counts, run_until_drained, stream_to_lake, stream_upsert


def _write(spark, path, rows):
    spark.createDataFrame(rows, "value string, topic string").write.mode("append").partitionBy("topic").text(path)


def _ev(i, amount, ts):
    return (
        '{"payload":{"op":"c","ts_ms":%d,"after":{"id":%d,"account_id":1,"txn_type":"DEPOSIT","amount":%s,'
        '"status":"COMPLETED","created_at":"2024-01-01T00:00:00"}}}' % (ts, i, amount),
        "banking_server.public.transactions",
    )


def test_stream_to_lake_restart_is_exactly_once(spark, tmp):
    changes, lake, ckpt = (os.path.join(tmp, x) for x in ("changes", "lake", "ckpt"))
    _write(spark, changes, [_ev(1, 1.5, 1), _ev(2, 2.5, 2), ("oops", "banking_server.public.transactions")])
    q = stream_to_lake(read_changes(spark, "files", changes, ["transactions"]), lake, ckpt, ["transactions"], "availableNow")
    run_until_drained(q)
    assert ingest_counts(q) == {"rows": 3, "rejected": 1}
    assert refresh_raw(spark, lake, "transactions").count() == 2
    assert load_audit(refresh_raw(spark, lake, "transactions"), "transactions", lake).first().bad_lines == 1
    # restart on the same checkpoint with no new input: nothing is written twice
    run_until_drained(stream_to_lake(read_changes(spark, "files", changes, ["transactions"]), lake, ckpt, ["transactions"], "availableNow"))
    assert refresh_raw(spark, lake, "transactions").count() == 2
    _write(spark, changes, [_ev(3, 3.5, 3)])
    run_until_drained(stream_to_lake(read_changes(spark, "files", changes, ["transactions"]), lake, ckpt, ["transactions"], "availableNow"))
    raw = refresh_raw(spark, lake, "transactions")
    assert raw.count() == 3
    assert [r[0] for r in raw.select("date").distinct().collect()] if "date" in raw.columns else True
    typed = staging.stg_transactions(raw, RUN1)
    assert sorted(r.amount for r in typed.collect()) == [1.5, 2.5, 3.5]


def test_stream_upsert_newest_wins_and_replay_noop(spark, tmp):
    changes, ckpt = os.path.join(tmp, "changes"), os.path.join(tmp, "ckpt")
    table = BucketedTable(spark, os.path.join(tmp, "tx"), ["transaction_id"], buckets=4)
    _write(spark, changes, [_ev(1, 1.0, 10), _ev(2, 2.0, 10)])

    def typed(b):
        return staging._typed(after_image(decode(b)), staging.TRANSACTIONS).drop("_offset")

    def run():
        q = stream_upsert(
            read_changes(spark, "files", changes, ["transactions"], max_files_per_trigger=1),
            table, [F.col("_ts_ms").desc_nulls_last()], ckpt, transform=typed,
        )
        run_until_drained(q)

    run()
    _write(spark, changes, [_ev(1, 9.0, 20), _ev(2, 0.5, 5)])  # id 2 arrives with an older version
    run()
    got = sorted((r.transaction_id, r.amount) for r in table.rows().collect())
    assert got == [("1", 9.0), ("2", 2.0)]
    before = sorted(table.rows().inputFiles())
    run()  # nothing new: no file is written
    assert sorted(table.rows().inputFiles()) == before


def test_lake_read_ignores_uncommitted_sink_files(spark, tmp):
    """A file left in the lake by a failed micro-batch is not in the sink's commit log: not read."""
    import shutil

    changes, lake, ckpt = (os.path.join(tmp, x) for x in ("changes", "lake", "ckpt"))
    _write(spark, changes, [_ev(1, 1.5, 1), _ev(2, 2.5, 2)])
    run_until_drained(stream_to_lake(read_changes(spark, "files", changes, ["transactions"]), lake, ckpt, ["transactions"], "availableNow"))
    part = [d for d in os.listdir(os.path.join(lake, "table=transactions")) if d.startswith("date=")][0]
    folder = os.path.join(lake, "table=transactions", part)
    committed = [f for f in os.listdir(folder) if f.endswith(".parquet")][0]
    shutil.copy(os.path.join(folder, committed), os.path.join(folder, "part-99999-leftover.c000.snappy.parquet"))
    assert refresh_raw(spark, lake, "transactions").count() == 2
