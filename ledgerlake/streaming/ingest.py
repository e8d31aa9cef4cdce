"""Structured Streaming jobs.

`stream_to_lake`  change stream → after-images → allow-listed tables → Parquet lake
                  partitioned by table and ingest date; the checkpoint holds the source
                  offsets and the file sink's commit log, so restarts neither lose nor
                  duplicate files (exactly-once sink).
`stream_upsert`   change stream → per micro-batch newest version per key → merged into a table
                  bucketed by key, of which only the buckets of the batch's keys are rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.schemas import TABLES
from ledgerlake.sources.cdc import REJECTED, decode, images_and_rejects
from ledgerlake.sources.lake import lake_frame
from ledgerlake.sources.partitioned import BucketedTable


def utc_date() -> Column:
    """Processing date in UTC whatever the session zone."""
    return F.to_date(F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd"))


def lake_stream(changes: DataFrame, tables: Sequence[str] = TABLES, wrapped: bool = True) -> DataFrame:
    """(topic, value, _offset) stream → lake rows (table, v, lineage, date).

    Events that can't be read are rows too, of table REJECTED, so the sink keeps each of them once. The metrics
    `ingest` of the query's progress count both kinds.
    """
    images = images_and_rejects(decode(changes), tables, wrapped=wrapped)
    images = images.observe("ingest", F.count(F.lit(1)).alias("rows"), F.count_if(F.col("table") == REJECTED).alias("rejected"))
    return lake_frame(images, utc_date())


def ingest_counts(query: StreamingQuery) -> dict[str, int]:
    """Rows and rejected events of the micro-batches that the query still remembers."""
    seen = [p.observedMetrics["ingest"] for p in query.recentProgress if "ingest" in p.observedMetrics]
    return {k: sum(m[k] for m in seen) for k in ("rows", "rejected")}


def trigger_kwargs(trigger: str | int | float) -> dict:
    if trigger == "availableNow":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": f"{trigger} seconds"}


def stream_to_lake(
    changes: DataFrame,
    lake: str,
    checkpoint: str,
    tables: Sequence[str] = TABLES,
    trigger: str | int | float = 8,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start the ingest query. `trigger`: seconds between micro-batches, or "availableNow"
    to drain what is there and stop (the shutdown flush)."""
    w = (
        lake_stream(changes, tables)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("table", "date")
        .outputMode("append")
        .trigger(**trigger_kwargs(trigger))
    )
    if query_name:
        w = w.queryName(query_name)
    return w.start(lake)


def stream_upsert(
    stream: DataFrame,
    table: BucketedTable,
    order: Sequence[Column],
    checkpoint: str,
    transform=None,
    trigger: str | int | float = "availableNow",
) -> StreamingQuery:
    """Merge every micro-batch into `table`: only the buckets of the batch's keys are read and rewritten.

    The newest row per key stays, so late files of an older version can't replace a newer row, and a replayed batch
    finds its rows in place.
    """
    root = checkpoint.rstrip("/")

    def merge(batch_df: DataFrame, batch_id: int) -> None:
        query = batch_df.sparkSession.read.json(f"{root}/metadata").first()["id"]  # a new checkpoint is another query
        table.upsert(transform(batch_df) if transform else batch_df, order, f"{query}-{batch_id}")

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_kwargs(trigger))
        .start()
    )


def run_until_drained(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an availableNow/once query; re-raise its failure. With `timeout_s`, a query that
    still runs then is stopped and reported as an error: its target is not complete."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream was not drained within {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
