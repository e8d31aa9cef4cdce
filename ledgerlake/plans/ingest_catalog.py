"""Registered queries for the ingest side: change events, realtime normalizer, lake, RAW
refresh with type drift, load audit, streaming ingest and streaming upsert.

All inputs are derived with Spark from the driver tables; files go to a fresh folder under
the session's shared checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.columns import safe_number
from ledgerlake.operators.extract import compute_once
from ledgerlake.plans import staging
from ledgerlake.plans.runs import RUN1
from ledgerlake.session import scratch_path
from ledgerlake.sources import fixtures as fx
from ledgerlake.sources.cdc import after_image, decode, images_and_rejects, jsonable, only_tables, quarantine, realtime_to_changes
from ledgerlake.sources.lake import land_raw, load_audit, refresh_raw, write_lake, write_text
from ledgerlake.sources.partitioned import BucketedTable, PartitionedTable
from ledgerlake.sources.raw import to_raw
from ledgerlake.streaming.ingest import run_until_drained, stream_to_lake, stream_upsert

# Fixed rules of the generated change feed (shared with the oracle):
#   orderkey mod 13 = 0 → delete event (no after-image); mod 17 = 0 → empty after-image;
#   mod 19 = 0 → an extra line that is not JSON; ts_ms = orderkey.


def transaction_changes(spark: SparkSession, sf: str, builder=fx.transactions, ts_offset: int = 0) -> DataFrame:
    """Capture-style change events (topic, value) for the transactions entity."""
    tx = jsonable(builder(spark, sf))
    key = F.col("id")
    after = (
        F.when(key % 13 == 0, F.lit("null"))
        .when(key % 17 == 0, F.lit("{}"))
        .otherwise(F.to_json(F.struct(*[F.col(c) for c in tx.columns])))
    )
    op = F.when(key % 13 == 0, F.lit("d")).otherwise(F.lit("c"))
    value = F.concat(
        F.lit('{"payload":{"op":"'), op,
        F.lit('","source":{"connector":"capture","schema":"public","table":"transactions"},"ts_ms":'),
        (key + F.lit(ts_offset)).cast("string"),
        F.lit(',"before":null,"after":'), after, F.lit("}}"),
    )
    topic = F.lit("banking_server.public.transactions")
    events = tx.select(topic.alias("topic"), value.alias("value"))
    junk = tx.filter(key % 19 == 0).select(topic.alias("topic"), F.concat(F.lit("not json "), key.cast("string")).alias("value"))
    return events.unionByName(junk)


def _typed_transactions(raw: DataFrame) -> DataFrame:
    return staging.stg_transactions(raw, RUN1).drop("load_timestamp")


def after_image_extract(spark: SparkSession, sf: str) -> DataFrame:
    """S01–S03, S13, P01 in batch form: events → after-images → RAW → typed rows."""
    images = only_tables(after_image(decode(transaction_changes(spark, sf))), ["transactions"])
    typed = staging._typed(images, staging.TRANSACTIONS)
    return typed.select(
        "transaction_id", "account_id", "amount", "transaction_type", "related_account_id", "status", "transaction_time",
        F.col("_ts_ms"),
    )


def quarantined_events(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that are not JSON, kept aside with their topic."""
    return quarantine(decode(transaction_changes(spark, sf))).select("topic", "value")


def realtime_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Realtime-style row-change payloads built from customers.

    Fixed rules: event word TRUNCATE when id mod 10 = 7, else INSERT / update / DELETE for
    id mod 3 = 0 / 1 / 2; the word sits under "type" (id mod 5 = 0), "event" (= 1) or
    "eventType"; wrapped in "data" when id mod 4 = 0; row under "record" for even ids, "new"
    for odd; old row {"id"} under "old_record"; table NULL when id mod 23 = 0, "audit_log"
    when id mod 11 = 0, else "customers"; schema "staging" when id mod 6 = 0, else absent.
    """
    c = fx.customers(spark, sf)
    i = F.col("id")
    word = F.when(i % 10 == 7, "TRUNCATE").when(i % 3 == 0, "INSERT").when(i % 3 == 1, "update").otherwise("DELETE")
    rec = F.struct("id", "email", "first_name")
    table = F.when(i % 23 == 0, F.lit(None)).when(i % 11 == 0, F.lit("audit_log")).otherwise(F.lit("customers"))
    fields = [
        F.when(i % 5 >= 2, word).alias("eventType"),
        F.when(i % 5 == 1, word).alias("event"),
        F.when(i % 5 == 0, word).alias("type"),
        table.alias("table"),
        F.when(i % 6 == 0, F.lit("staging")).alias("schema"),
        F.when(i % 2 == 0, rec).alias("record"),
        F.when(i % 2 == 1, rec).alias("new"),
        F.struct(i.alias("id")).alias("old_record"),
    ]
    body = F.struct(*fields)
    payload = F.when(i % 4 == 0, F.to_json(F.struct(body.alias("data")))).otherwise(F.to_json(body))
    return compute_once(c, j=F.parse_json(payload)).select("j")


def normalize_changes_query(spark: SparkSession, sf: str) -> DataFrame:
    """Normalize, guard, route; the envelope is read back for comparison."""
    routed = realtime_to_changes(realtime_payloads(spark, sf), RUN1.epoch_millis(), ["customers", "accounts", "transactions"])
    parsed = compute_once(routed, _j=F.parse_json("value")).withColumn("table", F.variant_get("_j", "$.payload.source.table", "string"))
    j = F.col("_j")
    return parsed.select(
        F.col("table").alias("change_table"),
        F.variant_get(j, "$.payload.source.schema", "string").alias("change_schema"),
        F.variant_get(j, "$.payload.op", "string").alias("op"),
        "topic",
        F.try_variant_get(j, "$.payload.after.id", "bigint").alias("after_id"),
        F.try_variant_get(j, "$.payload.after.email", "string").alias("after_email"),
        F.try_variant_get(j, "$.payload.before.id", "bigint").alias("before_id"),
    )


def build_usage_lake(spark: SparkSession, sf: str, lake: str, files: int | None = None) -> None:
    """usage id mod 3 = 0 → own sink (VARIANT); = 1 → foreign, BIGINT ids; = 2 → foreign, DOUBLE account_id.
    `files`: into how many files each third goes."""
    u = fx.service_usage(spark, sf)
    dealt = lambda k: u.filter(F.col("id") % 3 == k).repartition(files) if files else u.filter(F.col("id") % 3 == k)
    write_lake(to_raw(dealt(0)).withColumn("table", F.lit("service_usage")), lake, RUN1)
    base = f"{lake.rstrip('/')}/service_usage/date=2024-01-01"
    dealt(1).write.mode("append").parquet(f"{base}/ints")
    dealt(2).withColumn("account_id", F.col("account_id").cast("double")).write.mode("append").parquet(f"{base}/doubles")


def lake_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Mixed-layout lake with type drift → RAW → stg_service_usage."""
    lake = scratch_path(spark, "lake")
    build_usage_lake(spark, sf, lake)
    raw = refresh_raw(spark, lake, "service_usage")
    return staging.stg_service_usage(raw, RUN1).drop("load_timestamp")


def load_audit_query(spark: SparkSession, sf: str) -> DataFrame:
    """A lake with type drift, two files that are not Parquet, and events that can't be read.

    Fixed rules: usage ids mod 3 lie as in `build_usage_lake`, each third in 4 files; events of id mod 19 = 0 are not
    JSON, of id mod 23 = 0 (and not 19) have no envelope.
    """
    lake = scratch_path(spark, "lake-audit")
    build_usage_lake(spark, sf, lake, files=4)
    base = f"{lake}/service_usage/date=2024-01-01"
    for k in range(2):
        write_text(spark, f"{base}/broken-{k}.parquet", "not a Parquet file")
    i = F.col("id")
    text = F.when(i % 19 == 0, F.concat(F.lit("not json "), i.cast("string"))).otherwise(F.concat(F.lit('{"id":'), i.cast("string"), F.lit("}")))
    events = fx.service_usage(spark, sf).filter((i % 19 == 0) | (i % 23 == 0))
    events = events.select(F.lit("banking_server.public.service_usage").alias("topic"), text.alias("value"))
    write_lake(images_and_rejects(decode(events), ["service_usage"]), lake, RUN1)
    landed = land_raw(spark, lake, "service_usage", PartitionedTable(spark, f"{lake}-raw", "date"))
    return load_audit(landed, "service_usage", lake)


def _write_changes(df: DataFrame, path: str) -> None:
    df.select("value", "topic").write.mode("append").partitionBy("topic").text(path)


def stream_to_lake_query(spark: SparkSession, sf: str) -> DataFrame:
    """Directory change stream → lake (availableNow), then lake → RAW → typed rows."""
    from ledgerlake.sources.cdc import read_changes

    root = scratch_path(spark, "stream")
    _write_changes(transaction_changes(spark, sf), f"{root}/changes")
    q = stream_to_lake(
        read_changes(spark, "files", f"{root}/changes", tables=["transactions"]),
        f"{root}/lake",
        f"{root}/ckpt",
        trigger="availableNow",
    )
    run_until_drained(q)
    return _typed_transactions(refresh_raw(spark, f"{root}/lake", "transactions"))


def _transactions_v2(spark: SparkSession, sf: str) -> DataFrame:
    """Second version of every transaction: amount + 1 where id mod 3 = 0."""
    t = fx.transactions(spark, sf)
    return t.withColumn("amount", F.when(F.col("id") % 3 == 0, F.col("amount") + 1).otherwise(F.col("amount")))


def stream_upsert_query(spark: SparkSession, sf: str) -> DataFrame:
    """Two change batches (batch-1 rows, then new versions of all rows) merged per
    micro-batch into a table bucketed by transaction; newest `_ts_ms` wins per transaction."""
    from ledgerlake.sources.cdc import read_changes

    root = scratch_path(spark, "upsert")
    _write_changes(transaction_changes(spark, sf, fx.transactions_batch1), f"{root}/changes")
    _write_changes(transaction_changes(spark, sf, _transactions_v2, ts_offset=10**12), f"{root}/changes")
    table = BucketedTable(spark, f"{root}/fact_transactions_stream", ["transaction_id"], buckets=16)

    def typed(batch: DataFrame) -> DataFrame:
        images = after_image(decode(batch))
        return staging._typed(images, staging.TRANSACTIONS).drop("_offset")

    q = stream_upsert(
        read_changes(spark, "files", f"{root}/changes", tables=["transactions"], max_files_per_trigger=4),
        table,
        [F.col("_ts_ms").desc_nulls_last()],
        f"{root}/ckpt",
        transform=typed,
    )
    run_until_drained(q)
    return table.rows()


def safe_number_cast(spark: SparkSession, sf: str) -> DataFrame:
    """P02 over event values and non-numeric text."""
    e = fx.read(spark, sf, "events")
    txt = F.col("value").cast("string")
    return e.select(
        "event_id",
        safe_number(txt).alias("value_0"),
        safe_number(txt, 1).alias("value_1"),
        safe_number(F.col("event_type")).alias("type_number"),
        safe_number(F.concat(F.lit("-"), txt)).alias("negated_0"),
    )


def pipeline_service_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """N01 end to end: change feed of services and usage → `run(full)` (ingest, lake, RAW,
    staging, SCD2, dimension, usage fact, aggregates, checks) → published frequency table."""
    from ledgerlake.plans.pipeline import PipelineConfig, run
    from ledgerlake.sources.cdc import envelopes

    root = scratch_path(spark, "pipeline")
    changes = f"{root}/changes"
    for t in ("services", "service_usage"):
        _write_changes(envelopes(fx.ENTITIES[t](spark, sf), t), changes)
    cfg = PipelineConfig(lake=f"{root}/lake", warehouse=f"{root}/wh", changes=changes, tables=["services", "service_usage"])
    return run(spark, "full", cfg, RUN1)["agg_service_frequency"]


INGEST_QUERIES = {
    "after_image_extract": after_image_extract,
    "quarantined_events": quarantined_events,
    "normalize_changes": normalize_changes_query,
    "lake_refresh": lake_refresh,
    "load_audit": load_audit_query,
    "stream_to_lake": stream_to_lake_query,
    "stream_upsert": stream_upsert_query,
    "safe_number_cast": safe_number_cast,
    "pipeline_service_frequency": pipeline_service_frequency,
}
