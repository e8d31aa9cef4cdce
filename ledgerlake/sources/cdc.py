"""Change-event sources: decode, route, after-images, realtime normalizer, JSON coercion.

Transports (`read_changes`):
  kafka  — `readStream.format("kafka")`, one query subscribed to every table topic; offsets
           live in the query checkpoint (needs the Kafka connector package on the classpath).
  files  — a directory of JSON-lines files, one sub-folder per topic (`topic=<name>/`);
           batch or streaming, used offline and in tests.
Both yield (topic, value, _offset) with `value` the JSON text of one event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import op_code, table_of_topic, topic_name
from ledgerlake.operators.extract import compute_once
from ledgerlake.schemas import DEFAULT_SCHEMA, DEFAULT_TOPIC_PREFIX, TABLES

REALTIME_CONNECTOR = "realtime"
REJECTED = "_rejected"  # the lake table of events that could not be read


def topics_for(tables: Sequence[str] | str, prefix: str = DEFAULT_TOPIC_PREFIX, schema: str = DEFAULT_SCHEMA) -> list[str]:
    """Comma list or sequence of tables → topics `prefix.schema.table` (trimmed, blanks dropped)."""
    names = tables.split(",") if isinstance(tables, str) else list(tables)
    return [f"{prefix}.{schema}.{t.strip()}" for t in names if t and t.strip()]


def read_changes(
    spark: SparkSession,
    source: str,
    path_or_servers: str,
    tables: Sequence[str] = TABLES,
    prefix: str = DEFAULT_TOPIC_PREFIX,
    schema: str = DEFAULT_SCHEMA,
    streaming: bool = True,
    starting_offsets: str = "latest",
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Change events as (topic, value, _offset). Micro-batch size is bounded by
    `max_files_per_trigger` (files) or `max_offsets_per_trigger` (Kafka)."""
    topics = topics_for(tables, prefix, schema)
    if source == "kafka":
        reader = spark.readStream if streaming else spark.read
        reader = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", path_or_servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting_offsets)
        )
        if streaming and max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        df = reader.load()
        return df.select(
            "topic",
            F.col("value").cast("string").alias("value"),
            (F.col("partition").cast("bigint") * F.lit(1 << 40) + F.col("offset")).alias("_offset"),
        )
    if source == "files":
        reader = spark.readStream if streaming else spark.read
        reader = reader.format("text").schema(T.StructType([T.StructField("value", T.StringType()), T.StructField("topic", T.StringType())]))
        if streaming and max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        df = reader.load(path_or_servers)
        return df.filter(F.col("topic").isin(topics)).select(
            "topic", "value", F.col("_metadata.file_modification_time").cast("long").alias("_offset")
        )
    raise ValueError(f"unknown change source {source!r}")


def decode(df: DataFrame, value: str = "value") -> DataFrame:
    """Parse the JSON text into `j: VARIANT` once per event; text that is not JSON gives NULL
    (see `quarantine`)."""
    return compute_once(df, j=F.try_parse_json(F.col(value)))


def quarantine(decoded: DataFrame) -> DataFrame:
    """Events whose text is not JSON: kept aside and countable, never silently lost."""
    return decoded.filter(F.col("j").isNull())


def _empty_or_null(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v) | (F.schema_of_variant(v) == "OBJECT<>")


def after_image(
    decoded: DataFrame,
    wrapped: bool = True,
    keep_deletes: bool = False,
    topic: str = "topic",
) -> DataFrame:
    """Row after-images of change events: (table, v, _op, _ts_ms, _offset).

    Events without an after-image (deletes, missing/NULL/empty `after`) are dropped, as the
    lake only holds rows (H8); `keep_deletes=True` keeps them as tombstones with the
    before-image in `v` and `_op = 'd'`. `wrapped=False` reads bare envelopes (no `payload`).
    """
    root = "$.payload" if wrapped else "$"
    base = compute_once(
        decoded.filter(F.col("j").isNotNull()),
        _after=F.variant_get("j", f"{root}.after", "variant"),
        _before=F.variant_get("j", f"{root}.before", "variant"),
    )
    after, before = F.col("_after"), F.col("_before")
    op = F.try_variant_get("j", f"{root}.op", "string")
    ts_ms = F.try_variant_get("j", f"{root}.ts_ms", "bigint")
    has_after = ~_empty_or_null(after)
    if keep_deletes:
        body = F.when(has_after, after).otherwise(before)
        keep = has_after | ((op == "d") & ~_empty_or_null(before))
    else:
        body, keep = after, has_after
    offset = F.col("_offset") if "_offset" in decoded.columns else F.lit(None).cast("bigint")
    return base.filter(keep).select(
        table_of_topic(F.col(topic)).alias("table"),
        body.alias("v"),
        op.alias("_op"),
        ts_ms.alias("_ts_ms"),
        offset.alias("_offset"),
    )


def images_and_rejects(decoded: DataFrame, tables: Sequence[str], wrapped: bool = True, topic: str = "topic") -> DataFrame:
    """`after_image` of the listed tables, and in one pass the events that could not be read, as rows of table REJECTED.

    An event is rejected when its text is not JSON, or has no object where the envelope should be. Its `v` holds the
    table, topic, text and reason. An event without text is the tombstone after a delete, and no reject.
    """
    root = "$.payload" if wrapped else "$"
    own = table_of_topic(F.col(topic))
    base = compute_once(
        decoded.filter(F.col("value").isNotNull() & own.isin(list(tables))),
        _envelope=F.variant_get("j", root, "variant"),
        _after=F.variant_get("j", f"{root}.after", "variant"),
    )
    envelope, after = F.col("_envelope"), F.col("_after")
    kind = F.schema_of_variant(envelope)
    reason = F.when(F.col("j").isNull(), "not JSON").when(envelope.isNull() | F.is_variant_null(envelope) | ~kind.startswith("OBJECT"), "no envelope")
    offset = F.col("_offset") if "_offset" in decoded.columns else F.lit(None).cast("bigint")
    bad = F.col("_reason").isNotNull()
    rows = base.withColumn("_reason", reason).filter(bad | ~_empty_or_null(after))
    kept = F.to_variant_object(F.struct(own.alias("table"), F.col(topic).alias("topic"), F.col("value").alias("value"), F.col("_reason").alias("reason")))
    return rows.select(
        F.when(bad, REJECTED).otherwise(own).alias("table"),
        F.when(bad, kept).otherwise(after).alias("v"),
        F.when(~bad, F.try_variant_get("j", f"{root}.op", "string")).alias("_op"),
        F.when(~bad, F.try_variant_get("j", f"{root}.ts_ms", "bigint")).alias("_ts_ms"),
        offset.alias("_offset"),
    )


def _truthy_object(v: Column) -> Column:
    """Python truthiness of a JSON value used as a record: NULL, null, {} are false."""
    return ~_empty_or_null(v)


def _text(j: Column, path: str) -> Column:
    return F.nullif(F.try_variant_get(j, path, "string"), F.lit(""))


def normalize_changes(
    df: DataFrame,
    run_ts_ms: Column,
    default_schema: str = DEFAULT_SCHEMA,
    connector: str = REALTIME_CONNECTOR,
    payload: str = "j",
) -> DataFrame:
    """Row-change payloads of a realtime feed → change envelopes.

    data = payload.data where that is present (also empty), else the payload itself; event type = eventType or event or type;
    INSERT/UPDATE/DELETE (any case) → c/u/d, anything else → r; after = NULL for deletes;
    after-image = new or record, before-image = old or old_record; schema defaults.
    Output: (table, schema, op, envelope) with `envelope` the JSON text of
    {"payload": {op, source: {connector, schema, table}, ts_ms, before, after}}.
    """
    p = F.col(payload)
    wrapped = F.variant_get(p, "$.data", "variant")
    # each stage is computed once per row and referenced by name
    d = compute_once(df.select(p), _wrapped=wrapped)
    d = compute_once(d, _data=F.when(F.col("_wrapped").isNotNull(), F.col("_wrapped")).otherwise(p)).select("_data")
    j = F.col("_data")
    d = d.select(
        F.coalesce(_text(j, "$.eventType"), _text(j, "$.event"), _text(j, "$.type")).alias("_event"),
        _text(j, "$.table").alias("table"),
        F.coalesce(_text(j, "$.schema"), F.lit(default_schema)).alias("schema"),
        F.variant_get(j, "$.new", "variant").alias("_new"),
        F.variant_get(j, "$.record", "variant").alias("_record"),
        F.variant_get(j, "$.old", "variant").alias("_old"),
        F.variant_get(j, "$.old_record", "variant").alias("_old_record"),
    )
    d = d.select(
        "table",
        "schema",
        op_code(F.col("_event")).alias("op"),
        F.when(_truthy_object(F.col("_new")), F.col("_new")).otherwise(F.col("_record")).alias("_after"),
        F.when(_truthy_object(F.col("_old")), F.col("_old")).otherwise(F.col("_old_record")).alias("_before"),
    )
    envelope = F.to_json(
        F.struct(
            F.struct(
                F.col("op"),
                F.struct(F.lit(connector).alias("connector"), F.col("schema"), F.col("table")).alias("source"),
                run_ts_ms.cast("bigint").alias("ts_ms"),
                F.col("_before").alias("before"),
                F.when(F.col("op") == "d", F.lit(None).cast("variant")).otherwise(F.col("_after")).alias("after"),
            ).alias("payload")
        )
    )
    return d.select("table", "schema", "op", envelope.alias("envelope"))


def only_tables(df: DataFrame, tables: Sequence[str], table: str = "table") -> DataFrame:
    """Drop changes without a table or for tables not allow-listed."""
    return df.filter(F.col(table).isNotNull() & F.col(table).isin(list(tables)))


def route(df: DataFrame, prefix: str = DEFAULT_TOPIC_PREFIX, schema: str = DEFAULT_SCHEMA, table: str = "table") -> DataFrame:
    """Topic from the *configured* schema, not the event's."""
    return df.withColumn("topic", topic_name(prefix, schema, F.col(table)))


def realtime_to_changes(
    payloads: DataFrame,
    run_ts_ms: Column,
    tables: Sequence[str],
    prefix: str = DEFAULT_TOPIC_PREFIX,
    schema: str = DEFAULT_SCHEMA,
    payload: str = "j",
) -> DataFrame:
    """Realtime row-change payloads (`j: VARIANT`) → (topic, value) change events: normalized,
    guarded (table present and allow-listed) and routed with the configured schema."""
    env = only_tables(normalize_changes(payloads, run_ts_ms, schema, payload=payload), tables)
    return route(env, prefix, schema).select("topic", F.col("envelope").alias("value"))


def write_changes(changes: DataFrame, sink: str, target: str, checkpoint: str | None = None, trigger: dict | None = None):
    """Publish (topic, value) change events.

    sink="files": JSON-lines directory, one sub-folder per topic (batch or streaming);
    sink="kafka": `target` is the bootstrap servers (needs the Kafka connector package).
    """
    if changes.isStreaming:
        w = changes.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
        if sink == "kafka":
            return w.format("kafka").option("kafka.bootstrap.servers", target).start()
        return w.format("text").partitionBy("topic").start(target)
    if sink == "kafka":
        changes.write.format("kafka").option("kafka.bootstrap.servers", target).save()
        return None
    changes.select("value", "topic").write.mode("append").partitionBy("topic").text(target)
    return None


def iso_text(c: Column) -> Column:
    """ISO-8601 text of a timestamp: fraction only when non-zero (as Python's isoformat)."""
    micros = F.unix_micros(c.cast("timestamp_ntz").cast("timestamp")) % 1_000_000
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == 0, base).otherwise(F.concat(base, F.lit("."), F.lpad(micros.cast("string"), 6, "0")))


def jsonable(df: DataFrame) -> DataFrame:
    """Coerce columns to JSON-friendly values: dates/timestamps → ISO text, decimals → double,
    binary and other non-JSON types → text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType
        if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = iso_text(c)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.BinaryType, T.DayTimeIntervalType, T.YearMonthIntervalType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def envelopes(df: DataFrame, table: str, op: Column | None = None, ts_ms: Column | None = None,
              after: Column | None = None, prefix: str = DEFAULT_TOPIC_PREFIX, schema: str = DEFAULT_SCHEMA) -> DataFrame:
    """Rows of an entity → capture-style change events (topic, value) with JSON values."""
    j = jsonable(df)
    row = F.struct(*[F.col(c) for c in j.columns])
    body = after if after is not None else row
    value = F.to_json(
        F.struct(
            F.struct(
                (op if op is not None else F.lit("c")).alias("op"),
                F.struct(F.lit("capture").alias("connector"), F.lit(schema).alias("schema"), F.lit(table).alias("table")).alias(
                    "source"
                ),
                (ts_ms if ts_ms is not None else F.lit(0).cast("bigint")).alias("ts_ms"),
                F.lit(None).cast("string").alias("before"),
                body.alias("after"),
            ).alias("payload")
        )
    )
    return j.select(F.lit(f"{prefix}.{schema}.{table}").alias("topic"), value.alias("value"))
