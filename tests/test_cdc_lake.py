import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.sources.cdc import (
    after_image,
    decode,
    jsonable,
    normalize_changes,
    only_tables,
    quarantine,
    route,
    topics_for,
)
from ledgerlake.sources.lake import TableStore, load_audit, refresh_raw, write_lake
from ledgerlake.sources.raw import to_raw

EVENTS = [
    ("banking_server.public.accounts", '{"payload":{"op":"c","ts_ms":1,"after":{"id":1,"balance":10.5}}}'),
    ("banking_server.public.accounts", '{"payload":{"op":"u","ts_ms":2,"after":null}}'),
    ("banking_server.public.accounts", '{"payload":{"op":"u","ts_ms":3}}'),
    ("banking_server.public.accounts", '{"payload":{"op":"u","ts_ms":4,"after":{}}}'),
    ("banking_server.public.accounts", '{"payload":{"op":"d","ts_ms":5,"before":{"id":2},"after":null}}'),
    ("banking_server.public.accounts", "this is not json"),
    ("banking_server.public.accounts", '{"op":"c","after":{"id":9}}'),
    ("banking_server.public.secrets", '{"payload":{"op":"c","ts_ms":6,"after":{"id":3}}}'),
]


def test_topics_for_trims_and_drops_blanks():
    assert topics_for(" customers, ,accounts ,") == ["banking_server.public.customers", "banking_server.public.accounts"]


def test_after_image_edge_cases(spark):
    df = decode(spark.createDataFrame(EVENTS, "topic string, value string"))
    assert quarantine(df).count() == 1
    imgs = only_tables(after_image(df), ["accounts"])
    got = imgs.select("table", F.variant_get("v", "$.id", "int").alias("id"), "_op", "_ts_ms").collect()
    assert [(r.table, r.id, r._op, r._ts_ms) for r in got] == [("accounts", 1, "c", 1)]
    tomb = after_image(df, keep_deletes=True).filter(F.col("_op") == "d").select(F.variant_get("v", "$.id", "int")).collect()
    assert [r[0] for r in tomb] == [2]
    bare = after_image(df, wrapped=False).select(F.variant_get("v", "$.id", "int")).collect()
    assert [r[0] for r in bare] == [9]


def test_normalize_changes(spark):
    payloads = [
        '{"data":{"eventType":"INSERT","table":"customers","record":{"id":1}}}',
        '{"event":"delete","table":"customers","schema":"other","old_record":{"id":2},"new":{"id":2}}',
        '{"type":"","eventType":"","event":"Update","table":"accounts","new":{},"record":{"id":3},"old":{"id":3}}',
        '{"type":"truncate","table":"customers"}',
        '{"eventType":"INSERT","record":{"id":5}}',
        '{"eventType":"INSERT","table":"audit","record":{"id":6}}',
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "s string").select(F.parse_json("s").alias("j"))
    env = route(only_tables(normalize_changes(df, F.lit(123)), ["customers", "accounts"]))
    j = F.parse_json("envelope")
    out = env.select(
        "table", "topic", "op",
        F.variant_get(j, "$.payload.source.schema", "string").alias("schema"),
        F.try_variant_get(j, "$.payload.after.id", "int").alias("after_id"),
        F.try_variant_get(j, "$.payload.before.id", "int").alias("before_id"),
        F.variant_get(j, "$.payload.ts_ms", "bigint").alias("ts"),
    ).collect()
    got = [(r.table, r.topic, r.op, r.schema, r.after_id, r.before_id, r.ts) for r in out]
    assert got == [
        ("customers", "banking_server.public.customers", "c", "public", 1, None, 123),
        ("customers", "banking_server.public.customers", "d", "other", None, 2, 123),
        ("accounts", "banking_server.public.accounts", "u", "public", 3, 3, 123),
        ("customers", "banking_server.public.customers", "r", "public", None, None, 123),
    ]


def test_jsonable(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05' AS t, TIMESTAMP_NTZ'2024-01-02 03:04:05.25' AS f, DATE'2024-01-02' AS d, "
        "CAST(1.25 AS DECIMAL(5,2)) AS m, 'x' AS s, 7 AS i"
    )
    r = jsonable(df).first()
    assert (r.t, r.f, r.d, r.m, r.s, r.i) == ("2024-01-02T03:04:05", "2024-01-02T03:04:05.250000", "2024-01-02", 1.25, "x", 7)


def test_refresh_raw_type_drift_unreadable_and_missing(spark, tmp):
    lake = os.path.join(tmp, "lake")
    base = os.path.join(lake, "transactions", "date=2024-01-01")
    os.makedirs(base)
    pq.write_table(pa.table({"id": pa.array([1, 2], pa.int64()), "account_id": pa.array([10, 11], pa.int64())}), f"{base}/a.parquet")
    pq.write_table(pa.table({"id": pa.array([3], pa.int64()), "account_id": pa.array([12.0], pa.float64())}), f"{base}/b.parquet")
    with open(f"{base}/c.parquet", "wb") as fh:
        fh.write(b"definitely not parquet")
    own = to_raw(spark.createDataFrame([(4, 13)], "id long, account_id long")).withColumn("table", F.lit("transactions"))
    write_lake(own, lake, RunContext("2024-01-02 00:00:00"))
    raw = refresh_raw(spark, lake, "transactions")
    assert "date" not in raw.columns
    got = sorted(tuple(r) for r in raw.select(F.variant_get("v", "$.id", "int"), F.variant_get("v", "$.account_id", "int")).collect())
    assert got == [(1, 10), (2, 11), (3, 12), (4, 13)]
    assert raw.filter(F.variant_get("v", "$.date", "string").isNotNull()).count() == 0
    audit = load_audit(raw, "transactions").first()
    assert (audit.rows, audit.files) == (4, 3)
    assert refresh_raw(spark, lake, "customers") is None


def test_table_store_versions(spark, tmp):
    store = TableStore(spark, os.path.join(tmp, "wh"))
    assert store.read("t") is None
    assert store.publish(spark.range(3), "t") == 1
    assert store.publish(spark.range(5), "t") == 2
    assert store.read("t").count() == 5 and store.read("t", 1).count() == 3
    store.append(spark.range(2), "t")
    assert store.read("t").count() == 7
    assert store.publish(spark.range(100), "t", version=2) == 2  # replay of a committed version: no-op
    assert store.read("t").count() == 7


def test_epoch_millis_and_change_sink_roundtrip(spark, tmp):
    from ledgerlake.sources.cdc import read_changes, realtime_to_changes, write_changes

    ctx = RunContext("2024-01-01 00:00:01")
    assert spark.range(1).select(ctx.epoch_millis()).first()[0] == 1704067201000
    payloads = spark.createDataFrame(
        [('{"eventType":"INSERT","table":"customers","record":{"id":7}}',), ('{"eventType":"INSERT","table":"nope","record":{"id":8}}',)],
        "s string",
    ).select(F.parse_json("s").alias("j"))
    changes = realtime_to_changes(payloads, ctx.epoch_millis(), ["customers"])
    path = os.path.join(tmp, "feed")
    write_changes(changes, "files", path)
    back = read_changes(spark, "files", path, ["customers"], streaming=False)
    imgs = after_image(decode(back)).select("table", F.variant_get("v", "$.id", "int").alias("id"), "_ts_ms").collect()
    assert [(r.table, r.id, r._ts_ms) for r in imgs] == [("customers", 7, 1704067201000)]


def test_register_views(spark):
    from ledgerlake.plans.pipeline import register_views

    names = register_views({"ll_view_test": spark.range(3)})
    assert spark.sql(f"SELECT count(*) FROM {names[0]}").first()[0] == 3


def test_table_store_marks(spark, tmp):
    store = TableStore(spark, os.path.join(tmp, "wh2"))
    assert store.read_mark("t", "id") is None
    store.advance_mark("t", "id", spark.range(5))
    assert store.read_mark("t", "id") == 4
    store.advance_mark("t", "id", spark.range(2), previous=4)  # never moves back
    assert store.read_mark("t", "id") == 4
    store.advance_mark("t", "id", spark.range(10, 12), previous=4)
    assert store.read_mark("t", "id") == 11


def test_refresh_raw_single_schema_folder(spark, tmp):
    lake = os.path.join(tmp, "lake1")
    for d, ids in (("date=2024-01-01", [1, 2]), ("date=2024-01-02", [3])):
        os.makedirs(os.path.join(lake, "accounts", d))
        pq.write_table(pa.table({"id": pa.array(ids, pa.int64())}), os.path.join(lake, "accounts", d, "f.parquet"))
    raw = refresh_raw(spark, lake, "accounts")
    assert sorted(r[0] for r in raw.select(F.variant_get("v", "$.id", "int")).collect()) == [1, 2, 3]
    assert raw.filter(F.variant_get("v", "$.date", "string").isNotNull()).count() == 0


def test_rejected_events_are_kept_with_their_reason(spark):
    from ledgerlake.sources.cdc import REJECTED, images_and_rejects

    topic = "banking_server.public.accounts"
    good = '{"payload":{"op":"c","ts_ms":5,"after":{"id":1}}}'
    lines = [good, '{"payload":{"op":"d","after":null}}', '{"payload":{"after":{}}}', "oops", "[1]", '{"id":3}', '{"payload":7}', '{"payload":null}', "", None]
    df = decode(spark.createDataFrame([(topic, x) for x in lines] + [("banking_server.public.other", "oops")], "topic string, value string"))
    out = images_and_rejects(df, ["accounts"])
    got = sorted(out.filter(F.col("table") == REJECTED).select(F.variant_get("v", "$.reason", "string"), F.variant_get("v", "$.value", "string")).collect())
    assert [tuple(r) for r in got] == sorted([("no envelope", x) for x in ("[1]", '{"id":3}', '{"payload":7}', '{"payload":null}')] + [("not JSON", ""), ("not JSON", "oops")])
    rows = out.filter(F.col("table") == "accounts").select(F.variant_get("v", "$.id", "int"), "_op", "_ts_ms").collect()
    assert [tuple(r) for r in rows] == [(1, "c", 5)]


def test_load_audit_counts_what_was_not_loaded(spark, tmp):
    from ledgerlake.sources.cdc import images_and_rejects
    from ledgerlake.sources.lake import land_raw
    from ledgerlake.sources.partitioned import PartitionedTable

    lake = os.path.join(tmp, "lake")
    base = os.path.join(lake, "accounts", "date=2024-01-01")
    os.makedirs(base)
    for name in ("a", "b"):
        pq.write_table(pa.table({"id": pa.array(range(5000), pa.int64())}), f"{base}/{name}.parquet", row_group_size=1000, compression="none")
    content = bytearray(open(f"{base}/b.parquet", "rb").read())
    content[4:2000] = b"\xff" * 1996  # a good footer over broken pages
    open(f"{base}/b.parquet", "wb").write(content)
    open(f"{base}/c.parquet", "wb").write(b"no parquet")
    lines = spark.createDataFrame([("banking_server.public.accounts", x) for x in ("oops", "[]", '{"payload":{"op":"c","after":{"id":9}}}')], "topic string, value string")
    write_lake(images_and_rejects(decode(lines), ["accounts"]), lake, RunContext("2024-01-02 00:00:00"))
    landed = land_raw(spark, lake, "accounts", PartitionedTable(spark, os.path.join(tmp, "raw"), "date"))
    r = load_audit(landed, "accounts", lake).first()
    assert r.bad_lines == 2 and r.skipped_files == 1
    assert r.lost_rows > 0 and r.rows + r.lost_rows == 10_001


def test_a_second_landing_reads_new_dates_only(spark, tmp):
    from ledgerlake.sources.lake import land_raw
    from ledgerlake.sources.partitioned import PartitionedTable

    lake, landed = os.path.join(tmp, "lake"), PartitionedTable(spark, os.path.join(tmp, "raw"), "date")
    rows = lambda ids: to_raw(spark.createDataFrame([(i,) for i in ids], "id long")).withColumn("table", F.lit("t"))
    ids = lambda df: sorted(r[0] for r in df.select(F.variant_get("v", "$.id", "int")).collect())
    assert land_raw(spark, lake, "t", landed) is None
    write_lake(rows([1, 2]), lake, RunContext("2024-01-01 00:00:00"))
    os.makedirs(os.path.join(lake, "t", "date=2024-01-01"))
    pq.write_table(pa.table({"id": pa.array([3], pa.int64())}), os.path.join(lake, "t", "date=2024-01-01", "f.parquet"))
    write_lake(rows([4]), lake, RunContext("2024-01-02 00:00:00"))
    assert ids(land_raw(spark, lake, "t", landed)) == [1, 2, 3, 4]
    old = {f for f in landed.read().inputFiles() if "date=2024-01-01" in f}
    write_lake(rows([5]), lake, RunContext("2024-01-02 12:00:00"))  # the day goes on
    write_lake(rows([6]), lake, RunContext("2024-01-03 00:00:00"))
    fresh = refresh_raw(spark, lake, "t", since="2024-01-02")
    assert ids(fresh) == [4, 5, 6]
    assert "PartitionFilters: [isnotnull(date" in fresh._jdf.queryExecution().executedPlan().toString()
    assert not [r for r in fresh.select("_file").collect() if "date=2024-01-01" in r[0]]
    assert ids(land_raw(spark, lake, "t", landed)) == [1, 2, 3, 4, 5, 6]
    assert old <= set(landed.read().inputFiles())  # the first day's files were left alone
    assert ids(land_raw(spark, lake, "t", landed)) == [1, 2, 3, 4, 5, 6]
