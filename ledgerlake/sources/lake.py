"""Parquet lake and versioned tables.

Lake layout (own sink): `<lake>/table=<t>/date=<yyyy-mm-dd>/part-*.parquet` with columns
`v` (VARIANT after-image) and lineage `_op, _ts_ms, _offset`: one fixed schema, so files of a
table never disagree. A lake written by the streaming sink is read through the sink's commit
log (`_spark_metadata`); batch `write_lake` is for lakes without a streaming writer. Foreign files in the reference layout `<lake>/<t>/date=<d>/*.parquet`
(row columns, types inferred per file) are read by footer schema group (H5).

Versioned tables: `<root>/<name>/v=<n>/batch=<k>/`; `batch=0` is the full contents of
version n, later batches are appends. A batch counts once its commit record exists, so a
half-written batch is never read, and nothing is overwritten in place (H19).
"""

from __future__ import annotations

import json
import re
import uuid
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.sources.raw import to_raw

if TYPE_CHECKING:
    from ledgerlake.sources.partitioned import PartitionedTable

LAKE_COLUMNS = ["v", "_op", "_ts_ms", "_offset"]


# ---- file system helpers (Hadoop FS through the session, works for any cluster store) ----


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


# ---- lake sink -----------------------------------------------------------------------------


def lake_frame(after_images: DataFrame, date: F.Column) -> DataFrame:
    """(table, v, lineage) + ingest `date` partition value."""
    cols = ["table"] + [c for c in LAKE_COLUMNS if c in after_images.columns]
    return after_images.select(*cols).withColumn("date", date.cast("string"))


def write_lake(after_images: DataFrame, lake: str, ctx: RunContext) -> None:
    """Batch append of after-images, partitioned by table and processing date (UTC).

    A lake that a streaming sink writes is read through the sink's commit log, which would never show these rows: refused.
    """
    if exists(after_images.sparkSession, f"{lake.rstrip('/')}/_spark_metadata"):
        raise ValueError(f"{lake} is written by a stream; batch rows would not be read from it")
    lake_frame(after_images, ctx.date()).write.mode("append").partitionBy("table", "date").parquet(lake)


# ---- lake → RAW -----------------------------------------------------------------------------


def _own_layout(spark: SparkSession, lake: str, table: str) -> str | None:
    p = f"{lake.rstrip('/')}/table={table}"
    return p if exists(spark, p) else None


def _foreign_layout(spark: SparkSession, lake: str, table: str) -> str | None:
    p = f"{lake.rstrip('/')}/{table}"
    return p if exists(spark, p) else None


# URI schemes that pyarrow opens, by their names in Spark
_ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}

_FOOTERS = "path string, schema string, rows long"


def _footers(files: DataFrame) -> DataFrame:
    """Per file: its Parquet footer schema as text (None: not a Parquet file) and its rows, read on the executors.

    Where pyarrow knows the store only the footer is read; of other stores, Spark reads the files' bytes.
    Only a file that is not Parquet counts as unreadable; a store that fails raises.
    """
    scheme = F.regexp_extract("path", r"^([a-z0-9+.-]+):", 1)
    known = scheme.isin(*_ARROW_SCHEMES)

    def read(batches):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        for pdf in batches:
            schemas, rows = [], []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                if content is None:
                    name, rest = path.split(":", 1)
                    filesystem, rel = pafs.FileSystem.from_uri(f"{_ARROW_SCHEMES[name]}:{rest}")
                    handle = filesystem.open_input_file(rel)
                else:
                    handle = pa.BufferReader(content)
                with handle:
                    try:
                        footer = pq.read_metadata(handle)
                        schemas.append(";".join(f"{f.name}:{f.type}" for f in footer.schema.to_arrow_schema()))
                        rows.append(footer.num_rows)
                    except pa.ArrowInvalid:  # not a Parquet file: skipped, as the tolerant load does
                        schemas.append(None)
                        rows.append(None)
            yield pd.DataFrame({"path": pdf["path"], "schema": schemas, "rows": pd.array(rows, "Int64")})

    native = files.filter(known).select("path", F.lit(None).cast("binary").alias("content"))
    other = files.filter(~known).select("path", "content")
    return native.unionAll(other).mapInPandas(read, _FOOTERS)


_DATED = re.compile(r"^date=(.+)$")


def _foreign_roots(spark: SparkSession, folder: str, since: str | None) -> list[str]:
    """The folders to read: those of the dates since `since`, where the files lie by date; else the whole folder."""
    dates = [m.group(1) if (m := _DATED.match(d)) else None for d in list_dirs(spark, folder)]
    if not since or None in dates:
        return [folder]
    return [f"{folder}/date={d}" for d in dates if d >= since]


def _foreign_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """_footers of the Parquet files below these folders."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return _footers(reader.load(roots).select("path", "content"))


def refresh_raw(spark: SparkSession, lake: str, table: str, since: str | None = None) -> DataFrame | None:
    """RAW contents of `table` := every lake file of it now (full refresh). None when the
    table has no files, so the caller keeps the previous RAW (skip-on-empty).

    Output: `v` VARIANT, lineage columns, `_file`. Foreign files that are not Parquet are skipped and counted
    (`load_audit`); files of the own sink are complete, so one that can't be read is an error. With `since`, the
    rows carry their `date`, and only the folders of that date and later ones are read ("": all).
    """
    day = F.regexp_extract("_file", r"/date=([^/]+)/", 1)
    parts: list[DataFrame] = []
    own = _own_layout(spark, lake, table)
    if own:
        if exists(spark, f"{lake.rstrip('/')}/_spark_metadata"):
            # written by the streaming file sink: read through its commit log (committed files
            # only, never a retried batch's leftovers) and prune to the table's partition
            df = spark.read.parquet(lake).where(F.col("table") == table)
        else:
            df = spark.read.parquet(own)
        if since:
            df = df.where(F.col("date") >= F.lit(since).cast(df.schema["date"].dataType))
        df = df.withColumn("_file", F.col("_metadata.file_path"))
        parts.append(df.select(*[c for c in LAKE_COLUMNS if c in df.columns], "_file"))
    foreign = _foreign_layout(spark, lake, table)
    roots = _foreign_roots(spark, foreign, since) if foreign else []
    if roots:
        reader = spark.read.option("ignoreCorruptFiles", "true")
        groups = _foreign_files(spark, roots).filter(F.col("schema").isNotNull())
        # one entry per distinct footer schema (a handful), not per row
        schemas = [r["schema"] for r in groups.select("schema").distinct().collect()]
        lineage = ("_op", "_ts_ms", "_offset", "_file")
        if len(schemas) == 1:
            # no drift: read the folder as a whole, no file list through the driver; the schema comes from a
            # file that could be read, as the reader's own inference may pick one that is not Parquet
            one = groups.select("path").first()["path"]
            df = (
                reader.schema(spark.read.parquet(one).schema)
                .option("recursiveFileLookup", "true")
                .option("pathGlobFilter", "*.parquet")
                .parquet(*roots)
                .withColumn("_file", F.col("_metadata.file_path"))
            )
            parts.append(to_raw(df, exclude=("date", "table"), lineage=lineage))
        for sch in schemas if len(schemas) > 1 else []:
            paths = [r["path"] for r in groups.filter(F.col("schema") == sch).select("path").collect()]
            df = reader.parquet(*paths).withColumn("_file", F.col("_metadata.file_path"))
            parts.append(to_raw(df, exclude=("date", "table"), lineage=lineage))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    for c in ("_op", "_ts_ms", "_offset"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string" if c == "_op" else "bigint"))
    return out if since is None else out.withColumn("date", F.when(day != "", day))


def load_audit(raw: DataFrame, table: str, lake: str | None = None) -> DataFrame:
    """One row: files and rows loaded for one table (`raw` as landed) and, of a `lake`, what was not: `skipped_files` (foreign files
    that are not Parquet), `lost_rows` (rows that readable foreign files hold and the load lacks) and `bad_lines`
    (events of the table that could not be read)."""
    from ledgerlake.sources.cdc import REJECTED

    spark = raw.sparkSession
    foreign_row = ~F.col("_file").contains(f"/table={table}/")
    loaded = raw.agg(
        F.count_distinct("_file").alias("files"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(foreign_row).alias("_foreign"),
    )
    if lake is None:
        return loaded.select(F.lit(table).alias("table"), "files", "rows")
    foreign = _foreign_layout(spark, lake, table)
    files = _foreign_files(spark, [foreign]) if foreign else spark.createDataFrame([], _FOOTERS)
    files = files.agg(F.count_if(F.col("schema").isNull()).alias("skipped_files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("_held"))
    rejected = refresh_raw(spark, lake, REJECTED)
    if rejected is None:
        bad = spark.range(1).select(F.lit(0).cast("long").alias("bad_lines"))
    else:
        bad = rejected.agg(F.count_if(F.variant_get("v", "$.table", "string") == table).alias("bad_lines"))
    out = loaded.crossJoin(files).crossJoin(bad)  # one row each
    return out.select(F.lit(table).alias("table"), "files", "rows", "skipped_files", (F.col("_held") - F.col("_foreign")).alias("lost_rows"), "bad_lines")


def land_raw(spark: SparkSession, lake: str, table: str, landed: PartitionedTable) -> DataFrame | None:
    """Bring `landed` (RAW by ingest date) up to date and return it: v, lineage, `_file`.

    Files come into the folder of the day they are written on, so a run reads the last date that it has and later
    ones, and replaces those partitions; older dates are neither read nor copied. None if nothing was ever landed.
    """
    days = [d.removeprefix("date=") for d in list_dirs(spark, landed.path) if _DATED.match(d)]
    fresh = refresh_raw(spark, lake, table, since=max(days, default=""))
    if fresh is not None:
        landed.overwrite(fresh, f"run-{uuid.uuid4().hex}")
    out = landed.read()
    return None if out is None else out.drop("date")


# ---- versioned tables ------------------------------------------------------------------------

_V = re.compile(r"^v=(\d+)$")
_B = re.compile(r"^batch=(\d+)$")


class TableStore:
    """Immutable versions of named tables under one root (shared storage on a cluster).

    A batch is written first and counts once its commit record `_COMMIT` exists: one small file, moved into place
    in one step, that holds all that belongs to the batch (its high-water marks, its generation). So a run that fails at any point leaves nothing half done, and can be run again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _dir(self, name: str) -> str:
        return f"{self.root}/{name}"

    # commit records

    def _commit(self, path: str, record: dict) -> None:
        fs, p = _fs(self.spark, path)
        jvm = self.spark.sparkContext._jvm
        temporary = jvm.org.apache.hadoop.fs.Path(p, f"_commit-{uuid.uuid4().hex}.tmp")
        out = fs.create(temporary, True)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        if not fs.rename(temporary, jvm.org.apache.hadoop.fs.Path(p, "_COMMIT")):
            raise OSError(f"{path} could not be committed")

    def _record(self, path: str) -> dict | None:
        if not exists(self.spark, f"{path}/_COMMIT"):
            return None
        fs, p = _fs(self.spark, f"{path}/_COMMIT")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def records(self, name: str, version: int) -> dict[int, dict]:
        """The committed batches of a version, with their records."""
        base, out = f"{self._dir(name)}/v={version}", {}
        for d in list_dirs(self.spark, base):
            m = _B.match(d)
            r = self._record(f"{base}/{d}") if m else None
            if r is not None:
                out[int(m.group(1))] = r
        return dict(sorted(out.items()))

    def versions(self, name: str) -> list[int]:
        found = [int(m.group(1)) for m in map(_V.match, list_dirs(self.spark, self._dir(name))) if m]
        return sorted(v for v in found if self.is_committed(name, v))

    def current(self, name: str) -> int | None:
        found = sorted((int(m.group(1)) for m in map(_V.match, list_dirs(self.spark, self._dir(name))) if m), reverse=True)
        return next((v for v in found if self.is_committed(name, v)), None)

    def batches(self, name: str, version: int) -> list[int]:
        return list(self.records(name, version))

    def generation(self, name: str) -> int:
        """The generation of the current version (0: none)."""
        v = self.current(name)
        return 0 if v is None else self.records(name, v)[0].get("generation", 0)

    def read(self, name: str, version: int | None = None, generation: int | None = None) -> DataFrame | None:
        """The rows of a version. With `generation`, batches of later generations are left out, and of batches of
        one generation (a step that was run again) the last counts."""
        v = self.current(name) if version is None else version
        if v is None:
            return None
        records = self.records(name, v)
        if generation is not None:
            last = {r.get("generation", 0): b for b, r in records.items() if r.get("generation", 0) <= generation}
            records = dict.fromkeys(last.values())
        if not records:
            return None
        return self.spark.read.parquet(*[f"{self._dir(name)}/v={v}/batch={b}" for b in records])

    def is_committed(self, name: str, version: int) -> bool:
        return exists(self.spark, f"{self._dir(name)}/v={version}/batch=0/_COMMIT")

    def _write(self, df: DataFrame, name: str, version: int, batch: int, mark_col: str | None, record: dict, previous=None) -> None:
        path = f"{self._dir(name)}/v={version}/batch={batch}"
        df.write.mode("errorifexists").parquet(path)
        if mark_col:
            top = self.spark.read.schema(df.schema).parquet(path).agg(F.max(mark_col).alias("mark"))
            if previous is not None:
                top = top.select(F.greatest(F.col("mark"), F.lit(str(previous)).cast(df.schema[mark_col].dataType)).alias("mark"))
            record = record | {"marks": {mark_col: top.select(F.col("mark").cast("string")).first()[0]}}
        self._commit(path, record)

    def publish(self, df: DataFrame, name: str, version: int | None = None, mark_col: str | None = None, generation: int | None = None) -> int:
        """Write `df` as a new version; readers switch once it is committed. Publishing an already committed
        `version` is a no-op. The record holds the high-water mark of `mark_col`, and `generation`."""
        v = version
        if v is not None and self.is_committed(name, v):
            return v
        record = {} if generation is None else {"generation": generation}
        if v is None:
            v = (self.current(name) or 0) + 1
            while exists(self.spark, f"{self._dir(name)}/v={v}"):
                v += 1  # skip leftovers of a failed attempt
        elif exists(self.spark, f"{self._dir(name)}/v={v}/batch=0"):
            fs, p = _fs(self.spark, f"{self._dir(name)}/v={v}/batch=0")
            fs.delete(p, True)  # only an uncommitted leftover can be here
        self._write(df, name, v, 0, mark_col, record)
        return v

    def append(self, df: DataFrame, name: str, mark_col: str | None = None, generation: int | None = None) -> int:
        """Add rows to the current version as a new batch (exact for append-only targets), with the advanced mark."""
        v = self.current(name)
        if v is None:
            return self.publish(df, name, mark_col=mark_col, generation=generation)
        b = max(self.batches(name, v)) + 1
        while exists(self.spark, f"{self._dir(name)}/v={v}/batch={b}"):
            b += 1
        previous = None
        if mark_col:
            previous = self.read_mark(name, mark_col)
            if previous is None:
                previous = self.read(name).agg(F.max(mark_col)).first()[0]
        self._write(df, name, v, b, mark_col, {} if generation is None else {"generation": generation}, previous)
        return v

    # high-water marks

    def _mark_path(self, name: str, col: str) -> str:
        return f"{self._dir(name)}/_marks/{col}"

    def read_mark(self, name: str, col: str):
        """The high-water mark of `col`: of the current version's last batch, or None where that holds none.
        Of a table without versions, the mark that `advance_mark` kept."""
        v = self.current(name)
        if v is not None:
            text = list(self.records(name, v).values())[-1].get("marks", {}).get(col)
            kind = self.read(name).schema[col].dataType
            return None if text is None else self.spark.range(1).select(F.lit(text).cast(kind)).first()[0]
        path = self._mark_path(name, col)
        if not exists(self.spark, f"{path}/_SUCCESS"):
            return None
        row = self.spark.read.parquet(path).first()
        return None if row is None else row["mark"]

    def advance_mark(self, name: str, col: str, batch: DataFrame, previous=None) -> None:
        """Keep max(previous, max(batch.col)) as the mark of a target that is stored elsewhere."""
        m = batch.agg(F.max(col).alias("mark"))
        if previous is not None:
            m = m.select(F.greatest(F.col("mark"), F.lit(str(previous)).cast(batch.schema[col].dataType)).alias("mark"))
        m.write.mode("overwrite").parquet(self._mark_path(name, col))
