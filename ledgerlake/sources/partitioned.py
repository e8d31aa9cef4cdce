"""Tables in partition folders, of which a write replaces only the folders that it has rows for.

A write is first staged as a whole below `_staged/<tag>` (which readers of the table don't see) and then put in place
by Spark's dynamic partition overwrite. The staged rows are the complete new contents of their partitions, so putting
them in place can be repeated: a run that dies half way is finished by the next one that opens the table. Readers see
each partition before or after a write, not both.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import latest_by, total_order
from ledgerlake.sources.lake import delete, exists, list_dirs

SLICES = 8  # parts of a bucket that an upsert merges in tasks of their own


class PartitionedTable:
    def __init__(self, spark: SparkSession, path: str, by: str):
        self.spark, self.path, self.by = spark, path.rstrip("/"), by

    def _staged(self, tag: str) -> str:
        return f"{self.path}/_staged/{tag}"

    def recover(self) -> None:
        """Finish writes that were staged as a whole; drop what was staged in part."""
        for tag in list_dirs(self.spark, f"{self.path}/_staged"):
            if exists(self.spark, f"{self._staged(tag)}/_SUCCESS") and list_dirs(self.spark, self._staged(tag)):
                self._place(self.spark.read.parquet(self._staged(tag)))
            delete(self.spark, self._staged(tag))

    def _place(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.by).parquet(self.path)

    def read(self) -> DataFrame | None:
        """The table's rows; None before the first write."""
        self.recover()
        if not any(d.startswith(f"{self.by}=") for d in list_dirs(self.spark, self.path)):
            return None
        return self.spark.read.parquet(self.path)

    def overwrite(self, rows: DataFrame, tag: str, spread: bool = True) -> None:
        """Replace the partitions that rows has; others keep their files. rows may read this table.

        REBALANCE gives each partition few files of the advisory size and splits a large one over tasks; rows that
        lie by partition already come with spread=False. What is staged so is put in place without another shuffle.
        """
        staged = self._staged(tag)
        (rows.hint("rebalance", self.by) if spread else rows).write.mode("overwrite").partitionBy(self.by).parquet(staged)
        if list_dirs(self.spark, staged):
            self._place(self.spark.read.schema(rows.schema).parquet(staged))
        delete(self.spark, staged)

    def small_files(self, file_bytes: int = 128 << 20) -> DataFrame:
        """(partition, files, bytes) of the partitions with more files than their size asks for."""
        rows = self.read()
        files = rows.select(F.col(self.by), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
        sums = files.groupBy(self.by).agg(F.count("*").alias("files"), F.sum("size").alias("bytes"))
        return sums.filter(F.col("files") > F.ceil(F.col("bytes") / file_bytes))

    def compact(self, tag: str, file_bytes: int = 128 << 20) -> int:
        """Rewrite partitions that lie in too many files; returns how many. The rows stay as they are."""
        found = [r[0] for r in self.small_files(file_bytes).select(self.by).collect()]  # a row per partition at most
        if found:
            known = F.lit(False)
            for v in found:
                known = known | F.col(self.by).eqNullSafe(F.lit(v))
            self.overwrite(self.read().filter(known), tag)
        return len(found)

    def drop(self, values: Sequence) -> None:
        """Remove whole partitions."""
        for v in values:
            delete(self.spark, f"{self.path}/{self.by}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}")


class BucketedTable(PartitionedTable):
    """Rows by key, in folders by hash of the key: an upsert rewrites the buckets of the keys it brings, no others.

    The number of buckets is fixed when the table is made (its folder's name holds it): about the table's size in
    bytes by the size a task should rewrite. A later `buckets` is not looked at.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        made = [int(m.group(1)) for m in (re.match(r"^buckets-(\d+)$", d) for d in list_dirs(spark, path)) if m]
        self.keys, self.buckets = list(keys), made[0] if made else buckets
        super().__init__(spark, f"{path.rstrip('/')}/buckets-{self.buckets}", "bucket")

    def _keyless(self, rows: DataFrame) -> Column:
        """For a row whose key has a NULL, which no other row matches: a hash of the whole row; else NULL."""
        return F.when(F.greatest(F.lit(False), *[F.col(k).isNull() for k in self.keys]), F.xxhash64(*[c for c in rows.columns if c != self.by]))

    def upsert(self, batch: DataFrame, order: Sequence[Column], tag: str) -> None:
        """Merge batch, the newest row per key under `order` (equal ones: the least values) staying.

        Bringing the same rows again changes nothing, so a replayed batch needs no record of what was done.
        """
        rows = batch.withColumn(self.by, F.pmod(F.coalesce(self._keyless(batch), F.xxhash64(*self.keys)), F.lit(self.buckets)).cast("int")).persist()
        held = rows
        try:
            touched = [r[0] for r in rows.select(self.by).distinct().collect()]  # at most the number of buckets
            target = self.read() if touched else None
            if target is not None:
                rows = target.filter(F.col(self.by).isin(touched)).unionByName(rows.select(*target.columns))
            if touched:
                rest = total_order(rows, (*self.keys, self.by))
                rows = rows.withColumn("_alone", self._keyless(rows))
                # one shuffle by parts of buckets serves both the newest row per key and the write by bucket
                slices = F.pmod(F.shiftright(F.coalesce("_alone", F.xxhash64(*self.keys)), 32), F.lit(SLICES)).alias("_slice")
                rows = rows.select("*", slices).repartition(self.by, "_slice")
                merged = latest_by(rows, [self.by, "_slice", *self.keys, "_alone"], list(order), rest).drop("_alone", "_slice")
                self.overwrite(merged, tag, spread=False)
        finally:
            held.unpersist()

    def rows(self) -> DataFrame | None:
        out = self.read()
        return None if out is None else out.drop(self.by)
