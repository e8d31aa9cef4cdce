"""Intermediate tables in the shared folder, and connected components over a table of links."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path
from ledgerlake.sources.lake import delete

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_made: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once as Parquet below spark.checkpoint.dir and read back.

    This cuts the lineage (a lost executor costs no recomputation) and lets later readers prune columns. The shuffle
    files behind the write have no further reader, so they go with its end, not when the driver next collects garbage.
    """
    spark = df.sparkSession
    path = f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    if _made.get() is not None:
        _made.get().append(out)
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of written(). Only for tables whose last reader has written its own result: a lost executor then
    needs none of them again."""
    for t in tables:
        delete(t.sparkSession, t.written_path)


@contextmanager
def intermediates() -> Iterator[list[DataFrame]]:
    """The list of all tables that written() makes inside."""
    made: list[DataFrame] = []
    token = _made.set(made)
    try:
        yield made
    finally:
        _made.reset(token)


def is_empty(df: DataFrame) -> bool:
    return len(df.take(1)) == 0


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links(a, b): root is the smallest node reachable. Nodes can be any ordered type.

    Alternating large-star and small-star steps: each links neighbours to the smallest one they see, which halves
    long chains, so the number of rounds follows the logarithm of the longest path. All of it stays in tables.
    """
    both = lambda e: e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(max_rounds):
        # large star: neighbours above u are linked to the smallest node that u sees
        sees = both(edges)
        low = sees.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = sees.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: neighbours below u, and u, are linked to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        small = small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct()
        before, edges = edges, written(small, "links")
        # both are sets of rows: settled if they are equally large and no row is new
        settled = before.count() == edges.count() and is_empty(edges.join(before, ["a", "b"], "left_anti"))
        discard(before)
        if settled:
            break
    else:
        raise RuntimeError("components: the links did not settle")
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
