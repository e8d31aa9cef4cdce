"""Data-quality expectations: not_null, unique, relationships, row predicates, accepted values.

`check_datasets` returns one row per expectation: (check_name, dataset, column_name, failed_rows). Each dataset is
read once and one shuffle answers all checks; `require` turns failures into an error. `violations` gives the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.joins import orphans


@dataclass(frozen=True)
class Expectation:
    check: str  # not_null | unique | relationships | predicate | accepted_values
    column: str
    values: tuple = ()
    predicate: str | None = None  # SQL text of a row predicate (NULL result passes)
    parent: str | None = None  # dataset name of the parent for relationships
    parent_column: str | None = None
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.check


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def unique(column: str) -> Expectation:
    return Expectation("unique", column)


def relationships(column: str, parent: str, parent_column: str | None = None) -> Expectation:
    return Expectation("relationships", column, parent=parent, parent_column=parent_column or column)


def predicate(column: str, sql: str, name: str | None = None) -> Expectation:
    return Expectation("predicate", column, predicate=sql, name=name or "predicate")


def accepted_values(column: str, values: Sequence[str]) -> Expectation:
    return Expectation("accepted_values", column, values=tuple(values))


def violations(df: DataFrame, exp: Expectation, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """The offending rows (or, for `unique`, the duplicated values with their counts)."""
    c = F.col(exp.column)
    if exp.check == "not_null":
        return df.filter(c.isNull())
    if exp.check == "unique":
        return df.filter(c.isNotNull()).groupBy(exp.column).count().filter(F.col("count") > 1)
    if exp.check == "relationships":
        parent = (parents or {})[exp.parent]
        return orphans(df, parent, exp.column, exp.parent_column)
    if exp.check == "predicate":
        return df.filter(~F.coalesce(F.expr(exp.predicate), F.lit(True)))
    if exp.check == "accepted_values":
        return df.filter(c.isNotNull() & ~c.isin(list(exp.values)))
    raise ValueError(f"unknown check {exp.check}")


class QualityError(ValueError):
    """Checks that failed, or that had no dataset to look at."""


_TOKEN = "struct<check:int,value:string,n:bigint,parent:boolean>"


def _tokens(df: DataFrame, own: Sequence[tuple[int, Expectation]], children: Sequence[tuple[int, Expectation]]) -> DataFrame:
    """What one dataset tells about all checks that it has a part in, in one pass over it.

    A row check sends a token for each failing row, a key check the key's value, and the parent side of a relationship
    its value without a count.
    """

    def token(when: Column, i: int, value: Column, n: int = 1, parent: bool = False) -> Column:
        return F.when(when, F.struct(F.lit(i).alias("check"), value.cast("string").alias("value"), F.lit(n).cast("bigint").alias("n"), F.lit(parent).alias("parent")))

    out = []
    for i, e in own:
        c = F.col(e.column)
        if e.check == "not_null":
            out.append(token(c.isNull(), i, F.lit("")))
        elif e.check == "predicate":
            out.append(token(~F.coalesce(F.expr(e.predicate), F.lit(True)), i, F.lit("")))
        elif e.check == "accepted_values":
            out.append(token(c.isNotNull() & ~c.isin(list(e.values)), i, F.lit("")))
        elif e.check in ("unique", "relationships"):
            out.append(token(c.isNotNull(), i, c))
        else:
            raise ValueError(f"unknown check {e.check}")
    for i, e in children:
        c = F.col(e.parent_column)
        out.append(token(c.isNotNull(), i, c, n=0, parent=True))
    sent = F.explode(F.array_compact(F.array(*out)).cast(f"array<{_TOKEN}>"))
    return df.select(sent.alias("t")).select("t.*")


HELD = 1 << 17  # tokens that a task folds at a time
FOLDED = "check int, value string, n bigint, parent boolean"


def _folded(batches):
    """The tokens of a task with equal ones among HELD in a row folded: a frequent value is dealt out as few rows, and
    what a task holds does not grow with its different values, as a partial aggregate would."""
    held, rows = [], 0

    def fold():
        t = pa.Table.from_batches(held).group_by(["check", "value"], use_threads=False).aggregate([("n", "sum"), ("parent", "any")])
        return t.select(["check", "value", "n_sum", "parent_any"]).rename_columns(["check", "value", "n", "parent"]).combine_chunks().to_batches()

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= HELD:
            yield from fold()
            held, rows = [], 0
    if rows:
        yield from fold()


RESULT = "check_name string, dataset string, column_name string, failed_rows bigint"


def check_datasets(suite: dict[str, Sequence[Expectation]], datasets: dict[str, DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """(check_name, dataset, column_name, failed_rows) for every expectation of every dataset.

    Each dataset is read once and all checks share one shuffle: tokens are grouped by check and value after each task
    has folded them in bounded parts, so a value that a third of the rows hold meets as a row per part. failed_rows: failing rows;
    for `unique` the values that occur more than once; NULL where the dataset or its parent is absent.
    """
    checks = [(name, e) for name, es in suite.items() for e in es]
    there = {i for i, (name, e) in enumerate(checks) if name in datasets and (e.parent is None or e.parent in datasets)}
    spark = spark or next(iter(datasets.values())).sparkSession
    parts = []
    for name, df in datasets.items():
        own = [(i, e) for i, (d, e) in enumerate(checks) if d == name and i in there]
        children = [(i, e) for i, (_, e) in enumerate(checks) if e.parent == name and i in there]
        if own or children:
            parts.append(_tokens(df, own, children))
    rows = [(i, e.label, name, e.column, i in there) for i, (name, e) in enumerate(checks)]
    listed = spark.createDataFrame(rows, "check int, check_name string, dataset string, column_name string, there boolean")
    if not parts:
        return listed.select("check_name", "dataset", "column_name", F.lit(None).cast("bigint").alias("failed_rows"))
    tokens = reduce(DataFrame.unionAll, parts)
    # dealt out first: a partial aggregate would hold a task's different values all at once
    values = tokens.mapInArrow(_folded, FOLDED).repartition("check", "value").groupBy("check", "value").agg(F.sum("n").alias("n"), F.bool_or("parent").alias("found"))
    kind = lambda k: F.col("check").isin([i for i, (_, e) in enumerate(checks) if e.check == k] or [-1])
    failed = F.when(kind("unique"), (F.col("n") > 1).cast("bigint")).when(kind("relationships") & F.col("found"), F.lit(0)).otherwise(F.col("n"))
    found = values.groupBy("check").agg(F.sum(failed).alias("failed"))
    out = listed.join(found, "check", "left")
    return out.select("check_name", "dataset", "column_name", F.when(F.col("there"), F.coalesce("failed", F.lit(0).cast("bigint"))).alias("failed_rows"))


def run_checks(df: DataFrame, dataset: str, expectations: Sequence[Expectation], parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """`check_datasets` for one dataset."""
    return check_datasets({dataset: expectations}, {**(parents or {}), dataset: df}, df.sparkSession)


def require(results: DataFrame, allowed: Sequence[tuple[str, str, str]] = ()) -> None:
    """Raise QualityError if a check failed or had nothing to look at, but for the (check, dataset, column) allowed."""
    bad = results.filter(F.coalesce(F.col("failed_rows") > 0, F.lit(True))).orderBy("dataset", "check_name", "column_name").collect()  # a row per check at most
    said = [f"{r.dataset}.{r.column_name} {r.check_name}: " + ("absent" if r.failed_rows is None else f"{r.failed_rows} failed") for r in bad if (r.check_name, r.dataset, r.column_name) not in set(allowed)]
    if said:
        raise QualityError("; ".join(said))
