"""Whole-table windows without a one-partition window on data-sized input.

`share_of_total`  — `x / sum(x) over ()` as a one-row global aggregate broadcast back.
`global_rank`     — `rank() over (order by x)` from per-value counts and prefix sums over value ranges
                    with fixed bounds (the ranges' totals are the only thing that meets in one place).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.operators.joins import null_spread


def share_of_total(df: DataFrame, col: str, out: str = "pct_share", scale: int = 2) -> DataFrame:
    """round(100 * col / nullif(sum(col) over (), 0), scale) as DOUBLE, computed in DECIMAL."""
    total = df.agg(F.sum(F.col(col)).cast("decimal(20,0)").alias("_share_total"))
    joined = df.crossJoin(F.broadcast(total))  # exactly one row: a global aggregate
    pct = (F.col(col).cast("decimal(20,0)") * F.lit(100)) / F.nullif(F.col("_share_total"), F.lit(0))
    return joined.withColumn(out, F.round(pct, scale).cast("double")).drop("_share_total")


def _sort_key(c: str, descending: bool, nulls_first: bool | None) -> Column:
    col = F.col(c)
    if nulls_first is None:  # warehouse default: NULLS LAST on ASC, NULLS FIRST on DESC
        nulls_first = descending
    if descending:
        return col.desc_nulls_first() if nulls_first else col.desc_nulls_last()
    return col.asc_nulls_first() if nulls_first else col.asc_nulls_last()


def global_rank(
    df: DataFrame,
    col: str,
    out: str = "rank",
    descending: bool = True,
    nulls_first: bool | None = None,
    dense: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Competition rank (ties share, gaps follow) or dense rank of `col` over the whole table.

    The range of a value is an expression over bounds that are literals (approximate quantiles of the values),
    so every use of it agrees, whatever the optimizer reuses. A value that many rows share is joined by broadcast.
    `col` is numeric, a date or a timestamp.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_n", F.lit(1).cast("bigint") if dense else F.col("_rows"))
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = df.agg(F.percentile_approx(col, [k / n for k in range(1, n)], 10_000)).first()[0] if n > 1 else None
    kind = df.schema[col].dataType
    place = F.lit(0)
    for b in sorted(set(bounds or [])):
        place = place + (F.col(col) > F.lit(b).cast(kind)).cast("int")
    first = descending if nulls_first is None else nulls_first
    place = F.when(F.col(col).isNull(), F.lit(-1 if first else n)).otherwise(-place + n - 1 if descending else place)
    key = _sort_key(col, descending, nulls_first)
    ranged = counts.withColumn("_pid", place)
    local_before = Window.partitionBy("_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("_n").over(local_before), F.lit(0)))
    totals = ranged.groupBy("_pid").agg(F.sum("_n").alias("_tot"))  # one row per range
    offsets = totals.withColumn(
        "_off",
        F.coalesce(F.sum("_tot").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    ranks = local.join(F.broadcast(offsets.select("_pid", "_off")), "_pid").select(
        F.col(col).alias("_rank_key"), "_rows", (F.col("_off") + F.col("_local") + 1).alias(out)
    )
    # values that more than 1/n of the rows share, at most n of them, go to the rows; the other rows go to their values
    often = ranks.filter(F.col("_rows") > df.count() / n).select(F.col("_rank_key").alias("_often"), F.col(out).alias("_often_rank"))
    rows = df.join(F.broadcast(often), df[col].eqNullSafe(often["_often"]), "left").drop("_often")
    rows = null_spread(rows, F.col("_often_rank").isNotNull(), "_r")
    rare = ranks.select("_rank_key", F.col(out).alias("_rare_rank"), F.lit(False).alias("_v_often"), F.lit(0).cast("bigint").alias("_v_salt"))
    cond = (rows["_r_null"] == rare["_v_often"]) & (rows["_r_salt"] == rare["_v_salt"]) & rows[col].eqNullSafe(rare["_rank_key"])
    joined = rows.join(rare, cond, "left").withColumn(out, F.coalesce("_often_rank", "_rare_rank").cast("bigint"))
    return joined.select(*df.columns, out)
