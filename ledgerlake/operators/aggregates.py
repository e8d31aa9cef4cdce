"""Aggregate building blocks: conditional counts/sums, zero-filled averages, group mode, roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import event_date


def count_where(pred: Column) -> Column:
    return F.count_if(pred)


def sum_where(pred: Column, value: Column, dtype: str = "decimal(18,2)") -> Column:
    """sum(case when pred then coalesce(value, 0) else 0 end), summed exactly as `dtype`."""
    v = F.coalesce(value.cast(dtype), F.lit(0).cast(dtype))
    return F.sum(F.when(pred, v).otherwise(F.lit(0).cast(dtype)))


def sum_zero(value: Column, dtype: str = "decimal(18,2)") -> Column:
    return F.sum(F.coalesce(value.cast(dtype), F.lit(0).cast(dtype)))


def avg_zero(value: Column, dtype: str = "decimal(18,2)") -> Column:
    """avg(coalesce(value, 0)) as DOUBLE: NULLs count as 0 in the denominator.

    Summed exactly in `dtype` and divided once, so the result does not depend on row order.
    """
    return sum_zero(value, dtype).cast("double") / F.count(F.lit(1))


def group_mode(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str | None = None,
    count_col: str = "_cnt",
) -> DataFrame:
    """Most frequent `value` per `keys`; ties go to the smallest value (NULLs first).

    Two aggregations, both with map-side partial aggregation: (keys, value) counts, then
    per key `min_by(value, (-count, value))`. No window over raw rows, no join back.
    """
    out = out or f"mode_{value}"
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(count_col))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct((-F.col(count_col)).alias("n"), F.col(value).alias("v"))).alias(out)
    )


def daily_rollup(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    date_col: str = "activity_date",
    amount: str | None = None,
    distinct: str | None = None,
    prefix: str = "",
) -> DataFrame:
    """Group by `keys` × calendar day of `ts`: row count, optional exact amount sum/avg, optional distinct count."""
    aggs = [F.count(F.lit(1)).alias(f"{prefix}count")]
    if amount:
        aggs += [
            sum_zero(F.col(amount)).cast("double").alias(f"{prefix}total"),
            avg_zero(F.col(amount)).alias(f"{prefix}avg"),
        ]
    if distinct:
        aggs.append(F.count_distinct(F.col(distinct)).alias(f"{prefix}distinct"))
    return df.groupBy(*keys, event_date(F.col(ts)).alias(date_col)).agg(*aggs)


def rollup_first_last(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Per key: count, first and last time."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_uses"),
        F.min(ts).alias("first_used_at"),
        F.max(ts).alias("last_used_at"),
    )
