"""Reports R01–R04: ordered, with a total order before any limit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_top_services(freq: DataFrame, n: int | None = 10) -> DataFrame:
    out = freq.orderBy(F.col("usage_rank").asc(), F.col("service_id").asc()).select(
        "usage_rank", "service_name", "category", "total_uses", "distinct_customers", "pct_share"
    )
    return out.limit(n) if n else out


def report_recent_activity(activity: DataFrame, n: int = 20) -> DataFrame:
    return (
        activity.orderBy(F.col("activity_date").desc_nulls_first(), F.col("customer_id").asc_nulls_first())
        .select("customer_id", "activity_date", "transactions_count", "total_amount")
        .limit(n)
    )


def report_segment_counts(segments: DataFrame) -> DataFrame:
    return (
        segments.groupBy("segment_name")
        .agg(F.count(F.lit(1)).alias("customers"))
        .orderBy(F.col("customers").desc(), F.col("segment_name").asc())
    )


def report_top_risk(profile: DataFrame, n: int = 10) -> DataFrame:
    return (
        profile.orderBy(F.col("risk_score").desc_nulls_last(), F.col("customer_id").asc())
        .select("customer_id", "risk_score")
        .limit(n)
    )
