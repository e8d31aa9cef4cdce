"""Service-usage marts D23–D26."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.functions.columns import event_date
from ledgerlake.operators.aggregates import count_where, rollup_first_last
from ledgerlake.operators.joins import enrich_current
from ledgerlake.operators.merge import above_watermark, append
from ledgerlake.operators.ranking import global_rank, share_of_total

FCT_COLUMNS = [
    "usage_id",
    "customer_id",
    "account_id",
    "service_id",
    "service_code",
    "service_name",
    "category",
    "channel",
    "status",
    "used_at",
    "usage_date",
    "load_timestamp",
]


def fct_service_usage_batch(
    usage: DataFrame, dim_services: DataFrame, target: DataFrame | None, ctx: RunContext, mark=None
) -> DataFrame:
    """New usage rows above the target's max usage_id (or the kept `mark`), enriched with the
    *current* service attributes. The watermark is insert-only: a later change to an old id
    never arrives (H12)."""
    batch = above_watermark(usage, target, "usage_id", floor=0, mark=mark)
    e = enrich_current(batch, dim_services, "service_id", ["service_code", "service_name", "category"])
    e = e.withColumn("usage_date", event_date("used_at")).withColumn("load_timestamp", ctx.ts())
    return e.select(*FCT_COLUMNS)


def fct_service_usage(usage: DataFrame, dim_services: DataFrame, target: DataFrame | None, ctx: RunContext) -> DataFrame:
    """Full contents after the run. usage_id is the key and the batch is strictly above the
    target's max, so the merge is an append."""
    return append(target, fct_service_usage_batch(usage, dim_services, target, ctx))


def agg_service_frequency(fct: DataFrame, materialize: bool = True) -> DataFrame:
    """Per service: uses, distinct customers, successes, failures, share of all uses, rank.

    The per-service aggregate (one row per service of the catalogue) is read three times —
    rows, grand total, rank — with different columns each, so Spark would not reuse its
    exchanges and would run the whole usage pipeline three times. It is checkpointed once
    (to `spark.checkpoint.dir`) and the three reads share it.
    """
    per = fct.groupBy("service_id", "service_name", "category").agg(
        F.count(F.lit(1)).alias("total_uses"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        count_where(F.col("status") == "SUCCESS").alias("successful_uses"),
        count_where(F.col("status") == "FAILED").alias("failed_uses"),
        F.max("used_at").alias("last_used_at"),
    )
    if materialize:
        from ledgerlake.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(fct.sparkSession)
        per = per.checkpoint(eager=True)
    shared = share_of_total(per, "total_uses", "pct_share")
    ranked = global_rank(shared, "total_uses", "usage_rank", descending=True)
    return ranked.select(
        "service_id",
        "service_name",
        "category",
        "total_uses",
        "distinct_customers",
        "successful_uses",
        "failed_uses",
        "pct_share",
        "usage_rank",
        "last_used_at",
    )


def agg_service_usage_daily(fct: DataFrame) -> DataFrame:
    return fct.groupBy("usage_date", "service_id", "service_name", "category", "channel").agg(
        F.count(F.lit(1)).alias("total_uses"),
        F.count_distinct("customer_id").alias("distinct_customers"),
    )


def agg_customer_service_freq(fct: DataFrame) -> DataFrame:
    return rollup_first_last(fct, ["customer_id", "service_id", "service_name", "category"], "used_at")
