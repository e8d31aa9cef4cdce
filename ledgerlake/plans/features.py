"""Customer features D13–D15 and the profile dimension D19."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.functions.columns import first_known, risk_score
from ledgerlake.operators.joins import attach_customer
from ledgerlake.operators.merge import above_watermark, upsert

EPOCH_TS = "1970-01-01 00:00:00"
MONEY = "decimal(18,2)"


def transactions_with_customer(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """stg_transactions ⟕ stg_accounts → customer_id (NULL for orphans and NULL account ids)."""
    cols = ["transaction_id", "account_id", "amount", "transaction_type", "related_account_id", "status", "transaction_time"]
    return attach_customer(tx.select(*cols), accounts.select("account_id", "customer_id"))


def int_customer_transactions(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per customer: count, transfer total, zero-filled average, last time, preferred type.

    One (customer, type) aggregation feeds both the totals and the mode, then a second
    aggregation per customer: no window over raw rows and no join back. The preferred type
    is the most frequent one, ties to the alphabetically first; the NULL customer group gets
    no preferred type (a NULL key never matches in the reference's join back, H13).
    """
    t = transactions_with_customer(tx, accounts)
    amount = F.coalesce(F.col("amount").cast(MONEY), F.lit(0).cast(MONEY))
    per_type = t.groupBy("customer_id", "transaction_type").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.when(F.lower("transaction_type") == "transfer", amount).otherwise(F.lit(0).cast(MONEY))).alias("transfer"),
        F.sum(amount).alias("amount_sum"),
        F.max("transaction_time").alias("last_time"),
    )
    per_cust = per_type.groupBy("customer_id").agg(
        F.sum("cnt").alias("total_transactions"),
        F.sum("transfer").alias("transfer"),
        F.sum("amount_sum").alias("amount_sum"),
        F.max("last_time").alias("last_transaction_time"),
        F.min_by("transaction_type", F.struct((-F.col("cnt")).alias("n"), F.col("transaction_type").alias("t"))).alias(
            "mode"
        ),
    )
    return per_cust.select(
        "customer_id",
        F.col("total_transactions").cast("bigint").alias("total_transactions"),
        F.col("transfer").cast("double").alias("total_transfer_amount"),
        (F.col("amount_sum").cast("double") / F.col("total_transactions")).alias("avg_transaction_amount"),
        "last_transaction_time",
        F.when(F.col("customer_id").isNull(), F.lit(None).cast("string")).otherwise(F.col("mode")).alias(
            "preferred_transaction_type"
        ),
    )


def int_customer_behavior(d13: DataFrame, profiles: DataFrame) -> DataFrame:
    """Transaction features ⟕ latest profile, profile values first (H21: no tx → no row)."""
    p = profiles.select(
        F.col("customer_id").alias("_pc"),
        F.col("login_frequency").alias("_login"),
        F.col("preferred_transaction_type").alias("_pref"),
        F.col("favorite_feature").alias("_fav"),
        F.col("last_active_date").alias("_last"),
        F.col("risk_score").alias("_risk"),
    )
    j = d13.join(p, d13["customer_id"] == p["_pc"], "left")
    return j.select(
        "customer_id",
        "total_transactions",
        "total_transfer_amount",
        "avg_transaction_amount",
        "last_transaction_time",
        first_known(F.col("_login"), F.lit(0).cast("decimal(38,0)")).alias("login_frequency"),
        first_known(F.col("_pref"), F.col("preferred_transaction_type")).alias("preferred_transaction_type"),
        F.col("_fav").alias("favorite_feature"),
        first_known(F.col("_last"), F.col("last_transaction_time")).alias("last_active_date"),
        first_known(F.col("_risk"), F.lit(0).cast("decimal(38,0)")).alias("risk_score"),
    )


METRIC_COLUMNS = [
    "customer_id",
    "total_transactions",
    "total_transfer_amount",
    "avg_transaction_amount",
    "login_frequency",
    "preferred_transaction_type",
    "favorite_feature",
    "last_active_date",
    "risk_score",
    "updated_at",
]


def int_customer_metrics(d14: DataFrame, target: DataFrame | None, ctx: RunContext) -> DataFrame:
    """Behaviour + derived risk score (0..100), stamped with the run time; incremental on
    customer_id. Later runs take customers whose last transaction is after the target's max
    *processing* time (H11), then merge."""
    batch = d14
    if target is not None:
        batch = above_watermark(d14, target, "last_transaction_time", "updated_at", floor=EPOCH_TS)
    out = batch.select(
        "customer_id",
        "total_transactions",
        "total_transfer_amount",
        "avg_transaction_amount",
        "login_frequency",
        "preferred_transaction_type",
        "favorite_feature",
        "last_active_date",
        risk_score("risk_score", "total_transfer_amount", "avg_transaction_amount").alias("risk_score"),
        ctx.ts().alias("updated_at"),
    )
    return upsert(target, out, ["customer_id"])


def dim_customer_profile(metrics: DataFrame, target: DataFrame | None) -> DataFrame:
    """Latest metrics per customer; incremental on updated_at, merged on customer_id."""
    batch = metrics.select(*METRIC_COLUMNS)
    batch = above_watermark(batch, target, "updated_at", floor=EPOCH_TS)
    return upsert(target, batch, ["customer_id"])
