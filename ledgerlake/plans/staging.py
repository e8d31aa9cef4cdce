"""Staging datasets D01–D07: typed columns out of RAW `v`, latest row per key.

Null placement follows each model: four use the warehouse default for DESC (NULLS FIRST,
H1), profiles and segments say NULLS LAST. Ties are broken by the lake lineage
(`_ts_ms`, `_offset`, newest first) when present, then by the remaining columns, so the pick
is deterministic (H2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.functions.columns import safe_number
from ledgerlake.operators.dedup import latest_by
from ledgerlake.operators.extract import field

Spec = dict[str, tuple[str, str]]

CUSTOMERS: Spec = {
    "customer_id": ("id", "id"),
    "first_name": ("first_name", "string"),
    "last_name": ("last_name", "string"),
    "email": ("email", "string"),
    "created_at": ("created_at", "timestamp"),
}
ACCOUNTS: Spec = {
    "account_id": ("id", "id"),
    "customer_id": ("customer_id", "id"),
    "account_type": ("account_type", "string"),
    "balance": ("balance", "float"),
    "currency": ("currency", "string"),
    "created_at": ("created_at", "timestamp"),
}
TRANSACTIONS: Spec = {
    "transaction_id": ("id", "id"),
    "account_id": ("account_id", "id"),
    "amount": ("amount", "float"),
    "transaction_type": ("txn_type", "string"),
    "related_account_id": ("related_account_id", "id"),
    "status": ("status", "string"),
    "transaction_time": ("created_at", "timestamp"),
}
SERVICES: Spec = {
    "service_id": ("id", "int"),
    "service_code": ("service_code", "string"),
    "service_name": ("service_name", "string"),
    "category": ("category", "string"),
    "is_active": ("is_active", "boolean"),
    "created_at": ("created_at", "timestamp"),
}
SERVICE_USAGE: Spec = {
    "usage_id": ("id", "int"),
    "customer_id": ("customer_id", "int"),
    "account_id": ("account_id", "int"),
    "service_id": ("service_id", "int"),
    "channel": ("channel", "string"),
    "status": ("status", "string"),
    "used_at": ("used_at", "timestamp"),
}
CUSTOMER_PROFILES: Spec = {
    "customer_id": ("customer_id", "id"),
    "total_transactions": ("total_transactions", "number"),
    "total_transfer_amount": ("total_transfer_amount", "number"),
    "avg_transaction_amount": ("avg_transaction_amount", "number"),
    "login_frequency": ("login_frequency", "number"),
    "preferred_transaction_type": ("preferred_transaction_type", "string"),
    "favorite_feature": ("favorite_feature", "string"),
    "last_active_date": ("last_active_date", "timestamp_ntz"),
    "risk_score": ("risk_score", "number"),
    "updated_at": ("updated_at", "timestamp_ntz"),
}
CUSTOMER_SEGMENTS: Spec = {
    "customer_id": ("customer_id", "id"),
    "segment_name": ("segment_name", "string"),
    "segment_score": ("segment_score", "number"),
    "assigned_at": ("assigned_at", "timestamp_ntz"),
}


def _typed(raw: DataFrame, spec: Spec, scale: int = 0) -> DataFrame:
    cols = []
    for name, (path, kind) in spec.items():
        if kind == "number":
            cols.append(safe_number(F.variant_get("v", f"$.{path}", "string"), scale).alias(name))
        else:
            cols.append(field("v", path, kind).alias(name))
    lineage = [c for c in ("_ts_ms", "_offset") if c in raw.columns]
    return raw.select(*cols, *lineage)


def _lineage_order(df: DataFrame) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ("_ts_ms", "_offset") if c in df.columns]


def _rest(df: DataFrame, used: set[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in df.columns if c not in used and not c.startswith("_")]


def _latest(df: DataFrame, key: str, order: Column, order_name: str) -> DataFrame:
    tiebreak = _lineage_order(df) + _rest(df, {key, order_name})
    out = latest_by(df, [key], [order], tiebreak)
    return out.drop(*[c for c in ("_ts_ms", "_offset") if c in out.columns])


def stg_customers(raw: DataFrame, ctx: RunContext) -> DataFrame:
    t = _typed(raw, CUSTOMERS)
    return _latest(t, "customer_id", F.col("created_at").desc_nulls_first(), "created_at").withColumn(
        "load_timestamp", ctx.ts()
    )


def stg_accounts(raw: DataFrame, ctx: RunContext) -> DataFrame:
    t = _typed(raw, ACCOUNTS)
    return _latest(t, "account_id", F.col("created_at").desc_nulls_first(), "created_at").withColumn(
        "load_timestamp", ctx.ts()
    )


def stg_transactions(raw: DataFrame, ctx: RunContext, dedupe: bool = False) -> DataFrame:
    """Not deduplicated by default: re-captured rows are counted twice downstream (H9)."""
    t = _typed(raw, TRANSACTIONS)
    if dedupe:
        t = _latest(t, "transaction_id", F.col("transaction_time").desc_nulls_first(), "transaction_time")
    else:
        t = t.drop(*[c for c in ("_ts_ms", "_offset") if c in t.columns])
    return t.withColumn("load_timestamp", ctx.ts())


def stg_services(raw: DataFrame, ctx: RunContext) -> DataFrame:
    t = _typed(raw, SERVICES)
    return _latest(t, "service_id", F.col("created_at").desc_nulls_first(), "created_at").withColumn(
        "load_timestamp", ctx.ts()
    )


def stg_service_usage(raw: DataFrame, ctx: RunContext) -> DataFrame:
    t = _typed(raw, SERVICE_USAGE)
    return _latest(t, "usage_id", F.col("used_at").desc_nulls_first(), "used_at").withColumn(
        "load_timestamp", ctx.ts()
    )


def stg_customer_profiles(raw: DataFrame, ctx: RunContext, scale: int = 0) -> DataFrame:
    """Numbers go through the safe cast: NULL on bad text, rounded to `scale` (H4)."""
    t = _typed(raw, CUSTOMER_PROFILES, scale)
    return _latest(t, "customer_id", F.col("updated_at").desc_nulls_last(), "updated_at").withColumn(
        "load_ts", ctx.ts()
    )


def stg_customer_segments(raw: DataFrame, ctx: RunContext, scale: int = 0) -> DataFrame:
    t = _typed(raw, CUSTOMER_SEGMENTS, scale)
    out = _latest(t, "customer_id", F.col("assigned_at").desc_nulls_last(), "assigned_at")
    return out.select(
        "customer_id", "segment_name", "segment_score", "assigned_at", F.col("assigned_at").alias("updated_at")
    ).withColumn("load_ts", ctx.ts())


STAGING = {
    "customers": stg_customers,
    "accounts": stg_accounts,
    "transactions": stg_transactions,
    "services": stg_services,
    "service_usage": stg_service_usage,
    "customer_profiles": stg_customer_profiles,
    "customer_segments": stg_customer_segments,
}
