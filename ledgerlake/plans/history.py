"""History datasets D08–D12 (SCD2 snapshots of staging) and dimensions D16–D18."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.operators.history import present_history, scd2_check, scd2_timestamp


def customers_history(src: DataFrame, hist: DataFrame | None, ctx: RunContext) -> DataFrame:
    return scd2_check(hist, src, "customer_id", ["first_name", "last_name", "email"], ctx.ts())


def accounts_history(src: DataFrame, hist: DataFrame | None, ctx: RunContext) -> DataFrame:
    """Currency changes alone do not version an account (not a check column)."""
    return scd2_check(hist, src, "account_id", ["customer_id", "account_type", "balance"], ctx.ts())


def services_history(src: DataFrame, hist: DataFrame | None, ctx: RunContext) -> DataFrame:
    return scd2_check(hist, src, "service_id", ["service_name", "category", "is_active"], ctx.ts())


def profiles_history(src: DataFrame, hist: DataFrame | None, ctx: RunContext | None = None) -> DataFrame:
    return scd2_timestamp(hist, src, "customer_id", "updated_at")


def segments_history(src: DataFrame, hist: DataFrame | None, ctx: RunContext | None = None) -> DataFrame:
    return scd2_timestamp(hist, src, "customer_id", "assigned_at")


_DIM_CUSTOMERS = ["customer_id", "first_name", "last_name", "email", "created_at"]
_DIM_ACCOUNTS = ["account_id", "customer_id", "account_type", "balance", "currency", "created_at"]
_DIM_SERVICES = ["service_id", "service_code", "service_name", "category", "is_active", "created_at"]


def _dim(hist: DataFrame, cols: list[str]) -> DataFrame:
    p = present_history(hist)
    return p.select(*cols, "effective_from", "effective_to", "is_current")


def dim_customers(hist: DataFrame) -> DataFrame:
    return _dim(hist, _DIM_CUSTOMERS)


def dim_accounts(hist: DataFrame) -> DataFrame:
    return _dim(hist, _DIM_ACCOUNTS)


def dim_services(hist: DataFrame) -> DataFrame:
    return _dim(hist, _DIM_SERVICES)


def current_services(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))
