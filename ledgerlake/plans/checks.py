"""The declared data tests (36) and the constraints of the system-of-record DDL as expectations.

`declared_checks(datasets)` / `ddl_checks(datasets)` take a dict of dataset name → DataFrame
and return (check_name, dataset, column_name, failed_rows), one row per expectation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.operators.quality import (
    Expectation,
    accepted_values,
    check_datasets,
    not_null,
    predicate,
    relationships,
    unique,
)
from ledgerlake.schemas import CATEGORIES, CHANNELS, USAGE_STATUSES

DECLARED: dict[str, list[Expectation]] = {
    "stg_services": [not_null("service_id"), unique("service_id"), not_null("service_code"), unique("service_code")],
    "stg_service_usage": [not_null("usage_id"), unique("usage_id"), not_null("service_id")],
    "dim_services": [not_null("service_id")],
    "fct_service_usage": [
        not_null("usage_id"),
        unique("usage_id"),
        not_null("service_id"),
        relationships("service_id", "dim_services", "service_id"),
    ],
    "agg_service_frequency": [not_null("service_id"), unique("service_id"), not_null("usage_rank")],
    "stg_customers": [not_null("customer_id"), unique("customer_id")],
    "stg_accounts": [not_null("account_id"), unique("account_id")],
    "stg_transactions": [not_null("transaction_id")],
    "dim_customers": [not_null("customer_id")],
    "dim_accounts": [not_null("account_id")],
    "fact_transactions": [not_null("transaction_id"), unique("transaction_id")],
    "stg_customer_profiles": [not_null("customer_id"), unique("customer_id")],
    "stg_customer_segments": [not_null("customer_id"), unique("customer_id"), not_null("segment_name")],
    "dim_customer_profile": [not_null("customer_id"), unique("customer_id")],
    "fact_customer_segment": [not_null("customer_id"), unique("customer_id"), not_null("segment_name")],
    "fact_customer_activity": [not_null("customer_id"), not_null("activity_date")],
}

DDL: dict[str, list[Expectation]] = {
    "stg_customers": [not_null("first_name"), not_null("last_name"), not_null("email"), unique("email")],
    "stg_accounts": [
        not_null("customer_id"),
        not_null("account_type"),
        not_null("balance"),
        not_null("currency"),
        predicate("balance", "balance >= 0", "balance_non_negative"),
        relationships("customer_id", "stg_customers", "customer_id"),
    ],
    "stg_transactions": [
        not_null("account_id"),
        not_null("transaction_type"),
        not_null("amount"),
        not_null("status"),
        predicate("amount", "amount > 0", "amount_positive"),
        relationships("account_id", "stg_accounts", "account_id"),
    ],
    "dim_customer_profile": [predicate("risk_score", "risk_score BETWEEN 0 AND 100", "risk_in_range")],
    "stg_service_usage": [
        not_null("customer_id"),
        not_null("channel"),
        not_null("status"),
        accepted_values("channel", CHANNELS),
        accepted_values("status", USAGE_STATUSES),
        relationships("customer_id", "stg_customers", "customer_id"),
        relationships("account_id", "stg_accounts", "account_id"),
        relationships("service_id", "stg_services", "service_id"),
    ],
    "stg_services": [not_null("service_name"), not_null("category"), not_null("is_active"), accepted_values("category", CATEGORIES)],
    "stg_customer_profiles": [
        # on the table the scores come from: those of dim_customer_profile are clamped to the range
        predicate("risk_score", "risk_score BETWEEN 0 AND 100", "risk_in_range"),
        relationships("customer_id", "stg_customers", "customer_id"),
    ],
    "stg_customer_segments": [relationships("customer_id", "stg_customers", "customer_id")],
}


def declared_checks(datasets: dict[str, DataFrame]) -> DataFrame:
    return check_datasets(DECLARED, datasets)


def ddl_checks(datasets: dict[str, DataFrame]) -> DataFrame:
    return check_datasets(DDL, datasets)
