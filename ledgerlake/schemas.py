"""Entity schemas, the table registry and the domain values the reference fixes.

Fixed values (must equal the reference's for equal results), stated in their natural order:
  tables:              customers, accounts, transactions, services, service_usage,
                       customer_profiles, customer_segments
  transaction types:   DEPOSIT, WITHDRAWAL, TRANSFER
  account types:       SAVINGS, CHECKING
  channels:            WEB, MOBILE, ATM, BRANCH, CALL_CENTER
  usage statuses:      SUCCESS, FAILED
  service categories:  PAYMENTS, TRANSFERS, INQUIRY, LOANS, CARDS, ACCOUNT
  currency default:    USD
  transaction status default: COMPLETED
  topic naming:        <prefix>.<schema>.<table>, prefix default banking_server, schema default public
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------------------------
TABLES = [
    "customers",
    "accounts",
    "transactions",
    "services",
    "service_usage",
    "customer_profiles",
    "customer_segments",
]
TXN_TYPES = ["DEPOSIT", "WITHDRAWAL", "TRANSFER"]
ACCOUNT_TYPES = ["SAVINGS", "CHECKING"]
CHANNELS = ["WEB", "MOBILE", "ATM", "BRANCH", "CALL_CENTER"]
USAGE_STATUSES = ["SUCCESS", "FAILED"]
CATEGORIES = ["PAYMENTS", "TRANSFERS", "INQUIRY", "LOANS", "CARDS", "ACCOUNT"]
DEFAULT_CURRENCY = "USD"
DEFAULT_TXN_STATUS = "COMPLETED"
DEFAULT_TOPIC_PREFIX = "banking_server"
DEFAULT_SCHEMA = "public"
# -------------------------------------------------------------------------------------------

_S, _L, _I, _D, _B, _TS = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampNTZType(),
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# System-of-record entities, columns in DDL order. Money travels as DOUBLE on the change
# stream (the capture path turns decimals into doubles); sums are done in DECIMAL(18,2).
ENTITY_SCHEMAS: dict[str, T.StructType] = {
    "customers": _struct(
        ("id", _L), ("first_name", _S), ("last_name", _S), ("email", _S), ("created_at", _TS)
    ),
    "accounts": _struct(
        ("id", _L), ("customer_id", _L), ("account_type", _S), ("balance", _D),
        ("currency", _S), ("created_at", _TS),
    ),
    "transactions": _struct(
        ("id", _L), ("account_id", _L), ("txn_type", _S), ("amount", _D),
        ("related_account_id", _L), ("status", _S), ("created_at", _TS),
    ),
    "services": _struct(
        ("id", _L), ("service_code", _S), ("service_name", _S), ("category", _S),
        ("is_active", _B), ("created_at", _TS),
    ),
    "service_usage": _struct(
        ("id", _L), ("customer_id", _L), ("account_id", _L), ("service_id", _L),
        ("channel", _S), ("status", _S), ("used_at", _TS),
    ),
    "customer_profiles": _struct(
        ("customer_id", _L), ("total_transactions", _L), ("total_transfer_amount", _D),
        ("avg_transaction_amount", _D), ("preferred_transaction_type", _S),
        ("login_frequency", _L), ("favorite_feature", _S), ("last_active_date", _TS),
        ("risk_score", _D), ("updated_at", _TS),
    ),
    "customer_segments": _struct(
        ("customer_id", _L), ("segment_name", _S), ("segment_score", _D), ("assigned_at", _TS)
    ),
}

# Primary key of each entity (the partition key of every "latest row" step).
ENTITY_KEYS: dict[str, str] = {
    "customers": "id",
    "accounts": "id",
    "transactions": "id",
    "services": "id",
    "service_usage": "id",
    "customer_profiles": "customer_id",
    "customer_segments": "customer_id",
}

# Columns the lake carries next to the after-image for ordering versions (H2).
LINEAGE_COLUMNS = ["_op", "_ts_ms", "_offset"]

# Change-event envelope as it arrives as JSON text on a topic.
ENVELOPE_SCHEMA_DDL = (
    "payload STRUCT<op: STRING, source: STRUCT<connector: STRING, schema: STRING, table: STRING>,"
    " ts_ms: BIGINT, before: STRING, after: STRING>"
)
