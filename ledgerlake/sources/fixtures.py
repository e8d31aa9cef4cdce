"""Fixture entities derived from the driver's TPC-H-like tables.

The seven banking entities (customers, accounts, transactions, services, service_usage,
customer_profiles, customer_segments) and a versioned row log are computed with Spark from
`customer`, `orders`, `events` and `lineitem`, so their size grows with the scale factor.
The oracle SQL uses the same rules.

Fixed values of the mapping:
  creation time of customers/accounts 1995-01-01, of services 2024-01-01
  as-of time of profiles and segments 2024-02-01
  orphan transaction account id -1 (orderkey mod 97 = 0)
  order status → type: F → DEPOSIT, O → WITHDRAWAL, P → TRANSFER
  email domain @example.com; favorite feature "dashboard"
  second batches: transactions split at 1999-01-01; segments split at 2024-01-02,
  reassignments at 2024-02-15 as "Active User" 85; new account ids start at 10,000,000;
  changed currency EUR
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.plans.segmentation import segment_customers
from ledgerlake.schemas import CHANNELS, DEFAULT_CURRENCY, DEFAULT_TXN_STATUS, TXN_TYPES

CREATED = "1995-01-01 00:00:00"
SERVICES_CREATED = "2024-01-01 00:00:00"
AS_OF = "2024-02-01 00:00:00"
TX_SPLIT = "1999-01-01 00:00:00"
SEGMENT_SPLIT = "2024-01-02 00:00:00"
REASSIGNED_AT = "2024-02-15 00:00:00"
NEW_ACCOUNT_BASE = 10_000_000
STATUS_TO_TYPE = {"F": "DEPOSIT", "O": "WITHDRAWAL", "P": "TRANSFER"}


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


_SCHEMAS: dict[str, object] = {}


def read(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """Read a driver table. Its schema is inferred once per path (a footer-reading job) and
    then given to the reader, so later reads plan without a job."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path in _SCHEMAS:
        df = spark.read.schema(_SCHEMAS[path]).parquet(path)
    else:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
    return df


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        ts(CREATED).alias("created_at"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.explode(F.array(F.lit(0), F.lit(1))).alias("i"))
    return c.select(
        (F.col("c_custkey") * 2 + F.col("i")).alias("id"),
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("i") == 0, "SAVINGS").otherwise("CHECKING").alias("account_type"),
        F.col("c_acctbal").alias("balance"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        ts(CREATED).alias("created_at"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    account = F.when(key % 97 == 0, F.lit(-1).cast("bigint")).otherwise(cust * 2 + key % 2)
    kind = F.when(F.col("o_orderstatus") == "F", STATUS_TO_TYPE["F"]).when(
        F.col("o_orderstatus") == "O", STATUS_TO_TYPE["O"]
    ).when(F.col("o_orderstatus") == "P", STATUS_TO_TYPE["P"])
    cents = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint") % 100000 + 1
    amount = (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    return o.select(
        key.alias("id"),
        account.alias("account_id"),
        kind.alias("txn_type"),
        amount.cast("double").alias("amount"),
        F.when(kind == "TRANSFER", account + 2).alias("related_account_id"),
        F.lit(DEFAULT_TXN_STATUS).alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )


def _event_type_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct event types with a 0-based dense rank (ascending, NULLS FIRST).

    The window runs over the *distinct* event types — a categorical domain of a few values
    after a partially aggregated distinct — not over event rows, so one partition is enough;
    the range-partitioned `global_rank` would only add scans here.
    """
    kinds = read(spark, sf_dir, "events").select("event_type").distinct()
    return kinds.withColumn("type_rank", F.dense_rank().over(Window.orderBy(F.col("event_type").asc_nulls_first())) - 1)


def services(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _event_type_codes(spark, sf_dir).select("event_type", "type_rank", F.explode(F.array(F.lit(0), F.lit(1))).alias("i"))
    return k.select(
        (F.col("type_rank") * 2 + F.col("i") + 1).cast("bigint").alias("id"),
        F.concat(F.upper("event_type"), F.lit("_"), F.col("i").cast("string")).alias("service_code"),
        F.concat(F.col("event_type"), F.lit(" "), F.col("i").cast("string")).alias("service_name"),
        F.upper("event_type").alias("category"),
        F.lit(True).alias("is_active"),
        ts(SERVICES_CREATED).alias("created_at"),
    )


def service_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    codes = _event_type_codes(spark, sf_dir)  # one row per event type; AQE broadcasts on its measured size
    j = e.join(codes, "event_type", "left")
    k = F.get_json_object("props", "$.k").cast("bigint")
    eid = F.col("event_id")
    return j.select(
        (eid + 1).alias("id"),
        F.col("user_id").alias("customer_id"),
        F.when(eid % 5 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id") * 2 + eid % 2).alias("account_id"),
        (F.col("type_rank") * 2 + k % 2 + 1).cast("bigint").alias("service_id"),
        F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (k % 5 + 1).cast("int")).alias("channel"),
        F.when(eid % 4 == 3, "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("ts").alias("used_at"),
    )


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").select("c_custkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    per_cust = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("o_orderstatus") == "P", price)).alias("p_sum"),
        F.sum(price).alias("all_sum"),
    )
    j = c.join(per_cust, c["c_custkey"] == per_cust["o_custkey"], "left")
    ck = F.col("c_custkey")
    n = F.coalesce(F.col("n"), F.lit(0))
    last_active = F.date_sub(F.lit(AS_OF[:10]).cast("date"), ((ck * 11) % 61).cast("int")).cast("timestamp_ntz")
    pref = F.when(ck % 7 == 0, F.lit(None).cast("string")).otherwise(
        F.element_at(F.array(*[F.lit(t) for t in TXN_TYPES]), (ck % 3 + 1).cast("int"))
    )
    return j.select(
        ck.alias("customer_id"),
        (n * 25).alias("total_transactions"),
        (F.coalesce(F.col("p_sum"), F.lit(0).cast("decimal(18,2)")).cast("double") / 20).alias("total_transfer_amount"),
        (F.col("all_sum").cast("double") / F.nullif(n, F.lit(0)) / 100).alias("avg_transaction_amount"),
        pref.alias("preferred_transaction_type"),
        ((ck * 7) % 61).alias("login_frequency"),
        F.lit("dashboard").alias("favorite_feature"),
        last_active.alias("last_active_date"),
        (((ck * 137) % 10001) / 100).alias("risk_score"),
        last_active.alias("updated_at"),
    )


def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_customers(customer_profiles(spark, sf_dir), ts(AS_OF))


def row_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a versioned row log; its consumers shuffle by key right away."""
    return read(spark, sf_dir, "lineitem", spread=False)


ENTITIES = {
    "customers": customers,
    "accounts": accounts,
    "transactions": transactions,
    "services": services,
    "service_usage": service_usage,
    "customer_profiles": customer_profiles,
    "customer_segments": customer_segments,
}


# ---- second batches for incremental / history operators ------------------------------------


def transactions_batch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).filter(F.col("created_at") < ts(TX_SPLIT))


def transactions_without_late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 1 as known on its day: odd ids of the seventh of January to March 1995 arrive later."""
    t, d = transactions_batch1(spark, sf_dir), F.col("created_at")
    late = (F.year(d) == 1995) & (F.month(d) <= 3) & (F.dayofmonth(d) == 7) & (F.col("id") % 2 == 1)
    return t.filter(~late)


def _usage_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return F.broadcast(service_usage(spark, sf_dir).agg(F.floor(F.max("id") / 2).alias("_half")))


def service_usage_batch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = service_usage(spark, sf_dir)
    return u.crossJoin(_usage_half(spark, sf_dir)).filter(F.col("id") <= F.col("_half")).drop("_half")


def service_usage_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usage rows plus a later status change for some old ids (id ≤ half, id mod 7 = 0)."""
    u = service_usage(spark, sf_dir)
    changed = (
        u.crossJoin(_usage_half(spark, sf_dir))
        .filter((F.col("id") <= F.col("_half")) & (F.col("id") % 7 == 0))
        .drop("_half")
        .withColumn("status", F.when(F.col("status") == "FAILED", "SUCCESS").otherwise("FAILED"))
        .withColumn("used_at", F.col("used_at") + F.expr("INTERVAL 1 SECOND"))
    )
    return u.unionByName(changed)


def accounts_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mod 10 = 0: balance + 1 (versions); = 1: currency only (ignored); = 2: missing; new ids."""
    a = accounts(spark, sf_dir).filter(F.col("id") % 10 != 2)
    a = a.withColumn("balance", F.when(F.col("id") % 10 == 0, F.col("balance") + 1).otherwise(F.col("balance")))
    a = a.withColumn("currency", F.when(F.col("id") % 10 == 1, F.lit("EUR")).otherwise(F.col("currency")))
    c = read(spark, sf_dir, "customer").filter(F.col("c_custkey") % 50 == 0)
    new = c.select(
        (F.lit(NEW_ACCOUNT_BASE) + F.col("c_custkey")).cast("bigint").alias("id"),
        F.col("c_custkey").alias("customer_id"),
        F.lit("SAVINGS").alias("account_type"),
        F.col("c_acctbal").alias("balance"),
        F.lit(DEFAULT_CURRENCY).alias("currency"),
        ts(CREATED).alias("created_at"),
    )
    return a.unionByName(new)


def customers_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mod 7 = 0: another e-mail (versions); = 1: missing from the source."""
    c = customers(spark, sf_dir).filter(F.col("id") % 7 != 1)
    return c.withColumn("email", F.when(F.col("id") % 7 == 0, F.concat(F.lit("new-"), F.col("email"))).otherwise(F.col("email")))


def services_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mod 4 = 0: switched off; = 1: another name (versions); = 2: another code (ignored)."""
    s, m = services(spark, sf_dir), F.col("id") % 4
    return (
        s.withColumn("is_active", F.when(m == 0, F.lit(False)).otherwise(F.col("is_active")))
        .withColumn("service_name", F.when(m == 1, F.concat("service_name", F.lit(" plus"))).otherwise(F.col("service_name")))
        .withColumn("service_code", F.when(m == 2, F.concat("service_code", F.lit("_B"))).otherwise(F.col("service_code")))
    )


def customer_profiles_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mod 5 = 0: updated_at + 1 day (versions); mod 5 = 1: other values, same time (ignored)."""
    p = customer_profiles(spark, sf_dir)
    m = F.col("customer_id") % 5
    bumped = F.when(m == 0, F.col("updated_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("updated_at"))
    return (
        p.withColumn("login_frequency", F.when(m == 0, F.col("login_frequency") + 1).when(m == 1, F.col("login_frequency") + 100).otherwise(F.col("login_frequency")))
        .withColumn("updated_at", bumped)
    )


def customer_segments_batch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_segments(spark, sf_dir).filter(F.col("assigned_at") < ts(SEGMENT_SPLIT))


def customer_segments_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = customer_segments(spark, sf_dir)
    moved = s.filter(F.col("customer_id") % 9 == 0).select(
        "customer_id",
        F.lit("Active User").alias("segment_name"),
        F.lit(85.0).alias("segment_score"),
        ts(REASSIGNED_AT).alias("assigned_at"),
    )
    return s.unionByName(moved)
