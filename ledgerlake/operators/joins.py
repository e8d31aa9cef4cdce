"""Joins used by the models: fact → account owner, event → current dimension, orphans.

The choice between a broadcast and a shuffle join is left to AQE, which knows the measured
sizes at run time and splits skewed partitions of the left side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def null_spread(df: DataFrame, is_null: Column, prefix: str, buckets: int | None = None) -> DataFrame:
    """Add `<prefix>_null` and `<prefix>_salt` join-key columns: rows whose key cannot match
    (a NULL part) get a salt from a hash of the row, others 0. Put both in the join condition
    against (false, 0) on the other side: matches are unchanged, and the unmatched rows spread
    over `buckets` partitions instead of one. The salt is deterministic (retries agree)."""
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(is_null, F.abs(F.xxhash64(*[F.col(c) for c in df.columns])) % n).otherwise(F.lit(0)).cast("bigint")
    return df.withColumn(f"{prefix}_null", is_null).withColumn(f"{prefix}_salt", salt)


def attach_customer(
    facts: DataFrame,
    accounts: DataFrame,
    key: str = "account_id",
    account_key: str = "account_id",
    out: str = "customer_id",
    null_buckets: int | None = None,
) -> DataFrame:
    """`facts ⟕ accounts` on the account id, adding the owning customer.

    Orphans keep a NULL customer. A NULL account id cannot match, but in a plain shuffle
    join all such rows would hash to one reducer; `null_spread` salts them instead.
    """
    left = null_spread(facts, F.col(key).isNull(), "_f", null_buckets)
    owners = accounts.select(
        F.lit(False).alias("_o_null"), F.lit(0).cast("bigint").alias("_o_salt"), F.col(account_key).alias("_acct"), F.col(out)
    )
    cond = (left["_f_null"] == owners["_o_null"]) & (left["_f_salt"] == owners["_o_salt"]) & (left[key] == owners["_acct"])
    return left.join(owners, cond, "left").drop("_f_null", "_f_salt", "_o_null", "_o_salt", "_acct")


def current_rows(history: DataFrame, flag: str = "is_current") -> DataFrame:
    if flag in history.columns:
        return history.filter(F.col(flag))
    return history.filter(F.col("valid_to").isNull())


def enrich_current(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    cols: Sequence[str],
) -> DataFrame:
    """Left join to the dimension's *current* rows (as of run time, not event time).

    Rows with a NULL key (they cannot match) are spread by `null_spread` instead of meeting in
    one reducer.
    """
    right = current_rows(dim).select(F.col(key).alias("_dim_key"), *[F.col(c) for c in cols])
    left = null_spread(df, F.col(key).isNull(), "_e")
    right = right.select(F.lit(False).alias("_d_null"), F.lit(0).cast("bigint").alias("_d_salt"), "*")
    cond = (left["_e_null"] == right["_d_null"]) & (left["_e_salt"] == right["_d_salt"]) & (left[key] == right["_dim_key"])
    return left.join(right, cond, "left").drop("_e_null", "_e_salt", "_d_null", "_d_salt", "_dim_key")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    pk = parent_key or key
    parents = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull())
    kids = child.filter(F.col(key).isNotNull())
    left, right = kids[key], parents["_pk"]
    if kids.schema[key].dataType != parents.schema["_pk"].dataType:  # e.g. text vs integer ids (H14)
        left, right = left.cast("string"), right.cast("string")
    return kids.join(parents, left == right, "left_anti")
