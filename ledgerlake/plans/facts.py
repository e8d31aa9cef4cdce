"""Fact datasets D20–D22."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.functions.columns import event_date
from ledgerlake.operators.aggregates import avg_zero, sum_zero
from ledgerlake.operators.dedup import latest_by
from ledgerlake.operators.merge import above_watermark, append, upsert
from ledgerlake.plans.features import transactions_with_customer
from ledgerlake.sources.partitioned import PartitionedTable

EPOCH_DATE = "1970-01-01"
EPOCH_TS = "1970-01-01 00:00:00"

FACT_TRANSACTION_COLUMNS = [
    "transaction_id",
    "account_id",
    "customer_id",
    "amount",
    "related_account_id",
    "status",
    "transaction_type",
    "transaction_time",
    "load_timestamp",
]


def fact_transactions(tx: DataFrame, accounts: DataFrame, target: DataFrame | None, ctx: RunContext) -> DataFrame:
    """Latest version per transaction_id (time desc, NULLS FIRST), owner attached, merged on
    transaction_id. No watermark: every run re-merges the whole source."""
    t = tx.select("transaction_id", "account_id", "amount", "transaction_type", "related_account_id", "status", "transaction_time")
    tiebreak = [F.col(c).asc_nulls_first() for c in t.columns if c not in ("transaction_id", "transaction_time")]
    dedup = latest_by(t, ["transaction_id"], [F.col("transaction_time").desc_nulls_first()], tiebreak)
    owned = transactions_with_customer(dedup, accounts)
    batch = owned.withColumn("load_timestamp", ctx.ts()).select(*FACT_TRANSACTION_COLUMNS)
    return upsert(target, batch, ["transaction_id"])


def customer_daily_activity(tx: DataFrame, accounts: DataFrame) -> DataFrame:
    t = transactions_with_customer(tx, accounts)
    return t.groupBy("customer_id", event_date("transaction_time").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("transactions_count"),
        sum_zero(F.col("amount")).cast("double").alias("total_amount"),
        avg_zero(F.col("amount")).alias("avg_amount"),
    )


def fact_customer_activity(
    tx: DataFrame, accounts: DataFrame, target: DataFrame | None, mode: str = "strict"
) -> DataFrame:
    """Per customer × day: count, total, average; key (customer_id, activity_date).

    mode="strict" (reference): only days strictly after the target's last day; since the day
    is part of the key nothing can match, so the merge is an append — the day in progress at
    the last run is never completed (H10).
    mode="recompute": the target's last day is rebuilt too and merged (late rows of that day
    are counted).
    Late rows of any earlier day: `refresh_customer_activity`.
    """
    if mode == "strict":
        return append(target, fact_customer_activity_batch(tx, accounts, target))
    daily = customer_daily_activity(tx, accounts)
    if mode == "recompute":
        batch = above_watermark(daily, target, "activity_date", floor=EPOCH_DATE, inclusive=True)
        return upsert(target, batch, ["customer_id", "activity_date"])
    raise ValueError(f"unknown mode {mode!r}")


def fact_customer_activity_batch(tx: DataFrame, accounts: DataFrame, target: DataFrame | None, mark=None) -> DataFrame:
    """Strict mode's new rows: days strictly after the target's last day (or the kept `mark`)."""
    return above_watermark(customer_daily_activity(tx, accounts), target, "activity_date", floor=EPOCH_DATE, mark=mark)


def _day_prints(rows: DataFrame, count: Column, amount: Column) -> DataFrame:
    """Per day four sums that the roll-up and the rows it was made from have in common: rows, cents, and both weighted
    by a hash of the customer, so that a row that changes hands shows too. Partial sums leave each task."""
    exact, weight = "decimal(38,0)", F.pmod(F.xxhash64("customer_id"), F.lit(1 << 31)).cast("decimal(10,0)")
    n = count.cast("decimal(14,0)")
    cents = (F.coalesce(amount.cast("decimal(20,2)"), F.lit(0)) * 100).cast("decimal(20,0)")
    sums = {"n": n, "cents": cents, "n_by": n * weight, "cents_by": cents * weight}
    return rows.groupBy("activity_date").agg(*[F.sum(c.cast(exact)).cast(exact).alias(k) for k, c in sums.items()])


def changed_days(tx: DataFrame, accounts: DataFrame, stored: DataFrame) -> DataFrame:
    """(activity_date, gone): the days whose transactions are not those of the stored roll-up; gone: there are none now."""
    rows = transactions_with_customer(tx, accounts).withColumn("activity_date", event_date("transaction_time"))
    amount = F.coalesce(F.col("amount").cast("decimal(18,2)"), F.lit(0))
    now = _day_prints(rows, F.lit(1), amount).alias("now")
    then = _day_prints(stored, F.col("transactions_count"), F.col("total_amount")).alias("then")
    same = F.lit(True)
    for c in ("n", "cents", "n_by", "cents_by"):
        same = same & F.col(f"now.{c}").eqNullSafe(F.col(f"then.{c}"))
    both = now.join(then, F.col("now.activity_date").eqNullSafe(F.col("then.activity_date")), "full")
    return both.filter(~same).select(F.coalesce("now.activity_date", "then.activity_date").alias("activity_date"), F.col("now.n").isNull().alias("gone"))


#: The columns a roll-up can be partitioned by, from its day: long histories of small days lie better by month.
ACTIVITY_UNITS = {"activity_date": lambda day: day, "activity_month": lambda day: F.date_format(day, "yyyy-MM")}


def refresh_customer_activity(tx: DataFrame, accounts: DataFrame, table: PartitionedTable, run: str) -> DataFrame:
    """Bring a roll-up partitioned by one of ACTIVITY_UNITS up to date, late rows of any earlier day included.

    Only partitions with a day that changed are grouped by customer again and rewritten.
    """
    unit = ACTIVITY_UNITS[table.by]
    daily = lambda rows: customer_daily_activity(rows, accounts).withColumn(table.by, unit(F.col("activity_date")))
    stored = table.read()
    if stored is None:
        table.overwrite(daily(tx), run)
        return table.read()
    days = changed_days(tx, accounts, stored).withColumn("unit", unit(F.col("activity_date")))
    days = days.groupBy("unit").agg(F.bool_or("gone").alias("gone")).collect()  # a row per calendar day at most
    if days:
        late = tx.sparkSession.createDataFrame([(d.unit,) for d in days], f"unit {stored.schema[table.by].dataType.simpleString()}")
        touched = tx.join(F.broadcast(late), unit(event_date("transaction_time")).eqNullSafe(F.col("unit")), "left_semi")
        table.overwrite(daily(touched), run)
        emptied = [d.unit for d in days if d.gone]
        if emptied:
            left = {r[0] for r in touched.select(unit(event_date("transaction_time"))).distinct().collect()}
            table.drop([u for u in emptied if u not in left])
    return table.read()


def fact_customer_segment(segments: DataFrame, target: DataFrame | None) -> DataFrame:
    """Latest segment per customer (assigned_at desc, NULLS FIRST), above the target's last
    assignment, merged on customer_id."""
    s = segments.select("customer_id", "segment_name", "segment_score", "assigned_at", "updated_at")
    tiebreak = [F.col(c).asc_nulls_first() for c in ("segment_name", "segment_score")]
    latest = latest_by(s, ["customer_id"], [F.col("assigned_at").desc_nulls_first()], tiebreak)
    batch = above_watermark(latest, target, "assigned_at", floor=EPOCH_TS)
    return upsert(target, batch, ["customer_id"])
