"""Registered queries: every dataset/operator of the survey, built from the driver tables.

Each entry takes (spark, sf_dir) and returns a DataFrame. Run-time columns use fixed run
times so results are comparable with the SQL oracle (`ledgerlake.plans.oracle`).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.operators.aggregates import group_mode
from ledgerlake.operators.dedup import latest_by
from ledgerlake.operators.history import present_history, scd2_from_log
from ledgerlake.plans import facts, features, history, reports, staging, usage
from ledgerlake.plans.ingest_catalog import INGEST_QUERIES
from ledgerlake.plans.segmentation import segment_customers
from ledgerlake.session import scratch_path
from ledgerlake.sources import fixtures as fx
from ledgerlake.sources.partitioned import PartitionedTable
from ledgerlake.sources.raw import to_raw

from ledgerlake.plans.runs import RUN1, RUN2  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf_dir: str, table: str, builder=None) -> DataFrame:
    """RAW form (`v: VARIANT`) of a fixture entity."""
    return to_raw((builder or fx.ENTITIES[table])(spark, sf_dir))


def stg(spark: SparkSession, sf_dir: str, table: str, ctx: RunContext = RUN1, builder=None) -> DataFrame:
    return staging.STAGING[table](raw(spark, sf_dir, table, builder), ctx)


# ---- staging ----------------------------------------------------------------------------


def _stg_query(table: str) -> Query:
    return lambda spark, sf: stg(spark, sf, table)


def latest_version_per_key(spark: SparkSession, sf: str) -> DataFrame:
    li = fx.row_versions(spark, sf)
    return latest_by(
        li,
        ["l_orderkey"],
        [F.col("l_shipdate").desc_nulls_first()],
        [F.col("l_linenumber").asc(), F.col("l_partkey").asc(), F.col("l_suppkey").asc()],
    )


# ---- history and dimensions ------------------------------------------------------------


def _first_history(spark, sf, table, fn, ctx=RUN1):
    return fn(stg(spark, sf, table, ctx), None, ctx)


def dim_customers(spark, sf):
    return history.dim_customers(_first_history(spark, sf, "customers", history.customers_history))


def dim_accounts(spark, sf):
    return history.dim_accounts(_first_history(spark, sf, "accounts", history.accounts_history))


def dim_services(spark, sf):
    return history.dim_services(_first_history(spark, sf, "services", history.services_history))


def _no_version_id(h: DataFrame) -> DataFrame:
    return present_history(h).drop("load_timestamp", "load_ts")


def scd2_check_second(spark, sf):
    h1 = history.accounts_history(stg(spark, sf, "accounts", RUN1), None, RUN1)
    src2 = stg(spark, sf, "accounts", RUN2, fx.accounts_batch2)
    return _no_version_id(history.accounts_history(src2, h1, RUN2))


def scd2_timestamp_second(spark, sf):
    h1 = history.profiles_history(stg(spark, sf, "customer_profiles", RUN1), None)
    src2 = stg(spark, sf, "customer_profiles", RUN2, fx.customer_profiles_batch2)
    return _no_version_id(history.profiles_history(src2, h1))


def _second_history(spark, sf, table, fn, builder):
    h1 = fn(stg(spark, sf, table, RUN1), None, RUN1)
    return fn(stg(spark, sf, table, RUN2, builder), h1, RUN2)


def customers_second_run(spark, sf):
    return history.dim_customers(_second_history(spark, sf, "customers", history.customers_history, fx.customers_batch2))


def services_second_run(spark, sf):
    return history.dim_services(_second_history(spark, sf, "services", history.services_history, fx.services_batch2))


def segments_second_run(spark, sf):
    h = _second_history(spark, sf, "customer_segments", history.segments_history, fx.customer_segments_batch2)
    return _no_version_id(h)


def version_ids(spark, sf):
    """The id of every version of two runs; a version keeps its id when it is closed."""
    h = _second_history(spark, sf, "accounts", history.accounts_history, fx.accounts_batch2)
    return h.select("account_id", "valid_from", "valid_to", "version_id", "version_updated_at")


def segments_history_first(spark, sf):
    return _no_version_id(history.segments_history(stg(spark, sf, "customer_segments"), None))


def scd2_log(spark, sf):
    log = fx.row_versions(spark, sf).select(
        "l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity"
    )
    return scd2_from_log(
        log,
        "l_orderkey",
        ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"],
        ["l_returnflag", "l_linestatus", "l_quantity"],
    )


# ---- service usage ------------------------------------------------------------------------


def _dim_services_df(spark, sf, ctx=RUN1):
    return history.dim_services(history.services_history(stg(spark, sf, "services", ctx), None, ctx))


def fct_service_usage(spark, sf):
    return usage.fct_service_usage(stg(spark, sf, "service_usage"), _dim_services_df(spark, sf), None, RUN1)


def agg_service_frequency(spark, sf):
    return usage.agg_service_frequency(fct_service_usage(spark, sf))


def agg_service_usage_daily(spark, sf):
    return usage.agg_service_usage_daily(fct_service_usage(spark, sf))


def agg_customer_service_freq(spark, sf):
    return usage.agg_customer_service_freq(fct_service_usage(spark, sf))


def usage_after_service_change(spark, sf):
    """Services with closed versions; every usage gets the open one's attributes."""
    return usage.fct_service_usage(stg(spark, sf, "service_usage", RUN2), services_second_run(spark, sf), None, RUN2)


def usage_second_run(spark, sf):
    dim = _dim_services_df(spark, sf)
    t1 = usage.fct_service_usage(stg(spark, sf, "service_usage", RUN1, fx.service_usage_batch1), dim, None, RUN1)
    u2 = stg(spark, sf, "service_usage", RUN2, fx.service_usage_batch2)
    return usage.fct_service_usage(u2, dim, t1, RUN2)


# ---- customer features ------------------------------------------------------------------


def _tx(spark, sf, ctx=RUN1, builder=None):
    return stg(spark, sf, "transactions", ctx, builder)


def _acc(spark, sf, ctx=RUN1):
    return stg(spark, sf, "accounts", ctx)


def preferred_type(spark, sf):
    t = features.transactions_with_customer(_tx(spark, sf), _acc(spark, sf))
    return group_mode(t, ["customer_id"], "transaction_type", "preferred_transaction_type")


def int_customer_transactions(spark, sf):
    return features.int_customer_transactions(_tx(spark, sf), _acc(spark, sf))


def _known_profiles(spark, sf):
    """Staged profiles, but for every tenth customer's: the join has to deal with customers without one."""
    return stg(spark, sf, "customer_profiles").filter(F.col("customer_id").cast("bigint") % 10 != 0)


def int_customer_behavior(spark, sf):
    d13 = int_customer_transactions(spark, sf)
    return features.int_customer_behavior(d13, _known_profiles(spark, sf))


def int_customer_metrics(spark, sf):
    return features.int_customer_metrics(int_customer_behavior(spark, sf), None, RUN1)


def metrics_second_run(spark, sf):
    prof = _known_profiles(spark, sf)
    d14_1 = features.int_customer_behavior(
        features.int_customer_transactions(_tx(spark, sf, RUN1, fx.transactions_batch1), _acc(spark, sf)), prof
    )
    t1 = features.int_customer_metrics(d14_1, None, RUN1)
    return features.int_customer_metrics(int_customer_behavior(spark, sf), t1, RUN2)


def dim_customer_profile(spark, sf):
    return features.dim_customer_profile(int_customer_metrics(spark, sf), None)


def profile_dim_second_run(spark, sf):
    """Metrics stamped after the dimension's last ones are merged into it."""
    prof = _known_profiles(spark, sf)
    tx1 = features.int_customer_transactions(_tx(spark, sf, RUN1, fx.transactions_batch1), _acc(spark, sf))
    first = features.int_customer_metrics(features.int_customer_behavior(tx1, prof), None, RUN1)
    second = features.int_customer_metrics(int_customer_behavior(spark, sf), first, RUN2)
    return features.dim_customer_profile(second, features.dim_customer_profile(first, None))


def report_top_risk(spark, sf, n=10):
    return reports.report_top_risk(dim_customer_profile(spark, sf), n)


# ---- facts --------------------------------------------------------------------------------


def fact_transactions(spark, sf):
    return facts.fact_transactions(_tx(spark, sf), _acc(spark, sf), None, RUN1)


def transactions_second_run(spark, sf):
    t1 = facts.fact_transactions(_tx(spark, sf, RUN1, fx.transactions_batch1), _acc(spark, sf), None, RUN1)
    return facts.fact_transactions(_tx(spark, sf, RUN2), _acc(spark, sf, RUN2), t1, RUN2)


def fact_customer_activity(spark, sf):
    return facts.fact_customer_activity(_tx(spark, sf), _acc(spark, sf), None)


def _activity_two_runs(spark, sf, mode):
    t1 = facts.fact_customer_activity(_tx(spark, sf, RUN1, fx.transactions_batch1), _acc(spark, sf), None)
    return facts.fact_customer_activity(_tx(spark, sf, RUN2), _acc(spark, sf, RUN2), t1, mode)


def activity_second_run(spark, sf):
    return _activity_two_runs(spark, sf, "strict")


def activity_recompute_run(spark, sf):
    return _activity_two_runs(spark, sf, "recompute")


def activity_late_days(spark, sf):
    """A daily roll-up in partitions by month, brought up to date after late rows of three earlier days and new days came in."""
    table = PartitionedTable(spark, f"{scratch_path(spark, 'activity')}/by_month", "activity_month")
    facts.refresh_customer_activity(_tx(spark, sf, RUN1, fx.transactions_without_late_days), _acc(spark, sf), table, "first")
    out = facts.refresh_customer_activity(_tx(spark, sf, RUN2), _acc(spark, sf, RUN2), table, "second")
    return out.select("customer_id", "activity_date", "transactions_count", "total_amount", "avg_amount")


def report_recent_activity(spark, sf):
    return reports.report_recent_activity(fact_customer_activity(spark, sf), 20)


def fact_customer_segment(spark, sf):
    return facts.fact_customer_segment(stg(spark, sf, "customer_segments"), None).drop("load_ts")


def segment_second_run(spark, sf):
    s1 = stg(spark, sf, "customer_segments", RUN1, fx.customer_segments_batch1)
    t1 = facts.fact_customer_segment(s1, None)
    s2 = stg(spark, sf, "customer_segments", RUN2, fx.customer_segments_batch2)
    return facts.fact_customer_segment(s2, t1)


def report_segment_counts(spark, sf):
    return reports.report_segment_counts(fact_customer_segment(spark, sf))


def segment_rules(spark, sf):
    return segment_customers(fx.customer_profiles(spark, sf), fx.ts(fx.AS_OF))


def raw_typed_extract(spark, sf):
    """S13, P01, P02 through the generic `extract` operator: RAW profiles → typed columns."""
    from ledgerlake.operators.extract import extract

    spec = {
        "customer_id": ("customer_id", "id"),
        "total_transactions": ("total_transactions", "int"),
        "risk_number": ("risk_score", "number"),
        "risk_score": ("risk_score", "float"),
        "preferred_transaction_type": ("preferred_transaction_type", "string"),
        "last_active_date": ("last_active_date", "timestamp_ntz"),
    }
    return extract(raw(spark, sf, "customer_profiles"), spec)


def scd2_check_first(spark, sf):
    """U02 first run in its stored form: every source row opens a version at the run time."""
    h = history.accounts_history(stg(spark, sf, "accounts", RUN1), None, RUN1)
    return h.drop("version_id", "load_timestamp")


def report_top_services(spark, sf):
    return reports.report_top_services(agg_service_frequency(spark, sf), 10)


def quality_datasets(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The datasets the checks read, as of the first run."""
    return {
        "stg_services": stg(spark, sf, "services"),
        "stg_service_usage": stg(spark, sf, "service_usage"),
        "dim_services": _dim_services_df(spark, sf),
        "fct_service_usage": fct_service_usage(spark, sf),
        "agg_service_frequency": agg_service_frequency(spark, sf),
        "stg_customers": stg(spark, sf, "customers"),
        "stg_accounts": _acc(spark, sf),
        "stg_transactions": _tx(spark, sf),
        "dim_customers": dim_customers(spark, sf),
        "dim_accounts": dim_accounts(spark, sf),
        "fact_transactions": fact_transactions(spark, sf),
        "stg_customer_profiles": stg(spark, sf, "customer_profiles"),
        "stg_customer_segments": stg(spark, sf, "customer_segments"),
        "dim_customer_profile": dim_customer_profile(spark, sf),
        "fact_customer_segment": fact_customer_segment(spark, sf),
        "fact_customer_activity": fact_customer_activity(spark, sf),
    }


def quality_declared(spark, sf):
    from ledgerlake.plans.checks import declared_checks

    return declared_checks(quality_datasets(spark, sf))


def quality_ddl(spark, sf):
    from ledgerlake.plans.checks import ddl_checks

    return ddl_checks(quality_datasets(spark, sf))


def _build() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for t in staging.STAGING:
        q[f"stg_{t}"] = _stg_query(t)
    q.update(
        {
            "latest_version_per_key": latest_version_per_key,
            "fct_service_usage": fct_service_usage,
            "agg_service_frequency": agg_service_frequency,
            "agg_service_usage_daily": agg_service_usage_daily,
            "agg_customer_service_freq": agg_customer_service_freq,
            "usage_second_run": usage_second_run,
            "preferred_type": preferred_type,
            "int_customer_transactions": int_customer_transactions,
            "int_customer_behavior": int_customer_behavior,
            "int_customer_metrics": int_customer_metrics,
            "metrics_second_run": metrics_second_run,
            "dim_customer_profile": dim_customer_profile,
            "fact_transactions": fact_transactions,
            "transactions_second_run": transactions_second_run,
            "fact_customer_activity": fact_customer_activity,
            "activity_second_run": activity_second_run,
            "activity_recompute_run": activity_recompute_run,
            "activity_late_days": activity_late_days,
            "customers_second_run": customers_second_run,
            "services_second_run": services_second_run,
            "segments_second_run": segments_second_run,
            "version_ids": version_ids,
            "usage_after_service_change": usage_after_service_change,
            "profile_dim_second_run": profile_dim_second_run,
            "fact_customer_segment": fact_customer_segment,
            "segment_second_run": segment_second_run,
            "dim_customers": dim_customers,
            "dim_accounts": dim_accounts,
            "dim_services": dim_services,
            "scd2_check_second": scd2_check_second,
            "scd2_timestamp_second": scd2_timestamp_second,
            "segments_history": segments_history_first,
            "scd2_log": scd2_log,
            "segment_rules": segment_rules,
            "report_top_services": report_top_services,
            "report_recent_activity": report_recent_activity,
            "report_segment_counts": report_segment_counts,
            "report_top_risk": partial(report_top_risk, n=10),
            "report_top_risk_5": partial(report_top_risk, n=5),
            "raw_typed_extract": raw_typed_extract,
            "scd2_check_first": scd2_check_first,
            "quality_declared": quality_declared,
            "quality_ddl": quality_ddl,
        }
    )
    return q


QUERIES: dict[str, Query] = _build()
QUERIES.update(INGEST_QUERIES)
