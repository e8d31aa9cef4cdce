"""DataFrame operators: each takes DataFrames (and columns) and returns a DataFrame."""

from ledgerlake.operators.aggregates import (
    avg_zero,
    count_where,
    daily_rollup,
    group_mode,
    rollup_first_last,
    sum_where,
    sum_zero,
)
from ledgerlake.operators.dedup import latest_by, total_order
from ledgerlake.operators.extract import extract, field, rename, stamp
from ledgerlake.operators.history import (
    current,
    present_history,
    scd2_check,
    scd2_from_log,
    scd2_timestamp,
)
from ledgerlake.operators.joins import (
    attach_customer,
    current_rows,
    enrich_current,
    orphans,
)
from ledgerlake.operators.merge import (
    DuplicateKeyError,
    above_watermark,
    append,
    assert_unique,
    upsert,
    watermark,
)
from ledgerlake.operators.quality import Expectation, QualityError, check_datasets, require, run_checks, violations
from ledgerlake.operators.ranking import global_rank, share_of_total

__all__ = [
    "DuplicateKeyError",
    "Expectation",
    "above_watermark",
    "append",
    "assert_unique",
    "attach_customer",
    "avg_zero",
    "count_where",
    "current",
    "current_rows",
    "daily_rollup",
    "enrich_current",
    "extract",
    "field",
    "global_rank",
    "group_mode",
    "latest_by",
    "orphans",
    "present_history",
    "rename",
    "rollup_first_last",
    "QualityError",
    "check_datasets",
    "require",
    "run_checks",
    "scd2_check",
    "scd2_from_log",
    "scd2_timestamp",
    "share_of_total",
    "stamp",
    "sum_where",
    "sum_zero",
    "total_order",
    "upsert",
    "violations",
    "watermark",
]
