"""Incremental targets: high-water marks and keyed upserts on immutable files.

Nothing is mutated in place: an upsert returns the new full contents (target rows whose key
is not in the batch, plus the batch) and the caller publishes it as a new version (H19).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def watermark(target: DataFrame | None, col: str, floor: Any) -> Any:
    """max(col) of the target, or `floor` when the target is missing or empty (one-row job)."""
    if target is None:
        return floor
    value = target.agg(F.max(F.col(col)).alias("m")).first()["m"]
    return floor if value is None else value


def above_watermark(
    df: DataFrame,
    target: DataFrame | None,
    col: str,
    target_col: str | None = None,
    floor: Any = None,
    inclusive: bool = False,
    mark: Any = None,
) -> DataFrame:
    """Rows with `col` strictly above the target's max (`>=` when `inclusive`).

    First run (`target is None`) passes everything. The mark is evaluated first and applied
    as a typed literal, so it reaches the scan as a pushed filter / partition prune. A known
    `mark` (e.g. kept next to an append-only target) skips the scan of the target.
    """
    if target is None:
        return df
    if mark is None:
        mark = watermark(target, target_col or col, floor)
    if mark is None:
        return df
    dtype = df.schema[col].dataType.simpleString()
    lit = F.lit(str(mark)).cast(dtype)
    return df.filter(F.col(col) >= lit) if inclusive else df.filter(F.col(col) > lit)


def assert_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a non-NULL key occurs twice in the batch (the merge would be ambiguous)."""
    all_set = F.lit(True)
    for k in keys:
        all_set = all_set & F.col(k).isNotNull()
    dup = (
        batch.filter(all_set)
        .groupBy(*keys)
        .count()
        .filter(F.col("count") > 1)
        .limit(1)
        .collect()
    )
    if dup:
        raise DuplicateKeyError(f"duplicate merge keys {list(keys)}: {dup[0].asDict()}")


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    check_duplicates: bool = False,
) -> DataFrame:
    """MERGE semantics: matched → replaced by the batch row, unmatched → inserted, rest kept.

    Keys are AND-ed; a NULL key never matches, so such batch rows are inserted and such
    target rows are kept.
    """
    keys = list(keys)
    if check_duplicates:
        assert_unique(batch, keys)
    if target is None:
        return batch
    batch = batch.select(*target.columns)
    kept = _unmatched(target, batch, keys)
    return kept.unionByName(batch)


def _unmatched(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in the batch (anti join).

    Target rows with a NULL key part can never match; they carry a (flag, salt) pair in the
    join key that spreads them over the shuffle instead of hashing them all to one reducer.
    Batch keys with a NULL part are left out of the probe side for the same reason.
    """
    from ledgerlake.operators.joins import null_spread

    any_null = F.lit(False)
    all_set = F.lit(True)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
        all_set = all_set & F.col(k).isNotNull()
    t = null_spread(target, any_null, "_t")
    b = batch.filter(all_set).select(
        F.lit(False).alias("_b_null"), F.lit(0).cast("bigint").alias("_b_salt"), *[F.col(k).alias(f"_bk{i}") for i, k in enumerate(keys)]
    )
    cond = (t["_t_null"] == b["_b_null"]) & (t["_t_salt"] == b["_b_salt"])
    for i, k in enumerate(keys):
        cond = cond & (t[k] == b[f"_bk{i}"])
    return t.join(b, cond, "left_anti").drop("_t_null", "_t_salt")


def append(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    """Upsert that provably cannot match (the batch's keys are above the target's mark)."""
    return batch if target is None else target.unionByName(batch.select(*target.columns))
