"""RAW landing form: one VARIANT column `v` per row (schema-on-read)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import LINEAGE_COLUMNS


def to_raw(df: DataFrame, exclude: Sequence[str] = ("date", "table"), lineage: Sequence[str] = LINEAGE_COLUMNS) -> DataFrame:
    """Wrap the entity columns into `v: VARIANT`; partition columns never leak into `v` (H6).

    Lineage columns (`_op`, `_ts_ms`, `_offset`) stay beside `v` for tie-breaking (H2).
    """
    keep = [c for c in lineage if c in df.columns]
    body = [c for c in df.columns if c not in set(exclude) | set(keep)]
    if "v" in df.columns and len(body) == 1:
        return df.select("v", *keep)
    return df.select(F.to_variant_object(F.struct(*[F.col(c) for c in body])).alias("v"), *keep)
