"""Latest row per key: `row_number() over (partition by keys order by ...) = 1`.

Spark plans this as a partial WindowGroupLimit before the shuffle and a final one after,
so a hot key is cut to one row per map task before it is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    tiebreak: Sequence[Column] = (),
    rn: str = "_rn",
) -> DataFrame:
    """Keep the first row per `keys` under `order` + `tiebreak`.

    `order` carries the null placement explicitly (e.g. `col.desc_nulls_first()` for the
    warehouse default on DESC, `desc_nulls_last()` where a model says NULLS LAST). Give a
    `tiebreak` that makes the order total, otherwise the pick among ties is arbitrary (H2).
    """
    w = Window.partitionBy(*keys).orderBy(*order, *tiebreak)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)


def total_order(df: DataFrame, exclude: Sequence[str] = ()) -> list[Column]:
    """Ascending NULLS FIRST on every remaining orderable column: a last-resort tie-break."""
    from pyspark.sql.types import MapType, VariantType

    return [
        F.col(f.name).asc_nulls_first()
        for f in df.schema.fields
        if f.name not in exclude and not isinstance(f.dataType, (MapType, VariantType))
    ]
