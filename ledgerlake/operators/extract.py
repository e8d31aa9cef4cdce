"""Typed extraction from the semi-structured RAW form (`v: VARIANT`), renames and stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.context import RunContext
from ledgerlake.functions.columns import canonical_id, safe_number

# Target types accepted by `extract`; `id` is canonical key text (H7), `number` a safe cast.
_VARIANT_TYPES = {
    "string": "string",
    "int": "bigint",
    "bigint": "bigint",
    "float": "double",
    "double": "double",
    "boolean": "boolean",
    "timestamp": "timestamp_ntz",
    "timestamp_ntz": "timestamp_ntz",
    "date": "date",
}


def field(v: str | Column, path: str, kind: str, scale: int = 0) -> Column:
    """`v:path::kind`. Strict: a value that cannot be cast raises, JSON null/missing → NULL."""
    vc = F.col(v) if isinstance(v, str) else v
    jpath = path if path.startswith("$") else f"$.{path}"
    if kind == "id":
        return canonical_id(vc, jpath)
    if kind == "number":
        return safe_number(F.variant_get(vc, jpath, "string"), scale)
    return F.variant_get(vc, jpath, _VARIANT_TYPES[kind])


def extract(df: DataFrame, spec: dict[str, tuple[str, str]], v: str = "v", keep: tuple[str, ...] = ()) -> DataFrame:
    """Project typed columns out of a VARIANT column.

    `spec` maps output name → (field path, kind); kinds are the keys of `_VARIANT_TYPES`
    plus `id` and `number`. Columns in `keep` (e.g. lineage) are carried along.
    """
    cols = [field(v, path, kind).alias(name) for name, (path, kind) in spec.items()]
    return df.select(*cols, *[F.col(k) for k in keep if k in df.columns])


def compute_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add expensive columns (e.g. a JSON parse) that are evaluated once per row.

    A plain projection of such a column is re-inlined by the optimizer into every filter
    pushed below it and every expression that reads it, so one parse can turn into ten. The
    one-row `inline(array(struct(...)))` generator is a boundary Catalyst neither inlines
    across nor pushes filters through; downstream expressions read an attribute.
    """
    packed = F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))
    return df.select("*", F.inline(packed))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def stamp(df: DataFrame, name: str, ctx: RunContext) -> DataFrame:
    """Add the run's processing time as column `name`."""
    return df.withColumn(name, ctx.ts())
