"""Scalar column functions shared by the operators and datasets."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_number(c: ColumnOrName, scale: int = 0) -> Column:
    """Text → DECIMAL(38, scale); NULL for text that is not a number.

    Rounds half away from zero at `scale` (12.5 → 13, -12.5 → -13), as the warehouse's
    safe number conversion does with its default scale 0 (H4). Accepts exponent text ('1e3').
    """
    return _c(c).cast("string").try_cast(f"decimal(38,{int(scale)})")


def round_half_up(c: ColumnOrName, scale: int = 2) -> Column:
    """Round a numeric value half away from zero on its decimal value, returned as DOUBLE.

    Rounding goes through DECIMAL(38,10) so the result does not depend on how a double's
    binary fraction prints (1.005 → 1.01).
    """
    return F.round(_c(c).cast("decimal(38,10)"), scale).cast("double")


def greatest_strict(*cols: ColumnOrName) -> Column:
    """`greatest` that is NULL when any input is NULL (Spark's skips NULLs)."""
    cs = [_c(c) for c in cols]
    any_null = F.lit(False)
    for c in cs:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def least_strict(*cols: ColumnOrName) -> Column:
    """`least` that is NULL when any input is NULL (Spark's skips NULLs)."""
    cs = [_c(c) for c in cols]
    any_null = F.lit(False)
    for c in cs:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def risk_score(risk: ColumnOrName, transfer: ColumnOrName, avg: ColumnOrName) -> Column:
    """clamp(round(risk + transfer/1000 + avg/10, 2), 0, 100), NULL inputs count as 0."""
    raw = (
        F.coalesce(_c(risk).cast("double"), F.lit(0.0))
        + F.coalesce(_c(transfer).cast("double"), F.lit(0.0)) / 1000
        + F.coalesce(_c(avg).cast("double"), F.lit(0.0)) / 10
    )
    return greatest_strict(F.lit(0.0), least_strict(F.lit(100.0), round_half_up(raw, 2)))


def first_known(*cols: ColumnOrName) -> Column:
    """First non-NULL of several sources (profile value, derived value, default)."""
    return F.coalesce(*[_c(c) for c in cols])


def event_date(ts: ColumnOrName) -> Column:
    """Calendar date of a wall-clock (NTZ) timestamp; no zone shift."""
    return F.to_date(_c(ts))


def whole_days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole 24-hour periods from start to end (30 d 23 h 59 m → 30)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def canonical_id(v: ColumnOrName, path: str) -> Column:
    """Key text of a VARIANT field (H7): integral numbers without a fraction (a double 12.0
    and a JSON 12 both give '12', a double 1.2E7 gives '12000000'), NaN → NULL. Text stays as
    it is: '007.0' is no number."""
    text = F.variant_get(_c(v), path, "string")
    is_text = F.schema_of_variant(F.variant_get(_c(v), path, "variant")) == "STRING"
    scientific = F.try_variant_get(_c(v), path, "bigint").cast("string")
    plain = F.regexp_replace(text, r"^(-?[0-9]+)\.0+$", "$1")
    number = F.when(text.rlike(r"^-?[0-9.]+E[0-9]+$"), scientific).otherwise(F.nullif(plain, F.lit("NaN")))
    # most keys are digits: only others are looked at closely
    odd = text.contains(".") | text.contains("E") | (text == "NaN")
    return F.when(odd, F.when(is_text, F.nullif(text, F.lit("NaN"))).otherwise(number)).otherwise(text)


def table_of_topic(topic: ColumnOrName) -> Column:
    """`prefix.schema.table` → `table` (last dot segment)."""
    return F.element_at(F.split(_c(topic), r"\."), -1)


def topic_name(prefix: str, schema: str, table: ColumnOrName) -> Column:
    return F.concat_ws(".", F.lit(prefix), F.lit(schema), _c(table))


# Event-type words and their change codes.
OP_CODES = {"INSERT": "c", "UPDATE": "u", "DELETE": "d"}
OP_OTHER = "r"


def op_code(event_type: ColumnOrName) -> Column:
    """INSERT/UPDATE/DELETE (any case) → c/u/d, anything else (NULL too) → r."""
    up = F.upper(_c(event_type).cast("string"))
    expr = F.when(up == "INSERT", "c").when(up == "UPDATE", "u").when(up == "DELETE", "d")
    return expr.otherwise(OP_OTHER)


@dataclass(frozen=True)
class Rule:
    """One rule of a first-match cascade: when `condition`, assign `label` and `score`."""

    condition: Column
    label: str
    score: ColumnOrName | float


def rule_cascade(rules: list[Rule], default_label: str, default_score: float) -> tuple[Column, Column]:
    """First matching rule wins; returns (label column, score column)."""
    label: Column | None = None
    score: Column | None = None
    for r in rules:
        s = _c(r.score) if isinstance(r.score, (str, Column)) else F.lit(float(r.score))
        if label is None:
            label = F.when(r.condition, F.lit(r.label))
            score = F.when(r.condition, s.cast("double"))
        else:
            label = label.when(r.condition, F.lit(r.label))
            score = score.when(r.condition, s.cast("double"))
    if label is None:
        return F.lit(default_label), F.lit(float(default_score))
    return label.otherwise(F.lit(default_label)), score.otherwise(F.lit(float(default_score)))
