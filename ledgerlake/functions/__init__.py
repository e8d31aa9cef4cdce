"""Column-level functions (JVM-side expressions; no Python UDFs)."""

from ledgerlake.functions.columns import (
    Rule,
    canonical_id,
    event_date,
    first_known,
    greatest_strict,
    least_strict,
    op_code,
    risk_score,
    round_half_up,
    rule_cascade,
    safe_number,
    table_of_topic,
    topic_name,
    whole_days_between,
)

__all__ = [
    "Rule",
    "canonical_id",
    "event_date",
    "first_known",
    "greatest_strict",
    "least_strict",
    "op_code",
    "risk_score",
    "round_half_up",
    "rule_cascade",
    "safe_number",
    "table_of_topic",
    "topic_name",
    "whole_days_between",
]
