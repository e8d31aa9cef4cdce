"""Rule-based customer segmentation (first matching rule wins).

Fixed values (names, scores and thresholds must equal the reference's), in rule order:
  1. risk_score > 80                                        → "Risky User", score = risk_score
  2. whole days since last activity > 30                    → "Dormant User", 90
  3. total_transactions > 200 and total_transfer > 30000    → "VIP", 95
  4. login_frequency > 20                                   → "Active User", 85
  5. preferred type = TRANSFER and total_transfer > 10000   → "Transfer Heavy User", 75
  otherwise                                                 → "Standard User", 50
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import Rule, rule_cascade, whole_days_between

RISKY, DORMANT, VIP, ACTIVE, TRANSFER_HEAVY, STANDARD = (
    "Risky User",
    "Dormant User",
    "VIP",
    "Active User",
    "Transfer Heavy User",
    "Standard User",
)
STANDARD_SCORE = 50.0


def segment_rules(as_of: Column) -> list[Rule]:
    days_inactive = whole_days_between(F.col("last_active_date"), as_of)
    return [
        Rule(F.col("risk_score") > 80, RISKY, "risk_score"),
        Rule(days_inactive > 30, DORMANT, 90.0),
        Rule((F.col("total_transactions") > 200) & (F.col("total_transfer_amount") > 30000), VIP, 95.0),
        Rule(F.col("login_frequency") > 20, ACTIVE, 85.0),
        Rule(
            (F.col("preferred_transaction_type") == "TRANSFER") & (F.col("total_transfer_amount") > 10000),
            TRANSFER_HEAVY,
            75.0,
        ),
    ]


def segment_customers(profiles: DataFrame, as_of: Column, assigned_at: str | Column = "updated_at") -> DataFrame:
    """profiles → (customer_id, segment_name, segment_score, assigned_at)."""
    label, score = rule_cascade(segment_rules(as_of), STANDARD, STANDARD_SCORE)
    at = F.col(assigned_at) if isinstance(assigned_at, str) else assigned_at
    return profiles.select(
        "customer_id",
        label.alias("segment_name"),
        score.alias("segment_score"),
        at.cast("timestamp_ntz").alias("assigned_at"),
    )
