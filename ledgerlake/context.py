"""Run context: the processing time every run-time column is stamped with.

The reference stamps `current_timestamp` at read time; a fixed `run_ts` per run makes
results reproducible and lets an oracle compare them.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def _now_utc() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


@dataclass(frozen=True)
class RunContext:
    """`run_ts` is wall-clock UTC text `YYYY-MM-DD HH:MM:SS[.ffffff]`."""

    run_ts: str = field(default_factory=_now_utc)

    def ts(self) -> Column:
        """The run time as a TIMESTAMP_NTZ literal (no session-zone shift)."""
        return F.lit(self.run_ts).cast("timestamp_ntz")

    def date(self) -> Column:
        return self.ts().cast("date")

    def epoch_millis(self) -> Column:
        """The run time as epoch milliseconds (run_ts is UTC wall-clock)."""
        text = self.run_ts if "." in self.run_ts else self.run_ts + ".000000"
        t = _dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S.%f").replace(tzinfo=_dt.timezone.utc)
        return F.lit(int(t.timestamp() * 1000)).cast("bigint")
