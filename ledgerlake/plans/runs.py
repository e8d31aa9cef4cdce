"""Fixed run times of the registered queries (first and second incremental run)."""

from ledgerlake.context import RunContext

RUN1 = RunContext("2024-03-01 00:00:00")
RUN2 = RunContext("2024-03-02 00:00:00")
