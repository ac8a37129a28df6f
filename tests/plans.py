"""Shapes that must not occur in a plan."""

import re

from pyspark.sql import DataFrame, DataFrameWriter

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"]

# One-partition windows whose size is bounded: partition counts (MAX_PARTITIONS) and counted tables (MAX_WINDOW_ROWS).
BOUNDED = re.compile(r"\[_(part|value)#\d+L? ASC NULLS FIRST\]")


def physical(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def problems(plan: str) -> list[str]:
    found = [name for name in FORBIDDEN if name in plan]
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(r"[+: -]Window \[", line) and not BOUNDED.search(line) and any(
            "Exchange SinglePartition" in below for below in lines[i + 1 : i + 4]
        ):
            found.append("window over one partition")
    return found


def record_writes(monkeypatch) -> list[str]:
    """The plans of all tables written from now on."""
    plans: list[str] = []

    def recorded(method):
        original = getattr(DataFrameWriter, method)

        def write(self, *args, **kwargs):
            plans.append(physical(self._df))
            return original(self, *args, **kwargs)

        return write

    for method in ("parquet", "json", "text", "csv"):
        monkeypatch.setattr(DataFrameWriter, method, recorded(method))
    return plans
