"""Plan inspection: the checks the test-suite applies to every report.

They read the physical plan Spark would run (the AQE initial plan) as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF")


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def python_nodes(df: DataFrame) -> list[str]:
    """Python-evaluated operators in the plan (the slow path; expected empty)."""
    plan = physical_plan(df)
    return [n for n in PYTHON_NODES if n in plan]


def unaggregated_single_partition(df: DataFrame) -> list[str]:
    """``Exchange SinglePartition`` nodes not fed by a partial aggregate.

    Moving one partial-aggregate row per task to one partition is fine (a
    global aggregate); moving raw rows there serialises the job.
    """
    lines = physical_plan(df).splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            if "HashAggregate" not in child or "partial_" not in child:
                bad.append(line.strip())
    return bad


def scans(df: DataFrame) -> list[str]:
    """FileScan lines (with their pushed filters and read schemas)."""
    return [ln.strip() for ln in physical_plan(df).splitlines() if "FileScan" in ln]
