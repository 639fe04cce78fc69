"""Physical-plan checks used by tests and by anyone reviewing a query."""

from __future__ import annotations

from pyspark.sql import DataFrame

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython")
NESTED_LOOP_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def executed_plan(df: DataFrame) -> str:
    """The physical plan as text (AQE's initial plan before execution)."""
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(df: DataFrame) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def has_any(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    plan = executed_plan(df)
    return [n for n in names if n in plan]


def scan_details(df: DataFrame) -> list[str]:
    """``PushedFilters`` and ``ReadSchema`` lines of every file scan."""
    return [line.strip() for line in formatted_plan(df).splitlines()
            if line.strip().startswith(("PushedFilters", "ReadSchema"))]
