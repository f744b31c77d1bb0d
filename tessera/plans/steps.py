"""Config-driven step lists: ``[{'type': 'aggregate', ...}, {'type': 'sort', ...}, ...]``.

Each step maps to one operator, folded over the list into one lazy plan.
Supported: aggregate, sort, filter, calculate (the reference ignores the
last one; the report configs declare it, so it is run here). Unknown step
types raise instead of being skipped silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import transform as tr


def apply_step(df: DataFrame, step: dict, order_by=None) -> DataFrame:
    kind = step.get("type")
    if kind == "aggregate":
        return tr.aggregate(df, step.get("groupby", []), step.get("metrics", {}), order_by=order_by)
    if kind == "sort":
        return tr.sort(df, step.get("by"), step.get("ascending", True))
    if kind == "filter":
        return tr.filter_rows(df, step["column"], step.get("condition", "eq"), step.get("value"))
    if kind == "calculate":
        return tr.calculate_column(df, step["name"], step["expression"])
    raise ValueError(f"unknown transformation step type: {kind!r}")


def apply_transformations(df: DataFrame, steps: list[dict], order_by=None) -> DataFrame:
    for step in steps:
        df = apply_step(df, step, order_by=order_by)
    return df
