"""Text of a frame's plans."""

from __future__ import annotations

from pyspark.sql import DataFrame


def optimized(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
