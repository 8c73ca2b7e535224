"""The four analytical marts over clean applications.

Each is one scan of the columns it needs, a partial aggregation before the shuffle and a final one
after it, so a key that holds a large share of the rows reaches the shuffle as one row per task.
The exact distinct count is planned by Spark as a de-duplication on (keys, customer) first, which
spreads a hot (region, status) pair over all tasks. The closing sort is over the few result rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mean(column: str) -> Column:
    return F.round(F.avg(column), 2)


def applications_by_region_status(clean: DataFrame) -> DataFrame:
    keys = ("region_code", "decision_status")
    return (
        clean.groupBy(*keys)
        .agg(
            F.count("*").alias("application_count"),
            F.count_distinct("customer_id").alias("customer_count"),
            _mean("requested_amount").alias("avg_requested_amount"),
        )
        .orderBy(*keys)
    )


def risk_level_metrics(clean: DataFrame) -> DataFrame:
    averaged = ("credit_score", "requested_amount", "approved_amount")
    return (
        clean.groupBy("risk_level")
        .agg(
            F.count("*").alias("application_count"),
            *[_mean(name).alias(f"avg_{name}") for name in averaged],
        )
        .orderBy("risk_level")
    )


def manual_review_by_channel(clean: DataFrame) -> DataFrame:
    """An unknown flag counts as not reviewed, but is left out of the percentage's denominator."""
    flag = F.col("employee_review_flag")
    return (
        clean.groupBy("channel")
        .agg(
            F.count("*").alias("application_count"),
            F.count_if(flag).alias("manual_review_count"),
            F.round(F.avg(flag.cast("int")) * 100, 2).alias("manual_review_pct"),
        )
        .orderBy("channel")
    )


def daily_processing_metrics(clean: DataFrame) -> DataFrame:
    averaged = ("processing_time_sec", "credit_score")
    return (
        clean.withColumn("event_date", F.to_date("event_time"))
        .groupBy("event_date")
        .agg(
            F.count("*").alias("application_count"),
            *[_mean(name).alias(f"avg_{name}") for name in averaged],
        )
        .orderBy("event_date")
    )


# Mart name, which is also its output directory, to the function that builds it.
MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "applications_by_region_status": applications_by_region_status,
    "risk_level_metrics": risk_level_metrics,
    "manual_review_by_channel": manual_review_by_channel,
    "daily_processing_metrics": daily_processing_metrics,
}
