"""Volume of published messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTES_PER_MB = 1024 * 1024


def sent_mb(value: Column) -> Column:
    """Aggregate: UTF-8 size of all values in MB, two digits; 0.0 for no rows."""
    return F.coalesce(F.round(F.sum(F.octet_length(value)) / BYTES_PER_MB, 2), F.lit(0.0))


def payload_volume(messages: DataFrame) -> DataFrame:
    """Messages and megabytes per topic."""
    return messages.groupBy("topic").agg(
        F.count("*").alias("messages"), sent_mb(F.col("value")).alias("sent_mb")
    )
