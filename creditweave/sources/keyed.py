"""Snapshot of the keyed call table, from exported files or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditweave.functions.casts import bigint_from_text, boolean_from_text, iso_timestamp, timestamp_from_text
from creditweave.schemas import TRANSACTION_COLUMNS, TRANSACTIONS_DDL
from creditweave.sources.files import read_source


def read_snapshot(spark: SparkSession, path: str, source_format: str = "parquet") -> DataFrame:
    """An exported table with its declared columns and types.

    CSV text is typed leniently: times in the plain or any ISO form, whole numbers in any spelling.
    """
    if source_format == "parquet":
        return read_source(spark, path, "parquet", TRANSACTIONS_DDL)
    text = read_source(spark, path, source_format)
    typed = {
        "call_time": F.coalesce(timestamp_from_text(text["call_time"]), iso_timestamp(text["call_time"])),
        "duration_sec": bigint_from_text(text["duration_sec"]),
        "follow_up_required": boolean_from_text(text["follow_up_required"]),
    }
    return text.withColumns(typed).select(*TRANSACTION_COLUMNS)


def jdbc_snapshot_options(
    url: str, table: str, lower: str, upper: str, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """JDBC options that split the table into ranges of ``call_time``.

    ``lower`` and ``upper`` only place the cuts; rows outside them are read by the first and last
    range. Without a split the whole table would come through one task.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": "call_time",
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }


def read_snapshot_jdbc(spark: SparkSession, **options: object) -> DataFrame:
    """The table over JDBC; needs the database's driver on the class path."""
    return spark.read.format("jdbc").options(**jdbc_snapshot_options(**options)).load().select(
        *TRANSACTION_COLUMNS
    )
