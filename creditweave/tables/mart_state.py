"""The marts kept as partial rows by day, to which deliveries are added without reading the old ones."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditweave.operators.partials import DAY, PARTIALS, mart_of, merged_rows, partial_rows, with_numbers
from creditweave.tables.numbers import number_values
from creditweave.tables.versions import VersionLog


def _partials(spark: SparkSession, log: VersionLog, record: dict[str, Any], mart: str) -> DataFrame:
    return spark.read.parquet(*[f"{log.folder.path}/parts/{run}/{mart}" for run in record["runs"]])


def add_delivery(clean: DataFrame, root: str, delivery: str) -> int:
    """Adds the clean applications of a delivery to the state at ``root``; returns its version.

    A delivery is added once: a name that the state holds already changes nothing. ``clean`` is read
    once for the customers' numbers and once for each mart, only the columns that these need, so it should be
    a stored table. The version's record is written last; a run that stops before leaves no trace in the
    marts (at most numbers that no row uses yet).
    """
    spark, run = clean.sparkSession, uuid.uuid4().hex
    log = VersionLog(spark, root)
    version = log.latest()
    record = log.record(version) if version else {"runs": [], "deliveries": []}
    if delivery in record["deliveries"]:
        return version
    numbered = with_numbers(clean, number_values(clean.select("customer_id"), f"{log.folder.path}/customers"))
    try:
        for mart, spec in PARTIALS.items():
            partial_rows(numbered if spec.distinct else clean, mart).write.parquet(f"{log.folder.path}/parts/{run}/{mart}")
        log.commit(version + 1, {"runs": [*record["runs"], run], "deliveries": [*record["deliveries"], delivery]})
    except BaseException:
        log.folder.delete(f"parts/{run}")
        raise
    return version + 1


def compact(spark: SparkSession, root: str) -> int:
    """Merges the parts of all deliveries into one and returns the new version; old versions stay readable."""
    log, run = VersionLog(spark, root), uuid.uuid4().hex
    version = log.latest()
    record = log.record(version)
    try:
        for mart in PARTIALS:
            merged_rows(_partials(spark, log, record, mart), mart).write.parquet(f"{log.folder.path}/parts/{run}/{mart}")
        log.commit(version + 1, record | {"runs": [run]})
    except BaseException:
        log.folder.delete(f"parts/{run}")
        raise
    return version + 1


def read_mart(spark: SparkSession, root: str, mart: str, first_day: str | None = None, last_day: str | None = None, version: int | None = None) -> DataFrame:
    """A mart over all deliveries, or over the days from ``first_day`` to ``last_day`` (ISO dates, both included)."""
    log = VersionLog(spark, root)
    rows = _partials(spark, log, log.record(version), mart)
    for bound, holds in ((first_day, F.col(DAY) >= F.lit(first_day).cast("date")), (last_day, F.col(DAY) <= F.lit(last_day).cast("date"))):
        rows = rows.filter(holds) if bound else rows
    return mart_of(rows, mart)
