"""Parquet sinks. Each replaces its directory."""

from __future__ import annotations

from pyspark.sql import DataFrame

SNAPSHOT_ROW_GROUP_BYTES = 256 * 1024 * 1024


def write_table(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """A table of any size: written by as many tasks as produce it, no shuffle."""
    writer = df.write.mode("overwrite")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(path)


def write_mart(mart: DataFrame, path: str) -> None:
    """A sorted mart: one file while it is small.

    The runtime re-plan merges the sort's partitions by their measured size, so a small mart comes
    from one task. A mart that dirty keys have made large stays split instead of passing through a
    single task, its files in key order.
    """
    mart.write.mode("overwrite").parquet(path)


def write_snapshot(
    df: DataFrame, path: str, row_group_bytes: int = SNAPSHOT_ROW_GROUP_BYTES
) -> None:
    """Export of a keyed table: Snappy Parquet with large row groups."""
    df.write.mode("overwrite").options(
        **{"compression": "snappy", "parquet.block.size": row_group_bytes}
    ).parquet(path)
