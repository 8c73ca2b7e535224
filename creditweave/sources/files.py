"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditweave.schemas import MESSAGE_DDL
from creditweave.sources.headers import data_files, files_by_header, read_by_header

SOURCE_FORMATS = ("csv", "parquet")


def read_source(
    spark: SparkSession,
    path: str,
    source_format: str = "csv",
    schema: T.StructType | str | None = None,
    same_header: bool = False,
) -> DataFrame:
    """Applications from a file or a directory of files.

    CSV: header row, ``"`` escaped by doubling it, one record per line so that large files split;
    every column is text. The files of a directory may have different headers: columns are matched by
    name, and one that a file lacks is NULL there. To find out, the first line of every file is read when
    the frame is made. ``same_header`` leaves that out for a directory of very many files: all must then
    have the header of one of them, or that of the schema, and another one raises when it is read.
    Parquet brings its own types.
    """
    if source_format not in SOURCE_FORMATS:
        raise ValueError(f"unknown format {source_format!r}; expected one of {', '.join(SOURCE_FORMATS)}")
    options = {"header": True, "multiLine": False, "escape": '"', "enforceSchema": False} if source_format == "csv" else {}
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if source_format == "csv" and not same_header:
        groups = files_by_header(spark, data_files(spark, path))
        wanted = None if schema is None else tuple(name.casefold() for name in schema.names)
        if len(groups) > 1 or any(wanted not in (None, tuple(n.casefold() for n in header)) for header in groups):
            return read_by_header(spark, groups, options, schema)
    reader = spark.read.format(source_format).options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Archived messages (Parquet) as a batch frame."""
    return spark.read.schema(MESSAGE_DDL).parquet(path)


def stream_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Archived messages (Parquet) as a stream, with the columns of a topic."""
    reader = spark.readStream.schema(MESSAGE_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
