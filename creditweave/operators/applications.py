"""Cleaning of raw loan applications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditweave.functions.casts import boolean_from_text, int_from_text, timestamp_from_text
from creditweave.schemas import APPLICATION_COLUMNS, CLEAN_APPLICATIONS

# Bounds of an acceptable credit score, both included.
MIN_SCORE, MAX_SCORE = 300, 900

_FROM_TEXT = {
    T.IntegerType(): int_from_text,
    T.BooleanType(): boolean_from_text,
    T.TimestampType(): timestamp_from_text,
}
# Columns whose typed value decides whether a row is kept.
_DECIDING = ("event_time", "requested_amount", "credit_score")


def _typed(schema: T.StructType, name: str) -> Column:
    target = CLEAN_APPLICATIONS[name].dataType
    source = schema[name].dataType
    if source == target:
        return F.col(name)
    if isinstance(source, T.StringType) and target in _FROM_TEXT:
        return _FROM_TEXT[target](F.col(name)).alias(name)
    return F.col(name).try_cast(target).alias(name)


def clean_applications(raw: DataFrame) -> DataFrame:
    """Type the 14 columns and keep rows with an id, a time, a positive amount and a valid score.

    Works on text columns (CSV) and on columns that are typed already (Parquet). One narrow stage.
    The deciding columns are parsed once inside ``inline``: a plain filter above the projection
    would be pushed below it and parse them a second time for every row.
    """
    schema = raw.schema
    parsed = raw.filter(F.col("application_id").isNotNull()).select(
        *[name for name in APPLICATION_COLUMNS if name not in _DECIDING],
        F.inline(F.array(F.struct(*[_typed(schema, name).alias(name) for name in _DECIDING]))),
    )
    kept = parsed.filter(
        F.col("event_time").isNotNull()
        & (F.col("requested_amount") > 0)
        & F.col("credit_score").between(MIN_SCORE, MAX_SCORE)
    )
    return kept.select(
        *[name if name in _DECIDING else _typed(schema, name) for name in APPLICATION_COLUMNS]
    )
