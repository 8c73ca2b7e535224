"""Operators on a table with a primary key and no NULLs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditweave.schemas import TRANSACTION_COLUMNS

# Fixed value: largest unsigned 32-bit number.
MAX_UINT32 = 4294967295


def _sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_sortable(field.dataType) for field in dtype)
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _tie_break(field: T.StructField) -> Column:
    """The column itself, or a hash of its JSON text where values have no order."""
    column = F.col(field.name)
    return column if _sortable(field.dataType) else F.xxhash64(F.to_json(F.struct(column)))


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` for each key.

    Spark cuts each task's rows to one per key before the shuffle (WindowGroupLimit), so a hot key
    costs its final task one row per input task. The other columns close the order, so that rows
    which tie on ``order`` give the same result when a lost task is run again.
    """
    rest = [_tie_break(f) for f in rows.schema if f.name not in (*keys, *order)]
    ranking = Window.partitionBy(*keys).orderBy(*[c.desc() for c in (*map(F.col, order), *rest)])
    return (
        rows.withColumn("__rank", F.row_number().over(ranking))
        .filter(F.col("__rank") == 1)
        .drop("__rank")
    )


def with_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key holds no NULL."""
    return rows.filter(reduce(and_, [F.col(key).isNotNull() for key in keys]))


def upsert(
    base: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Insert or replace whole rows of ``base`` by key.

    ``base`` holds one row per key. ``changes`` may repeat a key, then the highest ``order`` wins, and
    the highest of the other columns where that ties or is not given; so the result has one row per
    key as well. Columns only used for ordering are dropped, so the result has the columns of ``base``.

    Changes with a NULL in the key are not applied; :func:`split_not_null` names them. The replaced rows leave by an anti join
    on the changed keys alone. While those keys are under the broadcast threshold at run time,
    ``base`` is neither shuffled nor sorted; above it the planner takes a shuffled join on the key,
    which a table bucketed by the key already satisfies.
    """
    changes = with_keys(changes, keys)
    newest = latest_per_key(changes, keys, order)
    replaced = changes.select(*keys).distinct()
    kept = base.join(replaced, on=list(keys), how="left_anti").select(*base.columns)
    return kept.unionByName(newest.select(*base.columns))


def merge_upsert(
    table: str, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> None:
    """The same upsert as ``MERGE INTO`` a catalog table, where its format supports row changes.

    Such a table rewrites the files that hold changed keys instead of the whole snapshot.
    """
    columns = changes.sparkSession.table(table).columns
    newest = latest_per_key(with_keys(changes, keys), keys, order)
    matches = reduce(and_, [F.col(f"{table}.{key}") == F.col(f"__changes.{key}") for key in keys])
    (
        newest.select(*columns)
        .alias("__changes")
        .mergeInto(table, matches)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def key_violations(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def null_columns(columns: Sequence[str]) -> Column:
    """Names of the columns that are NULL in a row, as an array."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in columns]))


def split_not_null(rows: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every column set, and the others with the names of their ``null_columns``."""
    missing = reduce(or_, [F.col(c).isNull() for c in columns])
    violating = rows.filter(missing).withColumn("null_columns", null_columns(columns))
    return rows.filter(~missing), violating


def call_rules() -> dict[str, Column]:
    """Rules of the keyed call table, as conditions that break them: no NULL, durations in the unsigned range."""
    nulls = {f"{c}_is_null": F.col(c).isNull() for c in TRANSACTION_COLUMNS}
    return nulls | {"duration_out_of_range": ~F.col("duration_sec").between(0, MAX_UINT32)}


def uint32_violations(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose number does not fit an unsigned 32-bit column."""
    return rows.filter(~F.col(column).between(0, MAX_UINT32))
