"""Comparison of two outputs of a topic by message position: what is missing, extra or repeated, as offset ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets are put in order within blocks of so many, so that a topic partition of any length is spread over tasks.
BLOCK = 1 << 16

_PLACE = ("topic", "partition")


def _runs(rows: DataFrame, within: tuple[str, ...]) -> DataFrame:
    """Neighbouring rows of one ``outcome`` as one: ``from_offset``, ``to_offset`` and ``message_count``."""
    in_order = Window.partitionBy(*within).orderBy("from_offset")
    changed = (F.col("outcome") != F.lag("outcome").over(in_order)).cast("int")
    up_to = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn("changed", F.coalesce(changed, F.lit(0))).withColumn("run", F.sum("changed").over(up_to))
    return numbered.groupBy(*within, "run", "outcome").agg(
        F.min("from_offset").alias("from_offset"), F.max("to_offset").alias("to_offset"), F.sum("message_count").alias("message_count")
    )


def compare_outputs(first: DataFrame, second: DataFrame, block: int = BLOCK) -> DataFrame:
    """``topic, partition, outcome, from_offset, to_offset, message_count``: where two outputs differ.

    Both have rows with ``topic, partition, offset``, any number for a message. ``missing`` messages are only
    in the first, ``extra`` ones only in the second; ``repeated`` ones have more rows in the second,
    ``partial`` ones fewer. A range spans neighbouring messages of one outcome: neighbours among those that
    either output has, since a topic's own offsets may have gaps. Equal outputs give no rows.

    Counts are added up before the shuffle. Ranges are found within blocks of offsets first and then joined
    over the blocks of a topic partition, which are few rows where the outputs agree.
    """
    sides = [rows.select(*_PLACE, "offset", F.lit(k).alias("side")) for k, rows in enumerate((first, second))]
    counted = sides[0].unionAll(sides[1]).groupBy(*_PLACE, "offset").agg(*[F.count_if(F.col("side") == k).alias(f"n{k}") for k in (0, 1)])
    n0, n1 = F.col("n0"), F.col("n1")
    outcome = F.when(n1 == 0, "missing").when(n0 == 0, "extra").when(n1 > n0, "repeated").when(n1 < n0, "partial").otherwise("same")
    offset = F.col("offset")
    rows = counted.select(
        *_PLACE, F.floor(offset / F.lit(block)).alias("block"), outcome.alias("outcome"), offset.alias("from_offset"), offset.alias("to_offset"), F.lit(1).cast("bigint").alias("message_count")
    )
    found = _runs(_runs(rows, (*_PLACE, "block")).drop("block", "run"), _PLACE)
    return found.filter("outcome <> 'same'").select(*_PLACE, "outcome", "from_offset", "to_offset", "message_count")
