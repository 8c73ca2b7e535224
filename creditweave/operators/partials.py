"""The marts as sums that can be merged: partial rows by day, and exact distinct counts by bitmaps.

A distinct count over numbered values is a set of bits, filled in the JVM before the shuffle and joined by
*or*, so no row is de-duplicated. Over all days a group has many values: they are cut into runs of 32,768
numbers, and each (group, run) is one bitmap. A group of one day has few: there the runs are words of 64
numbers, so a word takes 8 bytes and there are never more of them than rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "event_date"
#: Column of the dense number that stands for ``customer_id``.
CUSTOMER_NUMBER = "customer_number"


@dataclass(frozen=True)
class Partial:
    """How a mart is built: keys, averaged columns, a flag whose share is taken, a number whose values are counted."""

    keys: tuple[str, ...]
    averages: tuple[str, ...] = ()
    flag: str | None = None
    distinct: str | None = None


PARTIALS = {
    "applications_by_region_status": Partial(("region_code", "decision_status"), ("requested_amount",), distinct=CUSTOMER_NUMBER),
    "risk_level_metrics": Partial(("risk_level",), ("credit_score", "requested_amount", "approved_amount")),
    "manual_review_by_channel": Partial(("channel",), flag="employee_review_flag"),
    "daily_processing_metrics": Partial((DAY,), ("processing_time_sec", "credit_score")),
}


def with_numbers(clean: DataFrame, numbers: DataFrame) -> DataFrame:
    """Clean applications with the number of their customer (``numbers`` of ``value, number``); NULL without one."""
    numbers = numbers.select(F.col("value").alias("customer_id"), F.col("number").alias(CUSTOMER_NUMBER))
    return clean.join(numbers, "customer_id", "left")


def _measures(spec: Partial) -> list[str]:
    return ["application_count", *[f"{kind}_{c}" for c in (*spec.averages, *([spec.flag] if spec.flag else [])) for kind in ("sum", "n")]]


def _bits(spec: Partial) -> list[str]:
    return ["bits_word"] if spec.distinct else []


def _sums(spec: Partial) -> list[Column]:
    sums: list[Column] = [F.count("*").alias("application_count")]
    for name in (*spec.averages, *([spec.flag] if spec.flag else [])):
        number = F.col(name).cast("int")
        sums += [F.sum(number.cast("bigint")).alias(f"sum_{name}"), F.count(name).alias(f"n_{name}")]
    return sums


def partial_rows(clean: DataFrame, mart: str) -> DataFrame:
    """One row for each day and group of a mart, and word of numbers where it counts distinct ones."""
    spec = PARTIALS[mart]
    rows, sums = clean.withColumn(DAY, F.to_date("event_time")), _sums(spec)
    if spec.distinct:
        rows = rows.withColumn("bits_word", F.shiftright(spec.distinct, 6))
        sums.append(F.bit_or(F.expr(f"shiftleft(1L, cast({spec.distinct} & 63 AS int))")).alias("bits"))
    return rows.groupBy(*dict.fromkeys((DAY, *spec.keys)), *_bits(spec)).agg(*sums)


def _summed(rows: DataFrame, spec: Partial, keys: list[str]) -> DataFrame:
    sums = [F.sum(m).alias(m) for m in _measures(spec)]
    return rows.groupBy(*keys).agg(*sums, *([F.bit_or("bits").alias("bits")] if spec.distinct else []))


def merged_rows(partials: DataFrame, mart: str) -> DataFrame:
    """Partial rows of several deliveries as if they had come in one."""
    spec = PARTIALS[mart]
    return _summed(partials, spec, [*dict.fromkeys((DAY, *spec.keys)), *_bits(spec)])


def mart_of(partials: DataFrame, mart: str) -> DataFrame:
    """The mart, equal to the one over all clean rows that the partial rows stand for."""
    spec = PARTIALS[mart]
    rows = _summed(partials, spec, [*spec.keys, *_bits(spec)])
    return _finished(rows.withColumn("customer_count", F.bit_count("bits")) if spec.distinct else rows, spec)


def _finished(rows: DataFrame, spec: Partial) -> DataFrame:
    """The mart from sums, which have the numbers of each run counted where the mart counts distinct ones."""
    counted = []
    if spec.distinct:
        rows = rows.groupBy(*spec.keys).agg(*[F.sum(m).alias(m) for m in (*_measures(spec), "customer_count")])
        counted = [F.coalesce("customer_count", F.lit(0)).cast("bigint").alias("customer_count")]
    mean = lambda c: F.col(f"sum_{c}").cast("double") / F.when(F.col(f"n_{c}") > 0, F.col(f"n_{c}"))
    averaged = [F.round(mean(c), 2).alias(f"avg_{c}") for c in spec.averages]
    if spec.flag:
        counted = [F.coalesce(f"sum_{spec.flag}", F.lit(0)).cast("bigint").alias("manual_review_count")]
        averaged = [F.round(mean(spec.flag) * 100, 2).alias("manual_review_pct")]
    return rows.select(*spec.keys, "application_count", *counted, *averaged).orderBy(*spec.keys)


def region_status_by_bitmaps(numbered: DataFrame) -> DataFrame:
    """The region and decision mart over clean rows that carry their customer's number, without de-duplicating rows.

    A task has one bitmap of 4 KB for each group and run of numbers, whatever the number of days.
    """
    spec = PARTIALS["applications_by_region_status"]
    rows = numbered.withColumn("bits_run", F.bitmap_bucket_number(spec.distinct))
    rows = rows.groupBy(*spec.keys, "bits_run").agg(*_sums(spec), F.bitmap_construct_agg(F.bitmap_bit_position(spec.distinct)).alias("bits"))
    counted = F.when(F.col("bits_run").isNotNull(), F.bitmap_count("bits"))
    return _finished(rows.withColumn("customer_count", counted), spec)
