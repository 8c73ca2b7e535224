"""Text forms of ids and timestamps used when records are published."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded_id(prefix: str, number: Column) -> Column:
    """``prefix_000000042``: nine digits at least, never cut."""
    return F.format_string(f"{prefix}_%09d", number.cast("bigint"))


def dated_id(prefix: str, day: Column, number: Column) -> Column:
    """``prefix_yyyymmdd_000000042``; NULL without a day."""
    stamp = F.date_format(day, "yyyyMMdd")
    return F.when(
        stamp.isNotNull(), F.format_string(f"{prefix}_%s_%09d", stamp, number.cast("bigint"))
    )


def iso_utc(moment: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ``, with six digits of a second where it has a fraction. The session zone must be UTC."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    exact = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(moment == F.date_trunc("second", moment), whole).otherwise(exact)
