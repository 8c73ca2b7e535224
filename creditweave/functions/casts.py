"""Lenient text casts: a bad value becomes NULL, whatever ``spark.sql.ansi.enabled`` says.

``try_cast`` alone would do for most values, but it raises and catches an exception inside the
task for every bad one (about 20 microseconds, 25-50 times the cost of a good value), so one dirty
column could dominate a scan. The casts of numbers and booleans therefore test the text with a
regular expression first and only cast what will parse. The cast of plain times tests the range of
every part, so only days that a month does not have (30 February) still raise inside it; signed
years and ISO text go through the parser, where bad values keep that cost. All of it is built-in and
stays inside generated code; the expressions are kept short because long ones push the generated
method past what the JVM compiles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# What a numeric or boolean cast strips from both ends: ASCII blanks and control characters.
_BLANKS = r"[\x00-\x20\x7f]*"

_SHORT_INT = r"^[0-9]{1,9}\z"
def _int_part(number: str) -> str:
    """The integer part of a decimal number, cut from between blanks and a fraction."""
    return rf"^{_BLANKS}{number}(?=(?:\.[0-9]*)?{_BLANKS}\z)"


def _digits_up_to(largest: str) -> str:
    """Numbers from 0 to ``largest``: fewer digits, or a smaller digit after a common beginning."""
    shorter = rf"[0-9]{{1,{len(largest) - 1}}}"
    below = [
        f"{largest[:k]}[0-{int(d) - 1}]" + (f"[0-9]{{{rest}}}" if (rest := len(largest) - k - 1) else "")
        for k, d in enumerate(largest)
        if d > "0"
    ]
    return "(?:" + "|".join([shorter, *below, largest]) + ")"


# 18 digits always fit a bigint, and the other pattern takes exactly what an int holds: no cast can fail.
_BIGINT_PART = _int_part("[+-]?0*[0-9]{1,18}")
_INT_PART = _int_part(rf"(?:[+-]?0*{_digits_up_to('2147483647')}|-0*2147483648)")
_NO_INT_PART = rf"^{_BLANKS}[+-]?\.[0-9]*{_BLANKS}\z"

# Spellings of true and false, any case.
_TRUE = rf"(?i)^{_BLANKS}(?:t|true|y|yes|1){_BLANKS}\z"
_FALSE = rf"(?i)^{_BLANKS}(?:f|false|n|no|0){_BLANKS}\z"

_PLAIN_TIME = r"^\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01]) (?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d\z"
_WITH_DATE = r"^\s*[+-]?\d{4}"
_SIGNED_YEAR = r"^[+-]"


def _whole(text: Column, pattern: str, kind: str) -> Column:
    return F.coalesce(
        F.regexp_substr(text, F.lit(pattern)).try_cast(kind),
        F.when(text.rlike(_NO_INT_PART), F.lit(0).cast(kind)),
    )


def bigint_from_text(text: Column) -> Column:
    """Text to bigint, up to 18 digits. Fractions are cut off (``12.7`` is 12, ``.5`` is 0); no exponents."""
    return _whole(text, _BIGINT_PART, "bigint")


def int_from_text(text: Column) -> Column:
    """Text to int, by the rules of :func:`bigint_from_text`; what an int cannot hold is NULL."""
    return F.when(text.rlike(_SHORT_INT), text.try_cast("int")).otherwise(_whole(text, _INT_PART, "int"))


def boolean_from_text(text: Column) -> Column:
    """Text to boolean by the usual spellings, any case, blanks around them allowed."""
    return F.when(text.rlike(_TRUE), True).when(text.rlike(_FALSE), False)


def timestamp_from_text(text: Column) -> Column:
    """Text in exactly ``yyyy-MM-dd HH:mm:ss``; any other shape or an impossible date is NULL.

    Plain four-digit years take the fast ISO cast. A signed year, which the pattern also allows,
    goes through the pattern parser.
    """
    by_pattern = F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT))
    return F.when(text.rlike(_PLAIN_TIME), text.try_cast("timestamp")).when(
        text.rlike(_SIGNED_YEAR), by_pattern
    )


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text (``T`` or blank, zone, fraction and time of day optional) to a timestamp.

    Text without a date is NULL: the plain cast would give it today's date, and a replay other rows.
    """
    return F.when(text.rlike(_WITH_DATE), F.try_to_timestamp(text))
