"""Text casts, against the rules and against Spark's own non-ANSI casts."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from creditweave import functions as fn
from creditweave.functions.casts import bigint_from_text

INTS = {
    "12": 12, " 12 ": 12, "\t12\n": 12, "+5": 5, "-7": -7, "12.7": 12, "-12.7": -12, "12.": 12, ".5": 0,
    "-.5": 0, ".": 0, "0012": 12, "000000000000012": 12, "2147483647": 2147483647, "-2147483648": -2147483648,
    "2147483648": None, "2199999999": None, "3000000000": None, "99999999999999": None, "1e3": None, "": None,
    " ": None, "+": None, "-": None, "abc": None, "1 2": None, "1.2.3": None, "1.a": None, "n/a": None,
    "2150000000": None, "9999999999999999999999": None, "0x10": None, "12L": None, "1,000": None, "١٢": None,
}
BIGINTS = {
    " 3000000000": 3000000000, "3000000000.0": 3000000000, "03000000000": 3000000000, "+3000000000": 3000000000,
    "4294967295": 4294967295, "-5": -5, "12.7": 12, ".5": 0, "999999999999999999": 999999999999999999,
    "1234567890123456789": None, "1e3": None, "": None,
}
BOOLEANS = {
    "true": True, "T": True, "yes": True, "Y": True, "1": True, "  true ": True, "\ttrue\n": True,
    "false": False, "F": False, "no": False, "N": False, "0": False, "": None, "2": None, "on": None,
    "tru": None, "true false": None,
}
TIMES = {
    "2026-05-01 10:15:11": datetime(2026, 5, 1, 10, 15, 11),
    "2024-02-29 23:59:59": datetime(2024, 2, 29, 23, 59, 59),
    "2026-02-30 10:15:11": None, "2026-02-29 00:00:00": None, "2026-5-1 0:0:20": None,
    "2026-05-01T10:15:11Z": None, "2026-05-01": None, "2026-05-01 10:15:11.5": None,
    " 2026-05-01 10:15:11": None, "2026-05-01 10:15:11\n": None, "2026-05-01 24:00:00": None,
    "2026-13-01 00:00:00": None, "2026-05-32 00:00:00": None, "2026-05-01 25:00:00": None, "2026-05-01 10:60:00": None, "not-a-time": None, "": None,
}
ISO_TIMES = {
    "2026-05-01T10:15:11Z": datetime(2026, 5, 1, 10, 15, 11),
    "2026-05-01 10:15:11": datetime(2026, 5, 1, 10, 15, 11),
    "2026-05-01T10:15:11.250Z": datetime(2026, 5, 1, 10, 15, 11, 250000),
    "2026-05-01T12:15:11+02:00": datetime(2026, 5, 1, 10, 15, 11),
    "2026-05-01": datetime(2026, 5, 1), "soon": None, "": None, "10:15:11": None, "T10:15:11Z": None,
}


def _apply(spark, texts, function):
    frame = spark.createDataFrame([(text,) for text in texts], "text string")
    return {row.text: row.value for row in frame.select("text", function(F.col("text")).alias("value")).collect()}


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (fn.int_from_text, INTS),
        (bigint_from_text, BIGINTS),
        (fn.boolean_from_text, BOOLEANS),
        (fn.timestamp_from_text, TIMES),
        (fn.iso_timestamp, ISO_TIMES),
    ],
    ids=["int", "bigint", "boolean", "timestamp", "iso"],
)
def test_cases(any_ansi, function, cases):
    assert _apply(any_ansi, [*cases, None], function) == {**cases, None: None}


def _texts(alphabet: str, longest: int, count: int) -> list[str]:
    rng = random.Random(7)
    return sorted({"".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(count)})


def _time_texts() -> list[str]:
    rng = random.Random(11)
    texts = set(TIMES)
    for _ in range(4000):
        text = list(
            f"{rng.randint(0, 9999):04d}-{rng.randint(0, 13):02d}-{rng.randint(0, 32):02d} "
            f"{rng.randint(0, 24):02d}:{rng.randint(0, 60):02d}:{rng.randint(0, 60):02d}"
        )
        for _ in range(rng.choice([0, 0, 1, 2])):
            text[rng.randrange(len(text))] = rng.choice("0123456789- :T+")
        texts.add(rng.choice(["", "", "", "+", "-", "+1"]) + "".join(text))
    return sorted(texts)


@pytest.fixture
def legacy(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize(
    ("ours", "plain", "texts"),
    [
        (fn.int_from_text, lambda c: c.cast("int"), _texts("0123456789.+- \t\x7fea", 13, 20000)),
        (fn.int_from_text, lambda c: c.cast("int"), _texts("0249.-", 14, 20000)),
        (fn.boolean_from_text, lambda c: c.cast("boolean"), _texts("truefalsyno01TY \t", 4, 20000)),
        (fn.timestamp_from_text, lambda c: F.to_timestamp(c, "yyyy-MM-dd HH:mm:ss"), _time_texts()),
    ],
    ids=["int", "int-digits", "boolean", "timestamp"],
)
def test_random_text_as_the_plain_cast(legacy, ours, plain, texts):
    """Non-ANSI ``cast`` and ``to_timestamp`` define the results."""
    frame = legacy.createDataFrame([(text,) for text in texts], "text string")
    different = frame.filter(~ours(F.col("text")).eqNullSafe(plain(F.col("text"))))
    assert different.limit(5).collect() == []
    assert frame.filter(ours(F.col("text")).isNotNull()).count() > 0


def test_iso_text_keeps_a_fraction(spark):
    moments = [datetime(2026, 5, 1, 10, 15, 11), datetime(2026, 5, 1, 10, 15, 11, 250), None]
    frame = spark.createDataFrame([(m,) for m in moments], "at timestamp")
    assert [r[0] for r in frame.select(fn.iso_utc(F.col("at"))).collect()] == ["2026-05-01T10:15:11Z", "2026-05-01T10:15:11.000250Z", None]
