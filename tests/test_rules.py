from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from creditweave import functions as fn
from creditweave.operators import apply_response_rule, count_violations, decision_violations

ROW = "application_id string, credit_score int, decision_status string, requested_amount int, approved_amount int, employee_review_flag boolean"


@pytest.mark.parametrize(
    ("row", "broken"),
    [
        ((720, "approved", 100, 100, False), []),
        ((720, "approved", 100, 99, False), ["approved_amount_is_requested"]),
        ((720, "approved", 100, None, False), ["approved_amount_is_requested"]),
        ((500, "rejected", 100, 0, None), []),
        ((500, "rejected", 100, 1, None), ["rejected_amount_is_zero"]),
        ((600, "manual_review", 100, 100, True), []),
        ((600, "manual_review", 100, 0, True), []),
        ((600, "manual_review", 100, 101, True), ["manual_amount_in_range"]),
        ((600, "manual_review", 100, -1, None), ["manual_amount_in_range", "manual_is_flagged"]),
        ((700, "rejected", 100, 0, None), ["decision_fits_score"]),
        ((699, "rejected", 100, 0, None), []),
        ((559, "approved", 100, 100, None), ["decision_fits_score"]),
        ((560, "approved", 100, 100, None), []),
        ((600, "postponed", 100, 0, None), ["decision_fits_score"]),
        ((600, None, 100, 0, None), ["decision_fits_score"]),
    ],
)
def test_decision_rules(spark, row, broken):
    frame = spark.createDataFrame([("a", *row)], ROW)
    assert [r.violated_rules for r in decision_violations(frame).collect()] == ([broken] if broken else [])
    counts = {r.rule: r.violations for r in count_violations(frame).collect()}
    assert {rule for rule, n in counts.items() if n} == set(broken)
    assert len(counts) == 5


def test_risk_band_edges(spark):
    scores = spark.range(1).selectExpr("explode(array(null, 300, 559, 560, 699, 700, 900)) AS score")
    bands = [r.band for r in scores.select(fn.risk_band(F.col("score")).alias("band")).collect()]
    assert bands == [None, "high", "high", "medium", "medium", "low", "low"]


def test_response_rule(spark):
    calls = spark.createDataFrame(
        [("answered", "interested"), ("missed", "interested"), (None, "interested"), ("answered", None)],
        "call_status string, client_response string",
    )
    assert [r.client_response for r in apply_response_rule(calls).collect()] == [
        "interested", "unknown", "unknown", None,
    ]


def test_id_text(spark):
    frame = spark.range(1).selectExpr(
        "explode(array(7L, 1234567890L)) AS n", "timestamp '2026-05-01 23:59:59' AS day", "cast(null AS timestamp) AS none"
    )
    rows = frame.select(
        fn.padded_id("loan", F.col("n")),
        fn.dated_id("app", F.col("day"), F.col("n")),
        fn.dated_id("app", F.col("none"), F.col("n")),
        fn.iso_utc(F.col("day")),
    ).collect()
    assert [tuple(r) for r in rows] == [
        ("loan_000000007", "app_20260501_000000007", None, "2026-05-01T23:59:59Z"),
        ("loan_1234567890", "app_20260501_1234567890", None, "2026-05-01T23:59:59Z"),
    ]
