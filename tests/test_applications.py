from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from creditweave.operators import MARTS, clean_applications
from creditweave.schemas import APPLICATION_COLUMNS, CLEAN_APPLICATIONS, RAW_APPLICATIONS

GOOD = dict(
    application_id="app_1", event_time="2026-05-01 10:00:00", customer_id="cust_1", region_code="DE-HE",
    product_type="cash_loan", requested_amount="1000", term_months="12", credit_score="700",
    risk_level="low", decision_status="approved", approved_amount="1000", channel="web",
    employee_review_flag="false", processing_time_sec="30",
)


def raw(spark, *changes):
    rows = [tuple((GOOD | change)[name] for name in APPLICATION_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, RAW_APPLICATIONS)


def test_types_and_order(any_ansi):
    clean = clean_applications(raw(any_ansi, {}))
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in CLEAN_APPLICATIONS]
    row = clean.first()
    assert row.event_time == datetime(2026, 5, 1, 10)
    assert (row.requested_amount, row.employee_review_flag) == (1000, False)


def test_row_filters(any_ansi):
    changes = {
        "good": {},
        "low score kept": {"credit_score": "300"},
        "high score kept": {"credit_score": "900"},
        "score 299": {"credit_score": "299"},
        "score 901": {"credit_score": "901"},
        "no score": {"credit_score": None},
        "text score": {"credit_score": "high"},
        "no id": {"application_id": None},
        "empty id kept": {"application_id": ""},
        "bad time": {"event_time": "2026-05-01"},
        "zero": {"requested_amount": "0"},
        "below one": {"requested_amount": "0.9"},
        "negative": {"requested_amount": "-5"},
        "no amount": {"requested_amount": ""},
        "fraction kept": {"requested_amount": "1.9"},
        "bad others kept": {"term_months": "x", "approved_amount": "", "employee_review_flag": "?",
                            "processing_time_sec": None},
    }
    rows = raw(any_ansi, *[{"product_type": name} | change for name, change in changes.items()])
    kept = {row.product_type: row for row in clean_applications(rows).collect()}
    assert set(kept) == {"good", *[name for name in changes if name.endswith("kept")]}
    lenient = kept["bad others kept"]
    assert (lenient.term_months, lenient.approved_amount, lenient.employee_review_flag) == (None, None, None)


def test_typed_input_is_kept(any_ansi):
    clean = clean_applications(raw(any_ansi, {}, {"credit_score": "650"}))
    assert clean_applications(clean).collect() == clean.collect()
    wide = clean.withColumn("requested_amount", F.lit(3_000_000_000)).withColumn("term_months", F.lit(7.9))
    assert clean_applications(wide).count() == 0
    assert clean_applications(clean.withColumn("term_months", F.lit(7.9))).first().term_months == 7


def test_marts(any_ansi):
    rows = raw(
        any_ansi,
        {"requested_amount": "10", "employee_review_flag": "true"},
        {"requested_amount": "15", "employee_review_flag": ""},
        {"requested_amount": "20", "employee_review_flag": "false", "customer_id": "cust_2"},
        {"requested_amount": "21", "customer_id": None, "channel": "office", "employee_review_flag": ""},
        {"region_code": None, "risk_level": None, "event_time": "2026-05-02 23:59:59", "channel": None},
    )
    marts = {name: [tuple(r) for r in build(clean_applications(rows)).collect()] for name, build in MARTS.items()}
    assert marts == {
        "applications_by_region_status": [(None, "approved", 1, 1, 1000.0), ("DE-HE", "approved", 4, 2, 16.5)],
        "risk_level_metrics": [(None, 1, 700.0, 1000.0, 1000.0), ("low", 4, 700.0, 16.5, 1000.0)],
        # an unknown flag is not a review, and is not in the denominator of the percentage
        "manual_review_by_channel": [(None, 1, 0, 0.0), ("office", 1, 0, None), ("web", 3, 1, 50.0)],
        "daily_processing_metrics": [(date(2026, 5, 1), 4, 30.0, 700.0), (date(2026, 5, 2), 1, 30.0, 700.0)],
    }


def test_mean_rounds_ties_up(spark):
    # 40 values with a sum of 45 give 1.125, 8 with a sum of 1001 give 125.125
    rows = raw(spark, *([{"requested_amount": "1"}] * 35 + [{"requested_amount": "2"}] * 5))
    assert MARTS["risk_level_metrics"](clean_applications(rows)).first().avg_requested_amount == 1.13


def test_empty_input(spark):
    clean = clean_applications(raw(spark, {}).limit(0))
    assert [build(clean).count() for build in MARTS.values()] == [0, 0, 0, 0]
