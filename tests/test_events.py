from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from creditweave.operators import encode_events, flatten_events, parse_events, payload_volume
from creditweave.schemas import MESSAGE_DDL
from creditweave.sinks import publish_events, start_publishing, to_messages
from creditweave.sources import KafkaConnection

EVENT = {
    "application_id": "app-17",
    "customer": {"customer_id": "person-3", "region": "NORTH"},
    "loan": {"amount": 8200, "term_months": 18},
    "scoring": {"score": 655, "risk_level": "medium"},
    "documents": [{"type": "payslip", "status": "pending"}, {"type": "id_card", "status": "rejected"}],
    "decision_status": "rejected",
    "submitted_at": "2025-11-23T07:48:30Z",
}


def messages(spark, *values):
    encoded = [
        ("t", 0, i, datetime(2026, 5, 1), None if v is None else bytearray(v if isinstance(v, bytes) else v.encode()))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(encoded, MESSAGE_DDL)


def variant(**changes):
    event = {k: v for k, v in (EVENT | changes).items() if v != "drop"}
    return json.dumps(event)


def test_flat_row(any_ansi):
    first, second = flatten_events(messages(any_ansi, json.dumps(EVENT))).collect()
    assert first.asDict() == {
        "topic": "t", "partition": 0, "offset": 0, "kafka_timestamp": datetime(2026, 5, 1),
        "application_id": "app-17", "customer_id": "person-3", "region_code": "NORTH",
        "loan_amount": 8200, "term_months": 18, "credit_score": 655, "risk_level": "medium",
        "decision_status": "rejected", "submitted_at": datetime(2025, 11, 23, 7, 48, 30),
        "document_type": "payslip", "document_status": "pending",
    }
    assert second.asDict() == first.asDict() | {"document_type": "id_card", "document_status": "rejected"}


@pytest.mark.parametrize(
    "value",
    ["not json", "", "null", "[]", "[" + json.dumps(EVENT) + "]", json.dumps(EVENT)[:40], "{}", None, b"\xff\xfe",
     variant(application_id=None), variant(application_id="drop"), json.dumps({"Application_Id": "x"})],
)
def test_dropped_messages(any_ansi, value):
    assert flatten_events(messages(any_ansi, value)).collect() == []


def test_bad_leaf_is_null_only_there(any_ansi):
    values = [
        variant(loan={"amount": "abc", "term_months": 18}),
        variant(loan={"amount": 8200.0, "term_months": 18}),
        variant(loan={"amount": 3000000000, "term_months": 18}),
    ]
    rows = flatten_events(messages(any_ansi, *values)).collect()
    assert [(r.loan_amount, r.term_months, r.credit_score) for r in rows] == [(None, 18, 655)] * 6
    row = flatten_events(messages(any_ansi, variant(submitted_at="soon", extra=1, customer=None))).first()
    assert (row.submitted_at, row.customer_id, row.application_id) == (None, None, "app-17")


def test_number_as_text_and_empty_id(any_ansi):
    rows = flatten_events(messages(any_ansi, variant(application_id=9), variant(application_id=""))).collect()
    assert sorted({r.application_id for r in rows}) == ["", "9"]


@pytest.mark.parametrize(
    ("documents", "expected"),
    [
        ("drop", [(None, None)]),
        (None, [(None, None)]),
        ([], [(None, None)]),
        ({"type": "passport"}, [(None, None)]),
        ([None], [(None, None)]),
        ([{"type": "passport"}, {"status": "pending"}], [("passport", None), (None, "pending")]),
    ],
)
def test_one_row_per_document(any_ansi, documents, expected):
    rows = flatten_events(messages(any_ansi, variant(documents=documents))).collect()
    assert [(r.document_type, r.document_status) for r in rows] == expected


def records(spark, rows):
    return spark.createDataFrame(
        rows,
        "application_id string, customer_id string, region_code string, loan_amount int, term_months int, "
        "credit_score int, risk_level string, documents array<struct<type: string, status: string>>, "
        "decision_status string, submitted_at timestamp",
    )


def test_encode_gives_the_nested_event(spark):
    flat = ("app-17", "person-3", "NORTH", 8200, 18, 655, "medium", [("payslip", "pending"), ("id_card", "rejected")],
            "rejected", datetime(2025, 11, 23, 7, 48, 30))
    (row,) = encode_events(records(spark, [flat])).collect()
    assert row.key == "app-17"
    assert json.loads(row.value) == EVENT
    assert list(json.loads(row.value)) == list(EVENT)


def test_encode_leaves_out_null_and_keeps_unicode(spark):
    flat = ("loan_1", "müller \"x\"", None, None, 36, None, None, None, None, None)
    (row,) = encode_events(records(spark, [flat])).collect()
    assert json.loads(row.value) == {
        "application_id": "loan_1", "customer": {"customer_id": "müller \"x\""}, "loan": {"term_months": 36}, "scoring": {},
    }
    assert "müller" in row.value


def test_volume_counts_utf8_bytes(spark):
    sent = to_messages(records(spark, [("ü" * 600_000,) + (None,) * 9]), "t")
    (row,) = payload_volume(sent).collect()
    assert (row.topic, row.messages, row.sent_mb) == ("t", 1, 1.14)


def test_messages_are_parsed_once(spark):
    plan = flatten_events(messages(spark, json.dumps(EVENT)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_source_columns_beyond_the_contract_are_ignored(spark):
    extended = messages(spark, json.dumps(EVENT)).withColumns({"key": F.lit("k"), "headers": F.lit(None)})
    assert parse_events(extended).columns[:4] == ["topic", "partition", "offset", "kafka_timestamp"]


def test_publishing_reports_what_was_sent(spark):
    rows = records(spark, [(f"loan_{i}", "c" * 1000) + (None,) * 8 for i in range(5000)])
    report = publish_events(rows, KafkaConnection("a:9092"), "t", sink="noop")
    assert report == payload_volume(to_messages(rows, "t")).first().asDict()
    assert report["messages"] == 5000


def test_publishing_nothing(spark):
    report = publish_events(records(spark, []), KafkaConnection("a:9092"), "t", sink="noop")
    assert report["messages"] == 0 and report["sent_mb"] == 0.0


def test_publishing_a_stream(spark, tmp_path):
    rows = records(spark, [(f"loan_{i}",) + (None,) * 9 for i in range(10)])
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        query = start_publishing(stream, KafkaConnection("a:9092"), "t", str(tmp_path / "cp"), "parquet", path=out)
        assert query.awaitTermination(120)
    sent = spark.read.parquet(out)
    assert sent.count() == 20 and sent.columns == ["topic", "key", "value"]
