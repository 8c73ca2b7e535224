"""Nested application events: parse, flatten and encode. All narrow, for batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditweave.functions.casts import iso_timestamp
from creditweave.functions.text import iso_utc
from creditweave.schemas import EVENT_PAYLOAD_DDL


def parse_payload(messages: DataFrame, *kept: str) -> DataFrame:
    """Position of each message, ``kept`` columns and the fields of its JSON value; malformed text gives NULLs.

    ``inline`` keeps what is built on the fields above the parser; a filter on a projected payload would be
    pushed below it and every message would be parsed twice.
    """
    payload = F.from_json(F.col("value").cast("string"), EVENT_PAYLOAD_DDL)
    return messages.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        *kept,
        F.inline(F.array(payload)),
    )


def parse_events(messages: DataFrame) -> DataFrame:
    """Parse the JSON value of each message and drop those without an application id.

    Malformed text parses to a payload of NULLs and is dropped by the same test.
    """
    return parse_payload(messages).filter(F.col("application_id").isNotNull())


def explode_documents(events: DataFrame) -> DataFrame:
    """One row per document; an event without documents keeps one row with NULL document."""
    return events.select("*", F.explode_outer("documents").alias("document")).drop("documents")


def flat_columns() -> list[str | Column]:
    """Columns of a flat row, over parsed events with one document each."""
    return [
        "topic",
        "partition",
        "offset",
        "kafka_timestamp",
        "application_id",
        F.col("customer.customer_id").alias("customer_id"),
        F.col("customer.region").alias("region_code"),
        F.col("loan.amount").alias("loan_amount"),
        F.col("loan.term_months").alias("term_months"),
        F.col("scoring.score").alias("credit_score"),
        F.col("scoring.risk_level").alias("risk_level"),
        "decision_status",
        iso_timestamp(F.col("submitted_at")).alias("submitted_at"),
        F.col("document.type").alias("document_type"),
        F.col("document.status").alias("document_status"),
    ]


def flatten_events(messages: DataFrame) -> DataFrame:
    """Messages to flat rows: message position, application fields, one document per row."""
    return explode_documents(parse_events(messages)).select(*flat_columns())


def encode_events(records: DataFrame) -> DataFrame:
    """Flat records with a ``documents`` array to message ``key`` and JSON ``value``.

    ``documents`` is an array of struct<type, status>; ``submitted_at`` is a timestamp. NULL
    fields are left out of the text.
    """
    event = F.struct(
        "application_id",
        F.struct("customer_id", F.col("region_code").alias("region")).alias("customer"),
        F.struct(F.col("loan_amount").alias("amount"), "term_months").alias("loan"),
        F.struct(F.col("credit_score").alias("score"), "risk_level").alias("scoring"),
        "documents",
        "decision_status",
        iso_utc(F.col("submitted_at")).alias("submitted_at"),
    )
    return records.select(F.col("application_id").alias("key"), F.to_json(event).alias("value"))
