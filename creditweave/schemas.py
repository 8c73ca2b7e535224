"""Fixed schemas. Column names, order and types are part of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw application columns, in header order; all text before cleaning.
APPLICATION_COLUMNS = (
    "application_id",
    "event_time",
    "customer_id",
    "region_code",
    "product_type",
    "requested_amount",
    "term_months",
    "credit_score",
    "risk_level",
    "decision_status",
    "approved_amount",
    "channel",
    "employee_review_flag",
    "processing_time_sec",
)

INTEGER_COLUMNS = frozenset(
    {
        "requested_amount",
        "term_months",
        "credit_score",
        "approved_amount",
        "processing_time_sec",
    }
)
BOOLEAN_COLUMNS = frozenset({"employee_review_flag"})
TIMESTAMP_COLUMNS = frozenset({"event_time"})


def _clean_type(name: str) -> T.DataType:
    if name in INTEGER_COLUMNS:
        return T.IntegerType()
    if name in BOOLEAN_COLUMNS:
        return T.BooleanType()
    if name in TIMESTAMP_COLUMNS:
        return T.TimestampType()
    return T.StringType()


RAW_APPLICATIONS = T.StructType([T.StructField(n, T.StringType()) for n in APPLICATION_COLUMNS])
CLEAN_APPLICATIONS = T.StructType([T.StructField(n, _clean_type(n)) for n in APPLICATION_COLUMNS])

# The nested application event carried as JSON in a message.
EVENT_PAYLOAD_DDL = (
    "application_id string, "
    "customer struct<customer_id: string, region: string>, "
    "loan struct<amount: int, term_months: int>, "
    "scoring struct<score: int, risk_level: string>, "
    "documents array<struct<type: string, status: string>>, "
    "decision_status string, "
    "submitted_at string"
)

# The columns of a message that the flattening reads; a message source may have more.
MESSAGE_DDL = "topic string, partition int, offset bigint, timestamp timestamp, value binary"

# The keyed call table. duration_sec is an unsigned 32-bit number, which needs a
# bigint here; its range is a row rule (operators.keyed).
TRANSACTIONS_DDL = (
    "call_id string, "
    "call_time timestamp, "
    "client_id string, "
    "region_code string, "
    "campaign_type string, "
    "call_status string, "
    "client_response string, "
    "duration_sec bigint, "
    "follow_up_required boolean"
)
TRANSACTION_COLUMNS = tuple(part.split()[0] for part in TRANSACTIONS_DDL.split(", "))
TRANSACTION_KEY = ("call_id",)
