from creditweave.operators.applications import clean_applications
from creditweave.operators.events import encode_events, explode_documents, flatten_events, parse_events
from creditweave.operators.keyed import (
    key_violations,
    latest_per_key,
    merge_upsert,
    split_not_null,
    uint32_violations,
    upsert,
)
from creditweave.operators.marts import MARTS
from creditweave.operators.rules import apply_response_rule, count_violations, decision_violations
from creditweave.operators.volume import payload_volume

__all__ = [
    "MARTS",
    "apply_response_rule",
    "clean_applications",
    "count_violations",
    "decision_violations",
    "encode_events",
    "explode_documents",
    "flatten_events",
    "key_violations",
    "latest_per_key",
    "merge_upsert",
    "parse_events",
    "payload_volume",
    "split_not_null",
    "uint32_violations",
    "upsert",
]
