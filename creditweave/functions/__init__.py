from creditweave.functions.casts import (
    boolean_from_text,
    int_from_text,
    iso_timestamp,
    timestamp_from_text,
)
from creditweave.functions.scoring import decision_allowed, risk_band
from creditweave.functions.text import dated_id, iso_utc, padded_id

__all__ = [
    "boolean_from_text",
    "dated_id",
    "decision_allowed",
    "int_from_text",
    "iso_timestamp",
    "iso_utc",
    "padded_id",
    "risk_band",
    "timestamp_from_text",
]
