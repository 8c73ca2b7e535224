"""DuckDB SQL for each registered query, over the same tables."""

from __future__ import annotations

from checks.views import VIEWS
from creditweave.schemas import APPLICATION_COLUMNS, INTEGER_COLUMNS, TRANSACTION_COLUMNS


def _with(view_names: tuple[str, ...], extra: dict[str, str], query: str) -> str:
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in view_names]
    parts += [f"{name} AS ({text.strip()})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)} {query.strip()}"


def _int(column: str) -> str:
    trimmed = f"trim({column})"
    whole = f"try_cast(regexp_extract({trimmed}, '^([+-]?[0-9]+)(\\.[0-9]*)?$', 1) AS int)"
    no_int_part = f"CASE WHEN regexp_matches({trimmed}, '^[+-]?\\.[0-9]*$') THEN 0 END"
    return f"coalesce({whole}, {no_int_part})"


def _typed(column: str) -> str:
    if column == "event_time":
        return "try_strptime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time"
    if column == "employee_review_flag":
        return "try_cast(trim(employee_review_flag) AS boolean) AS employee_review_flag"
    return f"{_int(column)} AS {column}" if column in INTEGER_COLUMNS else column


def _empty_as_null(column: str) -> str:
    return f"nullif({column}, '') AS {column}"


CLEAN = f"""
SELECT * FROM (SELECT {', '.join(_typed(c) for c in APPLICATION_COLUMNS)} FROM f_applications_raw) t
WHERE application_id IS NOT NULL AND event_time IS NOT NULL AND requested_amount > 0
  AND credit_score BETWEEN 300 AND 900
"""

PARSED = """
SELECT topic, "partition", "offset", "timestamp" AS kafka_timestamp, j
FROM (SELECT *, try_cast(value AS json) AS j FROM f_event_messages) p
WHERE j->>'$.application_id' IS NOT NULL
"""

DOCUMENT_ROWS = """
SELECT e.*, d FROM f_parsed e
LEFT JOIN LATERAL (SELECT unnest(from_json(j->'$.documents', '["json"]')) AS d) u ON true
"""

FLAT = """
SELECT topic, "partition", "offset", kafka_timestamp, j->>'$.application_id' AS application_id,
  j->>'$.customer.customer_id' AS customer_id, j->>'$.customer.region' AS region_code,
  cast(j->>'$.loan.amount' AS int) AS loan_amount, cast(j->>'$.loan.term_months' AS int) AS term_months,
  cast(j->>'$.scoring.score' AS int) AS credit_score, j->>'$.scoring.risk_level' AS risk_level,
  j->>'$.decision_status' AS decision_status,
  try_strptime(j->>'$.submitted_at', '%Y-%m-%dT%H:%M:%SZ') AS submitted_at,
  d->>'$.type' AS document_type, d->>'$.status' AS document_status
FROM f_documents
"""

_CALL_COLUMNS = ", ".join(TRANSACTION_COLUMNS)


def _latest(where: str, view: str = "f_transactions") -> str:
    return f"""
    SELECT {_CALL_COLUMNS} FROM (
      SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY batch_no DESC, seq DESC) AS rn
      FROM {view} WHERE {where}) t
    WHERE rn = 1"""


BASE = _latest("batch_no = 0")
UPSERTED = _latest("true")


def _mean(expression: str) -> str:
    """Two digits, ties up: rounded as a decimal, since the double rounds ties by its binary form."""
    return f"cast(round(cast({expression} AS decimal(38, 10)), 2) AS double)"


MARTS = {
    "applications_by_region_status": f"""
      SELECT region_code, decision_status, count(*) AS application_count,
        count(DISTINCT customer_id) AS customer_count,
        {_mean('avg(requested_amount)')} AS avg_requested_amount
      FROM f_clean GROUP BY region_code, decision_status""",
    "risk_level_metrics": f"""
      SELECT risk_level, count(*) AS application_count, {_mean('avg(credit_score)')} AS avg_credit_score,
        {_mean('avg(requested_amount)')} AS avg_requested_amount,
        {_mean('avg(approved_amount)')} AS avg_approved_amount
      FROM f_clean GROUP BY risk_level""",
    "manual_review_by_channel": f"""
      SELECT channel, count(*) AS application_count,
        cast(sum(CASE WHEN employee_review_flag THEN 1 ELSE 0 END) AS bigint) AS manual_review_count,
        {_mean('avg(cast(employee_review_flag AS int)) * 100')} AS manual_review_pct
      FROM f_clean GROUP BY channel""",
    "daily_processing_metrics": f"""
      SELECT cast(event_time AS date) AS event_date, count(*) AS application_count,
        {_mean('avg(processing_time_sec)')} AS avg_processing_time_sec,
        {_mean('avg(credit_score)')} AS avg_credit_score
      FROM f_clean GROUP BY cast(event_time AS date)""",
}


def _clean_query(query: str) -> str:
    return _with(("f_applications_raw",), {"f_clean": CLEAN}, query)


def _event_query(query: str, with_documents: bool = True) -> str:
    steps = {"f_parsed": PARSED} | ({"f_documents": DOCUMENT_ROWS} if with_documents else {})
    return _with(("f_event_messages",), steps, query)


def _call_query(query: str) -> str:
    return _with(("f_transactions",), {}, query)


def _record_query(query: str) -> str:
    return _with(("f_event_records",), {}, query)


_BAND = (
    "CASE WHEN credit_score >= 700 THEN 'low' WHEN credit_score >= 560 THEN 'medium' "
    "WHEN credit_score IS NOT NULL THEN 'high' END"
)
_ALLOWED = (
    "CASE WHEN credit_score >= 700 THEN decision_status IN ('approved', 'manual_review') "
    "WHEN credit_score >= 560 THEN decision_status IN ('approved', 'rejected', 'manual_review') "
    "WHEN credit_score IS NOT NULL THEN decision_status IN ('rejected', 'manual_review') END"
)
_LOAN_ID = "printf('loan_%09d', row_number)"
_DAY_NUMBER = "concat(strftime(submitted_at, '%Y%m%d'), printf('_%09d', row_number))"
def _iso(column: str) -> str:
    return (
        f"CASE WHEN microsecond({column}) % 1000000 = 0 THEN strftime({column}, '%Y-%m-%dT%H:%M:%SZ') "
        f"ELSE strftime({column}, '%Y-%m-%dT%H:%M:%S.%fZ') END"
    )


_ISO = _iso("submitted_at")


def _document(which: str) -> str:
    return f"""concat('{{"type":"', {which}_type, '","status":"', {which}_status, '"}}')"""


_DOCUMENTS = (
    f"CASE WHEN second_type IS NOT NULL THEN concat({_document('first')}, ',', {_document('second')}) "
    f"WHEN first_type IS NOT NULL THEN {_document('first')} ELSE '' END"
)
_SCORING = (
    "CASE WHEN credit_score IS NULL THEN '{}' ELSE "
    f"""concat('{{"score":', cast(credit_score AS varchar), ',"risk_level":"', {_BAND}, '"}}') END"""
)
EVENT_TEXT = f"""
SELECT 'loan_applications' AS topic, {_LOAN_ID} AS key,
  concat('{{"application_id":"', {_LOAN_ID}, '","customer":{{"customer_id":"', customer_id,
    '","region":"', region_code, '"}},"loan":{{"amount":', cast(loan_amount AS varchar), ',"term_months":',
    cast(term_months AS varchar), '}},"scoring":', {_SCORING}, ',"documents":[', {_DOCUMENTS},
    '],"decision_status":"', decision_status, '","submitted_at":"', {_ISO}, '"}}') AS value
FROM f_event_records
"""
ROUND_TRIP = f"""
SELECT row_number AS "offset", {_LOAN_ID} AS application_id, customer_id, region_code, loan_amount,
  term_months, credit_score, {_BAND} AS risk_level, decision_status,
  submitted_at, document_type, document_status
FROM (
  SELECT *, first_type AS document_type, first_status AS document_status FROM f_event_records
  UNION ALL
  SELECT *, second_type, second_status FROM f_event_records WHERE second_type IS NOT NULL) t
"""

# In the order in which the rules are listed in violated_rules.
_RULES = {
    "approved_amount_is_requested": "decision_status = 'approved' AND (approved_amount = requested_amount) IS NOT TRUE",
    "rejected_amount_is_zero": "decision_status = 'rejected' AND (approved_amount = 0) IS NOT TRUE",
    "manual_amount_in_range": (
        "decision_status = 'manual_review' AND (approved_amount BETWEEN 0 AND requested_amount) IS NOT TRUE"
    ),
    "manual_is_flagged": "decision_status = 'manual_review' AND employee_review_flag IS NOT TRUE",
    "decision_fits_score": f"({_ALLOWED}) IS NOT TRUE",
}
_BROKEN_NAMES = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {broken} THEN '{name}' END" for name, broken in _RULES.items()
) + ")"
_NULL_NAMES = "concat_ws(',', " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in TRANSACTION_COLUMNS
) + ")"
_ANY_NULL = " OR ".join(f"{c} IS NULL" for c in TRANSACTION_COLUMNS)

_OUTPUT_COUNTS = " UNION ALL ".join(
    ["SELECT 'clean_applications' AS output, count(*) AS row_count FROM f_clean"]
    + [f"SELECT '{name}', count(*) FROM ({query}) m" for name, query in MARTS.items()]
)

_RULE_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS rule, count(*) AS violations FROM f_clean WHERE {broken}" for name, broken in _RULES.items()
)

# CRC-32 bit by bit, since DuckDB has none.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(customer_id, ''), lambda s: cast(ord(s) AS bigint))),
  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, k: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
_PARTS = f"SELECT *, {_CRC} % 3 AS part FROM f_applications_raw"
_LACKING = {c: f"CASE WHEN part < 2 THEN nullif({c}, '') END AS {c}" for c in ("channel", "term_months")}
_MIXED = f"""SELECT {', '.join(_LACKING.get(c) or _empty_as_null(c) for c in APPLICATION_COLUMNS)},
  CASE WHEN part = 2 THEN 'b,2' END AS note FROM f_parts"""

_GAPS = """
SELECT topic, "partition", outcome, min("offset") AS from_offset, max("offset") AS to_offset, count(*) AS message_count
FROM (
  SELECT *, count(*) FILTER (changed) OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS run
  FROM (
    SELECT *, outcome <> lag(outcome) OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS changed
    FROM (
      SELECT DISTINCT topic, "partition", "offset", CASE
        WHEN "partition" = 0 AND "offset" // 100 IN (3, 4, 9) THEN 'missing' WHEN "partition" = 1 AND "offset" // 100 IN (5, 12) THEN 'repeated'
        WHEN "partition" = 2 AND "offset" // 100 = 7 THEN 'extra' ELSE 'same' END AS outcome
      FROM f_documents) a) b) c
WHERE outcome <> 'same' GROUP BY topic, "partition", outcome, run
"""

_WIDE_BASE = _latest("batch_no = 0", "f_transactions_wide")
_WIDE_CHANGES = "(SELECT DISTINCT call_id FROM f_transactions_wide WHERE batch_no = 1)"

ORACLES: dict[str, str] = {
    # An empty text is written to CSV as nothing and read back as NULL.
    "scan_csv": _with(
        ("f_applications_raw",),
        {},
        f"SELECT {', '.join(_empty_as_null(c) for c in APPLICATION_COLUMNS)} FROM f_applications_raw",
    ),
    "scan_csv_mixed": _with(("f_applications_raw",), {"f_parts": _PARTS}, _MIXED),
    "scan_parquet": _with(("f_applications_raw",), {}, "SELECT * FROM f_applications_raw"),
    "clean_applications": _clean_query("SELECT * FROM f_clean"),
    "cast_ints": _with(("f_number_text",), {}, f"SELECT *, {_int('number_text')} AS number FROM f_number_text"),
    "cast_bool": _with(
        ("f_boolean_text",), {}, "SELECT *, try_cast(trim(flag_text) AS boolean) AS flag FROM f_boolean_text"
    ),
    "parse_event_time": _with(
        ("f_time_text",),
        {},
        """SELECT *, CASE WHEN length(time_text) = 19 AND time_text[1:1] <> ' '
             THEN try_strptime(time_text, '%Y-%m-%d %H:%M:%S') END AS event_time FROM f_time_text""",
    ),
    "parse_iso_time": _with(
        ("f_time_text",),
        {},
        "SELECT *, try_cast(replace(trim(time_text), 'Z', '') AS timestamp) AS submitted_at FROM f_time_text",
    ),
    **{name: _clean_query(query) for name, query in MARTS.items()},
    **{f"merged_{name}": _clean_query(query) for name, query in MARTS.items()},
    "merged_mart_of_days": _clean_query(
        MARTS["applications_by_region_status"].replace("FROM f_clean", "FROM f_clean WHERE cast(event_time AS date) BETWEEN '1994-01-01' AND '1996-12-31'")
    ),
    "applications_by_region_status_bitmaps": _clean_query(MARTS["applications_by_region_status"]),
    "batch_job_outputs": _clean_query(_OUTPUT_COUNTS),
    "batch_job_versions": _clean_query(f"SELECT 2 AS version, *, (SELECT count(*) FROM f_clean) AS clean_rows FROM ({_OUTPUT_COUNTS}) o"),
    "batch_job_clean_applications": _clean_query("SELECT * FROM f_clean"),
    **{f"batch_job_{name}": _clean_query(query) for name, query in MARTS.items()},
    "parse_events": _event_query(
        """SELECT topic, "partition", "offset", j->>'$.application_id' AS application_id,
             j->>'$.customer.customer_id' AS customer_id, cast(j->>'$.loan.amount' AS int) AS loan_amount,
             cast(j->>'$.scoring.score' AS int) AS credit_score,
             CASE WHEN json_type(j->'$.documents') = 'ARRAY'
               THEN cast(json_array_length(j->'$.documents') AS int) END AS document_count
           FROM f_parsed""",
        with_documents=False,
    ),
    "explode_documents": _event_query(
        """SELECT j->>'$.application_id' AS application_id, d->>'$.type' AS document_type,
             d->>'$.status' AS document_status FROM f_documents"""
    ),
    "flatten_events": _event_query(FLAT),
    "stream_flatten": _event_query(FLAT),
    "stream_resume": _event_query(FLAT),
    "stream_bounded_drain": _event_query(FLAT),
    "stream_rebind": _event_query(FLAT),
    "stream_split": _event_query(
        """SELECT topic, "partition", "offset", 'event' AS outcome, count(*) AS row_count FROM f_documents GROUP BY ALL
           UNION ALL SELECT topic, "partition", "offset",
             CASE WHEN try_cast(value AS json) IS NULL THEN 'not JSON' ELSE 'no application id' END, 1
           FROM f_event_messages WHERE (try_cast(value AS json)->>'$.application_id') IS NULL"""
    ),
    "replay_gaps": _event_query(_GAPS),
    "event_encode": _record_query(EVENT_TEXT),
    "event_round_trip": _record_query(ROUND_TRIP),
    "payload_volume": _with(
        ("f_event_messages",),
        {},
        """SELECT topic, count(*) AS messages,
             cast(round(cast(sum(octet_length(encode(value))) / 1048576.0 AS decimal(38, 10)), 2) AS double) AS sent_mb
           FROM f_event_messages GROUP BY topic""",
    ),
    "risk_band": _record_query(f"SELECT row_number, credit_score, {_BAND} AS risk_level FROM f_event_records"),
    "decision_allowed": _record_query(
        f"SELECT row_number, credit_score, decision_status, {_ALLOWED} AS allowed FROM f_event_records"
    ),
    "padded_ids": _record_query(
        f"""SELECT {_LOAN_ID} AS loan_id, concat('app_', {_DAY_NUMBER}) AS application_id,
              concat('call_', {_DAY_NUMBER}) AS call_id FROM f_event_records"""
    ),
    "iso_utc_event_text": _call_query(f"SELECT seq, {_iso('call_time')} AS call_time_text FROM f_transactions"),
    "iso_utc_text": _record_query(f"SELECT row_number, {_ISO} AS submitted_text FROM f_event_records"),
    "decision_rule_violations": _clean_query(
        f"""SELECT application_id, {_BROKEN_NAMES} AS violated_rules FROM f_clean
            WHERE {_BROKEN_NAMES} <> ''"""
    ),
    "decision_rule_counts": _clean_query(_RULE_COUNTS),
    "decision_rule_counts_written": _clean_query(_RULE_COUNTS),
    "transactions_response_rule": _call_query(
        """SELECT seq, call_status, CASE WHEN call_status = 'answered' THEN client_response ELSE 'unknown' END
             AS client_response FROM f_transactions"""
    ),
    "transactions_snapshot": _call_query(UPSERTED),
    "transactions_snapshot_csv": _call_query(
        f"""SELECT * REPLACE (duration_sec + CASE WHEN duration_sec % 3 = 0 THEN 3000000000 ELSE 0 END AS duration_sec)
            FROM ({UPSERTED}) b"""
    ),
    "transactions_upsert": _call_query(UPSERTED),
    "transactions_upsert_wide": _with(("f_transactions_wide",), {}, _latest("true", "f_transactions_wide")),
    "transactions_upsert_buckets": _with(("f_transactions_wide",), {}, _latest("true", "f_transactions_wide")),
    "transactions_upsert_report": _with(
        ("f_transactions_wide",),
        {"f_base": _WIDE_BASE},
        f"""SELECT 'inserted' AS what, count(*) AS row_count FROM {_WIDE_CHANGES} c WHERE call_id NOT IN (SELECT call_id FROM f_base)
            UNION ALL SELECT 'replaced', count(*) FROM {_WIDE_CHANGES} c WHERE call_id IN (SELECT call_id FROM f_base)
            UNION ALL SELECT 'kept', count(*) FROM f_base WHERE call_id NOT IN (SELECT call_id FROM {_WIDE_CHANGES} c)
            UNION ALL SELECT 'without_key', 0""",
    ),
    "transactions_upsert_rules": _with(
        ("f_transactions_wide",),
        {"f_base": _WIDE_BASE, "f_changes": "SELECT * REPLACE (duration_sec - 100 AS duration_sec) FROM f_transactions_wide WHERE batch_no = 1"},
        " UNION ALL ".join(
            f"SELECT '{c}_is_null' AS rule, count(*) AS violations FROM f_changes WHERE {c} IS NULL" for c in TRANSACTION_COLUMNS
        )
        + """ UNION ALL SELECT 'duration_out_of_range', count(*) FROM f_changes WHERE duration_sec NOT BETWEEN 0 AND 4294967295
             UNION ALL SELECT 'rows_of_the_table', count(*) FROM f_base""",
    ),
    "transactions_upsert_keys": _with(
        ("f_transactions_wide",),
        {},
        f"""SELECT call_id, count(*) AS row_count FROM ({_latest("true", "f_transactions_wide")}) t
            GROUP BY call_id HAVING count(*) > 1""",
    ),
    "transactions_upsert_rows": _call_query(
        f"""{UPSERTED} AND call_id NOT IN ('call_20260501_001', 'call_20260501_002')
            UNION ALL SELECT * FROM (VALUES
              ('call_20260501_001', TIMESTAMP '2026-05-01 11:42:15', 'client_4412', 'DE-HE', 'credit_card_offer',
               'answered', 'interested', cast(184 AS bigint), true),
              ('call_20260501_002', TIMESTAMP '2026-05-01 12:04:31', 'client_1187', 'DE-BE', 'cash_loan_offer',
               'answered', 'not_interested', cast(73 AS bigint), false)) v"""
    ),
    "transactions_pk_violations": _call_query(
        "SELECT call_id, count(*) AS row_count FROM f_transactions GROUP BY call_id HAVING count(*) > 1"
    ),
    "transactions_not_null": _call_query(
        f"SELECT seq, call_id, {_NULL_NAMES} AS null_columns FROM f_transactions WHERE {_ANY_NULL}"
    ),
    "transactions_valid": _call_query(
        f"SELECT seq, {_CALL_COLUMNS} FROM f_transactions WHERE NOT ({_ANY_NULL})"
    ),
    "transactions_duration_range": _call_query(
        """SELECT seq, duration_sec - 100 AS duration_sec FROM f_transactions
           WHERE duration_sec - 100 < 0 OR duration_sec - 100 > 4294967295"""
    ),
}
