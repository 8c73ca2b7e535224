"""One registered query for each operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import view
from creditweave import functions as fn
from creditweave.fs import Folder
from creditweave.operators import applications, events, keyed, marts, partials, replay, rules, volume
from creditweave.operators.watch import RuleViolation
from creditweave.plans.batch import batch_record, publish_batch, read_output, run_batch
from creditweave.schemas import CLEAN_APPLICATIONS, TRANSACTION_COLUMNS, TRANSACTION_KEY, TRANSACTIONS_DDL
from creditweave.session import scratch_dir, use_utc
from creditweave.sinks import to_messages, write_snapshot, write_table
from creditweave.sources import read_snapshot, read_source, stream_messages
from creditweave.streaming import await_query, read_events, read_rejects, start_flatten, start_split
from creditweave.tables import add_delivery, compact, create_buckets, number_values, read_buckets, read_mart, upsert_buckets

Query = Callable[[SparkSession, str], DataFrame]

TOPIC = "loan_applications"
ORDER = ("batch_no", "seq")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "f_applications_raw")


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applications.clean_applications(_raw(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = view(spark, sf_dir, "f_event_messages")
    return messages.withColumns(
        {"timestamp": F.col("timestamp").cast("timestamp"), "value": F.col("value").cast("binary")}
    )


def _calls(spark: SparkSession, sf_dir: str, name: str = "f_transactions") -> DataFrame:
    calls = view(spark, sf_dir, name)
    return calls.withColumn("call_time", F.col("call_time").cast("timestamp"))


def _call_table(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Base table (one row per key) and change set of the calls."""
    base = keyed.latest_per_key(calls.filter("batch_no = 0"), TRANSACTION_KEY, ORDER)
    return base.select(*TRANSACTION_COLUMNS), calls.filter("batch_no = 1")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    def document(which: str):
        return F.struct(
            F.col(f"{which}_type").alias("type"), F.col(f"{which}_status").alias("status")
        )

    both = F.array(document("first"), document("second"))
    records = view(spark, sf_dir, "f_event_records")
    return records.select(
        fn.padded_id("loan", F.col("row_number")).alias("application_id"),
        "customer_id",
        "region_code",
        "loan_amount",
        "term_months",
        "credit_score",
        fn.risk_band(F.col("credit_score")).alias("risk_level"),
        F.filter(both, lambda d: d["type"].isNotNull()).alias("documents"),
        "decision_status",
        F.col("submitted_at").cast("timestamp").alias("submitted_at"),
    )


# --- sources ---------------------------------------------------------------------------------


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    _raw(spark, sf_dir).write.options(header=True, escape='"').csv(path)
    return read_source(spark, path, "csv")


def scan_csv_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory of three deliveries: all columns, the same in another order, and some of them with one more."""
    path, raw = scratch_dir(spark, "csv-mixed"), _raw(spark, sf_dir)
    part = F.pmod(F.crc32(F.col("customer_id").cast("binary")), F.lit(3))
    short = [c for c in raw.columns if c not in ("channel", "term_months")]
    for k, columns in enumerate((raw.columns, raw.columns[::-1], [*short[3:], *short[:3]])):
        rows = raw.filter(part == k).select(*columns, *([F.lit("b,2").alias("note")] if k == 2 else []))
        rows.write.mode("append").options(header=True, escape='"').csv(path)
    return read_source(spark, path, "csv")


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet")
    write_table(_raw(spark, sf_dir), path)
    return read_source(spark, path, "parquet")


def transactions_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches: the table after the upsert, exported and read back."""
    path = scratch_dir(spark, "snapshot")
    write_snapshot(transactions_upsert(spark, sf_dir), path)
    return read_snapshot(spark, path)


def transactions_snapshot_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as CSV: times in three ISO spellings, numbers of the whole unsigned range in four."""
    table = transactions_upsert(spark, sf_dir)
    number = F.col("duration_sec") + F.when(F.col("duration_sec") % 3 == 0, 3_000_000_000).otherwise(0)
    plain, turn = number.cast("string"), F.col("duration_sec") % 4
    numbers = F.when(turn == 0, plain).when(turn == 1, F.concat(F.lit(" "), plain)).when(turn == 2, F.concat(plain, F.lit(".0"))).otherwise(F.concat(F.lit("+0"), plain))
    exact = F.date_format("call_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    times = F.when(turn == 0, F.col("call_time").cast("string")).when(turn == 1, fn.iso_utc(F.col("call_time"))).otherwise(exact)
    path = scratch_dir(spark, "snapshot-csv")
    table.withColumns({"call_time": times, "duration_sec": numbers}).write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False).csv(path)
    return read_snapshot(spark, path, "csv")


# --- casts and cleaning ----------------------------------------------------------------------


def cast_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "f_number_text")
    return rows.withColumn("number", fn.int_from_text(F.col("number_text")))


def cast_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "f_boolean_text")
    return rows.withColumn("flag", fn.boolean_from_text(F.col("flag_text")))


def parse_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "f_time_text")
    return rows.withColumn("event_time", fn.timestamp_from_text(F.col("time_text")))


def parse_iso_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "f_time_text")
    return rows.withColumn("submitted_at", fn.iso_timestamp(F.col("time_text")))


# --- batch job -------------------------------------------------------------------------------


_JOBS: dict[tuple[str, str, str], dict[str, str]] = {}


def _job(spark: SparkSession, sf_dir: str, source_format: str) -> dict[str, str]:
    """The outputs of one run of the job, shared by all queries of a session that read them."""
    run = (spark.sparkContext.applicationId, sf_dir, source_format)
    if run not in _JOBS:
        source, root = scratch_dir(spark, "job-in"), scratch_dir(spark, "job-out")
        if source_format == "csv":
            _raw(spark, sf_dir).write.options(header=True, escape='"').csv(source)
        else:
            write_table(_raw(spark, sf_dir), source)
        _JOBS[run] = run_batch(spark, source, f"{root}/", source_format)
    return _JOBS[run]


def batch_job_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in each of the five outputs of the job, run on a CSV directory."""
    paths = _job(spark, sf_dir, "csv")
    counted = [
        spark.read.parquet(path).agg(F.lit(name).alias("output"), F.count("*").alias("row_count"))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def batch_job_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in each output of the newest version, after a run that broke its limits midway changed nothing."""
    source, root = scratch_dir(spark, "job-in"), scratch_dir(spark, "job-versions")
    write_table(_raw(spark, sf_dir), source)
    publish_batch(spark, source, root, "parquet")
    try:
        publish_batch(spark, source, root, "parquet", limits={"decision_fits_score": 0})
    except RuleViolation:
        publish_batch(spark, source, root, "parquet", limits={"rejected_amount_is_zero": 1 << 62})
    record = batch_record(spark, root)
    counted = [
        read_output(spark, root, name).agg(
            F.lit(2).alias("version"), F.lit(name).alias("output"), F.count("*").alias("row_count"), F.lit(record["rows"]).cast("long").alias("clean_rows")
        )
        for name in record["outputs"]
    ]
    return reduce(DataFrame.unionAll, counted)


def decision_rule_counts_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each rule as the job counted them while it wrote the clean table."""
    source, root = scratch_dir(spark, "job-in"), scratch_dir(spark, "job-rules")
    write_table(_raw(spark, sf_dir), source)
    publish_batch(spark, source, root, "parquet")
    return spark.createDataFrame(list(batch_record(spark, root)["violations"].items()), "rule string, violations bigint")


def batch_job_mart(name: str) -> Query:
    """A mart as the job leaves it, run on a Parquet input and read back."""

    return lambda spark, sf_dir: spark.read.parquet(_job(spark, sf_dir, "parquet")[name])


_STATES: dict[tuple[str, str], str] = {}


def _mart_state(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the marts' state after three deliveries, the first two merged before the third; one for all its queries."""
    run = (spark.sparkContext.applicationId, sf_dir)
    if run not in _STATES:
        stored, root = scratch_dir(spark, "clean"), scratch_dir(spark, "mart-state")
        write_table(_clean(spark, sf_dir), stored)
        clean = spark.read.schema(CLEAN_APPLICATIONS).parquet(stored)
        part = F.pmod(F.xxhash64("application_id"), F.lit(3))
        for k in (0, 1):
            add_delivery(clean.filter(part == k), root, f"delivery {k}")
        compact(spark, root)
        for _ in range(2):  # the second time it is known already
            add_delivery(clean.filter(part == 2), root, "delivery 2")
        _STATES[run] = root
    return _STATES[run]


def merged_mart(name: str) -> Query:
    """A mart from the merged state of several deliveries."""

    return lambda spark, sf_dir: read_mart(spark, _mart_state(spark, sf_dir), name)


def merged_mart_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region and decision mart over the days of three years, from the same state."""
    return read_mart(spark, _mart_state(spark, sf_dir), "applications_by_region_status", "1994-01-01", "1996-12-31")


def applications_by_region_status_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart over clean rows that were stored with their customers' numbers."""
    stored, clean = scratch_dir(spark, "numbered"), _clean(spark, sf_dir)
    numbers = number_values(clean.select("customer_id"), scratch_dir(spark, "customers"))
    write_table(partials.with_numbers(clean, numbers), stored)
    return partials.region_status_by_bitmaps(spark.read.parquet(stored))


def mart(name: str) -> Query:
    return lambda spark, sf_dir: marts.MARTS[name](_clean(spark, sf_dir))


# --- events ----------------------------------------------------------------------------------


def parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = F.col("documents")
    return events.parse_events(_messages(spark, sf_dir)).select(
        "topic",
        "partition",
        "offset",
        "application_id",
        F.col("customer.customer_id").alias("customer_id"),
        F.col("loan.amount").alias("loan_amount"),
        F.col("scoring.score").alias("credit_score"),
        F.when(documents.isNotNull(), F.size(documents)).alias("document_count"),
    )


def explode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events.explode_documents(events.parse_events(_messages(spark, sf_dir)))
    return rows.select(
        "application_id",
        F.col("document.type").alias("document_type"),
        F.col("document.status").alias("document_status"),
    )


def flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.flatten_events(_messages(spark, sf_dir))


def stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages through a real stream: Parquet archive, drain, Parquet sink, read back."""
    archive, run = scratch_dir(spark, "archive"), scratch_dir(spark, "stream")
    write_table(_messages(spark, sf_dir), archive)
    await_query(start_flatten(stream_messages(spark, archive), f"{run}/out", f"{run}/checkpoint"))
    return spark.read.parquet(f"{run}/out")


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages arrive in two deliveries; the second drain resumes from the checkpoint."""
    archive, run = scratch_dir(spark, "archive"), scratch_dir(spark, "stream")
    messages = _messages(spark, sf_dir)
    first = F.col("partition") == 0
    for delivery in (messages.filter(first), messages.filter(~first)):
        delivery.write.mode("append").parquet(archive)
        await_query(start_flatten(stream_messages(spark, archive), f"{run}/out", f"{run}/checkpoint"))
    return spark.read.parquet(f"{run}/out")


def stream_bounded_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drain that its time limit stops again and again, each run going on where the last one ended."""
    archive, run = scratch_dir(spark, "archive"), scratch_dir(spark, "stream")
    for part in range(3):
        _messages(spark, sf_dir).filter(F.col("partition") == part).write.mode("append").parquet(archive)
    while not await_query(start_flatten(stream_messages(spark, archive, max_files_per_trigger=1), f"{run}/out", f"{run}/checkpoint"), 0.5):
        pass
    return spark.read.parquet(f"{run}/out")


def stream_rebind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A used checkpoint is refused on another stream's output; the right pair then goes on."""
    archive, run = scratch_dir(spark, "archive"), scratch_dir(spark, "stream")
    messages = _messages(spark, sf_dir)
    first = F.col("partition") == 0
    messages.filter(first).write.parquet(archive)
    for name in ("a", "b"):
        await_query(start_flatten(stream_messages(spark, archive), f"{run}/out-{name}", f"{run}/checkpoint-{name}"))
    messages.filter(~first).write.mode("append").parquet(archive)
    try:
        start_flatten(stream_messages(spark, archive), f"{run}/out-a", f"{run}/checkpoint-b")
    except ValueError:
        await_query(start_flatten(stream_messages(spark, archive), f"{run}/out-a", f"{run}/checkpoint-a"))
    return spark.read.parquet(f"{run}/out-a")


def stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every message: events and rejects of a stream whose first batch is run again after a lost commit."""
    archive, run = scratch_dir(spark, "archive"), scratch_dir(spark, "stream")
    whole = scratch_dir(spark, "messages")
    write_table(_messages(spark, sf_dir), whole)
    messages, first = spark.read.parquet(whole), F.col("partition") == 0
    for delivery in (messages.filter(first), messages.filter(~first)):
        delivery.write.mode("append").parquet(archive)
        await_query(start_split(stream_messages(spark, archive), f"{run}/out", f"{run}/checkpoint"))
        for commit in ("commits/0", "commits/.0.crc"):
            Folder(spark, f"{run}/checkpoint").delete(commit)
    await_query(start_split(stream_messages(spark, archive), f"{run}/out", f"{run}/checkpoint"))
    position = ("topic", "partition", "offset")
    found = read_events(spark, f"{run}/out").groupBy(*position).agg(F.lit("event").alias("outcome"), F.count("*").alias("row_count"))
    lost = read_rejects(spark, f"{run}/out").select(*position, "reason", F.lit(1).cast("bigint"))
    return found.unionAll(lost)


def replay_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay that lost two ranges of a partition, doubled another one, and holds one that the first run had lost."""
    archive, run = scratch_dir(spark, "archive"), scratch_dir(spark, "stream")
    write_table(_messages(spark, sf_dir), archive)
    await_query(start_flatten(stream_messages(spark, archive), f"{run}/out", f"{run}/checkpoint"))
    flat, hundred = spark.read.parquet(f"{run}/out"), F.floor(F.col("offset") / 100)
    outputs = {
        "first": flat.filter((F.col("partition") != 2) | (hundred != 7)),
        "again": flat.filter((F.col("partition") != 0) | ~hundred.isin(3, 4, 9)).unionAll(flat.filter((F.col("partition") == 1) & hundred.isin(5, 12))),
    }
    for name, rows in outputs.items():
        write_table(rows, f"{run}/{name}")
    return replay.compare_outputs(*[spark.read.parquet(f"{run}/{name}") for name in outputs], block=256)


def event_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages(_records(spark, sf_dir), TOPIC)


def event_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded messages flattened again."""
    sent = to_messages(_records(spark, sf_dir), TOPIC).withColumns(
        {
            "partition": F.lit(0),
            "offset": F.substring_index("key", "_", -1).cast("bigint"),
            "timestamp": F.lit("2026-05-01 00:00:00").cast("timestamp"),
        }
    )
    return events.flatten_events(sent).drop("topic", "partition", "kafka_timestamp")


def payload_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume.payload_volume(_messages(spark, sf_dir))


# --- scoring and text ------------------------------------------------------------------------


def risk_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "f_event_records").select(
        "row_number", "credit_score", fn.risk_band(F.col("credit_score")).alias("risk_level")
    )


def decision_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = fn.decision_allowed(F.col("credit_score"), F.col("decision_status"))
    return view(spark, sf_dir, "f_event_records").select(
        "row_number", "credit_score", "decision_status", allowed.alias("allowed")
    )


def padded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, day = F.col("row_number"), F.col("submitted_at")
    return view(spark, sf_dir, "f_event_records").select(
        fn.padded_id("loan", number).alias("loan_id"),
        fn.dated_id("app", day, number).alias("application_id"),
        fn.dated_id("call", day, number).alias("call_id"),
    )


def iso_utc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    moment = F.col("submitted_at").cast("timestamp")
    return view(spark, sf_dir, "f_event_records").select(
        "row_number", fn.iso_utc(moment).alias("submitted_text")
    )


def iso_utc_event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls(spark, sf_dir).select("seq", fn.iso_utc(F.col("call_time")).alias("call_time_text"))


# --- row rules -------------------------------------------------------------------------------


def decision_rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = rules.decision_violations(_clean(spark, sf_dir))
    return broken.select(
        "application_id", F.array_join("violated_rules", ",").alias("violated_rules")
    )


def decision_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.count_violations(_clean(spark, sf_dir))


def transactions_response_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_response_rule(_calls(spark, sf_dir)).select(
        "seq", "call_status", "client_response"
    )


# --- keyed table -----------------------------------------------------------------------------


def transactions_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, changes = _call_table(_calls(spark, sf_dir))
    return keyed.upsert(base, changes, TRANSACTION_KEY, ORDER)


def transactions_upsert_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that grow with the data."""
    base, changes = _call_table(_calls(spark, sf_dir, "f_transactions_wide"))
    return keyed.upsert(base, changes, TRANSACTION_KEY, ORDER)


BUCKETS = 16


def _bucket_table(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Folder of a table of the first batch in buckets, and the change set."""
    calls = _calls(spark, sf_dir, "f_transactions_wide")
    path = scratch_dir(spark, "buckets")
    create_buckets(calls.filter("batch_no = 0").select(*TRANSACTION_COLUMNS, *ORDER), path, TRANSACTION_KEY, BUCKETS, ORDER)
    return path, calls.filter("batch_no = 1")


def transactions_upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both batches in a table of buckets: the second one in three upserts, each by a third of its calls in turn."""
    path, changes = _bucket_table(spark, sf_dir)
    third = F.pmod(F.floor(F.col("seq") / 3), F.lit(3))
    for k in range(3):
        upsert_buckets(spark, path, changes.filter(third == k), ORDER)
    return read_buckets(spark, path)


def transactions_upsert_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the writing jobs counted: rows inserted and replaced, changes without a value, by version."""
    path, changes = _bucket_table(spark, sf_dir)
    report = upsert_buckets(spark, path, changes, ORDER)
    rows = [("inserted", report.inserted), ("replaced", report.replaced), ("kept", report.kept), ("without_key", report.without_key)]
    return spark.createDataFrame(rows, "what string, row_count bigint")


def transactions_upsert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations that stop an upsert, as the job that writes the changes counts them; the table stays as it was."""
    path, changes = _bucket_table(spark, sf_dir)
    shifted = changes.withColumn("duration_sec", F.col("duration_sec") - 100)
    try:
        upsert_buckets(spark, path, shifted, ORDER, keyed.call_rules())
    except RuleViolation as refused:
        counts = {**refused.counts, "rows_of_the_table": read_buckets(spark, path).count()}
        return spark.createDataFrame(list(counts.items()), "rule string, violations bigint")
    raise AssertionError("the changes break rules")


def transactions_upsert_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that the upserted table holds more than once: none, even without an order of the changes."""
    base, changes = _call_table(_calls(spark, sf_dir, "f_transactions_wide"))
    return keyed.key_violations(keyed.upsert(base, changes, TRANSACTION_KEY), TRANSACTION_KEY)


# The two sample rows of the call table.
SAMPLE_CALLS = (
    ("call_20260501_001", "2026-05-01 11:42:15", "client_4412", "DE-HE", "credit_card_offer",
     "answered", "interested", 184, True),
    ("call_20260501_002", "2026-05-01 12:04:31", "client_1187", "DE-BE", "cash_loan_offer",
     "answered", "not_interested", 73, False),
)


def transactions_upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal rows as a change set."""
    base = keyed.latest_per_key(_calls(spark, sf_dir), TRANSACTION_KEY, ORDER).select(*TRANSACTION_COLUMNS)
    text_times = TRANSACTIONS_DDL.replace("call_time timestamp", "call_time string")
    rows = spark.createDataFrame(list(SAMPLE_CALLS), text_times)
    rows = rows.withColumn("call_time", F.col("call_time").cast("timestamp"))
    return keyed.upsert(base, rows, TRANSACTION_KEY)


def transactions_pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.key_violations(_calls(spark, sf_dir), TRANSACTION_KEY)


def transactions_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, violating = keyed.split_not_null(_calls(spark, sf_dir), TRANSACTION_COLUMNS)
    return violating.select("seq", "call_id", F.array_join("null_columns", ",").alias("null_columns"))


def transactions_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = keyed.split_not_null(_calls(spark, sf_dir), TRANSACTION_COLUMNS)
    return valid.select("seq", *TRANSACTION_COLUMNS)


def transactions_duration_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls whose duration, shifted so that some fall below zero, leaves the unsigned range."""
    shifted = _calls(spark, sf_dir).withColumn("duration_sec", F.col("duration_sec") - 100)
    return keyed.uint32_violations(shifted, "duration_sec").select("seq", "duration_sec")


QUERIES: dict[str, Query] = {
    "scan_csv": scan_csv,
    "scan_csv_mixed": scan_csv_mixed,
    "scan_parquet": scan_parquet,
    "clean_applications": _clean,
    "cast_ints": cast_ints,
    "cast_bool": cast_bool,
    "parse_event_time": parse_event_time,
    "parse_iso_time": parse_iso_time,
    **{name: mart(name) for name in marts.MARTS},
    **{f"merged_{name}": merged_mart(name) for name in marts.MARTS},
    "merged_mart_of_days": merged_mart_of_days,
    "applications_by_region_status_bitmaps": applications_by_region_status_bitmaps,
    "batch_job_outputs": batch_job_outputs,
    "batch_job_versions": batch_job_versions,
    "decision_rule_counts_written": decision_rule_counts_written,
    **{f"batch_job_{name}": batch_job_mart(name) for name in ("clean_applications", *marts.MARTS)},
    "parse_events": parse_events,
    "explode_documents": explode_documents,
    "flatten_events": flatten_events,
    "stream_flatten": stream_flatten,
    "stream_resume": stream_resume,
    "stream_bounded_drain": stream_bounded_drain,
    "stream_rebind": stream_rebind,
    "stream_split": stream_split,
    "replay_gaps": replay_gaps,
    "event_encode": event_encode,
    "event_round_trip": event_round_trip,
    "payload_volume": payload_volume,
    "risk_band": risk_band,
    "decision_allowed": decision_allowed,
    "padded_ids": padded_ids,
    "iso_utc_text": iso_utc_text,
    "iso_utc_event_text": iso_utc_event_text,
    "decision_rule_violations": decision_rule_violations,
    "decision_rule_counts": decision_rule_counts,
    "transactions_response_rule": transactions_response_rule,
    "transactions_snapshot": transactions_snapshot,
    "transactions_snapshot_csv": transactions_snapshot_csv,
    "transactions_upsert": transactions_upsert,
    "transactions_upsert_wide": transactions_upsert_wide,
    "transactions_upsert_buckets": transactions_upsert_buckets,
    "transactions_upsert_report": transactions_upsert_report,
    "transactions_upsert_rules": transactions_upsert_rules,
    "transactions_upsert_keys": transactions_upsert_keys,
    "transactions_upsert_rows": transactions_upsert_rows,
    "transactions_pk_violations": transactions_pk_violations,
    "transactions_not_null": transactions_not_null,
    "transactions_valid": transactions_valid,
    "transactions_duration_range": transactions_duration_range,
}


def with_utc(query: Query) -> Query:
    return lambda spark, sf_dir: query(use_utc(spark), sf_dir)
