"""Times every registered query, and the jobs on prepared inputs. Prints one JSON line.

``queries`` holds the seconds of each registered query, from the given tables to the last row (the
view that derives the input is part of it). ``jobs`` holds the operators alone, on inputs that were
written to disk beforehand. ``comparison``, if asked for by ``BENCH_COMPARE_ROWS``, sets the plain way
to write a step beside the library's on a larger input. Each number is the best of ``BENCH_RUNS`` runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from checks import registry  # noqa: E402
from checks.registry import QUERIES, with_utc  # noqa: E402
from creditweave.operators import MARTS, clean_applications, flatten_events, upsert  # noqa: E402
from creditweave.plans import run_batch  # noqa: E402
from creditweave.schemas import CLEAN_APPLICATIONS, EVENT_PAYLOAD_DDL, TRANSACTION_KEY  # noqa: E402
from creditweave.session import scratch_dir  # noqa: E402
from creditweave.sinks import write_table  # noqa: E402
from creditweave.sources import read_messages, read_source, stream_messages  # noqa: E402
from creditweave.streaming import await_query, start_flatten  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
#: Rows of the comparison with the plain way, such as 3000000; 0 leaves it out.
COMPARE_ROWS = int(os.environ.get("BENCH_COMPARE_ROWS", "0"))


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_of(action: Callable[[], None]) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def jobs(spark: SparkSession) -> dict[str, Callable[[], None]]:
    raw, text = scratch_dir(spark, "raw"), scratch_dir(spark, "text")
    archive, calls = scratch_dir(spark, "archive"), scratch_dir(spark, "calls")
    applications = registry._raw(spark, SF_DIR).repartition(int(CPUS))
    write_table(applications, raw)
    applications.write.options(header=True, escape='"').csv(text)
    write_table(registry._messages(spark, SF_DIR).repartition(int(CPUS)), archive)
    base, changes = registry._call_table(registry._calls(spark, SF_DIR))
    write_table(base, f"{calls}/base")
    write_table(changes, f"{calls}/changes")

    def batch(keep_in_memory: bool) -> Callable[[], None]:
        return lambda: run_batch(spark, text, scratch_dir(spark, "out"), keep_in_memory=keep_in_memory) and None

    def stream() -> None:
        run = scratch_dir(spark, "stream")
        await_query(start_flatten(stream_messages(spark, archive), f"{run}/out", f"{run}/checkpoint"))

    def merge() -> None:
        tables = [spark.read.parquet(f"{calls}/{name}") for name in ("base", "changes")]
        drain(upsert(*tables, TRANSACTION_KEY, registry.ORDER))

    return {
        "batch_csv_five_outputs": batch(False),
        "batch_csv_five_outputs_cached": batch(True),
        "clean_csv": lambda: drain(clean_applications(read_source(spark, text))),
        "clean_parquet": lambda: drain(clean_applications(read_source(spark, raw, "parquet"))),
        **{
            f"mart_{name}": lambda build=build: drain(build(clean_applications(read_source(spark, raw, "parquet"))))
            for name, build in MARTS.items()
        },
        "flatten_batch": lambda: drain(flatten_events(read_messages(spark, archive))),
        "flatten_stream": stream,
        "upsert": merge,
    }


def plain_clean(raw: DataFrame) -> DataFrame:
    """The cleaning as it is usually written: casts in a projection, a filter above it."""
    whole = F.regexp_extract
    typed = raw.select(
        *[
            F.try_to_timestamp(F.col(f.name), F.lit("yyyy-MM-dd HH:mm:ss")).alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else whole(F.col(f.name), r"^\s*([+-]?[0-9]+)", 1).try_cast("int").alias(f.name)
            if isinstance(f.dataType, T.IntegerType)
            else F.col(f.name).try_cast(f.dataType).alias(f.name)
            for f in CLEAN_APPLICATIONS
        ]
    )
    return typed.filter("application_id is not null and event_time is not null and requested_amount > 0 and credit_score between 300 and 900")


def plain_flatten(messages: DataFrame) -> DataFrame:
    """The flattening with a filter over the parsed column, which the optimizer pushes below the parsing."""
    event = F.from_json(F.col("value").cast("string"), EVENT_PAYLOAD_DDL)
    rows = messages.withColumn("e", event).filter("e.application_id is not null")
    return rows.select("topic", "partition", "offset", "e.application_id", "e.customer", "e.loan", "e.scoring", "e.decision_status", F.explode_outer("e.documents").alias("d"))


def comparison(spark: SparkSession) -> dict[str, Callable[[], None]]:
    """The design's claims on a larger input: the given rows repeated to ``COMPARE_ROWS``, plain way and ours."""
    raw, archive = scratch_dir(spark, "large-raw"), scratch_dir(spark, "large-messages")
    for rows, path in ((registry._raw(spark, SF_DIR), raw), (registry._messages(spark, SF_DIR), archive)):
        times = max(1, COMPARE_ROWS // rows.count())
        many = rows.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_again")
        write_table(many.repartition(4 * int(CPUS)), path)

    def marts(clean: Callable[[DataFrame], DataFrame]) -> None:
        rows = clean(read_source(spark, raw, "parquet")).cache()
        for build in MARTS.values():
            drain(build(rows))
        rows.unpersist()

    return {
        "clean_plain": lambda: drain(plain_clean(read_source(spark, raw, "parquet"))),
        "clean_ours": lambda: drain(clean_applications(read_source(spark, raw, "parquet"))),
        "flatten_plain": lambda: drain(plain_flatten(read_messages(spark, archive))),
        "flatten_ours": lambda: drain(flatten_events(read_messages(spark, archive))),
        "marts_plain_cached": lambda: marts(plain_clean),
        "batch_ours": lambda: run_batch(spark, raw, scratch_dir(spark, "large-out"), "parquet") and None,
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("creditweave-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="creditweave-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {
        name: best_of(lambda query=query: drain(with_utc(query)(spark, SF_DIR))) for name, query in QUERIES.items()
    }
    timed_jobs = {name: best_of(action) for name, action in jobs(spark).items()}
    compared = {name: best_of(action) for name, action in comparison(spark).items()} if COMPARE_ROWS else {}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "jobs": timed_jobs,
                **({"comparison": compared, "comparison_rows": COMPARE_ROWS} if compared else {}),
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
