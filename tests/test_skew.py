"""A third of all rows under one key: results stay exact, and the key does not reach one task whole."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from creditweave.operators import MARTS, key_violations, latest_per_key, payload_volume
from creditweave.schemas import CLEAN_APPLICATIONS

ROWS = 60_000


@pytest.fixture(scope="module")
def clean(spark):
    """One customer, region, decision, risk level, channel and day hold a third of the rows."""
    n = F.col("id")
    hot = n % 3 == 0

    def spread(prefix, values):
        return F.when(hot, f"{prefix}_hot").otherwise(F.concat(F.lit(f"{prefix}_"), n % values))

    columns = {
        "application_id": F.concat(F.lit("app_"), n),
        "event_time": F.when(hot, F.lit("2026-05-01 08:00:00")).otherwise(
            F.concat(F.lit("2026-06-"), F.lpad((n % 30 + 1).cast("string"), 2, "0"), F.lit(" 09:00:00"))
        ).cast("timestamp"),
        "customer_id": F.when(hot & (n % 2 == 0), "cust_hot").otherwise(F.concat(F.lit("cust_"), n % 5000)),
        "region_code": spread("region", 7),
        "product_type": F.lit("p"),
        "requested_amount": (n % 977 + 1).cast("int"),
        "term_months": F.lit(12),
        "credit_score": (n % 601 + 300).cast("int"),
        "risk_level": spread("risk", 3),
        "decision_status": spread("decision", 3),
        "approved_amount": (n % 500).cast("int"),
        "channel": spread("channel", 4),
        "employee_review_flag": F.when(n % 5 > 0, n % 2 == 0),
        "processing_time_sec": (n % 600).cast("int"),
    }
    frame = spark.range(0, ROWS, 1, 16).select(*[c.alias(name) for name, c in columns.items()])
    assert frame.columns == CLEAN_APPLICATIONS.names
    return frame.persist()


@pytest.fixture(scope="module")
def local_rows(clean):
    return clean.collect()


def group(rows, *names):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[name] for name in names)].append(row)
    return groups


def mean(rows, name):
    known = [row[name] for row in rows if row[name] is not None]
    return sum(known) / len(known)


def test_region_status(clean, local_rows):
    result = {(r[0], r[1]): tuple(r)[2:] for r in MARTS["applications_by_region_status"](clean).collect()}
    expected = group(local_rows, "region_code", "decision_status")
    assert set(result) == set(expected)
    for key, rows in expected.items():
        count, customers, amount = result[key]
        assert (count, customers) == (len(rows), len({r.customer_id for r in rows}))
        assert amount == pytest.approx(mean(rows, "requested_amount"), abs=0.0051)


@pytest.mark.parametrize(
    ("mart", "key", "averages"),
    [
        ("risk_level_metrics", "risk_level", ["credit_score", "requested_amount", "approved_amount"]),
        ("manual_review_by_channel", "channel", []),
        ("daily_processing_metrics", "event_date", ["processing_time_sec", "credit_score"]),
    ],
)
def test_other_marts(clean, local_rows, mart, key, averages):
    result = {r[0]: r for r in MARTS[mart](clean).collect()}
    groups = group(local_rows, "event_time") if key == "event_date" else group(local_rows, key)
    expected = {(k[0].date() if key == "event_date" else k[0]): rows for k, rows in groups.items()}
    assert set(result) == set(expected)
    for value, rows in expected.items():
        assert result[value].application_count == len(rows)
        for name in averages:
            assert result[value][f"avg_{name}"] == pytest.approx(mean(rows, name), abs=0.0051)
        if mart == "manual_review_by_channel":
            flags = [r.employee_review_flag for r in rows if r.employee_review_flag is not None]
            assert result[value].manual_review_count == sum(flags)
            assert result[value].manual_review_pct == pytest.approx(100 * sum(flags) / len(flags), abs=0.0051)


def _shuffled_rows(df):
    """Records each exchange wrote, taken from the finished plan's metrics."""
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        nodes.extend(children.apply(i) for i in range(children.size()))
    return found


@pytest.mark.parametrize("mart", [m for m in MARTS if m != "applications_by_region_status"])
def test_marts_shuffle_groups_not_rows(clean, mart):
    """At most one row per input task and group crosses the aggregation's shuffle."""
    result = MARTS[mart](clean)
    groups = result.count()
    assert 0 < max(_shuffled_rows(result)) <= groups * clean.rdd.getNumPartitions()


def test_distinct_count_shuffles_each_customer_once_per_task(clean):
    result = MARTS["applications_by_region_status"](clean)
    distinct = clean.select("region_code", "decision_status", "customer_id").distinct().count()
    assert 0 < max(_shuffled_rows(result)) <= distinct * clean.rdd.getNumPartitions()


def test_latest_of_a_hot_key(clean, local_rows):
    latest = latest_per_key(clean.select("customer_id", "application_id", "processing_time_sec"),
                            ["customer_id"], ["processing_time_sec", "application_id"])
    expected = {
        key[0]: max((r.processing_time_sec, r.application_id) for r in rows)
        for key, rows in group(local_rows, "customer_id").items()
    }
    got = {r.customer_id: (r.processing_time_sec, r.application_id) for r in latest.collect()}
    assert got == expected
    assert max(_shuffled_rows(latest)) <= len(expected) * clean.rdd.getNumPartitions()


def test_key_violations_and_volume(clean, local_rows):
    counts = Counter(r.customer_id for r in local_rows)
    violations = {r.customer_id: r.row_count for r in key_violations(clean, ["customer_id"]).collect()}
    assert violations == {k: n for k, n in counts.items() if n > 1}
    sent = clean.select(F.col("channel").alias("topic"), F.col("application_id").alias("value"))
    assert {r.topic: r.messages for r in payload_volume(sent).collect()} == Counter(r.channel for r in local_rows)
