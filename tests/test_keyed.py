from __future__ import annotations

import random
from datetime import datetime

import pytest

from creditweave.operators import keyed
from creditweave.operators.keyed import (
    key_violations,
    latest_per_key,
    merge_upsert,
    split_not_null,
    uint32_violations,
    upsert,
)
from tests.plans import optimized, physical

BASE = "id string, value string, seq int"
CHANGES = "id string, value string, seq int, batch_no int"


def brute_upsert(base, changes):
    table = {row[0]: row for row in base}
    for change in sorted(changes, key=lambda c: (c[3], c[2])):
        table[change[0]] = change[:3]
    return sorted(table.values())


def generated(hot_share: float):
    rng = random.Random(3)
    base = [(f"k{i}", f"base{i}", 0) for i in range(400)]
    changes = [
        ("hot" if rng.random() < hot_share else f"k{rng.randint(200, 600)}", f"change{i}", i, rng.randint(0, 1))
        for i in range(3000)
    ]
    return base, changes


@pytest.mark.parametrize("hot_share", [0.0, 0.4])
@pytest.mark.parametrize("threshold", ["10MB", "-1"], ids=["broadcast", "shuffled"])
def test_upsert_as_a_loop_would(spark, hot_share, threshold):
    base, changes = generated(hot_share)
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in settings:
        spark.conf.set(name, threshold)
    try:
        result = upsert(
            spark.createDataFrame(base, BASE),
            spark.createDataFrame(changes, CHANGES).repartition(7),
            ["id"],
            ["batch_no", "seq"],
        )
        assert sorted(tuple(r) for r in result.collect()) == brute_upsert(base, changes)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_upsert_replaces_whole_rows(spark):
    base = spark.createDataFrame([("a", "old", 1), ("b", "kept", 1)], BASE)
    changes = spark.createDataFrame([("a", None, None), ("c", "new", 2)], BASE)
    assert sorted(map(tuple, upsert(base, changes, ["id"]).collect()), key=str) == [
        ("a", None, None), ("b", "kept", 1), ("c", "new", 2),
    ]


def test_upsert_without_order_keeps_the_key(spark):
    base = spark.createDataFrame([("a", "old", 1), ("b", "kept", 1)], BASE)
    changes = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), (None, "lost", 9)], BASE)
    assert sorted(map(tuple, upsert(base, changes, ["id"]).collect())) == [("a", "y", 1), ("b", "kept", 1)]
    _, violating = split_not_null(changes, ["id"])
    assert [r.value for r in violating.collect()] == ["lost"]


def test_columns_without_an_order_break_ties(spark):
    ddl = "id string, seq int, inner struct<m: map<string, int>>, list array<map<string, int>>"
    rows = [("a", 1, ({"k": i},), [{"z": i}]) for i in range(20)]
    picked = {
        str(latest_per_key(spark.createDataFrame(rows[::step], ddl).repartition(parts), ["id"], ["seq"]).first().inner)
        for step in (1, -1) for parts in (1, 5)
    }
    assert len(picked) == 1


def test_upsert_with_two_key_columns(spark):
    ddl = "a int, b string, v int"
    base = spark.createDataFrame([(1, "x", 0), (1, "y", 0), (2, "x", 0)], ddl)
    changes = spark.createDataFrame([(1, "y", 9), (3, "z", 9)], ddl)
    result = sorted(map(tuple, upsert(base, changes, ["a", "b"]).collect()))
    assert result == [(1, "x", 0), (1, "y", 9), (2, "x", 0), (3, "z", 9)]


def test_first_batch_and_empty_changes(spark):
    rows, none = [("a", "x", 1)], spark.createDataFrame([], BASE)
    filled = spark.createDataFrame(rows, BASE)
    assert [tuple(r) for r in upsert(none, filled, ["id"]).collect()] == rows
    assert [tuple(r) for r in upsert(filled, none, ["id"]).collect()] == rows


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("a", f"v{i}", 1) for i in range(50)]
    picked = {
        latest_per_key(spark.createDataFrame(rows[::step], BASE).repartition(parts), ["id"], ["seq"]).first().value
        for step in (1, -1) for parts in (1, 5)
    }
    assert picked == {"v9"}


def test_latest_cuts_rows_before_the_shuffle(spark):
    rows = spark.createDataFrame([("a", "x", 1)], BASE)
    plan = physical(latest_per_key(rows, ["id"], ["seq"]))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_upsert_only_moves_keys_against_the_base(spark, tmp_path):
    base, changes = generated(0.1)
    spark.createDataFrame(base, BASE).write.parquet(str(tmp_path / "base"))
    spark.createDataFrame(changes, CHANGES).write.parquet(str(tmp_path / "changes"))
    result = upsert(
        spark.read.parquet(str(tmp_path / "base")), spark.read.parquet(str(tmp_path / "changes")),
        ["id"], ["batch_no", "seq"],
    )
    plan = physical(result)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Join LeftAnti" in optimized(result)


def test_shuffled_upsert_moves_each_side_once(spark, tmp_path):
    base, changes = generated(0.1)
    spark.createDataFrame(base, BASE).write.parquet(str(tmp_path / "base"))
    spark.createDataFrame(changes, CHANGES).write.parquet(str(tmp_path / "changes"))
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in settings:
        spark.conf.set(name, "-1")
    try:
        left, right = spark.read.parquet(str(tmp_path / "base")), spark.read.parquet(str(tmp_path / "changes"))
        plan = physical(upsert(left, right, ["id"], ["batch_no", "seq"]))
        # The base, the changed keys, and the newest change of each key.
        assert plan.count("Exchange hashpartitioning") == 3 and "LeftAnti" in plan
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_key_violations(spark):
    rows = spark.createDataFrame([("a", "", 0)] * 3 + [("b", "", 0)] + [(None, "", 0)] * 2, BASE)
    assert sorted(map(tuple, key_violations(rows, ["id"]).collect()), key=str) == [("a", 3), (None, 2)]


def test_split_not_null(spark):
    rows = spark.createDataFrame([("a", "x", 1), (None, None, 1), ("c", "x", None)], BASE)
    valid, violating = split_not_null(rows, ["id", "value", "seq"])
    assert [r.id for r in valid.collect()] == ["a"]
    assert sorted(r.null_columns for r in violating.collect()) == [["id", "value"], ["seq"]]


def test_uint32_range(spark):
    rows = spark.range(1).selectExpr("explode(array(-1L, 0L, 4294967295L, 4294967296L, null)) AS n")
    assert sorted(r.n for r in uint32_violations(rows, "n").collect()) == [-1, 4294967296]
    assert keyed.MAX_UINT32 == 2**32 - 1


def test_timestamp_order(spark):
    ddl = "id string, at timestamp"
    rows = spark.createDataFrame([("a", datetime(2026, 5, 1)), ("a", datetime(2026, 5, 2)), ("a", None)], ddl)
    assert latest_per_key(rows, ["id"], ["at"]).first()["at"] == datetime(2026, 5, 2)


def test_merge_is_left_to_the_table_format(spark, tmp_path):
    """A plain Parquet table has no row changes; Spark refuses the statement, with the names resolved."""
    spark.sql(f"CREATE TABLE calls_plain (id string, value string, seq int) USING parquet LOCATION '{tmp_path}/t'")
    try:
        changes = spark.createDataFrame([("a", "x", 1, 0)], CHANGES)
        with pytest.raises(Exception, match="MERGE"):
            merge_upsert("calls_plain", changes, ["id"], ["batch_no", "seq"])
    finally:
        spark.sql("DROP TABLE calls_plain")
