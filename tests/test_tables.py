"""Versions of an output, and the keyed table in buckets."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from creditweave.fs import Folder
from creditweave.operators.watch import RuleViolation
from creditweave.tables import CommitConflict, VersionLog, buckets, create_buckets, read_buckets, remove_old_versions, upsert_buckets
from tests.plans import physical

BASE = "id string, part int, value string, seq int"
CHANGES = f"{BASE}, batch_no int"
KEYS, ORDER = ["id", "part"], ["batch_no", "seq"]


def stored(spark, path, version=None):
    return sorted(tuple(r) for r in read_buckets(spark, path, version).collect())


def data_files(path):
    return {str(p.relative_to(path)) for p in Path(path, "data").rglob("part-*")}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = [(f"k{k}", k % 3, f"base{k}", 0) for k in range(300)]
    create_buckets(spark.createDataFrame(rows, BASE), path, KEYS, 8)
    return path, rows


def test_created_table(spark, table):
    path, rows = table
    assert stored(spark, path) == sorted(rows)
    assert read_buckets(spark, path).schema.simpleString() == "struct<id:string,part:int,value:string,seq:int>"
    with pytest.raises(ValueError, match="already"):
        create_buckets(spark.createDataFrame(rows, BASE), path, KEYS, 8)
    with pytest.raises(ValueError, match="no version"):
        read_buckets(spark, f"{path}-other")


@pytest.mark.parametrize("hot_share", [0.0, 0.4])
def test_upserts_as_a_loop_would(spark, table, hot_share):
    path, rows = table
    rng, held = random.Random(4), {r[:2]: r for r in rows}
    for turn in range(3):
        changes = []
        for k in range(700):
            key = "k7" if rng.random() < hot_share else f"k{rng.randint(200, 400)}"
            changes.append((key, rng.randint(0, 2), f"change{turn}.{k}", k, rng.randint(0, 1)))
        known, before = set(held), dict(held)
        for change in sorted(changes, key=lambda c: (c[4], c[3])):
            held[change[:2]] = change[:4]
        keys = {c[:2] for c in changes}
        # A column only used for ordering may come in any place, numbers in another width.
        frame = spark.createDataFrame(changes, CHANGES).withColumn("part", F.col("part").cast("long")).select("batch_no", "value", "seq", "part", "id").repartition(5)
        report = upsert_buckets(spark, path, frame, ORDER)
        assert (report.version, report.replaced, report.inserted) == (turn + 2, len(keys & known), len(keys - known))
        assert stored(spark, path) == sorted(held.values())
        assert stored(spark, path, turn + 1) == sorted(before.values())


def test_untouched_files_keep_their_names(spark, table):
    path, rows = table
    before = data_files(path)
    report = upsert_buckets(spark, path, spark.createDataFrame([("k1", 1, "new", 1), ("k1", 1, "newer", 2)], BASE), ["seq"])
    named = {f"data/{run}/__bucket={b}" for run, held in VersionLog(spark, path).record()["runs"].items() for b in held}
    now = {f for f in data_files(path) if str(Path(f).parent) in named}
    assert report.buckets == 1 and len(before) == 8
    assert len(before & now) == 7 and len(now - before) == 1
    assert stored(spark, path) == sorted([r for r in rows if r[0] != "k1"] + [("k1", 1, "newer", 2)])


def test_changes_of_no_effect(spark, table):
    path, rows = table
    changes = spark.createDataFrame([(None, 1, "x", 1), ("k1", None, "y", 1)], BASE)
    report = upsert_buckets(spark, path, changes)
    assert (report.version, report.buckets, report.without_key, report.inserted) == (2, 0, 2, 0)
    assert upsert_buckets(spark, path, changes.limit(0)).without_key == 0
    assert stored(spark, path) == sorted(rows)


def test_table_of_nothing(spark, tmp_path):
    path = str(tmp_path / "empty")
    create_buckets(spark.createDataFrame([], BASE), path, KEYS, 4)
    assert stored(spark, path) == []
    upsert_buckets(spark, path, spark.createDataFrame([("a", 1, "x", 1)], BASE))
    assert stored(spark, path) == [("a", 1, "x", 1)]


def test_rules_stop_the_upsert(spark, table):
    path, rows = table
    before = data_files(path)
    changes = spark.createDataFrame([("k1", 1, None, -1), ("k2", 2, "x", -2), ("k3", 0, "y", 5)], BASE)
    with pytest.raises(RuleViolation, match="value_is_null 1, negative 2") as refused:
        upsert_buckets(spark, path, changes, rules={"value_is_null": F.col("value").isNull(), "negative": F.col("seq") < 0, "other": F.col("seq") > 9})
    assert refused.value.counts == {"value_is_null": 1, "negative": 2, "other": 0}
    assert stored(spark, path) == sorted(rows) and data_files(path) == before and not list(Path(path, "_staged").iterdir())


def test_a_key_held_twice_stops_the_upsert(spark, table):
    path, rows = table
    log = VersionLog(spark, path)
    run, held = next(iter(log.record()["runs"].items()))
    again = f"{path}/data/{run}/__bucket={held[0]}"
    copy = spark.read.parquet(again).limit(1).collect()
    spark.createDataFrame(copy, BASE).write.mode("append").parquet(again)
    with pytest.raises(ValueError, match="holds 1 keys more than once"):
        upsert_buckets(spark, path, spark.createDataFrame([(*copy[0][:2], "x", 1)], BASE))
    assert log.latest() == 1


def test_a_failed_write_leaves_the_table(spark, table, monkeypatch):
    path, rows = table
    before = data_files(path)
    frame = spark.createDataFrame([("k1", 1, "x", 1)], BASE)
    with pytest.raises(Exception, match="broken input"):
        upsert_buckets(spark, path, frame.withColumn("value", F.raise_error(F.lit("broken input")).cast("string")))

    def taken(self, version, record):
        raise CommitConflict("taken")

    monkeypatch.setattr(VersionLog, "commit", taken)
    with pytest.raises(CommitConflict):
        upsert_buckets(spark, path, frame)
    assert stored(spark, path) == sorted(rows) and data_files(path) == before


def test_writers_at_once(spark, table):
    """Each of several writers takes up version 1; one of them gets version 2, the others leave nothing."""
    path, _ = table

    def write(k):
        try:
            upsert_buckets(spark, path, spark.createDataFrame([("k1", 1, f"by {k}", k)], BASE))
            return k
        except CommitConflict:
            return None

    log, first = VersionLog(spark, path), VersionLog.latest
    try:
        VersionLog.latest = lambda self: 1
        with ThreadPoolExecutor(4) as pool:
            won = [k for k in pool.map(write, range(4)) if k is not None]
    finally:
        VersionLog.latest = first
    assert len(won) == 1 and log.versions() == [1, 2]
    assert ("k1", 1, f"by {won[0]}", won[0]) in stored(spark, path)
    assert len(list(Path(path, "data").iterdir())) == 2


def test_one_claim_wins(spark, tmp_path):
    folder = Folder(spark, str(tmp_path / "claims"))
    with ThreadPoolExecutor(8) as pool:
        won = [k for k, got in enumerate(pool.map(lambda k: folder.claim("a/b.json", f"text {k}" * 1000), range(8))) if got]
    assert len(won) == 1 and folder.read("a/b.json") == f"text {won[0]}" * 1000
    assert folder.names("a") == ["b.json"] or [n for n in folder.names("a") if not n.startswith(".")] == ["b.json"]


def test_old_versions_are_removed(spark, table):
    path, rows = table
    for k in range(3):
        upsert_buckets(spark, path, spark.createDataFrame([("k1", 1, f"v{k}", k)], BASE))
    now = stored(spark, path)
    assert remove_old_versions(spark, path, keep=2) == [1, 2] and remove_old_versions(spark, path, keep=2) == []
    assert stored(spark, path) == now and ("k1", 1, "v1", 1) in stored(spark, path, 3)
    # seven buckets of the first version, the touched one of the two versions that are kept
    assert len(data_files(path)) == 9
    with pytest.raises(ValueError, match="stays"):
        remove_old_versions(spark, path, keep=0)


def test_touched_buckets_are_shuffled_once(spark, table, monkeypatch):
    """Beside the cut of the changes to one a key, rows are dealt out by bucket; the window and the files need nothing more."""
    plans = []
    real = buckets.Observation

    class Noted(real):
        def _on(self, df, *exprs):
            plans.append(physical(df))
            return super()._on(df, *exprs)

    monkeypatch.setattr(buckets, "Observation", Noted)
    path, _ = table
    upsert_buckets(spark, path, spark.createDataFrame([("k1", 1, "x", 1)], BASE))
    merge = plans[-1]
    assert merge.count("Exchange hashpartitioning") == 2 and merge.count("Exchange hashpartitioning(__bucket") == 1
    assert "WindowGroupLimit" in merge and "Join" not in merge and "Python" not in merge
