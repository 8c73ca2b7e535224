"""The stream with events and rejects, and the comparison of replays."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from creditweave.fs import Folder
from creditweave.operators import flatten_events
from creditweave.operators.replay import compare_outputs
from creditweave.schemas import MESSAGE_DDL
from creditweave.sources import stream_messages
from creditweave.streaming import await_query, read_events, read_rejects, split_messages, start_flatten, start_split
from tests.plans import physical

VALUES = ['{"application_id":"a1"}', '{"application_id":"a2","documents":[{"type":"t","status":"s"},{"type":"u"}]}', "not json", '{"x":1}', "", None, "[]", '{"application_id":""}', '{"application_id":null}', '{"appl']
REASONS = {"not json": "not JSON", '{"x":1}': "no application id", "": "not JSON", None: "no value", "[]": "no application id", '{"application_id":null}': "no application id", '{"appl': "not JSON"}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def messages(spark, values, start=0):
    made = [("t", k % 2, start + k, None if v is None else bytearray(v.encode())) for k, v in enumerate(values)]
    return spark.createDataFrame(made, "topic string, partition int, offset bigint, value binary").withColumn("timestamp", F.lit("2026-05-01").cast("timestamp")).select("topic", "partition", "offset", "timestamp", "value")


@pytest.fixture
def run(spark, tmp_path):
    archive = str(tmp_path / "archive")

    def deliver(values, start):
        messages(spark, values, start).write.mode("append").parquet(archive)

    def drain(out="out", checkpoint="checkpoint"):
        await_query(start_split(stream_messages(spark, archive), str(tmp_path / out), str(tmp_path / checkpoint)))

    deliver(VALUES, 0)
    return deliver, drain, tmp_path


def outputs(spark, root):
    return rows(read_events(spark, f"{root}/out")), rows(read_rejects(spark, f"{root}/out"))


def wanted(spark, values, start=0):
    rejects = [(r[2], REASONS[v]) for r, v in zip(messages(spark, values, start).collect(), values, strict=True) if v in REASONS]
    return rows(flatten_events(messages(spark, values, start))), rejects


def test_both_outputs(spark, run):
    _, drain, root = run
    drain()
    events, rejects = outputs(spark, root)
    flat, refused = wanted(spark, VALUES)
    assert events == flat and sorted((r[2], r[4]) for r in rejects) == refused
    assert read_events(spark, f"{root}/out").schema.simpleString() == flatten_events(messages(spark, VALUES)).schema.simpleString()
    assert {r[2]: None if r[5] is None else bytes(r[5]).decode() for r in rejects} == {k: v for k, v in enumerate(VALUES) if v in REASONS}
    positions = {(r[0], r[1], r[2]) for r in (*events, *rejects)}
    assert len(positions) == len(VALUES)


def test_batch_replayed_after_its_record(spark, run):
    deliver, drain, root = run
    drain()
    first = outputs(spark, root)
    Folder(spark, f"{root}/checkpoint").delete("commits")
    drain()
    assert outputs(spark, root) == first and len(list(Path(root, "out/parts").iterdir())) == 1
    deliver(VALUES[:3], 100)
    drain()
    assert len(outputs(spark, root)[0]) == len(first[0]) + len(wanted(spark, VALUES[:3])[0])
    assert len(outputs(spark, root)[1]) == len(first[1]) + 1


def test_batch_that_stops_before_its_record(spark, run, monkeypatch):
    _, drain, root = run

    def lost(self, name, text):
        raise OSError("lost")

    monkeypatch.setattr(Folder, "claim", lost)
    with pytest.raises(Exception, match="lost"):
        drain()
    monkeypatch.undo()
    assert outputs(spark, root) == ([], [])
    drain()
    events, rejects = outputs(spark, root)
    assert events == wanted(spark, VALUES)[0] and len(rejects) == 7
    assert len(list(Path(root, "out/parts").iterdir())) == 2  # the unfinished one is not read


def test_only_one_kind_in_a_batch(spark, run):
    deliver, drain, root = run
    drain()
    deliver(["bad", "worse"], 50)
    drain()
    deliver(VALUES[:2], 60)
    drain()
    events, rejects = outputs(spark, root)
    assert len(rejects) == 9 and {r[2] for r in events} >= {60, 61}


def test_other_pairings_are_refused(spark, run):
    _, drain, root = run
    drain()
    for pair in (("out", "new"), ("other", "checkpoint")):
        with pytest.raises(ValueError, match="another checkpoint"):
            drain(*pair)
    with pytest.raises(ValueError, match="another checkpoint"):
        start_flatten(stream_messages(spark, f"{root}/archive"), f"{root}/out", f"{root}/new")
    assert len(outputs(spark, root)[1]) == 7


def test_one_parse_and_no_shuffle(spark):
    plan = physical(split_messages(messages(spark, VALUES)))
    assert plan.count("from_json") == 1 and "Exchange" not in plan and "Python" not in plan
    assert split_messages(spark.createDataFrame([], MESSAGE_DDL)).count() == 0


def brute_ranges(first, second):
    """Runs of neighbouring messages of one outcome, in plain Python."""
    found = []
    places = {(t, p) for t, p, _ in (*first, *second)}
    for place in sorted(places):
        run = None
        for offset in sorted({o for t, p, o in (*first, *second) if (t, p) == place}):
            n0, n1 = first.count((*place, offset)), second.count((*place, offset))
            outcome = "missing" if not n1 else "extra" if not n0 else "repeated" if n1 > n0 else "partial" if n1 < n0 else "same"
            if run and run[2] == outcome:
                run[4], run[5] = offset, run[5] + 1
            else:
                run = [*place, outcome, offset, offset, 1]
                found.append(run)
    return sorted(tuple(r) for r in found if r[2] != "same")


@pytest.mark.parametrize("block", [1, 4, 1 << 16])
def test_gaps_and_repeats(spark, block):
    rng = random.Random(block)
    offsets = [("t", 0 if rng.random() < 0.7 else rng.randrange(3), o) for o in sorted(rng.sample(range(-40, 400), 180))]
    first, second = [], []
    for k, at in enumerate(offsets):
        kind = ["same", "missing", "extra", "repeated", "partial"][k // 9 % 5]
        first += [at] * {"extra": 0, "partial": 3}.get(kind, 1 + k % 2)
        second += [at] * {"missing": 0, "repeated": 4, "partial": 1}.get(kind, 1 + k % 2)
    schema = "topic string, partition int, offset bigint"
    frames = [spark.createDataFrame(side, schema).repartition(4).withColumn("block", F.lit("x")) for side in (first, second)]
    want = brute_ranges(first, second)
    assert {r[2] for r in want} == {"missing", "extra", "repeated", "partial"}
    assert rows(compare_outputs(*frames, block=block)) == sorted(want, key=repr)
    assert compare_outputs(frames[0], frames[0]).count() == 0
    assert rows(compare_outputs(frames[0].limit(0), frames[1], block=block)) == sorted(brute_ranges([], second), key=repr)


def test_reasons_are_given_for_rejects_only(spark):
    kinds = split_messages(messages(spark, VALUES)).select("kind", "reason", F.col("value").isNull().alias("bare")).distinct().collect()
    assert {(r.kind, r.reason is None) for r in kinds} == {("events", True), ("rejects", False)}
    assert json.loads(VALUES[0]) and all(r.bare for r in kinds if r.kind == "events")
