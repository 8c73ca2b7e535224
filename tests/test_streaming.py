from __future__ import annotations

import os
import time

import pytest

from checks.registry import _messages
from creditweave.operators import flatten_events
from creditweave.sources import stream_messages
from creditweave.streaming import await_query, replay_paths, start_flatten


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    return _messages(spark, sf_dir).repartition(6, "offset")


@pytest.fixture(scope="module")
def archive(messages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("archive") / "messages")
    messages.write.parquet(path)
    return path


@pytest.fixture
def run(tmp_path):
    return str(tmp_path / "flat"), str(tmp_path / "checkpoint")


def test_drain_equals_batch(spark, messages, archive, run):
    query = start_flatten(stream_messages(spark, archive), *run)
    await_query(query)
    assert not query.isActive
    assert rows(spark.read.parquet(run[0])) == rows(flatten_events(messages))


def test_drain_in_bounded_batches(spark, messages, archive, run):
    query = start_flatten(stream_messages(spark, archive, max_files_per_trigger=2), *run)
    await_query(query)
    assert query.lastProgress["batchId"] == 2
    assert rows(spark.read.parquet(run[0])) == rows(flatten_events(messages))


def test_resume_takes_only_new_messages(spark, messages, run, tmp_path):
    archive, parts = str(tmp_path / "archive"), [messages.filter(f"partition = {p}") for p in range(3)]
    expected = []
    for part in parts:
        part.write.mode("append").parquet(archive)
        await_query(start_flatten(stream_messages(spark, archive), *run))
        expected = sorted(expected + rows(flatten_events(part)), key=repr)
        assert rows(spark.read.parquet(run[0])) == expected
    await_query(start_flatten(stream_messages(spark, archive), *run))
    assert rows(spark.read.parquet(run[0])) == expected


def test_new_checkpoint_on_a_used_output_is_refused(spark, archive, run, tmp_path):
    await_query(start_flatten(stream_messages(spark, archive), *run))
    with pytest.raises(ValueError, match="another checkpoint"):
        start_flatten(stream_messages(spark, archive), run[0] + "/", str(tmp_path / "other"))


def test_used_checkpoint_on_another_output_is_refused(spark, archive, run, tmp_path):
    other = str(tmp_path / "other-flat"), str(tmp_path / "other-checkpoint")
    for paths in (run, other):
        await_query(start_flatten(stream_messages(spark, archive), *paths))
    for output, checkpoint in ((run[0], other[1]), (other[0], run[1]), (str(tmp_path / "new"), run[1])):
        with pytest.raises(ValueError, match="another checkpoint"):
            start_flatten(stream_messages(spark, archive), output, checkpoint)
    await_query(start_flatten(stream_messages(spark, archive), *run))


def test_output_without_a_stored_name_is_refused(spark, archive, run):
    await_query(start_flatten(stream_messages(spark, archive), *run))
    os.rename(f"{run[0]}/_creditweave_stream", f"{run[0]}/_kept")
    with pytest.raises(ValueError, match="another checkpoint"):
        start_flatten(stream_messages(spark, archive), *run)


def test_start_that_was_cut_short_can_be_repeated(spark, archive, run):
    os.makedirs(run[0])
    with open(f"{run[0]}/_creditweave_stream", "w") as file:
        file.write("left over")
    await_query(start_flatten(stream_messages(spark, archive), *run))
    assert spark.read.parquet(run[0]).count() > 0


def test_limited_drains_finish_a_backlog(spark, messages, archive, run):
    finished, runs = False, 0
    while not finished:
        query = start_flatten(stream_messages(spark, archive, max_files_per_trigger=1), *run)
        finished = await_query(query, 0.2)
        assert not query.isActive
        runs += 1
        assert runs <= 12
    assert runs > 1
    assert rows(spark.read.parquet(run[0])) == rows(flatten_events(messages))


def test_replay_into_new_paths(spark, archive, run):
    expected = None
    for run_id in ("20260501T000000", "20260502T000000"):
        output, checkpoint = replay_paths(run[0] + "/", run[1], run_id)
        assert output == f"{run[0]}/{run_id}"
        await_query(start_flatten(stream_messages(spark, archive), output, checkpoint))
        got = rows(spark.read.parquet(output))
        assert expected in (None, got)
        expected = got


def test_continuous_run_stops_at_the_time_limit(spark, messages, archive, run):
    query = start_flatten(stream_messages(spark, archive), *run, run_mode="continuous")
    started = time.monotonic()
    await_query(query, 8)
    assert not query.isActive and 7 < time.monotonic() - started < 60
    assert rows(spark.read.parquet(run[0])) == rows(flatten_events(messages))


def test_other_run_modes_run_on(spark, archive, run):
    query = start_flatten(stream_messages(spark, archive), *run, run_mode="hourly", processing_time="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()


def test_stream_keeps_no_state_and_does_not_shuffle(spark, archive, run):
    query = start_flatten(stream_messages(spark, archive), *run)
    await_query(query)
    assert query.lastProgress["stateOperators"] == []
    assert "Exchange" not in query._jsq.toString()
