"""Streaming job: topic of nested events to flat Parquet rows."""

from __future__ import annotations

import sys
import warnings
from collections.abc import Sequence

from creditweave.jobs.settings import FlattenSettings
from creditweave.session import build_session
from creditweave.sources.kafka import stream_topic
from creditweave.streaming.flatten import ONCE, await_query, replay_paths, start_flatten

#: Exit code of a drain that its time limit stopped: what is committed stays, the next run goes on.
UNFINISHED = 75


def main(argv: Sequence[str] | None = None) -> int:
    """Run the stream; returns the exit code."""
    settings = FlattenSettings.resolve(argv)
    output, checkpoint = settings.output, settings.checkpoint
    if settings.replay_id:
        output, checkpoint = replay_paths(output, checkpoint, settings.replay_id)
    spark = build_session("creditweave-flatten")
    try:
        messages = stream_topic(
            spark,
            settings.connection(),
            settings.topic,
            starting_offsets=settings.starting_offsets,
            max_offsets_per_trigger=settings.max_offsets_per_trigger,
            min_partitions=settings.min_partitions,
            fail_on_data_loss=bool(settings.fail_on_data_loss),
        )
        query = start_flatten(
            messages, output, checkpoint, settings.run_mode, settings.processing_time
        )
        drains = settings.run_mode == ONCE
        if drains and settings.timeout_seconds and not settings.max_offsets_per_trigger:
            warnings.warn("without --max-offsets-per-trigger the backlog is one batch, and the limit waits for its end", stacklevel=2)
        finished = await_query(query, settings.timeout_seconds)
        return UNFINISHED if drains and not finished else 0
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
