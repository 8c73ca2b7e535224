"""The flattening as a checkpointed stream into Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from creditweave.fs import Folder
from creditweave.operators.events import flatten_events

ONCE = "once"
CONTINUOUS = "continuous"


_PAIR = "_creditweave_stream"
#: Folder of the records of micro-batches that a stream writes itself.
BATCHES = "_batches"


def bind_paths(spark: SparkSession, output: str, checkpoint: str) -> None:
    """Make an output and a checkpoint a pair at their first start, and refuse any other pairing.

    The file sink logs its batches in the output and skips batch numbers that the log holds. So a
    checkpoint on an output that another one has filled would lose messages without a word, and a used
    checkpoint on a new output would leave out what came before. Both folders hold the name of the pair;
    the output's is written first, so a start that was cut short can be repeated.
    """
    out, check = Folder(spark, output), Folder(spark, checkpoint)
    ours, theirs = out.read(_PAIR), check.read(_PAIR)
    used_output, used_checkpoint = out.has("_spark_metadata") or out.has(BATCHES), theirs is not None or check.has("offsets")
    if ours is not None and ours == theirs:
        return
    if used_output or used_checkpoint:
        raise ValueError(
            f"{output} was written with another checkpoint than {checkpoint}; "
            "use that checkpoint to resume, or a new output and a new checkpoint to replay"
        )
    name = uuid.uuid4().hex
    out.write(_PAIR, name)
    check.write(_PAIR, name)


def replay_paths(output: str, checkpoint: str, run_id: str) -> tuple[str, str]:
    """Output and checkpoint of a full replay: both are new for each run."""
    return f"{output.rstrip('/')}/{run_id}", f"{checkpoint.rstrip('/')}/{run_id}"


def start_flatten(
    messages: DataFrame,
    output: str,
    checkpoint: str,
    run_mode: str = ONCE,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream: parse, filter, explode, project, append to Parquet.

    No state and no shuffle; the work is as parallel as the source. ``once`` takes all that is
    available, in as many micro-batches as the source's limits ask for, and stops. Every other
    mode runs on, one micro-batch after the other or every ``processing_time``.
    """
    bind_paths(messages.sparkSession, output, checkpoint)
    writer = (
        flatten_events(messages)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if run_mode == ONCE:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def _done(query: StreamingQuery) -> int:
    last = query.lastProgress
    return -1 if last is None else last["batchId"]


def await_query(query: StreamingQuery, timeout_seconds: float | None = None) -> bool:
    """Wait for the query to end; with a time limit, stop it between two micro-batches after the limit.

    The micro-batch that runs when the limit is over is finished and committed, so a drain whose source
    bounds its batches gets on with every run. Returns whether the query ended by itself.
    """
    if not timeout_seconds:
        query.awaitTermination()
        return True
    if query.awaitTermination(timeout_seconds):
        return True
    before = _done(query)
    while query.status["isTriggerActive"] and _done(query) == before:
        if query.awaitTermination(0.1):
            return True
    query.stop()
    return False
