"""The flattening stream with two outputs: events, and the messages that hold none."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from creditweave.fs import Folder
from creditweave.operators.events import flat_columns, parse_payload
from creditweave.schemas import MESSAGE_DDL
from creditweave.streaming.flatten import BATCHES, ONCE, bind_paths

EVENTS, REJECTS = "events", "rejects"
_POSITION = ("topic", "partition", "offset", "kafka_timestamp")


def _reason() -> Column:
    text = F.col("value").cast("string")
    return F.when(F.col("value").isNull(), "no value").when(F.get_json_object(text, "$").isNull(), "not JSON").otherwise("no application id")


def split_messages(messages: DataFrame) -> DataFrame:
    """Messages parsed once: the flat columns, ``kind``, and for a reject its ``reason`` and ``value``.

    An event has a row for each document, as in the flattening; a reject has one.
    """
    parsed = parse_payload(messages, "value").withColumn("kind", F.when(F.col("application_id").isNull(), REJECTS).otherwise(EVENTS))
    exploded = parsed.select("*", F.explode_outer("documents").alias("document")).drop("documents")
    rejected = F.col("kind") == REJECTS
    return exploded.select("kind", *flat_columns(), F.when(rejected, _reason()).alias("reason"), F.when(rejected, F.col("value")).alias("value"))


def _writer(spark: SparkSession, output: str) -> Callable[[DataFrame, int], None]:
    folder = Folder(spark, output)

    def write(batch: DataFrame, number: int) -> None:
        record = f"{BATCHES}/{number:020d}.json"
        if folder.has(record):  # replayed after the outputs were written, before the checkpoint noted it
            return
        run = f"parts/{number:020d}-{uuid.uuid4().hex}"
        seen = Observation()
        rows = split_messages(batch).observe(seen, *[F.count_if(F.col("kind") == kind).alias(kind) for kind in (EVENTS, REJECTS)])
        rows.write.partitionBy("kind").parquet(f"{folder.path}/{run}")
        folder.claim(record, json.dumps({"folder": run, **seen.get}))

    return write


def start_split(messages: DataFrame, output: str, checkpoint: str, run_mode: str = ONCE, processing_time: str | None = None) -> StreamingQuery:
    """Start the stream that writes events and rejects, each micro-batch in one pass over its messages.

    A micro-batch goes to a folder of its own; a record with its number, written last, makes both outputs
    visible at once. A batch that is replayed finds its record and writes nothing, one that stopped before
    its record is written anew and the unfinished folder is never read. Modes as in ``start_flatten``.
    """
    spark = messages.sparkSession
    bind_paths(spark, output, checkpoint)
    writer = messages.writeStream.foreachBatch(_writer(spark, output)).option("checkpointLocation", checkpoint)
    if run_mode == ONCE:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def _read(spark: SparkSession, output: str, kind: str) -> DataFrame:
    folder = Folder(spark, output)
    records = [json.loads(folder.read(f"{BATCHES}/{name}")) for name in folder.names(BATCHES) if name.endswith(".json")]
    paths = [f"{folder.path}/{r['folder']}/kind={kind}" for r in records if r[kind]]
    schema = split_messages(spark.createDataFrame([], MESSAGE_DDL)).drop("kind").schema
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_events(spark: SparkSession, output: str) -> DataFrame:
    """The flat rows of all finished micro-batches, as ``flatten_events`` gives them."""
    return _read(spark, output, EVENTS).drop("reason", "value")


def read_rejects(spark: SparkSession, output: str) -> DataFrame:
    """``topic, partition, offset, kafka_timestamp, reason, value`` of the messages without an event."""
    return _read(spark, output, REJECTS).select(*_POSITION, "reason", "value")
