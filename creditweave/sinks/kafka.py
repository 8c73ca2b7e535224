"""Publishing events to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from creditweave.operators.events import encode_events
from creditweave.operators.volume import sent_mb
from creditweave.sources.kafka import KafkaConnection


def to_messages(records: DataFrame, topic: str) -> DataFrame:
    """Records as messages: topic, application id as key, UTF-8 JSON as value."""
    return encode_events(records).select(F.lit(topic).alias("topic"), "key", "value")


def publish_events(
    records: DataFrame, connection: KafkaConnection, topic: str, sink: str = "kafka"
) -> dict[str, object]:
    """Write the records to the topic and report what was sent.

    The executors send; the totals are observed on the way, without a second pass. A task that is
    run again sends its messages again (delivery is at least once). ``sink`` names another batch
    sink with the same columns, to try a run without brokers.
    """
    sent = Observation("sent")
    messages = to_messages(records, topic).observe(
        sent, F.count(F.lit(1)).alias("messages"), sent_mb(F.col("value")).alias("sent_mb")
    )
    messages.write.format(sink).mode("append").options(**connection.options()).save()
    return {"topic": topic, **sent.get}


def start_publishing(
    records: DataFrame,
    connection: KafkaConnection,
    topic: str,
    checkpoint: str,
    sink: str = "kafka",
    **options: str,
) -> StreamingQuery:
    """Publish a stream of records: all that is available, then stop; resumes from the checkpoint."""
    return (
        to_messages(records, topic)
        .writeStream.format(sink)
        .outputMode("append")
        .options(**connection.options(), **options)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
