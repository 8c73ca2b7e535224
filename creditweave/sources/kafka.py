"""Kafka connection options, for reading and for publishing.

Needs the connector package that matches the running Spark and Scala version, for example
``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Login modules by kind of SASL mechanism.
_SCRAM_MODULE = "org.apache.kafka.common.security.scram.ScramLoginModule"
_PLAIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace('"', '\\"')
    return f'"{escaped}"'


def sasl_jaas_line(username: str, password: str, mechanism: str | None = None) -> str:
    """JAAS line for a user. SCRAM unless the mechanism is PLAIN."""
    module = _PLAIN_MODULE if (mechanism or "").upper() == "PLAIN" else _SCRAM_MODULE
    return f"{module} required username={_quoted(username)} password={_quoted(password)};"


@dataclass(frozen=True)
class KafkaConnection:
    """Where the brokers are and how to log in.

    ``jaas_config`` wins over ``username`` and ``password``. Secrets stay out of ``repr``.
    """

    servers: str
    security_protocol: str | None = None
    sasl_mechanism: str | None = None
    jaas_config: str | None = field(default=None, repr=False)
    username: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)

    def options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": ",".join(
                server for part in self.servers.split(",") if (server := part.strip())
            )
        }
        if self.security_protocol:
            options["kafka.security.protocol"] = self.security_protocol
        if self.sasl_mechanism:
            options["kafka.sasl.mechanism"] = self.sasl_mechanism
        jaas = self.jaas_config
        if not jaas and self.username and self.password:
            jaas = sasl_jaas_line(self.username, self.password, self.sasl_mechanism)
        if jaas:
            options["kafka.sasl.jaas.config"] = jaas
        return options


def topic_options(
    connection: KafkaConnection,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Options of a topic stream.

    The start position only counts while the checkpoint is new. Offsets that have expired are
    skipped unless ``fail_on_data_loss`` is set. ``max_offsets_per_trigger`` bounds a micro-batch, so that a drain of a long backlog
    commits in steps; ``min_partitions`` splits large topic partitions over more tasks.
    """
    options = connection.options() | {
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_topic(
    spark: SparkSession, connection: KafkaConnection, topic: str, **settings: object
) -> DataFrame:
    """Stream of one topic; ``settings`` as for :func:`topic_options`."""
    return spark.readStream.format("kafka").options(**topic_options(connection, topic, **settings)).load()
