from creditweave.sources.files import read_messages, read_source, stream_messages
from creditweave.sources.kafka import KafkaConnection, sasl_jaas_line, stream_topic
from creditweave.sources.keyed import jdbc_snapshot_options, read_snapshot, read_snapshot_jdbc

__all__ = [
    "KafkaConnection",
    "jdbc_snapshot_options",
    "read_messages",
    "read_snapshot",
    "read_snapshot_jdbc",
    "read_source",
    "sasl_jaas_line",
    "stream_messages",
    "stream_topic",
]
