from creditweave.sinks.files import write_mart, write_snapshot, write_table
from creditweave.sinks.kafka import publish_events, start_publishing, to_messages

__all__ = ["publish_events", "start_publishing", "to_messages", "write_mart", "write_snapshot", "write_table"]
