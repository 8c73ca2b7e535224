from creditweave.streaming.flatten import await_query, replay_paths, start_flatten
from creditweave.streaming.split import read_events, read_rejects, split_messages, start_split

__all__ = ["await_query", "read_events", "read_rejects", "replay_paths", "split_messages", "start_flatten", "start_split"]
