from creditweave.tables.buckets import UpsertReport, create_buckets, read_buckets, remove_old_versions, upsert_buckets
from creditweave.tables.mart_state import add_delivery, compact, read_mart
from creditweave.tables.numbers import number_values, read_numbers
from creditweave.tables.versions import CommitConflict, VersionLog

__all__ = [
    "CommitConflict",
    "UpsertReport",
    "VersionLog",
    "add_delivery",
    "compact",
    "create_buckets",
    "number_values",
    "read_buckets",
    "read_mart",
    "read_numbers",
    "remove_old_versions",
    "upsert_buckets",
]
