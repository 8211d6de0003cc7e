from tickline.sinks.buckets import prune_buckets, read_buckets, rebucket, upsert_buckets
from tickline.sinks.tables import (
    align_schema,
    append_stream,
    ensure_schema,
    overwrite_partitions,
    overwrite_table,
    write_batch_idempotent,
)
from tickline.sinks.versions import current_version, prune_versions, read_current, upsert

__all__ = [
    "align_schema", "append_stream", "current_version", "ensure_schema",
    "overwrite_partitions", "overwrite_table", "prune_buckets", "prune_versions", "read_buckets",
    "read_current", "rebucket", "upsert", "upsert_buckets", "write_batch_idempotent",
]
