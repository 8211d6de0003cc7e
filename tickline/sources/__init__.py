from tickline.sources.changes import note_all, note_days, on_days, stream_changes
from tickline.sources.snapshots import (
    hidden_documents,
    land_snapshots,
    read_snapshot_documents,
    read_snapshots,
)
from tickline.sources.tables import read_newest_day, read_table, stream_table
from tickline.sources.ticks import kafka_options, tick_stream

__all__ = [
    "hidden_documents", "kafka_options", "land_snapshots", "note_all", "note_days", "on_days", "read_newest_day",
    "read_snapshot_documents", "read_snapshots", "read_table", "stream_changes", "stream_table", "tick_stream",
]
