from tickline.streaming.gold import (
    daily_trends_stream,
    daily_trends_upsert,
    fold_batches,
    gold_fanout,
    read_daily_trends,
    read_performance,
    read_snapshot,
    recent_performance,
)
from tickline.streaming.layers import (
    bronze_stream,
    check_rows,
    collapse_copies,
    dedup,
    late_rows,
    replay_checkpoint,
    run_bronze,
    run_silver,
    silver_stream,
)
from tickline.streaming.tiers import dedup_tiers, run_silver_tiers

__all__ = [
    "bronze_stream", "check_rows", "collapse_copies", "daily_trends_stream", "daily_trends_upsert", "dedup", "dedup_tiers", "fold_batches", "gold_fanout", "late_rows",
    "read_daily_trends",
    "read_performance", "read_snapshot", "recent_performance", "replay_checkpoint", "run_bronze", "run_silver", "run_silver_tiers",
    "silver_stream",
]
