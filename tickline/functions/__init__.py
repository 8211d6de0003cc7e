from tickline.functions.columns import (
    change_flag,
    change_ratio,
    event_time,
    ingestion_delay,
    load_time,
    nested,
    outside_bounds,
    parse_time,
    valid_tick,
)

__all__ = [
    "change_flag", "change_ratio", "event_time", "ingestion_delay", "load_time",
    "nested", "outside_bounds", "parse_time", "valid_tick",
]
