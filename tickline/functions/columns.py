"""Column expressions shared by the batch and the streaming layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickline.schemas import PRICE_BOUNDS


def nested(*names: str) -> Column:
    """Column at a nested path whose parts may hold hyphens or dots."""
    return F.col(".".join("`" + name.replace("`", "``") + "`" for name in names))


def event_time(epoch: Column, unit: str = "s", precision: str = "second") -> Column:
    """Timestamp of an epoch in seconds ("s") or milliseconds ("ms").

    Millisecond epochs are cut to whole seconds unless precision="milli".
    """
    if unit == "s":
        return F.timestamp_seconds(epoch)
    if unit != "ms":
        raise ValueError(f"unit must be 's' or 'ms', not {unit!r}")
    exact = F.timestamp_millis(epoch)
    if precision == "milli":
        return exact
    if precision != "second":
        raise ValueError(f"precision must be 'second' or 'milli', not {precision!r}")
    return F.date_trunc("second", exact)


def parse_time(text: Column) -> Column:
    """Timestamp of an ISO 8601 string; null where it cannot be read."""
    return F.try_to_timestamp(text)


def load_time(as_of: dt.datetime | Column | None = None) -> Column:
    """The time of the run, or the given moment for repeatable runs.

    A moment without a zone is in the session's time zone.
    """
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of.isoformat()).cast("timestamp")


def ingestion_delay(ingested_at: Column, epoch: Column, unit: str = "s",
                    fractional: bool = False) -> Column:
    """Seconds from the event to its ingestion.

    Whole seconds, rounded down, unless fractional=True (milliseconds only).
    """
    arrived = F.unix_timestamp(ingested_at)
    if unit == "s":
        return arrived - epoch
    delay = arrived - epoch / 1000
    return delay if fractional else F.floor(delay).cast("long")


def outside_bounds(key: Column, price: Column,
                   bounds: Mapping[str, tuple[float, float]] = PRICE_BOUNDS) -> Column:
    """True where a bounded instrument's price lies outside its limits."""
    outside = F.lit(False)
    for name, (low, high) in bounds.items():
        outside = outside | ((key == name) & ((price < low) | (price > high)))
    return outside


def valid_tick(key: Column, price: Column,
               bounds: Mapping[str, tuple[float, float]] = PRICE_BOUNDS) -> Column:
    """The one rule for an acceptable tick: named, priced above zero, in bounds."""
    return key.isNotNull() & (price > 0) & ~outside_bounds(key, price, bounds)


def change_flag(price: Column, previous: Column) -> Column:
    """UP, DOWN or STABLE against the previous price; the first is STABLE."""
    return (F.when(price > previous, "UP")
             .when(price < previous, "DOWN")
             .otherwise("STABLE"))


def change_ratio(price: Column, previous: Column) -> Column:
    """Relative move from the previous price, without sign.

    Null for the first row and where the previous price is zero.
    """
    return F.abs(F.try_divide(price - previous, previous))
