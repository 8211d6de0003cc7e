"""Silver prices to the three analytic tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tickline.operators.series import last_rows, over_series, rank_within
from tickline.operators.silver import SERIES
from tickline.schemas import ROLLING_ROWS


def settled_mean(mean: Column, digits: int) -> Column:
    """A mean rounded to `digits`, the same whatever order its rows were summed in.

    Partial sums meet in no fixed order, which moves the last bits of a double.
    They are rounded off first, or a mean that lies half-way would round up in
    one run and down in the next.
    """
    return F.round(F.round(mean, digits + 5), digits)


def _existing(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def latest_snapshot(df: DataFrame, order: Sequence[str] = ("event_timestamp",)) -> DataFrame:
    """The latest row per instrument."""
    columns = _existing(df, "coin_id", "price_usd", "market_cap", "volume_24h", "event_timestamp")
    needed = list(dict.fromkeys([*columns, *order]))
    return last_rows(df.select(*needed), SERIES, order, 1).select(*columns)


def rolling_columns(rows: int = ROLLING_ROWS) -> dict:
    """Moving average and sample deviation over the last `rows` prices."""
    def frame(w: WindowSpec) -> WindowSpec:
        return w.rowsBetween(-(rows - 1), 0)

    return {
        "moving_avg_price": lambda w: F.round(F.avg("price_usd").over(frame(w)), 4),
        "price_volatility": lambda w: F.round(
            F.coalesce(F.stddev("price_usd").over(frame(w)), F.lit(0.0)), 6),
    }


def rolling_metrics(df: DataFrame, order: Sequence[str] = ("event_timestamp",),
                    rows: int = ROLLING_ROWS, layout: str = "time", unit: str = "day",
                    prior: DataFrame | None = None) -> DataFrame:
    """Add `moving_avg_price` and `price_volatility` per instrument."""
    return over_series(df, SERIES, order, rows - 1, rolling_columns(rows),
                       layout=layout, unit=unit, prior=prior)


def market_cap_rank(df: DataFrame, rank_by: str = "market_cap",
                    layout: str = "plain") -> DataFrame:
    """Add `market_cap_rank`, the position among the instruments of a moment.

    The moment's date is part of the group where there is one, so a filter on
    days reaches the scan.
    """
    moment = [*_existing(df, "date"), "event_timestamp"]
    return rank_within(df, moment, rank_by, "market_cap_rank", layout)


def price_performance(df: DataFrame, order: Sequence[str] = ("event_timestamp",),
                      rows: int = ROLLING_ROWS, rank_by: str = "market_cap",
                      layout: str = "time", unit: str = "day",
                      rank_layout: str = "plain",
                      prior: DataFrame | None = None) -> DataFrame:
    """Rolling average, volatility and rank per instrument and moment."""
    base = _existing(df, "coin_id", "event_timestamp", "price_usd", "market_cap", "volume_24h")
    needed = list(dict.fromkeys([*base, "date", *order]))
    rolled = rolling_metrics(df.select(*needed), order, rows, layout, unit, prior)
    return market_cap_rank(rolled, rank_by, rank_layout).select(
        *base, "moving_avg_price", "price_volatility", "market_cap_rank", "date")


def daily_columns() -> list[Column]:
    """The figures of a day."""
    return [
        settled_mean(F.avg("price_usd"), 4).alias("daily_avg_price"),
        F.round(F.max("price_usd"), 4).alias("daily_max_price"),
        F.round(F.min("price_usd"), 4).alias("daily_min_price"),
        settled_mean(F.avg("volume_24h"), 2).alias("daily_avg_volume"),
        F.count(F.lit(1)).alias("record_count"),
    ]


def daily_trends(df: DataFrame) -> DataFrame:
    """Average, highest and lowest price and average volume per day."""
    return df.groupBy("date", "coin_id").agg(*daily_columns())


def daily_partials(df: DataFrame) -> DataFrame:
    """What `merge_daily_partials` needs from one part of the rows: sums and
    counts, since averages cannot be merged."""
    return df.groupBy("date", "coin_id").agg(
        F.sum("price_usd").alias("price_sum"),
        F.count("price_usd").alias("price_count"),
        F.max("price_usd").alias("price_max"),
        F.min("price_usd").alias("price_min"),
        F.sum("volume_24h").alias("volume_sum"),
        F.count("volume_24h").alias("volume_count"),
        F.count(F.lit(1)).alias("record_count"),
    )


def fold_daily_partials(df: DataFrame) -> DataFrame:
    """Partials of several parts as one per day and instrument."""
    totals = ("price_sum", "price_count", "volume_sum", "volume_count", "record_count")
    return df.groupBy("date", "coin_id").agg(
        *[F.sum(c).alias(c) for c in totals], F.max("price_max").alias("price_max"), F.min("price_min").alias("price_min"))


def merge_daily_partials(df: DataFrame) -> DataFrame:
    """Daily trends of all the parts together."""
    def mean(total: str, count: str, digits: int) -> Column:
        return settled_mean(F.try_divide(F.sum(total), F.sum(count)), digits)

    return df.groupBy("date", "coin_id").agg(
        mean("price_sum", "price_count", 4).alias("daily_avg_price"),
        F.round(F.max("price_max"), 4).alias("daily_max_price"),
        F.round(F.min("price_min"), 4).alias("daily_min_price"),
        mean("volume_sum", "volume_count", 2).alias("daily_avg_volume"),
        F.sum("record_count").alias("record_count"),
    )
