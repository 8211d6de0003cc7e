"""Report queries over the finished tables. Each returns a sorted DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.operators.gold import latest_snapshot


def snapshot_report(df: DataFrame, order: str = "market_cap") -> DataFrame:
    """The latest snapshot, rounded.

    order   "market_cap": the latest row per instrument by capitalisation;
            "price": the table as it is by price
    """
    if order == "market_cap":
        return latest_snapshot(df).select(
            "coin_id",
            F.round("price_usd", 4).alias("price_usd"),
            F.round("market_cap", 2).alias("market_cap_usd"),
            F.round("volume_24h", 2).alias("volume_24h_usd"),
            "event_timestamp",
        ).orderBy(F.col("market_cap_usd").desc())
    if order != "price":
        raise ValueError(f"order must be 'market_cap' or 'price', not {order!r}")
    return df.select(
        "coin_id",
        F.round("price_usd", 4).alias("target_live_price"),
        F.round("volume_24h", 2).alias("aggregated_volume_usd"),
        "event_timestamp",
    ).orderBy(F.col("target_live_price").desc())


def performance_recent(df: DataFrame, hours: int = 24,
                       names: Sequence[str] = ("moving_avg_price_24h", "price_volatility_index"),
                       ) -> DataFrame:
    """Performance rows of the last `hours` up to the latest one, both included.

    With a `date` column the latest moment is looked up in the last day only,
    and older days are pruned from the scan.
    """
    if "date" in df.columns:
        last_day = df.select(F.max("date")).scalar()
        latest = df.filter(F.col("date") == last_day)
    else:
        latest = df
    since = latest.select(F.max("event_timestamp")).scalar() - F.expr(f"INTERVAL {int(hours)} HOURS")
    recent = df.filter(F.col("event_timestamp") >= since)
    if "date" in df.columns:
        recent = recent.filter(F.col("date") >= F.to_date(since))
    average, volatility = names
    return recent.select(
        "event_timestamp",
        "coin_id",
        F.round("price_usd", 4).alias("price_usd"),
        F.round("moving_avg_price", 4).alias(average),
        F.round("price_volatility", 6).alias(volatility),
        "market_cap_rank",
    ).orderBy(F.col("event_timestamp").desc(), F.col("market_cap_rank").asc())


def daily_report(df: DataFrame, variant: str = "counted") -> DataFrame:
    """Daily trends by day and price.

    variant   "counted": with the number of ticks behind each day;
              "sampled": with the number of table rows that are alike, which
              is above one only where a day was stored twice
    """
    prices = ("daily_avg_price", "daily_max_price", "daily_min_price")
    if variant == "sampled":
        return (df.groupBy("date", "coin_id", *prices)
                  .agg(F.count(F.lit(1)).alias("validation_ticks_sampled"))
                  .select("date", "coin_id", *[F.round(p, 4).alias(p) for p in prices],
                          "validation_ticks_sampled")
                  .orderBy(F.col("date").desc(), F.col("daily_avg_price").desc()))
    if variant != "counted":
        raise ValueError(f"variant must be 'counted' or 'sampled', not {variant!r}")
    names = ("daily_avg", "daily_peak", "daily_floor")
    return (df.select("date", "coin_id",
                      *[F.round(p, 4).alias(n) for p, n in zip(prices, names)],
                      F.col("record_count").alias("total_sampled_ticks"))
              .orderBy(F.col("date").desc(), F.col("daily_avg").desc()))


def latest_rows(df: DataFrame, n: int = 15,
                order: Sequence[str] = ("event_timestamp",)) -> DataFrame:
    """The `n` latest rows; `order` may name tie-breakers after the time."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
