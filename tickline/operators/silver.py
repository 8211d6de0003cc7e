"""Raw snapshots and ticks to one clean price row per instrument and moment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline import functions as C
from tickline.operators.series import last_rows, over_series
from tickline.schemas import INSTRUMENTS, PRICE_BOUNDS, QUOTE, TICK

SERIES = ["coin_id"]
LATEST_INGESTED = ("ingested_at", "price_usd", "market_cap", "volume_24h")


# -- batch snapshots --------------------------------------------------------

def _quote(schema: T.StructType, coin: str) -> Column:
    """The coin's quote in the uniform struct; typed nulls for what is absent."""
    present = set()
    if coin in schema.names and isinstance(schema[coin].dataType, T.StructType):
        present = set(schema[coin].dataType.names)
    return F.struct(*[
        (C.nested(coin, f.name) if f.name in present else F.lit(None))
        .cast(f.dataType).alias(f.name)
        for f in QUOTE])


def normalise_snapshot(df: DataFrame, coins: Sequence[str] = INSTRUMENTS) -> DataFrame:
    """One uniform struct column per expected coin, whatever the input holds.

    Takes documents of an inferred schema too: absent coins, fields and
    metadata become typed nulls.
    """
    schema = df.schema
    stamped = ("ingestion_metadata" in schema.names
               and isinstance(schema["ingestion_metadata"].dataType, T.StructType)
               and "ingested_at" in schema["ingestion_metadata"].dataType.names)
    ingested = C.nested("ingestion_metadata", "ingested_at") if stamped else F.lit(None)
    return df.select(ingested.cast("string").alias("ingested_at_str"),
                     *[_quote(schema, coin).alias(coin) for coin in coins])


def unpivot_snapshot(df: DataFrame, coins: Sequence[str] = INSTRUMENTS) -> DataFrame:
    """Normalised documents to one row per document and coin."""
    quotes = F.array(*[F.struct(F.lit(coin).alias("coin_id"), C.nested(coin).alias("data"))
                       for coin in coins])
    return df.select("ingested_at_str", F.inline(quotes))


def unpivot_documents(df: DataFrame, value: str = "value") -> DataFrame:
    """Raw JSON documents to one row per document and coin, for an open list of
    coins. Needs no schema beyond the quote's."""
    metadata = F.get_json_object(value, "$.ingestion_metadata.ingested_at")
    quotes = F.from_json(value, T.MapType(T.StringType(), QUOTE))
    return (df.select(metadata.alias("ingested_at_str"), F.explode(quotes).alias("coin_id", "data"))
              .filter(F.col("coin_id") != "ingestion_metadata"))


def clean_prices(df: DataFrame) -> DataFrame:
    """Typed, renamed columns; rows without a price go."""
    return df.select(
        F.lower("coin_id").alias("coin_id"),
        F.col("data.usd").cast("double").alias("price_usd"),
        F.col("data.usd_market_cap").cast("double").alias("market_cap"),
        F.col("data.usd_24h_vol").cast("double").alias("volume_24h"),
        F.col("data.last_updated_at").cast("long").alias("api_last_updated_at"),
        C.parse_time(F.col("ingested_at_str")).alias("ingested_at"),
    ).filter(F.col("price_usd").isNotNull())


def add_event_columns(df: DataFrame, epoch: str = "api_last_updated_at", unit: str = "s",
                      precision: str = "second") -> DataFrame:
    """`event_timestamp` from the epoch, with its `date` and `hour`."""
    return (df.withColumn("event_timestamp", C.event_time(F.col(epoch), unit, precision))
              .withColumns({"date": F.to_date("event_timestamp"),
                            "hour": F.hour("event_timestamp")}))


def add_ingestion_delay(df: DataFrame, epoch: str = "api_last_updated_at", unit: str = "s",
                        fractional: bool = False) -> DataFrame:
    return df.withColumn(
        "ingestion_delay_seconds",
        C.ingestion_delay(F.col("ingested_at"), F.col(epoch), unit, fractional))


def dedup_latest(df: DataFrame, keys: Sequence[str] = ("coin_id", "event_timestamp"),
                 order: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """One row per key, the one that is greatest on `order`.

    Each map task keeps one row per key before the shuffle, so a key with many
    copies costs no task more than one row from each map task.
    """
    return last_rows(df, keys, order, 1)


def add_price_change_flag(df: DataFrame, order: Sequence[str] = ("event_timestamp",),
                          layout: str = "time", unit: str = "day",
                          prior: DataFrame | None = None) -> DataFrame:
    """`price_change_flag` against the instrument's previous row.

    prior   the latest row per instrument from before `df`, if there is one
    """
    return over_series(
        df, SERIES, order, 1,
        {"price_change_flag": lambda w: C.change_flag(
            F.col("price_usd"), F.lag("price_usd").over(w))},
        carry=["price_usd"], layout=layout, unit=unit, prior=prior)


def drop_negative_delay(df: DataFrame) -> DataFrame:
    """Rows from the future go (their clocks are ahead of ours)."""
    return df.filter(F.col("ingestion_delay_seconds") >= 0)


def stamp(df: DataFrame, as_of: dt.datetime | Column | None = None) -> DataFrame:
    return df.withColumn("load_timestamp", C.load_time(as_of))


def clean_snapshots(df: DataFrame, coins: Sequence[str] = INSTRUMENTS,
                    order: Sequence[str] = LATEST_INGESTED) -> DataFrame:
    """Snapshot documents to unique, typed price rows (all but flag and stamp).

    The values themselves break ties, so a repeated run picks the same row.
    """
    long = clean_prices(unpivot_snapshot(normalise_snapshot(df, coins), coins))
    return dedup_latest(add_ingestion_delay(add_event_columns(long)), order=order)


# -- stream ticks -----------------------------------------------------------

def parse_ticks(df: DataFrame, value: str = "value") -> DataFrame:
    """Message payloads to tick columns; unreadable JSON gives nulls.

    `inline` keeps later filters from being moved below the parsing, where
    each column they use would parse the payload once more.
    """
    return df.select(F.inline(F.array(F.from_json(F.col(value).cast("string"), TICK))))


def valid_ticks(df: DataFrame,
                bounds: Mapping[str, tuple[float, float]] | DataFrame = PRICE_BOUNDS) -> DataFrame:
    """Ticks that pass the validity rule.

    bounds   {symbol: (low, high)}, or a table (symbol, low, high) for many
             instruments; unlisted ones have no limits
    """
    if isinstance(bounds, DataFrame):
        limits = bounds.select(F.col("symbol").alias("__symbol"), "low", "high")
        within = (F.coalesce(F.col("price") >= F.col("low"), F.lit(True))
                  & F.coalesce(F.col("price") <= F.col("high"), F.lit(True)))
        return (df.filter(C.valid_tick(F.col("symbol"), F.col("price"), {}))
                  .join(limits, F.col("symbol") == F.col("__symbol"), "left")
                  .filter(within).select(*df.columns))
    return df.filter(C.valid_tick(F.col("symbol"), F.col("price"), bounds))


def clean_ticks(df: DataFrame, precision: str = "second", fractional_delay: bool = False,
                as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Tick columns plus the silver columns derived from them."""
    named = df.withColumns({
        "coin_id": F.col("symbol"),
        "price_usd": F.col("price").cast("double"),
        "volume_24h": F.col("volume").cast("double"),
    })
    timed = add_event_columns(named, "timestamp", "ms", precision)
    return add_ingestion_delay(timed.withColumn("ingested_at", C.load_time(as_of)),
                               "timestamp", "ms", fractional_delay)
