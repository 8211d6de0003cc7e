"""Types, instruments and limits shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Instruments, price limits and tolerances.
INSTRUMENTS = [
    "bitcoin", "ethereum", "solana", "ripple", "cardano",
    "dogecoin", "polkadot", "polygon", "shiba-inu", "avalanche-2",
    "chainlink", "uniswap", "litecoin", "stellar", "near",
]
PRICE_BOUNDS = {"bitcoin": (10_000.0, 250_000.0)}
PRICE_FLAGS = ["UP", "DOWN", "STABLE"]
ROLLING_ROWS = 7
FRESHNESS_MINUTES = 30
JUMP_RATIO = 0.20
SYNC_TOLERANCE = 0.0001
STREAM_SYNC_TOLERANCE = 0.05
SNAPSHOT_SOURCE = "CoinGecko API"
SNAPSHOT_CURRENCY = "usd"

QUOTE = T.StructType([
    T.StructField("usd", T.DoubleType()),
    T.StructField("usd_market_cap", T.DoubleType()),
    T.StructField("usd_24h_vol", T.DoubleType()),
    T.StructField("last_updated_at", T.LongType()),
])

METADATA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("coins", T.StringType()),
    T.StructField("currency", T.StringType()),
])

TICK = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

CHECK_RESULT = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("metric", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
])

CORRUPT = "_corrupt_record"


def snapshot_schema(coins: list[str] | None = None) -> T.StructType:
    """Schema of one raw snapshot document: one quote per coin, the ingestion
    metadata, and the column that keeps unparsable text."""
    fields = [T.StructField(coin, QUOTE) for coin in coins or INSTRUMENTS]
    fields.append(T.StructField("ingestion_metadata", METADATA))
    fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)
