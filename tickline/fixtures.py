"""Market-price views over the test tables, and their SQL twins.

`events` becomes ticks of 15 instruments (event type and user group). Several
events of an instrument fall into one hour, so the hourly prices hold real
duplicates, which the latest event resolves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INSTRUMENTS = [f"{kind}-{group}" for kind in ("click", "error", "purchase", "signup", "view")
               for group in range(3)]
BOUNDS = {"click-0": (5.0, 120.0), "view-1": (1.0, 90.0)}
AS_OF = "2024-02-01 00:00:00"
SLICES = ("2024-01-11", "2024-01-21")
NEWEST = ("ingested_at", "event_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instrument() -> Column:
    return F.concat(F.col("event_type"), F.lit("-"), (F.col("user_id") % 3).cast("string"))


def volume() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def ticks_of(events: DataFrame) -> DataFrame:
    """Every event as a tick of the hour it falls in."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return events.select(
        instrument().alias("coin_id"), hour.alias("event_timestamp"),
        F.col("ts").alias("ingested_at"), "event_id", F.col("value").alias("price_usd"),
        (F.col("value") * (1 + volume())).alias("market_cap"), volume().alias("volume_24h"),
        F.to_date(hour).alias("date"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"))


def messages_of(events: DataFrame) -> DataFrame:
    """Events as message payloads, as a tick producer would send them."""
    return events.select(F.to_json(F.struct(
        instrument().alias("symbol"), F.col("value").alias("price"), volume().alias("volume"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"))).alias("value"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream source."""
    schema = table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir))


def slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events in three parts by time, as three arrivals of data."""
    events = table(spark, sf_dir, "events")
    first, second = (F.lit(d).cast("timestamp_ntz") for d in SLICES)
    ts = F.col("ts")
    return [events.filter(ts < first), events.filter((ts >= first) & (ts < second)),
            events.filter(ts >= second)]


def documents(spark: SparkSession, sf_dir: str, slot: str = "minute") -> DataFrame:
    """Events as wide snapshot documents: one per time slot, with each
    instrument's latest quote in it."""
    quote = F.struct(
        F.col("value").alias("usd"), (F.col("value") * (1 + volume())).alias("usd_market_cap"),
        volume().alias("usd_24h_vol"),
        F.unix_timestamp(F.date_trunc("hour", "ts")).alias("last_updated_at"))
    wide = (table(spark, sf_dir, "events")
            .select(F.date_trunc(slot, "ts").alias("slot"), instrument().alias("coin_id"),
                    quote.alias("quote"), F.struct("ts", "event_id").alias("at"))
            .groupBy("slot").pivot("coin_id", INSTRUMENTS).agg(F.max_by("quote", "at")))
    metadata = F.struct(
        F.lit("events").alias("source"),
        F.date_format("slot", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
        F.lit(",".join(INSTRUMENTS)).alias("coins"), F.lit("usd").alias("currency"))
    return wide.withColumn("ingestion_metadata", metadata).drop("slot")


# -- SQL twins --------------------------------------------------------------

K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

SQL_TICKS = f"""ticks AS (
  SELECT event_type || '-' || CAST(user_id % 3 AS VARCHAR) AS coin_id,
         date_trunc('hour', ts) AS event_timestamp, ts AS ingested_at, event_id,
         value AS price_usd, value * (1 + {K}) AS market_cap, {K} AS volume_24h,
         CAST(ts AS DATE) AS date, epoch_us(ts) // 1000 AS ms
  FROM events)"""

SQL_PRICES = SQL_TICKS + """, prices AS (
  SELECT * FROM ticks QUALIFY row_number() OVER (
    PARTITION BY coin_id, event_timestamp ORDER BY ingested_at DESC, event_id DESC) = 1)"""

SQL_PERFORMANCE = SQL_PRICES + """, performance AS (
  SELECT coin_id, event_timestamp, price_usd, market_cap, volume_24h,
         round(avg(price_usd) OVER w, 4) AS moving_avg_price,
         round(coalesce(stddev_samp(price_usd) OVER w, 0.0), 6) AS price_volatility,
         CAST(rank() OVER (PARTITION BY event_timestamp ORDER BY market_cap DESC NULLS LAST)
              AS INTEGER) AS market_cap_rank, date
  FROM prices
  WINDOW w AS (PARTITION BY coin_id ORDER BY event_timestamp
               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""

SQL_SNAPSHOT = """snapshot AS (
  SELECT coin_id, price_usd, market_cap, volume_24h, event_timestamp
  FROM prices QUALIFY row_number() OVER (
    PARTITION BY coin_id ORDER BY event_timestamp DESC) = 1)"""


def _exact_mean(column: str, scale: int, digits: int) -> str:
    """Mean rounded half up, in whole numbers: the tables' values have at most
    `scale` decimals and are not negative."""
    total = f"sum(CAST(round({column} * {10 ** scale}) AS HUGEINT)) * {10 ** (digits - scale)}"
    return f"CAST((2 * {total} + count(*)) // (2 * count(*)) AS DOUBLE) / {10 ** digits}"


SQL_DAILY = f"""daily AS (
  SELECT date, coin_id, {_exact_mean('price_usd', 2, 4)} AS daily_avg_price,
         round(max(price_usd), 4) AS daily_max_price,
         round(min(price_usd), 4) AS daily_min_price,
         {_exact_mean('volume_24h', 0, 2)} AS daily_avg_volume, count(*) AS record_count
  FROM prices GROUP BY date, coin_id)"""

SQL_FLAGGED = SQL_PRICES + """, flagged AS (
  SELECT *, CASE WHEN price_usd > lag(price_usd) OVER w THEN 'UP'
                 WHEN price_usd < lag(price_usd) OVER w THEN 'DOWN'
                 ELSE 'STABLE' END AS price_change_flag,
         CAST(floor(epoch(ingested_at)) AS BIGINT) - CAST(epoch(event_timestamp) AS BIGINT) - 1800
           AS ingestion_delay_seconds
  FROM prices WINDOW w AS (PARTITION BY coin_id ORDER BY event_timestamp))"""

SQL_INSTRUMENTS = ("instruments AS (SELECT unnest(["
                   + ", ".join(f"'{i}'" for i in INSTRUMENTS) + "]) AS coin_id)")
