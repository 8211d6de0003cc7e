"""Every operator as a query over the test tables, with its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline import fixtures as X
from tickline import functions as C
from tickline import sinks, sources, streaming
from tickline.operators import gold, quality, reports, series, silver
from tickline.plans.batch import Tables, run_batch, run_increment
from tickline.schemas import CHECK_RESULT
from tickline.session import materialise, shared_dir, use_rocksdb
from tickline.sinks.versions import write_version

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _comparable(build(spark, sf_dir))

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build
    return register


def _comparable(df: DataFrame) -> DataFrame:
    """UTC wall-clock timestamps, as the SQL side has them."""
    zoned = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema
             if f.dataType.simpleString() == "timestamp"}
    return df.withColumns(zoned) if zoned else df


def as_of():
    return F.lit(X.AS_OF).cast("timestamp")


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly prices, one row per instrument and hour."""
    return silver.dedup_latest(X.ticks(spark, sf_dir), order=X.NEWEST)


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver: prices with flag, and the delay to the half hour."""
    delay = F.unix_timestamp("ingested_at") - F.unix_timestamp("event_timestamp") - 1800
    return (silver.add_price_change_flag(materialise(prices(spark, sf_dir)))
            .withColumn("ingestion_delay_seconds", delay))


def performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.price_performance(prices(spark, sf_dir))


def stored(spark: SparkSession, df: DataFrame, partition_by: tuple = ()) -> DataFrame:
    """`df` as a table written and read back through the sinks."""
    path = shared_dir(spark, "table")
    sinks.overwrite_table(df, path, partition_by)
    return sources.read_table(spark, path)


# == silver =================================================================

_TICK = "coin_id, event_timestamp, ingested_at, event_id, price_usd, market_cap, volume_24h, date"


@query(f"WITH {X.SQL_PRICES} SELECT {_TICK} FROM prices")
def dedup_latest(spark, sf_dir):
    return prices(spark, sf_dir)


@query(f"WITH {X.SQL_FLAGGED} SELECT {_TICK}, price_change_flag FROM flagged")
def price_change_flag(spark, sf_dir):
    """The unique rows are stored first, as in the batch run: the flag reads them
    twice, the second time only by three columns."""
    return silver.add_price_change_flag(materialise(prices(spark, sf_dir)))


_SLOTS = """, slots AS (
  SELECT date_trunc('{slot}', ingested_at) AS slot, t.* FROM ticks t JOIN instruments USING (coin_id)
  QUALIFY row_number() OVER (PARTITION BY slot, coin_id
                             ORDER BY ingested_at DESC, event_id DESC) = 1)"""


def _slots(slot: str) -> str:
    return f"WITH {X.SQL_INSTRUMENTS}, {X.SQL_TICKS}" + _SLOTS.format(slot=slot)


@query(_slots("hour") + """
SELECT strftime(d.slot, '%Y-%m-%dT%H:%M:%S') AS ingested_at_str, i.coin_id, s.price_usd,
       s.market_cap, s.volume_24h,
       coalesce(CAST(epoch(s.event_timestamp) AS BIGINT), -1) AS api_last_updated_at
FROM (SELECT DISTINCT date_trunc('hour', ingested_at) AS slot FROM ticks) d
CROSS JOIN instruments i LEFT JOIN slots s ON s.slot = d.slot AND s.coin_id = i.coin_id""")
def unpivot_snapshot(spark, sf_dir):
    wide = silver.normalise_snapshot(X.documents(spark, sf_dir, "hour"), X.INSTRUMENTS)
    return silver.unpivot_snapshot(wide, X.INSTRUMENTS).select(
        "ingested_at_str", "coin_id",
        F.col("data.usd").alias("price_usd"), F.col("data.usd_market_cap").alias("market_cap"),
        F.col("data.usd_24h_vol").alias("volume_24h"),
        F.coalesce(F.col("data.last_updated_at"), F.lit(-1)).alias("api_last_updated_at"))


_QUOTES = """ SELECT coin_id, price_usd, market_cap, volume_24h,
  CAST(epoch(event_timestamp) AS BIGINT) AS api_last_updated_at, slot AS ingested_at FROM slots"""

_SILVER_ROWS = """SELECT coin_id, price_usd, market_cap, volume_24h,
  CAST(epoch(event_timestamp) AS BIGINT) AS api_last_updated_at, slot AS ingested_at,
  event_timestamp, CAST(event_timestamp AS DATE) AS date,
  CAST(hour(event_timestamp) AS INTEGER) AS hour,
  CAST(epoch(slot) AS BIGINT) - CAST(epoch(event_timestamp) AS BIGINT) AS ingestion_delay_seconds
FROM slots QUALIFY row_number() OVER (
  PARTITION BY coin_id, event_timestamp ORDER BY slot DESC) = 1"""


@query(_slots("minute") + _QUOTES)
def clean_prices(spark, sf_dir):
    wide = silver.normalise_snapshot(X.documents(spark, sf_dir), X.INSTRUMENTS)
    return silver.clean_prices(silver.unpivot_snapshot(wide, X.INSTRUMENTS))


@query(_slots("hour") + _QUOTES)
def snapshot_scan(spark, sf_dir):
    """Landed one document per file, read as multi-line JSON."""
    path = sources.land_snapshots(X.documents(spark, sf_dir, "hour"), shared_dir(spark, "bronze"))
    wide = silver.normalise_snapshot(sources.read_snapshots(spark, path, X.INSTRUMENTS), X.INSTRUMENTS)
    return silver.clean_prices(silver.unpivot_snapshot(wide, X.INSTRUMENTS))


@query(_slots("minute") + _SILVER_ROWS)
def clean_snapshots(spark, sf_dir):
    """Landed as JSON lines, read back and taken to unique silver rows."""
    path = sources.land_snapshots(X.documents(spark, sf_dir), shared_dir(spark, "bronze"),
                                  one_per_file=False)
    documents = sources.read_snapshots(spark, path, X.INSTRUMENTS, multi_line=False)
    return silver.clean_snapshots(documents, X.INSTRUMENTS)


@query(_slots("minute") + _QUOTES)
def unpivot_documents(spark, sf_dir):
    """Documents as text, for an open list of coins."""
    text = X.documents(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value"))
    return silver.clean_prices(silver.unpivot_documents(text))


_MESSAGES = f"""WITH messages AS (
  SELECT event_type || '-' || CAST(user_id % 3 AS VARCHAR) AS symbol, value AS price,
         {X.K} AS volume, epoch_us(ts) // 1000 AS "timestamp", ts, event_type FROM events)"""


@query(_MESSAGES + """
SELECT CASE WHEN event_type <> 'error' THEN symbol END AS symbol,
       CASE WHEN event_type <> 'error' THEN price END AS price,
       CASE WHEN event_type <> 'error' THEN volume END AS volume,
       CASE WHEN event_type <> 'error' THEN "timestamp" ELSE -1 END AS "timestamp" FROM messages""")
def parse_ticks(spark, sf_dir):
    return _cut_ticks(spark, sf_dir).fillna(-1, ["timestamp"])


def _cut_ticks(spark, sf_dir):
    """Payloads of error events are cut off, so they cannot be parsed."""
    sent = X.messages_of(X.table(spark, sf_dir, "events"))
    cut = F.when(F.col("value").contains('"symbol":"error'), F.substring("value", 2, 20))
    return silver.parse_ticks(sent.select(F.coalesce(cut, F.col("value")).cast("binary").alias("value")))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.parse_ticks(X.messages_of(X.table(spark, sf_dir, "events")))


_VALID = " AND ".join(
    ["price > 0"] + [f"NOT (symbol = '{name}' AND (price < {low} OR price > {high}))"
                     for name, (low, high) in X.BOUNDS.items()])


@query(_MESSAGES + f'SELECT symbol, price, volume, "timestamp" FROM messages WHERE {_VALID}')
def valid_ticks(spark, sf_dir):
    return silver.valid_ticks(bronze(spark, sf_dir), X.BOUNDS)


@query(_MESSAGES + """, limits AS (
  SELECT symbol, min(price) * 2 + 1 AS low, max(price) / 2 AS high FROM messages GROUP BY symbol)
SELECT symbol, price, volume, "timestamp" FROM messages JOIN limits USING (symbol)
WHERE price > 0 AND price BETWEEN low AND high""")
def valid_ticks_table(spark, sf_dir):
    """Limits per instrument come from a table."""
    limits = bronze(spark, sf_dir).groupBy("symbol").agg(
        (F.min("price") * 2 + 1).alias("low"), (F.max("price") / 2).alias("high"))
    return silver.valid_ticks(bronze(spark, sf_dir), limits)


_CLEAN_TICKS = f"""SELECT symbol, price, volume, "timestamp", symbol AS coin_id, price AS price_usd,
  volume AS volume_24h, date_trunc('second', ts) AS event_timestamp, CAST(ts AS DATE) AS date,
  CAST(hour(ts) AS INTEGER) AS hour, TIMESTAMP '{X.AS_OF}' AS ingested_at,
  CAST(floor(epoch(TIMESTAMP '{X.AS_OF}') - "timestamp" / 1000) AS BIGINT)
    AS ingestion_delay_seconds"""


@query(_MESSAGES + _CLEAN_TICKS + " FROM messages")
def clean_ticks(spark, sf_dir):
    return silver.clean_ticks(bronze(spark, sf_dir), as_of=as_of())


@query(_MESSAGES + f"""SELECT symbol, "timestamp",
  make_timestamp("timestamp" * 1000) AS event_timestamp,
  epoch(TIMESTAMP '{X.AS_OF}') - "timestamp" / 1000 AS ingestion_delay_seconds FROM messages""")
def clean_ticks_exact(spark, sf_dir):
    """Event times to the millisecond, delays with their fraction."""
    exact = silver.clean_ticks(bronze(spark, sf_dir), "milli", True, as_of())
    return exact.select("symbol", "timestamp", "event_timestamp", "ingestion_delay_seconds")


@query(f"WITH {X.SQL_FLAGGED} SELECT {_TICK}, price_change_flag, ingestion_delay_seconds "
       "FROM flagged WHERE ingestion_delay_seconds >= 0")
def drop_negative_delay(spark, sf_dir):
    return silver.drop_negative_delay(flagged(spark, sf_dir))


# == gold ===================================================================

_PERFORMANCE = ("coin_id, event_timestamp, price_usd, market_cap, volume_24h, moving_avg_price, "
                "price_volatility, market_cap_rank, date")


@query(f"WITH {X.SQL_PRICES}, {X.SQL_SNAPSHOT} SELECT * FROM snapshot")
def latest_snapshot(spark, sf_dir):
    return gold.latest_snapshot(prices(spark, sf_dir))


@query(f"WITH {X.SQL_PERFORMANCE} SELECT {_PERFORMANCE} FROM performance")
def price_performance(spark, sf_dir):
    return performance(spark, sf_dir)


@query(f"WITH {X.SQL_PERFORMANCE} SELECT {_PERFORMANCE} FROM performance")
def price_performance_table(spark, sf_dir):
    """From the stored silver table, as the batch run does it."""
    return gold.price_performance(stored(spark, prices(spark, sf_dir), ("date",)))


@query(f"WITH {X.SQL_PERFORMANCE} SELECT coin_id, event_timestamp, moving_avg_price FROM performance")
def moving_average(spark, sf_dir):
    rolled = gold.rolling_metrics(prices(spark, sf_dir).select("coin_id", "event_timestamp", "price_usd"))
    return rolled.select("coin_id", "event_timestamp", "moving_avg_price")


@query(f"WITH {X.SQL_PERFORMANCE} SELECT coin_id, event_timestamp, price_volatility FROM performance")
def volatility(spark, sf_dir):
    rolled = gold.rolling_metrics(prices(spark, sf_dir).select("coin_id", "event_timestamp", "price_usd"))
    return rolled.select("coin_id", "event_timestamp", "price_volatility")


@query(f"WITH {X.SQL_PERFORMANCE} SELECT coin_id, event_timestamp, market_cap_rank FROM performance")
def market_cap_rank(spark, sf_dir):
    ranked = gold.market_cap_rank(prices(spark, sf_dir))
    return ranked.select("coin_id", "event_timestamp", "market_cap_rank")


@query(f"""WITH {X.SQL_TICKS} SELECT event_id, event_timestamp, price_usd,
CAST(rank() OVER (PARTITION BY event_timestamp ORDER BY price_usd DESC NULLS LAST) AS INTEGER)
  AS price_rank FROM ticks""")
def rank_of_every_tick(spark, sf_dir):
    """All ticks of an hour against each other: groups grow with the data, so
    the ranks come from even chunks of the distinct values."""
    return (series.rank_within(X.ticks(spark, sf_dir), ["event_timestamp"], "price_usd",
                               "price_rank", "range")
            .select("event_id", "event_timestamp", "price_usd", "price_rank"))


@query("""SELECT event_type AS coin_id, event_id, ts AS event_timestamp,
  round(avg(value) OVER w, 4) AS moving_avg_price,
  round(coalesce(stddev_samp(value) OVER w, 0.0), 6) AS price_volatility
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id
                         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_every_tick(spark, sf_dir):
    """Five long series with no limit on the rows of a moment: even chunks."""
    raw = X.table(spark, sf_dir, "events").select(
        F.col("event_type").alias("coin_id"), "event_id", F.col("ts").alias("event_timestamp"),
        F.col("value").alias("price_usd"))
    rolled = gold.rolling_metrics(raw, ("event_timestamp", "event_id"), layout="range")
    return rolled.drop("price_usd")


@query("""SELECT o_orderpriority AS coin_id, o_orderkey, o_orderdate AS event_timestamp,
  o_totalprice - lag(o_totalprice) OVER w AS change
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)""")
def change_of_every_order(spark, sf_dir):
    """Look-back of one row, in even chunks."""
    raw = X.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("coin_id"), "o_orderkey",
        F.col("o_orderdate").alias("event_timestamp"), "o_totalprice")
    price = F.col("o_totalprice")
    return series.over_series(
        raw, silver.SERIES, ("event_timestamp", "o_orderkey"), 1,
        {"change": lambda w: price - F.lag(price).over(w)}, layout="range").drop("o_totalprice")


@query(f"WITH {X.SQL_PRICES}, {X.SQL_DAILY} SELECT * FROM daily")
def daily_trends(spark, sf_dir):
    return gold.daily_trends(prices(spark, sf_dir))


def _daily_sql(table: str, key: str, time: str, price: str, volume: str) -> str:
    return f"""WITH prices AS (SELECT CAST({time} AS DATE) AS date, {key} AS coin_id,
  {price} AS price_usd, {volume} AS volume_24h FROM {table}), {X.SQL_DAILY} SELECT * FROM daily"""


@query(_daily_sql("lineitem", "l_returnflag || l_linestatus", "l_shipdate", "l_extendedprice",
                  "l_quantity"))
def daily_trends_lineitem(spark, sf_dir):
    return gold.daily_trends(X.table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.concat("l_returnflag", "l_linestatus").alias("coin_id"),
        F.col("l_extendedprice").alias("price_usd"), F.col("l_quantity").alias("volume_24h")))


@query(_daily_sql("orders", "o_orderpriority", "o_orderdate", "o_totalprice",
                  "CAST(o_custkey AS DOUBLE)"))
def daily_trends_orders(spark, sf_dir):
    return gold.daily_trends(X.table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("coin_id"),
        F.col("o_totalprice").alias("price_usd"),
        F.col("o_custkey").cast("double").alias("volume_24h")))


@query(f"WITH {X.SQL_PRICES}, {X.SQL_DAILY} SELECT * FROM daily")
def daily_trends_merged(spark, sf_dir):
    """Partials of separate hours of the day, merged."""
    rows = prices(spark, sf_dir).withColumn("part", F.hour("event_timestamp") % 4)
    parts = [gold.daily_partials(rows.filter(F.col("part") == n).drop("part")) for n in range(4)]
    return gold.merge_daily_partials(quality.union(*parts))


# == quality ================================================================

@query(f"WITH {X.SQL_TICKS} SELECT coin_id, event_timestamp, count(*) AS count "
       "FROM ticks GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(X.ticks(spark, sf_dir))


@query(f"""WITH {X.SQL_PRICES}, counted AS (
  SELECT count(*) FILTER (price_usd IS NULL) AS a, count(*) FILTER (price_usd = 0) AS b FROM prices)
SELECT 'null_prices' AS "check", 'error' AS severity,
       CASE WHEN a = 0 THEN 'pass' ELSE 'fail' END AS status,
       CAST(a AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold FROM counted
UNION ALL SELECT 'zero_prices', 'error', CASE WHEN b = 0 THEN 'pass' ELSE 'fail' END, b, 0.0
FROM counted""")
def null_prices(spark, sf_dir):
    price = F.col("price_usd")
    return quality.run_checks(prices(spark, sf_dir),
                              {"null_prices": price.isNull(), "zero_prices": price == 0})


_EXPECTED = ["click-0", "view-2", "refund-0", "refund-1"]


@query("SELECT e AS coin_id FROM (SELECT unnest(" + str(_EXPECTED) + f""") AS e)
WHERE e NOT IN (SELECT event_type || '-' || CAST(user_id % 3 AS VARCHAR) FROM events)""")
def missing_keys(spark, sf_dir):
    return quality.missing_keys(X.ticks(spark, sf_dir), _EXPECTED)


@query(f"WITH {X.SQL_FLAGGED} SELECT DISTINCT price_change_flag FROM flagged")
def flag_values(spark, sf_dir):
    return quality.distinct_values(flagged(spark, sf_dir))


@query(f"WITH {X.SQL_TICKS} SELECT count(DISTINCT date) AS partition_count FROM ticks")
def partition_count(spark, sf_dir):
    return quality.partition_count(X.ticks(spark, sf_dir))


@query(f"""WITH {X.SQL_TICKS} SELECT max(event_timestamp) AS latest_ts,
  (epoch(TIMESTAMP '{X.AS_OF}') - epoch(max(event_timestamp))) / 60 AS delay_mins,
  CASE WHEN (epoch(TIMESTAMP '{X.AS_OF}') - epoch(max(event_timestamp))) / 60 > 30
       THEN 'fail' ELSE 'pass' END AS status FROM ticks""")
def freshness(spark, sf_dir):
    return quality.freshness(X.ticks(spark, sf_dir), as_of=as_of())


@query(f"WITH {X.SQL_TICKS} SELECT coin_id, count(*) AS count FROM ticks GROUP BY coin_id")
def volume_per_key(spark, sf_dir):
    return quality.volume_per_key(X.ticks(spark, sf_dir))


_OUTSIDE = " OR ".join(f"(coin_id = '{name}' AND (price_usd < {low} OR price_usd > {high}))"
                       for name, (low, high) in X.BOUNDS.items())


@query(f"WITH {X.SQL_TICKS} SELECT {_TICK} FROM ticks WHERE {_OUTSIDE}")
def price_outliers(spark, sf_dir):
    return quality.price_outliers(X.ticks(spark, sf_dir), X.BOUNDS)


_JUMPS = """, moved AS (
  SELECT coin_id, event_timestamp, price_usd, lag(price_usd) OVER w AS prev_price,
         abs((price_usd - lag(price_usd) OVER w) / nullif(lag(price_usd) OVER w, 0)) AS pct_change
  FROM prices WINDOW w AS (PARTITION BY coin_id ORDER BY event_timestamp)),
jumps AS (SELECT * FROM moved WHERE pct_change > 0.20)"""


@query(f"WITH {X.SQL_PRICES}{_JUMPS} SELECT * FROM jumps")
def price_jumps(spark, sf_dir):
    return quality.price_jumps(prices(spark, sf_dir))


@query(f"""WITH {X.SQL_FLAGGED} SELECT 'negative_delay' AS "check", 'fatal' AS severity,
  CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status,
  CAST(count(*) AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold
FROM flagged WHERE ingestion_delay_seconds < 0""")
def negative_delay(spark, sf_dir):
    return quality.run_checks(flagged(spark, sf_dir),
                              {"negative_delay": F.col("ingestion_delay_seconds") < 0},
                              fatal=["negative_delay"])


@query(_MESSAGES + """SELECT count(*) AS total_rows,
  count(*) FILTER (event_type = 'error' OR price <= 0) AS corrupt_price_count,
  count(*) FILTER (event_type = 'error' OR price < 0) AS null_or_negative_price_count,
  count(*) FILTER (event_type = 'error') AS corrupt_symbol_count FROM messages""")
def corrupt_counts(spark, sf_dir):
    return quality.corrupt_counts(_cut_ticks(spark, sf_dir))


_STATS = f"""SELECT symbol, max(ingestion_delay_seconds) AS max_delay_secs,
  avg(ingestion_delay_seconds) AS avg_delay_secs FROM ({_CLEAN_TICKS} FROM messages) GROUP BY symbol"""


@query(_MESSAGES + _STATS)
def delay_stats(spark, sf_dir):
    return quality.delay_stats(clean_ticks(spark, sf_dir))


@query(f"""WITH {X.SQL_TICKS}, ranked AS (
  SELECT event_timestamp, CAST(rank() OVER (PARTITION BY event_timestamp
           ORDER BY volume_24h DESC NULLS LAST) AS INTEGER) AS market_cap_rank
  FROM (SELECT * FROM ticks QUALIFY row_number() OVER (
    PARTITION BY coin_id, event_timestamp ORDER BY ingested_at DESC, event_id DESC) = 1))
SELECT event_timestamp, market_cap_rank, count(*) AS count
FROM ranked GROUP BY ALL HAVING count(*) > 1""")
def rank_integrity(spark, sf_dir):
    """Volumes are whole numbers, so ranks by volume do tie."""
    return quality.rank_duplicates(gold.market_cap_rank(prices(spark, sf_dir), "volume_24h"))


@query(f"""WITH {X.SQL_PERFORMANCE} SELECT 'null_moving_average' AS "check", 'error' AS severity,
  CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status,
  CAST(count(*) AS DOUBLE) AS metric, 0.0::DOUBLE AS threshold
FROM performance WHERE moving_avg_price IS NULL""")
def ma_completeness(spark, sf_dir):
    return quality.run_checks(performance(spark, sf_dir),
                              {"null_moving_average": F.col("moving_avg_price").isNull()})


# Both tables are whole. The snapshot has another price for signups, and another
# name for one instrument, which is then missing on either side.
_SYNC = f"""WITH {X.SQL_PRICES}, latest AS (
  SELECT coin_id, price_usd FROM prices
  QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY event_timestamp DESC) = 1),
s AS (
  SELECT CASE WHEN coin_id = 'click-0' THEN 'renamed' ELSE coin_id END AS coin_id,
         CASE WHEN coin_id LIKE 'signup%' THEN price_usd + 1 ELSE price_usd END AS snapshot_price
  FROM latest),
p AS (SELECT coin_id, price_usd AS performance_price FROM latest),
synced AS (
  SELECT coin_id, snapshot_price, performance_price,
         CASE WHEN s.coin_id IS NULL THEN 'missing_in_snapshot'
              WHEN p.coin_id IS NULL THEN 'missing_in_performance'
              WHEN abs(snapshot_price - performance_price) <= 0.0001 THEN 'in_sync'
              ELSE 'out_of_sync' END AS status
  FROM s FULL JOIN p USING (coin_id))"""


def _sync_inputs(spark, sf_dir):
    rows = prices(spark, sf_dir)
    coin, price = F.col("coin_id"), F.col("price_usd")
    snapshot = gold.latest_snapshot(rows).withColumns({
        "coin_id": F.when(coin == "click-0", "renamed").otherwise(coin),
        "price_usd": F.when(coin.startswith("signup"), price + 1).otherwise(price)})
    return snapshot, rows


@query(_SYNC + " SELECT * FROM synced")
def cross_table_sync(spark, sf_dir):
    return quality.cross_table_sync(*_sync_inputs(spark, sf_dir))


def _check_sql(rows: list[tuple[str, str, str, str, str]]) -> str:
    """UNION of result rows (check, severity, status, metric, threshold)."""
    return " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", '{severity}' AS severity, {status} AS status,
            CAST({metric} AS DOUBLE) AS metric, CAST({threshold} AS DOUBLE) AS threshold"""
        for check, severity, status, metric, threshold in rows)


def _zero(check: str, severity: str, metric: str) -> tuple[str, str, str, str, str]:
    return check, severity, f"CASE WHEN {metric} = 0 THEN 'pass' ELSE 'fail' END", metric, "0"


_AGE = f"((SELECT epoch(TIMESTAMP '{X.AS_OF}') - epoch(max(event_timestamp)) FROM flagged) / 60)"


@query(f"WITH {X.SQL_FLAGGED}{_JUMPS} " + _check_sql([
    _zero("null_prices", "error", "(SELECT count(*) FROM flagged WHERE price_usd IS NULL)"),
    _zero("unknown_flags", "error", "0"),
    _zero("price_outliers", "error", f"(SELECT count(*) FROM flagged WHERE {_OUTSIDE})"),
    _zero("negative_delay", "error",
          "(SELECT count(*) FROM flagged WHERE ingestion_delay_seconds < 0)"),
    ("date_partitions", "info", "'info'", "(SELECT count(DISTINCT date) FROM flagged)", "NULL"),
    ("freshness_minutes", "warn", f"CASE WHEN {_AGE} > 30 THEN 'fail' ELSE 'pass' END", _AGE, "30"),
    _zero("duplicate_keys", "error", "0"),
    ("instruments", "info", "'info'", "(SELECT count(DISTINCT coin_id) FROM flagged)", "NULL"),
    _zero("price_jumps", "warn", "(SELECT count(*) FROM jumps)"),
]))
def silver_checks(spark, sf_dir):
    return quality.silver_checks(materialise(flagged(spark, sf_dir)), as_of(), bounds=X.BOUNDS)


@query(_MESSAGES + _check_sql([
    _zero("corrupt_price", "error",
          "(SELECT count(*) FROM messages WHERE event_type = 'error' OR price <= 0)"),
    _zero("corrupt_symbol", "error", "(SELECT count(*) FROM messages WHERE event_type = 'error')"),
    _zero("negative_delay", "error", "0"),
]))
def stream_silver_checks(spark, sf_dir):
    return quality.stream_silver_checks(
        silver.clean_ticks(_cut_ticks(spark, sf_dir), as_of=as_of()))


@query(f"WITH {X.SQL_PERFORMANCE} " + _check_sql([
    _zero("tied_ranks", "warn", """(SELECT count(*) FROM (SELECT 1 FROM performance
      GROUP BY event_timestamp, market_cap_rank HAVING count(*) > 1))"""),
    _zero("duplicate_keys", "error", "0"),
    _zero("null_moving_average", "error",
          "(SELECT count(*) FROM performance WHERE moving_avg_price IS NULL)"),
    _zero("out_of_sync", "error", "0"),
    _zero("missing_in_one_table", "warn", "0"),
]))
def gold_checks(spark, sf_dir):
    table = stored(spark, performance(spark, sf_dir), ("date",))
    return quality.gold_checks(table, gold.latest_snapshot(prices(spark, sf_dir)))


@query(_slots("hour") + ", wide AS (SELECT count(DISTINCT slot) AS n FROM slots) " + _check_sql(
    [_zero("corrupt_json", "fatal", "0"), _zero("missing_coins", "warn", "0"),
     _zero("missing_metadata", "fatal", "0")]
    + [_zero(f"null_price {c}", "warn",
             f"((SELECT n FROM wide) - (SELECT count(*) FROM slots WHERE coin_id = '{c}'))")
       for c in X.INSTRUMENTS]))
def bronze_checks(spark, sf_dir):
    path = sources.land_snapshots(X.documents(spark, sf_dir, "hour"), shared_dir(spark, "bronze"),
                                  one_per_file=False)
    documents = sources.read_snapshots(spark, path, X.INSTRUMENTS, multi_line=False)
    return quality.bronze_checks(documents, X.INSTRUMENTS)


# == reports ================================================================

@query(f"""WITH {X.SQL_PRICES}, {X.SQL_SNAPSHOT} SELECT coin_id, round(price_usd, 4) AS price_usd,
  round(market_cap, 2) AS market_cap_usd, round(volume_24h, 2) AS volume_24h_usd, event_timestamp
FROM snapshot ORDER BY market_cap_usd DESC""")
def snapshot_report(spark, sf_dir):
    return reports.snapshot_report(gold.latest_snapshot(prices(spark, sf_dir)))


@query(f"""WITH {X.SQL_PRICES}, {X.SQL_SNAPSHOT} SELECT coin_id,
  round(price_usd, 4) AS target_live_price, round(volume_24h, 2) AS aggregated_volume_usd,
  event_timestamp FROM snapshot ORDER BY target_live_price DESC""")
def snapshot_report_by_price(spark, sf_dir):
    return reports.snapshot_report(gold.latest_snapshot(prices(spark, sf_dir)), "price")


def _recent_sql(hours: int, average: str, volatility: str) -> str:
    return f"""WITH {X.SQL_PERFORMANCE} SELECT event_timestamp, coin_id,
  round(price_usd, 4) AS price_usd, round(moving_avg_price, 4) AS {average},
  round(price_volatility, 6) AS {volatility}, market_cap_rank FROM performance
WHERE event_timestamp >= (SELECT max(event_timestamp) FROM performance) - INTERVAL {hours} HOUR
ORDER BY event_timestamp DESC, market_cap_rank"""


_STREAM_NAMES = ("rolling_avg_price", "calculated_volatility_index")


@query(_recent_sql(24, "moving_avg_price_24h", "price_volatility_index"))
def performance_recent_24h(spark, sf_dir):
    return reports.performance_recent(stored(spark, performance(spark, sf_dir), ("date",)), 24)


@query(_recent_sql(1, *_STREAM_NAMES))
def performance_recent_1h(spark, sf_dir):
    return reports.performance_recent(stored(spark, performance(spark, sf_dir), ("date",)), 1,
                                      _STREAM_NAMES)


@query(f"""WITH {X.SQL_PRICES}, {X.SQL_DAILY} SELECT date, coin_id, daily_avg_price AS daily_avg,
  daily_max_price AS daily_peak, daily_min_price AS daily_floor,
  record_count AS total_sampled_ticks FROM daily ORDER BY date DESC, daily_avg DESC""")
def daily_report(spark, sf_dir):
    return reports.daily_report(daily_trends(spark, sf_dir))


@query(f"""WITH {X.SQL_PRICES}, {X.SQL_DAILY} SELECT date, coin_id, daily_avg_price,
  daily_max_price, daily_min_price, count(*) AS validation_ticks_sampled FROM daily GROUP BY ALL
ORDER BY date DESC, daily_avg_price DESC""")
def daily_report_sampled(spark, sf_dir):
    return reports.daily_report(daily_trends(spark, sf_dir), "sampled")


@query(f"WITH {X.SQL_TICKS} SELECT {_TICK} FROM ticks ORDER BY ingested_at DESC, event_id DESC LIMIT 15")
def latest_rows(spark, sf_dir):
    return reports.latest_rows(X.ticks(spark, sf_dir), order=X.NEWEST)


# == sinks ==================================================================

@query(f"WITH {X.SQL_PRICES} SELECT {_TICK} FROM prices")
def overwrite_table(spark, sf_dir):
    return stored(spark, prices(spark, sf_dir), ("date",))


@query(f"""WITH {X.SQL_PRICES} SELECT coin_id, event_timestamp, date,
  CASE WHEN date >= DATE '{X.SLICES[1]}' THEN price_usd * 2 ELSE price_usd END AS price_usd
FROM prices""")
def overwrite_partitions(spark, sf_dir):
    """A correction of the last days replaces their partitions only."""
    path = shared_dir(spark, "table")
    rows = prices(spark, sf_dir).select("coin_id", "event_timestamp", "date", "price_usd")
    sinks.overwrite_table(rows, path, ["date"])
    late = rows.filter(F.col("date") >= F.lit(X.SLICES[1]).cast("date"))
    sinks.overwrite_partitions(late.withColumn("price_usd", F.col("price_usd") * 2), path)
    return sources.read_table(spark, path)


@query(f"""WITH {X.SQL_TICKS} SELECT coin_id, event_id, price_usd,
  CASE WHEN ingested_at >= TIMESTAMP '{X.SLICES[1]}' THEN market_cap END AS market_cap FROM ticks""")
def merge_schema(spark, sf_dir):
    """Early files lack a column, later ones have it."""
    path = shared_dir(spark, "table")
    first, second, third = (X.ticks_of(part) for part in X.slices(spark, sf_dir))
    old = first.unionByName(second).select("coin_id", "event_id", "price_usd")
    old.write.parquet(f"{path}/part=0")
    third.select("coin_id", "event_id", "price_usd", "market_cap").write.parquet(f"{path}/part=1")
    return sources.read_table(spark, path, merge_schema=True).drop("part")


@query("""SELECT CAST(floor(epoch(ts)) AS DOUBLE) AS delay, event_id, CAST(NULL AS VARCHAR) AS note
FROM events""")
def align_schema(spark, sf_dir):
    """A long becomes the target's double; a column only the target has is null."""
    rows = X.table(spark, sf_dir, "events").select(
        F.unix_timestamp("ts").alias("delay"), "event_id", "value")
    target = spark.createDataFrame([], "delay double, event_id bigint, note string")
    return sinks.align_schema(rows, target)


@query(f"WITH {X.SQL_PRICES}, {X.SQL_SNAPSHOT} SELECT * FROM snapshot")
def upsert(spark, sf_dir):
    """The snapshot kept current over three arrivals."""
    path = shared_dir(spark, "snapshot")
    for part in X.slices(spark, sf_dir):
        arrived = silver.dedup_latest(X.ticks_of(part), order=X.NEWEST)
        sinks.upsert(gold.latest_snapshot(arrived), path, ["coin_id"], ["event_timestamp"])
    return sinks.read_current(spark, path)


@query(f"WITH {X.SQL_PRICES}, {X.SQL_DAILY} SELECT * FROM daily")
def batch_run(spark, sf_dir):
    """Landed documents to gold by the whole batch run; gives the daily trends."""
    tables = Tables(shared_dir(spark, "run"))
    sources.land_snapshots(X.documents(spark, sf_dir), tables.bronze, one_per_file=False)
    run_batch(spark, tables, X.INSTRUMENTS)
    return sources.read_table(spark, tables.daily)


@query(_slots("minute") + """, prices AS (
  SELECT coin_id, event_timestamp, price_usd, market_cap, volume_24h,
         CAST(event_timestamp AS DATE) AS date
  FROM slots QUALIFY row_number() OVER (
    PARTITION BY coin_id, event_timestamp ORDER BY slot DESC) = 1)""" + """
SELECT coin_id, event_timestamp, price_usd, market_cap, volume_24h,
  round(avg(price_usd) OVER w, 4) AS moving_avg_price,
  round(coalesce(stddev_samp(price_usd) OVER w, 0.0), 6) AS price_volatility,
  CAST(rank() OVER (PARTITION BY event_timestamp ORDER BY market_cap DESC NULLS LAST) AS INTEGER)
    AS market_cap_rank, date
FROM prices WINDOW w AS (PARTITION BY coin_id ORDER BY event_timestamp
                         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def batch_increment(spark, sf_dir):
    """A batch run on the first arrivals, then the last arrival added to it."""
    tables = Tables(shared_dir(spark, "run"))
    documents = X.documents(spark, sf_dir)
    late = F.col("ingestion_metadata.ingested_at") >= X.SLICES[1]
    sources.land_snapshots(documents.filter(~late), tables.bronze, one_per_file=False)
    run_batch(spark, tables, X.INSTRUMENTS)
    arrived = sources.land_snapshots(documents.filter(late), f"{tables.root}/arrived",
                                     one_per_file=False)
    run_increment(spark, tables, arrived, X.INSTRUMENTS)
    return sources.read_table(spark, tables.performance)


# == streaming ==============================================================

def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.messages_of(X.event_stream(spark, sf_dir))


def _drained(stream: DataFrame) -> DataFrame:
    """Run a stream over all there is into a new table, and read the table."""
    spark = stream.sparkSession
    use_rocksdb(spark)
    path = shared_dir(spark, "stream")
    sinks.append_stream(stream, f"{path}/table", f"{path}/checkpoint")
    return sources.read_table(spark, f"{path}/table")


@query(_MESSAGES + 'SELECT symbol, price, volume, "timestamp" FROM messages')
def stream_bronze(spark, sf_dir):
    return _drained(streaming.bronze_stream(_messages(spark, sf_dir)))


def _twice(df: DataFrame) -> DataFrame:
    """Every message sent two times."""
    return df.select("value", F.explode(F.array(F.lit(1), F.lit(2))).alias("n")).drop("n")


_UNIQUE = """SELECT symbol AS coin_id, "timestamp", date_trunc('second', ts) AS event_timestamp
FROM messages QUALIFY row_number() OVER (PARTITION BY symbol, "timestamp" ORDER BY ts) = 1"""


def _clean_stream(spark, sf_dir):
    return silver.clean_ticks(silver.parse_ticks(_twice(_messages(spark, sf_dir))), as_of=as_of())


@query(_MESSAGES + _UNIQUE)
def stream_dedup(spark, sf_dir):
    """Copies are dropped in the tasks first, then over all runs."""
    few = streaming.collapse_copies(_clean_stream(spark, sf_dir), ["coin_id", "timestamp"])
    unique = streaming.dedup(few)
    return _drained(unique.select("coin_id", "timestamp", "event_timestamp"))


@query(_MESSAGES + _UNIQUE)
def stream_dedup_watermark(spark, sf_dir):
    unique = streaming.dedup(_clean_stream(spark, sf_dir), watermark="1 hour")
    return _drained(unique.select("coin_id", "timestamp", "event_timestamp"))


@query(_MESSAGES + f"""{_CLEAN_TICKS}, TIMESTAMP '{X.AS_OF}' AS load_timestamp FROM messages
WHERE {_VALID} QUALIFY row_number() OVER (PARTITION BY symbol, "timestamp" ORDER BY ts) = 1""")
def stream_silver(spark, sf_dir):
    bronze = streaming.bronze_stream(_twice(_messages(spark, sf_dir)))
    return _drained(streaming.silver_stream(bronze, X.BOUNDS, as_of=as_of()))


_STREAM_SILVER = f"""WITH prices AS (
  SELECT event_type || '-' || CAST(user_id % 3 AS VARCHAR) AS coin_id, value AS price_usd,
         {X.K} AS volume_24h, date_trunc('second', ts) AS event_timestamp,
         CAST(ts AS DATE) AS date, epoch_us(ts) // 1000 AS ms
  FROM events WHERE value > 0
  QUALIFY row_number() OVER (PARTITION BY coin_id, ms ORDER BY ts) = 1)"""

_STREAM_SNAPSHOT = _STREAM_SILVER + """
SELECT coin_id, price_usd, volume_24h, event_timestamp FROM prices
QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY ms DESC) = 1"""

_STREAM_PERFORMANCE = _STREAM_SILVER + """
SELECT coin_id, event_timestamp, price_usd, volume_24h,
       round(avg(price_usd) OVER w, 4) AS moving_avg_price,
       round(coalesce(stddev_samp(price_usd) OVER w, 0.0), 6) AS price_volatility,
       CAST(rank() OVER (PARTITION BY event_timestamp ORDER BY price_usd DESC) AS INTEGER)
         AS market_cap_rank, date
FROM prices WINDOW w AS (PARTITION BY coin_id ORDER BY ms
                         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""

_STREAM_DAILY = _STREAM_SILVER + f", {X.SQL_DAILY} SELECT * FROM daily"


def _gold_once(spark: SparkSession, sf_dir: str) -> str:
    """The whole table as one micro-batch."""
    use_rocksdb(spark)
    root = shared_dir(spark, "gold")
    ticks = streaming.silver_stream(streaming.bronze_stream(_messages(spark, sf_dir)), {},
                                    as_of=as_of())
    streaming.gold_fanout(ticks, root, f"{root}_checkpoint")
    return root


def _gold_in_slices(spark: SparkSession, sf_dir: str) -> str:
    """Three arrivals, each a run from messages to silver and on to gold."""
    use_rocksdb(spark)
    base = shared_dir(spark, "slices")
    root = f"{base}/gold"
    for part in X.slices(spark, sf_dir):
        X.messages_of(part).write.mode("append").text(f"{base}/landed")
        messages = sources.tick_stream(spark, "files", f"{base}/landed")
        streaming.run_bronze(messages, f"{base}/bronze", f"{base}/c1")
        bronze = spark.read.parquet(f"{base}/bronze")
        streaming.run_silver(sources.stream_table(spark, f"{base}/bronze", bronze.schema),
                             f"{base}/silver", f"{base}/c2", bounds={}, as_of=as_of())
        ticks = spark.read.parquet(f"{base}/silver")
        streaming.gold_fanout(sources.stream_table(spark, f"{base}/silver", ticks.schema),
                              root, f"{base}/c3", mode="merge")
    return root


@query(_STREAM_SNAPSHOT)
def stream_latest_snapshot(spark, sf_dir):
    return streaming.read_snapshot(spark, _gold_once(spark, sf_dir))


@query(_STREAM_PERFORMANCE)
def stream_performance(spark, sf_dir):
    return streaming.read_performance(spark, _gold_once(spark, sf_dir))


@query(_STREAM_DAILY)
def stream_daily_trends(spark, sf_dir):
    return streaming.read_daily_trends(spark, _gold_once(spark, sf_dir))


@query(_STREAM_SNAPSHOT)
def stream_latest_snapshot_merged(spark, sf_dir):
    return streaming.read_snapshot(spark, _gold_in_slices(spark, sf_dir), "merge")


@query(_STREAM_PERFORMANCE)
def stream_rolling(spark, sf_dir):
    return streaming.read_performance(spark, _gold_in_slices(spark, sf_dir), "merge")


@query(_STREAM_DAILY)
def stream_daily_trends_merged(spark, sf_dir):
    return streaming.read_daily_trends(spark, _gold_in_slices(spark, sf_dir), "merge")


@query(_STREAM_DAILY)
def stream_daily_aggregate(spark, sf_dir):
    """Daily trends as a streaming aggregate, its full result a new version."""
    use_rocksdb(spark)
    path = shared_dir(spark, "daily")
    ticks = streaming.silver_stream(streaming.bronze_stream(_messages(spark, sf_dir)), {},
                                    as_of=as_of())
    totals = streaming.daily_trends_stream(ticks)
    run = (totals.writeStream.outputMode("complete")
           .foreachBatch(lambda batch, n: write_version(batch, f"{path}/table", n))
           .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    run.awaitTermination()
    return sinks.read_current(spark, f"{path}/table")
