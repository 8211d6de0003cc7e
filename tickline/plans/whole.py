"""Queries over every tick, with planted faults, and over several micro-batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline import fixtures as X
from tickline import sinks, sources, streaming
from tickline.operators import daystate, digests, gold, quality, series, silver
from tickline.plans import queries as Q
from tickline.plans.batch import Tables, run_batch, run_increment
from tickline.plans.batch import follow_silver as follow_gold
from tickline.plans.queries import query
from tickline.schemas import STREAM_SYNC_TOLERANCE
from tickline.session import materialise, shared_dir, use_rocksdb
from tickline.sinks import commits
from tickline.streaming.gold import DAILY, PERFORMANCE

ORDER = ("event_timestamp", "event_id")

# -- every tick --------------------------------------------------------------

SQL_EVERY = f"""WITH prices AS (
  SELECT event_type || '-' || CAST(user_id % 3 AS VARCHAR) AS coin_id, ts AS event_timestamp,
         ts AS ingested_at, event_id, value AS price_usd, value * (1 + {X.K}) AS market_cap,
         {X.K} AS volume_24h, CAST(ts AS DATE) AS date FROM events)"""


def every_tick(spark, sf_dir) -> DataFrame:
    """All events at their own times; some were sent twice, and de-duplicated.

    What is sent again is the same event: two events of an instrument at one moment are
    both ticks, so windows over them are in `ORDER`.
    """
    ticks = X.ticks(spark, sf_dir).withColumn("event_timestamp", F.col("ingested_at"))
    again = ticks.filter("event_id % 7 = 0").withColumn(
        "ingested_at", F.expr("ingested_at - INTERVAL 1 SECOND"))
    return silver.dedup_latest(ticks.unionByName(again), [*silver.SERIES, *ORDER], X.NEWEST)


SQL_FLAGGED = SQL_EVERY + """, flagged AS (
  SELECT *, CASE WHEN price_usd > lag(price_usd) OVER w THEN 'UP'
                 WHEN price_usd < lag(price_usd) OVER w THEN 'DOWN'
                 ELSE 'STABLE' END AS price_change_flag
  FROM prices WINDOW w AS (PARTITION BY coin_id ORDER BY event_timestamp))"""


@query(SQL_FLAGGED + " SELECT coin_id, event_timestamp, event_id, price_usd, price_change_flag FROM flagged")
def flag_every_tick(spark, sf_dir):
    flagged = silver.add_price_change_flag(materialise(every_tick(spark, sf_dir)), ORDER)
    return flagged.select("coin_id", "event_timestamp", "event_id", "price_usd", "price_change_flag")


@query(SQL_EVERY + Q._JUMPS + " SELECT coin_id, event_timestamp, price_usd, prev_price, pct_change FROM moved")
def moves_every_tick(spark, sf_dir):
    """Every tick's move; jumps are those above the limit."""
    return series.over_series(
        every_tick(spark, sf_dir).select(*silver.SERIES, *ORDER, "price_usd"), silver.SERIES, ORDER, 1,
        {"prev_price": lambda w: F.lag("price_usd").over(w),
         "pct_change": lambda w: F.abs(F.try_divide(F.col("price_usd") - F.lag("price_usd").over(w),
                                                    F.lag("price_usd").over(w)))}).drop("event_id")


@query(SQL_EVERY + Q._JUMPS + " SELECT coin_id, event_timestamp, price_usd, prev_price, pct_change FROM jumps")
def jumps_every_tick(spark, sf_dir):
    return quality.price_jumps(every_tick(spark, sf_dir), order=ORDER).drop("event_id")


SQL_PERFORMANCE = SQL_EVERY + """, performance AS (
  SELECT coin_id, event_timestamp, price_usd, market_cap, volume_24h,
         round(avg(price_usd) OVER w, 4) AS moving_avg_price,
         round(coalesce(stddev_samp(price_usd) OVER w, 0.0), 6) AS price_volatility,
         CAST(rank() OVER (PARTITION BY event_timestamp ORDER BY market_cap DESC NULLS LAST) AS INTEGER)
           AS market_cap_rank, date
  FROM prices WINDOW w AS (PARTITION BY coin_id ORDER BY event_timestamp
                           ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


@query(SQL_PERFORMANCE + f" SELECT {Q._PERFORMANCE} FROM performance")
def performance_every_tick(spark, sf_dir):
    return gold.price_performance(every_tick(spark, sf_dir), ORDER)


# -- planted faults ----------------------------------------------------------

_BAD = {"price": 97, "flag": 101, "delay": 103, "again": 107}  # one event in so many

SQL_BAD_SILVER = SQL_FLAGGED + f""", once AS (
  SELECT coin_id, event_timestamp, event_id, date,
         CASE WHEN event_id % {_BAD['price']} <> 0 THEN price_usd END AS price_usd,
         CASE WHEN event_id % {_BAD['flag']} = 0 THEN 'SIDEWAYS' ELSE price_change_flag END AS price_change_flag,
         CASE WHEN event_id % {_BAD['delay']} = 0 THEN -5 ELSE 5 END AS ingestion_delay_seconds FROM flagged),
bad AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE event_id % {_BAD['again']} = 0),
moved AS (SELECT abs((price_usd - lag(price_usd) OVER w) / nullif(lag(price_usd) OVER w, 0)) AS pct_change
  FROM bad WINDOW w AS (PARTITION BY coin_id ORDER BY event_timestamp, event_id))"""

_AGE = f"((SELECT floor(epoch(TIMESTAMP '{X.AS_OF}')) - floor(epoch(max(event_timestamp))) FROM bad) / 60)"


SQL_SILVER_FAULTS = SQL_BAD_SILVER + Q._check_sql([
    Q._zero("null_prices", "error", "(SELECT count(*) FROM bad WHERE price_usd IS NULL)"),
    Q._zero("unknown_flags", "error", "(SELECT count(*) FROM bad WHERE price_change_flag = 'SIDEWAYS')"),
    Q._zero("price_outliers", "error", f"(SELECT count(*) FROM bad WHERE {Q._OUTSIDE})"),
    Q._zero("negative_delay", "error", "(SELECT count(*) FROM bad WHERE ingestion_delay_seconds < 0)"),
    ("date_partitions", "info", "'info'", "(SELECT count(DISTINCT date) FROM bad)", "NULL"),
    ("freshness_minutes", "warn", f"CASE WHEN {_AGE} > 30 THEN 'fail' ELSE 'pass' END", _AGE, "30"),
    Q._zero("duplicate_keys", "error", """(SELECT count(*) FROM (SELECT 1 FROM bad
      GROUP BY coin_id, event_timestamp HAVING count(*) > 1))"""),
    ("instruments", "info", "'info'", "(SELECT count(DISTINCT coin_id) FROM bad)", "NULL"),
    Q._zero("price_jumps", "warn", "(SELECT count(*) FROM moved WHERE pct_change > 0.20)"),
])


def _bad_silver(spark, sf_dir) -> DataFrame:
    """Every tick, with something to find for every check of the silver table."""
    flagged = silver.add_price_change_flag(materialise(every_tick(spark, sf_dir)), ORDER)
    one_in = lambda kind: F.col("event_id") % _BAD[kind] == 0
    once = (flagged.withColumn("price_usd", F.when(~one_in("price"), F.col("price_usd")))
            .withColumn("price_change_flag", F.when(one_in("flag"), "SIDEWAYS").otherwise(F.col("price_change_flag")))
            .withColumn("ingestion_delay_seconds", F.when(one_in("delay"), -5).otherwise(5)))
    return materialise(once.unionByName(once.filter(one_in("again"))))


@query(SQL_SILVER_FAULTS)
def silver_faults_every_tick(spark, sf_dir):
    """Every check of the silver table has something to find."""
    return quality.silver_checks(_bad_silver(spark, sf_dir), Q.as_of(), bounds=X.BOUNDS, order=ORDER)


def _states(spark, sf_dir) -> DataFrame:
    """Check state of three runs of days, made one after the other and stored side by side."""
    bad, path = _bad_silver(spark, sf_dir), shared_dir(spark, "check_state")
    first, second = (F.lit(d).cast("date") for d in X.SLICES)
    date = F.col("date")
    for within in (date < first, (date >= first) & (date < second), date >= second):
        sinks.overwrite_partitions(daystate.day_state(bad, X.BOUNDS, order=ORDER, within=within), path)
    return sources.read_table(spark, path)


@query(SQL_SILVER_FAULTS)
def silver_faults_by_state(spark, sf_dir):
    """The same checks from stored states of days."""
    return daystate.state_checks(_states(spark, sf_dir), Q.as_of())


@query(SQL_BAD_SILVER + """ SELECT coin_id, count(*) AS rows, max(ingestion_delay_seconds) AS max_delay_secs,
  CAST(sum(ingestion_delay_seconds) AS DOUBLE) / count(*) AS avg_delay_secs, 5 AS delay_p50, true AS moments_close
  FROM bad GROUP BY coin_id""")
def delays_by_state(spark, sf_dir):
    """Delays per instrument from stored states; the estimate of distinct moments is within 3 % of their number."""
    states = _states(spark, sf_dir)
    exact = every_tick(spark, sf_dir).groupBy("coin_id").agg(F.count_distinct("event_timestamp").alias("moments"))
    figures = daystate.delay_figures(states, quantiles=(0.5,)).join(exact, "coin_id")
    close = F.abs(F.col("distinct_moments") - F.col("moments")) <= F.greatest(F.lit(1), 0.03 * F.col("moments"))
    return figures.select("coin_id", "rows", "max_delay_secs", "avg_delay_secs", "delay_p50", close.alias("moments_close"))


SQL_BAD_GOLD = SQL_PERFORMANCE + """, marked AS (SELECT *, CAST(floor(epoch(event_timestamp)) AS BIGINT) AS s FROM performance),
once AS (SELECT * REPLACE (CASE WHEN s % 97 <> 0 THEN moving_avg_price END AS moving_avg_price) FROM marked),
bad AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE s % 101 = 0),
latest AS (SELECT coin_id, price_usd FROM prices
  QUALIFY row_number() OVER (PARTITION BY coin_id ORDER BY event_timestamp DESC) = 1)"""


@query(SQL_BAD_GOLD + Q._check_sql([
    Q._zero("tied_ranks", "warn", """(SELECT count(*) FROM (SELECT 1 FROM bad
      GROUP BY event_timestamp, market_cap_rank HAVING count(*) > 1))"""),
    Q._zero("null_moving_average", "error", "(SELECT count(*) FROM bad WHERE moving_avg_price IS NULL)"),
    Q._zero("duplicate_keys", "error", """(SELECT count(*) FROM (SELECT 1 FROM bad
      GROUP BY coin_id, event_timestamp HAVING count(*) > 1))"""),
    Q._zero("out_of_sync", "error", "(SELECT count(*) FROM latest WHERE coin_id LIKE 'signup%')"),
    Q._zero("missing_in_one_table", "warn", "(SELECT 2 * count(*) FROM latest WHERE coin_id = 'click-0')"),
]))
def gold_faults_every_tick(spark, sf_dir):
    """A null average, repeated keys, prices out of step, an instrument renamed on one side."""
    second = F.unix_timestamp("event_timestamp")
    once = gold.price_performance(every_tick(spark, sf_dir), ORDER).withColumn(
        "moving_avg_price", F.when(second % 97 != 0, F.col("moving_avg_price")))
    bad = materialise(once.unionByName(once.filter(second % 101 == 0)))
    coin, price = F.col("coin_id"), F.col("price_usd")
    newest = ("event_timestamp", "price_usd")  # the performance table holds no event ids
    snapshot = gold.latest_snapshot(every_tick(spark, sf_dir), newest).withColumns({
        "coin_id": F.when(coin == "click-0", "renamed").otherwise(coin),
        "price_usd": F.when(coin.startswith("signup"), price + 1).otherwise(price)})
    return quality.gold_checks(bad, snapshot, order=newest)


_DOCS = Q._slots("minute") + """, docs AS (
  SELECT DISTINCT slot, epoch(slot) // 60 % 53 = 0 AS cut, epoch(slot) // 60 % 59 = 0 AS bare FROM slots),
whole AS (SELECT s.* FROM slots s JOIN docs USING (slot) WHERE NOT cut)"""


@query(_DOCS + Q._check_sql(
    [Q._zero("corrupt_json", "fatal", "(SELECT count(*) FROM docs WHERE cut)"),
     Q._zero("missing_coins", "warn", "1"),
     Q._zero("missing_metadata", "fatal", "(SELECT count(*) FROM docs WHERE cut OR bare)")]
    + [Q._zero(f"null_price {c}", "warn",
               f"((SELECT count(*) FROM docs) - (SELECT count(*) FROM whole WHERE coin_id = '{c}'))")
       for c in X.INSTRUMENTS if c != "view-2"]
    + [("null_price view-2", "warn", "'skip'", "(SELECT count(*) FROM docs)", "0")]))
def bronze_faults(spark, sf_dir):
    """Documents cut off, documents without metadata, and one coin in none of them."""
    documents = X.documents(spark, sf_dir).drop("view-2")
    minute = F.floor(F.unix_timestamp(F.to_timestamp("ingestion_metadata.ingested_at")) / 60)
    documents = documents.withColumn("__minute", minute)
    bare = documents.withColumn("ingestion_metadata", F.when(F.col("__minute") % 59 != 0, F.col("ingestion_metadata")))
    names = [F.col(f"`{c}`") for c in documents.columns if c != "__minute"]
    text = F.to_json(F.struct(*names))
    path = shared_dir(spark, "bronze")
    bare.select(F.when(F.col("__minute") % 53 != 0, text).otherwise(F.substring(text, 1, 40))) \
        .write.text(f"{path}/lines_faulty")
    return quality.bronze_checks(sources.read_snapshots(spark, f"{path}/*", X.INSTRUMENTS), X.INSTRUMENTS)


@query(Q._slots("hour") + " SELECT count(DISTINCT slot) AS documents FROM slots")
def snapshot_lines_default(spark, sf_dir):
    """Landed and read with the default arguments, no document is lost."""
    path = sources.land_snapshots(X.documents(spark, sf_dir, "hour"), shared_dir(spark, "bronze"))
    return sources.read_snapshots(spark, path, X.INSTRUMENTS).agg(F.count(F.lit(1)).alias("documents"))


@query(Q._slots("minute") + f""", dated AS (
  SELECT coin_id, slot, price_usd, CASE WHEN slot < TIMESTAMP '{X.SLICES[1]}' THEN event_timestamp END AS event_timestamp
  FROM slots)
SELECT coin_id, event_timestamp, price_usd FROM dated
QUALIFY row_number() OVER (PARTITION BY coin_id, event_timestamp ORDER BY slot DESC) = 1""")
def batch_increment_undated(spark, sf_dir):
    """The last arrival's quotes have no time of their own; they are kept all the same."""
    tables = Tables(shared_dir(spark, "run"))
    documents = X.documents(spark, sf_dir)
    late = F.col("ingestion_metadata.ingested_at") >= X.SLICES[1]
    sources.land_snapshots(documents.filter(~late), tables.bronze)
    run_batch(spark, tables, X.INSTRUMENTS)
    undated = documents.filter(late).withColumns(
        {c: F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{c}`").withField("last_updated_at", F.lit(None).cast("long")))
         for c in X.INSTRUMENTS})
    arrived = sources.land_snapshots(undated, f"{tables.root}/arrived")
    run_increment(spark, tables, arrived, X.INSTRUMENTS)
    return sources.read_table(spark, tables.silver).select("coin_id", "event_timestamp", "price_usd")


@query(Q.ORACLES["batch_increment"])
def follow_silver(spark, sf_dir):
    """Gold kept by a stream over silver, which a run and two increments rewrite; the middle days arrive last."""
    lake, documents = Tables(shared_dir(spark, "lake")), X.documents(spark, sf_dir)
    at = F.col("ingestion_metadata.ingested_at")
    early, late = at < X.SLICES[0], at >= X.SLICES[1]
    sources.land_snapshots(documents.filter(early), lake.bronze)
    run_batch(spark, lake, X.INSTRUMENTS)
    checkpoint = f"{lake.root}/checkpoint"
    follow_gold(spark, lake, checkpoint)
    for n, part in enumerate((late, ~early & ~late)):
        arrived = sources.land_snapshots(documents.filter(part), f"{lake.root}/arrived{n}")
        run_increment(spark, lake, arrived, X.INSTRUMENTS)
        follow_gold(spark, lake, checkpoint)
    return sources.read_table(spark, lake.performance)


_UNLIKE = {"price": 211, "gone": 223, "again": 227}

SQL_DIFFERENCES = SQL_PERFORMANCE + f""", l AS (SELECT *, CAST(floor(epoch(event_timestamp)) AS BIGINT) AS s FROM performance
  WHERE date <> DATE '2024-01-05'),
kinds AS (SELECT *, date >= DATE '2024-01-15' AS late FROM l)
SELECT coin_id, event_timestamp,
  CAST(CASE WHEN s % {_UNLIKE['gone']} = 0 OR s % {_UNLIKE['price']} = 0 THEN 1 ELSE 0 END AS BIGINT) AS left_only,
  CAST(CASE WHEN s % {_UNLIKE['gone']} = 0 THEN 0
            WHEN s % {_UNLIKE['price']} = 0 THEN CASE WHEN s % {_UNLIKE['again']} = 0 THEN 2 ELSE 1 END
            ELSE 1 END AS BIGINT) AS right_only,
  CASE WHEN s % {_UNLIKE['gone']} <> 0 AND s % {_UNLIKE['price']} = 0 AND s % {_UNLIKE['again']} <> 0
       THEN 'price_usd' END AS unlike
FROM kinds WHERE late AND (s % {_UNLIKE['gone']} = 0 OR s % {_UNLIKE['price']} = 0 OR s % {_UNLIKE['again']} = 0)"""


@query(SQL_DIFFERENCES)
def table_differences(spark, sf_dir):
    """A copy of the performance table with other prices, rows lost and rows repeated from some day on."""
    left = Q.stored(spark, gold.price_performance(every_tick(spark, sf_dir), ORDER).filter("date <> DATE '2024-01-05'"), ("date",))
    one_in = lambda kind: (F.unix_timestamp(F.col("event_timestamp").cast("timestamp")) % _UNLIKE[kind] == 0) & (
        F.col("date") >= F.lit("2024-01-15"))
    once = left.filter(~one_in("gone")).withColumn("price_usd", F.when(one_in("price"), F.col("price_usd") + 1).otherwise(F.col("price_usd")))
    right = Q.stored(spark, once.unionByName(once.filter(one_in("again"))), ("date",))
    found = digests.compare(left, right)
    return found.select("coin_id", "event_timestamp", "left_only", "right_only", F.array_join("columns", ",").alias("unlike"))


# -- several micro-batches ---------------------------------------------------

@query(Q._MESSAGES + Q._UNIQUE)
def stream_dedup_late(spark, sf_dir):
    """Messages of the last days come first, one file to a micro-batch; none is lost."""
    use_rocksdb(spark)
    base = shared_dir(spark, "late")
    for part in reversed(X.slices(spark, sf_dir)):
        Q._twice(X.messages_of(part)).coalesce(2).write.mode("append").text(f"{base}/landed")
    messages = sources.tick_stream(spark, "files", f"{base}/landed", maxFilesPerTrigger="1")
    ticks = silver.clean_ticks(silver.parse_ticks(messages), as_of=Q.as_of())
    return Q._drained(streaming.dedup(ticks).select("coin_id", "timestamp", "event_timestamp"))


@query(Q._MESSAGES + Q._UNIQUE)
def stream_dedup_tiers(spark, sf_dir):
    """Four arrivals days apart, the last days first, and all ticks once more at the end; state of one day of arrivals."""
    use_rocksdb(spark)
    base = shared_dir(spark, "tiers")
    parts = X.slices(spark, sf_dir)
    for k, part in enumerate([*reversed(parts), X.table(spark, sf_dir, "events")]):
        Q._twice(X.messages_of(part)).write.mode("append").text(f"{base}/landed")
        messages = sources.tick_stream(spark, "files", f"{base}/landed")
        arrived = F.lit(X.AS_OF).cast("timestamp") + F.make_dt_interval(F.lit(3 * k))
        streaming.run_silver_tiers(silver.parse_ticks(messages), f"{base}/silver", f"{base}/checkpoint",
                                   bounds={}, as_of=arrived)
    return sources.read_table(spark, f"{base}/silver").select("coin_id", "timestamp", "event_timestamp")


def _gold_of(spark, parts, mode: str, fold: bool = False, fold_first: int = 0) -> tuple[str, str]:
    """Each part a run from messages to gold, the first `fold_first` or all of them folded; (gold root, silver table)."""
    use_rocksdb(spark)
    base = shared_dir(spark, "slices")
    for k, part in enumerate(parts):
        X.messages_of(part).write.mode("append").text(f"{base}/landed")
        messages = sources.tick_stream(spark, "files", f"{base}/landed")
        streaming.run_bronze(messages, f"{base}/bronze", f"{base}/c1")
        bronze = spark.read.parquet(f"{base}/bronze")
        streaming.run_silver(sources.stream_table(spark, f"{base}/bronze", bronze.schema),
                             f"{base}/silver", f"{base}/c2", bounds={}, as_of=Q.as_of())
        ticks = spark.read.parquet(f"{base}/silver")
        streaming.gold_fanout(sources.stream_table(spark, f"{base}/silver", ticks.schema),
                              f"{base}/gold", f"{base}/c3", mode=mode)
        if fold or k < fold_first:
            streaming.fold_batches(spark, f"{base}/gold", mode)
            commits.drop_folded(spark, f"{base}/gold", [PERFORMANCE, DAILY])
    return f"{base}/gold", f"{base}/silver"


@query(Q._STREAM_PERFORMANCE)
def stream_rolling_late(spark, sf_dir):
    """The middle days arrive last; the windows after them are revised."""
    first, middle, last = X.slices(spark, sf_dir)
    root, _ = _gold_of(spark, (first, last, middle), "merge")
    return streaming.read_performance(spark, root, "merge")


@query(Q._STREAM_PERFORMANCE)
def stream_folded(spark, sf_dir):
    """Late days again, with all micro-batches folded into one folder per day after each run."""
    first, middle, last = X.slices(spark, sf_dir)
    return streaming.read_performance(spark, _gold_of(spark, (first, last, middle), "merge", fold=True)[0], "merge")


@query(Q._STREAM_PERFORMANCE)
def stream_ranks_of_folded_days(spark, sf_dir):
    """Two runs folded with ranks, then late days: the days that they leave alone are not ranked again."""
    first, middle, last = X.slices(spark, sf_dir)
    root, _ = _gold_of(spark, (first, last, middle), "merge", fold_first=2)
    return streaming.read_performance(spark, root, "merge")


@query(f"""WITH w AS ({Q._STREAM_PERFORMANCE}) SELECT event_timestamp, coin_id, round(price_usd, 4) AS price_usd,
  round(moving_avg_price, 4) AS rolling_avg_price, round(price_volatility, 6) AS calculated_volatility_index, market_cap_rank
FROM w WHERE event_timestamp >= (SELECT max(event_timestamp) FROM w) - INTERVAL 24 HOUR""")
def stream_recent_performance(spark, sf_dir):
    """The last day's rows of a merged stream, found by folder names; the days before are not read."""
    first, middle, last = X.slices(spark, sf_dir)
    return streaming.recent_performance(spark, _gold_of(spark, (first, last, middle), "merge", fold_first=2)[0], 24, "merge")


@query(f"""WITH {X.SQL_TICKS}, newest AS (SELECT max(event_timestamp) AS latest_ts FROM ticks)
SELECT latest_ts, (epoch(TIMESTAMP '{X.AS_OF}') - epoch(latest_ts)) / 60 AS delay_mins,
  CASE WHEN (epoch(TIMESTAMP '{X.AS_OF}') - epoch(latest_ts)) / 60 > 30 THEN 'fail' ELSE 'pass' END AS status FROM newest""")
def freshness_newest_day(spark, sf_dir):
    """Freshness of a stored table from its newest day alone."""
    path = shared_dir(spark, "fresh")
    sinks.overwrite_table(X.ticks(spark, sf_dir), path, ["date"])
    return quality.freshness(sources.read_newest_day(spark, path), as_of=Q.as_of())


@query(Q._STREAM_DAILY)
def stream_daily_folded(spark, sf_dir):
    """Daily partials folded after each of three runs."""
    return streaming.read_daily_trends(spark, _gold_of(spark, X.slices(spark, sf_dir), "merge", fold=True)[0], "merge")


@query(Q._STREAM_DAILY)
def stream_daily_upsert(spark, sf_dir):
    """Daily trends in update mode: each run writes the buckets of the days that it changed."""
    use_rocksdb(spark)
    base = shared_dir(spark, "daily_upsert")
    for part in X.slices(spark, sf_dir):
        X.messages_of(part).write.mode("append").text(f"{base}/landed")
        messages = sources.tick_stream(spark, "files", f"{base}/landed")
        ticks = streaming.silver_stream(streaming.bronze_stream(messages), {}, as_of=Q.as_of())
        streaming.daily_trends_upsert(ticks, f"{base}/table", f"{base}/checkpoint")
    return sinks.read_buckets(spark, f"{base}/table")


@query(SQL_EVERY + " SELECT user_id, event_id, price_usd, event_timestamp FROM prices JOIN (SELECT event_id, user_id FROM events) USING (event_id)"
       " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC) = 1")
def upsert_buckets(spark, sf_dir):
    """The latest event of every user over three arrivals, the last days before the middle ones."""
    path = shared_dir(spark, "users")
    first, middle, last = X.slices(spark, sf_dir)
    for part in (first, last, middle):
        latest = part.select("user_id", "event_id", F.col("value").alias("price_usd"), F.col("ts").alias("event_timestamp"))
        sinks.upsert_buckets(latest, path, ["user_id"], ["event_timestamp"], buckets=16)
    return sinks.read_buckets(spark, path)


@query(Q._STREAM_PERFORMANCE)
def stream_replay(spark, sf_dir):
    """All ticks once more under a new checkpoint replace what is there."""
    root, table = _gold_of(spark, X.slices(spark, sf_dir), "merge")
    ticks = spark.read.parquet(table)
    streaming.gold_fanout(sources.stream_table(spark, table, ticks.schema), root, f"{root}_replay",
                          mode="merge", replace=True)
    return streaming.read_performance(spark, root, "merge")


_PART = f"""CASE WHEN date < DATE '{X.SLICES[0]}' THEN 0 WHEN date < DATE '{X.SLICES[1]}' THEN 1 ELSE 2 END"""


@query(Q._STREAM_SILVER + f""" SELECT coin_id, event_timestamp, price_usd, volume_24h,
  round(avg(price_usd) OVER w, 4) AS moving_avg_price,
  round(coalesce(stddev_samp(price_usd) OVER w, 0.0), 6) AS price_volatility,
  CAST(rank() OVER (PARTITION BY event_timestamp ORDER BY price_usd DESC) AS INTEGER) AS market_cap_rank, date
FROM prices WINDOW w AS (PARTITION BY coin_id, {_PART} ORDER BY ms ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def stream_performance_append(spark, sf_dir):
    """Three micro-batches, each with windows of its own."""
    return streaming.read_performance(spark, _gold_of(spark, X.slices(spark, sf_dir), "append")[0])


@query(Q._STREAM_SILVER + f""" SELECT coin_id, price_usd, volume_24h, event_timestamp FROM prices
QUALIFY row_number() OVER (PARTITION BY coin_id, {_PART} ORDER BY ms DESC) = 1""")
def stream_snapshot_append(spark, sf_dir):
    return streaming.read_snapshot(spark, _gold_of(spark, X.slices(spark, sf_dir), "append")[0])


@query(Q._STREAM_PERFORMANCE.replace("SELECT coin_id, event_timestamp, price_usd, volume_24h,",
                                     ", performance AS (SELECT coin_id, event_timestamp, ms, price_usd,", 1) + ") "
       + Q._check_sql([
           Q._zero("tied_ranks", "warn", """(SELECT count(*) FROM (SELECT 1 FROM performance
             GROUP BY event_timestamp, market_cap_rank HAVING count(*) > 1))"""),
           Q._zero("null_moving_average", "error", "(SELECT count(*) FROM performance WHERE moving_avg_price IS NULL)"),
           Q._zero("duplicate_keys", "error", """(SELECT count(*) FROM (SELECT 1 FROM performance
             GROUP BY coin_id, event_timestamp, ms HAVING count(*) > 1))"""),
           Q._zero("out_of_sync", "error", "(SELECT count(*) FROM performance WHERE price_usd < -1e300)"),
           Q._zero("missing_in_one_table", "warn", "(SELECT count(*) FROM performance WHERE coin_id IS NULL)")]))
def stream_gold_checks(spark, sf_dir):
    """Gold tables of a stream: keys to the millisecond, and the stream's tolerance."""
    root, _ = _gold_of(spark, X.slices(spark, sf_dir), "merge")
    return quality.gold_checks(
        streaming.read_performance(spark, root, "merge", keep_order=True),
        streaming.read_snapshot(spark, root, "merge"), STREAM_SYNC_TOLERANCE,
        order=("event_timestamp", "timestamp"), keys=("coin_id", "event_timestamp", "timestamp"))


# -- catalog -----------------------------------------------------------------

@query(f"WITH {X.SQL_PRICES} SELECT {Q._TICK}, kind FROM prices, (VALUES ('managed'), ('external')) AS k(kind)")
def catalog_table(spark, sf_dir):
    """The same table by name, in the warehouse and at a path of its own."""
    schema = f"market_{uuid.uuid4().hex[:12]}"
    sinks.ensure_schema(spark, schema)
    rows = materialise(Q.prices(spark, sf_dir))
    sinks.overwrite_table(rows, table=f"{schema}.prices", partition_by=["date"])
    sinks.overwrite_table(rows, shared_dir(spark, "external"), ["date"], table=f"{schema}.outside")
    managed, external = (sources.read_table(spark, f"{schema}.{t}") for t in ("prices", "outside"))
    return managed.withColumn("kind", F.lit("managed")).unionByName(external.withColumn("kind", F.lit("external")))


@query(Q._MESSAGES + 'SELECT symbol, price, volume, "timestamp" FROM messages')
def stream_to_table(spark, sf_dir):
    """A bronze stream into a catalog table."""
    schema = f"stream_{uuid.uuid4().hex[:12]}"
    sinks.ensure_schema(spark, schema)
    sinks.append_stream(streaming.bronze_stream(Q._messages(spark, sf_dir)), None,
                        f"{shared_dir(spark, 'catalog')}/checkpoint", table=f"{schema}.bronze")
    return sources.read_table(spark, f"{schema}.bronze")
