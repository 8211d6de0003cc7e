"""The batch run: landed snapshots to silver, gold and their check results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickline import sources
from tickline.functions import columns as C
from tickline.operators import daystate, gold, quality, series, silver
from tickline.operators.nearby import SEGMENT, nearby
from tickline.schemas import INSTRUMENTS, PRICE_BOUNDS, ROLLING_ROWS
from tickline.session import materialise, stages
from tickline.sinks import align_schema, files, overwrite_partitions, overwrite_table
from tickline.sources.changes import note_all, note_days, on_days, stream_changes

SORTED = ["coin_id", "event_timestamp"]
PRICED = ["coin_id", "event_timestamp", "price_usd", "market_cap", "volume_24h", "date"]


@dataclass(frozen=True)
class Tables:
    """Where a run keeps its tables."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/prices"

    @property
    def state(self) -> str:
        return f"{self.root}/silver/check_state"

    @property
    def snapshot(self) -> str:
        return f"{self.root}/gold/latest_snapshot"

    @property
    def performance(self) -> str:
        return f"{self.root}/gold/price_performance"

    @property
    def daily(self) -> str:
        return f"{self.root}/gold/daily_trends"


def build_silver(documents: DataFrame, coins: Sequence[str] = INSTRUMENTS,
                 as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Snapshot documents to the silver table.

    The unique rows are written once before the flag, which reads its input
    twice: documents are costly to parse.
    """
    unique = materialise(silver.clean_snapshots(documents, coins), "unique_prices")
    return silver.stamp(silver.add_price_change_flag(unique), as_of)


def write_gold(prices: DataFrame, tables: Tables) -> None:
    overwrite_table(gold.latest_snapshot(prices), tables.snapshot)
    overwrite_table(gold.price_performance(prices), tables.performance, ["date"], sort_by=SORTED)
    overwrite_table(gold.daily_trends(prices), tables.daily, ["date"])


def refresh_gold(prices: DataFrame, tables: Tables, since: dt.date | None,
                 days: Column, touched: Column) -> None:
    """Bring gold up to date after changes to silver on `days`, the first of them `since`.

    Windows also change on `touched` days, which hold the next rows of changed
    series. Earlier days give only the last rows per instrument, which Spark
    picks before any shuffle; other days' gold partitions stay as they are.
    """
    recent = prices.filter(_from(since))
    earlier = materialise(
        series.last_rows(prices.filter(_before(since)), silver.SERIES,
                         ["event_timestamp"], ROLLING_ROWS - 1), "earlier_prices")
    held = [c for c in PRICED if c in prices.columns]
    performance = gold.price_performance(recent, prior=earlier.select(*held)).filter(touched)
    _replace_days(performance, tables.performance, sort_by=SORTED)
    _replace_days(gold.daily_trends(recent.filter(days)), tables.daily)
    overwrite_table(gold.latest_snapshot(recent.unionByName(earlier)), tables.snapshot)


def _unique_rows_near(prices: DataFrame, marks: DataFrame, rows: int, following: int) -> DataFrame:
    """Rows of the days around the marks, with `__new` where a row is one of them."""
    keys = [*silver.SERIES, "event_timestamp"]
    near, placed = nearby(prices, marks.select(*keys, "date"), silver.SERIES, ["event_timestamp"], rows, following)
    fresh = placed.select(*keys).distinct().withColumn("__new", F.lit(True))
    return near.join(fresh, keys, "left").withColumn("__new", F.coalesce("__new", F.lit(False)))


def refresh_days(prices: DataFrame, tables: Tables, changed: DataFrame) -> None:
    """Bring gold up to date after `changed` rows of silver (keys and date), reading few days.

    Windows change at those rows and at the next ones of their series. What else
    is on these days keeps its figures; ranks are taken anew per moment.
    """
    spark = prices.sparkSession
    days = [r[0] for r in changed.select("date").distinct().collect()]
    _replace_days(gold.daily_trends(prices.filter(on_days(days))), tables.daily)

    latest = gold.latest_snapshot(prices.filter(on_days(days)))
    stored = sources.read_table(spark, tables.snapshot).withColumn("__date", F.to_date("event_timestamp"))
    other = stored.filter(~F.col("__date").isin(days) | F.col("__date").isNull()).drop("__date")
    overwrite_table(materialise(gold.latest_snapshot(other.unionByName(latest)), "snapshot"), tables.snapshot)

    held = [c for c in PRICED if c in prices.columns]
    metrics = ["moving_avg_price", "price_volatility"]
    near = _unique_rows_near(prices.select(*held), changed, ROLLING_ROWS - 1, ROLLING_ROWS - 1)
    touched = {"__near": lambda w: F.max("__new").over(w.rowsBetween(-(ROLLING_ROWS - 1), 0))}
    rolled = materialise(series.over_series(
        near, [*silver.SERIES, SEGMENT], ["event_timestamp"], ROLLING_ROWS - 1,
        {**gold.rolling_columns(), **touched}).filter("__near").select(*held, *metrics), "rolled")
    rewritten = [r[0] for r in rolled.select("date").distinct().collect()]
    kept = (sources.read_table(spark, tables.performance).filter(on_days(rewritten))
            .join(rolled.select("coin_id", "event_timestamp"), ["coin_id", "event_timestamp"], "left_anti"))
    ranked = gold.market_cap_rank(rolled.unionByName(kept.select(*held, *metrics)))
    columns = [c for c in held if c != "date"]
    _replace_days(materialise(ranked.select(*columns, *metrics, "market_cap_rank", "date"), "ranked"),
                  tables.performance, sort_by=SORTED)


def follow_silver(spark: SparkSession, tables: Tables, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """Gold as a stream over silver, whose days batch runs and increments rewrite."""
    def handle(prices: DataFrame, days: list[dt.date | None]) -> None:
        with stages(spark):
            if None in days or not files.exists(spark, tables.performance) or not prices.filter("date IS NULL").isEmpty():
                write_gold(prices, tables)
            else:
                refresh_days(prices, tables, prices.filter(on_days(days)))

    return stream_changes(spark, tables.silver, checkpoint, handle, wait)


def follow_checks(spark: SparkSession, tables: Tables, checkpoint: str | None = None,
                  bounds: Mapping[str, tuple[float, float]] = PRICE_BOUNDS) -> DataFrame:
    """The check state of silver (`operators.daystate`), brought up to date.

    Days that were rewritten since the last call are read again, with the days
    that hold the rows before theirs; the state of all others stays as it is.
    `daystate.state_checks` gives the check results of the whole table from it.
    """
    def handle(prices: DataFrame, days: list[dt.date | None]) -> None:
        order = ["event_timestamp"]
        with stages(spark):
            if None in days or not prices.filter("date IS NULL").isEmpty() or not files.exists(spark, tables.state):
                made = daystate.day_state(prices, bounds)
                overwrite_table(materialise(made, "state"), tables.state, ["date"])
                return
            changed = on_days(days)
            near, _ = nearby(prices, prices.filter(changed), silver.SERIES, order, 1, 0)
            made = materialise(daystate.day_state(near, bounds, series=[*silver.SERIES, SEGMENT], within=changed), "state")
            held = {r[0] for r in made.select("date").distinct().collect()}
            gone = daystate.no_state([d for d in days if d not in held], made)
            overwrite_partitions(made.unionByName(gone), tables.state)

    stream_changes(spark, tables.silver, checkpoint or f"{tables.state}_checkpoint", handle)
    return sources.read_table(spark, tables.state)


def _replace_days(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> None:
    """Overwrite the days in `df`, in the column types that the table has."""
    stored = sources.read_table(df.sparkSession, path)
    overwrite_partitions(align_schema(df, stored, merge=True), path, sort_by=sort_by)


def _from(since: dt.date | None) -> Column:
    """Rows of `since` or later, and those without a date; all rows if it is None."""
    return F.lit(True) if since is None else (F.col("date") >= F.lit(since)) | F.col("date").isNull()


def _before(since: dt.date | None) -> Column:
    return F.lit(False) if since is None else F.col("date") < F.lit(since)


def _news(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Fresh rows that no stored row of their key equals or beats."""
    held = stored.select(*[F.col(c).alias(f"__{c}") for c in (*silver.SERIES, "event_timestamp", "ingested_at")])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*silver.SERIES, "event_timestamp")]
    beaten = F.col("ingested_at").isNull() | (F.col("__ingested_at") >= F.col("ingested_at"))
    return fresh.join(held, [*same, beaten], "left_anti")


def _touched(merged: DataFrame, news: DataFrame, rows: int) -> list[dt.date | None]:
    """Days of the news and of the next rows of their series, as far as windows reach."""
    keys = [*silver.SERIES, "event_timestamp"]
    marks = news.select(*keys, F.lit(True).alias("fresh"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
    marked = merged.select(*keys, "date").join(marks.withColumnsRenamed({c: f"__{c}" for c in keys}), same, "left") \
        .select(*keys, "date", F.coalesce("fresh", F.lit(False)).alias("fresh"))
    near = series.over_series(marked, silver.SERIES, ["event_timestamp"], rows - 1, {
        "near": lambda w: F.max("fresh").over(w.rowsBetween(-(rows - 1), 0))})
    return [r[0] for r in near.filter("near").select("date").distinct().collect()]


def _whole(spark: SparkSession, path: str, multi_line: bool | None) -> None:
    """Stop before documents are lost to a wrong layout, whatever else is fatal."""
    if lost := sources.hidden_documents(spark, path, multi_line):
        raise ValueError(f"{lost} documents in {path} stand behind others in files read as one document; "
                         "read them as JSON lines (multi_line=False)")


def _checked(results: DataFrame, name: str) -> DataFrame:
    """Check results, computed once and stored; stops the run if a fatal one failed."""
    return quality.gate(materialise(results, name))


def _check_gold(spark: SparkSession, tables: Tables, fatal: Sequence[str],
                since: dt.date | None = None) -> DataFrame:
    """Gold checks, on request only of the days and instruments with news."""
    performance = sources.read_table(spark, tables.performance)
    snapshot = sources.read_table(spark, tables.snapshot)
    if since is not None:
        performance = performance.filter(_from(since))
        snapshot = (snapshot.withColumn("date", F.to_date("event_timestamp"))
                    .filter(_from(since)).drop("date"))
    return _checked(quality.gold_checks(performance, snapshot, fatal=fatal), "gold_checks")


def run_batch(spark: SparkSession, tables: Tables, coins: Sequence[str] = INSTRUMENTS,
              as_of: dt.datetime | None = None, multi_line: bool | None = None,
              fatal: Sequence[str] = ("corrupt_json", "missing_metadata")) -> DataFrame:
    """Rebuild every table from the landed documents; returns all check results.

    Each layer is checked before the next one is built, and a failed check
    named in `fatal` stops the run there.
    """
    _whole(spark, f"{tables.bronze}/*", multi_line)
    documents = sources.read_snapshots(spark, f"{tables.bronze}/*", coins, multi_line)
    landed = _checked(quality.bronze_checks(documents, coins, fatal), "bronze_checks")

    note_all(spark, tables.silver)
    with stages(spark):
        measured = overwrite_table(build_silver(documents, coins, as_of), tables.silver, ["date"],
                                   sort_by=SORTED, measures=quality.silver_measures())
    note_all(spark, tables.silver)
    prices = sources.read_table(spark, tables.silver)
    cleaned = _checked(quality.silver_checks(prices, as_of, fatal=fatal, measured=measured), "silver_checks")

    write_gold(prices, tables)
    return quality.union(landed, cleaned, _check_gold(spark, tables, fatal))


def _rewrite_silver(rows: DataFrame, tables: Tables, days: Sequence[dt.date | None]) -> None:
    """Replace days of silver, and tell its streams."""
    note_days(rows.sparkSession, tables.silver, days)
    _replace_days(rows, tables.silver, sort_by=SORTED)
    note_days(rows.sparkSession, tables.silver, days)


def _add_dated(spark: SparkSession, tables: Tables, stored: DataFrame, news: DataFrame,
               dates: Sequence[dt.date], as_of: dt.datetime | None) -> None:
    """Add news to silver and gold where every row has a date: only days around the news are read."""
    merged = materialise(
        silver.dedup_latest(stored.filter(on_days(dates)).unionByName(news, allowMissingColumns=True),
                            order=silver.LATEST_INGESTED), "merged_prices")
    table = stored.filter(~F.col("date").isin(list(dates))).unionByName(merged, allowMissingColumns=True)
    # A flag looks back one row: it may change at the news and at their next rows.
    near = _unique_rows_near(table, news, 1, 1)
    touched = series.over_series(near, [*silver.SERIES, SEGMENT], ["event_timestamp"], 1, {
        "__near": lambda w: F.max("__new").over(w.rowsBetween(-1, 0))}, carry=["__new"])
    days = [r[0] for r in touched.filter("__near").select("date").distinct().collect()]
    # Those days are written whole, each row with the one before it at hand.
    around, _ = nearby(table, table.filter(on_days(days)), silver.SERIES, ["event_timestamp"], 1, 0)
    flagged = series.over_series(around, [*silver.SERIES, SEGMENT], ["event_timestamp"], 1, {
        "price_change_flag": lambda w: C.change_flag(F.col("price_usd"), F.lag("price_usd").over(w))}, carry=["price_usd"])
    rows = materialise(silver.stamp(flagged.filter(on_days(days)).drop(SEGMENT), as_of), "flagged")
    _rewrite_silver(rows, tables, days)
    refresh_days(sources.read_table(spark, tables.silver), tables, news)


def run_increment(spark: SparkSession, tables: Tables, landed_path: str,
                  coins: Sequence[str] = INSTRUMENTS, as_of: dt.datetime | None = None,
                  multi_line: bool | None = None,
                  fatal: Sequence[str] = ("corrupt_json", "missing_metadata")) -> DataFrame:
    """Add newly landed documents to the tables of an earlier run.

    Gives the tables `run_batch` would rebuild from all documents, but rewrites
    only days that change: those of quotes that are news, and those of the next
    rows that flags and windows look back from. Checks cover the days from the
    first changed one on; once `follow_checks` keeps a state, those of silver
    cover the whole table and read the changed days only.
    """
    _whole(spark, landed_path, multi_line)
    documents = sources.read_snapshots(spark, landed_path, coins, multi_line)
    landed = _checked(quality.bronze_checks(documents, coins, fatal), "bronze_checks")
    with stages(spark):
        stored = sources.read_table(spark, tables.silver).drop("price_change_flag", "load_timestamp")
        fresh = materialise(align_schema(silver.clean_snapshots(documents, coins), stored, merge=True), "fresh_prices")
        # A stored row of a quote's moment is on the quote's day.
        same_days = stored.filter(on_days(r[0] for r in fresh.select("date").distinct().collect()))
        news = materialise(_news(fresh, same_days), "news")
        dates = [r[0] for r in news.select("date").distinct().collect()]
        if not dates:
            return landed
        since = None if None in dates else min(dates)  # undated rows stand before all others
        if since and files.exists(spark, tables.snapshot) and stored.filter("date IS NULL").isEmpty():
            _add_dated(spark, tables, stored, news, dates, as_of)
        else:
            merged = materialise(
                silver.dedup_latest(stored.filter(_from(since)).unionByName(news, allowMissingColumns=True),
                                    order=silver.LATEST_INGESTED), "merged_prices")
            before = series.last_rows(stored.filter(_before(since)), silver.SERIES, ["event_timestamp"], 1)
            flagged = silver.add_price_change_flag(merged, prior=materialise(before, "previous_prices"))
            # The flag looks back one row, the rolling figures a few more.
            next_days, window_days = (_touched(merged, news, n) for n in (2, ROLLING_ROWS))
            _rewrite_silver(silver.stamp(flagged.filter(on_days(next_days)), as_of), tables, next_days)

            refresh_gold(sources.read_table(spark, tables.silver), tables, since, on_days(dates), on_days(window_days))
    prices = sources.read_table(spark, tables.silver)
    if files.exists(spark, tables.state):
        found = daystate.state_checks(follow_checks(spark, tables), as_of, fatal=fatal)
    else:
        found = quality.silver_checks(prices.filter(_from(since)), as_of, fatal=fatal)
    cleaned = _checked(found, "silver_checks")
    return quality.union(landed, cleaned, _check_gold(spark, tables, fatal, since))
