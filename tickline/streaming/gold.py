"""Silver ticks to the gold stream tables, one micro-batch at a time.

mode="append"   each table gets what the micro-batch alone gives: its own
                latest rows, windows and daily figures
mode="merge"    the tables stay equal to those of one batch run over all rows:
                snapshots are upserted, rolling windows continue over earlier
                micro-batches, daily figures are kept as mergeable partials

Both are safe to retry: all writes of a micro-batch are named by its id, and the
three tables become visible together, by one commit after the last write. These
ids start again under a new checkpoint, so a root takes micro-batches of one
query only; a replay fills a new root, or replaces the old one if asked to.
`fold_batches` gathers the folders of many micro-batches into one per day. In
merge mode it ranks the moments of those days once; a day is ranked on reading
again only if a later micro-batch touched it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickline.operators import gold, reports
from tickline.operators.nearby import SEGMENT, nearby
from tickline.operators.series import last_rows, over_series
from tickline.operators.silver import SERIES
from tickline.schemas import ROLLING_ROWS
from tickline.session import materialise
from tickline.sinks import commits, read_current, upsert, upsert_buckets, write_batch_idempotent
from tickline.sinks.commits import read_committed
from tickline.sinks.files import names
from tickline.sinks.versions import prune_versions, write_version

SNAPSHOT = "latest_snapshot"
PERFORMANCE = "price_performance"
DAILY = "daily_trends"
_TAIL = "_rolling_tail"
_LATE = "__is_late"
_HELD = ("coin_id", "event_timestamp", "price_usd", "market_cap", "volume_24h", "date")
_DAY, _UNDATED = "date=", "date=_"  # days sort below the folder of rows without one


def _append_all(batch: DataFrame, batch_id: int, root: str, order: Sequence[str], rows: int,
                rank_by: str, unit: str) -> dict[str, list[str]]:
    write_batch_idempotent(gold.latest_snapshot(batch, order), f"{root}/{SNAPSHOT}", batch_id)
    performance = gold.price_performance(batch, order, rows, rank_by, unit=unit)
    write_batch_idempotent(performance, f"{root}/{PERFORMANCE}", batch_id, ["date"])
    write_batch_idempotent(gold.daily_trends(batch), f"{root}/{DAILY}", batch_id, ["date"])
    return {table: [f"batch_id={batch_id}"] for table in (SNAPSHOT, PERFORMANCE, DAILY)}


def _revised(late: DataFrame, root: str, order: Sequence[str], held: Sequence[str], rows: int, unit: str) -> DataFrame:
    """Late ticks' windows, and those of the next `rows - 1` stored rows of each.

    Nothing else changes. Only days around the late ticks are read; readers take
    the newest batch's row of each key.
    """
    stored = _newest_rows(read_committed(late.sparkSession, root, PERFORMANCE), order).select(*held)
    known, fresh = nearby(stored, late, SERIES, order, rows - 1, rows - 1)
    both = known.withColumn("__late", F.lit(False)).unionByName(fresh.withColumn("__late", F.lit(True)))
    near = {"__near": lambda w: F.max("__late").over(w.rowsBetween(-(rows - 1), 0))}
    rolled = over_series(both, [*SERIES, SEGMENT], order, rows - 1, {**gold.rolling_columns(rows), **near}, unit=unit)
    return rolled.filter("__near")


def _newest_rows(stored: DataFrame, order: Sequence[str]) -> DataFrame:
    """Of rows that were written again, the newest.

    A moment lies in one day, so `date` as part of the key lets a filter on days
    reach the scan. Order columns that the store lacks tell no rows apart.
    """
    held = [c for c in order if c in stored.columns]
    return last_rows(stored, [*SERIES, "date", *held], ["batch_id"], 1)


def _marked(rows: DataFrame, root: str, batch_id: int, order: Sequence[str]) -> DataFrame:
    """`rows` and whether each is late: not newer than all that came before of its instrument."""
    earlier = read_current(rows.sparkSession, f"{root}/{_TAIL}", below=batch_id)
    if earlier is None:
        return rows.withColumn(_LATE, F.lit(False))
    newest = earlier.groupBy("coin_id").agg(F.max(F.struct(*order)).alias("__newest"))
    return rows.join(newest, "coin_id", "left").withColumn(
        _LATE, F.coalesce(F.struct(*order) <= F.col("__newest"), F.lit(False))).drop("__newest")


def _merge_all(batch: DataFrame, batch_id: int, root: str, order: Sequence[str], rows: int,
               rank_by: str, unit: str) -> dict[str, list[str]]:
    spark = batch.sparkSession
    narrow = batch.drop(_LATE)
    held = narrow.columns
    # The snapshot and the tail need the same few rows of the batch.
    recent = materialise(last_rows(narrow, SERIES, order, max(1, rows - 1)), "recent")
    upsert(gold.latest_snapshot(recent, order), f"{root}/{SNAPSHOT}", SERIES,
           ["event_timestamp"], version=batch_id)

    # Rank is left to the reader: a moment's instruments may come in several
    # micro-batches.
    metrics = [*held, "moving_avg_price", "price_volatility"]
    earlier = read_current(spark, f"{root}/{_TAIL}", below=batch_id)
    if earlier is None:
        known, rolled = recent, gold.rolling_metrics(narrow, order, rows, unit=unit).select(*metrics)
    else:
        late, prior = batch.filter(_LATE).select(*held), earlier
        some_late = not late.isEmpty()
        if some_late:
            prior = last_rows(earlier.unionByName(late), SERIES, order, rows - 1)
        rolled = gold.rolling_metrics(batch.filter(~F.col(_LATE)).select(*held), order, rows,
                                      unit=unit, prior=prior).select(*metrics)
        if some_late:
            rolled = rolled.unionByName(
                materialise(_revised(late, root, order, held, rows, unit).select(*metrics), "revised"))
        known = recent.unionByName(earlier)
    write_batch_idempotent(rolled, f"{root}/{PERFORMANCE}", batch_id, ["date"])
    write_version(last_rows(known, SERIES, order, rows - 1), f"{root}/{_TAIL}", batch_id)

    write_batch_idempotent(gold.daily_partials(batch), f"{root}/{DAILY}", batch_id, ["date"])
    # A retry of this micro-batch needs the version before it.
    for table in (SNAPSHOT, _TAIL):
        prune_versions(spark, f"{root}/{table}", keep=3)
    return {table: [f"batch_id={batch_id}"] for table in (PERFORMANCE, DAILY)}


def _mark_of(spark: SparkSession) -> str:
    """Name of the file by which the running query claims its root."""
    return f"_query_{spark.sparkContext.getLocalProperty('sql.streaming.queryId') or 'none'}"


def _claim(spark: SparkSession, root: str, replace: bool) -> None:
    """Note the query that fills `root`; another one's micro-batches do not mix with it."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = jvm_path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    mine = jvm_path(f"{root}/{_mark_of(spark)}")
    if fs.exists(mine):
        return
    others = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    if any(not n.startswith(".") for n in others):
        if not replace:
            raise ValueError(f"{root} holds another query's tables; give a replay a new root or replace=True")
        fs.delete(folder, True)
    fs.create(mine, True).close()


def process_batch(root: str, mode: str = "append", order: Sequence[str] = ("timestamp",),
                  rows: int = ROLLING_ROWS, rank_by: str = "price_usd",
                  unit: str = "hour", replace: bool = False) -> Callable[[DataFrame, int], None]:
    """The function `foreachBatch` calls. `order` must start with the event time
    or an epoch that rises with it. replace=True lets a query with a new
    checkpoint delete what another one left in `root`."""
    handlers = {"append": _append_all, "merge": _merge_all}
    if mode not in handlers:
        raise ValueError(f"mode must be one of {sorted(handlers)}, not {mode!r}")
    windows = list(dict.fromkeys(["event_timestamp", *order]))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, at = batch.sparkSession, root.rstrip("/")
        # One read serves all three tables, of the columns that they are made of. Rows are
        # marked before they are kept; a root that is not this query's yet holds nothing of it.
        batch = batch.select(*dict.fromkeys([*[c for c in _HELD if c in batch.columns], *windows]))
        if mode == "merge":
            batch = (_marked(batch, at, batch_id, windows) if _mark_of(spark) in names(spark, at)
                     else batch.withColumn(_LATE, F.lit(False)))
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                _claim(spark, at, replace)
                if not commits.is_committed(spark, at, batch_id):
                    written = handlers[mode](batch, batch_id, at, windows, rows, rank_by, unit)
                    commits.commit(spark, at, batch_id, written)
        finally:
            batch.unpersist()

    return handle


def gold_fanout(silver: DataFrame, root: str, checkpoint: str, wait: bool = True,
                **options) -> StreamingQuery:
    """Feed all available silver ticks to the three gold tables under `root`."""
    query = (silver.writeStream.foreachBatch(process_batch(root, **options))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query


def read_snapshot(spark: SparkSession, root: str, mode: str = "append") -> DataFrame:
    if mode == "merge":
        held = commits.state(spark, root)
        return read_current(spark, f"{root.rstrip('/')}/{SNAPSHOT}", below=held and held.last + 1)
    return read_committed(spark, root, SNAPSHOT).drop("batch_id")


def read_performance(spark: SparkSession, root: str, mode: str = "append",
                     rank_by: str = "price_usd", order: Sequence[str] = ("timestamp",),
                     keep_order: bool = False, first_day: dt.date | None = None) -> DataFrame:
    """`order` is the stream's own; in merge mode its columns tell rows apart and
    are part of the result with keep_order=True, as checks of the keys need them.

    With `first_day` older days (and rows without one) are left out; of a root with
    commits their folders are not even listed by the scan. Days folded with ranks by
    `rank_by` and not touched since are read as they are, without a window.
    """
    held = commits.state(spark, root)
    closed: list[str] = []
    if held is None or (mode == "append" and first_day is None):
        stored = read_committed(spark, root, PERFORMANCE)
    else:
        known = commits.folders_by_day(spark, root, held, PERFORMANCE)
        since = {day: f for day, f in known.items() if first_day is None or _DAY + str(first_day) <= day < _UNDATED}
        ranked = held.notes.get(PERFORMANCE, {})
        closed = [folder for day, (folder, later) in since.items()
                  if mode == "merge" and folder and not later and ranked.get(day) == rank_by]
        read = [f for folder, later in since.values() for f in [folder, *later] if f and f not in closed]
        stored = commits.read_folders(spark, root, PERFORMANCE, read) if read else None
        if not read and not closed:  # the columns alone
            stored = read_committed(spark, root, PERFORMANCE).filter(F.lit(False))
    if stored is not None and first_day is not None:
        stored = stored.filter(F.col("date") >= F.lit(first_day))
    if mode == "append":
        return stored.drop("batch_id")

    def shaped(df: DataFrame, rank: bool) -> DataFrame:
        df = df.withColumn("date", F.col("date").cast("date"))  # folders without any day give a string
        if not keep_order:
            df = df.drop(*[c for c in order if c != "event_timestamp"])
        columns = [c for c in df.columns if c not in ("date", "market_cap_rank")]
        return (gold.market_cap_rank(df, rank_by) if rank else df).select(*columns, "market_cap_rank", "date")

    parts = []
    if closed:
        parts.append(shaped(commits.read_folders(spark, root, PERFORMANCE, closed).drop("batch_id"), False))
    if stored is not None:
        windows = list(dict.fromkeys(["event_timestamp", *order]))
        parts.append(shaped(_newest_rows(stored, windows).drop("batch_id", "market_cap_rank"), True))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def recent_performance(spark: SparkSession, root: str, hours: int = 1, mode: str = "append",
                       names: Sequence[str] = ("rolling_avg_price", "calculated_volatility_index"),
                       **options) -> DataFrame:
    """`reports.performance_recent` over a stream's table, from its last days only.

    The newest day comes from the folders' names, the newest moment from that day,
    so what is read does not grow with the table. `options` go to `read_performance`.
    """
    held = commits.state(spark, root)
    days = commits.folders_by_day(spark, root, held, PERFORMANCE) if held else {}
    first_day = None
    for day in sorted((d for d in days if d < _UNDATED), reverse=True):
        folder, later = days[day]
        newest = F.max("event_timestamp")
        first_day = (commits.read_folders(spark, root, PERFORMANCE, [f for f in [folder, *later] if f])
                     .agg(F.to_date(newest - F.expr(f"INTERVAL {int(hours)} HOURS"))).first()[0])
        if first_day is not None:
            break
    return reports.performance_recent(read_performance(spark, root, mode, first_day=first_day, **options), hours, names)


def read_daily_trends(spark: SparkSession, root: str, mode: str = "append") -> DataFrame:
    stored = read_committed(spark, root, DAILY).drop("batch_id")
    return stored if mode == "append" else gold.merge_daily_partials(stored)


def fold_batches(spark: SparkSession, root: str, mode: str = "append",
                 order: Sequence[str] = ("timestamp",), rank_by: str = "price_usd") -> int | None:
    """Gather all committed micro-batches into one folder per day and table.

    Days that no batch since the last fold touched keep their folder. In merge
    mode only the newest row of a key and one partial a day and instrument
    stay, and rows are ranked by `rank_by` within their moment. One commit makes the fold visible; a failed one leaves the batches as
    they were. Returns the number folded up to, or None if there is nothing to
    fold. Run it between micro-batches; `commits.drop_folded` then deletes what
    it replaced.
    """
    root = root.rstrip("/")
    held = commits.state(spark, root)
    if held is None or not held.batches:
        return None
    windows = list(dict.fromkeys(["event_timestamp", *order]))
    ranked = {table: dict(days) for table, days in held.notes.items()}
    fewer = {PERFORMANCE: lambda df: gold.market_cap_rank(_newest_rows(df, windows).drop("batch_id", "market_cap_rank"), rank_by),
             DAILY: lambda df: gold.fold_daily_partials(df)} if mode == "merge" else {}
    base = {table: dict(days) for table, days in held.base.items()}
    for table in (PERFORMANCE, DAILY, *([SNAPSHOT] if mode == "append" else [])):
        by_day: dict[str, list[str]] = {}
        for batch in held.batches.values():
            for folder in batch.get(table, []):
                days = [d for d in names(spark, f"{root}/{table}/{folder}") if d.startswith("date=")]
                for day in days if table != SNAPSHOT else [""]:
                    by_day.setdefault(day, []).append(f"{folder}/{day}".rstrip("/"))
        if not by_day:
            continue
        known = base.setdefault(table, {})
        read = [f for day, folders in by_day.items() for f in ([known[day]] if day in known else []) + folders]
        rows = commits.read_folders(spark, root, table, read)
        rows = fewer[table](rows) if table in fewer else rows.drop("batch_id")
        # Below all batches, so that a later one's row of the same key is the newer one.
        number = -(held.last + 1)
        write_batch_idempotent(rows, f"{root}/{table}", number, [] if table == SNAPSHOT else ["date"])
        known |= {day: f"batch_id={number}/{day}".rstrip("/") for day in by_day}
        if mode == "merge" and table == PERFORMANCE:
            ranked.setdefault(table, {}).update({day: rank_by for day in by_day})
    commits.commit_fold(spark, root, held.last, base, ranked)
    return held.last


def daily_trends_stream(silver: DataFrame, watermark: str | None = None) -> DataFrame:
    """Daily trends as a streaming aggregate over all rows so far.

    Without a watermark for the update and complete output modes; with one, a
    day can also be appended once, when it is over.
    """
    # Days of the session's zone, as in batch: window() alone cuts days in UTC.
    if watermark is None:
        return gold.daily_trends(silver.withColumn("date", F.to_date("event_timestamp")))
    zone = silver.sparkSession.conf.get("spark.sql.session.timeZone")
    local = (silver.withColumn("__local", F.from_utc_timestamp("event_timestamp", zone))
             .withWatermark("__local", watermark))
    totals = local.groupBy(F.window("__local", "1 day").alias("__day"), "coin_id").agg(*gold.daily_columns())
    return totals.select(F.to_date(F.to_utc_timestamp("__day.start", zone)).alias("date"),
                         *[c for c in totals.columns if c != "__day"])


def daily_trends_upsert(silver: DataFrame, path: str, checkpoint: str, buckets: int = 64,
                        wait: bool = True) -> StreamingQuery:
    """Daily trends kept current in a table of buckets (`read_buckets`).

    The aggregate runs in update mode: a micro-batch hands on the days and
    instruments that it changed, and only their buckets are written.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        _claim(batch.sparkSession, path.rstrip("/"), False)
        upsert_buckets(batch, path, ["date", "coin_id"], ["record_count"], batch_id, buckets)

    query = (daily_trends_stream(silver).writeStream.outputMode("update").foreachBatch(handle)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query
