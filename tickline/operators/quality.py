"""Data-quality checks for every layer.

A check gives rows of `schemas.CHECK_RESULT`, so results can be stored, joined
or passed to `gate`. All counts over one table are folded into one aggregate.
Statuses: pass, fail, skip (nothing to compare), error (no data), info.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline import functions as C
from tickline.operators.gold import latest_snapshot
from tickline.operators.series import over_series
from tickline.operators.silver import SERIES
from tickline.schemas import (
    CHECK_RESULT,
    CORRUPT,
    FRESHNESS_MINUTES,
    INSTRUMENTS,
    JUMP_RATIO,
    PRICE_BOUNDS,
    PRICE_FLAGS,
    SYNC_TOLERANCE,
)


class QualityError(RuntimeError):
    """A fatal check failed."""


def _result(check: str, severity: str, metric: Column, threshold: float | None = 0.0,
            status: Column | None = None) -> Column:
    """One result row as a struct; by default the metric may not pass the threshold."""
    if status is None:
        status = F.lit("info") if threshold is None else (
            F.when(metric <= threshold, "pass").otherwise("fail"))
    fields = {"check": F.lit(check), "severity": F.lit(severity), "status": status,
              "metric": metric, "threshold": F.lit(threshold)}
    return F.struct(*[fields[f.name].cast(f.dataType).alias(f.name) for f in CHECK_RESULT])


def _rows(one_row: DataFrame, *results: Column) -> DataFrame:
    return one_row.select(F.inline(F.array(*results)))


def _severity(check: str, default: str, fatal: Collection[str]) -> str:
    return "fatal" if check in fatal else default


def union(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def run_checks(df: DataFrame, rules: Mapping[str, Column],
               fatal: Collection[str] = ()) -> DataFrame:
    """Count the rows that break each rule {check: predicate}, in one pass."""
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return _rows(counts, *[_result(name, _severity(name, "error", fatal), F.col(name))
                           for name in rules])


def gate(results: DataFrame) -> DataFrame:
    """Stop the run if a fatal check failed; else return the results.

    Brings only failed fatal checks to the driver, at most one row per check.
    """
    failed = results.filter("severity = 'fatal' AND status IN ('fail', 'error')").collect()
    if failed:
        raise QualityError("; ".join(f"{r['check']}: {r['metric']}" for r in failed))
    return results


# -- building blocks --------------------------------------------------------

def duplicate_keys(df: DataFrame,
                   keys: Sequence[str] = ("coin_id", "event_timestamp")) -> DataFrame:
    """The keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def volume_per_key(df: DataFrame, key: str = "coin_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def distinct_values(df: DataFrame, column: str = "price_change_flag") -> DataFrame:
    return df.select(column).distinct()


def partition_count(df: DataFrame, column: str = "date", approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(F.col(column)).alias("partition_count"))


def missing_keys(df: DataFrame, expected: Sequence[str] = INSTRUMENTS,
                 key: str = "coin_id") -> DataFrame:
    """The expected keys that never occur in `df`.

    Both sides of the last join hold at most `expected`.
    """
    wanted = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(k) for k in expected])).alias(key))
    present = df.select(key).join(F.broadcast(wanted), key, "left_semi").distinct()
    return wanted.join(present, key, "left_anti")


def freshness(df: DataFrame, sla_minutes: float = FRESHNESS_MINUTES,
              as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Latest event, its age in minutes and whether that meets the SLA."""
    age = (F.unix_timestamp(C.load_time(as_of)) - F.unix_timestamp("latest_ts")) / 60
    return (df.agg(F.max("event_timestamp").alias("latest_ts"))
              .withColumn("delay_mins", age)
              .withColumn("status", F.when(F.col("delay_mins").isNull(), "error")
                                     .when(F.col("delay_mins") > sla_minutes, "fail")
                                     .otherwise("pass")))


def price_jumps(df: DataFrame, ratio: float = JUMP_RATIO,
                order: Sequence[str] = ("event_timestamp",),
                layout: str = "time", unit: str = "day") -> DataFrame:
    """Rows whose price moved by more than `ratio` from the previous one."""
    narrow = df.select(*dict.fromkeys([*SERIES, *order, "price_usd"]))
    moved = over_series(
        narrow, SERIES, order, 1,
        {"prev_price": lambda w: F.lag("price_usd").over(w),
         "pct_change": lambda w: C.change_ratio(F.col("price_usd"), F.lag("price_usd").over(w))},
        layout=layout, unit=unit)
    return moved.filter(F.col("pct_change") > ratio)


def price_outliers(df: DataFrame,
                   bounds: Mapping[str, tuple[float, float]] = PRICE_BOUNDS) -> DataFrame:
    return df.filter(C.outside_bounds(F.col("coin_id"), F.col("price_usd"), bounds))


def corrupt_counts(df: DataFrame) -> DataFrame:
    """Ticks by fault. A zero price counts as corrupt, as in the silver filter."""
    bad_price = F.col("price").isNull() | (F.col("price") <= 0)
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(bad_price).alias("corrupt_price_count"),
                  F.count_if(F.col("price").isNull() | (F.col("price") < 0))
                  .alias("null_or_negative_price_count"),
                  F.count_if(F.col("symbol").isNull()).alias("corrupt_symbol_count"))


def delay_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(
        F.max("ingestion_delay_seconds").alias("max_delay_secs"),
        F.avg("ingestion_delay_seconds").alias("avg_delay_secs"))


def rank_duplicates(df: DataFrame) -> DataFrame:
    """Moments at which one rank is held more than once."""
    return duplicate_keys(df, ("event_timestamp", "market_cap_rank"))


def cross_table_sync(snapshot: DataFrame, performance: DataFrame,
                     tolerance: float = SYNC_TOLERANCE,
                     order: Sequence[str] = ("event_timestamp",),
                     coins: Sequence[str] | None = None) -> DataFrame:
    """Compare each instrument's latest price in both tables.

    One row per instrument of either table, with a status of in_sync,
    out_of_sync, missing_in_snapshot or missing_in_performance.
    """
    if coins is not None:
        snapshot = snapshot.filter(F.col("coin_id").isin(*coins))
        performance = performance.filter(F.col("coin_id").isin(*coins))
    snap = latest_snapshot(snapshot, [c for c in order if c in snapshot.columns]).select(
        "coin_id", F.col("price_usd").alias("snapshot_price"), F.lit(True).alias("__s"))
    perf = latest_snapshot(performance, order).select(
        "coin_id", F.col("price_usd").alias("performance_price"), F.lit(True).alias("__p"))
    gap = F.abs(F.col("snapshot_price") - F.col("performance_price"))
    both_null = F.col("snapshot_price").isNull() & F.col("performance_price").isNull()
    status = (F.when(F.col("__s").isNull(), "missing_in_snapshot")
               .when(F.col("__p").isNull(), "missing_in_performance")
               .when(both_null | (gap <= tolerance), "in_sync")
               .otherwise("out_of_sync"))
    return (snap.join(perf, "coin_id", "full")
                .select("coin_id", "snapshot_price", "performance_price", status.alias("status")))


# -- one result set per layer -----------------------------------------------

def bronze_checks(df: DataFrame, coins: Sequence[str] = INSTRUMENTS,
                  fatal: Collection[str] = ("corrupt_json", "missing_metadata")) -> DataFrame:
    """Raw documents read by `sources.read_snapshots`: one pass for all checks.

    Where no document has metadata at all, that check is skipped.
    """
    stamp = C.nested("ingestion_metadata", "ingested_at")
    counted = {
        "corrupt_json": F.count_if(C.nested(CORRUPT).isNotNull()),
        "missing_metadata": F.count_if(stamp.isNull() | (stamp == "")),
        "seen metadata": F.count("ingestion_metadata"),
        **{f"seen {coin}": F.count(C.nested(coin)) for coin in coins},
        **{f"null {coin}": F.count_if(C.nested(coin, "usd").isNull()) for coin in coins},
    }
    row = df.agg(*[value.alias(name) for name, value in counted.items()])
    absent = reduce(lambda a, b: a + b,
                    [F.when(C.nested(f"seen {coin}") == 0, 1).otherwise(0) for coin in coins])
    return _rows(
        row,
        _result("corrupt_json", _severity("corrupt_json", "error", fatal), F.col("corrupt_json")),
        _result("missing_coins", _severity("missing_coins", "warn", fatal), absent),
        _result("missing_metadata", _severity("missing_metadata", "error", fatal),
                F.col("missing_metadata"),
                status=F.when(C.nested("seen metadata") == 0, "skip")
                        .when(F.col("missing_metadata") == 0, "pass").otherwise("fail")),
        *[_result(f"null_price {coin}", _severity("null_price", "warn", fatal),
                  C.nested(f"null {coin}"),
                  status=F.when(C.nested(f"seen {coin}") == 0, "skip")
                          .when(C.nested(f"null {coin}") == 0, "pass").otherwise("fail"))
          for coin in coins])


_MEASURED = T.StructType([T.StructField(c, T.LongType()) for c in (
    "null_prices", "unknown_flags", "price_outliers", "negative_delay", "date_partitions", "latest_second")])


def silver_measures(bounds: Mapping[str, tuple[float, float]] = PRICE_BOUNDS, distinct: Column | None = None) -> list[Column]:
    """Aggregates of the checks that need one look at each row.

    Without distinct aggregates, so that a write can observe them; the days of
    a table are few enough to be gathered.
    """
    flag = F.col("price_change_flag")
    days = F.size(F.collect_set("date")) if distinct is None else distinct
    made = [F.count_if(F.col("price_usd").isNull()),
            F.count_if(flag.isNull() | ~flag.isin(*PRICE_FLAGS)),
            F.count_if(C.outside_bounds(F.col("coin_id"), F.col("price_usd"), bounds)),
            F.count_if(F.col("ingestion_delay_seconds") < 0),
            days.cast("long"), F.max(F.unix_timestamp("event_timestamp"))]
    return [column.alias(name) for column, name in zip(made, _MEASURED.names, strict=True)]


def silver_checks(df: DataFrame, as_of: dt.datetime | Column | None = None,
                  sla_minutes: float = FRESHNESS_MINUTES, ratio: float = JUMP_RATIO,
                  bounds: Mapping[str, tuple[float, float]] = PRICE_BOUNDS,
                  fatal: Collection[str] = (), order: Sequence[str] = ("event_timestamp",),
                  layout: str = "time", measured: Mapping[str, int | None] | None = None) -> DataFrame:
    """Batch silver: keys, nulls, flags, partitions, freshness, volume, limits,
    jumps and clock sync.

    measured    what `silver_measures` gave when the table was written; the table
                is then read for keys and jumps alone
    """
    if measured is None:
        row = df.agg(*silver_measures(bounds, F.count_distinct("date")))
    else:
        row = df.sparkSession.createDataFrame([tuple(measured[c] for c in _MEASURED.names)], _MEASURED)
    row = row.withColumn("freshness_minutes",
                         (F.unix_timestamp(C.load_time(as_of)) - F.col("latest_second")) / 60)
    folded = _rows(row, *_row_results(sla_minutes, fatal))

    # One pass over the keys gives the repeats and the instruments.
    keys = (df.groupBy("coin_id", "event_timestamp").agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                 F.count_distinct("coin_id").alias("instruments")))
    jumps = price_jumps(df, ratio, order, layout).agg(F.count(F.lit(1)).alias("price_jumps"))
    return union(folded, _rows(keys, *_key_results(fatal)), _rows(jumps, _jump_result(fatal)))


def _row_results(sla_minutes: float, fatal: Collection[str]) -> list[Column]:
    age = F.col("freshness_minutes")
    return [
        *[_result(name, _severity(name, "error", fatal), F.col(name))
          for name in ("null_prices", "unknown_flags", "price_outliers", "negative_delay")],
        _result("date_partitions", "info", F.col("date_partitions"), None),
        _result("freshness_minutes", _severity("freshness_minutes", "warn", fatal), age,
                float(sla_minutes),
                F.when(age.isNull(), "error").when(age > sla_minutes, "fail").otherwise("pass"))]


def _key_results(fatal: Collection[str]) -> list[Column]:
    return [_result("duplicate_keys", _severity("duplicate_keys", "error", fatal), F.col("duplicate_keys")),
            _result("instruments", "info", F.col("instruments"), None)]


def _jump_result(fatal: Collection[str]) -> Column:
    return _result("price_jumps", _severity("price_jumps", "warn", fatal), F.col("price_jumps"))


def silver_results(row: DataFrame, sla_minutes: float = FRESHNESS_MINUTES,
                   fatal: Collection[str] = ()) -> DataFrame:
    """The rows of `silver_checks` from one row that holds all its figures."""
    return _rows(row, *_row_results(sla_minutes, fatal), *_key_results(fatal), _jump_result(fatal))


def stream_silver_checks(df: DataFrame, fatal: Collection[str] = ()) -> DataFrame:
    """Stream silver: prices and symbols that should not have got through."""
    return run_checks(df, {
        "corrupt_price": F.col("price").isNull() | (F.col("price") <= 0),
        "corrupt_symbol": F.col("symbol").isNull(),
        "negative_delay": F.col("ingestion_delay_seconds") < 0,
    }, fatal)


def gold_checks(performance: DataFrame, snapshot: DataFrame,
                tolerance: float = SYNC_TOLERANCE, coins: Sequence[str] | None = None,
                fatal: Collection[str] = (),
                order: Sequence[str] = ("event_timestamp",),
                keys: Sequence[str] = ("coin_id", "event_timestamp")) -> DataFrame:
    """Gold: ranks, moving averages and agreement of the two tables.

    Tied ranks are legitimate and only warn; a repeated key is an error. Rows
    of a stream table are unique by millisecond, so their `keys` and `order`
    have a column that tells the ticks of one second apart.
    """
    # One exchange by moment serves ranks and keys; null averages are counted on the way.
    held = dict.fromkeys(["event_timestamp", "market_cap_rank", "moving_avg_price", *keys])
    moments = performance.select(*held).repartition("event_timestamp")
    ranks = (moments.groupBy("event_timestamp", "market_cap_rank")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(F.col("moving_avg_price").isNull()).alias("nulls"))
             .agg(F.count_if(F.col("n") > 1).alias("tied_ranks"),
                  F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_moving_average")))
    repeats = duplicate_keys(moments, keys).agg(F.count(F.lit(1)).alias("duplicate_keys"))
    sync = cross_table_sync(snapshot, performance, tolerance, order, coins).agg(
        F.count(F.lit(1)).alias("compared"),
        F.count_if(F.col("status") == "out_of_sync").alias("off"),
        F.count_if(F.col("status").startswith("missing")).alias("missing"))
    nothing = F.when(F.col("compared") == F.col("missing"), "skip")
    return union(
        _rows(ranks,
              _result("tied_ranks", _severity("tied_ranks", "warn", fatal), F.col("tied_ranks")),
              _result("null_moving_average", _severity("null_moving_average", "error", fatal),
                      F.col("null_moving_average"))),
        _rows(repeats, _result("duplicate_keys", _severity("duplicate_keys", "error", fatal),
                               F.col("duplicate_keys"))),
        _rows(sync,
              _result("out_of_sync", _severity("out_of_sync", "error", fatal), F.col("off"),
                      status=nothing.when(F.col("off") == 0, "pass").otherwise("fail")),
              _result("missing_in_one_table", _severity("missing_in_one_table", "warn", fatal),
                      F.col("missing"))))
