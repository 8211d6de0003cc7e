"""Check state per day and instrument, which merges instead of being counted again.

`day_state` gives one row per day and instrument: counts of what the silver
checks look for, delays, and two sketches, of the distinct moments (HyperLogLog)
and of the delays (KLL). States of disjoint sets of days are put side by side in
one table; `merge_state` adds them up to any coarser grouping. What is counted
is exact; a key's repeats fall into one day, so their counts add up too. Of the
sketches, distinct moments have a relative standard error of 1.04 / sqrt(2^bits)
(0.8 % with 14 bits), and a delay quantile a rank error of about 1.3 % at k = 200.

An empty table has no state; checks of none report no data as `silver_checks` does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline import functions as C
from tickline.operators import quality
from tickline.operators.series import over_series
from tickline.operators.silver import SERIES
from tickline.schemas import FRESHNESS_MINUTES, JUMP_RATIO, PRICE_BOUNDS, PRICE_FLAGS

GRAIN = ("date", "coin_id")
BITS = 14
KLL_SIZE = 200
COUNTS = ("rows", "null_prices", "unknown_flags", "price_outliers", "negative_delay", "duplicate_keys",
          "price_jumps", "delays", "delay_sum")
DELAY = "ingestion_delay_seconds"


def day_state(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = PRICE_BOUNDS,
              ratio: float = JUMP_RATIO, order: Sequence[str] = ("event_timestamp",),
              series: Sequence[str] = SERIES, layout: str = "time",
              within: Column | None = None) -> DataFrame:
    """One row per day and instrument of a silver table.

    within   of which rows the state is made; others only stand before them, as
             a jump is measured from the row before
    """
    held = dict.fromkeys([*series, *GRAIN, "event_timestamp", *order, "price_usd", "price_change_flag", DELAY])
    moment = F.struct("event_timestamp")
    moved = over_series(
        df.select(*held), series, order, 2,
        {"__moved": lambda w: C.change_ratio(F.col("price_usd"), F.lag("price_usd").over(w)),
         # Rows of a key stand side by side: its second row tells that it is repeated.
         "__second": lambda w: (F.lag(moment).over(w).eqNullSafe(moment)
                                & ~F.lag(moment, 2).over(w).eqNullSafe(moment))}, layout=layout)
    if within is not None:
        moved = moved.filter(within)
    flag, delay = F.col("price_change_flag"), F.col(DELAY).cast("long")
    return moved.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("price_usd").isNull()).alias("null_prices"),
        F.count_if(flag.isNull() | ~flag.isin(*PRICE_FLAGS)).alias("unknown_flags"),
        F.count_if(C.outside_bounds(F.col("coin_id"), F.col("price_usd"), bounds)).alias("price_outliers"),
        F.count_if(F.col(DELAY) < 0).alias("negative_delay"),
        F.count_if("__second").alias("duplicate_keys"),
        F.count_if(F.col("__moved") > ratio).alias("price_jumps"),
        F.count(delay).alias("delays"), F.coalesce(F.sum(delay), F.lit(0)).alias("delay_sum"),
        F.max(delay).alias("max_delay"), F.max(F.unix_timestamp("event_timestamp")).alias("latest_second"),
        F.hll_sketch_agg(F.unix_micros(F.col("event_timestamp").cast("timestamp")), F.lit(BITS)).alias("moment_sketch"),
        F.kll_sketch_agg_bigint(delay, F.lit(KLL_SIZE)).alias("delay_sketch"))


def no_state(days: Collection[dt.date | None], like: DataFrame) -> DataFrame:
    """Rows that stand for days without any row, in the columns of a state."""
    made = like.sparkSession.createDataFrame([(d,) for d in days], "date date")
    return made.select(*[F.col("date") if f.name == "date" else
                         F.lit(0 if f.name in COUNTS else None).cast(f.dataType).alias(f.name) for f in like.schema])


def merge_state(state: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Days' states added up by instrument, by day, or (`by` empty) over all of them."""
    return state.filter("rows > 0").groupBy(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
        F.max("max_delay").alias("max_delay"), F.max("latest_second").alias("latest_second"),
        F.count_distinct("date").alias("date_partitions"), F.count_distinct("coin_id").alias("instruments"),
        F.hll_union_agg("moment_sketch").alias("moment_sketch"),
        F.kll_merge_agg_bigint("delay_sketch").alias("delay_sketch"))


def delay_figures(state: DataFrame, by: Sequence[str] = ("coin_id",),
                  quantiles: Sequence[float] = (0.5, 0.99)) -> DataFrame:
    """Delays by instrument: exact mean and maximum, estimated quantiles, and about how many moments."""
    merged = merge_state(state, by)
    known = F.col("delays") > 0  # an empty sketch has no quantiles
    return merged.select(
        *by, "rows", F.col("max_delay").alias("max_delay_secs"),
        F.try_divide(F.col("delay_sum"), F.col("delays")).alias("avg_delay_secs"),
        *[F.when(known, F.kll_sketch_get_quantile_bigint("delay_sketch", F.lit(float(q)))).alias(f"delay_p{round(q * 100)}")
          for q in quantiles],
        F.hll_sketch_estimate("moment_sketch").alias("distinct_moments"))


def state_checks(state: DataFrame, as_of: dt.datetime | Column | None = None,
                 sla_minutes: float = FRESHNESS_MINUTES, fatal: Collection[str] = ()) -> DataFrame:
    """The rows of `quality.silver_checks`, from the state alone."""
    row = merge_state(state).withColumn(
        "freshness_minutes", (F.unix_timestamp(C.load_time(as_of)) - F.col("latest_second")) / 60)
    return quality.silver_results(row, sla_minutes, fatal)
