"""The stored rows around given moments, read by the few days that hold them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = "__segment"


def _segments(days: Sequence[dt.date], marked: set[dt.date], reach: int) -> dict[dt.date, int]:
    """Days up to `reach` days of the list from a marked one; runs of them share a number."""
    near = {j for i, d in enumerate(days) if d in marked for j in range(max(0, i - reach), min(len(days), i + reach + 1))}
    made, number = {}, -1
    for j in sorted(near):
        number += j - 1 not in near
        made[days[j]] = number
    return made


def nearby(stored: DataFrame, marks: DataFrame, keys: Sequence[str], order: Sequence[str],
           preceding: int, following: int) -> tuple[DataFrame, DataFrame]:
    """(stored rows, marks), both with the segment of days that they are in.

    `stored` is partitioned by `date`. A segment is a run of stored days around
    marks that has, for each marked series, `preceding` rows before its first
    mark and `following` after its last one, or as many as there are. Only
    those days are read; the run grows while one of its series lacks rows. The
    driver holds lists of days.
    """
    marked = {r[0] for r in marks.select("date").distinct().collect()}
    days = sorted({r[0] for r in stored.select("date").distinct().collect() if r[0]} | marked)
    reach = 1
    while True:
        held = _segments(days, marked, reach)
        numbers = F.create_map(*[F.lit(x) for pair in held.items() for x in pair])
        rows = stored.filter(F.col("date").isin(list(held))).withColumn(SEGMENT, numbers[F.col("date")])
        placed = marks.withColumn(SEGMENT, numbers[F.col("date")])
        ends = {n: [d for d in held if held[d] == n] for n in set(held.values())}
        open_left = [n for n, ds in ends.items() if min(ds) > days[0]]
        open_right = [n for n, ds in ends.items() if max(ds) < days[-1]]
        if not open_left and not open_right:
            return rows, placed
        moment = F.struct(*order)
        edges = placed.groupBy(*keys, SEGMENT).agg(F.min(moment).alias("__first"), F.max(moment).alias("__last"))
        counts = (edges.join(rows.select(*keys, SEGMENT, moment.alias("__at")), [*keys, SEGMENT], "left")
                  .groupBy(*keys, SEGMENT).agg(F.count_if(F.col("__at") < F.col("__first")).alias("before"),
                                               F.count_if(F.col("__at") > F.col("__last")).alias("after")))
        lacking = ((F.col("before") < preceding) & F.col(SEGMENT).isin(open_left)) | (
            (F.col("after") < following) & F.col(SEGMENT).isin(open_right))
        if counts.filter(lacking).isEmpty():
            return rows, placed
        reach *= 4
