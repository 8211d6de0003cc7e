"""A stream over a table whose days are rewritten in place.

A file stream would repeat rows of a rewritten day, or miss that old ones are
gone. Writers of such a table note the days that they rewrite, in small files
beside it, in `<table>_changes`. The stream reads the notes, and hands on each
changed day with all the rows that it now has, so that the consumer replaces the
day.

A writer notes the days before it writes and again after, so no change is lost
with a writer that dies in between; a day that is handed on twice does no harm.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickline.sinks.files import names, write_text

_SCHEMA = "date date, undated boolean"


def _notes(path: str) -> str:
    return f"{path.rstrip('/')}_changes"


def on_days(days: Iterable[dt.date | None], column: str = "date") -> Column:
    """Rows of some days; None stands for rows without a date."""
    days, day = list(days), F.col(column)
    return day.isin([d for d in days if d]) | (day.isNull() if None in days else F.lit(False))


def note_days(spark: SparkSession, path: str, days: Iterable[dt.date | None]) -> None:
    """Tell the table's streams that these days are rewritten."""
    lines = [json.dumps({"date": d and d.isoformat(), "undated": d is None}) for d in days]
    if lines:
        write_text(spark, f"{_notes(path)}/{uuid.uuid4().hex}.json", "\n".join(lines))


def note_all(spark: SparkSession, path: str) -> None:
    """Note every day that the table has, if there is one."""
    if not names(spark, path):
        return
    days = [r[0] for r in spark.read.parquet(path).select("date").distinct().collect()]
    note_days(spark, path, days)


def stream_changes(spark: SparkSession, path: str, checkpoint: str,
                   handle: Callable[[DataFrame, list[dt.date | None]], None], wait: bool = True) -> StreamingQuery:
    """Call `handle(table, days)` for what changed since the checkpoint, then stop.

    `table` is the table as it is now; `days` are those to be replaced, so
    `table.filter(on_days(days))` reads nothing else. The driver holds the days.
    """
    path = path.rstrip("/")

    def each(batch: DataFrame, _: int) -> None:
        days = [r["date"] for r in batch.select("date").distinct().collect()]
        if days:
            handle(batch.sparkSession.read.parquet(path), sorted(days, key=lambda d: (d is not None, d)))

    query = (spark.readStream.schema(_SCHEMA).json(_notes(path)).writeStream.foreachBatch(each)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query
