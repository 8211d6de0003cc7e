"""Tick messages to the bronze and silver stream tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickline.operators import silver
from tickline.schemas import PRICE_BOUNDS
from tickline.session import uncounted_state
from tickline.sinks import append_stream


_CHECKS = "checks"


def bronze_stream(messages: DataFrame) -> DataFrame:
    """Payloads in `value` to raw tick columns; nothing is filtered here."""
    return silver.parse_ticks(messages)


def collapse_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop repeats of a key inside each input batch of a task.

    Spark shuffles a stream by key before it drops repeats and cannot combine
    them first, so a key sent very many times would keep one task busy with
    its copies. This leaves that task one row per input batch.
    """
    keys = list(keys)

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            numbered = table.append_column("__row", pa.array(range(batch.num_rows), pa.int64()))
            first = numbered.group_by(keys).aggregate([("__row", "min")])["__row_min"]
            yield from table.take(first).combine_chunks().to_batches()

    return df.mapInArrow(first_of_each, df.schema)


def dedup(df: DataFrame, keys: Sequence[str] = ("coin_id", "timestamp"),
          watermark: str | None = None, event_time: str = "event_timestamp") -> DataFrame:
    """Keep the first arrival of each key, across runs of one checkpoint.

    watermark   bounds the state, at a price: Spark drops EVERY row that is
                older than the newest event time of earlier micro-batches less
                the watermark, repeated or not. `late_rows` tells how many a
                query dropped. Without a watermark nothing is dropped and the
                state keeps every key for good
    """
    keys = list(keys)
    if watermark is None:
        return df.dropDuplicates(keys)
    return df.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys)


def silver_stream(bronze: DataFrame,
                  bounds: Mapping[str, tuple[float, float]] | DataFrame = PRICE_BOUNDS,
                  precision: str = "second", fractional_delay: bool = False,
                  watermark: str | None = None, collapse: bool = False,
                  as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Valid, typed, de-duplicated ticks with their delay and load time.

    Bad ticks and copies go while the rows are still narrow, before the
    shuffle and the state. collapse=True adds a Python step that drops copies
    within each task, for sources that send one tick very many times.
    """
    valid = silver.valid_ticks(bronze, bounds)
    if collapse:
        valid = collapse_copies(valid, ["symbol", "timestamp"])
    ticks = silver.clean_ticks(valid, precision, fractional_delay, as_of)
    unique = dedup(ticks, watermark=watermark)
    return silver.stamp(silver.drop_negative_delay(unique), as_of)


def run_bronze(messages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return append_stream(bronze_stream(messages), path, checkpoint)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query dropped for being behind its watermark, so far as its
    progress reports reach back (`spark.sql.streaming.numRecentProgressUpdates`)."""
    return sum(state["numRowsDroppedByWatermark"]
               for progress in query.recentProgress for state in progress["stateOperators"])


def run_silver(bronze: DataFrame, path: str, checkpoint: str,
               rules: Mapping[str, Column] | None = None, **options) -> StreamingQuery:
    """`rules` {check: predicate} are counted while the rows are written (`check_rows`).

    The state's own rows are not counted (`uncounted_state`).
    """
    ticks = silver_stream(bronze, **options)
    if rules:
        ticks = ticks.observe(_CHECKS, F.count(F.lit(1)).alias("rows"),
                              *[F.count_if(broken).alias(name) for name, broken in rules.items()])
    with uncounted_state(ticks.sparkSession):  # a stream keeps the settings that it is started with
        query = append_stream(ticks, path, checkpoint, wait=False)
    query.awaitTermination()
    return query


def check_rows(query: StreamingQuery) -> DataFrame:
    """(batch_id, check, metric) of what `run_silver` observed, as far as the query's
    progress reports reach back; `rows` counts the rows written."""
    found = [(progress["batchId"], check, count) for progress in query.recentProgress
             for check, count in _observed(progress).items()]
    return SparkSession.active().createDataFrame(found, "batch_id bigint, check string, metric bigint")


def _observed(progress) -> dict[str, int]:
    metrics = progress["observedMetrics"].get(_CHECKS)
    return metrics.asDict() if hasattr(metrics, "asDict") else dict(metrics or {})


def replay_checkpoint(base: str) -> str:
    """A new checkpoint directory beside the old ones: a stream started on it
    reads its source from the beginning. Checkpoints are never wiped, as a
    wiped one makes the next run append everything again."""
    return f"{base.rstrip('/')}/replay-{uuid.uuid4().hex}"
