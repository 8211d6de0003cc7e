"""De-duplication with bounded state that loses no late tick.

A watermark on event time bounds the state but drops whatever is behind it. Here
the watermark runs on the arrival of ticks instead, so no tick is behind it, and
the state holds the keys of the last `window` of arrivals. A copy that arrives
later than that after the first one passes the state. As a tick arrives after its
event, that can only be one whose event is older than `window` at its arrival:
those few ticks, and no others, go to an anti join against the silver days that
they fall in.

Silver is stored as batch_id=<n>/date=<d>. A batch that was written is not
written again on a retry, and it looks for copies in earlier batches only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickline.operators import silver
from tickline.schemas import PRICE_BOUNDS
from tickline.session import materialise, stages
from tickline.sinks import files, write_batch_idempotent
from tickline.sources.changes import on_days

KEYS = ("coin_id", "timestamp")
_LATE = "__late"


def new_ticks(batch: DataFrame, stored: DataFrame | None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows of a batch that no stored row equals on `keys`; only late ones are looked up.

    The driver holds the days of late ticks, and reads no other day.
    """
    late = batch.filter(_LATE)
    if stored is None or late.isEmpty():
        return batch.drop(_LATE)
    days = on_days(r[0] for r in late.select("date").distinct().collect())
    held = stored.filter(days).select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    unseen = late.join(held, same, "left_anti")
    return batch.filter(~F.col(_LATE)).unionByName(unseen).drop(_LATE)


def dedup_tiers(ticks: DataFrame, path: str, checkpoint: str, window: str = "1 day",
                keys: Sequence[str] = KEYS, arrival: str = "ingested_at",
                event_time: str = "event_timestamp", wait: bool = True) -> StreamingQuery:
    """Append ticks whose key is new to the silver table at `path`.

    `arrival` may not fall back by more than `window`, which a stamp at loading
    never does; ticks stamped before their own event must be gone already
    (`silver.drop_negative_delay`).
    """
    # Event times are cut to seconds, so a tick on the edge counts as late.
    edge = F.col(arrival) - F.expr(f"INTERVAL {window}") + F.expr("INTERVAL 1 SECOND")
    unique = (ticks.withWatermark(arrival, window).dropDuplicatesWithinWatermark(list(keys))
              .withColumn(_LATE, (F.col(event_time) <= edge) | F.col(event_time).isNull()))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if files.exists(spark, f"{path}/batch_id={batch_id}/_SUCCESS"):
            batch.write.format("noop").mode("overwrite").save()  # the state still takes the batch in
            return
        with stages(spark):
            # Written first: the join and its list of days read the batch more than once.
            rows = materialise(batch, "tier")
            stored = None
            if any(n.startswith("batch_id=") for n in files.names(spark, path)):
                stored = spark.read.schema(f"{_ddl(rows)}, batch_id bigint").parquet(path).filter(F.col("batch_id") < batch_id)
            write_batch_idempotent(new_ticks(rows, stored, keys), path, batch_id, ["date"])

    query = (unique.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != _LATE)


def run_silver_tiers(bronze: DataFrame, path: str, checkpoint: str, window: str = "1 day",
                     bounds: Mapping[str, tuple[float, float]] | DataFrame = PRICE_BOUNDS,
                     precision: str = "second", fractional_delay: bool = False,
                     as_of: dt.datetime | Column | None = None, wait: bool = True) -> StreamingQuery:
    """Valid, typed ticks, each once, with their delay and load time (as `run_silver`
    without a watermark, but with bounded state)."""
    ticks = silver.clean_ticks(silver.valid_ticks(bronze, bounds), precision, fractional_delay, as_of)
    stamped = silver.stamp(silver.drop_negative_delay(ticks), as_of)
    return dedup_tiers(stamped, path, checkpoint, window, wait=wait)
