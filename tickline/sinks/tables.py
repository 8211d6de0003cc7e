"""Parquet table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def ensure_schema(spark: SparkSession, name: str) -> None:
    """Create the namespace if it is missing."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def align_schema(df: DataFrame, target: T.StructType | DataFrame, merge: bool = False) -> DataFrame:
    """`df` with the target table's column types and order.

    Columns the target has and `df` lacks become nulls. merge=True keeps the
    columns only `df` has, at the end; otherwise they are dropped.
    """
    schema = target.schema if isinstance(target, DataFrame) else target
    known = [(F.col(f.name) if f.name in df.columns else F.lit(None))
             .cast(f.dataType).alias(f.name) for f in schema]
    new = [F.col(c) for c in df.columns if c not in schema.names] if merge else []
    return df.select(*known, *new)


def _spread(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Gather each table partition into few files, and split large ones."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df


def overwrite_table(df: DataFrame, path: str | None = None, partition_by: Sequence[str] = (),
                    table: str | None = None, sort_by: Sequence[str] = (),
                    measures: Sequence[Column] = ()) -> dict:
    """Replace a whole table: at a path, in the catalog, or both (external).

    Rows sorted by what readers filter on let them skip parts of the files.
    Returns `measures`, aggregates of the rows written, by name. They are taken
    behind the last shuffle, where Spark counts a repeated task once.
    """
    rows, seen = _spread(df, partition_by, sort_by), Observation()
    if measures:
        rows = rows.observe(seen, *measures)
    writer = rows.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is None:
        writer.save(path)
    else:
        (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return seen.get if measures else {}


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str] = ("date",),
                         sort_by: Sequence[str] = ()) -> None:
    """Replace only the table partitions that occur in `df`."""
    (_spread(df, partition_by, sort_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_batch_idempotent(df: DataFrame, path: str, batch_id: int,
                           partition_by: Sequence[str] = ()) -> None:
    """Add a micro-batch to a table under its own `batch_id=<n>` partition.

    A repeated batch replaces its own rows, so a retry adds nothing twice.
    """
    writer = _spread(df, partition_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def append_stream(df: DataFrame, path: str | None, checkpoint: str,
                  partition_by: Sequence[str] = (), wait: bool = True,
                  table: str | None = None) -> StreamingQuery:
    """Append all that is available to a Parquet table, then stop.

    The table is at a path, in the catalog, or both (external).
    """
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if table is None:
        query = writer.start(path)
    else:
        query = (writer if path is None else writer.option("path", path)).toTable(table)
    if wait:
        query.awaitTermination()
    return query
