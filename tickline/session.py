"""Session helpers: shared scratch space and state-store choice."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_made: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unused directory in the folder all executors share.

    The folder is the session's `spark.checkpoint.dir`, a checkpoint directory
    set on the context, or else the warehouse, which executors share as well.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch")
    root = f"{base.rstrip('/')}/tickline-{uuid.uuid4().hex}"
    _made.append(root)
    return f"{root}/{name}"


def _delete(spark: SparkSession, root: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_shared(spark: SparkSession) -> int:
    """Delete the shared directories this process made; returns how many.

    For the end of a job: DataFrames that still read them stop working.
    """
    count = len(_made)
    while _made:
        _delete(spark, _made.pop())
    return count


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Delete the stages made inside once the block is left: their consumers
    have committed by then. Other directories of the process stay."""
    before = len(_made)
    try:
        yield
    finally:
        for root in _made[before:]:
            _delete(spark, root)
        del _made[before:]


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and later branches
    read only the columns they use.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state off the JVM heap: de-duplication state grows with
    the number of distinct keys."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


@contextmanager
def uncounted_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside do not count the rows of their RocksDB state, which spares
    a lookup for every row that is stored; their progress reports give no total."""
    name = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
