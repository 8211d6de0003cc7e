"""Helpers shared by the operators on texts."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

CHUNK_BYTES = 4 << 20
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_caches: dict[str, Callable[[], None]] = {}


def cached(owner: str, clear: Callable[[], None]) -> None:
    """Note how the caches of an operator's module are emptied."""
    _caches[owner] = clear


def begin(owner: str) -> None:
    """Call at a task's start: a worker that served another operator's tasks
    empties that one's caches and gives freed memory back to the system."""
    for name, clear in _caches.items():
        if name != owner:
            clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new directory below `spark.checkpoint.dir`; below the warehouse if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    """`df` written once to the shared folder and read back: later readers do not
    recompute it, and it outlives lost executors. With `clean`, the shuffle files of
    the write go at its end, not when the driver happens to collect its garbage."""
    conf, path = df.sparkSession.conf, shared_dir(df.sparkSession, name)
    before = conf.get(_CLEANUP, None)
    if clean:
        conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if clean:
            conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _reachable(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started; where
    it is installed on the executors this changes nothing."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _reachable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterable[pa.RecordBatch], column: int,
           chunk_bytes: int = CHUNK_BYTES, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a piece has about `chunk_bytes` bytes of text (one
    row at least) and at most `rows` rows, whatever the length of the texts."""
    for batch in batches:
        start = held = 0
        texts = batch.column(column)
        for i in range(batch.num_rows):
            held += len(texts[i].as_buffer() or b"") if texts[i].is_valid else 0
            if held >= chunk_bytes or i + 1 - start == rows or i + 1 == batch.num_rows:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0


def map_texts(df: DataFrame, text_col: str, results: T.StructType,
              make: Callable[[], Callable[[list[str | None]], list]],
              chunk_bytes: int = CHUNK_BYTES, more: tuple[str, ...] = (), rows: int = 1 << 20) -> DataFrame:
    """`df` with columns computed from its texts, one pass and no shuffle.

    `make()` is called once per task and returns the function from a chunk of
    texts (and lists of the columns in `more`) to the result columns. Columns
    of `df` that are named like a result are replaced.
    """
    names = {f.name.lower() for f in results}
    keep = [f for f in df.schema if f.name.lower() not in names]
    inputs = [F.col(f"`{text_col}`").cast("string").alias("__text"),
              *(F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(more))]
    types = [to_arrow_type(f.dataType) for f in results]
    n = len(inputs)

    def run(batches):
        begin(make.__module__)
        function = make()
        for batch in slices(batches, 0, chunk_bytes, rows):
            made = function(*(batch.column(i).to_pylist() for i in range(n)))
            arrays = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, t)
                      for x, t in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[n:], *arrays], names=[*(f.name for f in keep), *results.names])

    kept = [F.col(f"`{f.name}`") for f in keep]
    return df.select(*inputs, *kept).mapInArrow(run, T.StructType([*keep, *results]))
