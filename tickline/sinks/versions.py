"""Keyed upsert into plain Parquet by writing a new version each time.

A table is a directory of numbered versions. A version counts once it holds
the mark that is written after its job (Spark's own `_SUCCESS` file can be
switched off), so readers never see a half-written one, and a failed run leaves
the current version as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.operators.series import last_rows
from tickline.sinks.tables import align_schema


def _files(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    root = jvm_path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root, jvm_path


MARK = "_COMMITTED"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The version directories, complete or not, from the newest down."""
    fs, root, _ = _files(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted((int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit()), reverse=True)


def _complete(spark: SparkSession, path: str, version: int) -> bool:
    fs, _, jvm_path = _files(spark, path)
    return fs.exists(jvm_path(f"{_at(path, version)}/{MARK}"))


def _at(path: str, version: int) -> str:
    return f"{path}/v{version:012d}"


def current_version(spark: SparkSession, path: str, below: int | None = None) -> int | None:
    """The newest complete version (older than `below`), or None if there is no
    version at all. Versions of which none is complete are an error: a writer
    would otherwise begin again over them."""
    path = path.rstrip("/")
    numbers = [v for v in _numbers(spark, path) if below is None or v < below]
    found = next((v for v in numbers if _complete(spark, path, v)), None)
    if found is None and numbers:
        raise ValueError(f"no complete version among {numbers} in {path}; remove them to begin anew")
    return found


def read_current(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The table as of its newest version, or None before the first one."""
    path = path.rstrip("/")
    version = current_version(spark, path, below)
    return None if version is None else spark.read.parquet(_at(path, version))


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write one version, then its mark; an earlier attempt's files and mark go first."""
    spark, at = df.sparkSession, _at(path.rstrip("/"), version)
    df.write.mode("overwrite").parquet(at)
    fs, _, jvm_path = _files(spark, at)
    fs.create(jvm_path(f"{at}/{MARK}"), True).close()


def upsert(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
           version: int | None = None) -> int:
    """Keep per key the row that is greatest on `order`, of the table and `df`.

    At equal order the new row wins. `version` numbers the result; giving a
    micro-batch's id makes a retry rebuild the same version from the one
    before it. Rewrites the whole table, so it is for tables of one row per
    key; larger ones should be kept as partials (`write_batch_idempotent`).
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    if version is None:
        newest = current_version(spark, path)
        version = 0 if newest is None else newest + 1
    merged = df.withColumn("__new", F.lit(1))
    current = read_current(spark, path, below=version)
    if current is not None:
        merged = (align_schema(df, current, merge=True).withColumn("__new", F.lit(1))
                  .unionByName(current.withColumn("__new", F.lit(0)), allowMissingColumns=True))
    write_version(last_rows(merged, keys, [*order, "__new"], 1).drop("__new"), path, version)
    return version


def prune_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest `keep` versions; returns the deleted ones.

    Keep at least those that running readers may still use.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    path = path.rstrip("/")
    fs, _, jvm_path = _files(spark, path)
    old = sorted([v for v in _numbers(spark, path) if _complete(spark, path, v)][keep:])
    for version in old:
        fs.delete(jvm_path(_at(path, version)), True)
    return old
