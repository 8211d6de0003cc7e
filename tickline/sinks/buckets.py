"""Keyed upsert that reads and writes only the buckets with new rows.

A table is cut into buckets by a hash of its key. Each version has a manifest,
a small JSON file that names, for every bucket, the folder that holds it. An
upsert merges the buckets that its rows fall into, writes those to a folder of
its own and then the manifest, in which all other buckets keep their folders.
The manifest appears by a rename, so readers see a version whole or not at all;
a failed attempt leaves only a folder that no manifest names.

    <path>/_manifest/v000000000007.json
    <path>/data/v000000000007-<attempt>/bucket=12/part-*.parquet

There is one row per key, so buckets are even however often a key is updated;
their number should give a bucket a few hundred megabytes (`rebucket` changes
it). The driver holds the manifest, one line per bucket, and no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.operators.series import last_rows
from tickline.session import materialise
from tickline.sinks.files import delete, names, read_text, write_text
from tickline.sinks.tables import align_schema

_BUCKET = "bucket"


@dataclass(frozen=True)
class Manifest:
    """One version: which folder holds which bucket."""

    version: int
    buckets: int
    keys: list[str]
    schema: T.StructType
    folders: dict[int, str] = field(default_factory=dict)


def _file(path: str, version: int) -> str:
    return f"{path}/_manifest/v{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that have a manifest, the newest first."""
    found = [n for n in names(spark, f"{path.rstrip('/')}/_manifest") if n.startswith("v") and n.endswith(".json")]
    return sorted((int(n[1:-5]) for n in found), reverse=True)


def manifest(spark: SparkSession, path: str, below: int | None = None) -> Manifest | None:
    """The newest manifest (older than `below`), or None before the first one."""
    path = path.rstrip("/")
    version = next((v for v in versions(spark, path) if below is None or v < below), None)
    if version is None:
        return None
    said = json.loads(read_text(spark, _file(path, version)))
    return Manifest(version, said["buckets"], said["keys"], T.StructType.fromJson(said["schema"]),
                    {int(b): f for b, f in said["folders"].items()})


def _save(spark: SparkSession, path: str, made: Manifest) -> None:
    said = {"buckets": made.buckets, "keys": made.keys, "schema": made.schema.jsonValue(), "folders": made.folders}
    write_text(spark, _file(path, made.version), json.dumps(said))


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, held: Manifest, only: Sequence[int] | None = None) -> DataFrame:
    folders = [f for b, f in sorted(held.folders.items()) if only is None or b in set(only)]
    if not folders:
        return spark.createDataFrame([], held.schema)
    # Folders are given one by one, so no partition column is found in their names.
    return spark.read.schema(held.schema).parquet(*[f"{path}/{f}" for f in folders])


def read_buckets(spark: SparkSession, path: str, below: int | None = None,
                 only_keys: Sequence[Sequence] | None = None) -> DataFrame | None:
    """The table as of its newest version, or None before the first one.

    only_keys   tuples of key values: only the buckets that can hold them are
                read, and only their rows returned
    """
    path = path.rstrip("/")
    held = manifest(spark, path, below)
    if held is None or only_keys is None:
        return None if held is None else _read(spark, path, held)
    wanted = spark.createDataFrame([tuple(k) for k in only_keys], T.StructType([held.schema[k] for k in held.keys]))
    marked = wanted.select(*held.keys, _bucket_of(held.keys, held.buckets).alias("__bucket"))
    buckets = {r["__bucket"] for r in marked.select("__bucket").distinct().collect()}
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in held.keys]
    return _read(spark, path, held, sorted(buckets)).join(
        wanted.select(*[F.col(k).alias(f"__{k}") for k in held.keys]), same, "left_semi")


def upsert_buckets(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str],
                   version: int | None = None, buckets: int = 64) -> int:
    """Keep per key the row that is greatest on `order`, of the table and `df`.

    At equal order the new row wins. `version` numbers the result; with a
    micro-batch's id a retry rebuilds that version from the one before it. A
    table keeps the number of buckets it began with.
    """
    spark, path, keys = df.sparkSession, path.rstrip("/"), list(keys)
    if version is None:
        version = max(versions(spark, path), default=-1) + 1
    held = manifest(spark, path, below=version)
    if held is not None:
        if held.keys != keys:
            raise ValueError(f"{path} is kept by {held.keys}, not {keys}")
        df, buckets = align_schema(df, held.schema, merge=True), held.buckets
    # Evaluated once: the newest row per key of the new ones, with its bucket.
    fresh = materialise(last_rows(df, keys, order, 1).withColumn("__bucket", _bucket_of(keys, buckets)), "upsert")
    touched = sorted(r["__bucket"] for r in fresh.select("__bucket").distinct().collect())
    schema = fresh.drop("__bucket").schema

    folders = dict(held.folders) if held else {}
    merged = fresh.withColumn("__new", F.lit(1))
    stored = [b for b in touched if b in folders]
    if stored:
        current = _read(spark, path, held, stored)
        merged = merged.unionByName(
            current.withColumns({"__bucket": _bucket_of(keys, buckets), "__new": F.lit(0)}), allowMissingColumns=True)
    kept = last_rows(merged, [*keys, "__bucket"], [*order, "__new"], 1).drop("__new")
    folders |= _write(kept, path, version, touched)
    _save(spark, path, Manifest(version, buckets, keys, schema, folders))
    return version


def _write(rows: DataFrame, path: str, version: int, buckets: Sequence[int]) -> dict[int, str]:
    """Write rows by their `__bucket` to a new folder; bucket -> folder."""
    if not buckets:
        return {}
    attempt = f"data/v{version:012d}-{uuid.uuid4().hex[:8]}"
    (rows.withColumnRenamed("__bucket", _BUCKET).hint("rebalance", _BUCKET)
     .write.partitionBy(_BUCKET).parquet(f"{path}/{attempt}"))
    return {b: f"{attempt}/{_BUCKET}={b}" for b in buckets}


def rebucket(spark: SparkSession, path: str, buckets: int) -> int:
    """Write the whole table anew with another number of buckets, as its next version."""
    path = path.rstrip("/")
    held = manifest(spark, path)
    if held is None:
        raise ValueError(f"no table at {path}")
    rows = _read(spark, path, held).withColumn("__bucket", _bucket_of(held.keys, buckets))
    # Buckets without a row have no folder.
    found = [r["__bucket"] for r in rows.select("__bucket").distinct().collect()]
    folders = _write(rows, path, held.version + 1, found)
    _save(spark, path, Manifest(held.version + 1, buckets, held.keys, held.schema, folders))
    return held.version + 1


def prune_buckets(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest `keep` versions, and the buckets that none of
    those names; returns the deleted folders. Not while an upsert runs."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    path = path.rstrip("/")
    numbers = versions(spark, path)
    kept = [manifest(spark, path, below=v + 1) for v in numbers[:keep]]
    named = {f for m in kept for f in m.folders.values()}
    for version in numbers[keep:]:
        delete(spark, _file(path, version))
    gone = []
    for attempt in names(spark, f"{path}/data"):
        inside = [n for n in names(spark, f"{path}/data/{attempt}") if n.startswith(f"{_BUCKET}=")]
        unused = [f"data/{attempt}/{n}" for n in inside if f"data/{attempt}/{n}" not in named]
        if len(unused) == len(inside):
            delete(spark, f"{path}/data/{attempt}")
        else:
            for folder in unused:
                delete(spark, f"{path}/{folder}")
        gone += unused
    return gone
