"""Raw snapshot documents: landing and scanning."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.schemas import (
    CORRUPT,
    INSTRUMENTS,
    SNAPSHOT_CURRENCY,
    SNAPSHOT_SOURCE,
    snapshot_schema,
)


LINES = "lines_"  # begins the name of a directory that holds JSON lines


def _matches(spark: SparkSession, path: str) -> list[str]:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jvm_path)
    return [s.getPath().toString() for s in found] if found else []


def _layouts(spark: SparkSession, path: str, multi_line: bool | None) -> list[tuple[bool, list[str]]]:
    """(one document per file?, paths) of what a path or glob leads to.

    What `land_snapshots` landed says so in the directory's name; other files
    count as one document each, as the price API's snapshots come.
    """
    found = _matches(spark, path)
    if multi_line is not None or not found:
        return [(True if multi_line is None else multi_line, found or [path])]
    lines = [p for p in found if p.rstrip("/").rsplit("/", 1)[-1].startswith(LINES)]
    files = [p for p in found if p not in set(lines)]
    return [(kind, paths) for kind, paths in ((True, files), (False, lines)) if paths]


def read_snapshots(spark: SparkSession, path: str, coins: Sequence[str] = INSTRUMENTS,
                   multi_line: bool | None = None) -> DataFrame:
    """Documents under a path or glob, by explicit schema.

    Absent coins read as null and unparsable files are kept in
    `_corrupt_record`. The layout is the one recorded when the documents were
    landed; multi_line overrides it (True: one document per file; False: JSON
    lines, whose files can be split among tasks).
    """
    def read(kind: bool, paths: list[str]) -> DataFrame:
        return (spark.read.schema(snapshot_schema(list(coins)))
                .option("multiLine", kind)
                .option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT)
                .json(paths))

    return reduce(DataFrame.unionByName, [read(*x) for x in _layouts(spark, path, multi_line)])


def hidden_documents(spark: SparkSession, path: str, multi_line: bool | None = None) -> int:
    """Documents that are lost because they stand behind another one in a file
    that is read as a single document. Reads only files of that layout."""
    files = [p for kind, paths in _layouts(spark, path, multi_line) if kind for p in paths]
    if not files:
        return 0
    lines = F.filter(F.split("value", r"\r?\n"), lambda x: x.rlike(r"^\s*\{.*\}\s*$"))
    extra = spark.read.text(files, wholetext=True).select(F.greatest(F.size(lines) - 1, F.lit(0)).alias("n"))
    return extra.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_snapshot_documents(spark: SparkSession, path: str, whole_text: bool = True) -> DataFrame:
    """Documents as text in `value`, for `silver.unpivot_documents`."""
    return spark.read.text(path, wholetext=whole_text)


def land_snapshots(df: DataFrame, path: str, source: str = SNAPSHOT_SOURCE,
                   as_of: dt.datetime | None = None, coins: Sequence[str] | None = None,
                   currency: str = SNAPSHOT_CURRENCY, one_per_file: bool = False) -> str:
    """Store raw quotes with their ingestion metadata; returns the directory.

    Each run adds a directory, `lines_<time>` with JSON lines or, with
    one_per_file, `batch_<time>`; readers take the layout from that name. Rows
    that already carry `ingestion_metadata` keep it.
    """
    moment = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    listed = coins or [c for c in df.columns if c != "ingestion_metadata"]
    if "ingestion_metadata" not in df.columns:
        df = df.withColumn("ingestion_metadata", F.struct(
            F.lit(source).alias("source"),
            F.lit(moment.isoformat()).alias("ingested_at"),
            F.lit(",".join(listed)).alias("coins"),
            F.lit(currency).alias("currency")))
    target = f"{path.rstrip('/')}/{'batch_' if one_per_file else LINES}{moment:%Y%m%d_%H%M%S}"
    writer = df.write.mode("append")
    if one_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    writer.json(target)
    return target
