"""Tables as batch and as stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickline.sinks.files import names


def read_table(spark: SparkSession, name: str, merge_schema: bool = False) -> DataFrame:
    """A catalog table, or the Parquet table at a path (anything with a slash)."""
    reader = spark.read.option("mergeSchema", merge_schema)
    return reader.parquet(name) if "/" in name else reader.table(name)


def read_newest_day(spark: SparkSession, path: str, column: str = "event_timestamp") -> DataFrame:
    """Rows of the newest `date` partition that has a value in `column`.

    Days come from the folders' names, so what is read does not grow with the
    table. `quality.freshness` of it equals that of the whole table where `date`
    is the day of `column`. Without such a day there are no rows.
    """
    path = path.rstrip("/")
    days = [n for n in names(spark, path) if "date=" <= n < "date=_"]
    for day in reversed(days):
        rows = spark.read.option("basePath", path).parquet(f"{path}/{day}")
        if not rows.filter(F.col(column).isNotNull()).isEmpty():
            return rows
    return read_table(spark, path).filter(F.lit(False))


def stream_table(spark: SparkSession, path: str, schema: T.StructType,
                 **options: str) -> DataFrame:
    """An append-only Parquet table as a stream. Tables here are never rewritten
    in place, so no option for tolerating changed files is needed."""
    return spark.readStream.schema(schema).options(**options).parquet(path)
