"""Small files and folders, in whatever store the path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is directly below a folder; none if it is missing."""
    fs, at = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _open(spark, path)
    fs.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _open(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place, then move it there: it is seen whole or not at all."""
    fs, at = _open(spark, path)
    _, beside = _open(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(beside, at):
        raise OSError(f"could not write {path}")
