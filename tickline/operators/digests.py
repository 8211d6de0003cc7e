"""Comparison of two tables by order-free digests, from the top down.

A digest of a group of rows is their number, the sums of both halves of the
rows' 64-bit hashes, and their exclusive or. It does not depend on the order of
the rows, it is made before the shuffle, and digests of groups add up to the
digest of their union. Tables are compared by day and instrument; only the days
whose digests differ are read again, and there rows are compared by value.

Nulls are part of a hash (a null and an absent value are not skipped), -0.0 and
0.0 are one value, and so are all NaNs. Repeated rows count as often as they
occur. An empty table has no groups. Two groups that differ share a digest with
a probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.session import materialise
from tickline.sources.changes import on_days

GROUPS = ("date", "coin_id")
KEYS = ("coin_id", "event_timestamp")
PARTS = ("rows", "low", "high", "odd")


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row; `xxhash64` alone passes over nulls, so each column says whether it is one."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def digests(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = GROUPS) -> DataFrame:
    """One row per group: `by`, and the digest of the group's rows."""
    columns = sorted(columns or df.columns)
    hashed = df.select(*by, row_hash(columns).alias("__hash"))
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("__hash").bitwiseAND(0xFFFFFFFF)).alias("low"),
        F.sum(F.shiftrightunsigned("__hash", 32)).alias("high"),
        F.bit_xor("__hash").alias("odd"))


def merged(groups: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Digests of coarser groups, from those of finer ones."""
    return groups.groupBy(*by).agg(*[F.sum(c).alias(c) for c in PARTS[:3]], F.bit_xor("odd").alias("odd"))


def differing(left: DataFrame, right: DataFrame, by: Sequence[str] = GROUPS) -> DataFrame:
    """Groups whose digests differ, with their numbers of rows on both sides."""
    both = (left.select(*by, *[F.col(c).alias(f"__l_{c}") for c in PARTS])
            .unionByName(right.select(*by, *[F.col(c).alias(f"__r_{c}") for c in PARTS]), allowMissingColumns=True)
            .groupBy(*by).agg(*[F.max(f"__{s}_{c}").alias(f"__{s}_{c}") for s in "lr" for c in PARTS]))
    same = [F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}")) for c in PARTS]
    unlike = ~(same[0] & same[1] & same[2] & same[3])
    return both.filter(unlike).select(*by, F.coalesce("__l_rows", F.lit(0)).alias("left_rows"),
                                      F.coalesce("__r_rows", F.lit(0)).alias("right_rows"))


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS, columns: Sequence[str] | None = None,
            day: str = "date", by: Sequence[str] = GROUPS, left_digests: DataFrame | None = None,
            right_digests: DataFrame | None = None) -> DataFrame:
    """The keys at which two tables differ.

    One row per key: left_only and right_only, the rows of it that only one side
    has, and `columns`, the names of those that differ where it is one row on
    each side (else null). Columns that only one table has are not compared,
    unless `columns` names them.

    Digests that were stored for a table spare its first reading. The driver
    holds the days that differ.
    """
    columns = list(columns or [c for c in left.columns if c in right.columns])
    columns = list(dict.fromkeys([*by, *keys, *columns]))
    sides = [materialise(digests(df, columns, by), "digests") if stored is None else stored
             for df, stored in ((left, left_digests), (right, right_digests))]
    groups = materialise(differing(*sides, by), "differing")
    days = on_days([r[0] for r in groups.select(day).distinct().collect()], day)
    marks = groups.select(*[F.col(c).alias(f"__{c}") for c in by])
    same_group = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]

    def suspects(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*columns).filter(days).join(marks, same_group, "left_semi").withColumn("__n", F.lit(sign))

    # Equal rows cancel before the shuffle, and after it.
    balance = (suspects(left, 1).unionByName(suspects(right, -1)).groupBy(*columns)
               .agg(F.sum("__n").alias("__n")).filter("__n <> 0"))
    row = F.struct(*columns)
    found = balance.groupBy(*keys).agg(
        F.sum(F.when(F.col("__n") > 0, F.col("__n")).otherwise(0)).alias("left_only"),
        F.sum(F.when(F.col("__n") < 0, -F.col("__n")).otherwise(0)).alias("right_only"),
        F.max(F.when(F.col("__n") > 0, row)).alias("__left"), F.max(F.when(F.col("__n") < 0, row)).alias("__right"))
    names = F.array(*[F.when(~F.col(f"__left.`{c}`").eqNullSafe(F.col(f"__right.`{c}`")), F.lit(c))
                      for c in columns if c not in keys])
    one_each = (F.col("left_only") == 1) & (F.col("right_only") == 1)
    return found.select(*keys, "left_only", "right_only", F.when(one_each, F.array_compact(names)).alias("columns"))
