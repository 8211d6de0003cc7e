"""Windows over long per-key series, split so that no task holds a whole key.

A row-frame window partitioned by a key puts the key's whole history into one
task. Here every series is cut into order-preserving chunks. The windows run
per (key, chunk), and each chunk first receives a copy of the few rows that
precede it, so the frames come out as if the series had not been cut.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickline.session import materialise

_CHUNK = "__chunk"
_COPY = "__copy"

CHUNK_ROWS = 1_000_000


def time_chunk(time: str, unit: str = "day") -> Column:
    return F.to_date(time) if unit == "day" else F.date_trunc(unit, F.col(time))


def range_chunks(df: DataFrame, order: Sequence[Column | str],
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Number `df`'s rows by range partition of `order`, and materialise.

    The numbers rise with `order` and the partitions are even however the keys
    are spread, as for a global sort; there is one for every `chunk_rows` rows,
    so a chunk is as large for any input. Range bounds come from a sample, so
    the numbers are only fixed once written.
    """
    n = max(1, -(-df.count() // chunk_rows))
    ranged = df.repartitionByRange(n, *order).withColumn(_CHUNK, F.spark_partition_id())
    return materialise(ranged, "chunks")


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[str], layout: str,
         unit: str, chunk_rows: int) -> DataFrame:
    if layout == "time":
        return df.withColumn(_CHUNK, time_chunk(order[0], unit))
    if layout == "range":
        return range_chunks(df, [*keys, *order], chunk_rows)
    raise ValueError(f"layout must be 'time' or 'range', not {layout!r}")


def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The n latest rows per key. Spark limits the rows before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (df.withColumn("__row", F.row_number().over(newest))
              .filter(F.col("__row") <= n)
              .drop("__row"))


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    carry: Sequence[str] | None = None,
    layout: str = "time",
    unit: str = "day",
    prior: DataFrame | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add window columns that look back at most `preceding` rows per key.

    columns   name -> function of the ordered window; set `rowsBetween` there
    order     ascending, first a time; its last part should break ties
    carry     columns the windows read; all of them by default, which lets
              both branches of the plan share one exchange of `df`
    layout    "time": chunks of one `unit`. A chunk holds no more rows than
              distinct order values in a unit, so this is for series that are
              unique on (keys, order) at a bounded resolution;
              "range": even chunks of `chunk_rows` rows for any spread, at the
              price of a row count and a materialised range shuffle
    prior     earlier rows to look back on, not part of the result
    """
    names = df.columns
    rows = df.withColumn(_COPY, F.lit(False))
    if prior is not None:
        rows = rows.unionByName(prior.withColumn(_COPY, F.lit(True)), allowMissingColumns=True)
    rows = _cut(rows, keys, order, layout, unit, chunk_rows)

    held = [c for c in dict.fromkeys([*order, *(carry or names)]) if c not in keys]
    tails = last_rows(rows.select(*keys, _CHUNK, *held), [*keys, _CHUNK], order, preceding)
    per_chunk = tails.groupBy(*keys, _CHUNK).agg(
        F.sort_array(F.collect_list(F.struct(*held))).alias("__tail"))

    # One row per chunk from here on. `preceding` chunks before it always hold
    # enough rows, as an empty chunk has no row here.
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(-preceding, -1)
    gathered = per_chunk.select(
        *keys, _CHUNK, F.flatten(F.collect_list("__tail").over(before)).alias("__tail"))
    start = F.greatest(F.lit(1), F.size("__tail") - (preceding - 1))
    copies = (gathered
              .select(*keys, _CHUNK, F.explode(F.slice("__tail", start, preceding)).alias("__row"))
              .select(*keys, _CHUNK, "__row.*")
              .withColumn(_COPY, F.lit(True)))

    spec = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
    return (rows.unionByName(copies, allowMissingColumns=True)
                .select("*", *[make(spec).alias(name) for name, make in columns.items()])
                .filter(~F.col(_COPY))
                .select(*[c for c in names if c not in columns], *columns))


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    name: str,
    layout: str = "plain",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add `rank()` of `value`, largest first and nulls last, within `group`.

    layout    "plain": one window; a group is one task's work, so this is for
              groups of bounded size, such as the instruments of one moment;
              "range": ties are counted first, the distinct values are cut into
              even chunks of `chunk_rows`, and the ranks are joined back
    """
    group = list(group)
    if layout == "plain":
        spec = Window.partitionBy(*group).orderBy(F.col(value).desc())
        return df.withColumn(name, F.rank().over(spec))
    if layout != "range":
        raise ValueError(f"layout must be 'plain' or 'range', not {layout!r}")

    ties = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    cut = range_chunks(ties, [*group, F.col(value).desc()], chunk_rows)
    chunks_above = (Window.partitionBy(*group).orderBy(_CHUNK)
                    .rowsBetween(Window.unboundedPreceding, -1))
    values_above = (Window.partitionBy(*group, _CHUNK).orderBy(F.col(value).desc())
                    .rowsBetween(Window.unboundedPreceding, -1))

    def above(total: str, spec: WindowSpec) -> Column:
        return F.coalesce(F.sum(total).over(spec), F.lit(0))

    offsets = (cut.groupBy(*group, _CHUNK).agg(F.sum("__n").alias("__sum"))
               .withColumn("__offset", above("__sum", chunks_above)).drop("__sum"))
    ranked = (_join_nulls(cut.withColumn("__above", above("__n", values_above)),
                          offsets, [*group, _CHUNK])
              .select(*group, value,
                      (F.col("__above") + F.col("__offset") + 1).cast("int").alias(name)))
    return _join_nulls(df, ranked, [*group, value])


def _join_nulls(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join on columns of the same names, where a null equals a null."""
    renamed = right.withColumnsRenamed({c: f"__right_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__right_{c}")) for c in on]
    return left.join(renamed, same).drop(*[f"__right_{c}" for c in on])
