"""Cut series must give what a plain window over the whole series gives."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickline.operators import series

SCHEMA = "k string, t timestamp, i bigint, v double"
START = dt.datetime(2024, 1, 1)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def columns(n):
    return {
        "mean": lambda w: F.avg("v").over(w.rowsBetween(-n, 0)),
        "spread": lambda w: F.stddev("v").over(w.rowsBetween(-n, 0)),
        "before": lambda w: F.lag("v", n).over(w),
    }


def plain(df, n):
    w = Window.partitionBy("k").orderBy("t", "i")
    return df.select("*", *[make(w).alias(name) for name, make in columns(n).items()])


def same(a, b):
    a, b = a.select(sorted(a.columns)), b.select(sorted(b.columns))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def sample(keys=3, n=300, hot=0.5, seed=1, span=20 * 24 * 60):
    """Half the rows in one key, uneven gaps, whole days without rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < hot else f"k{rng.randrange(keys)}"
        minute = int(span * rng.random() ** 3)
        price = None if rng.random() < 0.05 else round(rng.uniform(0, 100), 2)
        out.append((key, START + dt.timedelta(minutes=minute), i, price))
    return out


@pytest.mark.parametrize("layout", ["time", "range"])
@pytest.mark.parametrize("n", [1, 6])
def test_equals_plain_window(spark, layout, n):
    df = frame(spark, sample())
    got = series.over_series(df, ["k"], ["t", "i"], n, columns(n), layout=layout)
    assert same(got, plain(df, n))


@pytest.mark.parametrize("unit", ["minute", "hour", "day", "month"])
def test_chunk_unit_does_not_matter(spark, unit):
    df = frame(spark, sample(seed=2))
    got = series.over_series(df, ["k"], ["t", "i"], 6, columns(6), unit=unit)
    assert same(got, plain(df, 6))


def test_null_times_and_null_keys(spark):
    data = sample(n=60) + [("k1", None, 900, 5.0), ("k1", None, 901, 6.0),
                           (None, START, 902, 1.0), (None, START, 903, 2.0)]
    df = frame(spark, data)
    assert same(series.over_series(df, ["k"], ["t", "i"], 3, columns(3)), plain(df, 3))


def test_all_rows_at_one_moment(spark):
    """One moment of one key holds everything; even chunks cut it all the same."""
    df = frame(spark, [("k", START, i, float(i)) for i in range(500)])
    got = series.over_series(df, ["k"], ["t", "i"], 6, columns(6), layout="range",
                             chunk_rows=100)
    assert same(got, plain(df, 6))


@pytest.mark.parametrize("rows", [50, 100, 1000])
def test_chunks_grow_in_number_not_in_size(spark, rows):
    cut = series.range_chunks(frame(spark, [("k", START, i, float(i)) for i in range(400)]), ["k", "i"], rows)
    sizes = [n for _, n in cut.groupBy("__chunk").count().collect()]
    assert len(sizes) == -(-400 // rows) and sum(sizes) == 400


def test_columns_it_does_not_read_are_kept(spark):
    df = frame(spark, sample(n=50)).withColumn("note", F.concat("k", F.lit("!")))
    got = series.over_series(df, ["k"], ["t", "i"], 2, {"before": columns(2)["before"]}, carry=["v"])
    assert got.columns == ["k", "t", "i", "v", "note", "before"]
    assert got.count() == 50 and got.filter("note IS NULL").isEmpty()


def test_prior_rows_are_looked_back_on_but_not_returned(spark):
    data = sorted(sample(n=200), key=lambda r: (r[1], r[2]))
    early, late = frame(spark, data[:120]), frame(spark, data[120:])
    prior = series.last_rows(early, ["k"], ["t", "i"], 6)
    got = series.over_series(late, ["k"], ["t", "i"], 6, columns(6), prior=prior)
    expected = plain(frame(spark, data), 6).join(late.select("i"), "i", "left_semi")
    assert same(got, expected)


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        series.over_series(frame(spark, []), ["k"], ["t"], 1, {}, layout="x")
    with pytest.raises(ValueError):
        series.rank_within(frame(spark, []), ["k"], "v", "r", "x")


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 6 * 24), st.integers(0, 5)),
                max_size=40), st.integers(1, 7))
def test_any_series(spark, drawn, n):
    df = frame(spark, [(k, START + dt.timedelta(hours=h), i, float(v))
                       for i, (k, h, v) in enumerate(drawn)])
    assert same(series.over_series(df, ["k"], ["t", "i"], n, columns(n)), plain(df, n))


@pytest.mark.parametrize("layout", ["plain", "range"])
def test_rank_with_ties_and_nulls(spark, layout):
    rng = random.Random(3)
    values = [None, 1.0, 2.0, 2.5, 7.0, 7.5, 9.0]
    df = frame(spark, [(rng.choice(["a", "b", None]), START, i, rng.choice(values))
                       for i in range(120)])
    spec = Window.partitionBy("k").orderBy(F.col("v").desc())
    got = series.rank_within(df, ["k"], "v", "r", layout, chunk_rows=10)
    assert same(got, df.withColumn("r", F.rank().over(spec)))
    assert dict(got.dtypes)["r"] == "int"
