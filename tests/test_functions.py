import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickline import functions as C


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, value)
    return df.select(column.alias("x")).first()[0]


def test_nested_takes_hyphens_and_dots(spark):
    df = spark.sql("SELECT named_struct('usd', 1.5D) AS `shiba-inu`, named_struct('a.b', 2) AS c")
    assert df.select(C.nested("shiba-inu", "usd")).first()[0] == 1.5
    assert df.select(C.nested("c", "a.b")).first()[0] == 2


def test_event_time_units_and_precision(spark):
    assert one(spark, C.event_time(F.lit(1704067200))) == dt.datetime(2024, 1, 1)
    ms = F.lit(1704067200987)
    assert one(spark, C.event_time(ms, "ms")) == dt.datetime(2024, 1, 1)
    assert one(spark, C.event_time(ms, "ms", "milli")) == dt.datetime(2024, 1, 1, 0, 0, 0, 987000)
    with pytest.raises(ValueError):
        C.event_time(ms, "us")
    with pytest.raises(ValueError):
        C.event_time(ms, "ms", "micro")


@pytest.mark.parametrize("text, expected", [
    ("2024-01-01T10:00:00.5", dt.datetime(2024, 1, 1, 10, 0, 0, 500000)),
    ("2024-01-01T10:00:00", dt.datetime(2024, 1, 1, 10)),
    ("not a time", None), ("", None), (None, None)])
def test_parse_time(spark, text, expected):
    assert one(spark, C.parse_time(F.lit(text).cast("string"))) == expected


def test_ingestion_delay(spark):
    at = F.lit("2024-01-01 00:00:10").cast("timestamp")
    assert one(spark, C.ingestion_delay(at, F.lit(1704067200))) == 10
    assert one(spark, C.ingestion_delay(at, F.lit(1704067215))) == -5
    late = F.lit(1704067209400)
    assert one(spark, C.ingestion_delay(at, late, "ms")) == 0
    assert one(spark, C.ingestion_delay(at, late, "ms", True)) == pytest.approx(0.6)
    assert one(spark, C.ingestion_delay(at, F.lit(1704067210001), "ms")) == -1


@pytest.mark.parametrize("symbol, price, valid", [
    ("bitcoin", 9_999.0, False), ("bitcoin", 10_000.0, True), ("bitcoin", 250_000.0, True),
    ("bitcoin", 250_001.0, False), ("near", 1.0, True), ("near", 0.0, False),
    ("near", -1.0, False), ("near", None, None), (None, 1.0, False)])
def test_valid_tick(spark, symbol, price, valid):
    got = one(spark, C.valid_tick(F.lit(symbol).cast("string"), F.lit(price).cast("double")))
    assert bool(got) == bool(valid)


@pytest.mark.parametrize("price, previous, flag, ratio", [
    (2.0, 1.0, "UP", 1.0), (1.0, 2.0, "DOWN", 0.5), (1.0, 1.0, "STABLE", 0.0),
    (1.0, None, "STABLE", None), (1.0, 0.0, "UP", None)])
def test_change(spark, price, previous, flag, ratio):
    p, q = F.lit(price).cast("double"), F.lit(previous).cast("double")
    assert one(spark, C.change_flag(p, q)) == flag
    assert one(spark, C.change_ratio(p, q)) == ratio


def test_load_time_may_be_fixed(spark):
    moment = dt.datetime(2024, 5, 1, 12)
    assert one(spark, C.load_time(moment)) == moment
    zoned = moment.replace(tzinfo=dt.timezone(dt.timedelta(hours=2)))
    assert one(spark, C.load_time(zoned)) == dt.datetime(2024, 5, 1, 10)
    assert one(spark, C.load_time()) is not None
