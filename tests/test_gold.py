import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickline.operators import gold

SILVER = "coin_id string, event_timestamp timestamp, price_usd double, market_cap double, volume_24h double, date date"


@pytest.fixture
def prices(spark, at):
    data = [("a", 5 * i, float(i * i), 100.0 + i, 10.0) for i in range(10)]
    data += [("b", 0, 3.0, 100.0, None), ("c", 0, 4.0, None, 1.0), ("d", 0, 5.0, None, 1.0)]
    return spark.createDataFrame(
        [(c, at(m), p, cap, v, at(m).date()) for c, m, p, cap, v in data], SILVER)


def test_latest_snapshot(prices, at):
    got = gold.latest_snapshot(prices)
    assert got.columns == ["coin_id", "price_usd", "market_cap", "volume_24h", "event_timestamp"]
    assert rows(got, "coin_id", "price_usd") == [("a", 81.0), ("b", 3.0), ("c", 4.0), ("d", 5.0)]
    assert "market_cap" not in gold.latest_snapshot(prices.drop("market_cap")).columns


def test_price_performance(prices, at):
    got = gold.price_performance(prices)
    assert got.columns == ["coin_id", "event_timestamp", "price_usd", "market_cap", "volume_24h",
                           "moving_avg_price", "price_volatility", "market_cap_rank", "date"]
    assert dict(got.dtypes)["market_cap_rank"] == "int"
    last = got.filter("coin_id = 'a'").orderBy(F.desc("event_timestamp")).first()
    window = [float(i * i) for i in range(3, 10)]
    mean = sum(window) / 7
    deviation = (sum((x - mean) ** 2 for x in window) / 6) ** 0.5
    assert last.moving_avg_price == round(mean, 4)
    assert last.price_volatility == pytest.approx(round(deviation, 6))


def test_first_row_has_no_volatility(prices):
    assert rows(gold.price_performance(prices).filter("coin_id = 'b'"),
                "moving_avg_price", "price_volatility") == [(3.0, 0.0)]


def test_rank_ties_and_nulls(prices, at):
    first = gold.price_performance(prices).filter(F.col("event_timestamp") == F.lit(at(0)))
    assert rows(first, "coin_id", "market_cap_rank") == [("a", 1), ("b", 1), ("c", 3), ("d", 3)]
    by_price = gold.price_performance(prices.drop("market_cap"), rank_by="price_usd")
    assert "market_cap" not in by_price.columns
    first = by_price.filter(F.col("event_timestamp") == F.lit(at(0)))
    assert rows(first, "coin_id", "market_cap_rank") == [("a", 4), ("b", 3), ("c", 2), ("d", 1)]


def test_daily_trends(prices):
    got = gold.daily_trends(prices)
    assert got.columns == ["date", "coin_id", "daily_avg_price", "daily_max_price",
                           "daily_min_price", "daily_avg_volume", "record_count"]
    assert rows(got.filter("coin_id IN ('a', 'b')")) == [
        (dt.date(2024, 1, 1), "a", 28.5, 81.0, 0.0, 10.0, 10),
        (dt.date(2024, 1, 1), "b", 3.0, 3.0, 3.0, None, 1)]


def test_merged_partials_equal_daily_trends(prices):
    parts = [gold.daily_partials(prices.filter(F.minute("event_timestamp") % 3 == n)) for n in range(3)]
    merged = gold.merge_daily_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(merged) == rows(gold.daily_trends(prices))
    assert merged.columns == gold.daily_trends(prices).columns


def test_half_way_means_do_not_depend_on_the_order_of_summing(spark, at):
    """The mean is exactly 46.33375; sums of these doubles differ in the last bits."""
    values = [2.24, 101.68, 56.11, 33.07, 48.9, 12.35, 77.72, 38.6]
    assert sum(round(v * 100) for v in values) == 37067
    results = set()
    for parts in (1, 2, 3, 8):
        for data in (values, values[::-1], sorted(values)):
            df = spark.createDataFrame([("a", at(0).date(), v, v) for v in data],
                                       "coin_id string, date date, price_usd double, volume_24h double")
            results.add(gold.daily_trends(df.repartition(parts)).first().daily_avg_price)
    assert results == {46.3338}


def test_empty_input(spark):
    empty = spark.createDataFrame([], SILVER)
    for operator in (gold.latest_snapshot, gold.price_performance, gold.daily_trends):
        assert operator(empty).isEmpty()
