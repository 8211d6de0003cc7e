import datetime as dt

import pytest
from conftest import rows

from tickline import sinks, sources
from tickline.operators import gold, reports


@pytest.fixture
def performance(spark, at):
    data = [("a", at(60 * h), 1.123456, 2.0, 3.0, 0.1234567, 1 + h % 2, at(60 * h).date())
            for h in range(60)]
    return spark.createDataFrame(
        data, "coin_id string, event_timestamp timestamp, price_usd double, volume_24h double, "
              "moving_avg_price double, price_volatility double, market_cap_rank int, date date")


def test_snapshot_report(spark, at):
    df = spark.createDataFrame(
        [("a", 1.00005, 10.005, 1.0, at(0)), ("a", 2.0, 20.0, 1.0, at(1)), ("b", 3.0, 30.0, 1.0, at(0))],
        "coin_id string, price_usd double, market_cap double, volume_24h double, event_timestamp timestamp")
    got = reports.snapshot_report(df)
    assert got.columns == ["coin_id", "price_usd", "market_cap_usd", "volume_24h_usd", "event_timestamp"]
    assert [r.coin_id for r in got.collect()] == ["b", "a"]
    by_price = reports.snapshot_report(df, "price")
    assert [r.target_live_price for r in by_price.collect()] == [3.0, 2.0, 1.0001]
    with pytest.raises(ValueError):
        reports.snapshot_report(df, "volume")


def test_recent_includes_both_ends(performance, at):
    got = reports.performance_recent(performance, 24).collect()
    assert len(got) == 25
    assert (got[0].event_timestamp, got[-1].event_timestamp) == (at(60 * 59), at(60 * 35))
    assert got[0].price_volatility_index == 0.123457
    names = ("rolling_avg_price", "calculated_volatility_index")
    hourly = reports.performance_recent(performance.drop("date"), 1, names)
    assert hourly.count() == 2 and hourly.columns[3:5] == list(names)


def test_recent_prunes_old_days(spark, performance, tmp_path):
    path = f"{tmp_path}/performance"
    sinks.overwrite_table(performance, path, ["date"])
    report = reports.performance_recent(sources.read_table(spark, path), 1)
    assert report.count() == 2
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "date#" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_daily_reports(spark, at):
    prices = spark.createDataFrame(
        [("a", 1.0, 1.0, at(0).date()), ("a", 2.0, 1.0, at(0).date()), ("b", 9.0, 1.0, at(0).date()),
         ("a", 1.0, 1.0, at(1500).date())],
        "coin_id string, price_usd double, volume_24h double, date date")
    daily = gold.daily_trends(prices)
    counted = reports.daily_report(daily)
    assert counted.columns == ["date", "coin_id", "daily_avg", "daily_peak", "daily_floor",
                               "total_sampled_ticks"]
    assert [(r.date.day, r.coin_id, r.total_sampled_ticks) for r in counted.collect()] == [
        (2, "a", 1), (1, "b", 1), (1, "a", 2)]
    sampled = reports.daily_report(daily.unionByName(daily.filter("coin_id = 'b'")), "sampled")
    assert [(r.coin_id, r.validation_ticks_sampled) for r in sampled.collect()] == [
        ("a", 1), ("b", 2), ("a", 1)]
    with pytest.raises(ValueError):
        reports.daily_report(daily, "x")


def test_latest_rows(performance, at):
    got = reports.latest_rows(performance)
    assert [r.event_timestamp for r in got.collect()] == [at(60 * h) for h in range(59, 44, -1)]
    assert rows(reports.latest_rows(performance, 1), "event_timestamp") == [(at(60 * 59),)]
    assert "TakeOrderedAndProject" in got._jdf.queryExecution().executedPlan().toString()
    assert dt.datetime(2024, 1, 3, 11) == at(60 * 59)
