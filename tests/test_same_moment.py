"""Events of one instrument at one moment, and messages sent again."""

import datetime as dt

import pytest
from conftest import rows

from tickline.plans import whole  # noqa: F401  registers more queries
from tickline.plans.queries import QUERIES

T = dt.datetime(2024, 1, 1, 5)
EVENTS = [(1, T, 3, "click", 10.0), (2, T, 3, "click", 20.0), (3, T, 6, "click", 20.0),
          (4, T + dt.timedelta(seconds=9), 3, "click", 5.0)]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """A folder with an `events` table: three events of click-0 at one moment, one later."""
    path = str(tmp_path_factory.mktemp("same_moment"))
    made = spark.createDataFrame([(*e, '{"k": 1}') for e in EVENTS],
                                 "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    made.coalesce(1).write.parquet(f"{path}/events.parquet")
    return path


def test_delays_count_every_event(spark, events):
    # One in 103 has a delay of -5 and one in 107 is repeated: none of these four.
    assert rows(QUERIES["delays_by_state"](spark, events), "coin_id", "rows", "moments_close") == [("click-0", 4, True)]


def test_flag_of_every_event(spark, events):
    assert rows(QUERIES["flag_every_tick"](spark, events), "event_id", "price_change_flag") == [
        (1, "STABLE"), (2, "UP"), (3, "STABLE"), (4, "DOWN")]


def test_move_of_every_event(spark, events):
    assert set(rows(QUERIES["moves_every_tick"](spark, events), "price_usd", "prev_price")) == {
        (10.0, None), (20.0, 10.0), (20.0, 20.0), (5.0, 20.0)}


def test_performance_of_every_event(spark, events):
    assert set(rows(QUERIES["performance_every_tick"](spark, events), "price_usd", "moving_avg_price", "market_cap_rank")) == {
        (10.0, 10.0, 3), (20.0, 15.0, 1), (20.0, 16.6667, 1), (5.0, 13.75, 1)}


def test_daily_upsert_counts_a_message_once(spark, tmp_path):
    path = f"{tmp_path}/events"
    sent = [(n, T + dt.timedelta(seconds=s), 3, "click", price, '{"k": 1}') for n, s, price in ((1, 0, 10.0), (2, 0, 10.0), (3, 9, 20.0))]
    spark.createDataFrame(sent, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{path}/events.parquet")
    assert rows(QUERIES["stream_daily_upsert"](spark, path), "coin_id", "daily_avg_price", "record_count") == [("click-0", 15.0, 2)]
