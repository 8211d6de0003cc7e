import datetime as dt
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickline import sinks, sources, streaming
from tickline.operators import gold, quality
from tickline.streaming.gold import process_batch

AS_OF = dt.datetime(2024, 2, 1)
EPOCH = 1704067200000


def tick(symbol, second, price, volume=5.0):
    return json.dumps({"symbol": symbol, "price": price, "volume": volume,
                       "timestamp": EPOCH + int(second * 1000)})


class Run:
    """One stream set-up over a directory of messages."""

    def __init__(self, spark, base):
        self.spark, self.base, self.files = spark, str(base), 0
        os.makedirs(f"{self.base}/landed")

    def send(self, *messages):
        with open(f"{self.base}/landed/{self.files:03d}.json", "w") as out:
            out.write("\n".join(messages))
        self.files += 1

    def bronze(self):
        messages = sources.tick_stream(self.spark, "files", f"{self.base}/landed")
        return streaming.run_bronze(messages, f"{self.base}/bronze", f"{self.base}/c_bronze")

    def table(self, name):
        return sources.read_table(self.spark, f"{self.base}/{name}")

    def source(self, name):
        return sources.stream_table(self.spark, f"{self.base}/{name}", self.table(name).schema)

    def silver(self, **options):
        self.bronze()
        options = {"as_of": AS_OF, **options}
        streaming.run_silver(self.source("bronze"), f"{self.base}/silver", f"{self.base}/c_silver",
                             **options)
        return self.table("silver")

    def gold(self, mode, **options):
        self.silver()
        streaming.gold_fanout(self.source("silver"), f"{self.base}/gold", f"{self.base}/c_gold",
                              mode=mode, **options)
        return f"{self.base}/gold"


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path / "run")


def test_bronze_keeps_everything_and_resumes(run):
    run.send(tick("near", 1, 2.0), "nonsense")
    run.bronze()
    run.bronze()
    assert run.table("bronze").count() == 2
    run.send(tick("near", 2, 2.0))
    run.bronze()
    assert run.table("bronze").count() == 3
    assert run.table("bronze").columns == ["symbol", "price", "volume", "timestamp"]


def test_replay_reads_from_the_beginning(run, spark):
    run.send(tick("near", 1, 2.0))
    run.bronze()
    messages = sources.tick_stream(spark, "files", f"{run.base}/landed")
    checkpoint = streaming.replay_checkpoint(f"{run.base}/replays")
    assert checkpoint != streaming.replay_checkpoint(f"{run.base}/replays")
    streaming.run_bronze(messages, f"{run.base}/again", checkpoint)
    assert run.table("again").count() == 1


def test_silver_filters_and_types(run):
    run.send(tick("near", 1.25, 2.0), tick("near", 2, 0.0), tick("bitcoin", 1, 9_999.0),
             tick("bitcoin", 1, 10_000.0), "nonsense")
    got = run.silver()
    assert rows(got, "coin_id", "price_usd") == [("bitcoin", 10_000.0), ("near", 2.0)]
    assert got.columns == ["symbol", "price", "volume", "timestamp", "coin_id", "price_usd",
                           "volume_24h", "event_timestamp", "date", "hour", "ingested_at",
                           "ingestion_delay_seconds", "load_timestamp"]
    assert {r.status for r in quality.stream_silver_checks(got).collect()} == {"pass"}


def test_ticks_of_the_future_go(run):
    run.send(tick("near", 1, 2.0), tick("near", 3, 2.0))
    got = run.silver(as_of=dt.datetime(2024, 1, 1, 0, 0, 2))
    assert rows(got, "timestamp") == [(EPOCH + 1000,)]


@pytest.mark.parametrize("options", [{}, {"watermark": "1 hour"}, {"collapse": True}])
def test_repeats_within_and_across_runs(run, options):
    run.send(tick("near", 1, 2.0), tick("near", 1, 2.0), tick("near", 1.5, 2.0), tick("stellar", 1, 2.0))
    assert run.silver(**options).count() == 3
    run.send(tick("near", 1, 2.0), tick("near", 2, 2.0))
    assert run.silver(**options).count() == 4


def test_collapse_keeps_one_of_each_key_per_task(spark):
    data = [(s, t, float(i)) for i, (s, t) in enumerate([("a", 1), ("a", 1), ("b", None), ("b", None),
                                                         (None, 2), (None, 2), ("a", 2)])]
    df = spark.createDataFrame(data, "symbol string, timestamp bigint, price double").coalesce(1)
    got = streaming.collapse_copies(df, ["symbol", "timestamp"])
    assert got.schema == df.schema
    assert rows(got, "price") == [(0.0,), (2.0,), (4.0,), (6.0,)]
    many = df.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(25_000)))).drop("n")
    assert streaming.collapse_copies(many, ["symbol", "timestamp"]).count() < 100


FIRST = [tick("a", 0, 1.0), tick("a", 5, 2.0), tick("b", 5, 9.0)]
SECOND = [tick("a", 10, 6.0), tick("b", 10, 1.0)]


def test_append_mode_sees_one_batch_at_a_time(run, spark):
    for messages in (FIRST, SECOND):
        run.send(*messages)
        root = run.gold("append")
    assert streaming.read_snapshot(spark, root).count() == 4
    perf = streaming.read_performance(spark, root)
    assert rows(perf.filter("coin_id = 'a'"), "price_usd", "moving_avg_price") == [
        (1.0, 1.0), (2.0, 1.5), (6.0, 6.0)]
    daily = streaming.read_daily_trends(spark, root)
    assert rows(daily.filter("coin_id = 'a'"), "daily_avg_price", "record_count") == [(1.5, 2), (6.0, 1)]


def check_merged(run, spark, root):
    """The merged tables equal the batch tables of all silver rows."""
    silver = run.table("silver")
    order = ("event_timestamp", "timestamp")
    assert rows(streaming.read_snapshot(spark, root, "merge")) == rows(gold.latest_snapshot(silver, order))
    columns = ["coin_id", "event_timestamp", "price_usd", "volume_24h", "moving_avg_price",
               "price_volatility", "market_cap_rank", "date"]
    assert rows(streaming.read_performance(spark, root, "merge"), *columns) == rows(
        gold.price_performance(silver, order, rank_by="price_usd"), *columns)
    columns = gold.daily_trends(silver).columns
    assert rows(streaming.read_daily_trends(spark, root, "merge"), *columns) == rows(
        gold.daily_trends(silver), *columns)


def test_merge_mode_equals_the_batch_result(run, spark):
    step = 0
    for size in (1, 9, 4):
        messages = []
        for _ in range(size):
            # half-hour steps, so the series cross hours and days between runs
            messages += [tick("a", 1800 * step, 1.0 + step * step), tick("b", 1800 * step, 50.0 - step)]
            if step % 3 == 0:
                messages.append(tick("rare", 1800 * step, 7.0 + step))
            step += 1
        run.send(*messages)
        root = run.gold("merge")
    assert streaming.read_snapshot(spark, root, "merge").count() == 3
    check_merged(run, spark, root)


def test_moment_split_over_batches_is_ranked_whole(run, spark):
    run.send(tick("a", 5, 1.0))
    run.gold("merge")
    run.send(tick("b", 5, 2.0))
    root = run.gold("merge")
    assert rows(streaming.read_performance(spark, root, "merge"), "coin_id", "market_cap_rank") == [
        ("a", 2), ("b", 1)]


def test_late_tick_does_not_replace_the_snapshot(run, spark):
    run.send(tick("a", 100, 1.0))
    run.gold("merge")
    run.send(tick("a", 50, 2.0))
    root = run.gold("merge")
    assert rows(streaming.read_snapshot(spark, root, "merge"), "price_usd") == [(1.0,)]
    assert rows(streaming.read_performance(spark, root, "merge"), "price_usd", "moving_avg_price") == [
        (1.0, 1.5), (2.0, 2.0)]
    check_merged(run, spark, root)


def test_late_ticks_revise_the_windows_after_them(run, spark):
    run.send(*[tick("a", 3600 * i, float(i)) for i in range(20, 30)], tick("b", 3600 * 25, 5.0))
    run.gold("merge")
    run.send(tick("a", 3600 * 5, 15.0), tick("a", 3600 * 22 + 60, 100.0), tick("b", 3600 * 26, 6.0), tick("c", 60, 1.0))
    run.gold("merge")
    run.send(tick("a", 3600 * 40, 1.0), tick("a", 3600 * 21 + 5, 7.0))
    check_merged(run, spark, run.gold("merge"))


def test_replay_does_not_double(run, spark):
    run.send(*FIRST)
    root = run.gold("merge")
    run.send(*SECOND)
    root = run.gold("merge")
    again = run.source("silver")
    with pytest.raises(Exception, match="another query's tables"):
        streaming.gold_fanout(again, root, f"{run.base}/replay", mode="merge")
    streaming.gold_fanout(again, root, f"{run.base}/replay2", mode="merge", replace=True)
    check_merged(run, spark, root)
    assert streaming.read_daily_trends(spark, root, "merge").agg(F.sum("record_count")).first()[0] == 5


def test_rows_behind_the_watermark_are_counted(run, spark):
    run.send(tick("a", 0, 1.0), tick("a", 86400, 2.0))
    run.silver(watermark="1 hour")
    run.send(tick("a", 86500, 2.5))
    run.silver(watermark="1 hour")
    run.send(tick("b", 5, 3.0), tick("a", 86600, 4.0))
    source = run.source("bronze") if os.path.exists(f"{run.base}/bronze") else None
    assert source is not None
    kept = run.silver(watermark="1 hour").count()
    assert kept == 4  # the late tick of b is gone, unique as it is
    assert run.silver(watermark="1 hour").count() == kept


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("watermark", [None, "1 hour"])
def test_stream_days_are_days_of_the_session_zone(run, spark, zone, watermark):
    run.send(tick("a", 0, 1.0), tick("a", 12 * 3600, 3.0), tick("a", 5 * 86400, 5.0))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        run.silver()
        totals = streaming.daily_trends_stream(run.source("silver"), watermark=watermark)
        out = f"{run.base}/zone"
        (totals.writeStream.outputMode("append" if watermark else "complete")
         .foreachBatch(lambda b, n: b.write.mode("append").parquet(out) if watermark else b.write.mode("overwrite").parquet(out))
         .option("checkpointLocation", f"{out}_c").trigger(availableNow=True).start().awaitTermination())
        expected = gold.daily_trends(run.table("silver").withColumn("date", F.to_date("event_timestamp")))
        last = expected.agg(F.max("date")).first()[0]
        got, expected = rows(spark.read.parquet(out), "date", "record_count"), rows(expected, "date", "record_count")
        assert got == [r for r in expected if not watermark or r[0] < last]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_repeated_batch_changes_nothing(run, spark, mode):
    for messages in (FIRST, SECOND):
        run.send(*messages)
        silver = run.silver()
    root = f"{run.base}/direct"
    handle = process_batch(root, mode)
    parts = [silver.filter(F.col("timestamp") <= EPOCH + 5000),
             silver.filter(F.col("timestamp") > EPOCH + 5000)]
    for batch_id in (0, 1, 1):
        handle(parts[batch_id], batch_id)
    assert streaming.read_performance(spark, root, mode).count() == 5
    assert streaming.read_daily_trends(spark, root, mode).agg(F.sum("record_count")).first()[0] == 5
    if mode == "merge":
        check_merged(run, spark, root)


def test_empty_batch_writes_nothing(run, spark):
    run.send(*FIRST)
    handle = process_batch(f"{run.base}/direct", "append")
    handle(run.silver().filter("false"), 0)
    assert not os.path.exists(f"{run.base}/direct")
    with pytest.raises(ValueError):
        process_batch("x", "other")


def test_daily_aggregate_with_watermark_appends_closed_days(run, spark):
    run.send(tick("a", 0, 1.0), tick("a", 60, 3.0), tick("a", 3 * 86400, 5.0))
    run.silver()
    totals = streaming.daily_trends_stream(run.source("silver"), watermark="1 hour")
    sinks.append_stream(totals, f"{run.base}/daily", f"{run.base}/c_daily")
    assert rows(run.table("daily"), "date", "daily_avg_price", "record_count") == [
        (dt.date(2024, 1, 1), 2.0, 2)]


def test_stream_can_be_watched(run):
    run.send(*FIRST)
    messages = sources.tick_stream(run.spark, "files", f"{run.base}/landed")
    query = sinks.append_stream(streaming.bronze_stream(messages), f"{run.base}/t", f"{run.base}/c",
                                wait=False)
    query.awaitTermination(60)
    assert query.exception() is None and run.table("t").count() == 3


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_a_batch_is_kept_by_the_columns_of_gold_alone(run, spark, mode):
    run.send(*FIRST)
    unread = run.silver().withColumn("unread", F.raise_error(F.lit("read")).cast("string"))
    root = f"{run.base}/direct"
    process_batch(root, mode)(unread, 0)
    assert streaming.read_performance(spark, root, mode).count() == 3


def test_silver_spares_the_count_of_its_state(run, spark):
    run.send(*FIRST, *FIRST)
    run.bronze()
    query = streaming.run_silver(run.source("bronze"), f"{run.base}/silver", f"{run.base}/c_silver", as_of=AS_OF)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(held) == 0 and run.table("silver").count() == 3
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", None) is None
