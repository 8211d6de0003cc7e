"""Check state that merges over days, and comparison of tables by digests."""

import datetime as dt
import os
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_batch import AS_OF, document, files, write

from tickline import sources
from tickline.operators import daystate, digests, quality
from tickline.plans.batch import Tables, follow_checks, run_batch, run_increment

PRICED = "coin_id string, event_timestamp timestamp, date date, price_usd double, price_change_flag string, ingestion_delay_seconds long"


def table(spark, entries):
    made = [(c, t, t and t.date(), p, f, d) for c, t, p, f, d in entries]
    return spark.createDataFrame(made, PRICED)


def faulty(spark, at):
    day = 24 * 60
    return table(spark, [
        ("a", at(0), 1.0, "STABLE", 5), ("a", at(1), 1.5, "UP", 7), ("a", at(1), 1.5, "UP", 7), ("a", at(1), 1.5, "UP", 7),
        ("a", at(day), 3.0, "UP", -1), ("a", at(day + 1), None, "SIDEWAYS", None), ("a", at(day + 2), 3.0, None, 9),
        ("b", at(3), 2.0, "STABLE", 5), ("b", at(3), 2.0, "STABLE", 5), ("b", at(2 * day), -4.0, "DOWN", 5),
        ("b", None, 2.0, "STABLE", 1), ("b", None, 2.0, "STABLE", 1), (None, at(4), 2.0, "STABLE", 0)])


# -- check state ---------------------------------------------------------------

def test_state_checks_equal_checks_of_the_rows(spark, at):
    df, bounds = faulty(spark, at), {"b": (0.0, 10.0)}
    expected = rows(quality.silver_checks(df, AS_OF, bounds=bounds))
    assert rows(daystate.state_checks(daystate.day_state(df, bounds), AS_OF)) == expected
    found = {r[0]: r[3] for r in expected}
    assert found["duplicate_keys"] == 3 and found["price_jumps"] >= 2 and found["price_outliers"] == 1


def test_states_of_parts_merge_to_the_state_of_all(spark, at):
    df = faulty(spark, at).filter("event_timestamp IS NOT NULL")
    whole = daystate.day_state(df)
    first = dt.date(2024, 1, 2)
    parts = [daystate.day_state(df, within=F.col("date") < F.lit(first)), daystate.day_state(df, within=F.col("date") >= F.lit(first))]
    exact = [c for c in whole.columns if "sketch" not in c]
    assert rows(parts[0].unionByName(parts[1]), *exact) == rows(whole, *exact)
    by_coin = daystate.merge_state(parts[0].unionByName(parts[1]), ["coin_id"])
    assert rows(by_coin, "coin_id", "rows", "duplicate_keys") == rows(daystate.merge_state(whole, ["coin_id"]), "coin_id", "rows", "duplicate_keys")


def test_empty_table_has_no_state_and_reports_no_data(spark):
    state = daystate.day_state(table(spark, []))
    assert state.isEmpty()
    found = {r["check"]: r for r in daystate.state_checks(state, AS_OF).collect()}
    assert found["freshness_minutes"].status == "error" and found["duplicate_keys"].status == "pass"
    assert rows(daystate.state_checks(state, AS_OF)) == rows(quality.silver_checks(table(spark, []), AS_OF))


def test_sketches_keep_their_error_bounds(spark):
    """A skewed instrument holds nine tenths of the rows; days overlap in nothing."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("big").alias("coin_id"),
        F.timestamp_seconds(1704067200 + F.col("id") * 17).alias("event_timestamp"),
        F.to_date(F.timestamp_seconds(1704067200 + F.col("id") * 17)).alias("date"),
        F.lit(1.0).alias("price_usd"), F.lit("STABLE").alias("price_change_flag"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("ingestion_delay_seconds"))
    days = daystate.day_state(df)
    assert days.count() > 20
    got = {r.coin_id: r for r in daystate.delay_figures(days).collect()}
    exact = df.groupBy("coin_id").agg(F.count_distinct("event_timestamp").alias("moments"), F.avg("ingestion_delay_seconds").alias("mean"),
                                      F.max("ingestion_delay_seconds").alias("worst")).collect()
    for r in exact:
        found = got[r.coin_id]
        assert abs(found.distinct_moments - r.moments) <= 0.03 * r.moments
        assert (found.max_delay_secs, round(found.avg_delay_secs, 6)) == (r.worst, round(r["mean"], 6))
        delays = df.filter(F.col("coin_id") == r.coin_id)
        for quantile, value in ((0.5, found.delay_p50), (0.99, found.delay_p99)):
            below = delays.filter(F.col("ingestion_delay_seconds") <= value).count() / r.moments
            assert abs(below - quantile) <= 0.04


def test_increment_checks_from_changed_days_and_stored_state(spark, tmp_path):
    lake = Tables(str(tmp_path))
    for n in range(0, 48 * 12, 8):
        write(lake.bronze, n, document(n))
    run_batch(spark, lake, as_of=AS_OF, fatal=[])

    def same():
        expected = quality.silver_checks(sources.read_table(spark, lake.silver), AS_OF)
        assert rows(daystate.state_checks(follow_checks(spark, lake), AS_OF)) == rows(expected)
        return rows(expected)

    same()
    for part, moments in enumerate(([48 * 3 + 1], [48 * 11 + 47, 48 * 14], [48 * 3 + 1])):
        before = files(lake.state)
        for n in moments:
            write(f"{lake.root}/new{part}", n, document(n))
        results = run_increment(spark, lake, f"{lake.root}/new{part}", as_of=AS_OF, fatal=[])
        rewritten = {os.path.basename(os.path.dirname(f)) for f in before - files(lake.state)}
        assert len(rewritten) <= 2, rewritten
        expected = same()
        if part < 2:  # the last one holds no news
            checks = [r[0] for r in expected]
            assert rows(results.filter(F.col("check").isin(checks) & (F.col("check") != "duplicate_keys"))) == [
                r for r in expected if r[0] != "duplicate_keys"]
    # A rebuild from fewer documents: days that are gone leave the state too.
    other = Tables(str(tmp_path))
    for n in range(48 * 5, 48 * 15):
        path = f"{other.bronze}/batch_{n}.json"
        if os.path.exists(path):
            os.remove(path)
    run_batch(spark, other, as_of=AS_OF, fatal=[])
    same()


def test_state_reads_only_changed_days_and_those_before(spark, tmp_path, monkeypatch):
    from tickline.plans import batch
    lake = Tables(str(tmp_path))
    for n in range(0, 48 * 20, 12):
        write(lake.bronze, n, document(n))
    run_batch(spark, lake, as_of=AS_OF, fatal=[])
    follow_checks(spark, lake)
    write(f"{lake.root}/new", 0, document(48 * 9 + 5))
    run_increment(spark, lake, f"{lake.root}/new", as_of=AS_OF, fatal=[])
    seen, make = [], daystate.day_state

    def watched(df, *options, **named):
        seen.append(df.select("date").distinct().count())
        return make(df, *options, **named)

    monkeypatch.setattr(batch.daystate, "day_state", watched)
    write(f"{lake.root}/more", 0, document(48 * 4 + 5))
    run_increment(spark, lake, f"{lake.root}/more", as_of=AS_OF, fatal=[])
    assert seen and max(seen) <= 4  # of 20 days


# -- digests ---------------------------------------------------------------------

ROWS = "coin_id string, event_timestamp timestamp, date date, x double, y string"


def both(spark, at):
    day = 24 * 60
    left = [("a", at(m), at(m).date(), float(m), "s") for m in range(0, 6 * day, 60)]
    left += [("b", at(m), at(m).date(), None, None) for m in range(0, 6 * day, 90)]
    left += [(None, None, None, float("nan"), None)] * 2
    return left


def test_planted_differences_are_found(spark, at):
    left = both(spark, at)
    right = [r for r in left if r[:2] != ("a", at(60))]  # missing
    right = [(*r[:3], -0.0, "t") if r[:2] == ("a", at(0)) else r for r in right]  # 0.0 = -0.0, but another text
    right = [(*r[:4], "x") if r[:2] == ("b", at(90)) else r for r in right]
    right += [("b", at(180), at(180).date(), None, None)]  # once more
    right += [("c", at(5), at(5).date(), 1.0, "")]
    right.remove((None, None, None, left[-1][3], None))
    l, r = spark.createDataFrame(left, ROWS), spark.createDataFrame(right, ROWS)
    got = {(x.coin_id, x.event_timestamp): (x.left_only, x.right_only, x["columns"]) for x in digests.compare(l, r).collect()}
    assert got == {("a", at(60)): (1, 0, None), ("a", at(0)): (1, 1, ["y"]), ("b", at(90)): (1, 1, ["y"]),
                   ("b", at(180)): (0, 1, None), ("c", at(5)): (0, 1, None), (None, None): (1, 0, None)}
    assert digests.compare(l, spark.createDataFrame(left[::-1], ROWS)).isEmpty()
    empty = spark.createDataFrame([], ROWS)
    assert digests.compare(empty, empty).isEmpty()
    assert digests.compare(l, empty).agg(F.sum("left_only"), F.sum("right_only")).collect()[0][:] == (len(left), 0)


def test_nulls_in_different_columns_have_different_digests(spark):
    schema = "date date, coin_id string, x string, y string"
    one, two = ([(None, "a", *xy)] for xy in (("v", None), (None, "v")))
    left, right = (digests.digests(spark.createDataFrame(d, schema)) for d in (one, two))
    assert digests.differing(left, right).count() == 1


def test_digests_add_up(spark, at):
    df = spark.createDataFrame(both(spark, at), ROWS)
    by_group = digests.digests(df)
    assert rows(digests.merged(by_group, ["date"])) == rows(digests.digests(df, by=["date"]))
    assert rows(digests.merged(by_group)) == rows(digests.digests(df.repartition(7), by=[]))


def test_equal_days_are_not_read_again(spark, at, tmp_path):
    left = spark.createDataFrame([r for r in both(spark, at) if r[0]], ROWS)
    right = left.withColumn("x", F.when((F.col("coin_id") == "a") & (F.col("event_timestamp") == F.lit(at(60))), 5.5).otherwise(F.col("x")))
    stored = []
    for name, df in (("l", left), ("r", right)):
        df.write.partitionBy("date").parquet(f"{tmp_path}/{name}")
        stored.append(spark.read.parquet(f"{tmp_path}/{name}"))
    kept = [digests.digests(df, sorted(left.columns)) for df in stored]
    found = digests.compare(*stored, left_digests=kept[0], right_digests=kept[1])
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[[^\]]*date#\d+ = 2024-01-01", plan)
    assert len(scans) == 2, plan
    assert rows(found) == [("a", at(60), 1, 1, ["x"])]


@pytest.mark.parametrize("skew", [20_000])
def test_a_hot_group_is_compared_without_gathering_it(spark, skew):
    left = spark.range(skew).select(F.lit("hot").alias("coin_id"), F.timestamp_seconds(1704067200 + F.col("id") % 86400).alias("event_timestamp"),
                                    F.lit(dt.date(2024, 1, 1)).alias("date"), F.col("id").cast("double").alias("x"))
    right = left.filter("x <> 777")
    assert [tuple(r)[2:] for r in digests.compare(left, right).collect()] == [(1, 0, None)]
