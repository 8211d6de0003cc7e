"""Bucketed upserts, commits over several tables, folds, and bounded revision of late ticks."""

import datetime as dt
import glob
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streaming import EPOCH, Run, check_merged, tick

from tickline import sinks, sources, streaming
from tickline.operators import quality, reports
from tickline.operators.nearby import SEGMENT, nearby
from tickline.sinks import commits
from tickline.streaming import gold as stream_gold
from tickline.streaming.gold import process_batch

KEYED = "k long, t long, v string"


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path / "run")


def upsert(df, path, **options):
    return sinks.upsert_buckets(df, path, ["k"], ["t"], **options)


def parquet_files(path):
    return set(glob.glob(f"{path}/**/*.parquet", recursive=True))


# -- buckets -----------------------------------------------------------------

def test_upsert_rewrites_only_buckets_with_new_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sinks.read_buckets(spark, path) is None
    first = spark.range(20_000).selectExpr("id AS k", "1L AS t", "'old' AS v")
    assert upsert(first, path, buckets=100) == 0
    before = parquet_files(path)
    changed = spark.createDataFrame([(k, 2, "new") for k in (5, 77, 20_001)], KEYED)
    assert upsert(changed, path) == 1
    added = parquet_files(path) - before
    assert 1 <= len({os.path.dirname(f) for f in added}) <= 3  # of 100 buckets
    got = sinks.read_buckets(spark, path)
    assert got.count() == 20_001 and set(rows(got.filter("v = 'new'"), "k")) == {(5,), (77,), (20_001,)}
    held = sinks.buckets.manifest(spark, path)
    assert sum("v000000000000" in f for f in held.folders.values()) >= 97


def test_upsert_keeps_the_greatest_and_the_new_one_of_ties(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert(spark.createDataFrame([(1, 5, "a"), (1, 4, "b"), (2, 1, "c"), (None, 1, "n")], KEYED), path, buckets=4)
    upsert(spark.createDataFrame([(1, 4, "late"), (2, 1, "tie"), (None, 2, "m")], KEYED), path)
    assert rows(sinks.read_buckets(spark, path)) == sorted([(1, 5, "a"), (2, 1, "tie"), (None, 2, "m")], key=repr)
    wider = spark.createDataFrame([(2, 3, "w", 0.5)], KEYED + ", x double")
    upsert(wider, path)
    assert rows(sinks.read_buckets(spark, path), "k", "v", "x") == sorted([(1, "a", None), (2, "w", 0.5), (None, "m", None)], key=repr)
    with pytest.raises(ValueError):
        sinks.upsert_buckets(wider, path, ["v"], ["t"])


def test_upsert_retry_gives_the_same_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert(spark.createDataFrame([(k, 1, "a") for k in range(50)], KEYED), path, version=0, buckets=8)
    batch = spark.createDataFrame([(3, 2, "b"), (99, 2, "b")], KEYED)
    for _ in range(2):
        upsert(batch, path, version=1)
    assert sinks.buckets.versions(spark, path) == [1, 0]
    assert sinks.read_buckets(spark, path).count() == 51
    assert sinks.read_buckets(spark, path, below=1).count() == 50
    os.rename(f"{path}/_manifest/v000000000001.json", f"{path}/lost")  # as if the attempt had died before its manifest
    assert rows(sinks.read_buckets(spark, path).filter("k = 3"), "v") == [("a",)]
    upsert(batch, path, version=1)
    assert rows(sinks.read_buckets(spark, path).filter("k = 3"), "v") == [("b",)]


def test_empty_upserts_pruning_and_another_number_of_buckets(spark, tmp_path):
    path = f"{tmp_path}/t"
    none = spark.createDataFrame([], KEYED)
    upsert(none, path, buckets=8)
    assert sinks.read_buckets(spark, path).count() == 0
    for t in range(1, 5):
        upsert(spark.createDataFrame([(k, t, str(t)) for k in range(0, 200, t)], KEYED), path)
    expected = rows(sinks.read_buckets(spark, path))
    gone = sinks.prune_buckets(spark, path, keep=1)
    assert gone and rows(sinks.read_buckets(spark, path)) == expected
    assert len(sinks.buckets.versions(spark, path)) == 1
    sinks.rebucket(spark, path, 3)
    assert rows(sinks.read_buckets(spark, path)) == expected
    assert sinks.buckets.manifest(spark, path).buckets == 3
    wanted = sinks.read_buckets(spark, path, only_keys=[(4,), (1000,)])
    assert rows(wanted, "k") == [(4,)]
    upsert(spark.createDataFrame([(4, 9, "z")], KEYED), path)
    assert rows(sinks.read_buckets(spark, path).filter("k = 4"), "v") == [("z",)]


def test_daily_trends_in_update_mode_write_what_changed(run, spark):
    run.send(*[tick("a", 86400 * d, 1.0 + d) for d in range(30)])
    path, checkpoint = f"{run.base}/daily", f"{run.base}/c_daily"
    run.silver()
    streaming.daily_trends_upsert(run.source("silver"), path, checkpoint)
    before = parquet_files(f"{path}/data")
    run.send(tick("a", 86400 * 4 + 60, 9.0), tick("b", 86400 * 7, 2.0))
    run.silver()
    streaming.daily_trends_upsert(run.source("silver"), path, checkpoint)
    assert len({os.path.dirname(f) for f in parquet_files(f"{path}/data") - before}) <= 2
    expected = stream_gold.gold.daily_trends(run.table("silver"))
    assert rows(sinks.read_buckets(spark, path), *expected.columns) == rows(expected, *expected.columns)


# -- one commit for three tables ----------------------------------------------

@pytest.mark.parametrize("mode", ["append", "merge"])
def test_tables_of_a_batch_appear_together(run, spark, mode, monkeypatch):
    run.send(tick("a", 0, 1.0), tick("a", 60, 2.0), tick("b", 0, 5.0))
    silver = run.silver()
    root = f"{run.base}/direct"
    handle = process_batch(root, mode)
    handle(silver.filter("coin_id = 'a'"), 0)

    def seen():
        return [rows(read(spark, root, mode)) for read in
                (streaming.read_snapshot, streaming.read_performance, streaming.read_daily_trends)]

    before, during = seen(), []
    write = stream_gold.write_batch_idempotent

    def watched(df, path, batch_id, partition_by=()):
        write(df, path, batch_id, partition_by)
        during.append(seen())

    monkeypatch.setattr(stream_gold, "write_batch_idempotent", watched)
    handle(silver.filter("coin_id = 'b'"), 1)
    assert len(during) >= 2 and all(s == before for s in during)
    after = seen()
    assert all(len(a) > len(b) for a, b in zip(after, before, strict=True))
    handle(silver.filter("coin_id = 'b'"), 1)  # retried after its commit: nothing is written again
    assert seen() == after and len(during) == {"append": 3, "merge": 2}[mode]


def test_a_batch_that_dies_before_its_commit_is_not_seen(run, spark, monkeypatch):
    run.send(tick("a", 0, 1.0), tick("a", 60, 2.0))
    silver = run.silver()
    root = f"{run.base}/direct"
    handle = process_batch(root, "merge")
    parts = [silver.filter(f"timestamp {op} {EPOCH + 100}") for op in ("<", ">=")]
    handle(parts[0].limit(1), 0)
    before = rows(streaming.read_performance(spark, root, "merge"))

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(commits, "commit", dies)
    with pytest.raises(RuntimeError):
        handle(silver, 1)
    assert rows(streaming.read_performance(spark, root, "merge")) == before
    monkeypatch.undo()
    rest = silver.exceptAll(parts[0].limit(1))
    handle(rest, 1)
    check_merged(run, spark, root)


# -- folds ----------------------------------------------------------------------

@pytest.mark.parametrize("mode", ["append", "merge"])
def test_folds_keep_the_tables_and_bound_what_is_read(run, spark, mode):
    def read():
        return [rows(streaming.read_snapshot(spark, root, mode)), rows(streaming.read_performance(spark, root, mode)),
                rows(streaming.read_daily_trends(spark, root, mode))]

    hours = iter(range(0, 400, 7))
    for k in range(6):
        run.send(*[tick(c, 3600 * h, 1.0 + h % 5) for h in [next(hours), next(hours)] for c in ("a", "b")],
                 tick("a", 3600 * k + 1800, 3.0),  # and a late one
                 *([tick("z", 86400 * 20, 4.0)] if not k else []))
        root = run.gold(mode)
        if k in (2, 4):
            before = read()
            assert streaming.fold_batches(spark, root, mode) == k
            assert read() == before
            held = commits.state(spark, root)
            assert not held.batches and all(len(set(f.values())) == len(f) for f in held.base.values())
            commits.drop_folded(spark, root, [stream_gold.PERFORMANCE, stream_gold.DAILY, stream_gold.SNAPSHOT])
            assert read() == before
            assert len(os.listdir(f"{root}/_commits")) <= 2 * 2  # a fold and its checksum file, no batches
    days = commits.state(spark, root).base[stream_gold.PERFORMANCE]
    assert len(set(f.split("/")[0] for f in days.values())) == 2  # days that the second fold left alone kept their folder
    assert streaming.fold_batches(spark, root, mode) == 5 and streaming.fold_batches(spark, root, mode) is None
    if mode == "merge":
        check_merged(run, spark, root)


# -- late ticks -------------------------------------------------------------------

def test_a_late_tick_rewrites_at_most_seven_rows_and_reads_few_days(run, spark):
    run.send(*[tick(c, 3600 * h, 1.0 + h % 7) for h in range(24 * 28) for c in ("a", "b")])
    root = run.gold("merge")
    run.send(tick("a", 3600 * 24 * 11 + 90, 50.0), tick("b", 3600 * 24 * 20 + 90, 60.0), tick("b", 3600 * 24 * 29, 2.0))
    run.gold("merge")
    written = spark.read.parquet(f"{root}/{stream_gold.PERFORMANCE}/batch_id=1")
    assert written.count() == 7 + 7 + 1
    check_merged(run, spark, root)

    stored = spark.read.parquet(f"{root}/{stream_gold.PERFORMANCE}")
    late = written.filter("coin_id = 'a'").limit(1)
    near, marks = nearby(stored, late, ["coin_id"], ["event_timestamp"], 6, 6)
    assert near.select("date").distinct().count() == 3 and marks.count() == 1
    text = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "date" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_nearby_grows_until_every_series_has_its_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    data = [("x", d, f"2024-01-{d:02d}") for d in range(1, 31)] + [("y", 3, "2024-01-03"), ("y", 29, "2024-01-29")]
    df = spark.createDataFrame(data, "coin_id string, at int, date string").withColumn("date", F.to_date("date"))
    sinks.overwrite_table(df, path, ["date"])
    stored = spark.read.parquet(path)
    marks = spark.createDataFrame([("x", 15, "2024-01-15")], "coin_id string, at int, date string").withColumn("date", F.to_date("date"))
    near, _ = nearby(stored, marks, ["coin_id"], ["at"], 3, 3)
    assert near.select("date").distinct().count() == 9
    lonely = spark.createDataFrame([("y", 15, "2024-01-15")], "coin_id string, at int, date string").withColumn("date", F.to_date("date"))
    near, placed = nearby(stored, lonely, ["coin_id"], ["at"], 1, 1)
    assert set(rows(near.filter("coin_id = 'y'"), "at")) == {(3,), (29,)}
    assert placed.select(SEGMENT).first()[0] == 0


# -- checks beside the write ---------------------------------------------------------

def test_measures_of_a_write_equal_those_of_a_scan(spark, tmp_path):
    import datetime as dt

    from tickline.operators import quality
    moment = dt.datetime(2024, 1, 1)
    data = [("bitcoin", moment + dt.timedelta(hours=h), float(h) if h % 5 else None, "UP" if h % 3 else None, h - 2) for h in range(60)]
    df = spark.createDataFrame(data, "coin_id string, event_timestamp timestamp, price_usd double, price_change_flag string, "
                                     "ingestion_delay_seconds long").withColumn("date", F.to_date("event_timestamp"))
    for name, written in (("all", df), ("none", df.limit(0))):
        measured = sinks.overwrite_table(written, f"{tmp_path}/{name}", ["date"], measures=quality.silver_measures())
        assert set(measured) == {"null_prices", "unknown_flags", "price_outliers", "negative_delay", "date_partitions", "latest_second"}
        stored = written if name == "none" else spark.read.parquet(f"{tmp_path}/{name}")
        as_of = moment + dt.timedelta(hours=70)
        from_write = quality.silver_checks(stored, as_of, measured=measured)
        assert rows(from_write) == rows(quality.silver_checks(stored, as_of))
        scans = [q._jdf.queryExecution().optimizedPlan().toString().count("parquet") for q in
                 (from_write, quality.silver_checks(stored, as_of))]
        assert scans[0] == scans[1] - 1 or name == "none"


def test_a_stream_reports_its_checks_by_micro_batch(run, spark):
    run.send(tick("near", 1, 2.0), tick("near", 2, 9.0), tick("near", 2, 9.0), tick("stellar", 2, 0.0))
    run.bronze()
    from test_streaming import AS_OF
    query = streaming.run_silver(run.source("bronze"), f"{run.base}/silver", f"{run.base}/c_silver", as_of=AS_OF,
                                 rules={"dear": F.col("price_usd") > 5, "nameless": F.col("symbol").isNull()})
    got = streaming.check_rows(query)
    assert rows(got.groupBy("check").agg(F.sum("metric"))) == sorted([("rows", 2), ("dear", 1), ("nameless", 0)], key=repr)


# -- ranks of folded days, newest days ------------------------------------------

def scanned(df):
    """Days in the paths of a plan's files."""
    return {part for file in df.inputFiles() for part in file.split("/") if part.startswith("date=")}


def test_folded_days_keep_their_ranks_until_a_batch_touches_them(run, spark):
    run.send(*[tick(c, 86400 * d + 60 * m, p + m) for d in range(6) for m in (0, 1) for c, p in (("a", 1.0), ("b", 2.0), ("c", 2.0))])
    root = run.gold("merge")
    unfolded = rows(streaming.read_performance(spark, root, "merge"))
    assert streaming.fold_batches(spark, root, "merge") == 0
    folded = streaming.read_performance(spark, root, "merge")
    assert "Window" not in folded._jdf.queryExecution().executedPlan().toString()
    assert rows(folded) == unfolded
    # Another column to rank by is ranked on reading.
    other = streaming.read_performance(spark, root, "merge", rank_by="volume_24h")
    assert "Window" in other._jdf.queryExecution().executedPlan().toString()

    run.send(tick("d", 86400 * 2, 9.0), tick("a", 86400 * 5 + 120, 4.0))  # late into the third day, on time in the last
    run.gold("merge")
    merged = streaming.read_performance(spark, root, "merge")
    top = merged._jdf.queryExecution().optimizedPlan()
    closed, opened = (top.children().apply(k).toString() for k in (0, 1))
    assert top.nodeName() == "Union" and "Window" not in closed and "Window" in opened
    late = merged.filter("coin_id = 'd'").select("event_timestamp")
    third = merged.join(late, "event_timestamp").collect()
    assert sorted((r.coin_id, r.market_cap_rank) for r in third) == [("a", 4), ("b", 2), ("c", 2), ("d", 1)]
    check_merged(run, spark, root)
    assert streaming.fold_batches(spark, root, "merge") == 1
    check_merged(run, spark, root)
    assert set(commits.state(spark, root).notes[stream_gold.PERFORMANCE].values()) == {"price_usd"}


@pytest.mark.parametrize("mode", ["merge", "append"])
def test_recent_rows_of_a_stream_read_the_last_days_only(run, spark, mode):
    run.send(*[tick(c, 3600 * h, 1.0 + h % 5) for h in range(24 * 8) for c in ("a", "b")])
    root = run.gold(mode)
    for _ in range(2):
        whole = reports.performance_recent(streaming.read_performance(spark, root, mode), 2, ("x", "y"))
        recent = streaming.recent_performance(spark, root, 2, mode, names=("x", "y"))
        assert rows(recent) == rows(whole) and recent.count() == 2 * 3
        assert len(scanned(whole)) == 8 and len(scanned(recent)) == 1
        streaming.fold_batches(spark, root, mode)
    nothing = streaming.read_performance(spark, root, mode, first_day=dt.date(2100, 1, 1))
    assert nothing.count() == 0 and nothing.columns == streaming.read_performance(spark, root, mode).columns


def test_newest_day_gives_the_freshness_of_the_table(spark, tmp_path):
    path = f"{tmp_path}/days"
    moments = spark.range(24 * 30).selectExpr("timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS event_timestamp")
    dated = moments.withColumn("date", F.to_date("event_timestamp"))
    odd = spark.sql("SELECT CAST(null AS timestamp) AS event_timestamp, d AS date FROM VALUES (DATE'2024-03-01'), (null) AS t(d)")
    sinks.overwrite_table(dated.unionByName(odd), path, ["date"])
    as_of = dt.datetime(2024, 1, 31)
    newest = sources.read_newest_day(spark, path)
    assert scanned(newest) == {"date=2024-01-30"}  # a later day holds no moment
    assert rows(quality.freshness(newest, as_of=as_of)) == rows(quality.freshness(sources.read_table(spark, path), as_of=as_of))
    empty = f"{tmp_path}/empty"
    sinks.overwrite_table(odd, empty, ["date"])
    assert [r.status for r in quality.freshness(sources.read_newest_day(spark, empty), as_of=as_of).collect()] == ["error"]
