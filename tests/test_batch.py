import datetime as dt
import json
import os

import pytest
from conftest import rows

from tickline import sources
from tickline.operators import gold, quality
from tickline.plans import batch
from tickline.plans.batch import Tables, build_silver, run_batch, run_increment
from tickline.schemas import INSTRUMENTS, snapshot_schema

AS_OF = dt.datetime(2024, 1, 1, 2, 10)
EPOCH = 1704067200


def document(run):
    """The run-th half-hourly snapshot; doge stops being listed after two."""
    quotes = {c: {"usd": 20_000.0 + run if c == "bitcoin" else 1.0 + run * i,
                  "usd_market_cap": 1e9 / (i + 1), "usd_24h_vol": 5.0,
                  "last_updated_at": EPOCH + 1800 * run}
              for i, c in enumerate(INSTRUMENTS) if c != "dogecoin" or run < 2}
    stamp = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=1800 * run + 60)
    return {**quotes, "ingestion_metadata": {"source": "test", "ingested_at": stamp.isoformat(),
                                             "coins": ",".join(INSTRUMENTS), "currency": "usd"}}


@pytest.fixture
def tables(tmp_path):
    found = Tables(str(tmp_path / "lake"))
    os.makedirs(found.bronze)
    for run in range(5):
        with open(f"{found.bronze}/batch_{run}.json", "w") as out:
            json.dump(document(run), out, indent=4)
    return found


def test_run_batch(spark, tables):
    results = {r["check"]: r for r in run_batch(spark, tables, as_of=AS_OF).collect()}
    assert results["corrupt_json"].status == "pass"
    assert (results["null_price dogecoin"].status, results["null_price dogecoin"].metric) == ("fail", 3.0)
    assert results["freshness_minutes"].metric == 10.0
    assert results["out_of_sync"].status == "pass"

    silver = sources.read_table(spark, tables.silver)
    assert silver.count() == 5 * 15 - 3
    assert set(silver.columns) == {
        "coin_id", "price_usd", "market_cap", "volume_24h", "api_last_updated_at", "ingested_at",
        "event_timestamp", "date", "hour", "ingestion_delay_seconds", "price_change_flag",
        "load_timestamp"}
    assert rows(silver.filter("coin_id = 'bitcoin'"), "hour", "price_change_flag") == [
        (0, "STABLE"), (0, "UP"), (1, "UP"), (1, "UP"), (2, "UP")]
    assert rows(silver.select("ingestion_delay_seconds").distinct()) == [(60,)]
    assert sources.read_table(spark, tables.snapshot).count() == 15
    assert sources.read_table(spark, tables.performance).count() == silver.count()
    assert rows(sources.read_table(spark, tables.daily), "coin_id", "record_count")[3:6] == [
        ("chainlink", 5), ("dogecoin", 2), ("ethereum", 5)]


def test_second_run_rebuilds_the_same_tables(spark, tables):
    run_batch(spark, tables, as_of=AS_OF)
    before = rows(sources.read_table(spark, tables.performance))
    with open(f"{tables.bronze}/batch_again.json", "w") as out:
        json.dump(document(3), out, indent=4)
    run_batch(spark, tables, as_of=AS_OF)
    assert rows(sources.read_table(spark, tables.performance)) == before


def test_corrupt_document_stops_the_run_before_silver(spark, tables):
    with open(f"{tables.bronze}/batch_cut.json", "w") as out:
        out.write(json.dumps(document(9), indent=4)[:200])
    with pytest.raises(quality.QualityError, match="corrupt_json"):
        run_batch(spark, tables, as_of=AS_OF)
    assert not os.path.exists(tables.silver)


def test_chosen_check_stops_the_run_before_gold(spark, tables):
    with pytest.raises(quality.QualityError, match="freshness_minutes"):
        run_batch(spark, tables, as_of=dt.datetime(2024, 1, 2), fatal=["freshness_minutes"])
    assert os.path.exists(tables.silver) and not os.path.exists(tables.performance)


def test_build_silver_matches_gold_invariants(spark, tables):
    silver = build_silver(sources.read_snapshots(spark, tables.bronze), as_of=AS_OF)
    assert quality.duplicate_keys(silver).isEmpty()
    ranks = gold.price_performance(silver)
    assert quality.rank_duplicates(ranks).isEmpty()
    daily = gold.daily_trends(silver)
    assert daily.filter("daily_min_price > daily_avg_price OR daily_avg_price > daily_max_price").isEmpty()


def write(path, number, body):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/batch_{number}.json", "w") as out:
        json.dump(body, out, indent=4)


@pytest.mark.parametrize("new", [[60, 61], [47, 49, 3], [100]])
def test_increment_equals_rebuild(spark, tmp_path, new):
    """Later days, a gap that is filled, an old moment quoted again, a long pause."""
    kept = [n for n in range(60) if n not in new]
    parts, whole = Tables(str(tmp_path / "parts")), Tables(str(tmp_path / "whole"))
    for n in kept:
        write(parts.bronze, n, document(n))
        write(whole.bronze, n, document(n))
    again = document(50)
    again["bitcoin"]["usd"] = 11_111.0
    again["ingestion_metadata"]["ingested_at"] = "2024-01-05T00:00:00"
    for n, body in [*((n, document(n)) for n in new), (999, again)]:
        write(f"{parts.root}/new", n, body)
        write(whole.bronze, n, body)
    run_batch(spark, parts, as_of=AS_OF)
    results = run_increment(spark, parts, f"{parts.root}/new", as_of=AS_OF)
    failed = results.filter("status = 'fail' AND severity IN ('error', 'fatal')")
    assert rows(failed, "check") == []
    assert rows(results.filter("check = 'missing_in_one_table'"), "status") == [("pass",)]
    run_batch(spark, whole, as_of=AS_OF)
    for name in ("silver", "snapshot", "performance", "daily"):
        got = sources.read_table(spark, getattr(parts, name))
        expected = sources.read_table(spark, getattr(whole, name))
        columns = sorted(expected.columns)
        assert rows(got, *columns) == rows(expected, *columns), name


def test_increment_without_prices_changes_nothing(spark, tables):
    run_batch(spark, tables, as_of=AS_OF)
    before = rows(sources.read_table(spark, tables.silver))
    empty = {c: {} for c in INSTRUMENTS} | {"ingestion_metadata": {"ingested_at": "2024-01-01T00:00:00"}}
    write(f"{tables.root}/new", 0, empty)
    run_increment(spark, tables, f"{tables.root}/new", as_of=AS_OF)
    assert rows(sources.read_table(spark, tables.silver)) == before


def test_json_lines_are_read_by_their_landed_layout(spark, tmp_path):
    """Ten documents in one file: none is lost with the default arguments."""
    lake = Tables(str(tmp_path))
    lines = spark.createDataFrame([(json.dumps(document(n)),) for n in range(10)], "value string").coalesce(1)
    schema = snapshot_schema(INSTRUMENTS)
    landed = spark.read.schema(schema).json(lines.rdd.map(lambda r: r.value)).drop("_corrupt_record")
    sources.land_snapshots(landed.coalesce(1), lake.bronze)
    run_batch(spark, lake, as_of=AS_OF)
    assert sources.read_table(spark, lake.silver).count() == 10 * 14 + 2


def test_documents_behind_others_stop_the_run(spark, tmp_path):
    lake = Tables(str(tmp_path))
    os.makedirs(lake.bronze)
    with open(f"{lake.bronze}/foreign.json", "w") as out:
        out.write("\n".join(json.dumps(document(n)) for n in range(10)))
    with pytest.raises(ValueError, match="9 documents"):
        run_batch(spark, lake, as_of=AS_OF, fatal=[])
    run_batch(spark, lake, as_of=AS_OF, multi_line=False)
    assert sources.read_table(spark, lake.silver).count() == 10 * 14 + 2


def test_increment_of_undated_quotes_equals_rebuild(spark, tmp_path):
    parts, whole = Tables(str(tmp_path / "parts")), Tables(str(tmp_path / "whole"))
    undated = document(7)
    for quote in list(undated.values())[:-1]:
        quote["last_updated_at"] = None
    for lake in (parts, whole):
        write(lake.bronze, 0, document(0))
    write(f"{parts.root}/new", 1, undated)
    write(whole.bronze, 1, undated)
    run_batch(spark, parts, as_of=AS_OF)
    run_increment(spark, parts, f"{parts.root}/new", as_of=AS_OF, fatal=[])
    run_batch(spark, whole, as_of=AS_OF, fatal=[])
    for name in ("silver", "performance", "daily"):
        got, expected = (sources.read_table(spark, getattr(lake, name)) for lake in (parts, whole))
        assert rows(got, *sorted(expected.columns)) == rows(expected, *sorted(expected.columns)), name
    assert sources.read_table(spark, parts.silver).filter("date IS NULL").count() == 14


def files(path):
    return {f for d, _, names in os.walk(path) for n in names if n.endswith(".parquet") for f in [f"{d}/{n}"]}


def test_stale_quote_leaves_other_days_alone(spark, tmp_path):
    lake = Tables(str(tmp_path))
    for n in range(0, 48 * 12, 16):
        write(lake.bronze, n, document(n))
    run_batch(spark, lake, as_of=AS_OF)
    kept = {name: files(getattr(lake, name)) for name in ("silver", "performance", "daily")}
    stale = document(48 * 12)
    stale["dogecoin"] = {"usd": 1.0, "usd_market_cap": 1.0,
                         "usd_24h_vol": 5.0, "last_updated_at": EPOCH}
    write(f"{lake.root}/new", 0, stale)
    run_increment(spark, lake, f"{lake.root}/new", as_of=AS_OF)
    for name, before in kept.items():
        rewritten = {os.path.basename(os.path.dirname(f)) for f in before - files(getattr(lake, name))}
        assert rewritten <= {"date=2024-01-01", "date=2024-01-02"}, (name, rewritten)
    # The same document once more holds no news at all.
    now = files(lake.silver)
    write(f"{lake.root}/again", 0, stale)
    run_increment(spark, lake, f"{lake.root}/again", as_of=AS_OF)
    assert files(lake.silver) == now


def test_increment_takes_the_types_of_the_table(spark, tables):
    run_batch(spark, tables, as_of=AS_OF)
    silver = sources.read_table(spark, tables.silver)
    other = silver.withColumn("ingestion_delay_seconds", silver.ingestion_delay_seconds.cast("double"))
    other.write.partitionBy("date").parquet(f"{tables.root}/other")
    moved = Tables(f"{tables.root}/moved")
    overwrite = sources.read_table(spark, f"{tables.root}/other")
    overwrite.write.partitionBy("date").parquet(moved.silver)
    for name in ("performance", "daily"):
        sources.read_table(spark, getattr(tables, name)).write.partitionBy("date").parquet(getattr(moved, name))
    write(f"{tables.root}/new", 0, document(8))
    run_increment(spark, moved, f"{tables.root}/new", as_of=AS_OF)
    got = sources.read_table(spark, moved.silver)
    assert dict(got.dtypes)["ingestion_delay_seconds"] == "double"
    assert got.count() == silver.count() + 14


class Follow(Tables):
    """Gold tables of their own over another lake's silver."""

    def __init__(self, own, silver):
        super().__init__(own.root)
        object.__setattr__(self, "_silver", silver)

    @property
    def silver(self):
        return self._silver


def test_gold_follows_silver_through_increments(spark, tmp_path):
    """A stream over silver that runs and increments rewrite: gold equals gold of the last state."""
    lake, followed = Tables(str(tmp_path / "lake")), Tables(str(tmp_path / "followed"))
    days = [list(range(0, 200, 9)), [300, 310, 4], [95, 96, 700], [701]]
    for part, moments in enumerate(days):
        for n in moments:
            write(f"{lake.root}/new{part}" if part else lake.bronze, n, document(n))
        if part:
            run_increment(spark, lake, f"{lake.root}/new{part}", as_of=AS_OF, fatal=[])
        else:
            run_batch(spark, lake, as_of=AS_OF, fatal=[])
        seen = files(followed.performance) if part else set()
        follow = Follow(followed, lake.silver)
        batch.follow_silver(spark, follow, str(tmp_path / "checkpoint"))
        if part == 3:  # one new moment at the end: only its day is written
            gone = {os.path.basename(os.path.dirname(f)) for f in seen - files(followed.performance)}
            assert len(gone) <= 1
        prices = sources.read_table(spark, lake.silver)
        for name, expected in (("snapshot", gold.latest_snapshot(prices)), ("performance", gold.price_performance(prices)),
                               ("daily", gold.daily_trends(prices))):
            got = sources.read_table(spark, getattr(followed, name))
            assert rows(got, *sorted(expected.columns)) == rows(expected, *sorted(expected.columns)), (part, name)


def test_increment_reads_only_days_around_the_news(spark, tmp_path, monkeypatch):
    lake = Tables(str(tmp_path))
    for n in range(0, 48 * 30, 12):
        write(lake.bronze, n, document(n))
    run_batch(spark, lake, as_of=AS_OF, fatal=[])
    seen = []
    find = batch.nearby

    def watched(stored, marks, *options):
        near, placed = find(stored, marks, *options)
        seen.append(near.select("date").distinct().count())
        return near, placed

    monkeypatch.setattr(batch, "nearby", watched)
    write(f"{lake.root}/new", 0, document(48 * 3 + 5))
    run_increment(spark, lake, f"{lake.root}/new", as_of=AS_OF, fatal=[])
    assert seen and max(seen) <= 10  # of 30 days, for a news row and six rows on either side
