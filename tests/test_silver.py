import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickline import sources
from tickline.operators import silver
from tickline.schemas import INSTRUMENTS, QUOTE


def quote(usd, cap=10.0, vol=5.0, at=1704067200):
    return {"usd": usd, "usd_market_cap": cap, "usd_24h_vol": vol, "last_updated_at": at}


def metadata(at="2024-01-01T00:01:00"):
    return {"source": "test", "ingested_at": at, "coins": "bitcoin", "currency": "usd"}


@pytest.fixture
def land(tmp_path):
    def write(*documents):
        for i, document in enumerate(documents):
            text = document if isinstance(document, str) else json.dumps(document, indent=4)
            (tmp_path / f"batch_{i}.json").write_text(text)
        return f"{tmp_path}/*.json"
    return write


def test_complete_document(spark, land):
    path = land({**{c: quote(1.0 + i) for i, c in enumerate(INSTRUMENTS)},
                 "ingestion_metadata": metadata()})
    got = silver.clean_snapshots(sources.read_snapshots(spark, path))
    assert got.columns == ["coin_id", "price_usd", "market_cap", "volume_24h",
                           "api_last_updated_at", "ingested_at", "event_timestamp", "date",
                           "hour", "ingestion_delay_seconds"]
    assert [r[0] for r in rows(got, "coin_id")] == sorted(INSTRUMENTS)
    row = got.filter("coin_id = 'shiba-inu'").first()
    assert row.price_usd == 9.0 and row.ingestion_delay_seconds == 60
    assert (row.date, row.hour) == (dt.date(2024, 1, 1), 0)


def test_absent_coin_absent_field_null_and_integer_price(spark, land):
    path = land({"bitcoin": {"usd": 5}, "near": quote(None), "ingestion_metadata": metadata()})
    got = silver.clean_snapshots(sources.read_snapshots(spark, path))
    assert rows(got, "coin_id", "price_usd", "market_cap") == [("bitcoin", 5.0, None)]


@pytest.mark.parametrize("infer", [True, False])
def test_inferred_and_fixed_schema_agree(spark, land, infer):
    """Fields absent from every file do not fail an inferred read."""
    path = land({"bitcoin": {"usd": 5}, "shiba-inu": quote(0.5)})
    raw = (spark.read.option("multiLine", True).json(path) if infer
           else sources.read_snapshots(spark, path))
    long = silver.clean_prices(silver.unpivot_snapshot(silver.normalise_snapshot(raw)))
    assert rows(long, "coin_id", "price_usd", "volume_24h", "ingested_at") == [
        ("bitcoin", 5.0, None, None), ("shiba-inu", 0.5, 5.0, None)]


def test_normalised_structs_are_uniform(spark, land):
    raw = sources.read_snapshots(spark, land({"bitcoin": {"usd": 5}}))
    wide = silver.normalise_snapshot(raw)
    assert wide.columns == ["ingested_at_str", *INSTRUMENTS]
    assert {f.dataType for f in wide.schema.fields[1:]} == {QUOTE}


def test_unpivot_has_a_row_per_document_and_coin(spark, land):
    raw = sources.read_snapshots(spark, land({"bitcoin": quote(1.0)}, {"near": quote(2.0)}))
    assert silver.unpivot_snapshot(silver.normalise_snapshot(raw)).count() == 2 * len(INSTRUMENTS)


def test_open_coin_list(spark, land):
    path = land({"brand.new": quote(3.0), "BitCoin": quote(4.0), "ingestion_metadata": metadata()})
    got = silver.clean_prices(silver.unpivot_documents(sources.read_snapshot_documents(spark, path)))
    assert rows(got, "coin_id", "price_usd", "ingested_at") == [
        ("bitcoin", 4.0, dt.datetime(2024, 1, 1, 0, 1)),
        ("brand.new", 3.0, dt.datetime(2024, 1, 1, 0, 1))]


def test_truncated_file_is_kept_as_corrupt(spark, land):
    raw = sources.read_snapshots(spark, land({"bitcoin": quote(1.0)}, '{"bitcoin": {"usd": 1'))
    assert raw.filter(F.col("bitcoin").isNull()).select("_corrupt_record").first()[0]


def test_later_ingested_document_wins(spark, land):
    path = land({"bitcoin": quote(1.0), "ingestion_metadata": metadata("2024-01-01T00:02:00")},
                {"bitcoin": quote(2.0), "ingestion_metadata": metadata("2024-01-01T00:09:00")},
                {"bitcoin": quote(3.0), "ingestion_metadata": metadata("")})
    got = silver.clean_snapshots(sources.read_snapshots(spark, path))
    assert rows(got, "price_usd", "ingestion_delay_seconds") == [(2.0, 540)]


def test_price_change_flag(spark, at):
    prices = [("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 2.0), ("a", 60 * 24 * 3, 1.0), ("b", 1, 9.0)]
    df = spark.createDataFrame([(c, at(m), p) for c, m, p in prices],
                               "coin_id string, event_timestamp timestamp, price_usd double")
    got = silver.add_price_change_flag(df).orderBy("coin_id", "event_timestamp")
    assert [r.price_change_flag for r in got.collect()] == ["STABLE", "UP", "STABLE", "DOWN", "STABLE"]


def test_stamp(spark):
    moment = dt.datetime(2024, 3, 1)
    assert silver.stamp(spark.range(1), moment).first().load_timestamp == moment


TICK_ROWS = [
    '{"symbol":"near","price":2.5,"volume":7,"timestamp":1704067200900}',
    '{"symbol":"bitcoin","price":9999,"volume":7,"timestamp":1704067200900}',
    '{"symbol":"bitcoin","price":10000,"volume":7,"timestamp":1704067200900}',
    '{"symbol":null,"price":1,"volume":7,"timestamp":1704067200900}',
    '{"symbol":"near","price":0,"volume":7,"timestamp":1704067200900}',
    '{"symbol":"near","price":-1,"volume":7,"timestamp":1704067200900}',
    '{"symbol":"near","volume":7,"timestamp":1704067200900}',
    'nonsense',
]


def ticks(spark):
    return silver.parse_ticks(spark.createDataFrame([(t,) for t in TICK_ROWS], "value string"))


def test_parse_ticks(spark):
    assert ticks(spark).columns == ["symbol", "price", "volume", "timestamp"]
    assert ticks(spark).filter(
        "symbol IS NULL AND price IS NULL AND volume IS NULL AND timestamp IS NULL").count() == 1
    binary = spark.createDataFrame([(TICK_ROWS[0].encode(),)], "value binary")
    assert silver.parse_ticks(binary).first().symbol == "near"


def test_valid_ticks_by_mapping_and_by_table(spark):
    expected = [("bitcoin", 10000.0), ("near", 2.5)]
    assert rows(silver.valid_ticks(ticks(spark)), "symbol", "price") == expected
    table = spark.createDataFrame([("bitcoin", 10000.0, 250000.0), ("other", 1.0, None)],
                                  "symbol string, low double, high double")
    got = silver.valid_ticks(ticks(spark), table)
    assert got.columns == ["symbol", "price", "volume", "timestamp"]
    assert rows(got, "symbol", "price") == expected


def test_clean_ticks(spark):
    moment = dt.datetime(2024, 1, 1, 0, 0, 5)
    row = silver.clean_ticks(ticks(spark).limit(1), as_of=moment).first()
    assert row.event_timestamp == dt.datetime(2024, 1, 1)
    assert (row.coin_id, row.price_usd, row.volume_24h, row.hour) == ("near", 2.5, 7.0, 0)
    assert row.ingestion_delay_seconds == 4 and row.ingested_at == moment
    exact = silver.clean_ticks(ticks(spark).limit(1), "milli", True, moment).first()
    assert exact.event_timestamp == dt.datetime(2024, 1, 1, 0, 0, 0, 900000)
    assert exact.ingestion_delay_seconds == pytest.approx(4.1)


def test_drop_negative_delay(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (None,)], "ingestion_delay_seconds bigint")
    assert rows(silver.drop_negative_delay(df)) == [(0,), (1,)]
