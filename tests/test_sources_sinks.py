import datetime as dt
import glob
import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickline import session, sinks, sources
from tickline.sinks.versions import write_version


def test_land_one_document_per_file(spark, tmp_path):
    df = spark.sql("SELECT named_struct('usd', CAST(id AS DOUBLE)) AS bitcoin FROM range(5)")
    moment = dt.datetime(2024, 1, 2, 3, 4, 5)
    target = sources.land_snapshots(df, str(tmp_path), as_of=moment, one_per_file=True)
    assert os.path.basename(target) == "batch_20240102_030405"
    written = [f for f in glob.glob(f"{target}/*.json") if os.path.getsize(f)]
    assert len(written) == 5
    raw = sources.read_snapshots(spark, f"{tmp_path}/*", ["bitcoin"])
    assert [r[0] for r in rows(raw, "bitcoin.usd")] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert raw.select("ingestion_metadata.*").distinct().first() == (
        "CoinGecko API", "2024-01-02T03:04:05", "bitcoin", "usd")


def test_land_json_lines(spark, tmp_path):
    df = spark.sql("SELECT named_struct('usd', 1.0D) AS near FROM range(5)").coalesce(1)
    target = sources.land_snapshots(df, str(tmp_path))
    assert os.path.basename(target).startswith("lines_")
    assert len(glob.glob(f"{target}/*.json")) == 1
    assert sources.read_snapshots(spark, target, ["near"]).count() == 5
    assert sources.hidden_documents(spark, target) == 0
    assert sources.hidden_documents(spark, target, multi_line=True) == 4


def test_landing_adds_to_what_is_there(spark, tmp_path):
    df = spark.sql("SELECT named_struct('usd', 1.0D) AS near")
    for minute in (1, 2):
        sources.land_snapshots(df, str(tmp_path), as_of=dt.datetime(2024, 1, 1, 0, minute))
    assert sources.read_snapshots(spark, f"{tmp_path}/*", ["near"]).count() == 2


def test_documents_as_text(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"near": {"usd": 1}}, indent=4))
    assert sources.read_snapshot_documents(spark, str(tmp_path)).count() == 1


def test_kafka_options():
    plain = sources.kafka_options("host:9092", "ticks")
    assert plain == {"kafka.bootstrap.servers": "host:9092", "subscribe": "ticks",
                     "startingOffsets": "earliest"}
    secured = sources.kafka_options("host:9092", "ticks", "me", "secret", maxOffsetsPerTrigger="10")
    assert secured["kafka.security.protocol"] == "SASL_SSL"
    assert secured["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="me" password="secret";' in secured["kafka.sasl.jaas.config"]
    assert secured["maxOffsetsPerTrigger"] == "10"


def test_kafka_source_is_asked_for(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.tick_stream(spark, "kafka", **sources.kafka_options("localhost:1", "ticks"))
    with pytest.raises(ValueError):
        sources.tick_stream(spark, "pigeon")


def test_catalog_tables(spark, tmp_path):
    sinks.ensure_schema(spark, "market")
    sinks.ensure_schema(spark, "market")
    df = spark.range(3)
    sinks.overwrite_table(df, table="market.managed")
    sinks.overwrite_table(df, table="market.managed")
    sinks.overwrite_table(df.withColumn("date", F.lit("d")), f"{tmp_path}/ext", ["date"], "market.ext")
    assert sources.read_table(spark, "market.managed").count() == 3
    assert sources.read_table(spark, "market.ext").count() == 3
    assert sources.read_table(spark, f"{tmp_path}/ext").count() == 3
    spark.sql("DROP SCHEMA market CASCADE")


def test_partitioned_write_gives_one_file_per_small_partition(spark, tmp_path):
    df = spark.range(1000).withColumn("date", F.col("id") % 5).repartition(8)
    sinks.overwrite_table(df, f"{tmp_path}/t", ["date"])
    assert len(glob.glob(f"{tmp_path}/t/date=*/*.parquet")) == 5


def test_overwrite_partitions_leaves_others(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.overwrite_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, date string"), path, ["date"])
    sinks.overwrite_partitions(spark.createDataFrame([(9, "b"), (8, "c")], "v int, date string"), path)
    assert rows(sources.read_table(spark, path)) == [(1, "a"), (8, "c"), (9, "b")]


def test_batch_write_is_idempotent(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, date string")
    for batch_id in (0, 1, 1, 0):
        sinks.write_batch_idempotent(df, path, batch_id, ["date"])
    assert sources.read_table(spark, path).count() == 4


def test_align_schema(spark):
    df = spark.sql("SELECT 1 AS delay, 'x' AS extra, 2 AS b")
    target = spark.sql("SELECT 2.0D AS b, 1.5D AS delay, 'n' AS note")
    assert sinks.align_schema(df, target).dtypes == [
        ("b", "double"), ("delay", "double"), ("note", "string")]
    merged = sinks.align_schema(df, target.schema, merge=True)
    assert merged.columns == ["b", "delay", "note", "extra"]
    assert merged.first() == (2.0, 1.0, None, "x")


def test_merge_schema_read(spark, tmp_path):
    spark.sql("SELECT 1 AS a").write.parquet(f"{tmp_path}/t/p=1")
    spark.sql("SELECT 2 AS a, 3 AS b").write.parquet(f"{tmp_path}/t/p=2")
    assert rows(sources.read_table(spark, f"{tmp_path}/t", True), "a", "b") == [(1, None), (2, 3)]


def snapshot(spark, *data):
    return spark.createDataFrame(data, "coin_id string, event_timestamp int, price_usd double")


def upsert(df, path, **options):
    return sinks.upsert(df, path, ["coin_id"], ["event_timestamp"], **options)


def test_upsert(spark, tmp_path):
    path = f"{tmp_path}/snap"
    assert sinks.read_current(spark, path) is None
    assert upsert(snapshot(spark, ("a", 1, 1.0), ("b", 5, 2.0)), path) == 0
    assert upsert(snapshot(spark, ("a", 2, 9.0), ("b", 4, 8.0), ("c", 1, 3.0)), path) == 1
    assert rows(sinks.read_current(spark, path)) == [("a", 2, 9.0), ("b", 5, 2.0), ("c", 1, 3.0)]
    upsert(snapshot(spark, ("a", 2, 7.0)), path)
    assert sinks.read_current(spark, path).filter("coin_id = 'a'").first().price_usd == 7.0


def test_upsert_retry_gives_the_same_version(spark, tmp_path):
    path = f"{tmp_path}/snap"
    upsert(snapshot(spark, ("a", 1, 1.0)), path, version=0)
    for _ in range(2):
        upsert(snapshot(spark, ("a", 2, 2.0), ("b", 1, 1.0)), path, version=1)
    assert sinks.current_version(spark, path) == 1
    assert rows(sinks.read_current(spark, path)) == [("a", 2, 2.0), ("b", 1, 1.0)]


def test_unfinished_version_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/snap"
    upsert(snapshot(spark, ("a", 1, 1.0)), path)
    write_version(snapshot(spark, ("a", 2, 2.0)), path, 1)
    os.remove(f"{path}/v000000000001/_COMMITTED")
    assert rows(sinks.read_current(spark, path)) == [("a", 1, 1.0)]
    assert upsert(snapshot(spark, ("a", 3, 3.0)), path) == 1
    assert rows(sinks.read_current(spark, path)) == [("a", 3, 3.0)]


def test_versions_do_not_need_the_success_file(spark, tmp_path):
    path, conf = str(tmp_path / "t"), spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        upsert(snapshot(spark, ("a", 1, 1.0), ("b", 5, 2.0)), path)
        upsert(snapshot(spark, ("a", 2, 9.0)), path)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert rows(sinks.read_current(spark, path), "coin_id") == [("a",), ("b",)]


def test_versions_without_a_complete_one_are_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(snapshot(spark, ("a", 1, 1.0)), path)
    os.remove(f"{path}/v000000000000/_COMMITTED")
    with pytest.raises(ValueError, match="no complete version"):
        upsert(snapshot(spark, ("b", 1, 1.0)), path)
    upsert(snapshot(spark, ("a", 1, 1.0)), path, version=0)  # the retry of the one that was cut off
    assert sinks.current_version(spark, path) == 0


def test_upsert_takes_new_columns_and_old_types(spark, tmp_path):
    path = f"{tmp_path}/snap"
    upsert(snapshot(spark, ("a", 1, 1.0)), path)
    upsert(spark.sql("SELECT 'b' AS coin_id, 1L AS event_timestamp, 2 AS price_usd, 'n' AS note"), path)
    got = sinks.read_current(spark, path)
    assert got.dtypes == [("coin_id", "string"), ("event_timestamp", "int"),
                          ("price_usd", "double"), ("note", "string")]
    assert rows(got) == [("a", 1, 1.0, None), ("b", 1, 2.0, "n")]


def test_prune_versions(spark, tmp_path):
    path = f"{tmp_path}/snap"
    for n in range(4):
        upsert(snapshot(spark, ("a", n, float(n))), path)
    assert sinks.prune_versions(spark, path, keep=2) == [0, 1]
    assert sorted(os.listdir(path)) == ["v000000000002", "v000000000003"]
    assert rows(sinks.read_current(spark, path)) == [("a", 3, 3.0)]
    with pytest.raises(ValueError):
        sinks.prune_versions(spark, path, keep=0)


def test_shared_dir_is_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert one.startswith(base) and one != two


def test_materialise(spark):
    df = session.materialise(spark.range(10).withColumn("x", F.col("id") * 2))
    assert rows(df, "x") == [(2 * i,) for i in range(10)] or df.count() == 10
    assert df.select("x").inputFiles()


def test_drop_shared_deletes_only_what_was_made_here(spark):
    path = session.shared_dir(spark, "x")
    base = os.path.dirname(os.path.dirname(path))
    spark.range(1).write.parquet(path)
    spark.range(1).write.parquet(f"{base}/other")
    assert session.drop_shared(spark) >= 1
    assert not os.path.exists(os.path.dirname(path)) and os.path.exists(f"{base}/other")
    assert session.drop_shared(spark) == 0


def test_sorted_write(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 2).alias("date"), (1000 - F.col("id")).alias("k"))
    sinks.overwrite_table(df, f"{tmp_path}/t", ["date"], sort_by=["k"])
    for file in glob.glob(f"{tmp_path}/t/date=*/*.parquet"):
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)
