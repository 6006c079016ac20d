"""Versions that fail on the way, and merged tables whose batches write only themselves."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from lectern.sources import versions
from lectern.streaming import jobs
from test_streaming import at, write

TYPES = {"key": "bigint", "value": "double"}


def _report(spark, rows):
    return spark.createDataFrame(rows, "key string, value string")


def test_versions_and_bad_rows(spark, folder, rows):
    path = folder("report")
    one = versions.publish_version(_report(spark, [("1", "2.5"), ("x", "1"), ("3", "\\N")]), path, TYPES).first()
    assert (one.number, one.saved, one.errors) == (1, 2, 1)
    assert rows(versions.read_version(spark, path)) == [(1, 2.5), (3, None)]
    two = versions.publish_version(_report(spark, [("7", "0")]), path, TYPES).first()
    assert (two.number, two.saved, two.errors) == (2, 1, 0)
    assert rows(versions.read_version(spark, path)) == [(7, 0.0)] and rows(versions.read_version(spark, path, 1)) == [(1, 2.5), (3, None)]
    assert versions.read_version(spark, path, 1, bad=True).count() == 1
    three = versions.publish_version(_report(spark, []), path, TYPES).first()
    assert (three.saved, three.errors) == (0, 0)


def test_a_failed_write_changes_nothing(spark, folder, rows):
    path = folder("report")
    with pytest.raises(ValueError, match="no version"):
        versions.read_version(spark, path)
    versions.publish_version(_report(spark, [("1", "1")]), path, TYPES)
    broken = _report(spark, [(str(k), "2") for k in range(200)]).repartition(4).withColumn(
        "value", F.when(F.col("key") == "150", F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        versions.publish_version(broken, path, TYPES)
    assert rows(versions.read_version(spark, path)) == [(1, 1.0)] and versions.manifest(spark, path).count() == 1


def test_deltas_merge_like_upserts(spark, folder, rows):
    src, store, offsets, plain, other = (folder(n) for n in ("src", "store", "offsets", "plain", "other"))
    schema = "key string, v string, ts timestamp, gone boolean"
    batches = [
        [("a", "1", at(0), False), ("b", "1", at(1), False), ("a", "2", at(2), False)],
        [("a", "2", at(2), False), ("c", "1", at(3), False), ("b", "older", at(0), False)],
        [("c", "2", at(4), True), ("d", "1", at(4), None), ("a", "3", at(5), False)]]
    for number, batch in enumerate(batches):
        write(spark, src, batch, schema)
        jobs.snapshot_delta_stream(jobs.file_stream(spark, src), store, "key", "ts", checkpoint=offsets)
        jobs.snapshot_upsert_stream(jobs.file_stream(spark, src), plain, "key", "ts", checkpoint=other)
        expected = rows(spark.read.parquet(plain), "key", "v")
        assert rows(versions.read_merged(spark, store, ["key"], "ts"), "key", "v") == expected
        if number == 1:
            versions.compact(spark, store, ["key"], "ts")
            assert rows(versions.read_merged(spark, store, ["key"], "ts"), "key", "v") == expected
    assert rows(versions.read_merged(spark, store, ["key"], "ts", deleted="gone"), "key", "v") == [("a", "3"), ("b", "1"), ("d", "1")]


def test_a_batch_writes_itself_only(spark, folder):
    """Bytes written follow the batch, however large the table; a repeated batch replaces its rows."""
    path = folder("table")
    size = lambda: sum(p.stat().st_size for p in pathlib.Path(path).rglob("*.parquet"))
    many = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("v"), F.lit(dt.datetime(2024, 1, 1)).alias("ts"))
    versions.write_delta(many, 0, path)
    large = size()
    few = many.limit(10).withColumn("v", F.lit("new")).withColumn("ts", F.lit(dt.datetime(2024, 1, 2)))
    for _ in range(2):
        versions.write_delta(few, 1, path)
        assert size() - large < large / 50
    merged = versions.read_merged(spark, path, ["id"], "ts")
    assert merged.count() == 200_000 and merged.where("v = 'new'").count() == 10
