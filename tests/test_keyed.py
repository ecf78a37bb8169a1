"""Keyed storage: one row per key over batches, replays and failed runs; only folders that may hold a key are read."""

import tempfile

import pytest
from pyspark.sql import functions as F

from leadmill.operators import keyed as KY


def rows(spark, low, high, tag):
    return spark.range(low, high).select(F.col("id").alias("key"), F.lit(tag).alias("tag"), (F.col("id") * 2).alias("x"))


def test_three_batches_and_replays(spark):
    path = tempfile.mkdtemp(prefix="keyed-")
    for _ in range(2):  # the second turn is a replay of everything
        KY.append_keyed(rows(spark, 0, 1000, "a"), path, ["key"], "a")
        KY.append_keyed(rows(spark, 500, 1500, "b").unionByName(rows(spark, 500, 600, "c")), path, ["key"], "b")
        KY.append_keyed(rows(spark, 0, 1500, "d"), path, ["key"], "d")  # nothing new
    got = KY.read_keyed(spark, path)
    assert got.columns == ["key", "tag", "x"] and got.count() == 1500 == got.select("key").distinct().count()
    assert {r["tag"]: r["count"] for r in got.groupBy("tag").count().collect()} == {"a": 1000, "b": 500}
    KY.append_keyed(rows(spark, 1500, 1501, "e"), path, ["key"], "e")
    assert KY.read_keyed(spark, path).count() == 1501


def test_a_failed_batch_is_written_again(spark):
    path = tempfile.mkdtemp(prefix="keyed-")
    KY.append_keyed(rows(spark, 0, 100, "a"), path, ["key"], "1")
    # rows without a marker, as a run leaves them that stopped before its end
    rows(spark, 100, 150, "lost").withColumns({"batch": F.lit("2"), "prefix": F.lit(0)}).write.mode("append").partitionBy("batch", "prefix").parquet(f"{path}/rows")
    assert KY.read_keyed(spark, path).count() == 100
    KY.append_keyed(rows(spark, 50, 200, "b"), path, ["key"], "2")
    got = KY.read_keyed(spark, path)
    assert got.groupBy("tag").count().collect() and {r["tag"]: r["count"] for r in got.groupBy("tag").count().collect()} == {"a": 100, "b": 100}


def test_only_folders_that_may_hold_a_key_are_read(spark):
    path = tempfile.mkdtemp(prefix="keyed-")
    KY.append_keyed(rows(spark, 0, 20_000, "a"), path, ["key"], "1", prefixes=16)
    hashes = lambda low, high: rows(spark, low, high, "x").withColumn("hash", KY._hash(["key"])).withColumn("prefix", F.pmod("hash", F.lit(16)).cast("int")).select("prefix", "hash")
    held = KY.holding(spark, path, hashes(100, 110))
    assert held.count() == 10 and held.select("prefix").distinct().count() == hashes(100, 110).select("prefix").distinct().count()
    strange = KY.holding(spark, path, hashes(50_000, 60_000)).count()
    assert strange < 0.1 * 10_000  # a bit in sixteen is set
    folders = [f"{path}/rows/batch={r['batch']}/prefix={r['prefix']}" for r in held.select("batch", "prefix").distinct().collect()]
    read = spark.read.option("basePath", f"{path}/rows").parquet(*folders)
    assert 0 < len(read.inputFiles()) < len(spark.read.parquet(f"{path}/rows").inputFiles())
    assert all(any(folder in name for folder in folders) for name in read.inputFiles())


@pytest.mark.parametrize("keys", [["key"], ["key", "tag"]])
def test_empty_and_null_keys(spark, keys):
    path = tempfile.mkdtemp(prefix="keyed-")
    KY.append_keyed(rows(spark, 0, 0, "a"), path, keys, "1")
    KY.append_keyed(rows(spark, 0, 5, "a"), path, keys, "2")
    KY.append_keyed(rows(spark, 3, 9, "b"), path, keys, "3")
    assert KY.read_keyed(spark, path).count() == (9 if keys == ["key"] else 11)


def test_rows_that_are_held_are_not_staged(spark, monkeypatch):
    """Of a batch that brings little, only the new rows are written aside; others go no further than their keys."""
    path, made = tempfile.mkdtemp(prefix="keyed-"), {}
    fresh = KY.fresh_folder
    KY.append_keyed(rows(spark, 0, 5000, "a"), path, ["key"], "a")
    monkeypatch.setattr(KY, "fresh_folder", lambda s, name: made.setdefault(name, fresh(s, name)))
    assert KY.append_keyed(rows(spark, 0, 5003, "b"), path, ["key"], "b") == 3
    assert spark.read.parquet(made["keyed"]).count() == 3 and spark.read.parquet(made["asked"]).columns == ["key", "hash", "prefix"]
