"""Helpers shared by the text operators: word pattern, stored intermediates, row keys, skew-safe joins, sampling."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts: a run of anything but space and the five control characters 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\u000b\u000c\r"
#: A key with at least this share of the rows is hot, so there are at most as many hot keys.
HOT_KEYS = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it. Only a local master, where driver and
    executors are one process, gets a temporary folder when the setting is missing."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it again: lineage ends there, and a lost executor costs a re-read."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes over all columns: equal rows have equal keys, and 128 bits keep other rows apart."""
    own = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(*own).alias("row_key_a"), F.xxhash64(F.lit(7), *own).alias("row_key_b")]


def repeat_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """``docs`` with each distinct row given as often as ``decisions`` (row_key_a, row_key_b, times) says.

    Equal rows are first reduced to one and ``times`` is their total. One exchange of the rows, on the key."""
    keys = ["row_key_a", "row_key_b"]
    times = decisions.groupBy(*keys).agg(F.sum("times").alias("times")).where("times > 0")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    ones = docs.select(whole, *row_key(docs)).join(times, keys).dropDuplicates(keys)
    return ones.select("whole", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("place")).select("whole.*")


def join_facts(rows: DataFrame, facts: DataFrame, key: str, count: str) -> DataFrame:
    """Left join of ``rows`` to ``facts`` (one row per key, ``count`` = rows of the key) that survives hot keys.

    Keys with 1/64 of the counted rows or more are at most 64, whatever the data: they are broadcast. The rest is a
    plain shuffled join without large keys. Both inputs should be stored or cheap, as they are read twice."""
    total = facts.agg(F.sum(count)).first()[0] or 0
    hot = F.broadcast(facts.where(F.col(count) * HOT_KEYS >= total))
    cold = facts.where(F.col(count) * HOT_KEYS < total)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, "left"))


def running_totals(df: DataFrame, group: str, order: Sequence[str], value: str, into: str) -> DataFrame:
    """Exclusive prefix sums of ``value`` within ``group`` in the given order, in two passes.

    Rows are dealt by range over (group, order), so a hot group spreads over many tasks; the first pass sums each
    (partition, group) piece, the second adds the sums of the pieces before to a running sum inside the piece."""
    from pyspark.sql import Window

    pieces = stash(df.repartitionByRange(group, *order).withColumn("piece", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = (pieces.groupBy(group, "piece").agg(F.sum(value).alias("piece_total"))
             .select(group, "piece", F.coalesce(F.sum("piece_total").over(before), F.lit(0)).alias("piece_base")))
    inside = Window.partitionBy(group, "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (pieces.join(bases, [group, "piece"])
            .withColumn(into, F.col("piece_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("piece", "piece_base"))
