"""A stored table with one row per key that an append finds its keys in without reading the table.

Rows lie in folders by batch and by a prefix of the key's hash. Every batch also stores, per prefix, a bitmap of its key
hashes in pieces of 32,768 bits. An append joins its keys to the pieces they fall in, reads only the folders in which a
bit says that a key may be, and compares keys there. A batch counts once its marker is written, last of all, so a run
that failed is written again in full and a repeated one is a no-op.

    <path>/rows/batch=../prefix=..   <path>/bits/batch=..   <path>/batches/batch=..
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.operators.quality import latest_per_key
from leadmill.operators.sinks import fresh_folder, new_rows, read_or_none, remove_folder

#: Folders that the rows of a batch are dealt to, and rows of a file.
PREFIXES, FILE_ROWS = 16, 1 << 20
#: Bits of a batch's bitmap per row and of one stored piece.
BITS_PER_ROW, PIECE = 16, 32768


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def committed(spark: SparkSession, path: str) -> DataFrame | None:
    """(batch, size, added): the batches that count, the bits of their bitmaps and the rows they brought."""
    found = read_or_none(spark, f"{path}/batches")
    return None if found is None else found.withColumn("batch", F.col("batch").cast("string"))


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the batches that count."""
    done, rows = committed(spark, path), read_or_none(spark, f"{path}/rows")
    if done is None or rows is None:
        return None
    names = [r["batch"] for r in done.select("batch").collect()]
    return rows.filter(F.col("batch").cast("string").isin(names)).drop("batch", "prefix")


def holding(spark: SparkSession, path: str, hashes: DataFrame) -> DataFrame | None:
    """(prefix, batch, hash) of the given (prefix, hash) that a stored bitmap has a bit for: all that the table holds, and a
    few it does not."""
    done, bits = committed(spark, path), read_or_none(spark, f"{path}/bits")
    if done is None or bits is None:
        return None
    units = bits.withColumn("batch", F.col("batch").cast("string")).join(F.broadcast(done), "batch")  # a row per batch
    sizes = units.select("prefix", "batch", "size").distinct()
    place = F.pmod("hash", F.col("size"))
    asked = hashes.join(sizes, "prefix").withColumns({"piece": F.floor(place / PIECE), "bit": place % PIECE})
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(F.col("bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = asked.join(units.select("prefix", "batch", "piece", "bitmap"), ["prefix", "batch", "piece"])
    return hit.filter(F.call_function("getbit", byte, (F.col("bit") % 8).cast("int")) == 1).select("prefix", "batch", "hash")


def held_keys(df: DataFrame, path: str, keys: Sequence[str], prefixes: int) -> DataFrame | None:
    """The keys of ``df`` that the table holds, stored; only keys and their hashes are exchanged, and of the table only the
    folders are read in which a bit says that a key may be."""
    spark = df.sparkSession
    if committed(spark, path) is None:
        return None
    asked, kept = fresh_folder(spark, "asked"), fresh_folder(spark, "held")
    own = df.select(*keys).withColumn("hash", _hash(keys)).withColumn("prefix", F.pmod("hash", F.lit(prefixes)).cast("int"))
    own.write.option("compression", "zstd").parquet(asked)
    own = spark.read.schema(own.schema).parquet(asked)
    maybe = holding(spark, path, own.select("prefix", "hash").distinct())
    folders = [f"{path}/rows/batch={r['batch']}/prefix={r['prefix']}" for r in maybe.select("batch", "prefix").distinct().collect()] if maybe is not None else []  # folders, not rows
    if not folders:
        return None
    held = spark.read.option("basePath", f"{path}/rows").parquet(*folders).select(*keys)
    held.join(own.select(*keys), list(keys), "left_semi").write.option("compression", "zstd").parquet(kept)
    return spark.read.schema(held.schema).parquet(kept)


def append_keyed(df: DataFrame, path: str, keys: Sequence[str], batch: str, order: Sequence[Column] = (), prefixes: int = PREFIXES) -> int:
    """Appends the rows whose key the table lacks, one per key (of several the last in ``order``, by default a fixed one), and
    gives their number, of a repeated batch that of its first run.

    ``batch`` names the input: a batch that was written before is not looked at again. ``prefixes`` must stay the same."""
    spark = df.sparkSession
    done = committed(spark, path)
    before = done.filter(F.col("batch") == batch).first() if done is not None else None
    if before is not None:
        return before["added"]
    rest = [F.col(c) for c in df.columns if c not in keys]
    fixed = [F.xxhash64(*rest), *rest] if rest else [F.lit(0)]
    known = held_keys(df, path, keys, prefixes)
    once = latest_per_key(df if known is None else new_rows(df, known, keys), keys, order or fixed)
    once = once.withColumn("hash", _hash(keys)).withColumn("prefix", F.pmod("hash", F.lit(prefixes)).cast("int"))
    staged = fresh_folder(spark, "keyed")
    once.write.option("compression", "zstd").parquet(staged)
    once = spark.read.schema(once.schema).parquet(staged)
    for part in ("rows", "bits"):  # what a run left that stopped before its marker
        remove_folder(spark, f"{path}/{part}/batch={batch}")
    count = once.count()
    size = -(-max(count, 1) * BITS_PER_ROW // PIECE) * PIECE
    file = F.pmod(F.floor(F.col("hash") / prefixes), F.lit(-(-count // (prefixes * FILE_ROWS)) or 1))
    named = once.withColumn("batch", F.lit(batch)).repartition("prefix", file)
    named.drop("hash").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "prefix").parquet(f"{path}/rows")
    place = F.pmod("hash", F.lit(size).cast("long"))
    bitmaps = named.groupBy("batch", "prefix", F.floor(place / PIECE).alias("piece")).agg(F.bitmap_construct_agg(place % PIECE).alias("bitmap"))
    bitmaps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/bits")
    marker = spark.range(1).select(F.lit(size).cast("long").alias("size"), F.lit(count).cast("long").alias("added"), F.lit(batch).alias("batch"))
    marker.write.mode("append").partitionBy("batch").parquet(f"{path}/batches")
    return count
