"""Writes: append, idempotent append, upserts, backfill and report files.

Merging is expressed as DataFrame operations on (target, source); the ``write_``
functions put the result on storage so that a failed or repeated run does no
harm: new data goes to a fresh folder or is anti-joined first.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.operators.quality import latest_per_key


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as ``spark.checkpoint.dir`` names it.

    Without the setting only a local master, whose executor is the driver itself, gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="leadmill-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by ``fresh_folder``, in whichever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _any_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """A fixed order of the rows of one key, for sources that bring none."""
    rest = [F.col(c) for c in df.columns if c not in keys]
    return [F.xxhash64(*rest), *rest] if rest else [F.lit(0)]


# --- merging ------------------------------------------------------------------------
def new_rows(source: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks."""
    return source if target is None else source.join(target.select(*keys), list(keys), "left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], stamp: Column | None = None,
                 order: Sequence[Column] = ()) -> DataFrame:
    """Target with the source rows inserted or replacing their namesakes.

    Of several source rows with one key the last in ``order`` counts, by default
    the last by all other columns, so that a key is never written twice.
    ``stamp`` is written to ``updated_timestamp`` of replaced and new rows.
    """
    rows = latest_per_key(source, keys, order or _any_order(source, keys))
    if stamp is not None:
        rows = rows.withColumn("updated_timestamp", stamp)
    kept = target.join(rows.select(*keys), list(keys), "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def merge_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Updates only the listed columns; new keys are inserted with the columns they have."""
    t, s = target.alias("t"), source.alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    have = set(source.columns)

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c)
        if c in columns:
            return F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c)
        if c in have:
            missing = F.col(f"t.{keys[0]}").isNull()
            return F.when(missing, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        return F.col(f"t.{c}").alias(c)

    return t.join(s, on, "full").select(*[value(c) for c in target.columns])


def backfill(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str],
             order: Sequence[Column]) -> DataFrame:
    """Null columns filled from the newest source row of the key."""
    one = latest_per_key(source.select(*keys, *columns, *[c for c in source.columns if c not in (*keys, *columns)]), keys, order)
    named = one.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns])
    joined = target.join(named, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_s_{c}")) for c in columns}).drop(*[f"_s_{c}" for c in columns]
                                                                                                 ).select(*target.columns)


def register_model(registry: DataFrame, entry: DataFrame) -> DataFrame:
    """Registry with new entries: of each type that has one, all others become inactive, and the inserted entry, of
    several the newest, is active whatever its date; other types are left as they are."""
    added = entry.withColumn("_place", F.struct("created", F.col("version"), F.xxhash64(*entry.columns)))
    chosen = added.groupBy("model_type").agg(F.max("_place").alias("_chosen"))
    old = registry.join(chosen.select("model_type", F.lit(True).alias("_new")), "model_type", "left")
    old = old.withColumn("is_active", F.col("is_active") & F.col("_new").isNull()).drop("_new")
    new = added.join(chosen, "model_type").withColumn("is_active", F.col("_place") == F.col("_chosen")).drop("_place", "_chosen")
    return old.select(*registry.columns).unionByName(new.select(*registry.columns))


# --- storage --------------------------------------------------------------------------
def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_new(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), order: Sequence[Column] = ()) -> None:
    """Idempotent append: one row per key, and none whose key the table holds, so a repeated run adds nothing.

    Of rows with one key the last in ``order`` counts (by default a fixed one).  Where the table is partitioned, the
    partition columns must be functions of the key: only partitions that occur in ``df`` are read."""
    once = latest_per_key(df, keys, order or _any_order(df, keys))
    target = read_or_none(df.sparkSession, path)
    if target is not None and partition_by:
        target = target.join(once.select(*partition_by).distinct(), list(partition_by), "left_semi")
    append(new_rows(once, target, keys), path, partition_by)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrites the partitions that occur in ``df``, which may itself come from the table.

    The new content is written in full to the shared folder first, so the table
    is never read while it is being replaced.
    """
    staged = fresh_folder(df.sparkSession, "staged")
    df.write.parquet(staged)
    (df.sparkSession.read.parquet(staged).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    remove_folder(df.sparkSession, staged)


def upsert_table(source: DataFrame, path: str, keys: Sequence[str], partition_by: str, stamp: Column | None = None,
                 order: Sequence[Column] = ()) -> None:
    """Upsert into a partitioned parquet table; only partitions with source rows are rewritten.

    The first write is a merge into an empty table, so keys and columns are the
    same as after any other.  The partition column must be a function of the
    key, so that a row never changes its partition.
    """
    target = read_or_none(source.sparkSession, path)
    if target is None:
        return append(merge_upsert(source.limit(0), source, keys, stamp, order), path, [partition_by])
    touched = target.join(source.select(partition_by).distinct(), partition_by, "left_semi")
    replace_partitions(merge_upsert(touched, source, keys, stamp, order), path, [partition_by])


def write_reports(df: DataFrame, path: str) -> None:
    """The same report as CSV with header and as JSON lines."""
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")
    df.write.mode("overwrite").json(f"{path}/json")
