"""The corpus pipeline: quality rules, exact copies, near copies, mixing and packing, each over all its predecessor kept.

``run`` writes every stage as Parquet into the shared folder (``spark.checkpoint.dir``) and reads it again, so that a
stage restarts from files and not from the beginning. No stage can be left to SQL as a whole (fingerprints, tokens), so
``ORACLE_SQL`` is None and tests compare with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm import common, exact_dedup, mixing, packing, quality_rules, simhash_index

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Kept documents without their failing lines; ``n_chars``, where present, follows the text."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    judged = quality_rules.line_clean(docs.select(whole, "text")).where("kept")
    row = F.col("whole").withField("text", F.col("cleaned"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("cleaned").cast(docs.schema["n_chars"].dataType))
    return judged.select(row.alias("whole")).select("whole.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked fingerprints, that of the smallest id."""
    return simhash_index.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mix(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("exact dedup", exact_copies), ("near dedup", near_copies),
          ("mixing", mix_sources), ("packing", pack_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is a row per piece, its ids as their checksum."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stash(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
