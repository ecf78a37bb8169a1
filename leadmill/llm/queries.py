"""Named queries of the text operators and, where SQL can say it, the same result in SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.llm import (alignment, certified_packing, cross_entropy, exact_dedup, host_reputation, html_blocks, language_ppm, mixing, negatives_rtree,
                          packing, quality_rules, simhash_index, toxicity_chain)
from leadmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    return host_reputation.judge_urls(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_plan(table(spark, folder, "documents"))


def op3_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    found = html_blocks.extract(pages, html_blocks.fit(pages), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op4_simhash_index(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_index.near_duplicates(table(spark, folder, "documents"))


def op5_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_chain.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    return cross_entropy.cross_entropy_difference(table(spark, folder, "documents"), table(spark, folder, "labels"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.line_clean(docs, cleaned=False).drop("text", "lost_lines")


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, folder, "documents"))


def op10_language_ppm(spark: SparkSession, folder: str) -> DataFrame:
    return language_ppm.identify(table(spark, folder, "documents"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    hashed = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return alignment.align(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), carry=[hashed])


def op12_certified_packing(spark: SparkSession, folder: str) -> DataFrame:
    return certified_packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), carry=[F.crc32("ids").alias("ids_crc32")])


def op13_negatives_rtree(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives_rtree.mine(table(spark, folder, "embeddings").withColumn("label", moved), F.col("id") % 100 == 0)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_host_reputation, op2_mixing, op3_html_blocks, op4_simhash_index, op5_toxicity_chain, op6_cross_entropy, op7_packing, op8_quality_rules, op9_exact_dedup, op10_language_ppm, op11_alignment, op12_certified_packing,
                                  op13_negatives_rtree, pipeline)}


def all_sql() -> dict[str, str]:
    return {"op1_host_reputation": host_reputation.JUDGED_SQL, "op8_quality_rules": quality_rules.JUDGED_SQL, "op9_exact_dedup": exact_dedup.COPIES_SQL,
            "op13_negatives_rtree": negatives_rtree.MINED_SQL}
