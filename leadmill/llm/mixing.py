"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words; every document of it is then expected target / size times. Documents are
laid out by size within their source, a prefix sum runs over their expected copies from one random offset, and a
document is given once for each whole number its interval crosses. Neighbours in the layout have like sizes, so the
words taken differ from the target by less than the source's longest document, and no document is taken more often
than its expected copies rounded up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.common import WORD, join_facts, repeat_rows, row_key, running_totals, stash

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2.0
SEED = 20240229


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to (source, source_size, ...): weights repeat over the sources by code point, null last, and share
    ``share`` times all words; no target exceeds ``cap`` times its source, the rest going to the others by weight.

    The windows without a key run over one row per source."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.get(listed, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))))
    weighed = weighed.withColumn("most", F.col("source_size") * cap)
    # Sources fill up in the order of most / weight; one is full if its share of what those before leave exceeds its cap.
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # The first open source sets the level for itself and all after it; those before it are full.
    place = F.row_number().over(by_ratio)
    weighed = weighed.withColumn("level", level).withColumn("place", place)
    opens = F.col("most") > F.col("level") * F.col("weight")
    first = F.min(F.when(opens, F.struct("place", "level"))).over(everything)
    return (weighed.withColumn("first", first)
            .withColumn("target", F.when(F.col("place") < F.coalesce(F.col("first.place"), F.col("place") + 1), F.col("most"))
                        .otherwise(F.col("first.level") * F.col("weight"))).drop("level", "most", "place", "first"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED,
             keys: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken (and its row key).

    Null and blank texts have size 0 and are given, if at all, with no words; a null source is a source of its own; equal
    rows are interchangeable; an empty table gives no rows. The result depends on the rows and ``seed`` alone."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    own = row_key(docs) if keys else []
    slim = stash(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), *own,
                             F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))).alias("shuffled"),
                             F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")).alias("source_key"),
                             F.monotonically_increasing_id().alias("row")), "sizes")
    sources = targets(slim.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")),
                      weights, share, cap).drop("source", "weight")
    # Equal rows go by their stored number, so that the copies of one row also spread over many ranges.
    order = ["size", "shuffled", "doc_id", *(["row_key_a", "row_key_b"] if keys else []), "row"]
    places = running_totals(slim.withColumn("one", F.lit(1).cast("long")), "source_key", order, "one", "place")
    joined = join_facts(stash(places.drop("one", "shuffled", "row"), "places"), stash(sources, "sources"), "source_key", "source_rows")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.pmod(F.xxhash64(F.lit(seed), "source_key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("offset") + (F.col("place") + 1) * F.col("rate")) - F.floor(F.col("offset") + F.col("place") * F.col("rate"))
    return (joined.withColumn("rate", rate).withColumn("offset", offset).withColumn("copies", copies.cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .select("doc_id", "source", "size", "source_size", "target", "copies", "taken", *(["row_key_a", "row_key_b"] if keys else [])))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as the plan takes it."""
    plan = mix_plan(docs, keys=True, **options)
    return repeat_rows(docs, plan.select("row_key_a", "row_key_b", F.col("copies").alias("times")))
