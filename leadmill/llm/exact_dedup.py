"""Exact duplicates by two-pass Bloom filtering, in DataFrame functions only.

Texts are equal when the same after deleting space and the characters 09 to 0D; a null text counts as empty. Of equal
texts the row with the most code points stays, then the smallest id (a null id comes last), then any one row.

First pass: every row's hash sets two positions of a Bloom table, and the table keeps the positions that two or more
rows set. Second pass: a row both of whose positions are kept is possibly a repeat. Only those rows are grouped by
their SHA-256; all others are alone for certain and pass straight through.

The table has a fixed largest size (``max_bits``), so it may be broadcast at any size of the corpus. With many more
rows than bits it lets more rows through to the grouping; results stay the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.common import BLANKS, join_facts, stash

#: Largest table: 2^28 positions, 2^22 words of 64 bits.
MAX_BITS = 1 << 28


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def positions(hashed: Column, bits: int) -> list[Column]:
    """Two table positions of a 64-bit hash."""
    return [F.pmod(hashed, F.lit(bits)), F.pmod(F.xxhash64(hashed), F.lit(bits))]


def table_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """Sixteen positions a row, as a power of two, at most ``max_bits``."""
    return min(max_bits, max(1 << 16, 1 << (16 * max(rows, 1) - 1).bit_length()))


def repeated_positions(hashes: DataFrame, column: str, bits: int) -> DataFrame:
    """The Bloom table as (word, mask): positions that two or more rows set; at most bits / 64 rows."""
    a, b = positions(F.col(column), bits)
    return bit_table(hashes.select(F.explode(F.array(a, b)).alias("spot")).groupBy("spot").count().where("count > 1"))


def member_positions(hashes: DataFrame, column: str, bits: int) -> DataFrame:
    """The Bloom table of all rows, for testing other rows on whether they may be among them."""
    a, b = positions(F.col(column), bits)
    return bit_table(hashes.select(F.explode(F.array(a, b)).alias("spot")))


def bit_table(spots: DataFrame) -> DataFrame:
    return (spots.groupBy(F.shiftright("spot", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("mask")))


def with_possible(df: DataFrame, column: str, seen: DataFrame, bits: int) -> DataFrame:
    """``df`` with the boolean ``possible``: both positions of ``column`` are in the table."""
    for n, spot in enumerate(positions(F.col(column), bits)):
        word = F.broadcast(seen.select(F.col("word").alias(f"word_{n}"), F.col("mask").alias(f"mask_{n}")))
        df = df.withColumn(f"spot_{n}", spot).withColumn(f"word_{n}", F.shiftright(f"spot_{n}", 6)).join(word, f"word_{n}", "left")
    hit = [F.coalesce(F.expr(f"getbit(mask_{n}, cast(spot_{n} & 63 as int)) = 1"), F.lit(False)) for n in (0, 1)]
    return df.withColumn("possible", hit[0] & hit[1]).drop(*[f"{c}_{n}" for c in ("spot", "word", "mask") for n in (0, 1)])


def order_of(size: Column, ident: Column) -> list[Column]:
    """Smallest first: most code points, then an id, then the smallest id."""
    return [(-size).alias("less"), ident.isNull().alias("no_id"), ident.alias("id")]


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts form one class with empty ones; repeated rows (same id and text) are members like others, and one of them
    stays; an empty table gives none. Other columns are not read."""
    text = F.col(text_col)
    plain = normalised(text)
    slim = stash(docs.select(F.col(id_col).alias("doc_id"), F.length(F.coalesce(text, F.lit(""))).cast("long").alias("size"),
                             F.unhex(F.sha2(plain, 256)).alias("sha"), F.xxhash64(plain).alias("short"),
                             F.monotonically_increasing_id().alias("row")), "hashes")
    bits = table_bits(slim.count(), max_bits)
    seen = stash(repeated_positions(slim, "short", bits), "bloom")
    rows = with_possible(slim, "short", seen, bits)
    alone = rows.where(~F.col("possible")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    maybe = stash(rows.where("possible").drop("possible", "short"), "possible")
    best = F.min(F.struct(*order_of(F.col("size"), F.col("doc_id")), F.col("row").alias("best_row"))).alias("best")
    groups = stash(maybe.groupBy("sha").agg(F.count("*").alias("group_size"), best)
                   .select("sha", "group_size", F.col("best.id").alias("keep_id"), "best.best_row"), "groups")
    grouped = join_facts(maybe, groups, "sha", "group_size").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("best_row")).alias("kept"), "sha")
    return alone.unionByName(grouped).select("doc_id", "keep_id", "group_size", "kept",
                                             F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Whole rows are exchanged only for possible repeats, and
    each task first reduces its own."""
    plain = normalised(F.col(text_col))
    short = stash(docs.select(F.xxhash64(plain).alias("short")), "hashes")
    bits = table_bits(short.count(), max_bits)
    seen = stash(repeated_positions(short, "short", bits), "bloom")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = with_possible(docs.select(whole.alias("whole"), plain.alias("plain"), F.xxhash64(plain).alias("short")), "short", seen, bits)
    size = F.length(F.coalesce(F.col("whole")[text_col], F.lit(""))).cast("long")
    best = F.min_by("whole", F.struct(*order_of(size, F.col("whole")[id_col]), F.xxhash64("whole"))).alias("whole")
    kept = rows.where("possible").groupBy(F.sha2("plain", 256).alias("sha")).agg(best).select("whole")
    return rows.where(~F.col("possible")).select("whole").unionByName(kept).select("whole.*")


COPIES_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS size,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
        count(*) OVER (PARTITION BY text_sha256) AS group_size
      FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id ASC NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r"""
