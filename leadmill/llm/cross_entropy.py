"""Cross-entropy difference: how much better a model of wanted text predicts a document than a model of any text.

Both are bigram models over one shared vocabulary, the parts of a byte-level tokenizer, which spell every text, so that
no word is unknown to either. The target are documents labelled as of good quality and not toxic. The background is
matched to it: documents drawn by hash, with as many tokens as the target has, so that text which is neither more nor
less like the target scores around zero. Both grow with the corpus, and nothing is cut.

No document is scored by counts that it is part of: documents are dealt to two folds by the hash of their id, and each
fold is scored by the models of the other.

Counts of pairs are a table in the shared folder. The most frequent pairs, at most ``HOT`` whatever the corpus, are
looked up where texts are read; all others are joined by key, so no key brings many rows to one task. Counts of single
parts are as many as the vocabulary has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.common import stash
from leadmill.llm.exact_dedup import member_positions, table_bits, with_possible
from leadmill.llm.tokens import ByteLevel

#: A pair's probability is (count + PRIOR * share of its second part) / (count of its first part + PRIOR).
PRIOR = 64.0
#: Pairs with at least 1/HOT of all counted pairs are looked up in the tasks.
HOT = 1 << 20
#: Tokens whose pairs a task adds up at once, and distinct pairs that it holds.
TOKENS, HELD = 1 << 20, 1 << 22
SEED = 20240229
#: The draw of a document for the background is a whole number below this.
DRAWS = 1 << 30
#: Texts that a worker holds the ids of at once.
ROWS = 250
#: Counts by model and fold.
COUNTS = ["t0", "t1", "u0", "u1"]

_ENCODERS: dict[str, ByteLevel] = {}


def encoder(path: str) -> ByteLevel:
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteLevel(path)
    return _ENCODERS[path]


def start_of(own: ByteLevel) -> int:
    """The id that stands before a text: the one behind the vocabulary."""
    return max(own.bytes) + 1


def pairs_of(ids: np.ndarray, sizes: np.ndarray, start: int) -> np.ndarray:
    """Names of all pairs of texts that lie end to end: the part before (or the start) and the part."""
    before = np.concatenate(([start], ids))[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = start
    return before << 32 | ids


def fold_of(ident: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), ident), F.lit(2)).cast("int")


def flagged(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text) with ``target``: labelled as good and not toxic. Of the corpus only rows that may be labelled, by a
    Bloom table of bounded size, are exchanged."""
    good = stash(labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
                 .select(F.col("doc_id").cast("string").alias("named")).distinct(), "target-ids")
    bits = table_bits(good.count())
    named = F.col("doc_id").cast("string")
    seen = stash(member_positions(good.select(F.xxhash64("named").alias("short")), "short", bits), "target-bloom")
    known = with_possible(rows.where("doc_id IS NOT NULL").withColumn("short", F.xxhash64(named)), "short", seen, bits)
    maybe = known.where("possible").withColumn("named", named).join(good.withColumn("target", F.lit(True)).hint("merge"), "named", "left")
    rest = known.where("NOT possible").select("doc_id", "text").unionByName(rows.where("doc_id IS NULL")).withColumn("target", F.lit(False))
    return maybe.select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target")).unionByName(rest)


def tokenised(rows: DataFrame, path: str) -> DataFrame:
    """(row, doc_id, target, fold, draw, n, ids): ids as little-endian unsigned 32-bit numbers."""
    out = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("target", T.BooleanType()), T.StructField("n", T.LongType()),
                        T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            ids = [np.array(own.ids(text or ""), np.uint32) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], names=out.names)

    made = rows.select("doc_id", "target", "text").mapInArrow(run, out)
    draw = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(DRAWS))
    return stash(made.select(F.monotonically_increasing_id().alias("row"), "doc_id", "target", fold_of(F.col("doc_id")).alias("fold"), draw.alias("draw"), "n", "ids"), "tokens")


def counted(tokens: DataFrame, limit: float, path: str) -> DataFrame:
    """(key, t0, t1, u0, u1): how often each pair occurs in target and background documents of either fold."""
    def combined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(x) for x in zip(*parts))
        own, place = np.unique(keys, return_inverse=True)
        return own, np.stack([np.bincount(place, counts[:, c], len(own)) for c in range(4)], 1).astype(np.int64)

    def batches_of(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, counts = combined(parts)
        for at in range(0, len(keys), 1 << 16):
            cut = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(keys[cut]), *[pa.array(counts[cut, c]) for c in range(4)]], names=["key", *COUNTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, parts, keys, kinds, size = start_of(encoder(path)), [], [], [], 0

        def add() -> None:
            nonlocal size
            whole, of = np.concatenate(keys), np.concatenate(kinds)
            own, place = np.unique(whole, return_inverse=True)
            fold, target, drawn = of & 1, of & 2, of & 4
            masks = [(fold == f) & (flag > 0) for flag in (target, drawn) for f in (0, 1)]
            parts.append((own, np.stack([np.bincount(place[m], minlength=len(own)) for m in masks], 1)))
            keys.clear()
            kinds.clear()
            size = 0

        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            fold, target, drawn, sizes = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(4))
            ids = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint32).astype(np.int64)
            keys.append(pairs_of(ids, sizes, start))
            kinds.append(np.repeat(fold.astype(np.int8) | target.astype(np.int8) << 1 | drawn.astype(np.int8) << 2, sizes))
            size += len(ids)
            if size >= TOKENS:
                add()
                if sum(len(p[0]) for p in parts) > HELD:
                    parts = [combined(parts)]
                    if len(parts[0][0]) > HELD // 2:
                        yield from batches_of(parts)
                        parts = []
        if size:
            add()
        if parts:
            yield from batches_of(parts)

    drawn = F.col("draw") < F.lit(limit)
    taken = tokens.where(F.col("target") | drawn).select("fold", "target", drawn.alias("drawn"), "n", "ids")
    return stash(taken.mapInArrow(run, "key long, " + ", ".join(f"{c} long" for c in COUNTS)).groupBy("key").agg(*[F.sum(c).alias(c) for c in COUNTS]), "pairs")


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, target_loss, background_loss, difference (per token, in nats; below
    zero a document reads more like the target than like other text).

    Null and empty texts have no tokens and null losses; repeated rows are counted and scored each, rows of one id in one
    fold; a model without documents is the even one; an empty table gives no rows; other columns are not read; texts of
    any length are scored whole."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tokens = tokenised(flagged(rows, labels), path)
    size = start_of(encoder(path)) + 1
    sums = tokens.agg(F.sum("n").alias("all"), F.sum(F.when(F.col("target"), F.col("n"))).alias("target")).first()
    pairs = counted(tokens, DRAWS * (sums["target"] or 0) / max(sums["all"] or 0, 1), path)

    def singles(part: Column) -> np.ndarray:
        """Counts per part of the vocabulary: by model and fold."""
        found = pairs.groupBy(part.alias("id")).agg(*[F.sum(c).alias(c) for c in COUNTS]).toArrow()  # a row per part at most
        out = np.zeros((4, size))
        out[:, found["id"].to_numpy()] = [found[c].to_numpy() for c in COUNTS]
        return out

    firsts, seconds = singles(F.shiftright("key", 32)), singles(F.col("key").bitwiseAND(F.lit((1 << 32) - 1)))
    shares = PRIOR * (seconds + 1) / (seconds.sum(1, keepdims=True) + size)
    least = (pairs.agg(F.sum(F.col("t0") + F.col("t1") + F.col("u0") + F.col("u1"))).first()[0] or 0) / hot
    total = F.col("t0") + F.col("t1") + F.col("u0") + F.col("u1")
    top = pairs.where(total >= least).orderBy("key").toArrow()  # at most ``hot`` rows
    sent = spark.sparkContext.broadcast((firsts, shares, top["key"].to_numpy(), np.stack([top[c].to_numpy() for c in COUNTS]).astype(np.int64)))
    rare_type = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("times", "t", "u")]]))
    out = T.StructType([T.StructField("row", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("a", "b")], T.StructField("rare", rare_type)])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, shares, keys, counts = sent.value
        start = size - 1
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            sizes, n = batch.column(2).to_numpy(), batch.num_rows
            own = pairs_of(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint32).astype(np.int64), sizes, start)
            text = np.repeat(np.arange(n), sizes)
            order = np.lexsort((own, text))
            own, text = own[order], text[order]
            new = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])))) if len(own) else np.zeros(0, np.int64)
            own, text, times = own[new], text[new], np.diff(np.append(new, len(own)))
            other = 1 - batch.column(1).to_numpy()[text]  # the models of the other fold
            spot = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
            hit = keys[spot] == own if len(keys) else np.zeros(len(own), bool)
            sums, prior = [], []
            for model in (0, 2):
                share = shares[model + other, own & 0xFFFFFFFF]
                seen = np.where(hit, counts[model + other, spot], 0) if len(keys) else np.zeros(len(own))
                loss = np.log(firsts[model + other, own >> 32] + PRIOR) - np.where(hit, np.log(seen + share), 0)
                sums.append(np.bincount(text, times * loss, n))
                prior.append(share)
            rare = pa.StructArray.from_arrays([pa.array(own[~hit]), *[pa.array(x[~hit].astype(np.float64)) for x in (times, *prior)]], names=["key", "times", "t", "u"])
            ends = np.concatenate(([0], np.cumsum(np.bincount(text[~hit], minlength=n))))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(s) for s in sums], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)], names=out.names)

    scored = stash(tokens.select("row", "fold", "n", "ids").mapInArrow(score, out), "scores")
    asked = scored.select("row", F.inline("rare")).join(tokens.select("row", "fold"), "row")
    seen = asked.join(pairs.where(total < least), "key", "left")
    theirs = lambda m: F.coalesce(F.when(F.col("fold") == 0, F.col(f"{m}1")).otherwise(F.col(f"{m}0")), F.lit(0))
    rest = seen.groupBy("row").agg(*[F.sum(-F.col("times") * F.log(theirs(m) + F.col(m))).alias(f"rare_{m}") for m in ("t", "u")])
    mean = lambda own, more: F.when(F.col("n") > 0, (F.col(own) + F.coalesce(F.col(more), F.lit(0.0))) / F.col("n"))
    whole = tokens.select("row", "doc_id", "n").join(scored.drop("rare"), "row").join(rest, "row", "left")
    return (whole.select("doc_id", F.col("n").alias("n_tokens"), mean("a", "rare_t").alias("target_loss"), mean("b", "rare_u").alias("background_loss"))
            .withColumn("difference", F.col("target_loss") - F.col("background_loss")))
