"""Language identification by partial matching: byte context trees per language, frozen after learning.

Learning counts, for each language, every byte after its last 0 to 3 bytes. Scoring gives each text its exact code length
in bits under each language: in a context of n bytes with d different successors, a successor seen c times costs
-log2(c / (n + d)); any other costs the escape -log2(d / (n + d)) and is coded in the next shorter context, at last as
one of 256 equal bytes. Contexts a language has not seen cost nothing and are skipped. The statistics do not change
while scoring, so texts are independent. The shortest code wins.

Trees are learnt from a bounded sample: of each language about ``sample`` documents, chosen by the hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = 3
#: Expected number of documents learnt from per language.
SAMPLE = 400
UNKNOWN = "und"
#: More languages than this are an error: the trees of all are held at once.
MOST_LANGUAGES = 1000
#: Bytes scored at once, divided by the number of languages.
WINDOW = 1 << 22


def codes_of(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte after the first ``order`` ones, that byte and those before it as one number, itself lowest."""
    out = np.zeros(len(data) - order, np.int64)
    for back in range(order, -1, -1):
        out = (out << 8) | data[order - back:len(data) - back]
    return out


def lead(order: int) -> bytes:
    """What stands before the first byte of a text."""
    return b" " * order


class Table:
    """Row numbers of known codes, by open addressing over numpy arrays."""

    def __init__(self, codes: np.ndarray):
        self.shift = np.uint64(64 - max(4, (4 * max(len(codes), 1) - 1).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask, self.keys, self.rows = size - 1, np.full(size, -1, np.int64), np.zeros(size, np.int32)
        left, step = np.arange(len(codes)), 0
        while len(left):
            slots = (self.home(codes[left]) + step) & self.mask
            free = np.flatnonzero(self.keys[slots] == -1)
            taken, first = np.unique(slots[free], return_index=True)
            own = free[first]
            self.keys[taken], self.rows[taken] = codes[left[own]], left[own]
            left, step = np.delete(left, own), step + 1

    def home(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Row numbers, -1 for unknown codes."""
        slots = self.home(codes)
        keys = self.keys[slots]
        out = np.where(keys == codes, self.rows[slots], -1)
        left = np.flatnonzero((keys != codes) & (keys != -1))
        while len(left):
            slots[left] = (slots[left] + 1) & self.mask
            keys = self.keys[slots[left]]
            hit = keys == codes[left]
            out[left[hit]] = self.rows[slots[left[hit]]]
            left = left[~hit & (keys != -1)]
        return out


class Trees:
    """Code lengths of all learnt languages: per order the cost of each known successor and of each escape."""

    def __init__(self, counts: pd.DataFrame, order: int = ORDER):
        """``counts``: lang, level (0 to order), code, n."""
        self.order = order
        self.langs = sorted(counts["lang"].unique().tolist())
        width, place = len(self.langs), {lang: n for n, lang in enumerate(self.langs)}
        self.finds, self.costs, self.contexts, self.escapes = [], [], [], []
        lower = np.full((width, 1), 8.0)
        lower_codes = None
        for level in range(order + 1):
            own = counts[counts["level"] == level]
            codes, row = np.unique(own["code"].to_numpy(np.int64), return_inverse=True)
            n = np.zeros((width, len(codes)))
            n[own["lang"].map(place).to_numpy(np.int64), row] = own["n"]
            contexts, of = np.unique(codes >> 8, return_inverse=True)
            total, kinds = np.zeros((width, len(contexts))), np.zeros((width, len(contexts)))
            for lang in range(width):
                total[lang] = np.bincount(of, n[lang], len(contexts))
                kinds[lang] = np.bincount(of, n[lang] > 0, len(contexts))
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                seen = -np.log2(n / (total + kinds)[:, of])
            if lower_codes is not None:
                lower = lower[:, np.searchsorted(lower_codes, codes & ((1 << 8 * level) - 1))]
            lower = np.where(n > 0, seen, escape[:, of] + lower)
            lower_codes = codes
            self.finds.append(Table(codes))
            self.costs.append(lower.astype(np.float32))
            self.contexts.append(Table(contexts))
            self.escapes.append(escape.astype(np.float32))

    def bits(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Code lengths (texts, languages) of pieces of ``data``; piece i is the bytes from starts[i] on, and the first
        ``order`` of them are only context."""
        codes = codes_of(data, self.order)
        ends = np.append(starts[1:], len(data)) - self.order
        text = np.repeat(np.arange(len(starts)), ends - starts)
        codes = codes[np.arange(len(text)) + np.repeat(starts - np.concatenate(([0], np.cumsum(ends - starts)[:-1])), ends - starts)]
        out = np.zeros((len(starts), len(self.langs)))
        for level in range(self.order, -1, -1):
            rows = self.finds[level].find(codes)
            hit = rows >= 0
            known, where = rows[hit], text[hit]
            for lang in range(len(self.langs)):
                out[:, lang] += np.bincount(where, self.costs[level][lang][known], len(starts))
            if hit.all():
                return out
            codes, text = codes[~hit], text[~hit]
            rows = self.contexts[level].find(codes >> 8)
            known, where = rows[rows >= 0], text[rows >= 0]
            for lang in range(len(self.langs)):
                out[:, lang] += np.bincount(where, self.escapes[level][lang][known], len(starts))
            codes = codes & ((1 << 8 * level) - 1) if level else codes
        return out + 8.0 * np.bincount(text, minlength=len(starts))[:, None]

    def score(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and posterior probability (all languages alike beforehand) of each text."""
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        window, before = max(1 << 12, WINDOW // len(self.langs)), lead(self.order)
        totals = np.zeros((len(texts), len(self.langs)))
        pieces, owners, size = [], [], 0

        def flush() -> None:
            nonlocal pieces, owners, size
            if pieces:
                starts = np.cumsum([0, *map(len, pieces)])[:-1]
                np.add.at(totals, owners, self.bits(np.frombuffer(b"".join(pieces), np.uint8), starts))
            pieces, owners, size = [], [], 0

        for n, text in enumerate(texts):
            data = before + (text or "").encode()
            for at in range(0, len(data) - self.order, window):
                pieces.append(data[at:at + window + self.order])
                owners.append(n)
                size += len(pieces[-1])
                if size >= window:
                    flush()
        flush()
        best = totals.argmin(1)
        score = 1 / np.exp2(totals.min(1)[:, None] - totals).sum(1)
        letters = [any(c.isalpha() for c in text or "") for text in texts]
        return ([self.langs[b] if has else UNKNOWN for b, has in zip(best, letters)],
                [float(s) if has else 0.0 for s, has in zip(score, letters)])


def held_out(ident: Column) -> Column:
    """Documents that are not learnt from; a null id is never one of them."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
          sample: int = SAMPLE) -> Trees:
    """Trees from the rows of ``docs`` that are not held out and have an id, a text and a language."""
    ident = F.col(id_col).cast("string")
    rows = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(F.col(id_col)))
    sizes = rows.groupBy(lang_col).agg(F.count("*").alias("rows")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    shares = F.create_map(*[F.lit(x) for row in sizes for x in (row[0], min(1.0, sample / row[1]))]) if sizes else None
    spot = F.pmod(F.xxhash64(ident), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = (rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), spot.alias("spot"))
              .where("text is not null").where(F.col("spot") < shares[F.col("lang")] if sizes else F.lit(False)).select("lang", "text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = lead(order)
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                codes = np.concatenate([codes_of(np.frombuffer(before + t.encode(), np.uint8), order) for t in texts])
                for level in range(order + 1):
                    own, n = np.unique(codes & ((1 << 8 * (level + 1)) - 1), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "level": level, "code": own, "n": n})

    counted = chosen.mapInPandas(count, "lang string, level int, code long, n long").groupBy("lang", "level", "code").agg(F.sum("n").alias("n"))
    return Trees(counted.toArrow().to_pandas(), order)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
             sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 where the text is null, empty or without a letter, or where nothing could be learnt; ties go to
    the first language by code point; repeated rows get the same answer; an empty table gives no rows. Only ``text`` is
    an input of a prediction; texts of any length are coded whole."""
    trees = docs.sparkSession.sparkContext.broadcast(learn(docs, id_col, text_col, lang_col, order, sample))
    schema = T.StructType([docs.schema[id_col], T.StructField("text", T.StringType())])
    out = T.StructType([T.StructField("doc_id", schema[0].dataType), T.StructField("held_out", T.BooleanType()),
                        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lang, score = trees.value.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=out.names)

    return docs.select(F.col(id_col), held_out(F.col(id_col)), F.col(text_col)).mapInArrow(run, out)
