"""Toxicity by a classifier chain: linear models for one category after the other, each reading the words of a text and
the probabilities of all categories before it.

Labels only say whether a document is toxic; the categories before the last are made from that label and fixed lists of
words. Later models are trained with the earlier categories' out-of-fold probabilities, so that they learn how sure those
models are on texts they have not seen. All models are fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that tell the categories of toxic documents apart.
INSULTS = frozenset("clown fool idiot jerk loser moron stupid".split())
CONTEMPT = frozenset("disgusting filth pathetic scum trash vermin worthless".split())
SEVERE_WORDS = 3
CATEGORIES = ("insult", "contempt", "severe", "toxic")
#: Labelled documents learnt from, by hash of the id: at most so many toxic and so many other ones.
SAMPLE_TOXIC, SAMPLE_OTHER = 1500, 3000
#: A word is a feature if at least so many documents of the sample have it and its share of toxic ones is so many
#: standard deviations off.
MIN_DOCS, MIN_DEVIATION = 3, 3.0
FOLDS = 3
STEPS = 100
RIDGE = 1e-3
THRESHOLD = 0.4
#: Beginnings of words that are features besides whole words, in bytes.
STEMS = (4, 5)
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> set[bytes]:
    """Different words of a text: runs of ASCII letters, lower-cased, and of all characters beyond ASCII."""
    return set((text or "").encode().translate(_PLAIN).split())


def features_of(words: set[bytes]) -> set[bytes]:
    """The words and, marked as such, their beginnings, which also tell inflected and disguised forms."""
    return words.union(*({w[:n] + b"-" for w in words if len(w) > n} for n in STEMS))


def categories(words: set[bytes], toxic: bool) -> list[bool]:
    """Labels of CATEGORIES for a labelled document."""
    said = {w.decode(errors="ignore") for w in words}
    insults, contempt = len(said & INSULTS), len(said & CONTEMPT)
    return [toxic and insults > 0, toxic and contempt > 0, toxic and insults + contempt >= SEVERE_WORDS, toxic]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_linear(rows: np.ndarray, columns: np.ndarray, extra: np.ndarray, y: np.ndarray, features: int) -> np.ndarray:
    """Weights of a logistic model, words first, then ``extra`` and a constant; ``rows`` and ``columns`` are the sparse
    entries, all 1. Adam over all rows with a ridge penalty."""
    dense = np.column_stack([extra, np.ones(len(y))])
    w, m, v = (np.zeros(features + dense.shape[1]) for _ in range(3))
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, w[columns], len(y)) + dense @ w[features:]
        error = (sigmoid(z) - y) / max(1, len(y))
        g = np.concatenate([np.bincount(columns, error[rows], features), dense.T @ error]) + RIDGE * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w


class Chain:
    """The fitted chain: word numbers and one weight vector per category."""

    def __init__(self, texts: list[set[bytes]], toxic: list[bool], folds: int = FOLDS):
        features = list(map(features_of, texts))
        counts = Counter(w for own in features for w in own)
        hits = Counter(w for own, bad in zip(features, toxic) if bad for w in own)
        docs, p = len(texts), sum(toxic) / max(1, len(toxic))
        told = [w for w, c in counts.items() if c >= MIN_DOCS and (hits[w] - c * p) ** 2 >= MIN_DEVIATION ** 2 * c * p * (1 - p)]
        self.numbers = {w: n for n, w in enumerate(sorted(told))}
        size = len(self.numbers)
        found = [[self.numbers[w] for w in own if w in self.numbers] for own in features]
        rows = np.repeat(np.arange(docs), [len(f) for f in found]).astype(np.int64)
        columns = np.array([c for f in found for c in f], np.int64)
        labels = np.array([categories(w, t) for w, t in zip(texts, toxic)], float).reshape(docs, len(CATEGORIES))
        fold = np.arange(docs) % folds
        before, self.weights = np.zeros((docs, 0)), []
        for n in range(len(CATEGORIES)):
            y = labels[:, n]
            self.weights.append(fit_linear(rows, columns, before, y, size))
            if n + 1 < len(CATEGORIES):
                out = np.zeros(docs)
                for k in range(folds):
                    train, place = fold != k, np.cumsum(fold != k) - 1
                    own = train[rows]
                    w = fit_linear(place[rows[own]], columns[own], before[train], y[train], size)
                    z = np.bincount(rows, w[columns], docs) + np.column_stack([before, np.ones(docs)]) @ w[size:]
                    out[~train] = sigmoid(z)[~train]
                before = np.column_stack([before, out])

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities (texts, categories), one category after the other."""
        size, docs, get = len(self.numbers), len(texts), self.numbers.get
        found = [[c for w in features_of(words_of(t)) if (c := get(w)) is not None] for t in texts]
        rows = np.repeat(np.arange(docs), [len(f) for f in found]).astype(np.int64)
        columns = np.array([c for f in found for c in f], np.int64)
        out = np.zeros((docs, 0))
        for w in self.weights:
            z = np.bincount(rows, w[columns], docs) + np.column_stack([out, np.ones(docs)]) @ w[size:]
            out = np.column_stack([out, sigmoid(z)])
        return out


def sample_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most_toxic: int, most_other: int) -> tuple[list, list]:
    """(words, toxic) of the sampled labelled documents, at most ``most_toxic`` + ``most_other`` of them."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("spot", F.xxhash64("doc_id"))
    take = lambda kind, n: known.where(kind).orderBy("spot", "doc_id").limit(n)
    chosen = take("toxic = 1", most_toxic).unionByName(take("toxic <> 1", most_other)).select("doc_id", "toxic")
    # Ids meet as text, so that numbers and names both do; of a repeated id Spark keeps the row of the smallest words.
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text")).dropna(subset=["doc_id"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b" ".join(sorted(words_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), batch.column(2)], names=["doc_id", "words", "toxic"])

    chosen = chosen.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    joined = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic").mapInArrow(words, "doc_id string, words binary, toxic int")
    once = joined.groupBy("doc_id").agg(F.min("words").alias("words"), F.max("toxic").alias("toxic"))
    got = sorted(once.toArrow().to_pylist(), key=lambda r: (zlib.crc32(r["doc_id"].encode()), r["doc_id"]))
    return [set(r["words"].split()) for r in got], [r["toxic"] == 1 for r in got]


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
             most_toxic: int = SAMPLE_TOXIC, most_other: int = SAMPLE_OTHER) -> DataFrame:
    """One row per row of ``docs``: doc_id, p_insult, p_contempt, p_severe, p_toxic and ``toxic``.

    A null or empty text has no words, so only the models' constants speak; without labelled documents all probabilities
    are one half and nothing is toxic; repeated rows are scored alike; an empty table gives no rows; other columns are
    not read; texts of any length are read whole."""
    texts, toxic = sample_of(docs, labels, id_col, text_col, most_toxic, most_other)
    chain = docs.sparkSession.sparkContext.broadcast(Chain(texts, toxic))
    names = [f"p_{c}" for c in CATEGORIES]
    out = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType)] + [T.StructField(n, T.DoubleType()) for n in names])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = chain.value.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, n]) for n in range(len(names))]], names=out.names)

    return (docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(score, out)
            .withColumn("toxic", F.col("p_toxic") > threshold))
