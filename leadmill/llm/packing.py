"""Packing: concatenate all documents and cut the stream into fixed windows.

First pass: every task tokenises its documents and numbers the tokens it has written; the partition totals, one row per
task, are summed up into the offset of each partition. Second pass: a document's place in the whole stream is that
offset plus its place in the partition, so windows are cut without moving any row. The pieces are boundary records:
which tokens of which document lie where in which sequence. Only the last sequence has padding.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.common import stash

LENGTH = 4096
END_ID = 2
#: A stored row holds at most so many tokens; longer documents take several.
ROW_TOKENS = 1 << 16
#: Words, and parts of words, whose ids a worker remembers before it starts anew.
WORDS_KEPT, PARTS_KEPT = 250_000, 450_000
#: Texts that a worker holds the ids of at once.
ROWS = 250
#: Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on.
BYTES = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}
#: The tokenizer's own split of a word; parts are encoded apart from each other.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def by_words(text: str) -> bool:
    """Whether a word's ids do not depend on its neighbours: all characters below U+0100, so that normalisation changes
    none, no separators that only Python splits at, and no text of a special token."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "<|" not in text and not any(c in text for c in "\x1c\x1d\x1e\x1f")


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers, remembering the ids of words and their parts."""

    def __init__(self, path: str, whole: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.whole = whole

    def encode(self, text: str) -> bytes:
        if self.whole or not by_words(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        if len(self.parts) > PARTS_KEPT:
            self.parts.clear()
        words = text.lower().split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            self.learn(word for word in words if word not in self.words)
            return b"".join(map(self.words.__getitem__, words))

    def learn(self, words: Iterable[str]) -> None:
        known, parts, tokenise = self.words, self.parts, self.tokenizer.model.tokenize
        for word in words:
            # letters alone, or letters and one mark, are the parts that PARTS would find
            if word.isalpha():
                split = (word,)
            elif word[-1] in ".,!?;:" and word[:-1].isalpha():
                split = (word[:-1], word[-1])
            else:
                split = PARTS.findall(word)
            ids = []
            for part in split:
                own = parts.get(part)
                if own is None:
                    spelt = part.encode().decode("latin-1").translate(BYTES)
                    own = parts[part] = array("I", [token.id for token in tokenise(spelt)]).tobytes()
                ids.append(own)
            known[word] = b"".join(ids)


_ENCODERS: dict[tuple, Encoder] = {}


def tokenise(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
             row_tokens: int = ROW_TOKENS, word_cache: bool = True) -> DataFrame:
    """(doc_id, part, place, start, length, doc_tokens, ids): the ids of each document and the end id, in rows of at most
    ``row_tokens``; ``place`` counts the tokens the task wrote before. ``word_cache`` may only be set for tokenizers that
    lower-case and split at white space."""
    out = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("part", T.IntegerType()),
                        T.StructField("place", T.LongType()), T.StructField("start", T.LongType()),
                        T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
                        T.StructField("ids", T.BinaryType())])
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path, word_cache)
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(path, not word_cache)
        encode, part, place, size = _ENCODERS[key].encode, TaskContext.get().partitionId(), 0, 4 * row_tokens
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            idents, rows = [], []
            for n, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                for at in range(0, len(ids), size):
                    cut = ids[at:at + size]
                    idents.append(n)
                    rows.append((place, at // 4, len(cut) // 4, len(ids) // 4, cut))
                    place += len(cut) // 4
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(idents, pa.int64())), pa.array([part] * len(rows), pa.int32()),
                 *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())], names=out.names)

    return docs.select(id_col, text_col).mapInArrow(run, out)


def pack(docs: DataFrame, path: str, length: int = LENGTH, **options) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset and its ``ids`` (little-endian unsigned
    32-bit). Every token lies in exactly one piece; offsets are gapless from 0 in each sequence.

    Null and empty texts have the end id alone; repeated rows are packed each; an empty table gives no rows; documents of
    any length are cut. Other columns are not read. The order of the stream is that of the input's partitions."""
    tokens = stash(tokenise(docs, path, **options), "tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task of the first pass
    bases = (tokens.groupBy("part").agg(F.sum("length").alias("total"))
             .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    first, size = F.col("first"), F.lit(length)
    placed = (tokens.join(F.broadcast(bases), "part").withColumn("first", F.col("base") + F.col("place"))
              .withColumn("sequence_id", F.explode(F.sequence(F.floor(first / size), F.floor((first + F.col("length") - 1) / size)))))
    begin = F.greatest(first, F.col("sequence_id") * size)
    end = F.least(first + F.col("length"), (F.col("sequence_id") + 1) * size)
    inside = (begin - first).cast("int")
    return placed.select(
        "doc_id", (F.col("start") + inside).alias("start"), (end - begin).alias("length"), "doc_tokens", "sequence_id",
        (begin - F.col("sequence_id") * size).alias("offset"),
        F.substring("ids", inside * 4 + 1, ((end - begin) * 4).cast("int")).alias("ids"))
