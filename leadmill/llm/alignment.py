"""Alignment of two tokenizers by a monoid of text fragments.

A fragment is what a range of a document's bytes knows about the alignment: the tokens up to its first common end (open
prefix), the groups between common ends (closed) and the tokens behind its last one (open suffix). Joining two
neighbours closes one group from the left suffix and the right prefix, and joining is associative, so the fragments of
a very long document are made in many tasks and joined in a tree. A word with the space before it is a closed fragment
of its own wherever a text may be cut there, which is why words are aligned once per worker and then only joined.

Links are counted over all documents: distinct id pairs per document, summed up by pair. The most frequent pairs, at
most ``COMMON`` whatever the corpus, are looked up in the tasks; all others are joined by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.llm.common import stash
from leadmill.llm.tokens import PLAIN, ByteLevel

#: Bytes of a range; longer documents are cut.
RANGE = 1 << 16
#: Fragments joined by one task of the tree.
FAN = 16
#: Pairs with at least this share of all counted pairs are common, so there are at most as many common ones.
COMMON = 1 << 17
#: Texts of which a worker holds the results at once; fewer if they have more bytes, or more pairs, than these.
ROWS = 250
ROWS_BYTES, ROWS_PAIRS = 1 << 21, 1 << 18
#: Words that a worker remembers before it starts anew, and the bytes they may take, about ``WORD_COST`` each beside what they hold.
WORDS_KEPT = 250_000
WORDS_BYTES, WORD_COST = 96 << 20, 256
#: Spaces where a text may not be cut: before white space, or at an end.
LOOSE = re.compile(r" \s").search
#: Where windows of long texts may start: a space between two letters.
CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


@dataclass
class Tokens:
    """Neighbouring tokens of both vocabularies with the document's bytes at which they end."""
    a: np.ndarray
    ends_a: np.ndarray
    b: np.ndarray
    ends_b: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self.parts(), other.parts())))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.ends_a, self.b, self.ends_b

    def between(self, low: int, high: int) -> Tokens:
        """The tokens that end behind ``low`` and not behind ``high``."""
        of_a, of_b = (slice(*np.searchsorted(ends, (low, high), "right")) for ends in (self.ends_a, self.ends_b))
        return Tokens(self.a[of_a], self.ends_a[of_a], self.b[of_b], self.ends_b[of_b])


def no_tokens() -> Tokens:
    return Tokens(*(np.zeros(0, np.int64) for _ in range(4)))


@dataclass
class Fragment:
    """``met``: the range has a common end. Without one all tokens are in ``first``. ``groups`` ends each group with ``;``."""
    met: bool
    first: Tokens
    groups: bytes
    pairs: np.ndarray
    counts: np.ndarray
    last: Tokens


class Aligner:
    """Fragments of texts under two vocabularies, and their joining."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a, self.b = ByteLevel(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: Whether no piece goes on behind a space, so that texts may be cut there.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.size_a = np.zeros(max(self.a.bytes) + 1, np.int64)
        self.size_a[list(self.a.bytes)] = [len(b) for b in self.a.bytes.values()]
        self.size_b = np.array([len(b) for b in self.bytes_b], np.int64)
        #: How an id is written: inside its list, and at the list's end.
        self.spelt = [s for i in range(len(self.size_a)) for s in (b"%d," % i, b"%d|" % i)]
        self.spelt += [s for i in range(len(pieces)) for s in (b"%d," % i, b"%d;" % i)]
        self.width = np.array([len(s) for s in self.spelt], np.int64)
        #: Of a word with a space before it: groups, pairs, tokens of the first vocabulary; None if its bytes do not come back.
        self.known: dict[str, tuple | None] = {}
        self.known_bytes = 0

    def forget(self) -> None:
        self.known.clear()
        self.known_bytes = 0

    def tokens(self, text: str, start: int = 0) -> Tokens | None:
        """Tokens of the space and ``text`` that begin at byte ``start``; None if their bytes are not those of the text."""
        a, b, whole = self.a.ids(" " + text), self.b.encode(text, num_threads=1), (" " + text).encode()
        if b"".join(map(self.bytes_b.__getitem__, b)) != whole or b"".join(map(self.a.bytes.__getitem__, a)) != whole:
            return None
        return self.placed(a, b, start)

    def placed(self, a: Sequence[int], b: Sequence[int], start: int) -> Tokens:
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Tokens(a, start + np.cumsum(self.size_a[a]), b, start + np.cumsum(self.size_b[b]))

    def close(self, t: Tokens) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """Of tokens that start and end together: the text of their groups, where the text of each token ends (in the order
        of the groups), the linked id pairs, and where each link ends. Every stretch between neighbouring ends is one link."""
        common, ends = np.intersect1d(t.ends_a, t.ends_b, assume_unique=True), np.union1d(t.ends_a, t.ends_b)
        pairs = t.a[np.searchsorted(t.ends_a, ends)] << 32 | t.b[np.searchsorted(t.ends_b, ends)]
        of_a, of_b = np.searchsorted(common, t.ends_a), np.searchsorted(common, t.ends_b)
        order = np.empty(len(t.a) + len(t.b), np.int64)
        order[np.arange(len(t.a)) + np.searchsorted(of_b, of_a)] = 2 * t.a + (common[of_a] == t.ends_a)
        order[np.arange(len(t.b)) + np.searchsorted(of_a, of_b, "right")] = 2 * (len(self.size_a) + t.b) + (common[of_b] == t.ends_b)
        return b"".join(map(self.spelt.__getitem__, order.tolist())), np.cumsum(self.width[order]), pairs, ends

    def closed(self, t: Tokens) -> tuple[bytes, np.ndarray, np.ndarray]:
        groups, _, pairs, _ = self.close(t)
        return groups, pairs, np.array([len(t.a), len(t.b), groups.count(b";")])

    def fragment(self, t: Tokens) -> Fragment:
        common = np.intersect1d(t.ends_a, t.ends_b, assume_unique=True)
        if not len(common):
            return Fragment(False, t, b"", np.zeros(0, np.int64), np.zeros(3, np.int64), no_tokens())
        first, last = common[0], common[-1]
        return Fragment(True, t.between(-1, first), *self.closed(t.between(first, last)), t.between(last, np.iinfo(np.int64).max))

    def join(self, x: Fragment, y: Fragment) -> Fragment:
        """The fragment of two neighbouring ranges."""
        if not x.met:
            return Fragment(y.met, x.first + y.first, y.groups, y.pairs, y.counts, y.last)
        if not y.met:
            return Fragment(True, x.first, x.groups, x.pairs, x.counts, x.last + y.first)
        groups, pairs, counts = self.closed(x.last + y.first)
        return Fragment(True, x.first, x.groups + groups + y.groups, np.concatenate([x.pairs, pairs, y.pairs]),
                        x.counts + counts + y.counts, y.last)

    def finish(self, x: Fragment) -> tuple[bytes, np.ndarray, np.ndarray] | None:
        """The groups, pairs and counts of a whole document: its start is a common end, and so must its end be."""
        if not x.met or len(x.last.a) or len(x.last.b):
            return None
        groups, pairs, counts = self.closed(x.first)
        return groups + x.groups, np.concatenate([pairs, x.pairs]), counts + x.counts

    def learn(self, words: list[str]) -> None:
        """Align new words, each with a space before it, in one go: as a text of these words, of which each ends a group."""
        found = self.tokens(" ".join(words))
        if found is None:
            if len(words) == 1:
                self.known[words[0]] = None
                self.known_bytes += WORD_COST + len(words[0].encode())
            for word in words if len(words) > 1 else ():
                self.learn([word])
            return
        groups, written, pairs, ends = self.close(found)
        stops = np.cumsum([1 + len(word.encode()) for word in words])
        n_a, n_b, links = (np.searchsorted(x, stops, "right") for x in (found.ends_a, found.ends_b, ends))
        texts, own, counts, known = written[n_a + n_b - 1].tolist(), pairs.tobytes(), np.diff(n_a, prepend=0).tolist(), self.known
        self.known_bytes += WORD_COST * len(words) + int(stops[-1]) + len(groups) + len(own)
        text = link = 0
        for word, to_text, to_link, count in zip(words, texts, (8 * links).tolist(), counts):
            known[word] = (groups[text:to_text], own[link:to_link], count)
            text, link = to_text, to_link

    def documents(self, texts: Sequence[str | None]) -> list[tuple[bytes, np.ndarray, np.ndarray] | None]:
        """The groups, pairs and counts of each text; None if it has no tokens that give its bytes back."""
        if len(self.known) > WORDS_KEPT or self.known_bytes > WORDS_BYTES:
            self.forget()
        loose = [not self.cuttable or not text or bool(LOOSE(text)) or text[0] == " " or text[-1] == " " for text in texts]
        split = [None if apart else text.split(" ") for text, apart in zip(texts, loose)]
        new = set().union(*filter(None, split)).difference(self.known)
        for kind in (True, False):
            if some := [word for word in new if bool(PLAIN(word)) is kind]:
                self.learn(some)
        return [self.whole(text) if words is None else self.joined(words) for text, words in zip(texts, split)]

    def whole(self, text: str | None) -> tuple[bytes, np.ndarray, np.ndarray] | None:
        found = self.tokens(text) if text else None
        return found and self.finish(self.fragment(found))

    def joined(self, words: list[str]) -> tuple[bytes, np.ndarray, np.ndarray] | None:
        parts = list(map(self.known.__getitem__, words))
        if None in parts:
            return None
        groups, pairs, counts = zip(*parts)
        groups, pairs, n_a = b"".join(groups), np.frombuffer(b"".join(pairs), np.int64), sum(counts)
        n_groups = groups.count(b";")
        return groups, pairs, np.array([n_a, len(pairs) + n_groups - n_a, n_groups])


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(paths: tuple[str, str]) -> Aligner:
    if paths not in _ALIGNERS:
        _ALIGNERS[paths] = Aligner(*paths)
    return _ALIGNERS[paths]


def forget_words() -> None:
    """Workers are used again by later stages, which do not need the words."""
    for own in _ALIGNERS.values():
        own.forget()


def _portions(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of ``batch``: at most ``ROWS``, and of ``sizes`` no more than ``most`` in all, but one row at least."""
    ends, at = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < batch.num_rows:
        full = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
        to = min(at + ROWS, max(at + 1, full), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_OPEN = [f"{side}_{part}" for side in ("first", "last") for part in ("a", "ends_a", "b", "ends_b")]


def _document_type(ident: T.DataType) -> T.StructType:
    return T.StructType([_field("row", T.LongType()), _field("doc_id", ident), *[_field(c, T.LongType()) for c in _COUNTS],
                         _field("groups", T.StringType()), _field("pairs", T.ArrayType(T.LongType())), _field("times", T.ArrayType(T.LongType()))])


def _fragment_type(ident: T.DataType) -> T.StructType:
    return T.StructType([_field("row", T.LongType()), _field("doc_id", ident), _field("range", T.LongType()), _field("at", T.LongType()),
                         _field("sound", T.BooleanType()), _field("met", T.BooleanType()), *[_field(c, T.BinaryType()) for c in _OPEN],
                         _field("groups", T.BinaryType()), _field("pairs", T.BinaryType()), _field("counts", T.BinaryType())])


def _documents(rows: pa.Array, idents: pa.Array, found: list[tuple | None]) -> pa.RecordBatch:
    """Rows of the document type; a document without tokens has zeros, an empty string and no pairs."""
    counts, groups, pairs, times, sizes = [], [], [], [], [0]
    for x in found:
        own, often = np.unique(x[1], return_counts=True) if x else (np.zeros(0, np.int64),) * 2
        counts.append([*x[2].tolist(), len(x[1])] if x else [0] * 4)
        groups.append(x[0][:-1] if x else b"")
        pairs.append(own)
        times.append(often)
        sizes.append(sizes[-1] + len(own))
    offsets = pa.array(sizes, pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())) for x in (pairs, times)]
    columns = [pa.array([c[n] for c in counts], pa.int64()) for n in range(4)]
    return pa.RecordBatch.from_arrays([rows, idents, *columns, pa.array(groups, pa.binary()).cast(pa.string()), *lists],
                                      names=["row", "doc_id", *_COUNTS, "groups", "pairs", "times"])


def _short(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Documents of one range, aligned where they are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row = aligner(paths), TaskContext.get().partitionId() << 33
        for batch in (part for whole in batches for part in _portions(whole, pc.binary_length(whole.column(1)), ROWS_BYTES)):
            rows = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            yield _documents(rows, batch.column(0), own.documents(batch.column(1).to_pylist()))

    return docs.mapInArrow(run, _document_type(docs.schema["doc_id"].dataType))


def _windows(docs: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """(row, doc_id, at, text): long texts cut where their tokens do not depend on each other, one row per window and
    without the space it starts with; rows count down from -1, apart from those of short documents."""
    out = T.StructType([_field("row", T.LongType()), _field("doc_id", docs.schema["doc_id"].dataType), _field("at", T.LongType()), _field("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, cuttable = -1 - (TaskContext.get().partitionId() << 33), aligner(paths).cuttable
        for batch in (whole.slice(n, 1) for whole in batches for n in range(whole.num_rows)):
            text, place, at, rows = batch.column(1)[0].as_py(), 0, 0, []
            while place <= len(text):
                cut = CUT.search(text, place + size) if cuttable else None
                part = text[place:cut.start() if cut else len(text)]
                rows.append((at, part))
                place, at = (cut.end() if cut else len(text) + 1), at + 1 + len(part.encode())
            yield pa.RecordBatch.from_arrays([pa.array([row] * len(rows), pa.int64()), batch.column(0).take(pa.array([0] * len(rows))),
                                              pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=out.names)
            row -= 1

    return docs.mapInArrow(run, out)


def _write(rows: list[tuple], idents: pa.Array, kind: T.StructType) -> pa.RecordBatch:
    """``rows``: (row, range, at, sound, fragment)."""
    plain = list(zip(*[(row, of, at, sound, x.met) for row, of, at, sound, x in rows]))
    opens = [[p.tobytes() for p in (*x.first.parts(), *x.last.parts())] for *_, x in rows]
    closed = [(x.groups, x.pairs.tobytes(), x.counts.tobytes()) for *_, x in rows]
    columns = [pa.array(plain[0], pa.int64()), idents, pa.array(plain[1], pa.int64()), pa.array(plain[2], pa.int64()), pa.array(plain[3]), pa.array(plain[4])]
    return pa.RecordBatch.from_arrays([*columns, *[pa.array(c, pa.binary()) for c in (*zip(*opens), *zip(*closed))]], names=kind.names)


def _read(row: dict) -> Fragment:
    opens = [np.frombuffer(row[c], np.int64) for c in _OPEN]
    return Fragment(row["met"], Tokens(*opens[:4]), row["groups"], np.frombuffer(row["pairs"], np.int64), np.frombuffer(row["counts"], np.int64), Tokens(*opens[4:]))


def _fragments(windows: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """A row per byte range that a window touches; ``sound`` is false where the tokens do not give the bytes back."""
    out = _fragment_type(windows.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(paths)
        for batch in (whole.slice(n, 1) for whole in batches for n in range(whole.num_rows)):
            row, _, start, text = (batch.column(c)[0].as_py() for c in range(4))
            found = own.tokens(text, start)
            whole, end, rows = found or no_tokens(), start + 1 + len(text.encode()), []
            for of in range(start // size, (end - 1) // size + 1):
                at = max(start, of * size)
                rows.append((row, of, at, found is not None, own.fragment(whole.between(at, (of + 1) * size))))
            yield _write(rows, batch.column(1).take(pa.array([0] * len(rows))), out)

    return windows.repartition("row", "at").mapInArrow(run, out)


def _tree(fragments: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Documents of their fragments: ``FAN`` neighbouring ranges are joined at a time, level by level. The last level
    finishes what it has joined, since a second step in its tasks would take a second Python worker beside each."""
    kind = fragments.schema
    ident = kind["doc_id"].dataType

    def joined(table: pa.Table) -> tuple[dict, pa.Array, bool, Fragment]:
        own, rows = aligner(paths), sorted(table.to_pylist(), key=lambda r: r["at"])
        whole = _read(rows[0])
        for row in rows[1:]:
            whole = own.join(whole, _read(row))
        return rows[0], table.column("doc_id").combine_chunks().slice(0, 1), all(r["sound"] for r in rows), whole

    def level(table: pa.Table) -> pa.Table:
        first, idents, sound, whole = joined(table)
        return pa.Table.from_batches([_write([(first["row"], first["range"] // FAN, first["at"], sound, whole)], idents, kind)])

    def last(table: pa.Table) -> pa.Table:
        first, idents, sound, whole = joined(table)
        found = aligner(paths).finish(whole) if sound else None
        return pa.Table.from_batches([_documents(pa.array([first["row"]], pa.int64()), idents, [found])])

    top = fragments.agg(F.max("range")).first()[0] or 0
    while top >= FAN:
        fragments = fragments.groupBy("row", F.floor(F.col("range") / FAN)).applyInArrow(level, kind)
        top //= FAN
    return fragments.groupBy("row").applyInArrow(last, _document_type(ident))


def _long(docs: DataFrame, paths: tuple[str, str], size: int) -> DataFrame:
    """Documents of many ranges: windows and their fragments in many tasks, then the tree."""
    return _tree(stash(_fragments(stash(_windows(docs, paths, size), "windows"), paths, size), "fragments"), paths)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times), one row per row of ``docs``: the groups as
    ``a1,a2|b1;a3|b2``, the distinct linked pairs as ``a << 32 | b`` and how many links each has in the document."""
    slim, paths = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), (path_a, path_b)
    many = F.octet_length("text") > size
    return _short(slim.where(~F.coalesce(many, F.lit(False))), paths).unionByName(_long(slim.where(many), paths, size))


def align(docs: DataFrame, path_a: str, path_b: str, carry: Sequence[Column] | None = None, common: int = COMMON, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``carry``, columns over the
    text of the groups, by default ``groups`` itself.

    A pair's count is the number of rows that hold it linked. ``n_best`` counts the links whose pair has the highest count
    of its first id, ties included; ``count_sum`` adds the counts of all links. Null and empty texts, and texts whose
    tokens do not give their bytes back, have zeros, an empty text of groups and no part in the counts. Repeated rows are
    rows of their own; an empty table gives no rows; other columns are not read. Texts of any length are whole."""
    carry = [F.col("groups")] if carry is None else list(carry)
    held = stash(aligned(docs, path_a, path_b, **options).select("row", "doc_id", *_COUNTS, *carry, "pairs", "times"), "aligned")
    counts = stash(held.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    best = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))  # a row per id of the first vocabulary
    facts = (counts.withColumn("a", F.shiftright("pair", 32)).join(F.broadcast(best), "a")
             .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    least = (counts.agg(F.sum("n")).first()[0] or 0) / common
    top = facts.where(F.col("n") >= least).toArrow().sort_by("pair")  # at most ``common`` rows
    sent = docs.sparkSession.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))
    out = T.StructType([_field("row", T.LongType()), _field("n_best", T.LongType()), _field("count_sum", T.LongType()),
                        _field("rare", T.ArrayType(T.StructType([_field("pair", T.LongType()), _field("links", T.LongType())])))])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = sent.value
        forget_words()
        for batch in (part for whole in batches for part in _portions(whole, whole.column(1).value_lengths(), ROWS_PAIRS)):
            own, links = (batch.column(c).flatten().to_numpy() for c in (1, 2))
            starts = np.concatenate([[0], np.cumsum(batch.column(1).value_lengths().to_numpy())]).astype(np.int64)
            spot = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            hit = pairs[spot] == own if len(pairs) else np.zeros(len(own), bool)
            def summed(values: np.ndarray) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(values)])[starts])
            known = np.where(hit, links, 0)
            sums = [summed(known * x[spot]) if len(pairs) else np.zeros(batch.num_rows, np.int64) for x in (best, n)]
            rare = pa.StructArray.from_arrays([pa.array(own[~hit]), pa.array(links[~hit])], names=["pair", "links"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(~hit)])[starts], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(s, pa.int64()) for s in sums], pa.ListArray.from_arrays(offsets, rare)], names=out.names)

    marked = stash(held.select("row", "pairs", "times").mapInArrow(look_up, out), "marked")
    rest = (marked.select("row", F.inline("rare")).join(facts.where(F.col("n") < least), "pair")
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("rare_best"), F.sum(F.col("n") * F.col("links")).alias("rare_sum")))
    sums = marked.drop("rare").join(rest, "row", "left")
    added = [(F.col(own) + F.coalesce(F.col(more), F.lit(0))).alias(own) for own, more in (("n_best", "rare_best"), ("count_sum", "rare_sum"))]
    return held.drop("pairs", "times").join(sums.select("row", *added), "row").drop("row")
