"""Certified packing as a round trip through the tokenizer; bounds beside packings found by trying all."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadmill.llm import certified_packing as packing
from leadmill.llm import queries
from leadmill.llm.tokens import ByteLevel
from tests.llm.fixtures import awkward, table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(sizes, capacity):
    """The fewest bins, by trying every bin for every size."""
    best = [len(sizes)]

    def place(left, bins):
        if len(bins) >= best[0]:
            return
        if not left:
            best[0] = len(bins)
            return
        for n, used in enumerate(bins):
            if used + left[0] <= capacity and used not in bins[:n]:
                place(left[1:], [*bins[:n], used + left[0], *bins[n + 1:]])
        place(left[1:], [*bins, left[0]])

    place(sorted(sizes, reverse=True), [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_bound_and_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([6, 10, 17, 30])
    sizes = [rng.randint(1, capacity) if seed % 2 else rng.randint(capacity // 4 + 1, capacity // 2 + 1) for _ in range(9)]
    bound, best = packing.lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity), fewest(sizes, capacity)
    bins = packing.best_fit_decreasing(sizes, capacity)
    used = Counter()
    for n, s in zip(bins, sizes):
        used[n] += s
    assert max(used.values()) <= capacity and sorted(used) == list(range(len(used)))
    assert -(-sum(sizes) // capacity) <= bound <= best <= len(used)


def test_bound_sees_more_than_the_sum():
    assert packing.lower_bound(np.bincount([6] * 9, minlength=11), 10) == 9  # each beyond half
    assert packing.lower_bound(np.bincount([4] * 9, minlength=11), 10) == 5  # two to a bin
    assert packing.lower_bound(np.zeros(11, int), 10) == 0


def check(docs, rows, length):
    """Every id in one piece, sequences gapless and within ``length``; returns the number of sequences."""
    own = Tokenizer.from_file(PATH)
    stock = defaultdict(Counter)
    for ident, text in docs:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % length + 1
        starts = [0, *range(first, len(ids), length)]
        cut = [ids[s:e] for s, e in zip(starts, [*starts[1:], len(ids)])]
        stock[ident].update((n, s, len(c), np.array(c, "<u4").tobytes()) for n, (s, c) in enumerate(zip(starts, cut)))
    got = defaultdict(Counter)
    for r in rows:
        got[r["doc_id"]][r["piece"], r["start"], r["length"], bytes(r["ids"])] += 1
    assert got == stock
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        at = 0
        for offset, size in sorted(placed):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


@pytest.mark.parametrize("options", [{}, {"length": 64, "group": 4}, {"length": 16, "group": 5, "rounds": 0}])
def test_round_trip(spark, options):
    rows = awkward() + [(700, "before <|endoftext|> after", "en", "s", 1), (701, " \n two  spaces \n", "en", "s", 1)]
    made = packing.pack(table(spark, rows), PATH, **options)
    assert made.columns == ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"]
    check([(r[0], r[1]) for r in rows], made.collect(), options.get("length", 1024))


def test_exchange_saves_sequences(spark):
    rng = random.Random(8)
    items = spark.createDataFrame([(n, rng.choice([3, 7, 20, 31, 33, 40, 50])) for n in range(900)], "item long, size long")
    counts = {}
    for group, rounds in ((30, 0), (30, 8), (900, 8)):
        made = packing.repack(items, 64, group=group, rounds=rounds).collect()
        used = Counter()
        for r in made:
            used[r["round"], r["group"], r["bin"]] += r["size"]
        assert len(made) == 900 and len({r["item"] for r in made}) == 900 and max(used.values()) <= 64
        counts[group, rounds] = len(used)
    sizes = [r["size"] for r in items.collect()]
    bound = packing.lower_bound(np.bincount(sizes, minlength=65), 64)
    assert bound == counts[900, 8] <= counts[30, 8] < counts[30, 0]


def test_empty_table(spark):
    assert packing.pack(table(spark, [], clashes=False), PATH).count() == 0


def test_ids_are_the_tokenizers():
    own, exact = ByteLevel(PATH, marks=True), Tokenizer.from_file(PATH)
    texts = [r[1] or "" for r in awkward()] + ["a  b ", " a", "x\n\n y\t", "it's we'll DON'T", "ⅷ ³ ｶ 😀", "\x1c\x1d \x85   x", "Ⴀ ꟊ", "a<|endoftext|>b", "​‐⁠", "café", "café"]
    assert [own.ids(t) for t in texts] == [exact.encode(t, add_special_tokens=False).ids for t in texts]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    whole = [r.asDict() for r in packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect()]
    sequences = check(docs, whole, 1024)
    got = queries.op12_certified_packing(spark, folder).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in whole)
    sizes = [r["length"] for r in whole]
    assert len({r["sequence_id"] for r in got}) == sequences <= packing.lower_bound(np.bincount(sizes, minlength=1025), 1024) + 1
