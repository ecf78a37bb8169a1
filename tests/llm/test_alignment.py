"""Alignment of two tokenizers beside a plain version, whole, cut into ranges, and with every pair joined by shuffle."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leadmill.llm import alignment, queries, tokens
from tests.llm.fixtures import awkward, table

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b ", " a", "a\nb", "a\n b\n\nc \n d", "x", "two\t\twords", "a▁b", "\x00x", "<s>hi</s> <|endoftext|> it's", "ﬁ１ 日本 語", "😀 ok", "né", "x" * 3000, "of the  house"]


@pytest.fixture(scope="module")
def pair():
    import sentencepiece

    first, second = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    first.encode_special_tokens = True
    spelt = tokens.byte_characters()
    inverse = {i: bytes(spelt[c] for c in t) for t, i in first.get_vocab().items() if all(c in spelt for c in t)}

    def plain(text):
        """(groups, Counter of links, n_a, n_b, n_groups) by walking both lists of tokens."""
        if not text:
            return "", Counter(), 0, 0, 0
        whole, a, b = (" " + text).encode(), first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        pieces = [second.id_to_piece(i) for i in b]
        spans = [[inverse[i] for i in a], [bytes([int(p[3:-1], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]]
        if any(b"".join(s) != whole for s in spans):
            return "", Counter(), 0, 0, 0
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in spans]
        common = sorted(set(ends[0]) & set(ends[1]))
        lists, links, low = [], Counter(), 0
        for high in common:
            own = [[(i, e) for i, e in zip(ids, at) if low < e <= high] for ids, at in zip((a, b), ends)]
            lists.append("|".join(",".join(str(i) for i, _ in side) for side in own))
            starts = [[low, *[e for _, e in side[:-1]]] for side in own]
            for (i, e), s in zip(own[0], starts[0]):
                for (j, f), t in zip(own[1], starts[1]):
                    links[i, j] += s < f and t < e
            low = high
        return ";".join(lists), +links, len(a), len(b), len(common)

    return plain


def expected(rows, plain):
    made = [(r[0], *plain(r[1])) for r in rows]
    counts = Counter(p for m in made for p in m[2])
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    return Counter((ident, n_a, n_b, n_groups, sum(links.values()), sum(k for p, k in links.items() if counts[p] == best[p[0]]),
                    sum(k * counts[p] for p, k in links.items()), groups) for ident, groups, links, n_a, n_b, n_groups in made)


@pytest.mark.parametrize("options", [{}, {"size": 50}, {"size": 700, "common": 3}, {"common": 1 << 30}])
def test_beside_plain_version(spark, pair, options):
    rows = [r for r in awkward() if not r[1] or len(r[1]) < 20_000] + [(500 + n, t, "en", "s", 1) for n, t in enumerate(ODD)]
    got = alignment.align(table(spark, rows), *PATHS, **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    ordered = got.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert Counter(tuple(r) for r in ordered.collect()) == expected(rows, pair)


def test_very_long_document(spark, pair):
    """A document of many windows and ranges equals the same text in one range, and one without any cut is whole too."""
    rows = [r for r in awkward() if r[1] and len(r[1]) > 100_000] + [(600, "ab" * 4000, "en", "s", 1)]
    small, large = (alignment.align(table(spark, rows, clashes=False), *PATHS, size=size).orderBy("doc_id").collect() for size in (1000, 1 << 30))
    assert small == large and small[0]["n_a"] > 20_000
    assert small[1]["groups"] == pair("ab" * 4000)[0]


def test_empty_table(spark):
    assert alignment.align(table(spark, [], clashes=False), *PATHS).count() == 0


def test_joining_is_associative():
    own = alignment.aligner(PATHS)
    text, rng = awkward()[0][1] + " " + "xyzzy" * 30 + " straße, naïveté!", random.Random(3)
    whole = own.tokens(text)
    for _ in range(30):
        cuts = sorted(rng.sample(range(1, int(whole.ends_a[-1])), 5))
        parts = [own.fragment(whole.between(low, high)) for low, high in zip([0, *cuts], [*cuts, 1 << 40])]
        while len(parts) > 1:
            n = rng.randrange(len(parts) - 1)
            parts[n:n + 2] = [own.join(parts[n], parts[n + 1])]
        groups, pairs, counts = own.finish(parts[0])
        want = own.finish(own.fragment(whole))
        assert groups == want[0] and (pairs == want[1]).all() and (counts == want[2]).all()


def test_one_python_worker_per_task(spark):
    """No step in Python feeds another one in the same task, each of which would hold both vocabularies."""
    rows = [(1, "short text", "en", "s", 1), (2, "a long text " * 300, "en", "s", 1)]
    df = alignment.aligned(table(spark, rows, clashes=False), *PATHS, size=50)
    nodes = [(m.end(), m.string[m.end():]) for m in (re.match(r"[ :+|-]*", line) for line in df._jdf.queryExecution().executedPlan().toString().splitlines())]
    above, steps = [], 0
    for depth, name in nodes:
        above = [x for x in above if x[0] < depth]
        if name.startswith("Exchange"):
            above.append((depth, False))
        if re.match("MapInArrow|FlatMapGroupsInArrow", name):
            steps += 1
            assert not (above and above[-1][1]), name
            above.append((depth, True))
    assert steps > 2


def test_remembered_words_are_bounded_by_bytes(pair, monkeypatch):
    own, rng = alignment.aligner(PATHS), random.Random(5)
    own.known.clear()
    monkeypatch.setattr(alignment, "WORDS_BYTES", 1 << 16, raising=False)
    for _ in range(20):
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(2000)) for _ in range(5))
        groups, pairs, counts = own.documents([text])[0]
        want = pair(text)
        assert groups[:-1].decode() == want[0] and Counter((int(p) >> 32, int(p) & (1 << 32) - 1) for p in pairs) == want[1] and counts.tolist() == list(want[2:])
    assert sum(len(word) + len(x[0]) + len(x[1]) for word, x in own.known.items()) < 1 << 18
    own.forget()
    assert not own.known and not own.known_bytes


def test_portions_are_bounded():
    batch = pa.record_batch({"n": list(range(1000))})
    for sizes, most in (([1] * 1000, 100), ([0] * 1000, 5), ([50, None, 3, 9] * 250, 10), ([7] * 1000, 1 << 30)):
        parts = list(alignment._portions(batch, pa.array(sizes, pa.int32()), most))
        assert pa.Table.from_batches(parts).column("n").to_pylist() == list(range(1000))
        at = 0
        for part in parts:
            own = [x or 0 for x in sizes[at:at + part.num_rows]]
            assert len(own) <= alignment.ROWS and (len(own) == 1 or sum(own) <= most)
            at += len(own)
    assert not list(alignment._portions(batch.slice(0, 0), pa.array([], pa.int32()), 5))


def test_query(spark, pair):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    hashed = Counter((*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in expected(rows, pair).elements())
    got = queries.op11_alignment(spark, folder).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert Counter(tuple(r) for r in got.collect()) == hashed
    assert dict(got.dtypes)["n_best"] == "bigint" and got.where(F.col("count_sum").isNull()).count() == 0
