"""Mixing beside the resharing rule and a running sum by hand; packing as a round trip through the tokenizer."""

import random
import zlib
from collections import Counter, defaultdict
from math import floor

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from leadmill.llm import mixing, packing
from tests.llm.fixtures import awkward, table, words

PATH = public_tokenizers.path("word_bpe_49k.json")


def reshared(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by the rule as written: share by weight, cut at the cap, share the excess among the rest, and so on."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        over = 0.0
        for s in sorted(open_, key=str):
            target[s] += left * weight[s] / total
        for s in sorted(open_, key=str):
            if target[s] >= cap * sizes[s]:
                over += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
        left = over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{n}": rng.choice([0, 3, 10, 500, 9000, 100000]) for n in range(rng.randint(1, 14))} | ({None: 70} if seed % 2 else {})
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = reshared(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_plan(spark):
    rng = random.Random(5)
    rows = awkward() + [(1000 + n, "w " * int(rng.paretovariate(1) * 5 % 3000), "en", f"s{n % 5 % 4}", 1) for n in range(600)]
    docs = table(spark, rows)
    plan = [r.asDict() for r in mixing.mix_plan(docs).collect()]
    assert Counter(r["doc_id"] for r in plan) == Counter(r[0] for r in rows)
    size = lambda t: len((t or "").encode().split())
    totals = defaultdict(int)
    for r in rows:
        totals[r[3]] += size(r[1])
    want = reshared(totals)
    for s, total in totals.items():
        own = [r for r in plan if r["source"] == s]
        assert {r["source_size"] for r in own} == {total} and all(abs(r["target"] - want[s]) < 1e-6 for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(r["size"] for r in own)
        # the same copies from a running sum by hand
        at, rate = 0.0, want[s] / total if total else 0.0
        offset = spark.range(1).select(F.pmod(F.xxhash64(F.lit(mixing.SEED), F.lit("n" if s is None else "s" + s)), F.lit(1 << 30))).first()[0] / float(1 << 30)
        copies = [floor(offset + (n + 1) * rate) - floor(offset + n * rate) for n in range(len(own))]
        assert sorted(copies) == sorted(r["copies"] for r in own)
        assert sum(r["taken"] for r in own) == sum(c * r["size"] for c, r in zip(copies, sorted(own, key=lambda r: r["size"]))) or len({r["size"] for r in own}) < len(own)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in plan)
    again = [r.asDict() for r in mixing.mix_plan(docs.repartition(7)).collect()]
    key = lambda r: tuple((v is None, v) for v in r.values())
    assert sorted(plan, key=key) == sorted(again, key=key)


def test_copies_of_one_row(spark):
    """A row that makes up most of its source is taken as often as its size asks, whatever range its copies fall into."""
    rows = [(n, words(random.Random(n), 5 + n % 9), "en", "s0", 1) for n in range(60)] + [(99, "a b c d e f g", "en", "s0", 1)] * 900
    docs = table(spark, rows)
    plans = [mixing.mix_plan(d, keys=k).select("doc_id", "size", "target", "copies").collect() for d, k in ((docs, False), (docs.repartition(9), True))]
    for plan in plans:
        taken = sum(r.copies * r.size for r in plan)
        assert len(plan) == len(rows) and abs(taken - plan[0].target) <= 13 and max(r.copies for r in plan) <= 2
    count = lambda plan: Counter(r.copies for r in plan if r.doc_id == 99)
    assert count(plans[0]) == count(plans[1])
    assert mixing.mix(docs).where("doc_id = 99").count() == sum(r.copies for r in plans[0] if r.doc_id == 99)


def test_mix_gives_whole_rows(spark):
    docs = table(spark, awkward())
    plan, mixed = mixing.mix_plan(docs), mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == plan.agg(F.sum("copies")).first()[0]
    assert mixed.select("doc_id", "text").distinct().exceptAll(docs.select("doc_id", "text").distinct()).count() == 0
    assert mixing.mix_plan(table(spark, [])).count() == 0 and mixing.mix(table(spark, [])).count() == 0


def test_words_apart_equal_whole_texts():
    rng = random.Random(3)
    alphabet = [chr(c) for c in range(1, 256)] + list("   \n\tabcdeE'''stmlrvd.,!?0123<|>") * 6 + ["<|endoftext|>", "Σ", "日", "é", "İ"]
    encoder, whole = packing.Encoder(PATH), packing.Encoder(PATH, whole=True)
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        assert encoder.encode(text) == whole.encode(text), repr(text)


@pytest.mark.parametrize("row_tokens", [50, packing.ROW_TOKENS])
def test_round_trip(spark, row_tokens):
    rows = awkward()
    docs = table(spark, rows).repartition(3)
    pieces = [r.asDict() for r in packing.pack(docs, PATH, length=256, row_tokens=row_tokens).collect()]
    stream, place = b"", 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert (p["sequence_id"], p["offset"]) == divmod(place, 256) and 0 < p["length"] <= 256 - p["offset"]
        assert len(p["ids"]) == 4 * p["length"]
        place += p["length"]
        stream += bytes(p["ids"])
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (2,)) for r in rows)
    found, at = Counter(), 0
    ordered = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    while at < len(ordered):
        ids, n, first = b"", 0, ordered[at]
        while n < first["doc_tokens"]:
            p = ordered[at]
            assert (p["doc_id"], p["start"], p["doc_tokens"]) == (first["doc_id"], n, first["doc_tokens"])
            ids, n, at = ids + bytes(p["ids"]), n + p["length"], at + 1
        found[(first["doc_id"], tuple(int.from_bytes(ids[k:k + 4], "little") for k in range(0, len(ids), 4)))] += 1
    assert found == want
    assert packing.pack(table(spark, []), PATH).count() == 0


def test_query_digests(spark):
    from leadmill.llm.queries import op7_packing

    rows = op7_packing(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(PATH)
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [2]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(b"".join(n.to_bytes(4, "little") for n in ids[r.start:r.start + r.length]))
    assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())
