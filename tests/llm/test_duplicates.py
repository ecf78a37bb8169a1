"""Exact copies beside SQL, fingerprints and links beside brute force."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from leadmill.llm import exact_dedup, simhash_index
from leadmill.llm.components import components
from tests.llm.fixtures import awkward, table


def sql(text, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(text).df()


@pytest.mark.parametrize("max_bits", [exact_dedup.MAX_BITS, 64])
def test_exact_copies_match_sql(spark, max_bits):
    docs = table(spark, awkward())
    got = Counter(map(tuple, exact_dedup.exact_copies(docs, max_bits=max_bits).collect()))
    want = sql(exact_dedup.COPIES_SQL, documents=docs.toPandas().astype({"doc_id": "Int64"}))
    none = lambda x: None if x is None or x != x else int(x)
    assert got == Counter((none(r.doc_id), none(r.keep_id), int(r.group_size), bool(r.kept), r.text_sha256) for r in want.astype({"doc_id": object, "keep_id": object}).replace({np.nan: None}).itertuples())
    assert sum(got.values()) == len(awkward())


def test_kept_rows_are_whole(spark):
    docs = table(spark, awkward())
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == exact_dedup.exact_copies(docs).where("kept").count()
    assert kept.exceptAll(docs).count() == 0


def naive_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[n:n + 3]) for n in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "A b c", "a b c a b c a b c", "É x \x1f y z", "the cat sat on the mat the cat sat"])
def test_fingerprint(text):
    assert simhash_index.fingerprint(text) % (1 << 64) == naive_fingerprint(text)


def roots_of(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def clustered(seed, n=400):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    out = set(centres)
    while len(out) < n:
        x = rng.choice(centres) if rng.random() < 0.7 else rng.choice(sorted(out)[:50])
        for _ in range(rng.randint(1, 6)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return [x - (1 << 64) if x >> 63 else x for x in out]


@pytest.mark.parametrize("long_list", [1, 5, 1024])
def test_links_give_the_components_of_all_pairs(spark, long_list):
    prints = clustered(3)
    pairs = [(a, b) for n, a in enumerate(prints) for b in prints[:n] if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3]
    links = simhash_index.links(spark.createDataFrame([(p,) for p in prints], "bits long"), long_list)
    found = [tuple(r) for r in links.collect()]
    assert all(bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3 for a, b in found)
    assert roots_of(prints, found) == roots_of(prints, pairs) and len(pairs) > 300
    if long_list == 1024:
        assert {tuple(sorted(p)) for p in found} == {tuple(sorted(p)) for p in pairs}


def test_links_of_lists_that_stay_long(spark):
    """All fingerprints agree in five bytes, so that every finer list of these stays long."""
    rng = random.Random(8)
    prints = sorted({0x1234567890 << 24 | rng.choice([0, 0xABCDEF, 0x0F0F0F]) ^ sum(1 << rng.randrange(24) for _ in range(rng.randint(0, 5))) & 0xFFFFFF for _ in range(300)})
    pairs = [(a, b) for n, a in enumerate(prints) for b in prints[:n] if (a ^ b).bit_count() <= 3]
    frame = spark.createDataFrame([(p,) for p in prints], "bits long")
    for long_list in (20, 120):
        found = [tuple(r) for r in simhash_index.links(frame, long_list).collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in found)
        assert roots_of(prints, found) == roots_of(prints, pairs) and len(pairs) > 300


def test_pairs_with_five_shared_bytes_meet_in_finer_lists(spark):
    rng = random.Random(9)
    a = rng.getrandbits(62)
    near = [a ^ sum(rng.randrange(1, 256) << 8 * p for p in rng.sample(range(7), rng.randint(1, 3))) for _ in range(40)]
    tally = simhash_index.shared_bytes(np.array(near, np.int64), np.int64(a))
    assert tally.tolist() == [sum(x >> 8 * p & 255 == a >> 8 * p & 255 for p in range(8)) for x in near]
    rows = simhash_index.finer_index(simhash_index.index(spark.createDataFrame([(p,) for p in {a, *near}], "bits long"))).collect()
    lists = defaultdict(set)
    for r in rows:
        lists[r.bits].add(r.list)
    assert all(lists[a] & lists[x] for x in near) and max(Counter(map(tuple, rows)).values()) == 1


def test_components_of_a_chain_and_stars(spark):
    edges = [(n, n + 1) for n in range(100)] + [(200, n) for n in range(201, 240)] + [(300, 301), (301, 300), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {**{n: 0 for n in range(101)}, **{n: 200 for n in range(200, 240)}, 300: 300, 301: 300}


def test_near_duplicates(spark):
    rows = awkward()
    docs = table(spark, rows)
    got = [tuple(r) for r in simhash_index.near_duplicates(docs).collect()]
    assert len(got) == len(rows)
    prints = {r: naive_fingerprint(r[1]) for r in rows}
    nodes = sorted(set(prints.values()))
    root = roots_of(nodes, [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3])
    ids = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            ids[root[prints[r]]].append(r[0])
    want = Counter((r[0], f"{prints[r]:016x}", min(ids[root[prints[r]]], default=None)) for r in rows)
    assert Counter(got) == want
    kept = simhash_index.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(root[p] for p in prints.values()))
    assert kept.exceptAll(docs).count() == 0


def test_empty_tables(spark):
    docs = table(spark, [])
    assert exact_dedup.exact_copies(docs).count() == 0 and exact_dedup.drop_exact_copies(docs).count() == 0
    assert simhash_index.near_duplicates(docs).count() == 0 and simhash_index.drop_near_duplicates(docs).count() == 0
