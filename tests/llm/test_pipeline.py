"""The pipeline stage by stage beside brute force over the smallest data."""

from collections import Counter, defaultdict

import corpus_pipeline
from leadmill.llm import common, mixing, quality_rules
from tests.llm.fixtures import awkward, table
from tests.llm.test_duplicates import naive_fingerprint, roots_of

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def chain(spark, docs, folder=FOLDER):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(common.stash(stage(spark, out[-1], folder), "test"))
    return out


def check(spark, docs):
    start, quality, exact, near, mixed, packed = chain(spark, docs)
    assert all(df.columns == docs.columns for df in (quality, exact, near, mixed))
    want = []
    for r in rows_of(start):
        *_, kept, cleaned = quality_rules.judge(r["text"])
        if kept:
            want.append(r | {"text": cleaned, "n_chars": len(cleaned)})
    freeze = lambda rows: Counter(tuple(sorted(r.items(), key=lambda x: x[0])) for r in rows)
    assert freeze(rows_of(quality)) == freeze(want)
    plain = lambda t: "".join((t or "").split(" ")).translate(dict.fromkeys(range(9, 14)))
    classes = defaultdict(list)
    for r in want:
        classes[plain(r["text"])].append(r)
    none_last = lambda r: (-len(r["text"]), r["doc_id"] is None, r["doc_id"] or 0)
    stay = rows_of(exact)
    assert len(stay) == len(classes)
    assert all(none_last(r) == min(map(none_last, classes[plain(r["text"])])) for r in stay)
    prints = [naive_fingerprint(r["text"]) for r in stay]
    nodes = sorted(set(prints))
    root = roots_of(nodes, [(a, b) for n, a in enumerate(nodes) for b in nodes[:n] if (a ^ b).bit_count() <= 3])
    groups = defaultdict(list)
    for r, p in zip(stay, prints):
        groups[root[p]].append((r["doc_id"] is None, r["doc_id"] or 0))
    left = rows_of(near)
    assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in left) == Counter(min(g) for g in groups.values())
    plan = rows_of(mixing.mix_plan(near))
    ids = Counter(r["doc_id"] for r in rows_of(mixed))
    for r in plan:
        assert ids[r["doc_id"]] == sum(p["copies"] for p in plan if p["doc_id"] == r["doc_id"])
    pieces = rows_of(packed)
    assert sum(p["start"] == 0 for p in pieces) == sum(ids.values())
    assert Counter(p["doc_id"] for p in pieces if p["start"] == 0) == ids


def test_stages_on_given_documents(spark):
    check(spark, common.table(spark, FOLDER, "documents"))


def test_stages_on_awkward_rows(spark):
    check(spark, table(spark, awkward()))


def test_run_gives_pieces(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.count() > 100 and got.selectExpr("max(length)").first()[0] <= 4096
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark):
    assert chain(spark, table(spark, []))[-1].count() == 0
