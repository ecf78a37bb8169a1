"""Quality rules beside SQL, languages beside a plain coder, toxicity on held-out labels, losses by hand."""

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from leadmill.llm import cross_entropy, language_ppm, quality_rules, toxicity_chain
from leadmill.llm.common import table as read
from tests.llm.fixtures import awkward, table

FOLDER = "/root/testdata/sf0.01"


def sql(text, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(text).df()


JUNK = ["a b c a b c d\nHome | About | Contact\nAll rights reserved.\n" + "good words here. " * 9 + "\nx\nx\n \nx", "Ends well.\r\nNo end here\v\n\"Quoted.\"  \n(So.)",
        "one two three four five six seven eight. nine\n" * 8, "WOW! WOW! WOW! yes! no! so! be! it!\n" + "calm line of words that ends.\n" * 12]


def test_quality_matches_sql(spark):
    rows = awkward() + [(100 + n, t, "en", "s", 1) for n, t in enumerate(JUNK)]
    docs = table(spark, rows)
    got = quality_rules.line_clean(docs.select("doc_id", "text"), cleaned=False)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_words"]
    want = sql(quality_rules.JUDGED_SQL, documents=docs.toPandas().astype({"doc_id": "Int64"}))
    none = lambda x: None if x is None or x != x else int(x)
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(
        (none(r.doc_id), *map(int, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)), bool(r.base_failed), bool(r.kept), int(r.lost_words))
        for r in want.astype({"doc_id": object}).replace({np.nan: None}).itertuples())


@pytest.mark.parametrize("text", ["", "a", "a b c", "a b c a b c", "a a a a", "a b a b a b x", "p q r s p q r t u p q r"])
def test_repeated_words(text):
    w = text.split()
    windows = [tuple(w[n:n + 3]) for n in range(len(w) - 2)]
    inside = {n + k for n, g in enumerate(windows) if windows.count(g) > 1 for k in range(3)}
    assert quality_rules.repeated_words(w) == len(inside)


def test_line_rules():
    rule = lambda line: quality_rules.line_fails(line)[0]
    assert rule("A sentence that ends.") is None and rule('He said "go."') is None and rule(" ") is None
    assert rule("Read more") == "punctuation" and rule("A! B! C! D! e f g h!") == "punctuation"
    assert rule("Home | News | Sport | more.") == "navigation" and rule("All Rights Reserved.") == "boilerplate"


def test_a_phrase_in_prose_fails_no_line(spark):
    long = "The town asked for its privacy policy, and so on. " + "Then people walked home along the river and talked. " * 40
    assert quality_rules.line_fails(long)[0] is None and quality_rules.line_fails("Read our privacy policy.")[0] == "boilerplate"
    text = "The town wrote its terms of use. " + " ".join(f"word{n}" + "." * (n % 9 == 0) for n in range(90)) + "."
    docs = spark.createDataFrame([(1, text), (2, "Short terms of use.\n" + text)], "doc_id long, text string")
    got = {r.doc_id: (r.kept, r.lost_words) for r in quality_rules.line_clean(docs).collect()}
    want = sql(quality_rules.JUDGED_SQL, documents=docs.toPandas())
    assert got == {1: (True, 0), 2: (True, 4)} == {int(r.doc_id): (bool(r.kept), int(r.lost_words)) for r in want.itertuples()}


def test_clean_keeps_clashing_columns(spark):
    docs = table(spark, awkward())
    out = quality_rules.line_clean(docs)
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    assert quality_rules.line_clean(table(spark, [])).count() == 0


def plain_code_length(trained: str, text: str, order: int = 3) -> float:
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    data = b" " * order + trained.encode()
    for at in range(order, len(data)):
        for n in range(order + 1):
            counts[n][data[at - n:at]][data[at]] += 1
    data, bits = b" " * order + text.encode(), 0.0
    for at in range(order, len(data)):
        for n in range(order, -1, -1):
            seen = counts[n].get(data[at - n:at])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if data[at] in seen:
                bits -= math.log2(seen[data[at]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("window", [16, 1 << 22])
def test_code_lengths(spark, monkeypatch, window):
    monkeypatch.setattr(language_ppm, "WINDOW", window)
    learnt = {"en": "the house on the hill the other one", "fr": "la maison sur la colline, où"}
    keep = [i for i in range(40) if __import__("zlib").crc32(str(i).encode()) % 4 != 2]
    docs = spark.createDataFrame([(keep[n], t, lang) for n, (lang, t) in enumerate(learnt.items())], "doc_id long, text string, lang string")
    trees = language_ppm.learn(docs)
    assert trees.langs == ["en", "fr"]
    for text in ["the colline", "zzz où", "", "q", "la maison of the other " * 400]:
        data = np.frombuffer(b"   " + text.encode(), np.uint8)
        got = trees.bits(data, np.array([0]))[0]
        assert got == pytest.approx([plain_code_length(t, text) for t in learnt.values()], rel=1e-5, abs=1e-6)
        best = ["en", "fr"][int(np.argmin([plain_code_length(t, text) for t in learnt.values()]))]
        assert trees.score([text])[0] == [best if text else "und"]


def test_language_of_held_out_documents(spark):
    docs = read(spark, FOLDER, "documents")
    got = language_ppm.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    own = got[got.held_out]
    assert 0.2 < len(own) / len(got) < 0.3 and (own.lang == own.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_of_awkward_rows(spark):
    rows = awkward()
    got = language_ppm.identify(table(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    by = {r.doc_id: r for r in got}
    assert [by[n].lang_pred for n in (20, 21, 22, 33)] == ["und"] * 4 and by[20].score == 0
    nothing = table(spark, [(r[0], r[1], None, r[3], r[4]) for r in rows])
    assert {r.lang_pred for r in language_ppm.identify(nothing).collect()} == {"und"}
    assert language_ppm.identify(table(spark, [])).count() == 0


def test_toxicity_on_held_out_labels(spark):
    docs, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity_chain.toxicity(docs, labels, most_toxic=250, most_other=1200).join(labels.withColumnRenamed("toxic", "label"), "doc_id").toPandas()
    assert len(got) == labels.join(docs, "doc_id").count()
    assert got[got.label == 1].toxic.mean() > 0.8 and got[got.label == 0].toxic.mean() < 0.01


def test_toxicity_chain_feeds_forward():
    rng = random.Random(1)
    texts, toxic = [], []
    for n in range(300):
        bad = n % 3 == 0
        words = {f"w{rng.randrange(60)}".encode() for _ in range(20)} | ({b"idiot", b"scum", b"trash"} if bad else set())
        texts.append(words)
        toxic.append(bad)
    chain = toxicity_chain.Chain(texts, toxic)
    size = len(chain.numbers)
    assert [len(w) - size for w in chain.weights] == [1, 2, 3, 4]
    p = chain.score(["you idiot scum trash", "nice words", None, ""])
    assert p[0].min() > 0.6 and p[1:].max() < 0.5
    assert toxicity_chain.categories({b"idiot", b"fool"}, True) == [True, False, False, True]


def test_toxicity_of_awkward_rows(spark):
    rows = awkward()
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (None, 1), (0, 1)], "doc_id long, toxic int")
    got = toxicity_chain.toxicity(table(spark, rows), labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    none = toxicity_chain.toxicity(table(spark, rows), labels.where("false")).collect()
    assert len(none) == len(rows)
    assert toxicity_chain.toxicity(table(spark, []), labels).count() == 0


def test_toxicity_sample_takes_a_repeated_id_once(spark):
    """A sampled id with most of the rows comes to the driver as one row; ids may be names."""
    rows = [("a", "idiot scum")] * 500 + [("a", "awful")] + [("b", "kind words"), ("c", None), (None, "idiot")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0), ("d", 1)], "doc_id string, toxic int")
    texts, toxic = toxicity_chain.sample_of(docs, labels, "doc_id", "text", 10, 10)
    assert sorted(zip(map(sorted, texts), toxic)) == [([], False), ([b"awful"], True), ([b"kind", b"words"], False)]
    assert toxicity_chain.toxicity(docs, labels).count() == len(rows)


def test_toxicity_scores_as_the_chain_by_hand(spark):
    """Every category is a logistic model over a text's features and the categories before it."""
    rng = random.Random(4)
    texts = [{f"w{rng.randrange(40)}".encode() for _ in range(12)} | ({b"moron", b"vermin"} if n % 4 == 0 else set()) for n in range(200)]
    chain = toxicity_chain.Chain(texts, [n % 4 == 0 for n in range(200)])
    said = ["You moron, vermin!", "w1 w2 w3", "", None, "moron " * 1000]
    got = chain.score(said)
    for text, row in zip(said, got):
        found = [chain.numbers[w] for w in toxicity_chain.features_of(toxicity_chain.words_of(text)) if w in chain.numbers]
        before: list[float] = []
        for w in chain.weights:
            z = sum(w[c] for c in found) + sum(a * b for a, b in zip(before, w[len(chain.numbers):])) + w[-1]
            before.append(1 / (1 + math.exp(-z)))
        assert row == pytest.approx(before, abs=1e-9)


BYTE_PAIRS = public_tokenizers.path("byte_bpe_50k.json")


def losses_by_hand(spark, docs, labels):
    """{row: (n_tokens, target_loss, background_loss)} by the rule as written, with plain counters."""
    own, folded = cross_entropy.encoder(BYTE_PAIRS), {}
    ids = sorted({i for i, _ in docs if i is not None})
    frame = spark.createDataFrame([(i,) for i in [*ids, None]], "doc_id long")
    for r in frame.select("doc_id", cross_entropy.fold_of(F.col("doc_id")).alias("f"), F.pmod(F.xxhash64(F.lit(cross_entropy.SEED + 1), "doc_id"), F.lit(cross_entropy.DRAWS)).alias("d")).collect():
        folded[r.doc_id] = r.f, r.d
    start, size = cross_entropy.start_of(own), cross_entropy.start_of(own) + 1
    pairs = [list(zip([start, *x], x)) for x in (own.ids(t or "") for _, t in docs)]
    wanted = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic and r.doc_id is not None}
    target = [i in wanted for i, _ in docs]
    rate = sum(len(p) for p, t in zip(pairs, target) if t) / max(1, sum(map(len, pairs)))
    drawn = [folded[i][1] < cross_entropy.DRAWS * rate for i, _ in docs]

    def model(fold, taken):
        counts = Counter(p for (i, _), own, t in zip(docs, pairs, taken) if t and folded[i][0] == fold for p in own)
        firsts, seconds = Counter(), Counter()
        for (h, w), c in counts.items():
            firsts[h] += c
            seconds[w] += c
        prior, total = cross_entropy.PRIOR, sum(counts.values())
        return lambda p: -math.log((counts[p] + prior * (seconds[p[1]] + 1) / (total + size)) / (firsts[p[0]] + prior))

    models = [[model(f, taken) for f in (0, 1)] for taken in (target, drawn)]
    return [(i, len(p), *[np.mean([m[1 - folded[i][0]](x) for x in p]) if p else None for m in models]) for (i, _), p in zip(docs, pairs)]


def same_losses(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], *[x or 0 for x in r[2:4]])
    got, want = sorted((tuple(r)[:4] for r in got), key=key), sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    for g, w in zip(got, want):
        assert g[2:] == pytest.approx(w[2:], rel=1e-9) if w[1] else g[2:] == (None, None)


@pytest.mark.parametrize("hot", [cross_entropy.HOT, 4])
def test_cross_entropy_by_hand(spark, hot):
    """Awkward rows, repeats and very long texts beside plain counters; with few hot pairs nearly all are joined by key."""
    docs = [(r[0], r[1]) for r in awkward()] + [(1, "a b a"), (900, "zzz B"), (1, "a b a")]
    labels = spark.createDataFrame([(n, 1, 0) for n in range(0, 12, 2)] + [(1, 0, 0), (25, 1, None), (29, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, target string, n long")
    got = cross_entropy.cross_entropy_difference(frame, labels, BYTE_PAIRS, hot=hot).collect()
    same_losses(got, losses_by_hand(spark, docs, labels))
    assert all(r.difference is None if not r.n_tokens else r.difference == pytest.approx(r.target_loss - r.background_loss) for r in got)


def test_cross_entropy_without_target_or_rows(spark):
    rows, labels = awkward(), spark.createDataFrame([(0, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    even = cross_entropy.cross_entropy_difference(table(spark, rows), labels.where("false"), BYTE_PAIRS).collect()
    assert len(even) == len(rows) and all(abs(r.difference) < 1e-9 for r in even if r.n_tokens)
    assert cross_entropy.cross_entropy_difference(table(spark, []), labels, BYTE_PAIRS).count() == 0
    named = spark.createDataFrame([("a", "x y z"), ("b", "x y"), (None, "q")], "doc_id string, text string")
    own = spark.createDataFrame([("a", 1, 0)], "doc_id string, quality int, toxic int")
    assert cross_entropy.cross_entropy_difference(named, own, BYTE_PAIRS).count() == 3


def test_cross_entropy_tells_likeness_not_membership(spark):
    """A third of the rows are of the wanted kind, and half of these are labelled: those without a label score like those
    with one, far below the other kind, and a labelled row of the other kind is not below its like."""
    rng = random.Random(4)
    kinds = [[f"{a}{b}" for a in half for b in ("an", "el", "or", "ist", "um")] for half in ("bdfgk", "lmnprs")]
    docs = [(n, " ".join(rng.choice(kinds[n % 3 != 0]) for _ in range(120))) for n in range(600)]
    wanted = [n for n in range(0, 600, 3) if n % 2]
    strays = list(range(1, 60, 6))
    labels = spark.createDataFrame([(n, 1, 0) for n in [*wanted, *strays]], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.difference for r in cross_entropy.cross_entropy_difference(spark.createDataFrame(docs, "doc_id long, text string"), labels, BYTE_PAIRS).collect()}
    mean = lambda own: float(np.mean([got[n] for n in own]))
    inside, outside = mean(wanted), mean([n for n in range(0, 600, 3) if n % 2 == 0])
    assert inside < 0 and outside < 0 and abs(inside - outside) < 0.05
    others = [n for n in range(600) if n % 3 and n not in strays]
    assert mean(others) > 0.1 and abs(mean(strays) - mean(others)) < 0.1


def test_cross_entropy_on_given_rows(spark):
    """Rows without a label are good and bad ones like the labelled: the median row of either is as near to the target, and
    as many are below zero; rows of low quality are far off."""
    documents, labels = read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")
    got = cross_entropy.cross_entropy_difference(documents, labels, BYTE_PAIRS).join(labels, "doc_id", "left").toPandas()
    got = got[got.n_tokens >= 50]
    unknown, good, bad = got[got.quality.isna()].difference, got[(got.quality == 1) & (got.toxic != 1)].difference, got[got.quality == 0].difference
    assert abs(unknown.median() - good.median()) < 0.1 and abs((unknown < 0).mean() - (good < 0).mean()) < 0.25
    assert (unknown < 0).mean() > 0.5 and bad.median() > 1
