"""Hard negatives beside all inner products."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill.llm import negatives_rtree as rtree


def expected(rows, every, positives=5, negatives=5, low=80, high=100):
    sound = {(i, l, tuple(math.floor(256 * x) for x in v)) for i, l, v in rows
             if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, label, q in (r for r in sound if r[0] % every == 0):
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, own) for i, own, v in sound if i != a)
        for score, p, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and low * -score <= 100 * -s[0] <= high * -score][:negatives]
            out += [(a, p, n + 1, s[1], -score, -s[0]) for n, s in enumerate(fit)]
    return sorted(out)


def made(rng, n, width, spread=0.4):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i, rng.randrange(4), [c + rng.gauss(0, spread) for c in rng.choice(centres)]) for i in range(n)]


def mined(spark, rows, every, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "vec", "score", "rank", "anchor", "slab")})
    return sorted(tuple(r) for r in rtree.mine(df, F.col("id") % every == 0, **options).collect())


def test_awkward_rows(spark):
    rng = random.Random(2)
    rows = made(rng, 400, 3)
    rows += [(400 + n, 1, rows[0][2]) for n in range(60)] + [rows[7]] * 50  # ties and repeats
    rows += [(900, None, [1.0] * 3), (901, 2, None), (902, 2, [1.0, None, 2.0]), (903, 2, [float("nan"), 1.0, 1.0]), (904, 1, [float("inf"), 0.0, 0.0]),
             (None, 1, [1.0] * 3), (905, 1, []), (906, 2, [3.0]), (1000, 3, [-2.0, 0.5, 1.0, 9.0]), (1100, 3, [1e8, -1e8, 1.0]), (1000, 2, [0.0, 0.0, 0.0])]
    assert mined(spark, rows, 20) == expected(rows, 20)
    assert mined(spark, rows, 50, block=3, positives=2, negatives=9, low=50, high=90) == expected(rows, 50, 2, 9, 50, 90)


def test_many_tiles(spark):
    rng = random.Random(4)
    rows = made(rng, 9500, 4, 0.2) + [(20_000 + n, n % 3, [0.5, 0.5, 0.5, 0.5]) for n in range(4800)]
    assert mined(spark, rows, 1000, block=7) == expected(rows, 1000)
    points = rtree.points(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), "vec_id", "label", "embedding", 256)
    tiles = rtree.tiles(points).select((F.octet_length("ids") / 8).alias("n")).collect()
    assert len(tiles) >= 4 and max(r["n"] for r in tiles) <= rtree.TILE and sum(r["n"] for r in tiles) == len(rows)


def test_empty_table(spark):
    assert mined(spark, [], 100) == []


def tree(vectors, labels):
    order = rtree.packed_order(vectors)
    row = {"ids": np.arange(len(vectors))[order].tobytes(), "labels": labels[order].tobytes(), "vectors": vectors[order].tobytes(), "width": vectors.shape[1]}
    return rtree.Tile(row)


def test_boxes_hold_their_rows():
    vectors = np.random.default_rng(1).integers(-300, 300, (3000, 5))
    own = tree(vectors, np.zeros(3000, np.int64))
    low, high = rtree.boxes(own.vectors)
    assert len(low) == sum(own.levels) and own.levels == [24, 3, 1]
    assert (low[-1] == vectors.min(0)).all() and (high[-1] == vectors.max(0)).all()
    for leaf in range(24):
        rows = own.vectors[leaf * rtree.LEAF:(leaf + 1) * rtree.LEAF]
        assert (low[leaf] == rows.min(0)).all() and (high[leaf] == rows.max(0)).all()


@pytest.mark.parametrize("same", [True, False])
def test_search_prunes_and_finds(same):
    rng = np.random.default_rng(6)
    vectors, labels = rng.integers(-300, 300, (4000, 2)), rng.integers(0, 3, 4000)
    own, anchors = tree(vectors, labels), vectors[:20]
    scores = vectors @ anchors.T
    tops = [np.sort(scores[:, n])[-200] for n in range(20)]
    wanted = [[rtree.Found(0.7 * t, t, 5, -np.inf)] for t in tops]
    seen = defaultdict(int)
    add = rtree.Found.add
    rtree.Found.add = lambda self, s, i: (seen.__setitem__("rows", seen["rows"] + len(s)), add(self, s, i))[1]
    try:
        own.search(anchors, labels[:20], np.arange(20), wanted, same, np.arange(20))
    finally:
        rtree.Found.add = add
    for n, (found,) in enumerate(wanted):
        fit = [i for i in range(4000) if i != n and (labels[i] == labels[n]) is np.bool_(same) and found.low <= scores[i, n] <= tops[n]]
        assert found.best == sorted((-float(scores[i, n]), i) for i in fit)[:5]
    assert seen["rows"] < 0.25 * 20 * 4000
