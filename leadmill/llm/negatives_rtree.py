"""Hard negatives by an R-tree over vectors, packed sort-tile-recursive and searched best first.

Rows are put into slabs along the coordinate that varies most and ordered along the next one within a slab; runs of that
order are tiles.  A task packs its tiles the same way into leaves along further coordinates and keeps the smallest and
largest value of each coordinate for every leaf and every node above.  A box bounds the inner product of an anchor with
all its rows from both sides, coordinate by coordinate.  The search takes boxes in the order of their upper bounds and
leaves out those outside the wanted scores and those strictly below the kth score found, so that ties are seen.

Anchors come in blocks of bounded size, which are sent to all tiles; rows are never moved for a search.  Each block first
visits the tiles its anchors lie in, and starts the others with the kth scores found there.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.common import shared_folder, stash

#: Rows of a tile and of a leaf, and nodes below a node.
TILE, LEAF, FAN = 1 << 12, 1 << 7, 8
#: Most slabs along the first coordinate.
SLABS = 256
#: Anchors that are sent to the tasks at once.
BLOCK = 1 << 12
#: Coordinates that a tile is packed along.
AXES = 3
#: Whole numbers below this are exact as floating-point numbers.
EXACT = 1 << 53


def points(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, vec): rows with a label and only finite components, each as the whole number below ``scale`` times it."""
    whole = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    odd = F.exists(F.col(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    taken = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & ~odd)
    return taken.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("vec")).dropDuplicates()


def levels(rows: int) -> list[int]:
    """Nodes per level of a tile, from the leaves to the root."""
    out = [-(-rows // LEAF)]
    while out[-1] > 1:
        out.append(-(-out[-1] // FAN))
    return out


def packed_order(vectors: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order of the rows: slabs along the coordinate of the largest spread, and so on inside them."""
    axes = np.argsort(-np.ptp(vectors, axis=0), kind="stable")[:AXES] if vectors.shape[1] else []

    def cut(own: np.ndarray, axes: Iterable[int]) -> np.ndarray:
        if not len(axes) or len(own) <= LEAF:
            return own
        pages = -(-len(own) // LEAF)
        size = LEAF * -(-pages // int(np.ceil(pages ** (1 / len(axes)))))
        own = own[np.argsort(vectors[own, axes[0]], kind="stable")]
        return np.concatenate([cut(own[at:at + size], axes[1:]) for at in range(0, len(own), size)])

    return cut(np.arange(len(vectors)), axes)


def boxes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest coordinates of all nodes, leaves first and the root last."""
    low = high = vectors
    lows, highs, step = [], [], LEAF
    for count in levels(len(vectors)):
        at = np.arange(count) * step
        low, high, step = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), FAN
        lows.append(low)
        highs.append(high)
    return np.concatenate(lows), np.concatenate(highs)


def tiles(rows: DataFrame) -> DataFrame:
    """(ids, labels, vectors, width): a row per tile of (id, label, vec). Rows of equal vectors are told apart by id, so no
    vector makes a tile larger. Shorter vectors are filled up with zeros."""
    spread = (rows.select(F.posexplode("vec").alias("axis", "x")).groupBy("axis").agg(F.variance("x").alias("v"))
              .orderBy(F.desc_nulls_last("v"), "axis").limit(2).collect())
    axes = [r["axis"] for r in spread] or [0]
    first, second = (F.coalesce(F.get("vec", F.lit(a)), F.lit(0)) for a in (axes[0], axes[-1]))
    slabs = min(SLABS, int(np.ceil((rows.count() / TILE) ** 0.5)))
    cuts = rows.agg(F.percentile_approx(first, [n / slabs for n in range(1, slabs)], 10_000)).first()[0] if slabs > 1 else None
    slab = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= first)) if cuts else F.lit(0)
    order = ["slab", "second", "id", "label"]
    dealt = rows.withColumn("slab", slab).withColumn("second", second).repartitionByRange(*order).sortWithinPartitions(*order)

    def tile(ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]) -> pa.RecordBatch:
        width = max(map(len, vectors))
        whole = np.zeros((len(ids), width), np.int64)
        for n, v in enumerate(vectors):
            whole[n, :len(v)] = v
        own = packed_order(whole)
        return pa.RecordBatch.from_pydict({"ids": [ids[own].tobytes()], "labels": [labels[own].tobytes()], "vectors": [whole[own].tobytes()], "width": [width]})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for batch in batches:
            ids, labels = np.concatenate([ids, batch.column(0).to_numpy()]), np.concatenate([labels, batch.column(1).to_numpy()])
            flat, ends = batch.column(2).flatten().to_numpy(), np.cumsum(batch.column(2).value_lengths().to_numpy())
            vectors += np.split(flat, ends[:-1]) if batch.num_rows else []
            while len(ids) >= TILE:
                yield tile(ids[:TILE], labels[:TILE], vectors[:TILE])
                ids, labels, vectors = ids[TILE:], labels[TILE:], vectors[TILE:]
        if len(ids):
            yield tile(ids, labels, vectors)

    return stash(dealt.select("id", "label", "vec").mapInArrow(pack, "ids binary, labels binary, vectors binary, width long"), "tiles")


class Found:
    """The best ``k`` rows of an anchor with scores from ``low`` to ``high``; ``least`` is the score that others must reach."""

    def __init__(self, low: float, high: float, k: int, least: float):
        self.low, self.high, self.k, self.least, self.best = low, high, k, max(low, least), []

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = np.flatnonzero((scores >= self.least) & (scores <= self.high))
        if len(fit):
            self.best = sorted([*self.best, *zip((-scores[fit]).tolist(), ids[fit].tolist())])[:self.k]
            if len(self.best) == self.k:
                self.least = max(self.least, -self.best[-1][0])


class Tile:
    """The tree over the rows of one tile."""

    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int64).reshape(len(self.ids), row["width"])
        self.levels = levels(len(self.ids))
        self.starts = np.concatenate([[0], np.cumsum(self.levels)]).tolist()

    def fitted(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and anchors of one width, as numbers that keep every product exact."""
        width = self.vectors.shape[1]
        fitted = np.zeros((len(anchors), width), np.int64)
        fitted[:, :anchors.shape[1]] = anchors[:, :width]
        size = int(np.abs(self.vectors).max(initial=0)) * int(np.abs(fitted).max(initial=0)) * max(width, 1)
        kind = np.float64 if size < EXACT else object
        return self.vectors.astype(kind), fitted.astype(kind)

    def search(self, anchors: np.ndarray, labels: np.ndarray, ids: np.ndarray, wanted: list[list[Found]], same: bool, who: np.ndarray) -> None:
        """Best first for each anchor in ``who``: rows of its label (``same``) or of others, never those of its own id."""
        vectors, anchors = self.fitted(anchors[who])
        low, high = boxes(vectors)
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        most, least = (up @ high.T + down @ low.T), (up @ low.T + down @ high.T)
        root = len(low) - 1
        for n, anchor in enumerate(who.tolist()):
            own = wanted[anchor]
            floor, top = min(w.least for w in own), max(w.high for w in own)
            if most[n, root] < floor or least[n, root] > top:
                continue
            upper, lower, queue = most[n].tolist(), least[n].tolist(), [(-upper_bound(most[n, root], top), len(self.levels) - 1, root)]
            while queue:
                bound, level, node = heapq.heappop(queue)
                if -bound < floor:
                    break
                if level:
                    place = node - self.starts[level]
                    begin = self.starts[level - 1] + place * FAN
                    for child in range(begin, min(begin + FAN, self.starts[level])):
                        if upper[child] >= floor and lower[child] <= top:
                            heapq.heappush(queue, (-upper_bound(upper[child], top), level - 1, child))
                    continue
                rows = slice(node * LEAF, (node + 1) * LEAF)
                scores, others = vectors[rows] @ anchors[n], self.ids[rows]
                fit = ((self.labels[rows] == labels[anchor]) if same else (self.labels[rows] != labels[anchor])) & (others != ids[anchor])
                scores, others = scores[fit], others[fit]
                for w in own:
                    if upper[node] >= w.least and lower[node] <= w.high:
                        w.add(scores, others)
                floor = min(w.least for w in own)


def upper_bound(most: float, top: float) -> float:
    return most if most < top else top


def _search(tree: DataFrame, block: dict, windows: list[list[tuple]], k: int, same: bool, home: bool) -> DataFrame:
    """(anchor, window, id, score): of each task the best ``k`` rows for every window (low, high, least) of every anchor of
    ``block``; anchors and windows are named by their places. ``home``: only tiles that hold the anchor."""
    sent = tree.sparkSession.sparkContext.broadcast((block, windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, windows = sent.value
        ids = block["ids"]
        wanted = [[Found(low, high, k, least) for low, high, least in own] for own in windows]
        asked = np.array([bool(w) for w in wanted], bool)
        for batch in batches:
            for row in batch.to_pylist():
                own = Tile(row)
                who = np.flatnonzero(asked & np.isin(ids, own.ids) if home else asked)
                if len(who):
                    own.search(block["vectors"], block["labels"], ids, wanted, same, who)
        rows = [(n, m, ident, -int(score)) for n, own in enumerate(wanted) for m, w in enumerate(own) for score, ident in w.best]
        columns = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array([int(x) for x in c], pa.int64()) for c in columns], names=["anchor", "window", "id", "score"])

    found = tree.mapInArrow(run, "anchor long, window long, id long, score long")
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _best(tree: DataFrame, block: dict, windows: list[list[tuple]], k: int, same: bool) -> DataFrame:
    """The search over all tiles, which starts with what the anchors' own tiles show."""
    known = _search(tree, block, windows, k, same, home=True).where(F.col("rank") == k).collect()  # a row per window at most
    least = {(r["anchor"], r["window"]): r["score"] for r in known}
    ready = [[(low, high, least.get((n, m), low)) for m, (low, high, _) in enumerate(own)] for n, own in enumerate(windows)]
    return _search(tree, block, ready, k, same, home=False)


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 256,
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, block: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which ``anchors``, a condition on ``id``, holds. A row's score is its inner product with the
    anchor; higher ones come first, ties by smaller id. Positives are the first rows of the anchor's label, negatives the
    first of other labels whose score is between ``low`` and ``high`` percent of the positive's, so a negative positive
    score has none. Rows without id, label or vector, or with a null or infinite component, take no part; equal rows count
    once; rows of one id are not each other's partners; an empty table gives no rows; other columns are not read. Scores
    are 64-bit numbers; a product beyond them ends the query with an error."""
    spark = rows.sparkSession
    held = stash(points(rows, id_col, label_col, vector_col, scale), "points")
    tree, chosen = tiles(held), stash(held.where(anchors), "anchors")
    blocks, path = -(-chosen.count() // block), f"{shared_folder(spark)}/negatives-{uuid.uuid4().hex}"
    for number in range(max(1, blocks)):
        part = chosen.where(F.pmod(F.xxhash64("id", "label", "vec"), F.lit(max(1, blocks))) == number).orderBy("id", "label").toArrow()
        vectors = part.column("vec").to_pylist()
        width = max(map(len, vectors), default=0)
        own = {"ids": part.column("id").to_numpy(), "labels": part.column("label").to_numpy(), "vectors": np.array([v + [0] * (width - len(v)) for v in vectors], np.int64).reshape(len(vectors), width)}
        everything = [(-np.inf, np.inf, -np.inf)]
        near = _best(tree, own, [everything] * len(vectors), positives, same=True).select("anchor", "rank", "id", "score").collect()  # ``positives`` rows per anchor
        near.sort(key=lambda r: (r["anchor"], r["rank"]))
        scores = [[] for _ in vectors]
        for r in near:
            if r["score"] not in scores[r["anchor"]]:
                scores[r["anchor"]].append(r["score"])
        windows = [[(-(-low * s // 100), high * s // 100, -np.inf) for s in own_scores] for own_scores in scores]
        far = _best(tree, own, windows, negatives, same=False).withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        pairs = [(r["anchor"], scores[r["anchor"]].index(r["score"]), int(own["ids"][r["anchor"]]), r["id"], r["score"]) for r in near]
        named = spark.createDataFrame(pairs, "anchor long, window long, anchor_id long, positive_id long, positive_score long")
        (far.join(F.broadcast(named), ["anchor", "window"])
         .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
         .write.parquet(f"{path}/block={number}"))
    return spark.read.parquet(path).drop("block")


#: The query's result in SQL: vectors changed as the query does, every anchor against all rows.
MINED_SQL = """
WITH vectors AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.vec, b.vec)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.id % 100 = 0 AND a.id <> b.id),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
