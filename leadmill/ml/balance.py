"""Class balancing: interpolated minority rows, density-weighted rows, edited neighbours, undersampling, and their choice.

Neighbours are exact.  Equal rows are one point with its first rows; a tree fitted on a sample deals the points to
cells of about ``block`` points, so many as the table asks for.  A point's own cell gives it a distance within which it
has enough neighbours, and every cell that this distance reaches is searched.  A cell is searched block by block, points
and queries alike, so that no group grows with the table, however uneven or large its cells are.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadmill.ml.prepare import spread
from leadmill.operators.dictionary import ordered_positions, stored
from leadmill.operators.quantiles import hash_order

#: Points of a cell; with more than ``CELLS`` times as many, a cell has more blocks instead.
BLOCK, CELLS = 1 << 10, 1 << 16
#: Sampled points per cell that the tree is fitted on.
SAMPLED = 8
#: A vector with at least this share of the rows is hot, so there are at most as many hot ones.
HOT = 64
#: Copies of a row that are made at once.
COPIES = 1024


class Cells:
    """A tree of splits: points up to the split's value go left, others right."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.count = 0
        self.root = self.grow(sample, cells)

    def grow(self, sample: np.ndarray, cells: int):
        if cells > 1 and len(sample) > 1:
            column = int(np.argmax(sample.max(0) - sample.min(0)))
            values = np.sort(sample[:, column])
            below = values[values < values[-1]]
            if len(below):
                value = min(values[(len(values) - 1) // 2], below[-1])
                left = sample[:, column] <= value
                return column, value, self.grow(sample[left], cells // 2), self.grow(sample[~left], cells - cells // 2)
        self.count += 1
        return self.count - 1

    def reached(self, v: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of all cells that may hold a point within ``radius`` of a row; with radius 0 just its own."""
        rows, cells, todo = [], [], [(self.root, np.arange(len(v)))]
        while todo:
            node, own = todo.pop()
            if not isinstance(node, tuple):
                rows.append(own)
                cells.append(np.full(len(own), node, np.int32))
                continue
            column, value, left, right = node
            x, r = v[own, column], radius[own]
            for side, part in ((left, own[x - r <= value]), (right, own[x + r > value])):
                if len(part):
                    todo.append((side, part))
        return (np.concatenate(rows), np.concatenate(cells)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int32))


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def nearest(points: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and places of the k nearest points of each query, nearest first; of equally near ones the first places."""
    most = min(k, len(points))
    gaps, places = np.empty((len(queries), most)), np.empty((len(queries), most), np.int64)
    step = max(1, (1 << 21) // max(len(points), 1))
    for at in range(0, len(queries), step):
        own = queries[at:at + step]
        gap = np.zeros((len(own), len(points)))
        for column in range(points.shape[1]):
            gap += (own[:, column, None] - points[None, :, column]) ** 2
        last = np.partition(gap, most - 1, axis=1)[:, most - 1:most]
        near, tied = gap < last, gap == last
        near |= tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= most - near.sum(1, keepdims=True))
        best = np.nonzero(near)[1].reshape(len(own), most)
        found = np.take_along_axis(gap, best, 1)
        order = np.argsort(found, axis=1, kind="stable")
        gaps[at:at + step], places[at:at + step] = np.sqrt(np.take_along_axis(found, order, 1)), np.take_along_axis(best, order, 1)
    return gaps, places


def by_first_member(table: pa.Table) -> pa.Table:
    """Points in the order of the ids of their first rows."""
    first = [m[0]["other"] for m in table["members"].to_pylist()]
    return table.take(pa.array(sorted(range(len(first)), key=first.__getitem__), pa.int64()))


def block_pairs(points: DataFrame, queries: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Points and queries of each ``cell`` dealt to blocks by the hash of ``v``; every block of points meets every block of
    queries under the key (cell, part, turn), and neither has more than about ``block`` rows there."""
    def parts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias(name))  # a row per cell, CELLS at most

    sizes = F.broadcast(parts(points, "parts").join(parts(queries, "turns"), "cell"))
    part, turn = (F.pmod(F.xxhash64("v"), F.col(c)).cast("int") for c in ("parts", "turns"))
    others = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    return (points.join(sizes, "cell").withColumn("part", part).withColumn("turn", others("turns")).drop("parts", "turns"),
            queries.join(sizes, "cell").withColumn("turn", turn).withColumn("part", others("parts")).drop("parts", "turns"))


def neighbours(df: DataFrame, features: str, identity: str, k: int = 5, extra: Sequence[str] = (), block: int = BLOCK, seed: int = 42) -> DataFrame:
    """The k nearest rows of each row, exactly: (id, v, other, w, distance, place, other_<extra>); of equal rows the first ids.

    With more than k rows every row has k neighbours.  ``block`` only sets how the search is dealt out."""
    names = [f"other_{c}" for c in extra]
    rows = df.select(F.col(identity).alias("id"), vector_to_array(features).alias("v"), *[F.col(c).alias(n) for c, n in zip(extra, names)])
    first = rows.first()
    size = len(first["v"]) if first else 1
    # a row needs no more than k + 1 rows of any one vector, itself included
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("place") <= k + 1)
    member = F.struct(F.col("id").alias("other"), *names)
    points = stored(ranked.groupBy("v").agg(F.sort_array(F.collect_list(member)).alias("members")), "points")
    total = points.count()
    wanted = min(CELLS, -(-total // block))
    sample = points.select("v").sample(min(1.0, SAMPLED * wanted / max(total, 1)), seed).toArrow() if wanted > 1 else None
    cells = Cells(matrix(sample["v"], size) if sample is not None else np.zeros((0, size)), wanted)
    tree = df.sparkSession.sparkContext.broadcast(cells)
    kinds = {f.name: f.dataType for f in points.schema}
    celled = T.StructType([*points.schema.fields, T.StructField("cell", T.IntegerType())])
    asked = T.StructType([T.StructField("v", kinds["v"]), T.StructField("radius", T.DoubleType()), T.StructField("cell", T.IntegerType())])
    out = T.StructType([T.StructField("v", kinds["v"]), T.StructField("distance", T.DoubleType()), T.StructField("w", kinds["v"]), T.StructField("members", kinds["members"])])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(0), size)
            row, cell = tree.value.reached(v, np.zeros(len(v)))
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(row)) for c in batch.columns], pa.array(cell)], names=celled.names)

    def ask(table: pa.Table) -> pa.Table:
        v, sizes = matrix(table["v"], size), np.array([len(m) for m in table["members"]])
        gaps, places = nearest(v, v, k + 1)
        enough = np.cumsum(sizes[places], axis=1) >= k + 1
        radius = np.where(enough.any(1), gaps[np.arange(len(v)), enough.argmax(1)], np.inf)
        row, cell = tree.value.reached(v, radius * (1 + 1e-9))
        return pa.table({"v": table["v"].take(pa.array(row)), "radius": pa.array(radius[row]), "cell": pa.array(cell)})

    def search(held: pa.Table, queries: pa.Table) -> pa.Table:
        held = by_first_member(held)
        gaps, places = nearest(matrix(held["v"], size), matrix(queries["v"], size), k + 1) if len(held) else (np.zeros((len(queries), 0)), np.zeros((len(queries), 0), np.int64))
        row, column = np.nonzero(gaps <= queries["radius"].to_numpy()[:, None] * (1 + 1e-9))
        at = pa.array(places[row, column])
        return pa.table({"v": queries["v"].take(pa.array(row)), "distance": pa.array(gaps[row, column]), "w": held["v"].take(at), "members": held["members"].take(at)})

    placed = stored(points.mapInArrow(place, celled), "cells")
    sizes = F.broadcast(placed.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts")))  # a row per cell
    dealt = placed.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("v"), "parts"))
    queries = stored(dealt.groupBy("cell", "part").applyInArrow(ask, asked), "queries")
    held, searching = (df.groupBy("cell", "part", "turn") for df in block_pairs(placed, queries, 2 * block))
    found = held.cogroup(searching).applyInArrow(search, out)
    near = F.transform("members", lambda m: F.struct(F.col("distance"), m["other"].alias("other"), F.col("w"), *[m[n].alias(n) for n in names]))
    facts = stored(found.groupBy("v").agg(F.slice(F.sort_array(F.flatten(F.collect_list(near))), 1, k + 1).alias("near")), "near")
    # a vector of many rows is broadcast, so it does not meet in one task
    shares = rows.groupBy("v").agg(F.count("*").alias("n"))
    hot = F.broadcast(shares.filter(F.col("n") * HOT >= rows.count()).select("v").join(facts, "v"))
    joined = rows.select("id", "v").join(hot, "v").unionByName(rows.select("id", "v").join(hot.select("v"), "v", "left_anti").join(facts, "v"))
    own = joined.select("id", "v", F.posexplode(F.slice(F.filter("near", lambda x: x["other"] != F.col("id")), 1, k)).alias("at", "x"))
    return own.select("id", "v", "x.other", "x.w", "x.distance", (F.col("at") + 1).alias("place"), *[F.col(f"x.{n}") for n in names])


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Every row as often as its ``times`` says, numbered from 1 in ``copy``, in arrays of at most ``COPIES``."""
    blocks = df.filter(F.col(times) > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / COPIES))))
    first = F.col("_block") * COPIES + 1
    return blocks.withColumn("copy", F.explode(F.sequence(first, F.least(F.col(times).cast("long"), first + COPIES - 1)))).drop("_block")


def _between(own: DataFrame, times: DataFrame, features: str, label: str, identity: str, k: int, seed: int) -> DataFrame:
    """(identity, features, label): for each row of one class, ``times`` (id, v, label, times) rows between it and a random
    one of its k nearest of the class; a class of one row is repeated."""
    near = neighbours(own, features, identity, k, seed=seed).select("id", "w", "place")
    counts = near.groupBy("id").agg(F.count("*").alias("found"))
    copies = (repeated(times, "times").join(counts, "id", "left")
              .withColumn("place", F.when(F.col("found") > 0, F.pmod(F.xxhash64("id", "copy", F.lit(seed)), F.col("found")).cast("int") + 1))
              .join(near, ["id", "place"], "left"))
    step = F.pmod(F.xxhash64("id", "copy", F.lit(seed + 1)), F.lit(1000)) / 1000.0
    made = F.zip_with("v", F.coalesce("w", "v"), lambda a, b: a + (b - a) * F.col("step"))
    return copies.withColumn("step", step).select(F.concat_ws("+", F.col("id").cast("string"), "copy").alias(identity), array_to_vector(made).alias(features), label)


def oversampled(df: DataFrame, features: str, label: str, identity: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(identity, features, label) with every class at the size of the largest: original rows, then rows between a row of
    the class and a random one of its k nearest of the class, named ``<id>+<number>``. Names are strings."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n")).collect()  # one row per class
    most = max((r["n"] for r in sizes), default=0)
    out = df.select(F.col(identity).cast("string").alias(identity), features, label)
    for value, n in ((r[label], r["n"]) for r in sizes if r["n"] < most):
        own = df.filter(F.col(label) == value)
        need, more = divmod(most - n, n)
        placed = hash_order(own.select(F.col(identity).alias("id"), vector_to_array(features).alias("v"), label), [], ["id"], seed)
        times = placed.withColumn("times", F.lit(need) + (F.col("position") <= more).cast("int")).select("id", "v", label, "times")
        out = out.unionByName(_between(own, times, features, label, identity, k, seed))
    return out


def oversample(df: DataFrame, features: str, label: str, identity: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(features, label) of ``oversampled``."""
    return oversampled(df, features, label, identity, k, seed).select(features, label)


def allotted(df: DataFrame, weight: str, total: int, order: Sequence[str], into: str = "times") -> DataFrame:
    """Adds whole numbers in proportion to ``weight`` that sum to ``total``: largest remainder, ties by ``order``; with no
    weight at all, all rows count alike."""
    whole = df.agg(F.sum(weight)).first()[0] or 0.0
    share = F.col(weight) / whole if whole else F.lit(1.0) / max(df.count(), 1)
    quota = stored(df.withColumn("_quota", share * total).withColumn(into, F.floor("_quota").cast("long")), "quotas")
    left = total - (quota.agg(F.sum(into)).first()[0] or 0)
    ranked = ordered_positions(quota, [(F.col(into) - F.col("_quota")), *order])
    return ranked.withColumn(into, F.col(into) + (F.col("position") <= left).cast("long")).drop("_quota", "position")


def adaptive(df: DataFrame, features: str, label: str, identity: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(identity, features, label) as ``oversampled`` gives it, but a row gets its new rows in proportion to the share of
    other classes among its k nearest rows, in whole numbers by largest remainder."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n")).collect()  # one row per class
    most = max((r["n"] for r in sizes), default=0)
    foreign = stored(neighbours(df, features, identity, k, [label], seed=seed).withColumnRenamed(f"other_{label}", "_theirs")
                     .join(df.select(F.col(identity).alias("id"), F.col(label).alias("_own")), "id").groupBy("id")
                     .agg(F.avg((F.col("_theirs") != F.col("_own")).cast("double")).alias("foreign")), "foreign")
    out = df.select(F.col(identity).cast("string").alias(identity), features, label)
    for value, n in ((r[label], r["n"]) for r in sizes if r["n"] < most):
        own = df.filter(F.col(label) == value)
        weighed = own.select(F.col(identity).alias("id"), vector_to_array(features).alias("v"), label).join(foreign, "id", "left").na.fill(0.0, ["foreign"])
        times = allotted(weighed, "foreign", most - n, ["id"]).select("id", "v", label, "times")
        out = out.unionByName(_between(own, times, features, label, identity, k, seed))
    return out


def adaptive_weights(df: DataFrame, features: str, label: str, identity: str, minority, k: int = 5) -> DataFrame:
    """Share of foreign neighbours of each minority row: where more synthetic rows are needed."""
    near = neighbours(df, features, identity, k, [label])
    mine = df.filter(F.col(label) == minority).select(F.col(identity).alias("id"))
    return near.join(mine, "id", "left_semi").groupBy("id").agg(F.avg((F.col(f"other_{label}") != minority).cast("double")).alias("foreign_share"))


def edited(df: DataFrame, features: str, label: str, identity: str, k: int = 3, every: bool = False) -> DataFrame:
    """Rows whose neighbours mostly (or, with ``every``, all) have their label; rows without neighbours stay."""
    near = neighbours(df, features, identity, k, [label]).join(df.select(F.col(identity).alias("id"), label), "id")
    wrong = near.groupBy("id").agg(F.avg((F.col(f"other_{label}") != F.col(label)).cast("double")).alias("s")).filter("s > 0" if every else "s > 0.5")
    return df.join(wrong.select(F.col("id").alias(identity)), identity, "left_anti")


def balanced_tables(df: DataFrame, features: str, label: str, identity: str, seed: int = 42) -> dict[str, DataFrame]:
    """The table as it is, with interpolated rows, with density-weighted rows, and interpolated then edited, each stored as
    (identity, features, label)."""
    original = stored(df.select(F.col(identity).cast("string").alias(identity), features, label), "original")
    smote = stored(oversampled(original, features, label, identity, seed=seed), "smote")
    return {"original": original, "smote": smote, "adasyn": stored(adaptive(original, features, label, identity, seed=seed), "adasyn"),
            "smote_enn": stored(edited(smote, features, label, identity, every=True), "smote-enn")}


def choose_balance(tables: Mapping[str, DataFrame], estimator, test: DataFrame, label: str = "label") -> tuple[object, list[dict]]:
    """The model fitted on the balanced table that gives the best accuracy on ``test`` (of equals the first; the table
    without balancing is only taken if there is no other), and a record per method tried. The tables are tried at a time."""
    right = F.avg((F.col("prediction") == F.col(label)).cast("double"))

    def fitted(name: str) -> tuple:
        model = estimator.fit(spread(tables[name], tables[name].columns[:1]))
        return model, {"method": name, "train_rows": tables[name].count(), "accuracy": model.transform(test).agg(right).first()[0]}

    names = [name for name in tables if name != "original"] or ["original"]
    with ThreadPoolExecutor(len(names)) as pool:
        found = dict(zip(names, pool.map(fitted, names)))
    best = max(names, key=lambda m: found[m][1]["accuracy"] or 0.0)
    return found[best][0], [{**r, "chosen": m == best} for m, (_, r) in found.items() if m != "original"]


def undersample(df: DataFrame, label: str, identity: str, seed: int = 42) -> DataFrame:
    """Every class cut to the size of the smallest one, by hash order."""
    ordered = hash_order(df, [label], [identity], seed)
    least = df.groupBy(label).agg(F.count("*").alias("n")).agg(F.min("n")).scalar()
    return ordered.filter(F.col("position") <= least).drop("position", "group_rows")
