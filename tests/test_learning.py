"""Neighbours beside brute force, balanced classes, exact areas and a search over phases."""

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from leadmill.ml import balance as B
from leadmill.ml import models as MD


def rows(spark, n=1500, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, 5))
    v[: n // 3] = v[0]  # a third of all rows are equal
    v[n // 3: n // 2] = np.round(v[n // 3: n // 2])
    labels = (rng.random(n) < 0.2).astype(float) + (rng.random(n) < 0.1)
    return v, labels, spark.createDataFrame([(i, Vectors.dense(x), float(y)) for i, (x, y) in enumerate(zip(v, labels))], ["id", "features", "label"]).repartition(5)


def test_every_row_has_near_neighbours(spark):
    v, _, df = rows(spark)
    got = B.neighbours(df, "features", "id", 5, ["label"], block=64).select("id", "other", "distance", "place").toPandas()
    assert (got.groupby("id").size() == 5).all() and got.id.nunique() == len(v) and (got.id != got.other).all()
    gap = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    np.fill_diagonal(gap, np.inf)
    worst = np.sort(gap, axis=1)[:, 4]
    assert np.allclose(got.distance, gap[got.id, got.other])
    assert (got.distance.to_numpy() <= worst[got.id] + 1e-9).mean() >= 0.9


def test_neighbours_stay_right_on_larger_tables(spark):
    """30,000 rows in five dimensions, a third of them equal: all have their five nearest."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(30_000, 5))
    v[20_000:] = v[7]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "id long, x array<double>").select("id", array_to_vector("x").alias("features")).repartition(6)
    got = B.neighbours(df, "features", "id", 5, block=2048).select("id", "other", "distance").toPandas()
    assert (got.groupby("id").size() == 5).all() and got.id.nunique() == len(v) and (got.id != got.other).all()
    assert np.allclose(got.distance, np.sqrt(((v[got.id] - v[got.other]) ** 2).sum(1)))
    worst = got.groupby("id").distance.max()
    for i in [*range(0, 20_000, 40), *range(20_000, 30_000, 500), 7]:
        gap = np.sqrt(((v - v[i]) ** 2).sum(1))
        gap[i] = np.inf
        assert worst[i] <= np.partition(gap, 4)[4] + 1e-9


def test_classes_are_filled_up_between_neighbours(spark):
    v, labels, df = rows(spark, 400)
    out = B.oversample(df, "features", "label", "id")
    counts = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert set(counts.values()) == {int((labels == 0).sum())}
    low, high = v[labels == 2].min(0), v[labels == 2].max(0)
    made = np.array([r.features.toArray() for r in out.filter("label = 2").collect()])
    assert (made >= low - 1e-9).all() and (made <= high + 1e-9).all()
    assert len(np.unique(made.round(9), axis=0)) > len(np.unique(v[labels == 2].round(9), axis=0))


def test_area_is_exact(spark):
    rng = np.random.default_rng(2)
    y = rng.random(800) < 0.3
    x = np.where(rng.random(800) < 0.4, 0.5, rng.random(800) * 1e-7 + y * 3e-8)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "score double, label int")
    pairs = (x[y][:, None] > x[~y]).mean() + (x[y][:, None] == x[~y]).mean() / 2
    assert abs(MD.auc(df, "label", "score").first()[0] - pairs) < 1e-12


def test_search_returns_all_phases(spark):
    df = spark.range(90).select(F.col("id"), array_to_vector(F.array((F.col("id") % 7).cast("double"), (F.col("id") % 3).cast("double"))).alias("features"),
                                (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 2).cast("int").alias("fold"))
    best, tried = MD.phased_search(df, MD.classifiers(iterations=5)["logistic_regression"], [{"regParam": [0.0, 5.0]}, {"fitIntercept": [True, False]}], k=2)
    assert [t["phase"] for t in tried] == [1, 1, 2, 2] and best.getRegParam() == 0.0


def test_soft_vote_takes_boosting(spark):
    """Three classes, of which the middle one is no linear cut: boosting of one against the rest votes with probabilities."""
    df = spark.createDataFrame([(i, float(n % 3), Vectors.dense([x, x * x])) for i, n in enumerate(range(120)) for x in [n % 3 + (i % 7) / 10]], ["id", "label", "features"])
    named = MD.classifiers(rounds=2, iterations=10)
    models = [named[n].fit(df) for n in ("gradient_boosting", "logistic_regression")]
    got = MD.soft_vote(df, models).collect()
    assert all(len(r.probabilities) == 3 and abs(sum(r.probabilities) - 1) < 1e-9 for r in got)
    alone = {r.id: r.probability.toArray() for r in models[1].transform(df).collect()}
    assert any(abs(r.probabilities[0] - alone[r.id][0]) > 1e-3 for r in got)
    assert sum(r.prediction == r.label for r in got) > 110


def test_rows_are_allotted_by_largest_remainder(spark):
    rng = np.random.default_rng(4)
    weights = [(i, float(w)) for i, w in enumerate(rng.integers(0, 9, 700) / 7)]
    for total in (0, 13, 5000):
        got = {r["id"]: r["times"] for r in B.allotted(spark.createDataFrame(weights, "id long, w double"), "w", total, ["id"]).collect()}
        quota = {i: w / sum(x for _, x in weights) * total for i, w in weights}
        want = {i: int(q) for i, q in quota.items()}
        for i in sorted(quota, key=lambda i: (round(want[i] - quota[i], 9), i))[:total - sum(want.values())]:
            want[i] += 1
        assert sum(got.values()) == total
        assert sum(abs(got[i] - want[i]) for i in want) <= 2  # sums in another order may swap two equal remainders
    even = B.allotted(spark.createDataFrame([(i, 0.0) for i in range(4)], "id long, w double"), "w", 10, ["id"]).collect()
    assert sorted(r["times"] for r in even) == [2, 2, 3, 3]


def test_copies_come_in_bounded_arrays(spark):
    df = spark.createDataFrame([(1, 5000), (2, 0), (3, 1), (4, 1024)], "id long, times long")
    got = {r["id"]: (r["n"], r["least"], r["most"], r["d"]) for r in B.repeated(df, "times").groupBy("id").agg(
        F.count("*").alias("n"), F.min("copy").alias("least"), F.max("copy").alias("most"), F.count_distinct("copy").alias("d")).collect()}
    assert got == {1: (5000, 1, 5000, 5000), 3: (1, 1, 1, 1), 4: (1024, 1, 1024, 1024)}


def test_density_weighted_rows(spark):
    v, labels, df = rows(spark, 300, 9)
    out = B.adaptive(df, "features", "label", "id").filter("id LIKE '%+%'").collect()
    gap = ((v[:, None] - v[None]) ** 2).sum(-1)
    np.fill_diagonal(gap, np.inf)
    most = max((labels == c).sum() for c in set(labels))
    for c in set(labels):
        assert (labels == c).sum() + sum(r.label == c for r in out) == most
    # rows without any foreign neighbour get none, if others of their class have some
    order = np.lexsort([np.broadcast_to(np.arange(300), gap.shape), gap], axis=1)[:, :5]
    foreign = (labels[order] != labels[:, None]).mean(1)
    for r in out:
        parent = int(r.id.split("+")[0])
        assert labels[parent] == r.label and foreign[parent] > 0


def test_editing_keeps_agreeing_rows(spark):
    v, labels, df = rows(spark, 300, 9)
    gap = ((v[:, None] - v[None]) ** 2).sum(-1)
    np.fill_diagonal(gap, np.inf)
    order = np.lexsort([np.broadcast_to(np.arange(300), gap.shape), gap], axis=1)[:, :3]
    agree = (labels[order] == labels[:, None])
    assert {r.id for r in B.edited(df, "features", "label", "id", every=True).collect()} == set(np.flatnonzero(agree.all(1)).tolist())
    assert {r.id for r in B.edited(df, "features", "label", "id").collect()} == set(np.flatnonzero(agree.mean(1) >= 0.5).tolist())


def test_best_balance_is_fitted_again(spark):
    _, _, df = rows(spark, 400, 3)
    tables = B.balanced_tables(df, "features", "label", "id")
    assert tables["smote_enn"].count() <= tables["smote"].count()
    assert tables["smote_enn"].select("id").subtract(tables["smote"].select("id")).count() == 0
    model, tried = B.choose_balance(tables, MD.classifiers(trees=5, depth=3)["random_forest"], df)
    assert [r["method"] for r in tried] == ["smote", "adasyn", "smote_enn"] and sum(r["chosen"] for r in tried) == 1
    chosen = next(r for r in tried if r["chosen"])
    assert chosen["accuracy"] == max(r["accuracy"] for r in tried)
    again = model.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert abs(again - chosen["accuracy"]) < 1e-12


def test_no_group_grows_with_a_cell(spark):
    """All points in one cell: blocks meet pairwise, each pair once, and none is larger than asked."""
    points = spark.range(5000).select(F.array(F.col("id").cast("double")).alias("v"), F.lit(0).alias("cell"), F.col("id").alias("p"))
    queries = spark.range(3000).select(F.array(F.col("id").cast("double")).alias("v"), (F.col("id") % 2 * 3).cast("int").alias("cell"), F.col("id").alias("q"))
    held, asked = B.block_pairs(points, queries, 500)
    for df in (held, asked):
        assert df.groupBy("cell", "part", "turn").count().agg(F.max("count")).first()[0] < 700
    assert held.join(asked.drop("v"), ["cell", "part", "turn"]).agg(F.count("*"), F.count_distinct("p", "q")).first()[:] == (5000 * 1500, 5000 * 1500)


def test_neighbours_in_blocks(spark):
    """200,000 rows in three dimensions, many at equal distances: distances are the least and ties go to the first ids."""
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(size=(150_000, 3)), np.round(rng.normal(size=(50_000, 3)) * 12) + 40])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "id long, x array<double>").select("id", array_to_vector("x").alias("features")).repartition(8)
    got = B.neighbours(df, "features", "id", 4).select("id", "other", "distance", "place").toPandas()
    assert len(got) == 4 * len(v)
    for i in [*range(0, 150_000, 3000), *range(150_000, 200_000, 1000)]:
        gap = ((v - v[i]) ** 2)
        gap = np.sqrt(gap[:, 0] + gap[:, 1] + gap[:, 2])
        gap[i] = np.inf
        want = np.lexsort([np.arange(len(v)), gap])[:4]
        assert got[got.id == i].sort_values("place").other.tolist() == want.tolist()


def test_nothing_is_fitted_twice(spark):
    """Three folds of two settings, of which one comes again in the second phase, and three balanced tables: a fit for each."""
    from pyspark.ml.classification import LogisticRegression

    fits = []

    class Counted(LogisticRegression):
        def _fit(self, dataset):
            fits.append(1)
            return super()._fit(dataset)

    _, _, df = rows(spark, 300, 3)
    folded = df.withColumn("fold", (F.col("id") % 3).cast("int"))
    _, tried = MD.phased_search(folded, Counted(maxIter=3), [{"regParam": [0.0, 5.0]}, {"fitIntercept": [True, False]}])
    assert len(tried) == 4 and len(fits) == 9
    fits.clear()
    MD.comparison(folded, {"a": Counted(maxIter=3), "b": Counted(maxIter=2)})
    assert len(fits) == 6
    fits.clear()
    B.choose_balance({"original": df, "x": df, "y": df}, Counted(maxIter=3), df)
    assert len(fits) == 2


def test_tables_to_fit_on_are_dealt_by_rows(spark):
    from leadmill.ml import prepare as P

    df = spark.range(1000).coalesce(1)
    assert P.spread(df, ["id"], 100).rdd.getNumPartitions() == 10 and P.spread(df, ["id"], 1000).rdd.getNumPartitions() == 1
