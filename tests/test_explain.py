"""Permutation importance beside numpy, meanings of slots, areas of classes, searches that stop early."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leadmill.ml import explain as EX
from leadmill.ml import models as MD
from leadmill.ml import prepare as P


def signal(spark, n=5000, seed=2):
    """Four features, of which the label follows the second most, then the first; the third a little, the fourth not."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = ((1.2 * x[:, 0] + 3 * x[:, 1] + 0.4 * x[:, 2] + rng.normal(size=n) * 0.3) > 0).astype(float)
    df = spark.createDataFrame([(i, v, float(c)) for i, (v, c) in enumerate(zip(x.tolist(), y))], "id long, v array<double>, label double")
    return x, y, df.select("id", array_to_vector("v").alias("features"), "label").repartition(6)


def test_a_permutation_moves_one_column(spark):
    df = spark.range(3000).select("id", F.array(F.col("id") * 1.0, F.col("id") % 7 * 1.0, F.lit(5.0)).alias("v"))
    rows = EX.permuted(df, "v", "id", 3, repeats=2).collect()
    assert len(rows) == 3000 * 6
    for column in range(3):
        for turn in range(2):
            own = [r for r in rows if r["column"] == column and r["turn"] == turn]
            assert sorted(r["id"] for r in own) == list(range(3000))
            assert sorted(r["v"][column] for r in own) == sorted([float(i), float(i % 7), 5.0][column] for i in range(3000))
            assert all(r["v"][c] == [float(r["id"]), float(r["id"] % 7), 5.0][c] for r in own for c in range(3) if c != column)
    first = [[r["v"][0] for r in sorted(rows, key=lambda r: r["id"]) if r["column"] == 0 and r["turn"] == t] for t in (0, 1)]
    assert first[0] != first[1] and sum(v == i for i, v in enumerate(first[0])) < 20


def test_importance_ranks_as_brute_force(spark):
    x, y, df = signal(spark)
    model = RandomForestClassifier(numTrees=20, maxDepth=6, seed=1).fit(df)
    got = {r["feature"]: r for r in EX.permutation_importance(model, df, ["a", "b", "c", "d"]).collect()}
    rng, lost = np.random.default_rng(0), {}
    def accuracy(values):
        made = spark.createDataFrame([(v, float(c)) for v, c in zip(values.tolist(), y)], "v array<double>, label double").select(array_to_vector("v").alias("features"), "label")
        return model.transform(made).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    base = accuracy(x)
    for n, name in enumerate("abcd"):
        moved = x.copy()
        moved[:, n] = rng.permutation(moved[:, n])
        lost[name] = base - accuracy(moved)
    assert sorted(got, key=lambda f: got[f]["place"]) == sorted(lost, key=lambda f: -lost[f])
    assert all(abs(got[f]["importance"] - lost[f]) < 0.03 for f in lost)


def test_slots_follow_the_stages(spark):
    df = spark.createDataFrame([(float(i), float(i % 5), "xy"[i % 2], f"k{i % 3}", f"word{i % 4} other{i % 4} common") for i in range(40)], "a double, b double, c string, d string, t string")
    model = P.transformer(["a", "b"], ["c", "d"], "t", terms=30).fit(df)
    rows = EX.slots(model, model.transform(df)).orderBy("slot").collect()
    assert [(r["column"], r["value"], r["type"]) for r in rows[:9]] == [
        ("a", None, "number"), ("b", None, "number"), ("c", "x", "category"), ("c", "y", "category"), ("c", None, "category"),
        ("d", "k0", "category"), ("d", "k1", "category"), ("d", "k2", "category"), ("d", None, "category")]
    assert {r["value"] for r in rows[9:]} >= {"word1", "other2", "word3 other3"} and all(r["column"] == "t" and r["type"] == "text" for r in rows[9:])
    assert [r["name"] for r in rows[2:4]] == ["c_hot_x", "c_hot_y"]
    summed = EX.importance_by_slot(EX.slots(model, model.transform(df)), [1.0] * len(rows)).groupBy("column").agg(F.sum("importance").alias("s")).collect()
    assert {r["column"]: r["s"] for r in summed} == {"a": 1, "b": 1, "c": 3, "d": 4, "t": len(rows) - 9}


def test_slots_without_scaling(spark):
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features")]).fit(df)
    assert [r["column"] for r in EX.slots(model, model.transform(df)).orderBy("slot").collect()] == ["a", "b"]


def test_areas_of_three_classes(spark):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 3, 900), np.round(rng.normal(size=(900, 4)), 1)
    s[np.arange(900), y] += 0.8
    df = spark.createDataFrame([(int(a), b) for a, b in zip(y, s.tolist())], "label int, scores array<double>").repartition(5)
    got = {r["class"]: (r["rows"], r["auc"]) for r in MD.class_areas(df, "label", "scores").collect()}
    for c in range(3):
        pos, neg = s[y == c, c], s[y != c, c]
        want = (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2
        assert got[c][0] == (y == c).sum() and abs(got[c][1] - want) < 1e-12
    assert got[3] == (0, None)
    whole = MD.weighted_area(MD.class_areas(df, "label", "scores")).first()[0]
    assert abs(whole - sum(n * a for n, a in got.values() if a is not None) / 900) < 1e-12


def test_boosting_stops_early_and_searches_in_phases(spark):
    _, _, df = signal(spark, 900)
    best, tried = MD.boosted_search(df, {"maxDepth": [1, 2, 4], "stepSize": [0.1, 0.5], "minInstancesPerNode": [1, 20]}, first=2, rounds=25, k=2, tolerance=0.01)
    assert {t["phase"] for t in tried} >= {1, 2} and len({t["setting"] for t in tried}) == len(tried) >= 5
    assert all(1 <= t["rounds"] <= 25 for t in tried) and min(t["rounds"] for t in tried) < 25
    top = max(tried, key=lambda t: t["auc"])
    assert best.getMaxIter() == max(t["rounds"] for t in tried if t["auc"] == top["auc"]) or best.getMaxIter() == top["rounds"]
    assert f"maxDepth={best.getMaxDepth()}" in top["setting"] and top["auc"] > 0.9


def test_permuted_rows_are_never_broadcast(spark):
    """However small the stored table is, the rows by column and repeat meet in a sorted join."""
    df = spark.range(200).select("id", F.array(F.col("id") * 1.0, F.col("id") % 7 * 1.0).alias("v"))
    plan = EX.permuted(df, "v", "id", 2)._jdf.queryExecution().sparkPlan().toString()
    assert next(line for line in plan.splitlines() if "Join" in line).split("SortMergeJoin")[0].strip(" :+-") == ""


def test_vocabulary_is_that_of_the_counting_estimator(spark):
    from pyspark.ml.feature import CountVectorizer

    rng = np.random.default_rng(3)
    docs = [[f"w{x}" for x in rng.zipf(1.5, rng.integers(0, 30)) if x < 400] + ["everywhere"] for _ in range(300)]
    df = spark.createDataFrame([(d,) for d in docs], "t array<string>")
    mine = P.Vocabulary("t", "v", 40, 2.0, 0.95).fit(df)
    theirs = CountVectorizer(inputCol="t", outputCol="v", vocabSize=40, minDF=2.0, maxDF=0.95).fit(df)
    often = {}
    for term in (t for d in docs for t in d):
        often[term] = often.get(term, 0) + 1
    assert [often[t] for t in mine.vocabulary] == [often[t] for t in theirs.vocabulary]  # the estimator leaves ties open
    assert mine.vocabulary == sorted(mine.vocabulary, key=lambda t: (-often[t], t)) and "everywhere" not in mine.vocabulary
