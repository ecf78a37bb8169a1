"""Boosting in blocks beside MLlib's own, and the passes that it takes."""

import numpy as np
from pyspark.ml import classification as MC
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from leadmill.ml import boosting as BO
from leadmill.ml import models as MD


def rows(spark, n=900, parts=3):
    rng = np.random.default_rng(11)
    v = np.round(rng.normal(size=(n, 4)), 2)
    v[:, 3] = 7.0  # one value only
    labels = (v[:, 0] + rng.normal(size=n) > 0).astype(int) + (v[:, 1] * v[:, 2] > 0.4)
    return spark.createDataFrame([(i, Vectors.dense(x), float(y)) for i, (x, y) in enumerate(zip(v, labels))], ["id", "features", "label"]).repartition(parts, "id")


def same(df, one, other):
    raw = lambda m, name: m.transform(df).select("id", vector_to_array("rawPrediction").alias(name), F.col("prediction").alias(f"{name}_class"))
    both = raw(one, "a").join(raw(other, "b"), "id").collect()
    assert len(both) == df.count() and all(r["a_class"] == r["b_class"] for r in both)
    assert max(abs(x - y) for r in both for x, y in zip(r["a"], r["b"])) < 1e-9


def beside(booster, df, **more):
    named = {"classifier": booster, "labelCol": "label", "featuresCol": "features", **more}
    return BO.BoostedRest(**named).fit(df), MC.OneVsRest(**named).fit(df)


def test_trees_are_those_of_the_library(spark, monkeypatch):
    df = rows(spark).cache()
    ours, theirs = beside(MC.GBTClassifier(maxIter=6, maxDepth=3, seed=5, minInstancesPerNode=4), df)
    same(df, ours, theirs)
    for a, b in zip(ours.models, theirs.models):
        assert [t.numNodes for t in a.trees] == [t.numNodes for t in b.trees] and a.treeWeights == b.treeWeights
        assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())
    monkeypatch.setattr(BO, "TREE_FROM", 1)  # counts of many partitions are added up elsewhere than in the driver
    monkeypatch.setattr(BO, "BLOCK_ROWS", 100)
    same(df, BO.BoostedRest(classifier=MC.GBTClassifier(maxIter=6, maxDepth=3, seed=5, minInstancesPerNode=4)).fit(df), theirs)


def test_odd_tables_as_in_the_library(spark):
    flat = spark.createDataFrame([(i, Vectors.dense([1.0, 2.0]), float(i % 2)) for i in range(9)], ["id", "features", "label"])  # nothing to split by
    one = spark.createDataFrame([(i, Vectors.dense([float(i)]), 2.0) for i in range(5)], ["id", "features", "label"])  # classes 0 and 1 have no rows
    apart = spark.createDataFrame([(i, Vectors.dense([float(i), float(-i)]), float(i > 2)) for i in range(6)], ["id", "features", "label"])
    nulls = apart.withColumn("label", F.when(F.col("id") != 1, F.col("label")))
    for df in (flat, one, apart, nulls):
        same(df, *beside(MC.GBTClassifier(maxIter=3, maxDepth=2, seed=1), df))


def test_what_is_not_covered_goes_to_the_library(spark):
    df = rows(spark, 200, 1).cache()
    same(df, *beside(MC.GBTClassifier(maxIter=2, maxDepth=2, seed=3, subsamplingRate=0.5), df))


def test_a_saved_model_is_read_again(spark, tmp_path):
    df = rows(spark, 200, 1).cache()
    model = MD.classifiers(rounds=3, boost_depth=2)["gradient_boosting"].fit(df)
    model.write().save(str(tmp_path / "model"))
    same(df, model, MC.OneVsRestModel.load(str(tmp_path / "model")))


def test_all_classes_are_grown_in_one_pass(spark):
    """A pass per level and round, whatever the number of classes, besides those that prepare."""
    df, sc = rows(spark).cache(), spark.sparkContext
    df.count()
    sc.setJobGroup("boosting", "boosting")
    try:
        MD.classifiers(rounds=5, boost_depth=3)["gradient_boosting"].fit(df)
        assert len(sc.statusTracker().getJobIdsForGroup("boosting")) <= 5 * 3 + 12
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_forests_go_before_others(spark):
    df = rows(spark, 60, sc_parts := spark.sparkContext.defaultParallelism)
    assert df.rdd.getNumPartitions() == sc_parts
    running, most, order = [], [], []

    def work(model, n):
        running.append(n)
        most.append(len(running))
        order.append(model)
        running.remove(n)
        return n

    forest, other = MC.RandomForestClassifier(), MC.LogisticRegression()
    assert MD.in_turn([(other, 0), (forest, 1), (other, 2), (forest, 3)], work, df, 4) == [0, 1, 2, 3]
    assert order[:2] == [forest, forest] and most[:2] == [1, 1]
    assert MD.classifiers()["random_forest"].getCacheNodeIds()
