"""Classifiers, ensembles, grid search, comparison, explanation, scoring and storage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml import classification as MC
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.ml import prepare as P
from leadmill.ml.balance import neighbours, oversample
from leadmill.ml.boosting import BoostedRest
from leadmill.operators.sinks import fresh_folder


FAMILIES = {"random_forest": "trees", "gradient_boosting": "trees", "logistic_regression": "linear", "linear_svm": "linear"}


def classifiers(label: str = "label", features: str = "features", seed: int = 42, classes: int = 3, trees: int = 100, depth: int = 10,
                rounds: int = 100, boost_depth: int = 4, iterations: int = 100) -> dict[str, Estimator]:
    """The model families under one set of names; boosting and linear margins are one-against-rest beyond two classes.

    The sizes are parameters: trees and their depth, boosting rounds and their depth, iterations of the linear models."""
    named = {"labelCol": label, "featuresCol": features}
    boosted = MC.GBTClassifier(maxIter=rounds, maxDepth=boost_depth, seed=seed, **named)
    margin = MC.LinearSVC(maxIter=iterations, **named)
    rest = (lambda m, kind=MC.OneVsRest: kind(classifier=m, parallelism=classes, **named)) if classes > 2 else (lambda m, kind=None: m)
    # with its rows' nodes kept, a forest does not walk down every tree again for each level
    forest = MC.RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True, **named)
    return {"random_forest": forest, "gradient_boosting": rest(boosted, BoostedRest),
            "logistic_regression": MC.LogisticRegression(maxIter=iterations, **named), "linear_svm": rest(margin)}


def soft_vote(df: DataFrame, models: Sequence, label: str = "label") -> DataFrame:
    """Average class probabilities of several fitted models and the class they favour.

    One-against-rest models give margins only: those of boosting become probabilities as in its own class, 1 / (1 + exp(-2 x)),
    and are scaled to a sum of one."""
    scored = df
    for i, model in enumerate(models):
        scored = model.transform(scored)
        if "probability" in scored.columns:
            scored = scored.withColumn(f"_p{i}", vector_to_array("probability"))
        else:
            each = F.transform(vector_to_array("rawPrediction"), lambda x: 1 / (1 + F.exp(-2 * x)))
            scored = (scored.withColumn(f"_p{i}", each)
                      .withColumn(f"_p{i}", F.transform(f"_p{i}", lambda p: p / F.aggregate(f"_p{i}", F.lit(0.0), lambda a, b: a + b))))
        scored = scored.drop("rawPrediction", "probability", "prediction")
    mean = scored["_p0"]
    for i in range(1, len(models)):
        mean = F.zip_with(mean, F.col(f"_p{i}"), lambda a, b: a + b)
    mean = F.transform(mean, lambda p: p / len(models))
    return scored.withColumn("probabilities", mean).drop(*[f"_p{i}" for i in range(len(models))]).withColumn(
        "prediction", (F.array_position("probabilities", F.array_max("probabilities")) - 1).cast("double"))


def nearest_vote(train: DataFrame, features: str, label: str, identity: str, k: int = 5) -> DataFrame:
    """Distance-weighted vote of the k nearest rows, leaving the row itself out; with two rows or more, all have a vote."""
    near = neighbours(train, features, identity, k, [label])
    votes = near.groupBy("id", f"other_{label}").agg(F.sum(1 / (F.col("distance") + 1e-9)).alias("w"))
    return votes.groupBy("id").agg(F.max_by(f"other_{label}", F.struct("w", f"other_{label}")).alias("prediction"))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(F.count("*").alias("rows"))


def class_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class of a confusion table."""
    actual = matrix.groupBy("label").agg(F.sum("rows").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0)).alias("hit"))
    guessed = matrix.groupBy(F.col("prediction").alias("label")).agg(F.sum("rows").alias("guessed"))
    both = actual.join(guessed, "label", "left").na.fill(0, ["guessed"])
    p, r = F.coalesce(F.try_divide("hit", "guessed"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    return both.select("label", "support", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"), "hit")


def summary(matrix: DataFrame) -> DataFrame:
    """Accuracy with macro and weighted averages; one row."""
    report = class_report(matrix)

    def weighted(c: str):
        return F.sum(F.col(c) * F.col("support")) / F.sum("support")

    return report.agg((F.sum("hit") / F.sum("support")).alias("accuracy"), *[F.avg(c).alias(f"{c}_macro") for c in ("precision", "recall", "f1")],
                      *[weighted(c).alias(f"{c}_weighted") for c in ("precision", "recall", "f1")])


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve of the exact scores, ties counted half; one row.

    Scores are counted per value and dealt by range; each range sums its own part and the totals of the ranges below are
    added, so no task orders all scores."""
    from pyspark.sql import Window

    counts = df.groupBy(F.col(score).alias("s")).agg(F.sum(F.col(label).cast("double")).alias("pos"), F.sum(1 - F.col(label).cast("double")).alias("neg"))
    path = fresh_folder(df.sparkSession, "scores")
    counts.repartitionByRange("s").withColumn("piece", F.spark_partition_id()).write.parquet(path)
    pieces = df.sparkSession.read.parquet(path)
    totals = pieces.groupBy("piece").agg(F.sum("neg").alias("piece_neg"))
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = totals.select("piece", F.coalesce(F.sum("piece_neg").over(before), F.lit(0.0)).alias("base"))
    inside = Window.partitionBy("piece").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("base") + F.coalesce(F.sum("neg").over(inside), F.lit(0.0))
    return pieces.join(bases, "piece").withColumn("area", F.col("pos") * (below + F.col("neg") / 2)).agg(
        (F.sum("area") / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def class_areas(df: DataFrame, label: str, scores: str) -> DataFrame:
    """(class, rows, auc): area under the ROC curve of each class against the rest, for an array of one score per class and
    labels that are places in it. Exact, ties counted half.

    All classes are counted in one pass; each range sums its own part of the order, and the counts of the ranges before
    it are added by class."""
    from pyspark.sql import Window

    long = df.select(F.col(label).cast("int").alias("_l"), F.posexplode(scores).alias("class", "s"))
    hit = (F.col("_l") == F.col("class")).cast("long")
    counts = long.groupBy("class", "s").agg(F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg"))
    path = fresh_folder(df.sparkSession, "scores")
    counts.repartitionByRange("class", "s").withColumn("piece", F.spark_partition_id()).write.parquet(path)
    pieces = df.sparkSession.read.parquet(path)
    before = Window.partitionBy("class").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)  # a row per range and class
    bases = (pieces.groupBy("class", "piece").agg(F.sum("neg").alias("_n"))
             .select("class", "piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base")))
    inside = Window.partitionBy("class", "piece").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("base") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    return (pieces.join(bases, ["class", "piece"]).withColumn("area", F.col("pos") * (below + F.col("neg") / 2)).groupBy("class")
            .agg(F.sum("pos").alias("rows"), F.try_divide(F.sum("area"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc")))


def weighted_area(areas: DataFrame) -> DataFrame:
    """One row: the areas of all classes, weighted by their rows; a class without rows or without others has no part."""
    known = areas.filter("auc IS NOT NULL")
    return known.agg((F.sum(F.col("auc") * F.col("rows")) / F.sum("rows")).alias("auc_weighted"))


def in_turn(jobs: Sequence[tuple], work, df: DataFrame, parallelism: int) -> list:
    """``work`` of every job, which starts with an estimator; of jobs on ``df``, several at a time.

    Unless there is a core for every task, forests go first, no more of them at a time than use all cores: they have few long
    tasks and hold much memory, and the many short passes of other models would wait for each of these tasks."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, max(df.rdd.getNumPartitions(), 1)
    wide, crowded = -(-cores // parts), min(parallelism, len(jobs)) * parts > cores
    forests = [n for n, job in enumerate(jobs) if crowded and isinstance(job[0], MC.RandomForestClassifier)]
    others, found = [n for n in range(len(jobs)) if n not in forests], {}
    for part, most in ((forests, min(parallelism, wide)), (others, parallelism)):
        with ThreadPoolExecutor(most) as pool:
            found |= zip(part, pool.map(lambda n: work(*jobs[n]), part))
    return [found[n] for n in range(len(jobs))]


def fitted(models: Sequence[Estimator], df: DataFrame, identity: str = "id", parallelism: int = 4) -> list:
    """Every model fitted on ``df``, several at a time."""
    dealt = P.spread(df, [identity])
    own = dealt.storageLevel == StorageLevel.NONE
    if own:
        dealt = dealt.persist()
    try:
        return in_turn([(model,) for model in models], lambda model: model.fit(dealt), dealt, parallelism)
    finally:
        if own:
            dealt.unpersist()


def cross_validated(df: DataFrame, models: Sequence[Estimator], judge, fold: str = "fold", k: int = 3, parallelism: int = 4) -> list[list[float]]:
    """What ``judge`` says of each model on every fold, fitted on the others. Nothing is fitted on the whole table."""
    held = P.spread(df, df.columns[:1]).persist()
    try:
        def judged(model: Estimator, n: int) -> float:
            return judge.evaluate(model.fit(held.filter(F.col(fold) != n)).transform(held.filter(F.col(fold) == n)))

        found = in_turn(list(product(models, range(k))), judged, held, parallelism)
    finally:
        held.unpersist()
    return [found[n * k:(n + 1) * k] for n in range(len(models))]


def phased_search(df: DataFrame, estimator: Estimator, phases: Sequence[Mapping[str, Sequence]], label: str = "label", fold: str = "fold", k: int = 3,
                  parallelism: int = 4) -> tuple[Estimator, list[dict]]:
    """Successive grids, each starting from the best setting of the one before.

    Gives the estimator with the best setting of all phases and one record per setting tried: phase, setting, mean F1 and
    its spread over the folds. A setting that comes again in a later phase is not fitted again."""
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="f1")
    tried, known, best_score, best_estimator = [], {}, float("-inf"), estimator
    for phase, grid in enumerate(phases, 1):
        names = sorted(grid)
        settings = [dict(zip(names, values)) for values in product(*[grid[n] for n in names])]
        models = [estimator.copy({estimator.getParam(n): v for n, v in setting.items()}) for setting in settings]
        whole = [repr(sorted((p.name, v) for p, v in model.extractParamMap().items())) for model in models]
        new = [n for n, key in enumerate(whole) if key not in known]
        known |= dict(zip([whole[n] for n in new], cross_validated(df, [models[n] for n in new], judge, fold, k, parallelism)))
        for setting, model, key in zip(settings, models, whole):
            mean, spread = float(np.mean(known[key])), float(np.std(known[key]))
            tried.append({"phase": phase, "setting": ", ".join(f"{n}={v}" for n, v in setting.items()), "f1": mean, "spread": spread})
            if mean > best_score:
                best_score, best_estimator = mean, model
        estimator = best_estimator
    return best_estimator, tried


def boosted_search(df: DataFrame, space: Mapping[str, Sequence], first: int = 8, label: str = "label", features: str = "features", identity: str = "id",
                   rounds: int = 200, tolerance: float = 0.001, k: int = 3, seed: int = 42, parallelism: int = 4) -> tuple[Estimator, list[dict]]:
    """Search over two-class boosted trees that stop adding rounds when a validation share no longer improves.

    Phase one tries ``first`` random settings of ``space`` (parameter name to ordered values). Phase two tries, around the
    best, every neighbouring value of one parameter at a time; phase three every pair of the two parameters that helped
    most. Folds and the validation rows (one in ten) go by hash. Gives the estimator of the best setting, with the mean
    rounds that it used, and a record per setting: phase, setting, rounds used, mean area and its spread over the folds."""
    from random import Random

    path, names = fresh_folder(df.sparkSession, "search"), sorted(space)
    share = F.pmod(F.xxhash64(identity, F.lit(seed + 1)), F.lit(10)) == 0
    P.folds(df, label, [identity], k, seed).withColumn("_watched", share).write.parquet(path)
    held, judged, records = df.sparkSession.read.parquet(path), {}, []

    def estimator(setting: tuple, most: int) -> Estimator:
        model = MC.GBTClassifier(labelCol=label, featuresCol=features, seed=seed, maxIter=most, validationTol=tolerance)
        return model.copy({model.getParam(n): space[n][v] for n, v in zip(names, setting)})

    def fitted(setting: tuple, fold: int) -> tuple[int, float]:
        model = estimator(setting, rounds).setValidationIndicatorCol("_watched").fit(held.filter(F.col("fold") != fold))
        scored = model.transform(held.filter(F.col("fold") == fold)).withColumn("_score", vector_to_array("probability")[1])
        return model.getNumTrees, auc(scored, label, "_score").first()[0]

    def judge(phase: int, settings: Sequence[tuple]) -> None:
        new = [s for s in dict.fromkeys(settings) if s not in judged]
        with ThreadPoolExecutor(parallelism) as pool:
            found = list(pool.map(lambda job: fitted(*job), product(new, range(k))))
        for n, setting in enumerate(new):
            own = found[n * k:(n + 1) * k]
            areas = [a if a is not None else 0.5 for _, a in own]
            mean = sum(areas) / k
            judged[setting] = mean, max(1, round(sum(r for r, _ in own) / k))
            records.append({"phase": phase, "setting": ", ".join(f"{name}={space[name][v]}" for name, v in zip(names, setting)), "rounds": judged[setting][1],
                            "auc": mean, "spread": (sum((a - mean) ** 2 for a in areas) / k) ** 0.5})

    def best() -> tuple:
        return max(judged, key=lambda s: (judged[s][0], [-v for v in s]))

    def beside(setting: tuple, n: int) -> list[tuple]:
        return [(*setting[:n], v, *setting[n + 1:]) for v in (setting[n] - 1, setting[n] + 1) if 0 <= v < len(space[names[n]])]

    dice = Random(seed)
    judge(1, [tuple(dice.randrange(len(space[n])) for n in names) for _ in range(first)])
    centre = best()
    judge(2, [s for n in range(len(names)) for s in beside(centre, n)])
    gains = {n: max((judged[s][0] for s in beside(centre, n)), default=float("-inf")) for n in range(len(names))}
    pair = sorted(gains, key=lambda n: (-gains[n], n))[:2]
    judge(3, [s for t in beside(centre, pair[0]) for s in beside(t, pair[-1])] if len(pair) == 2 else [])
    return estimator(best(), judged[best()][1]), records


def comparison(df: DataFrame, models: Mapping[str, Estimator], fold: str = "fold", k: int = 3, label: str = "label") -> list[dict]:
    """Cross-validated accuracy of each model: mean, spread, its family's mean, and whether it is best or most stable."""
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    found = cross_validated(df, list(models.values()), judge, fold, k, parallelism=2 * k)
    rows = [{"model": name, "family": FAMILIES.get(name, name), "cv_mean": float(np.mean(own)), "cv_spread": float(np.std(own))} for name, own in zip(models, found)]
    best, stable = max(rows, key=lambda r: r["cv_mean"])["model"], min(rows, key=lambda r: r["cv_spread"])["model"]
    for r in rows:
        own = [x["cv_mean"] for x in rows if x["family"] == r["family"]]
        r |= {"family_mean": sum(own) / len(own), "is_best": r["model"] == best, "is_most_stable": r["model"] == stable}
    return rows


def training_run(df: DataFrame, numbers: Sequence[str], label: str, identity: str, path: str, phases: Sequence[Mapping[str, Sequence]],
                 as_of, version: str, keep: int = 4, k: int = 3) -> DataFrame:
    """One run: split, prepare, select, balance, search, fit, report and save; gives the run's record.

    ``path/model`` holds preparation, selection and model as one pipeline, ``path/metadata`` the record as JSON: version,
    time, features, classes, row counts, best setting and the test report."""
    parts = P.split(df, label, [identity], 0.25)
    train, test = parts.filter("NOT is_test"), parts.filter("is_test")
    prepare = Pipeline(stages=[P.transformer(numbers, output="all_features"), UnivariateFeatureSelector(
        featuresCol="all_features", labelCol=label, outputCol="features", selectionMode="numTopFeatures")
        .setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(keep)]).fit(train)
    staged = fresh_folder(df.sparkSession, "train")
    prepare.transform(train).select(identity, "features", label).write.parquet(staged)
    ready = df.sparkSession.read.parquet(staged)
    balanced = oversample(ready, "features", label, identity).withColumn(identity, F.xxhash64(vector_to_array("features")).cast("string"))
    folded = fresh_folder(df.sparkSession, "folds")
    P.folds(balanced, label, [identity], k).write.parquet(folded)  # every fit of the search reads the same stored rows
    balanced = df.sparkSession.read.parquet(folded)
    estimator, tried = phased_search(balanced, classifiers(label)["logistic_regression"], phases, label=label, k=k)
    model = PipelineModel([*prepare.stages, *fitted([estimator], balanced, identity)])
    save(model, f"{path}/model")
    report = summary(confusion(model.transform(test), label)).first()
    selected = [list(numbers)[i] for i in prepare.stages[-1].selectedFeatures]
    best = max(tried, key=lambda r: r["f1"])
    record = df.sparkSession.createDataFrame(
        [(version, as_of, selected, ready.count(), test.count(), best["setting"], float(report["accuracy"]), float(report["f1_macro"]))],
        "version string, created timestamp, features array<string>, train_rows bigint, test_rows bigint, setting string, accuracy double, f1_macro double")
    record.write.mode("append").json(f"{path}/metadata")
    return record


def importance(spark, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    """Feature importance as ranked rows."""
    rows = sorted(zip(names, map(float, values)), key=lambda p: (-p[1], p[0]))
    return spark.createDataFrame([(n, v, i + 1) for i, (n, v) in enumerate(rows)], "feature string, importance double, place int")


def linear_contributions(df: DataFrame, coefficients: Sequence[float], names: Sequence[str], features: str = "features") -> DataFrame:
    """Mean absolute contribution w * (x - mean) per feature of a linear model: exact for that family."""
    values = df.select(vector_to_array(features).alias("v"))
    wide = values.select(*[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    means = wide.agg(F.struct(*[F.avg(n).alias(n) for n in names])).scalar()
    held = wide.withColumn("_m", means)
    return held.agg(F.array(*[F.struct(F.lit(n).alias("feature"), F.avg(F.abs(F.lit(float(w)) * (F.col(n) - F.col("_m")[n]))).alias("contribution"))
                              for n, w in zip(names, coefficients)]).alias("r")).select(F.inline("r"))


def score(df: DataFrame, model, version: str, keep: Sequence[str]) -> DataFrame:
    """Class, confidence and score (probability of the highest class) per row."""
    p = vector_to_array("probability")
    return model.transform(df).select(*keep, F.col("prediction").cast("int").alias("predicted_class"), F.array_max(p).alias("confidence_level"),
                                      F.element_at(p, -1).alias("predicted_score"), F.lit(version).alias("model_version"))


def save(model: PipelineModel, path: str, slot_table: DataFrame | None = None) -> None:
    """The model, and beside it what the slots of its feature vector mean."""
    model.write().overwrite().save(path)
    if slot_table is not None:
        slot_table.write.mode("overwrite").json(f"{path}/slots")


def load_slots(spark, path: str) -> DataFrame:
    return spark.read.schema("slot int, name string, column string, value string, type string, importance double").json(f"{path}/slots")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
