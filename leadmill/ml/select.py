"""Feature selection: variance, correlation, mutual information, ANOVA, principal components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import feature as MF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.operators.stats import correlations, per_column


def low_variance(df: DataFrame, columns: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """Sample variance per column and whether it exceeds the threshold."""
    return per_column(df, columns, {"variance": F.var_samp}).withColumn("kept", F.col("variance") > threshold)


def redundant(df: DataFrame, columns: Sequence[str], limit: float = 0.95) -> DataFrame:
    """Columns that correlate beyond the limit with an earlier column (the later one of each pair)."""
    return correlations(df, columns).filter(F.abs("correlation") > limit).select(F.col("right").alias("column")).distinct()


def anova_f(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """One-way F value per column, from class counts, sums and squares of a single pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])
    per_class = df.select(label, F.inline(pairs)).filter("v IS NOT NULL").groupBy("column", label).agg(
        F.count("*").alias("n"), F.avg("v").alias("m"), F.coalesce(F.var_samp("v"), F.lit(0.0)).alias("s2"))
    total = per_class.groupBy("column").agg(
        F.sum("n").alias("n"), F.count("*").alias("k"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("m"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("sq"), F.sum((F.col("n") - 1) * F.col("s2")).alias("within"))
    between = F.col("sq") - F.col("n") * F.col("m") * F.col("m")
    score = F.try_divide(between / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k")))
    return total.select("column", score.alias("f_value"))


def mutual_information(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Plug-in mutual information of (already binned) columns with the label, in nats."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
    joint = df.select(label, F.inline(pairs)).groupBy("column", "v", label).agg(F.count("*").alias("n"))
    by_value = joint.groupBy("column", "v").agg(F.sum("n").alias("nv"))
    by_label = joint.groupBy("column", label).agg(F.sum("n").alias("nl"))
    total = joint.groupBy("column").agg(F.sum("n").alias("t"))
    held = (joint.join(by_value.withColumnRenamed("v", "v2"), (joint["column"] == by_value["column"]) & joint["v"].eqNullSafe(F.col("v2")))
            .drop(by_value["column"]).join(by_label, ["column", label]).join(total, "column"))
    return held.groupBy("column").agg(F.sum(F.col("n") / F.col("t") * F.ln(
        F.col("n") * F.col("t") / (F.col("nv") * F.col("nl")))).alias("mutual_information"))


def select_best(df: DataFrame, k: int, features: str = "features", label: str = "label"):
    """Fitted selector of the k best ANOVA features of a vector column."""
    selector = MF.UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol="selected", selectionMode="numTopFeatures")
    return selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k).fit(df)


def principal_components(df: DataFrame, features: str, size: int, share: float = 0.95) -> DataFrame:
    """Components that together explain the share of the variance; column ``components``."""
    model = MF.PCA(k=size, inputCol=features, outputCol="all_components").fit(df)
    explained, n = 0.0, 0
    for value in model.explainedVariance.toArray():
        n, explained = n + 1, explained + float(value)
        if explained >= share:
            break
    return model.transform(df).withColumn("components", F.slice(vector_to_array("all_components"), 1, n)).drop("all_components")
