"""Descriptive statistics and two-sample tests, each from one aggregate."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.operators.quantiles import exact_quantiles


def sample_skewness(value: Column) -> Column:
    """Bias-corrected skewness; null below three values."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(value))


def sample_kurtosis(value: Column) -> Column:
    """Bias-corrected excess kurtosis; null below four values."""
    n = F.count(value).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6))


def per_column(df: DataFrame, columns: Sequence[str], measures: dict) -> DataFrame:
    """One row per column with the named aggregates, all from a single pass."""
    row = df.agg(*[measure(F.col(c)).alias(f"{c}__{name}") for c in columns for name, measure in measures.items()])
    structs = [F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{name}").alias(name) for name in measures])
               for c in columns]
    return row.select(F.inline(F.array(*structs)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes, quartiles and shape per numeric column."""
    shape = per_column(df, columns, {
        "n": F.count, "mean": F.avg, "std": F.stddev,
        "minimum": lambda c: F.min(c).cast("double"), "maximum": lambda c: F.max(c).cast("double"),
        "skewness": sample_skewness, "kurtosis": sample_kurtosis})
    marks = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    return shape.join(marks, "column").withColumns({
        "iqr": F.col("q3") - F.col("q1"),
        "mean_far_from_median": F.abs(F.col("mean") - F.col("median")) > F.col("std") * 0.5})


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts of equal-width bins, the last one closed on both sides."""
    span = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))).scalar()
    held = df.select(F.col(column).cast("double").alias("v"), span.alias("span")).filter("v IS NOT NULL")
    place = F.floor((F.col("v") - F.col("span.lo")) / (F.col("span.hi") - F.col("span.lo")) * bins)
    return held.groupBy(F.least(place, F.lit(bins - 1).cast("bigint")).alias("bin")).agg(F.count("*").alias("rows"))


def five_numbers(df: DataFrame, by: str, column: str) -> DataFrame:
    """Minimum, quartiles and maximum per category."""
    names = ["minimum", "q1", "median", "q3", "maximum"]
    found = exact_quantiles(df, [column], [0, 0.25, 0.5, 0.75, 1], [by])
    return found.select(by, *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"{a}__{b}").alias("correlation"))
        for a, b in pairs])))


def _t_two_sided(t: float, freedom: float) -> float:
    """P(|T| > t) by the continued fraction of the incomplete beta function."""
    x = freedom / (freedom + t * t)
    a, b = freedom / 2, 0.5
    if x >= (a + 1) / (a + b + 2):
        a, b, x, flip = b, a, 1 - x, True
    else:
        flip = False
    if x <= 0:
        tail = 0.0
    else:
        front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
        tiny = 1e-300
        c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
        total = d
        for m in range(1, 300):
            even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            for step in (even, odd):
                d = 1 / ((1 + step * d) or tiny)
                c = (1 + step / c) or tiny
                total *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        tail = front * total
    return 1 - tail if flip else tail


def two_sample(df: DataFrame, side: Column, column: str) -> DataFrame:
    """Pooled two-sample t test and standardised effect size of true against false rows; one row."""
    value = F.col(column).cast("double")

    def part(condition: Column, name: str) -> list[Column]:
        kept = F.when(condition, value)
        return [F.count(kept).alias(f"n_{name}"), F.avg(kept).alias(f"mean_{name}"),
                F.var_samp(kept).alias(f"var_{name}")]

    row = df.agg(*part(side, "on"), *part(~side, "off"))
    n1, n2 = F.col("n_on"), F.col("n_off")
    pooled = ((n1 - 1) * F.col("var_on") + (n2 - 1) * F.col("var_off")) / (n1 + n2 - 2)
    gap = F.col("mean_on") - F.col("mean_off")
    tested = row.withColumns({
        "t_statistic": gap / F.sqrt(pooled * (1 / n1 + 1 / n2)),
        "freedom": (n1 + n2 - 2).cast("double"), "cohens_d": gap / F.sqrt(pooled)})
    # the tail probability has no built-in; it is asked for on this single row only
    tail = F.udf(lambda t, f: None if t is None else _t_two_sided(abs(t), f), "double")
    size = F.abs(F.col("cohens_d"))
    return (tested.withColumn("p_value", tail("t_statistic", "freedom"))
            .withColumns({"significant": F.col("p_value") < 0.05,
                          "effect": F.when(size < 0.2, "Small").when(size < 0.5, "Medium").otherwise("Large")})
            .drop("var_on", "var_off", "freedom"))
