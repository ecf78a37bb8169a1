"""Data-quality operators: profiles, outliers, imputation, scores, rules, thresholds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions.expr import flag
from leadmill.operators.quantiles import bounded_quantiles, exact_quantiles, wide_quantiles, with_row
from leadmill.operators.stats import per_column, sample_skewness


# --- scores ------------------------------------------------------------------
def share_known(columns: Sequence[str]) -> Column:
    """Share of the columns that are not null in the row."""
    return sum((flag(F.col(c).isNotNull()) for c in columns), F.lit(0)) / F.lit(float(len(columns)))


def record_score(text_quality: Column) -> Column:
    """Mean of essential completeness, text quality and engagement completeness, 0 to 1."""
    return (share_known(K.ESSENTIAL_COLUMNS) + text_quality / 3.0 + share_known(K.ENGAGEMENT_COUNTS)) / 3.0


# --- profiles ------------------------------------------------------------------
def missing_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage per column with the class high (> 50) or moderate (10 to 50)."""
    total = F.count(F.lit(1))
    table = per_column(df, df.columns, {"missing": lambda c: total - F.count(c),
                                        "missing_pct": lambda c: (total - F.count(c)) * 100.0 / total})
    pct = F.col("missing_pct")
    return table.withColumn("level", F.when(pct > 50, "high").when(pct > 10, "moderate").otherwise("low"))


def cell_quality(df: DataFrame) -> DataFrame:
    """Percentage of non-null cells of the whole table; one row."""
    known = sum((F.count(c) for c in df.columns), F.lit(0))
    cells = F.count(F.lit(1)) * len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"),
                  (known * 100.0 / cells).alias("quality_pct"))


def distinct_profile(df: DataFrame, columns: Sequence[str], high: int = 50, approximate: bool = False) -> DataFrame:
    """Distinct values, non-null and null rows per column.

    The exact form counts (column, value) pairs in two aggregates instead of one
    distinct aggregate per column, so all columns share a single exchange.
    """
    if approximate:
        counts = per_column(df, columns, {"distinct_values": F.approx_count_distinct, "non_null": F.count})
    else:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        per_value = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count("*").alias("n"))
        known = F.col("value").isNotNull()
        counts = per_value.groupBy("column").agg(F.count_if(known).alias("distinct_values"),
                                                 F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("non_null"),
                                                 F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("missing"))
    return counts.withColumn("high_cardinality", F.col("distinct_values") > high)


def usable_numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are neither all null nor constant; one aggregate, one small row to the driver."""
    numeric = [f.name for f in df.schema if f.dataType.typeName() in
               ("integer", "long", "short", "byte", "double", "float") or f.dataType.typeName().startswith("decimal")]
    if not numeric:
        return []
    row = df.agg(*[F.coalesce(F.min(c) < F.max(c), F.lit(False)).alias(c) for c in numeric]).first()
    return [c for c in numeric if row[c]]


def drop_sparse(df: DataFrame, limit: float = 0.5, protect: Sequence[str] = ()) -> DataFrame:
    """Without the columns whose null share exceeds the limit, unless protected."""
    total = F.count(F.lit(1))
    row = df.agg(*[((total - F.count(c)) / total).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if (row[c] or 0) > limit and c not in protect])


# --- outliers ---------------------------------------------------------------------
def clip(df: DataFrame, bounds: DataFrame, columns: Sequence[str], low: int | None, high: int | None,
         only_if_spread: bool = False) -> DataFrame:
    """Values pulled to the ``low``-th and ``high``-th mark of a one-row frame of quantile arrays."""
    held = with_row(df, bounds, columns)

    def one(c: str) -> Column:
        marks = F.col(f"{c}_q")
        value = F.col(c).cast("double")
        clipped = value
        if high is not None:
            clipped = F.least(clipped, marks[high])
        if low is not None:
            clipped = F.greatest(clipped, marks[low])
        clipped = F.when(value.isNotNull(), clipped)
        return F.when(marks[high] > marks[low], clipped).otherwise(value) if only_if_spread else clipped

    return held.withColumns({c: one(c) for c in columns}).drop(*[f"{c}_q" for c in columns])


def clip_extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """1 % and 99 % clip of whole-number columns, skipped where both marks agree."""
    return clip(df, bounded_quantiles(df, columns, [0.01, 0.99]), columns, 0, 1, only_if_spread=True)


def cap_upper(df: DataFrame, columns: Sequence[str], prob: float = 0.95) -> DataFrame:
    """Upper cap of whole-number columns."""
    return clip(df, bounded_quantiles(df, columns, [prob]), columns, None, 0)


def iqr_bounds(df: DataFrame, columns: Sequence[str], threshold: float = 1.5) -> DataFrame:
    """One row with ``[lower, upper]`` per column."""
    marks = wide_quantiles(df, columns, [0.25, 0.75])

    def bounds(c: str) -> Column:
        a, b = F.col(c)[0], F.col(c)[1]
        return F.array(a - (b - a) * threshold, b + (b - a) * threshold).alias(c)

    return marks.select(*[bounds(c) for c in columns])


def winsorise(df: DataFrame, columns: Sequence[str], threshold: float = 1.5) -> DataFrame:
    """Values outside the interquartile fences are pulled to the fence."""
    return clip(df, iqr_bounds(df, columns, threshold), columns, 0, 1)


def outlier_report(df: DataFrame, columns: Sequence[str], iqr_threshold: float = 1.5, z_threshold: float = 3.0) -> DataFrame:
    """Outliers per column by both rules and the rule that finds fewer (ties: interquartile)."""
    fences = iqr_bounds(df, columns, iqr_threshold)
    centre = df.agg(*[F.array(F.avg(c), F.stddev_pop(c)).alias(f"{c}_z") for c in columns])
    held = with_row(with_row(df, fences, columns), centre, [f"{c}_z" for c in columns], "")
    measures = {}
    for c in columns:
        value, fence, z = F.col(c), F.col(f"{c}_q"), F.col(f"{c}_z")
        measures[c] = [F.count_if((value < fence[0]) | (value > fence[1])),
                       F.count_if((z[1] > 0) & (F.abs(value - z[0]) / z[1] > z_threshold)), F.count(value)]
    row = held.agg(*[m.alias(f"{c}__{i}") for c, ms in measures.items() for i, m in enumerate(ms)])
    return row.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"{c}__0").alias("iqr_outliers"), F.col(f"{c}__1").alias("zscore_outliers"),
        F.col(f"{c}__2").alias("total_records"),
        F.when(F.col(f"{c}__1") < F.col(f"{c}__0"), "zscore").otherwise("iqr").alias("method")) for c in columns])))


def log_if_skewed(df: DataFrame, column: str, z_threshold: float = 3.0, skew: float = 1.0) -> DataFrame:
    """Adds ``<column>_log`` where some value is far off and the column is right-skewed, else null."""
    facts = df.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s"), sample_skewness(F.col(column)).alias("g"),
                   F.min(column).alias("lo"), F.max(column).alias("hi"))
    far = F.greatest(F.abs(F.col("lo") - F.col("m")), F.abs(F.col("hi") - F.col("m"))) / F.col("s")
    use = facts.select(F.coalesce((F.col("s") > 0) & (far > z_threshold) & (F.col("g") > skew), F.lit(False))).scalar()
    return df.withColumn(f"{column}_log", F.when(use, F.log1p(F.col(column).cast("double"))))


# --- imputation and duplicates ----------------------------------------------------
def impute(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Median for unbounded numbers, most frequent value (ties: smallest) for categories."""
    held = df
    if numeric:
        held = with_row(held, wide_quantiles(df, numeric, [0.5]), numeric)
        held = held.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"{c}_q")[0]) for c in numeric}
                                ).drop(*[f"{c}_q" for c in numeric])
    if categorical:
        pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in categorical])
        counts = (df.select(F.inline(F.filter(pairs, lambda p: p["value"].isNotNull())))
                  .groupBy("column", "value").agg(F.count("*").alias("n")))
        # smallest value among the most frequent: highest count first, then the value itself
        best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("k"), "value"))["value"].alias("value"))
        modes = best.agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in categorical])
        held = with_row(held, modes, categorical)
        held = held.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}_q")) for c in categorical}
                                ).drop(*[f"{c}_q" for c in categorical])
    return held


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], newest: bool = True) -> DataFrame:
    """One row per key, the newest (or oldest) in the given order.

    An aggregate, not a window: candidates are reduced on every partition before
    the exchange, so a key that holds a third of all rows stays cheap.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if newest else F.min_by
    ranked = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    return (df.groupBy(*keys).agg(pick(F.struct(*rest), ranked).alias("_row"))
            .select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns))


# --- rules ------------------------------------------------------------------------
def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule; a rule that is unknown for a row counts as kept."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(~cond).alias(name) for name, cond in rules.items()])
    return row.select(F.inline(F.array(*[F.struct(
        F.lit(name).alias("rule"), F.col(name).alias("violations"), F.col("_rows").alias("checked"),
        (F.col(name) == 0).alias("passed")) for name in rules])))


def range_rules(ranges: Mapping[str, tuple]) -> dict[str, Column]:
    return {f"{c} in [{lo}, {hi}]": F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()}


def dimension_scores(df: DataFrame, key: str, ts: str, value: str, as_of: datetime, max_age_hours: int) -> DataFrame:
    """Completeness, uniqueness, timeliness and anomaly share of a table with pass marks; one row."""
    fences = iqr_bounds(df, [value])
    held = with_row(df, fences, [value])
    fence = F.col(f"{value}_q")
    columns = df.columns
    total = F.count(F.lit(1))
    age = (F.unix_timestamp(F.lit(as_of)) - F.unix_timestamp(F.max(ts))) / 3600
    known = sum((F.count(c) for c in columns), F.lit(0)) / (total * len(columns))
    distinct = df.select(key).distinct().agg(F.count(key)).scalar()
    row = held.agg(known.alias("completeness"), total.alias("rows"), age.alias("age_hours"),
                   (F.count_if((F.col(value) < fence[0]) | (F.col(value) > fence[1])) / total).alias("anomaly_share"))
    return row.withColumn("uniqueness", distinct / F.col("rows")).withColumns({
        "complete": F.col("completeness") >= 0.95, "unique": F.col("uniqueness") >= 0.95,
        "timely": F.col("age_hours") <= max_age_hours, "regular": F.col("anomaly_share") <= 0.10})


def schema_table(df: DataFrame) -> DataFrame:
    """Column names, types and positions as rows."""
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                     F.lit(i).alias("position")) for i, f in enumerate(df.schema)]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def schema_diff(have: DataFrame, want: Sequence[str]) -> DataFrame:
    """Each column of either side with its state: common, missing or extra."""
    known = schema_table(have).select("column", F.lit(1).alias("here"))
    asked = have.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, want))).alias("column")).withColumn(
        "there", F.lit(1))
    state = (F.when(F.col("here").isNull(), "missing").when(F.col("there").isNull(), "extra").otherwise("common"))
    return known.join(asked, "column", "full").select("column", state.alias("state"))


def schema_status(diff: DataFrame, needed: float = 0.8) -> DataFrame:
    """Coverage of the wanted columns with PASSED, WARNING or FAILED; one row."""
    common, missing = (F.count_if(F.col("state") == s) for s in ("common", "missing"))
    return diff.agg(common.alias("common"), missing.alias("missing"),
                    F.count_if(F.col("state") == "extra").alias("extra"),
                    (common * 100.0 / (common + missing)).alias("coverage_pct")).withColumn(
        "status", F.when(F.col("missing") == 0, "PASSED").when(F.col("coverage_pct") >= needed * 100, "WARNING")
        .otherwise("FAILED"))


def tree_samples(df: DataFrame, column: str, identity: str, trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """(tree, identity, v): the rows that each tree is grown from, at least ``sample`` and less than twice as many, all of them
    where the table has less.

    The ``trees * sample`` rows of the smallest hashes are taken, a number that does not depend on the table, and dealt
    out in a second hash order, one row to each tree in turn. Tables with less rows are dealt out several times. No row
    is twice in a tree, and equal rows, however many, count one by one.
    """
    rows = df.select(F.col(column).cast("double").alias("v"), F.col(identity).alias("i")).filter("v IS NOT NULL")
    taken = rows.orderBy(F.xxhash64("i", "v", F.lit(seed)), "i", "v").limit(trees * sample)
    decks = max(1, min(rows.count(), trees * sample) // sample)
    rounds = -(-trees // decks)
    dealt = taken.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    place = F.row_number().over(Window.partitionBy("r").orderBy(F.xxhash64("i", "v", "r", F.lit(seed + 1)), "i", "v"))
    tree = (F.col("r") * decks + (place - 1) % decks).cast("int")
    return dealt.select(tree.alias("tree"), F.col("i").alias(identity), "v").filter(F.col("tree") < trees)


def isolation_scores(df: DataFrame, column: str, identity: str, trees: int = 100, sample: int = 256,
                     seed: int = 42) -> DataFrame:
    """Isolation score of every row for one column; near one means easy to separate.

    Every tree is grown from the rows that ``tree_samples`` deals it, in its own
    task.  The grown forest is a bounded model (the number of leaves depends on
    the settings, not on the table) that is handed to the scoring tasks.  A column
    without values gives no scores.
    """
    def harmonic(n: int) -> float:
        return 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else (1.0 if n == 2 else 0.0)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        values = np.sort(pdf["v"].to_numpy(dtype=float))
        rng = np.random.default_rng(seed + tree)
        limit = int(np.ceil(np.log2(max(len(values), 2))))
        out, stack = [], [(values, 0, -np.inf, np.inf)]
        while stack:
            part, depth, lo, hi = stack.pop()
            if len(part) <= 1 or depth >= limit or part[0] == part[-1]:
                out.append((tree, len(values), lo, hi, depth + harmonic(len(part))))
                continue
            at = rng.uniform(part[0], part[-1])
            stack.append((part[part < at], depth + 1, lo, at))
            stack.append((part[part >= at], depth + 1, at, hi))
        return pd.DataFrame(out, columns=["tree", "size", "lo", "hi", "path"])

    dealt = tree_samples(df, column, identity, trees, sample, seed).select("tree", "v")
    leaves = dealt.groupBy("tree").applyInPandas(grow, "tree int, size int, lo double, hi double, path double")
    # the model: at most trees * 2 * sample leaves, merged into one ascending step function
    forest = leaves.toPandas()
    if forest.empty:
        return df.withColumn("isolation_score", F.lit(None).cast("double"))
    steps = np.unique(forest["lo"].to_numpy())
    total_path = np.zeros(len(steps))
    for lo, hi, path in forest[["lo", "hi", "path"]].itertuples(index=False):
        total_path[np.searchsorted(steps, lo):np.searchsorted(steps, hi) if np.isfinite(hi) else None] += path
    size = forest.groupby("tree")["size"].max().mean()
    score = 2.0 ** (-(total_path / forest["tree"].nunique()) / harmonic(max(int(size), 3)))

    @F.pandas_udf("double")
    def lookup_score(value: pd.Series) -> pd.Series:
        found = pd.Series(score[np.clip(np.searchsorted(steps, value.to_numpy(dtype=float), "right") - 1, 0, None)])
        return found.where(value.notna().to_numpy())

    return df.withColumn("isolation_score", lookup_score(F.col(column).cast("double")))
