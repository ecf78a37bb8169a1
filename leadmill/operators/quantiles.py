"""Exact quantiles and ranks of columns without a bound on their distinct values.

``percentile`` keeps one counter per distinct value in a single task, which is
right for counts and day numbers but not for prices or scores.  Here a bounded
sketch first brackets every wanted rank between two values, four times the error
bound of the sketch apart, which the rank can leave by one place at most, to the
next value on either side.  Exact counts then say how many rows lie below the
bracket and in each of its slices, and only the values of the one or two slices
that hold the rank are put in order.  All sizes
take the same path, and no task orders more than a slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 20000  # the sketch is off by one row in this many at most
MARGIN = 4 / ACCURACY  # half width of a bracket, four times the error
SLICES = 1024  # parts of a bracket, of equal width in values


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles ``q0, q1, ...`` per group and column, with the number of values.

    Without groups the brackets are one row and become constants of the next plans; with groups they are joined."""
    numbers = df.select(*by, *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns])
    marks = F.array(*[F.lit(min(max(p + side, 0.0), 1.0)) for p in probs for side in (-MARGIN, MARGIN)])
    brackets = numbers.groupBy(*by).agg(*[F.struct(
        F.count(c).alias("n"), F.percentile_approx(c, marks, F.lit(ACCURACY)).alias("marks")).alias(f"_{c}") for c in columns])
    if by:
        held = numbers.join(brackets, list(by))
        mark = {(c, k): F.col(f"_{c}.marks")[k] for c in columns for k in range(2 * len(probs))}
        total = {c: F.first(f"_{c}.n") for c in columns}
    else:
        row, held = brackets.first(), numbers
        mark = {(c, k): F.lit(row[f"_{c}"]["marks"][k] if row[f"_{c}"]["n"] else None).cast("double") for c in columns for k in range(2 * len(probs))}
        total = {c: F.lit(row[f"_{c}"]["n"]) for c in columns}
    spots = [(c, i, mark[c, 2 * i], mark[c, 2 * i + 1]) for c in columns for i in range(len(probs))]
    p = F.get(F.array(*[F.lit(float(x)) for x in probs]), F.col("i"))
    key = [*by, "column", "i"]

    # per group: how many values lie below each bracket, the next value on either side, and the two ranks that are wanted
    below = held.groupBy(*by).agg(*[F.struct(F.count_if(F.col(c) < low).alias("below"), F.max(F.when(F.col(c) < low, F.col(c))).alias("prior"),
                                             F.min(F.when(F.col(c) > high, F.col(c))).alias("next")).alias(f"b{n}") for n, (c, _, low, high) in enumerate(spots)],
                                  *[total[c].alias(f"n_{c}") for c in columns])
    start = below.select(*by, F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.lit(i).alias("i"), F.col(f"n_{c}").alias("total"), *[F.col(f"b{n}.{x}").alias(x) for x in ("below", "prior", "next")])
        for n, (c, i, _, _) in enumerate(spots)]))).withColumn("rank", p * (F.col("total") - 1))

    # the values inside a bracket, counted, with their slice
    within = F.lit(False)
    for c, _, low, high in spots:
        within |= F.col(c).between(low, high)
    tagged = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(i).alias("i"), F.when(F.col(c).between(low, high), F.col(c)).alias("value"),
                                F.when(high > low, F.floor((F.col(c) - low) / (high - low) * SLICES)).otherwise(F.lit(0)).cast("int").alias("slice"))
                       for c, i, low, high in spots])
    counts = (held.filter(within).select(*by, F.inline(tagged)).filter("value IS NOT NULL")
              .groupBy(*key, "slice", "value").agg(F.count("*").alias("n")))

    # rows before each slice; only slices that reach from below a wanted rank to beyond it matter
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0))
    slices = counts.groupBy(*key, "slice").agg(F.sum("n").alias("n")).withColumn("end", upto).join(start.drop("prior", "next"), key)
    slices = slices.withColumn("begin", F.col("below") + F.col("end") - F.col("n")).withColumn("end", F.col("below") + F.col("end"))
    holds = lambda r: (F.col("begin") <= r) & (r < F.col("end"))
    chosen = slices.filter(holds(F.floor("rank")) | holds(F.ceil("rank"))).select(*key, "slice", "begin", "rank")
    inside = F.sum("n").over(Window.partitionBy(*key, "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.join(chosen, [*key, "slice"]).withColumn("upto", F.col("begin") + inside).withColumn("from", F.col("upto") - F.col("n"))

    def at(r: Column) -> Column:
        return F.max(F.when((F.col("from") <= r) & (r < F.col("upto")), F.col("value")))

    found = ranked.groupBy(*key).agg(at(F.floor("rank")).alias("lo"), at(F.ceil("rank")).alias("hi"))
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"f.{k}")) for k in key]
    low, high = F.coalesce("lo", "prior"), F.coalesce("hi", "next")
    values = start.alias("s").join(found.alias("f"), same, "left").select(
        *[F.col(f"s.{k}") for k in key], "total", (low + (high - low) * (F.col("rank") - F.floor("rank"))).alias("q"))
    return values.groupBy(*by, "column").agg(F.max("total").alias("n"), *[
        F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))])


def wide_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row with an array of quantiles per column."""
    found = exact_quantiles(df, columns, probs)
    marks = F.array(*[F.col(f"q{i}") for i in range(len(probs))])
    return found.agg(*[F.max(F.when(F.col("column") == c, marks)).alias(c) for c in columns])


def bounded_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """The same row in one pass, for columns of whole numbers from a bounded range (counts, days, lengths)."""
    return df.agg(*[F.percentile(c, F.array(*[F.lit(float(p)) for p in probs])).alias(c) for c in columns])


def with_row(df: DataFrame, row: DataFrame, names: Sequence[str], suffix: str = "_q") -> DataFrame:
    """Columns of a one-row frame added to every row as constants of the plan."""
    packed = row.select(F.struct(*names).alias("s")).scalar()
    held = df.withColumn("_held", packed)
    return held.withColumns({f"{c}{suffix}": F.col("_held")[c] for c in names}).drop("_held")


def hash_order(df: DataFrame, by: Sequence[str], identity: Sequence[str], seed: int = 42, rows_per_bucket: int = 100_000) -> DataFrame:
    """Exact position of every row in a random but repeatable order within its group, and the group size.

    The order is that of a hash.  Its leading bits deal every group, however large, into even buckets of about
    ``rows_per_bucket`` rows, so many as the row count asks for: positions are the bucket's offset plus the place in the
    bucket, and no task sees more than a bucket.  The number of buckets does not change the order.
    """
    bits = max(1, (df.count() // rows_per_bucket).bit_length())
    hashed = df.withColumn("_h", F.xxhash64(*identity, F.lit(seed))).withColumn("_b", F.shiftright(F.col("_h"), 64 - bits))
    sizes = hashed.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy(*by)).alias("group_rows"))
    inside = Window.partitionBy(*by, "_b").orderBy("_h", *identity)
    return (hashed.withColumn("_rn", F.row_number().over(inside)).join(offsets, [*by, "_b"])
            .withColumn("position", F.col("_before") + F.col("_rn")).drop("_h", "_b", "_n", "_before", "_rn"))
