"""Encoders that need facts of the whole column: rare groups, frequencies, codes, quantile bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.functions.expr import cut_by_edges, equal_width_code
from leadmill.operators.dictionary import with_facts
from leadmill.operators.kpi import long_form
from leadmill.operators.quantiles import bounded_quantiles, wide_quantiles, with_row


def group_rare(df: DataFrame, columns: Sequence[str], keep: int = 20, other: str = "Other",
               source: DataFrame | None = None) -> DataFrame:
    """Adds ``<column>_grouped``: the ``keep`` most frequent values (ties by value), everything else ``other``.

    One pass over ``source`` (by default the frame itself) counts all columns; what reaches the rows is one array of at most
    ``keep`` values per column.
    """
    counts = long_form(df if source is None else source, columns).groupBy("dimension", "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy("dimension").orderBy(F.desc("n"), "value")
    best = counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
    row = best.agg(*[F.collect_list(F.when(F.col("dimension") == c, F.col("value"))).alias(c) for c in columns])
    held = with_row(df, row, columns, "_top")

    def one(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.when(F.array_contains(F.col(f"{c}_top"), text), text).otherwise(F.lit(other))

    return held.withColumns({f"{c}_grouped": one(c) for c in columns}).drop(*[f"{c}_top" for c in columns])


def with_frequency(df: DataFrame, columns: Sequence[str], normalise: Sequence[str] | bool = False) -> DataFrame:
    """Adds ``<column>_frequency`` (rows with the same value, 0 for null) and, for all or the named columns, its share of
    the largest as ``<column>_frequency_norm``."""
    shares = list(columns) if normalise is True else list(normalise or [])
    held = with_facts(df, columns, {"frequency": "n", "frequency_norm": "share"})
    filled = {f"{c}_frequency": F.coalesce(f"{c}_frequency", F.lit(0)) for c in columns}
    filled |= {f"{c}_frequency_norm": F.coalesce(f"{c}_frequency_norm", F.lit(0.0)) for c in shares}
    return held.withColumns(filled).drop(*[f"{c}_frequency_norm" for c in columns if c not in shares])


def label_codes(df: DataFrame, columns: Sequence[str], missing: str = "Unknown") -> DataFrame:
    """Adds ``<column>_code``: position of the value in alphabetical order, nulls as ``missing``."""
    return with_facts(df, columns, {"code": "code"}, missing) if columns else df


def quantile_codes(df: DataFrame, specs: dict[str, int], missing: float | None = None, bounded: bool = True) -> DataFrame:
    """Adds ``<column>_quantile``: the quantile bin of each value, equal edges merged.

    ``specs`` gives the number of bins per column; ``missing`` replaces nulls first.
    """
    columns = list(specs)
    filled = df.withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(missing).cast("double")) for c in columns})
    base = filled
    for c in columns:
        probs = [i / specs[c] for i in range(specs[c] + 1)]
        row = (bounded_quantiles if bounded else wide_quantiles)(base, [f"_{c}"], probs)
        row = row.select(F.array_distinct(f"_{c}").alias(f"_{c}"))
        filled = with_row(filled, row, [f"_{c}"], "_edges")
    return filled.withColumns({f"{c}_quantile": cut_by_edges(F.col(f"_{c}"), F.col(f"_{c}_edges")) for c in columns}
                              ).drop(*[f"_{c}" for c in columns], *[f"_{c}_edges" for c in columns])


def equal_width_labels(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Adds ``<column>_binned``: equal-width bin label between the column's extremes."""
    row = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    held = with_row(df, row, ["lo", "hi"], "")
    code = equal_width_code(F.col(column), F.col("lo"), F.col("hi"), len(labels))
    return held.withColumn(f"{column}_binned", F.get(F.array(*map(F.lit, labels)), code)).drop("lo", "hi")
