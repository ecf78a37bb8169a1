"""Segment key figures: one two-phase hash aggregate per report.

All reports share one shape: group, count, sum and rate.  The group state is one
row per segment on every partition before the exchange, so a segment that holds
a third of all contacts costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.functions.expr import half_even


OUTCOMES = (("opened", "opens", "open_rate"), ("clicked", "clicks", "click_rate"), ("replied", "replies", "reply_rate"))


def segment_totals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Contacts and summed outcome flags (``opened``, ``clicked``, ``replied``) per segment."""
    return df.groupBy(*keys).agg(F.count("opened").alias("contact_count"),
                                 *[F.sum(flag).alias(f"total_{plural}") for flag, plural, _ in OUTCOMES])


def segment_rates(totals: DataFrame, keys: Sequence[str], min_contacts: int = 0, min_open_rate: float | None = None,
                  top_n: int | None = None, places: int = 4) -> DataFrame:
    """Rates of segment totals, thresholds on the rounded rates, and the best open rates (ties by key).

    A missing key is no segment.
    """
    out = totals.dropna(subset=list(keys)).withColumns({
        rate: half_even(F.col(f"total_{plural}") / F.col("contact_count"), places) for _, plural, rate in OUTCOMES})
    if min_contacts:
        out = out.filter(F.col("contact_count") >= min_contacts)
    if min_open_rate is not None:
        out = out.filter(F.col("open_rate") >= min_open_rate)
    return top(out, "open_rate", top_n, keys) if top_n else out


def segment_kpis(df: DataFrame, keys: Sequence[str], min_contacts: int = 0, min_open_rate: float | None = None,
                 top_n: int | None = None) -> DataFrame:
    """Contacts with totals and rates of opened, clicked, replied per segment."""
    return segment_rates(segment_totals(df, keys), keys, min_contacts, min_open_rate, top_n)


def roll_up(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Segment totals at a coarser key; works on the already aggregated rows."""
    sums = ["contact_count", *[f"total_{plural}" for _, plural, _ in OUTCOMES]]
    return totals.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def top(df: DataFrame, measure: str, n: int, ties: Sequence[str], descending: bool = True) -> DataFrame:
    """The n best rows; planned as one top-n pass without a full sort."""
    first = F.col(measure).desc_nulls_last() if descending else F.col(measure).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc_nulls_last() for c in ties]).limit(n)


def within_largest(totals: DataFrame, column: str, n: int, weight: str = "contact_count") -> DataFrame:
    """Aggregated rows whose value is among the n largest by weight.

    Both sides come from the same aggregate, which is computed once; the n rows
    of the small side are safe to send everywhere.
    """
    sizes = totals.dropna(subset=[column]).groupBy(column).agg(F.sum(weight).alias("_n"))
    return totals.join(F.broadcast(top(sizes, "_n", n, [column]).select(column)), column, "left_semi")


def long_form(df: DataFrame, dimensions: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per contact and non-null dimension value, so that one pass serves several breakdowns."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
                      for d in dimensions])
    known = F.filter(pairs, lambda p: p["value"].isNotNull())
    return df.select(*keep, F.inline(known))


def opens_by(df: DataFrame, keys: Sequence[str | Column], places: int | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Contacts with a known open count, their opens and opens per contact."""
    mean = F.avg("email_open_count")
    return df.groupBy(*keys).agg(
        F.count("email_open_count").alias("contacts"),
        F.coalesce(F.sum("email_open_count"), F.lit(0)).alias("total_opens"),
        (half_even(mean, places) if places is not None else mean).alias("avg_opens"), *extra)


def share_of_total(df: DataFrame, key: str, name: str = "percentage", places: int = 2) -> DataFrame:
    """Rows per value with their percentage; the total is taken over the aggregated rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows").alias("t")).scalar()
    return counts.withColumn(name, F.round(F.col("rows") * 100.0 / total, places))


def pivot_counts(df: DataFrame, rows: str, columns: str, values: list | None = None) -> DataFrame:
    """Contingency table; give ``values`` to spare the pass that finds them."""
    return df.dropna(subset=[rows]).groupBy(rows).pivot(columns, values).agg(F.count(F.lit(1))).na.fill(0)


def top_per_group(counts: DataFrame, group: str, measure: str, value: str, k: int) -> DataFrame:
    """The k largest values per group of an aggregated frame."""
    order = Window.partitionBy(group).orderBy(F.col(measure).desc_nulls_last(), F.col(value).asc_nulls_last())
    return counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
