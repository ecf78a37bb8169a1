"""Time-series operators.

Windows without a partition key run in one task, so they are only ever put on
frames that are already aggregated to calendar periods or similar short axes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.functions.expr import half_even, safe_ratio


def daily_metrics(df: DataFrame, places: int = 3) -> DataFrame:
    """Contacts, engagement, distinct lists and diversity per day of creation.

    Needs ``timestamp_created``, the three counts, ``email_list`` and ``list_diversity``.
    """
    aggs = [F.count("email_open_count").alias("contacts")]
    for column, name in (("email_open_count", "opens"), ("email_click_count", "clicks"),
                         ("email_reply_count", "replies")):
        aggs += [F.sum(column).alias(f"total_{name}"), half_even(F.avg(column), places).alias(f"avg_{name}")]
    return (df.withColumn("date", F.to_date("timestamp_created")).dropna(subset=["date"]).groupBy("date")
            .agg(*aggs, F.count_distinct("email_list").alias("unique_lists"),
                 half_even(F.avg("list_diversity"), places).alias("avg_diversity"))
            .withColumns({"open_rate": safe_ratio(F.col("total_opens"), F.col("contacts")),
                          "click_rate": safe_ratio(F.col("total_clicks"), F.col("contacts"))}))


def rolling_mean(column: str, order: str, before: int, after: int, by: Sequence[str] = (),
                 full: bool = True) -> Column:
    """Mean over a row frame; with ``full`` null where the frame is cut off at an end."""
    frame = Window.partitionBy(*by).orderBy(order).rowsBetween(-before, after)
    mean = F.avg(column).over(frame)
    return F.when(F.count(column).over(frame) == before + after + 1, mean) if full else mean


def centred_mean(column: str, order: str, window: int, by: Sequence[str] = ()) -> Column:
    """Centred rolling mean; an even window reaches one row further back."""
    after = (window - 1) // 2
    return rolling_mean(column, order, window - 1 - after, after, by)


def smooth(df: DataFrame, keys: Sequence[str], order: str, value: str, largest_window: int = 7) -> DataFrame:
    """Simple and exponential moving averages of each short series.

    The window is a tenth of the series length, at most ``largest_window`` and at
    least one.  A series is one aggregated row per period, so it fits in an array;
    the exponential mean is a single fold over it.
    """
    series = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(value).cast("double").alias("v")))).alias("s"))
    window = F.greatest(F.least(F.lit(largest_window), F.floor(F.size("s") / 10).cast("int")), F.lit(1))
    keep = 1 - 2 / (F.col("w") + 1)

    def step(acc, item):
        before = F.get(acc, F.size(acc) - 1)
        weighted = F.coalesce(before.num, F.lit(0.0)) * keep + item.v
        total = F.coalesce(before.den, F.lit(0.0)) * keep + 1
        return F.concat(acc, F.array(F.struct(weighted.alias("num"), total.alias("den"))))

    start = F.array().cast("array<struct<num:double,den:double>>")

    def sma(item, i):
        first = F.greatest(i - F.col("w") + 2, F.lit(1))
        part = F.slice(F.col("s"), first, i + 2 - first)
        return F.aggregate(part, F.lit(0.0), lambda a, p: a + p.v) / F.size(part)

    spread = (series.withColumn("w", window)
              .withColumns({"ema": F.aggregate("s", start, step), "sma": F.transform("s", sma)})
              .select(*keys, "w", F.posexplode("s").alias("i", "p"), "ema", "sma"))
    ema = F.get("ema", F.col("i"))
    return spread.select(*keys, F.col(f"p.{order}").alias(order), F.col("p.v").alias(value),
                         F.col("w").alias("window"), F.get("sma", F.col("i")).alias(f"{value}_sma"),
                         (ema.num / ema.den).alias(f"{value}_ema"))


def ends(df: DataFrame, order: str, value: str, n: int) -> DataFrame:
    """One row: means of the first and last ``n`` rows and their difference."""
    up, down = Window.orderBy(F.asc(order)), Window.orderBy(F.desc(order))
    numbered = df.withColumns({"_first": F.row_number().over(up), "_last": F.row_number().over(down)})
    early = F.avg(F.when(F.col("_first") <= n, F.col(value)))
    recent = F.avg(F.when(F.col("_last") <= n, F.col(value)))
    return numbered.agg(early.alias("early"), recent.alias("recent"), (recent - early).alias("trend"))


def recent_trend(df: DataFrame, order: str, value: str, rows: int = 14, ahead: int = 7) -> DataFrame:
    """Least-squares slope over the last rows, the extrapolated value and the overall spread."""
    numbered = df.withColumn("_back", F.row_number().over(Window.orderBy(F.desc(order))))
    recent = F.col("_back") <= rows
    slope = F.regr_slope(F.when(recent, F.col(value)), F.when(recent, -F.col("_back").cast("double")))
    last = F.max_by(value, order)
    return numbered.agg(slope.alias("slope"), last.alias("last_value"), (last + slope * ahead).alias("forecast"),
                        F.stddev(value).alias("volatility"))


def calendar(df: DataFrame, date: str) -> DataFrame:
    """Every day between the first and the last date."""
    span = df.agg(F.min(date).alias("a"), F.max(date).alias("b"))
    return span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias(date))


def first_seen(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows with the first time of their key; rows without key are dropped.

    Aggregate and join rather than a window: the first time of a hot key is
    combined before the exchange, and the join side is small or split by AQE.
    """
    firsts = df.dropna(subset=[key]).groupBy(key).agg(F.min(ts).alias("first_seen"))
    return df.join(firsts, key)
