"""Monitoring: metric rows, alert rules, cool-down, budgets, freshness and drift."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill import constants as K


def hours_since(ts: Column, as_of: datetime) -> Column:
    """Whole elapsed time in hours, as a fraction."""
    return (F.unix_micros(F.lit(as_of)) - F.unix_micros(ts)) / 3.6e9


def freshness(df: DataFrame, ts: str, as_of: datetime, max_hours: float = 24) -> DataFrame:
    age = hours_since(F.max(ts), as_of)
    return df.agg(F.max(ts).alias("latest"), age.alias("hours_since_update")).withColumn(
        "is_stale", F.coalesce(F.col("hours_since_update") > max_hours, F.lit(True)))


def quality_check(df: DataFrame, score: str, least: float = 0.9, low: float = 0.5, max_low_share: float = 0.1) -> DataFrame:
    """Mean score, share below ``low`` and the verdict; one row."""
    row = df.agg(F.avg(score).alias("avg_quality"), F.count("*").alias("total_records"),
                 F.count_if(F.col(score) < low).alias("low_quality_records"))
    share = F.coalesce(F.try_divide("low_quality_records", "total_records"), F.lit(0.0))
    return row.withColumn("low_quality_rate", share).withColumn(
        "passed", (F.coalesce("avg_quality", F.lit(0.0)) >= least) & (F.col("low_quality_rate") <= max_low_share))


def backlog(bronze: DataFrame, silver: DataFrame, ts: str = "timestamp_created") -> DataFrame:
    """Total, processable, already processed and remaining rows with the date range; one row."""
    done = silver.agg(F.count("*")).scalar()
    return bronze.agg(F.count("*").alias("total"), F.count(ts).alias("processable"), F.min(ts).alias("earliest"),
                      F.max(ts).alias("latest")).withColumn("in_silver", done).withColumn(
        "remaining", F.col("processable") - F.col("in_silver"))


def overall_quality(leads: DataFrame, enriched: DataFrame, key: str, ts: str, required: Sequence[str], as_of: datetime) -> DataFrame:
    """Completeness 0.4, freshness 0.3 and enrichment coverage 0.3 of the recent leads; one row."""
    now = F.lit(as_of)

    def within(days: int) -> Column:
        return F.col(ts) >= now - F.make_dt_interval(F.lit(days))

    week = within(7)
    filled = [F.count_if(week & (F.coalesce(F.col(c), F.lit("")) != "")) * 100.0 for c in required]
    shares = [F.coalesce(F.try_divide(c, F.count_if(week)), F.lit(0.0)) for c in filled]
    ids = enriched.select(key).distinct().withColumn("_e", F.lit(1))
    # one row per lead, so distinct counts are plain counts
    recent = leads.filter(within(30)).select(key).distinct()
    coverage = recent.join(ids, key, "left").agg((F.count("_e") / F.greatest(F.count("*"), F.lit(1)))).scalar()
    row = leads.agg(*[s.alias(f"{c}_completeness") for s, c in zip(shares, required)],
                    hours_since(F.max(ts), as_of).alias("hours_since_update"),
                    F.count_if(within(1)).alias("records_24h")).withColumn("enrichment_coverage", coverage)
    complete = sum((F.col(f"{c}_completeness") for c in required), F.lit(0.0)) / (100.0 * len(required))
    fresh = F.least(F.lit(1.0), 24 / F.greatest(F.lit(1.0), F.col("hours_since_update")))
    return row.withColumn("quality_score", complete * 0.4 + fresh * 0.3 + F.col("enrichment_coverage") * 0.3)


def credit_usage(log: DataFrame, ts: str, credits: str, as_of: datetime, source: Column | None = None) -> DataFrame:
    """Credits of the current month: used, calls, remaining, percentage and what is free after the reserve."""
    month = F.lit(as_of.replace(day=1, hour=0, minute=0, second=0, microsecond=0))
    kept = log.filter((F.col(ts) >= month) & (F.col(ts) <= F.lit(as_of)))
    row = (kept if source is None else kept.filter(source)).agg(
        F.coalesce(F.sum(credits), F.lit(0)).cast("bigint").alias("used"), F.count("*").alias("calls"))
    left = F.lit(K.MONTHLY_CREDITS) - F.col("used")
    return row.withColumns({"remaining": left, "used_pct": F.col("used") * 100.0 / K.MONTHLY_CREDITS,
                            "available": F.greatest(left - K.TRAINING_RESERVE, F.lit(0))})


def alerts(metrics: DataFrame) -> DataFrame:
    """Alert rows (category, type, value) of a one-row metrics frame by the threshold table."""
    rows = []
    for category, metric, warning, critical, side in K.ALERT_THRESHOLDS:
        value = F.col(metric).cast("double") if metric in metrics.columns else F.lit(None).cast("double")
        beyond = (lambda v, b: v < b) if side == "below" else (lambda v, b: v > b)
        kind = F.when(beyond(value, critical), "critical").when(beyond(value, warning), "warning")
        rows.append(F.struct(F.lit(category).alias("category"), kind.alias("type"), value.alias("value")))
    return metrics.select(F.inline(F.filter(F.array(*rows), lambda r: r["type"].isNotNull())))


def cool_down(events: DataFrame, keys: Sequence[str], ts: str, seconds: int = 3600) -> DataFrame:
    """Times at which an alert of each key is let through: more than ``seconds`` after the one let through before.

    Alerts of a key within the same second are one alert, so a key has at most
    one row per second of its time span however often it fires.  The rows of a
    key pass in order through one task, which remembers a single time.
    """
    distinct = events.select(*keys, F.unix_seconds(ts).alias("_s")).distinct()
    ordered = distinct.repartition(*keys).sortWithinPartitions(*keys, "_s")

    def let_through(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, last = None, None
        for frame in frames:
            own = [tuple(None if k != k else k for k in row) for row in zip(*[frame[k] for k in keys])]
            sent = []
            for n, (this, now) in enumerate(zip(own, frame["_s"])):
                if now != now:
                    continue
                if this != key:
                    key, last = this, None
                if last is None or now - last > seconds:
                    last = now
                    sent.append(n)
            yield frame.iloc[sent]

    passed = ordered.mapInPandas(let_through, ordered.schema)
    return passed.select(*keys, F.timestamp_seconds("_s").alias(ts))


def remaining_credits(usage: DataFrame, ts: str, credits: str, as_of: datetime, limit: int = K.MONTHLY_CREDITS) -> int:
    """The month's limit less what the usage log has spent in the month of ``as_of``; one row to the driver."""
    month = F.date_trunc("month", F.col(ts)) == F.date_trunc("month", F.lit(as_of))
    spent = usage.filter(month).agg(F.coalesce(F.sum(credits), F.lit(0))).first()[0]
    return max(0, limit - int(spent))


def within_budget(df: DataFrame, order: Sequence[Column], budget: int) -> DataFrame:
    """The first rows that the credit budget pays for; a top-n pass, not a global window."""
    return df.orderBy(*order).limit(max(budget, 0))


def retraining_due(registry: DataFrame, ts: str, as_of: datetime, days: int = 7) -> DataFrame:
    age = hours_since(F.max(ts), as_of) / 24
    return registry.agg(F.max(ts).alias("last_training"), age.alias("days_since")).withColumn(
        "due", F.coalesce(F.col("days_since") >= days, F.lit(True)))


def status_rates(df: DataFrame, status: str) -> DataFrame:
    """Rows and percentage per outcome."""
    counts = df.groupBy(status).agg(F.count("*").alias("rows"))
    return counts.withColumn("rate_pct", F.col("rows") * 100.0 / counts.agg(F.sum("rows")).scalar())


def stability_index(base: DataFrame, now: DataFrame, bucket: str) -> DataFrame:
    """Population stability index over a bucket column of two frames; one row."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(bucket).agg(F.count("*").alias("n"))
        return counts.select(bucket, (F.col("n") / counts.agg(F.sum("n")).scalar()).alias(name))

    both = shares(base, "p").join(shares(now, "q"), bucket, "full").na.fill(0.0001, ["p", "q"])
    return both.agg(F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).alias("psi")).withColumn(
        "drifted", F.col("psi") > 0.1)


def performance_drop(history: DataFrame, metric: str, ts: str, drop: float = 0.05) -> DataFrame:
    """Latest metric against the best one before it."""
    latest = F.max_by(metric, ts)
    return history.agg(latest.alias("latest"), F.max(metric).alias("best")).withColumn(
        "degraded", F.col("best") - F.col("latest") > drop)
