"""Calendar and age features; every age is relative to an explicit time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions.expr import cut, days_between, flag


def parse_time(text: Column) -> Column:
    """Timestamp from text, null when it cannot be read."""
    return F.try_to_timestamp(text)


def calendar_parts(ts: Column, prefix: str) -> dict[str, Column]:
    """Day of week (Monday 0), month, hour and quarter."""
    return {
        f"{prefix}_day_of_week": F.weekday(ts),
        f"{prefix}_month": F.month(ts),
        f"{prefix}_hour": F.hour(ts),
        f"{prefix}_quarter": F.quarter(ts),
    }


def work_rhythm(ts: Column, prefix: str) -> dict[str, Column]:
    """Weekend, office hours (9 to 17), morning (up to 12) and season 0 to 3."""
    return {
        f"{prefix}_is_weekend": flag(F.weekday(ts) >= 5),
        f"{prefix}_is_business_hours": flag(F.hour(ts).between(9, 17)),
        f"{prefix}_is_morning": flag(F.hour(ts) <= 12),
        f"{prefix}_season": F.floor(F.month(ts) % 12 / 3).cast("int"),
    }


def day_parts(ts: Column, prefix: str) -> dict[str, Column]:
    """Half-open day parts: morning 6 to 12, afternoon 12 to 18."""
    hour = F.hour(ts)
    return {
        f"{prefix}_is_morning": flag((hour >= 6) & (hour < 12)),
        f"{prefix}_is_afternoon": flag((hour >= 12) & (hour < 18)),
    }


def hour_category(ts: Column) -> Column:
    return cut(F.hour(ts), *K.HOUR_BINS)


def ages(ts: Column, as_of: datetime, prefix: str = "") -> dict[str, Column]:
    """Days and whole weeks since ``ts``."""
    days = days_between(F.lit(as_of), ts)
    return {f"{prefix}days_since_creation": days, f"{prefix}weeks_since_creation": F.floor(days / 7)}


def short_name(column: str) -> str:
    """Feature stem of a time column: ``timestamp_last_open`` gives ``last_open``."""
    for affix in ("timestamp_", "_timestamp", "_at"):
        column = column.replace(affix, "")
    return column


def distances(columns: list[str], origin: str) -> dict[str, Column]:
    """Signed and absolute days from the origin plus a presence flag, per time column."""
    out: dict[str, Column] = {}
    for column in columns:
        stem = short_name(column)
        days = days_between(F.col(column), F.col(origin))
        out[f"days_between_{stem}_and_created"] = days
        out[f"days_between_{stem}_and_created_abs"] = F.abs(days)
        out[f"has_{stem}"] = flag(F.col(column).isNotNull())
    return out


def sunday_week(ts: Column) -> Column:
    """``year-Wweek`` with weeks that start on Sunday, week 00 before the first Sunday."""
    week = F.floor((F.dayofyear(ts) + 7 - F.dayofweek(ts)) / 7)
    return F.concat(F.year(ts).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def year_of_text(text: Column) -> Column:
    """Year from the first four characters; null when they are no number."""
    return F.when(F.length(text) >= 4, F.left(text, F.lit(4)).try_cast("int"))


def capped_age(ts: Column, as_of: datetime, cap: int = 365, bad: int = 999) -> Column:
    """Age in days, ``bad`` for an unreadable time, at most ``cap``."""
    return F.least(F.coalesce(days_between(F.lit(as_of), ts), F.lit(bad).cast("bigint")), F.lit(cap).cast("bigint"))


def lead_stage(created: Column, active: Column, as_of: datetime, maturity_days: int = 30,
               engagement_days: int = 14, extended_days: int = 30) -> Column:
    """Stage of a lead by its age and the age of its last activity."""
    age = days_between(F.lit(as_of), created)
    quiet = F.coalesce(days_between(F.lit(as_of), active), age)
    recent = F.when(quiet <= 3, "hot").when(quiet <= 7, "warm").otherwise("cooling")
    extended = F.when(quiet <= 7, "lukewarm").otherwise("cold")
    return (F.when(created.isNull(), "unknown")
            .when(age <= 1, "immediate")
            .when(age <= engagement_days, recent)
            .when(age <= extended_days, extended)
            .when(age >= maturity_days, "mature")
            .otherwise("aging"))


def is_mature(created: Column, as_of: datetime, maturity_days: int = 30) -> Column:
    """False, not null, for a missing creation time."""
    return F.coalesce(days_between(F.lit(as_of), created) >= maturity_days, F.lit(False))


def last_november(as_of: datetime) -> Column:
    """1 November of the current season, as a timestamp."""
    year = as_of.year if as_of.month >= 11 else as_of.year - 1
    return F.lit(datetime(year, 11, 1))
