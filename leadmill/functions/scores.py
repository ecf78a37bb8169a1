"""Targets, engagement scores and ratio features."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadmill.functions.expr import flag, number

EPSILON = 1e-6


def engagement_level(opens: Column, clicks: Column, replies: Column) -> Column:
    """2 for a click or reply, 1 for an open only, 0 otherwise; unreadable counts are 0."""
    return (F.when((number(clicks) > 0) | (number(replies) > 0), 2).when(number(opens) > 0, 1).otherwise(0))


def click_level(opens: Column, clicks: Column) -> Column:
    """Variant without replies: 2 for a click, 1 for an open without click."""
    return F.when(number(clicks) > 0, 2).when((number(opens) > 0) & (clicks == 0), 1).otherwise(0)


def outcome_flags(opens: str = "email_open_count", clicks: str = "email_click_count",
                  replies: str = "email_reply_count") -> dict[str, Column]:
    return {"opened": flag(F.col(opens) > 0), "clicked": flag(F.col(clicks) > 0),
            "replied": flag(F.col(replies) > 0)}


def engagement_score(open_rate: Column, click_rate: Column, reply_rate: Column, bounce_rate: Column,
                     quiet_days: Column) -> Column:
    """Weighted rates, reduced after 30 quiet days (to a tenth at most), kept within 0 and 1."""
    base = open_rate * 0.3 + click_rate * 0.25 + reply_rate * 0.35 + (1 - bounce_rate) * 0.1
    fade = F.when(quiet_days > 30, F.greatest(F.lit(0.1), 1 - (quiet_days - 30) / 365)).otherwise(F.lit(1.0))
    return F.least(F.greatest(base * fade, F.lit(0.0)), F.lit(1.0))


def engagement_trend(score: Column) -> Column:
    return F.when(score > 0.7, "increasing").when(score < 0.3, "decreasing").otherwise("stable")


def is_qualified(score: Column, bounce_rate: Column, quiet_days: Column) -> Column:
    return (score > 0.5) & (bounce_rate < 0.3) & (quiet_days < 60)


def lead_quality(score: Column, social: Column, bounce_rate: Column) -> Column:
    return score * 0.6 + social * 0.2 + (1 - bounce_rate) * 0.2


def per_day(value: Column, age_days: Column) -> Column:
    """Value per day of age; 0 for a lead younger than a day."""
    return F.when(age_days > 0, value / age_days).otherwise(F.lit(0.0))


def outcome(score: Column, qualified: Column, quiet_days: Column) -> Column:
    qualified = F.coalesce(qualified, F.lit(False))
    return (F.when((score > 0.7) & qualified, "converted").when((score > 0.4) & qualified, "ongoing")
            .when(quiet_days > 60, "cold").otherwise("disqualified"))


def outcome_label(name: Column) -> Column:
    return F.when(name == "converted", 2).when(name == "ongoing", 1).otherwise(0)


def ratio_features() -> dict[str, Column]:
    """Ratios, size-revenue product and logs over the service feature names."""
    def value(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    return {
        "click_through_rate": value("click_rate") / (value("open_rate") + EPSILON),
        "engagement_reply_ratio": value("reply_rate") / (value("engagement_score") + EPSILON),
        "company_maturity": value("company_size_encoded") * value("revenue_encoded"),
        "days_since_activity_log": F.log1p(value("days_since_activity").cast("double")),
        "lead_age_days_log": F.log1p(value("lead_age_days").cast("double")),
    }


def pairwise_products(columns: list[str]) -> dict[str, Column]:
    """Product of every pair among the columns."""
    return {f"{a}_x_{b}": (F.col(a) * F.col(b)).cast("double") for a, b in combinations(columns, 2)}


def direct_social_presence(profile: Column, second: Column, stack: Column) -> Column:
    """Half for a profile address, 0.3 for a second one, 0.2 for a technology list."""
    filled = [flag(F.coalesce(c, F.lit("")) != "") for c in (profile, second)]
    return F.least(filled[0] * 0.5 + filled[1] * 0.3 + stack * 0.2, F.lit(1.0))
