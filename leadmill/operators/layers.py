"""Layer functions: bronze to silver to gold, for the wide contact table and the service tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import categories as C
from leadmill.functions import json_features as J
from leadmill.functions import scores as S
from leadmill.functions.dates import last_november
from leadmill.functions.expr import days_between, flag
from leadmill.operators import features as FE
from leadmill.operators import quality as Q

SILVER_FEATURES = [
    "id", "email", "campaign", "engagement_level", *K.ENGAGEMENT_COUNTS, "timestamp_last_contact", "timestamp_created",
    "timestamp_updated", "created_day_of_week", "created_month", "created_hour", "created_quarter", "created_is_weekend",
    "created_is_business_hours", "created_is_morning", "created_season", "days_since_creation", "weeks_since_creation",
    "combined_text", "combined_text_length", "combined_text_word_count", "text_length", "text_word_count",
    "has_numbers_in_text", "has_email_in_text", "has_url_in_text", "text_quality_score", *FE.INTERACTIONS,
    "has_enrichment", "enrichment_success", "company_size_category", "company_size_log", "company_age_years",
    "company_age_category", "enrichment_cost", "days_since_enrichment", "enrichment_freshness",
    "enrichment_data_completeness", "enrichment_data_completeness_pct", "is_high_value_title",
    "is_high_value_seniority", "is_tech_department", "enrichment_completeness", "enrichment_completeness_pct",
    "job_count", "current_job_tenure_years", "avg_job_tenure_years", "total_career_years", "job_progression_score",
    "has_management_experience", "industry_stability", "education_level", "company_size_bucket", "has_public_trading",
    "alexa_rank_tier", "has_social_presence", "industry_keywords_count", "headcount_growth_6m", "headcount_growth_12m",
    "headcount_growth_24m", "is_tech_company", "is_enterprise", "market_cap_tier", "account_age_days",
    "has_crm_integration", "label_count", "account_stage_maturity", "phone_status_quality", "existence_level_score",
    "email_confidence", "intent_strength_score", "functions_count", "departments_count", "is_decision_maker",
    "seniority_level", "has_personal_emails", "revealed_for_team", "title", "seniority", "organization_industry",
    "country", "city", "enrichment_status", "upload_method", "api_status", "state", "campaign_size",
    "campaign_duration_days", "created_hour_category", "data_quality_score", "processed_timestamp", "pipeline_version",
]


def project_existing(df: DataFrame, wanted: Sequence[str] = tuple(SILVER_FEATURES)) -> DataFrame:
    """The wanted columns that exist, plus day distances, presence flags and grouped categories."""
    extra = [c for c in df.columns if (c.startswith(("days_between_", "has_")) or c.endswith("_grouped")) and c not in wanted]
    return df.select(*FE.having(df, wanted), *extra)


# --- wide contact table --------------------------------------------------------------
def recent(df: DataFrame, as_of: datetime, lookback_days: int) -> DataFrame:
    """Rows created or updated within the lookback; two comparable predicates that reach the scan."""
    since = F.lit(as_of) - F.make_dt_interval(F.lit(lookback_days))
    return df.filter((F.col("timestamp_created") >= since) | (F.col("timestamp_updated") >= since))


def processable(df: DataFrame, batch: int | None = None) -> DataFrame:
    """Rows with a creation time; only where a batch size is given, that many of the newest."""
    ready = df.filter("timestamp_created IS NOT NULL")
    return ready if batch is None else ready.orderBy(F.desc("timestamp_created"), "id").limit(batch)


def stale(df: DataFrame, as_of: datetime, days: int = K.STALE_DAYS) -> DataFrame:
    """Qualified leads that were last updated at least ``days`` ago."""
    return df.filter((F.col("timestamp_updated") <= F.lit(as_of) - F.make_dt_interval(F.lit(days))) & F.col("is_qualified_lead"))


def realistic_window(df: DataFrame, candidates: Sequence[str], as_of: datetime, min_rows: int = 1000) -> DataFrame:
    """Rows since last November by the first time column with more than ``min_rows`` such rows; none if there is no such column.

    One aggregate counts all candidates; the choice stays inside the plan.
    """
    inside = {c: F.coalesce(F.col(c).between(last_november(as_of), F.lit(as_of)), F.lit(False)) for c in candidates}
    counts = df.agg(*[(F.count_if(cond) > min_rows).alias(c) for c, cond in inside.items()])
    held = df.withColumn("_use", counts.select(F.struct(*candidates)).scalar())
    chosen = F.lit(False)
    for c in reversed(candidates):
        chosen = F.when(F.col("_use")[c], inside[c]).otherwise(chosen)
    return held.filter(chosen).drop("_use")


def bronze_to_silver(df: DataFrame, as_of: datetime, version: str = "1.0") -> DataFrame:
    """The newest row per (email, campaign) with all feature blocks and its quality score.

    Which row of a key survives depends on four columns only, so duplicates go
    before the wide features are built; category ranks and campaign facts still
    count every processable row.  The target is made before counts are clipped.
    """
    every = df.filter("timestamp_created IS NOT NULL")
    newest = Q.latest_per_key(every.select("email", "campaign", "timestamp_created", "id"), ["email", "campaign"],
                              [F.col("timestamp_created"), F.col("id")]).select("id")
    built = FE.target(every.join(newest, "id", "left_semi"))
    built = FE.time_features(built, as_of)
    built = FE.text_features(built)
    built = FE.categorical_features(built, source=every)
    built = FE.enrichment_features(built, as_of)
    built = FE.document_features(built, as_of)
    built = FE.with_campaign_facts(built, every)
    clean = built.withColumn("data_quality_score", Q.record_score(F.col("text_quality_score"))).withColumns({
        "processed_timestamp": F.lit(as_of), "pipeline_version": F.lit(version)})
    return project_existing(clean)


def mature(df: DataFrame, as_of: datetime, days: int = K.MATURITY_DAYS) -> DataFrame:
    """Leads whose last contact is at least ``days`` old, with the gold metadata."""
    last = F.col("timestamp_last_contact")
    return df.filter(last <= F.lit(as_of) - F.make_dt_interval(F.lit(days))).withColumns({
        "gold_processed_timestamp": F.lit(as_of), "lead_maturity_days": days_between(F.lit(as_of), last),
        "is_mature_lead": F.lit(1)})


def gold_quality(df: DataFrame, least: float = K.GOLD_MIN_QUALITY) -> DataFrame:
    return df.filter(F.col("engagement_level").isNotNull() & F.col("id").isNotNull() & F.col("email").isNotNull()
                     & (F.coalesce("data_quality_score", F.lit(0.0)) >= least))


def pending_silver(silver: DataFrame, gold: DataFrame, as_of: datetime, lookback_days: int = 7,
                   days: int = K.MATURITY_DAYS) -> DataFrame:
    """Recently processed rows, or mature rows that gold does not hold yet."""
    now = F.lit(as_of)
    fresh = F.col("processed_timestamp") >= now - F.make_dt_interval(F.lit(lookback_days))
    ripe = F.coalesce(F.col("timestamp_last_contact") <= now - F.make_dt_interval(F.lit(days)), F.lit(False))
    known = gold.select(F.col("id").alias("_id")).distinct().withColumn("_in_gold", F.lit(True))
    joined = silver.filter(fresh | ripe).join(known, F.col("id") == F.col("_id"), "left")
    return joined.filter(fresh | F.col("_in_gold").isNull()).drop("_id", "_in_gold")


def silver_to_gold(silver: DataFrame, gold: DataFrame | None, as_of: datetime) -> DataFrame:
    """Mature, good rows that are not in gold yet."""
    ready = gold_quality(mature(silver, as_of))
    return ready if gold is None else ready.join(gold.select("id"), "id", "left_anti")


# --- service tables ---------------------------------------------------------------------
def joined_leads(leads: DataFrame, enrichment: DataFrame) -> DataFrame:
    """Leads with their enrichment, one row per lead."""
    return leads.join(enrichment, "lead_id", "left")


def service_features(df: DataFrame, as_of: datetime) -> DataFrame:
    """Scores, categories, codes and the packed feature vector of the joined service leads."""
    rates = {r: F.coalesce(F.col(r).cast("double"), F.lit(0.0)) for r in ("open_rate", "click_rate", "reply_rate", "bounce_rate")}
    zero = F.lit(0).cast("bigint")
    staged = df.withColumns({
        **rates,
        "days_since_last_activity": F.coalesce(days_between(F.lit(as_of), F.col("last_activity_date")), zero),
        "lead_age_days": F.coalesce(days_between(F.lit(as_of), F.col("created_date")), zero),
        "company_size_category": C.company_size(F.col("employee_count"), F.col("company_size")),
        "revenue_category": C.revenue_category(F.col("company_revenue")),
        "industry_category": C.service_industry(F.col("company_industry")),
        "has_technology_stack": J.has_stack(F.col("technologies")) == 1,
        "social_media_presence_score": J.social_presence(F.col("social_media_profiles")),
        "employee_count_bucket": C.employee_bucket(F.col("employee_count")),
    }).withColumn("engagement_score", S.engagement_score(
        F.col("open_rate"), F.col("click_rate"), F.col("reply_rate"), F.col("bounce_rate"), F.col("days_since_last_activity")))
    score, bounce = F.col("engagement_score"), F.col("bounce_rate")
    quiet, age = F.least("days_since_last_activity", F.lit(365)), F.least("lead_age_days", F.lit(365))
    vector = F.to_json(F.struct(
        "open_rate", "click_rate", "reply_rate", "bounce_rate", quiet.alias("days_since_activity"), age.alias("lead_age_days"),
        "engagement_score", C.company_size_code(F.col("company_size_category")).alias("company_size_encoded"),
        C.revenue_code(F.col("revenue_category")).alias("revenue_encoded"),
        C.service_industry_code(F.col("industry_category")).alias("industry_encoded"),
        F.col("has_technology_stack").cast("int").alias("has_tech_stack"),
        F.col("social_media_presence_score").alias("social_presence_score")))
    return staged.select(
        "lead_id", F.col("open_rate").alias("avg_open_rate"), F.col("click_rate").alias("avg_click_rate"),
        F.col("reply_rate").alias("avg_reply_rate"), S.engagement_trend(score).alias("engagement_trend"),
        "days_since_last_activity", F.lit(1).alias("total_emails_sent"), "company_size_category", "revenue_category",
        "industry_category", "employee_count_bucket", "has_technology_stack", "social_media_presence_score", "lead_age_days",
        S.per_day(F.col("reply_rate"), F.col("lead_age_days")).alias("response_velocity"),
        S.per_day(F.lit(1.0), F.col("lead_age_days")).alias("email_frequency"), "engagement_score",
        S.is_qualified(score, bounce, quiet).alias("is_qualified_lead"),
        S.lead_quality(score, F.col("social_media_presence_score"), bounce).alias("lead_quality_score"),
        vector.alias("feature_vector"))


VECTOR_SCHEMA = ("struct<open_rate:double, click_rate:double, reply_rate:double, bounce_rate:double, days_since_activity:bigint, "
                 "lead_age_days:bigint, engagement_score:double, company_size_encoded:int, revenue_encoded:int, "
                 "industry_encoded:int, has_tech_stack:int, social_presence_score:double>")


def unpack_vector(df: DataFrame, column: str = "feature_vector") -> DataFrame:
    """Feature columns of the packed vector; rows whose vector cannot be read are dropped."""
    held = df.withColumn("_v", J.parse_object(F.col(column), VECTOR_SCHEMA)).filter("_v IS NOT NULL")
    return held.select("*", "_v.*").drop("_v", column)


def service_gold(silver: DataFrame, gold_ids: DataFrame, as_of: datetime, days: int = K.MATURITY_DAYS) -> DataFrame:
    """Mature service leads that gold lacks, with outcome and label."""
    ready = silver.filter((F.col("created_timestamp") <= F.lit(as_of) - F.make_dt_interval(F.lit(days)))
                          & F.col("is_qualified_lead").isNotNull())
    score = F.col("engagement_score")
    named = ready.join(gold_ids.select("lead_id"), "lead_id", "left_anti").withColumn(
        "lead_outcome", S.outcome(score, F.col("is_qualified_lead"), F.col("days_since_last_activity")))
    return named.select("lead_id", "feature_vector", S.outcome_label(F.col("lead_outcome")).alias("target_label"),
                        "lead_outcome", score.alias("final_engagement_score"), F.lit(True).alias("training_eligible"),
                        days_between(F.lit(as_of), F.col("created_timestamp")).alias("data_maturity_days"))


def training_rows(gold: DataFrame, days: int = K.MATURITY_DAYS) -> DataFrame:
    """Eligible, labelled, mature rows with readable vectors, unpacked."""
    kept = gold.filter(F.col("training_eligible") & F.col("target_label").isNotNull() & (F.col("data_maturity_days") >= days))
    return unpack_vector(kept)
