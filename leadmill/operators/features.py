"""Feature blocks: each takes the contact table and adds one family of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from leadmill import constants as K
from leadmill.functions import categories as C
from leadmill.functions import dates as D
from leadmill.functions import json_features as J
from leadmill.functions import scores as S
from leadmill.functions import text as T
from leadmill.functions.expr import any_of, cut, days_between, flag, lookup, number
from leadmill.operators import encode as E
from leadmill.operators.quality import share_known


def having(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The wanted columns that the frame has, in the wanted order."""
    return [c for c in columns if c in df.columns]


def target(df: DataFrame) -> DataFrame:
    """Readable counts and the engagement level."""
    counted = df.withColumns({c: number(c).cast("bigint") for c in having(df, K.ENGAGEMENT_COUNTS)})
    return counted.withColumn("engagement_level", S.engagement_level(
        F.col("email_open_count"), F.col("email_click_count"), F.col("email_reply_count")))


def time_features(df: DataFrame, as_of: datetime) -> DataFrame:
    """Calendar, work rhythm, age and distances to every other time column."""
    created = F.col("timestamp_created")
    others = [c for c in having(df, K.TIMESTAMP_COLUMNS) if c != "timestamp_created"]
    return df.withColumns({**D.calendar_parts(created, "created"), **D.work_rhythm(created, "created"),
                           **D.ages(created, as_of), **D.distances(others, "timestamp_created")})


def text_features(df: DataFrame, columns: Sequence[str] = tuple(K.TEXT_COLUMNS), legacy: bool = False) -> DataFrame:
    """Cleaned combined text with shape, flags and quality score.

    Shares and flags are taken from the raw text, where capitals and marks still
    exist; ``legacy`` takes them from the cleaned text and fills nulls with the
    letters ``nan``, as older data was built.
    """
    names = having(df, columns)
    raw = F.concat_ws(" ", *[F.col(c).cast("string") for c in names])
    clean = [T.clean_text(F.coalesce(F.col(c).cast("string"), F.lit("nan")) if legacy else F.col(c).cast("string"))
             for c in names]
    combined = F.concat(*[F.concat(c, F.lit(" ")) for c in clean]) if legacy else F.trim(F.concat_ws(" ", *clean))
    missing = F.greatest(*[F.col(c).isNull() for c in names]) if len(names) > 1 else F.col(names[0]).isNull()
    staged = df.withColumns({"combined_text": combined, "_raw": raw})
    text = F.col("combined_text")
    shown = text if legacy else F.col("_raw")
    shape = T.shape_features(text)
    ratios = {k: v for k, v in T.shape_features(shown).items() if k.endswith("_ratio")}
    return staged.withColumns({
        **shape, **ratios, **T.content_flags(shown),
        "combined_text_length": shape["text_length"], "combined_text_word_count": shape["text_word_count"],
        "text_quality_score": T.quality_score(text, missing, legacy)}).drop("_raw")


INTERACTIONS = {
    "org_title_interaction": ("organization", "title"), "status_method_interaction": ("status", "upload_method"),
    "seniority_industry": ("seniority", "organization_industry"), "dept_function": ("departments_text", "functions_text"),
    "geo_industry_interaction": ("country", "organization_industry"),
    "title_industry_interaction": ("title", "organization_industry"),
    "industry_seniority_interaction": ("organization_industry", "seniority"),
    "company_industry_interaction": ("company_name", "organization_industry"),
    "country_seniority_interaction": ("country", "seniority"),
}


def interaction_features(df: DataFrame) -> DataFrame:
    return df.withColumns({name: T.interaction(a, b) for name, (a, b) in INTERACTIONS.items()
                           if a in df.columns and b in df.columns})


def categorical_features(df: DataFrame, keep: int = 20, source: DataFrame | None = None) -> DataFrame:
    """Interactions and the grouped categories, ranked on ``source``."""
    base = df if source is None else source
    return E.group_rare(interaction_features(df), having(df, K.CATEGORICAL_COLUMNS), keep, source=base)


def enrichment_features(df: DataFrame, as_of: datetime) -> DataFrame:
    """Availability, size, age, cost, recency, completeness and value flags of the enrichment."""
    employees, founded = number_or_null("organization_employees"), number_or_null("organization_founded_year")
    age = F.lit(as_of.year) - founded
    since = days_between(F.lit(as_of), F.col("enriched_at"))
    known = having(df, K.COMPLETENESS_COLUMNS)
    filled = sum((flag(F.col(c).isNotNull()) for c in known), F.lit(0))
    departments = F.lower(F.concat_ws(",", "departments"))
    return df.withColumns({
        "has_enrichment": flag(F.col("enrichment_id").isNotNull()),
        "enrichment_success": flag(F.col("api_status") == "success"),
        "company_size_category": F.coalesce(cut(employees, *K.SIZE_CATEGORY_BINS), F.lit("nan")),
        "company_size_log": F.log1p(F.coalesce(employees, F.lit(0.0))),
        "company_age_years": age.cast("bigint"),
        "company_age_category": F.coalesce(cut(age, *K.AGE_CATEGORY_BINS), F.lit("nan")),
        "enrichment_cost": number("credits_consumed"),
        "days_since_enrichment": since,
        "enrichment_freshness": F.coalesce(cut(since, *K.FRESHNESS_BINS), F.lit("nan")),
        "enrichment_data_completeness": filled,
        "enrichment_data_completeness_pct": filled / F.lit(float(len(known))),
        "is_high_value_title": T.keyword_flag(F.col("title"), K.HIGH_VALUE_TITLES),
        "is_high_value_seniority": T.keyword_flag(F.col("seniority"), K.HIGH_VALUE_SENIORITY),
        "is_tech_department": flag(any_of(departments, K.TECH_DEPARTMENTS)),
    })


def number_or_null(column: str) -> Column:
    return F.col(column).try_cast("double")


def document_features(df: DataFrame, as_of: datetime) -> DataFrame:
    """Presence and content of the four enrichment documents."""
    df = df.withColumns(J.presence(having(df, K.JSON_COLUMNS)))
    df = J.employment_features(df, as_of)
    df = J.organization_features(df)
    df = J.account_features(df, as_of)
    return J.response_features(df)


def with_campaign_facts(df: DataFrame, source: DataFrame) -> DataFrame:
    """Size and duration of the campaign, counted on ``source``, and the part of the day of creation."""
    facts = (source.filter(F.col("campaign").isNotNull() & F.col("timestamp_created").isNotNull()).groupBy("campaign")
             .agg(F.count("id").alias("campaign_size"), days_between(
                 F.max("timestamp_created"), F.min("timestamp_created")).alias("campaign_duration_days")))
    return df.join(facts, "campaign", "left").withColumn(
        "created_hour_category", D.hour_category(F.col("timestamp_created")))


def engagement_features(df: DataFrame) -> DataFrame:
    """Campaign facts of the frame itself."""
    facts = df.dropna(subset=["campaign"]).groupBy("campaign").agg(
        F.count("id").alias("campaign_size"),
        days_between(F.max("timestamp_created"), F.min("timestamp_created")).alias("campaign_duration_days"))
    return df.join(facts, "campaign", "left").withColumn(
        "created_hour_category", D.hour_category(F.col("timestamp_created")))


# --- model-oriented blocks ---------------------------------------------------------
def _time_set(columns: Sequence[str], parts) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for c in columns:
        for part in parts:
            out.update(part(F.col(c), c))
    return out


def boosting_features(df: DataFrame, as_of: datetime) -> DataFrame:
    """Limit, size, place, provider, time, campaign and age features for boosted trees."""
    limit, employees = number_or_null("daily_limit"), number_or_null("organization_employees")
    esp, age = F.col("esp_code"), F.lit(as_of.year) - number_or_null("organization_founded_year")
    columns = {
        "daily_limit_performance": C.daily_limit_score(F.col("daily_limit")),
        "daily_limit_log": F.log1p(F.coalesce(limit, F.lit(0.0))),
        "daily_limit_squared": F.pow(F.coalesce(limit, F.lit(0.0)), F.lit(2.0)),
        "daily_limit_is_optimal": flag(limit.between(100, 150)), "daily_limit_is_high": flag(limit >= 500),
        "employees_log": F.log1p(F.coalesce(employees, F.lit(0.0))),
        "employees_sqrt": F.sqrt(F.coalesce(employees, F.lit(0.0))),
        **size_flags(employees),
        "is_tech_leadership": flag(any_of(F.col("organization_industry"), K.TECH_INDUSTRIES)
                                   & any_of(F.col("title"), K.TECH_LEADERSHIP_TITLES)),
        "esp_is_high_performance": flag(esp.isin(K.ESP_HIGH_PERFORMANCE)),
        "esp_performance_score": lookup(esp, K.ESP_SCORES, 0),
        **_time_set(["timestamp_created", "timestamp_last_contact"],
                    (D.calendar_parts, lambda c, p: {k: v for k, v in D.work_rhythm(c, p).items()
                                                     if k.endswith(("weekend", "hours"))}, D.day_parts)),
        **{f"has_{c}": flag(F.col(c).isNotNull()) for c in ("link_tracking", "open_tracking", "email_gap")},
        "email_gap_log": F.log1p(F.col("email_gap").cast("double")),
        **age_flags(age), "company_age_log": F.log1p(F.coalesce(age, F.lit(0.0))),
        "industry_title": T.interaction("organization_industry", "title", "nan"),
    }
    df = df.withColumns(columns)
    places = ["country", "state", "city", "campaign", "email_list", "upload_method"]
    df = E.with_frequency(df, [*places, "industry_title"], normalise=places).drop("industry_title")
    return E.quantile_codes(df, {"daily_limit": 10, "organization_employees": 20, "esp_code": 5, "email_gap": 5}, -1)


def size_flags(employees: Column) -> dict[str, Column]:
    return {"is_enterprise": flag(employees >= 1000), "is_mid_market": flag((employees >= 200) & (employees < 1000)),
            "is_smb": flag(employees < 200), "is_very_small": flag(employees <= 10)}


def age_flags(age: Column) -> dict[str, Column]:
    return {"company_age": age, "is_startup": flag(age <= 5), "is_mature_company": flag(age >= 20),
            "is_very_old_company": flag(age >= 50)}


def forest_features(df: DataFrame) -> DataFrame:
    """Limit, size, role, place, provider, time and text features for forests."""
    limit, employees = number_or_null("daily_limit"), number_or_null("organization_employees")
    text = F.concat_ws(" ", *[F.col(c) for c in having(df, ["campaign", "personalization", "headline"])])
    staged = df.withColumn("_text", text)
    raw = F.col("_text")
    industry, seniority = F.col("organization_industry"), F.col("seniority")
    scores = {k: v for k, v in K.ESP_SCORES.items() if k not in (5, 7)}
    return staged.withColumns({
        "daily_limit_performance_score": C.daily_limit_score(F.col("daily_limit"), coarse=True),
        "is_high_daily_limit": flag(limit >= 500),
        "employees_log": F.log1p(F.coalesce(employees, F.lit(0.0))),
        "size_level": cut(F.coalesce(employees, F.lit(0.0)), K.SIZE_CATEGORY_BINS[0], [1, 2, 3, 4, 5], lowest=False),
        "is_enterprise": flag(employees >= 1000), "is_small_company": flag(employees <= 50),
        "is_tech_executive": flag(any_of(industry, K.TECH_INDUSTRIES) & any_of(seniority, K.TECH_EXECUTIVE_SENIORITY)),
        "is_sales_professional": flag(any_of(industry, K.SALES_INDUSTRIES) & any_of(seniority, K.SALES_SENIORITY)),
        "is_high_engagement_country": flag(F.col("country").isin(K.HIGH_ENGAGEMENT_COUNTRIES)),
        "is_high_performance_esp": flag(F.col("esp_code").isin(K.ESP_HIGH_PERFORMANCE)),
        "esp_performance_score": lookup(F.col("esp_code"), scores, 0),
        "text_length": F.length(raw).cast("bigint"), "text_word_count": T.word_count(raw),
        "has_numbers": flag(raw.rlike("[0-9]")), "has_email": flag(F.contains(raw, F.lit("@"))),
        **T.marketing_flags(raw),
        **{f"has_{c}": flag(F.col(c).isNotNull()) for c in having(df, ["link_tracking", "daily_limit", "email_gap", *K.JSON_COLUMNS])},
    }).drop("_text")


def explain_features(df: DataFrame, as_of: datetime) -> DataFrame:
    """Binary target with time, size-code, age and presence features."""
    created = F.col("timestamp_created")
    age = F.lit(as_of.year) - number_or_null("organization_founded_year")
    rhythm = D.work_rhythm(created, "created")
    ages = age_flags(age)
    return df.withColumns({
        "opened": flag(F.col("email_open_count") > 0), **D.calendar_parts(created, "created"),
        "is_weekend": rhythm["created_is_weekend"], "is_business_hours": rhythm["created_is_business_hours"],
        "org_size_category": cut(number_or_null("organization_employees"), K.SIZE_CATEGORY_BINS[0], [0, 1, 2, 3, 4]),
        "company_age": ages["company_age"], "is_startup": ages["is_startup"],
        "is_mature_company": ages["is_mature_company"],
        **{f"has_{c}": flag(F.col(c).isNotNull()) for c in having(df, K.JSON_COLUMNS)}})


def every_time_column(df: DataFrame) -> DataFrame:
    """Calendar and rhythm features for each column whose name says it is a time."""
    names = [f.name for f in df.schema if "timestamp" in f.name.lower() and f.dataType.typeName().startswith("timestamp")]
    return df.withColumns(_time_set(names, (D.calendar_parts, D.work_rhythm)))


def value_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_has_value`` flags, with a filled category for text columns."""
    text = {f.name for f in df.schema if f.dataType.typeName() == "string"}
    out = {f"{c}_has_value": flag(F.col(c).isNotNull()) for c in having(df, columns)}
    out.update({f"{c}_category": F.coalesce(F.col(c), F.lit("Unknown")) for c in having(df, columns) if c in text})
    return df.withColumns(out)


def source_types(df: DataFrame) -> DataFrame:
    """Column names matched by the keyword sets of each source type, as rows."""
    hits = [(kind, c) for kind, words in K.SOURCE_TYPE_KEYWORDS.items() for c in df.columns
            if any(w in c.lower() for w in words)]
    rows = [F.struct(F.lit(kind).alias("source_type"), F.lit(c).alias("column")) for kind, c in hits]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def training_frame(df: DataFrame, as_of: datetime) -> DataFrame:
    """Target plus time, text, presence and interaction features; leaking and personal columns are gone."""
    built = interaction_features(time_features(target(df), as_of))
    if having(df, K.TEXT_COLUMNS):
        built = text_features(built)
    built = built.withColumns(J.presence(having(df, K.JSON_COLUMNS)))
    leaking = [f"{p}{D.short_name(c)}{s}" for c in K.LEAKAGE_COLUMNS if c.startswith("timestamp")
               for p, s in (("days_between_", "_and_created"), ("days_between_", "_and_created_abs"), ("has_", ""))]
    return built.drop(*K.LEAKAGE_COLUMNS, *K.PII_COLUMNS, *K.JSON_COLUMNS, *leaking)


def numeric_frame(df: DataFrame, categorical: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Codes for categories, numbers for everything else that reads as one, zero for nulls."""
    coded = E.label_codes(df, having(df, categorical))
    columns = []
    for f in coded.schema:
        kind = f.dataType.typeName()
        if f.name in keep or f.name == label:
            columns.append(F.col(f.name))
        elif kind in ("integer", "long", "double", "float", "short", "boolean"):
            columns.append(F.coalesce(F.col(f.name).cast("double"), F.lit(0.0)).alias(f.name))
    return coded.select(*columns)


# --- schema alignment -----------------------------------------------------------------
def default_for(name: str, kind: TY.DataType) -> Column:
    """Value of a column the source does not have: zero counts and flags, open day distances, empty text."""
    numeric = kind.typeName() in ("integer", "long", "double", "float", "short")
    if name.startswith(("days_between_", "days_since_")) or kind.typeName().startswith(("timestamp", "date")):
        return F.lit(None).cast(kind)
    if numeric:
        return F.lit(0).cast(kind)
    return F.lit("").cast(kind) if kind.typeName() == "string" else F.lit(None).cast(kind)


def align_to_schema(df: DataFrame, schema: TY.StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Exactly the target's columns, types and order; missing columns and nulls get typed defaults."""
    defaults = defaults or {}

    def column(f: TY.StructField) -> Column:
        fill = F.lit(defaults[f.name]).cast(f.dataType) if f.name in defaults else default_for(f.name, f.dataType)
        value = F.col(f.name).cast(f.dataType) if f.name in df.columns else fill
        return F.coalesce(value, fill).alias(f.name)

    return df.select(*[column(f) for f in schema])


def completeness(df: DataFrame, exclude: Sequence[str] = ("id", "email", "processed_timestamp")) -> DataFrame:
    """Adds the share of known columns of each row."""
    return df.withColumn("feature_completeness_score", share_known([c for c in df.columns if c not in exclude]))
