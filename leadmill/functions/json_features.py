"""Features of the four enrichment documents, read once into typed columns.

Each block first parses its document into a struct column and then derives its
features from that column, so that a document is parsed once per row.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions.dates import year_of_text
from leadmill.functions.expr import any_of, days_between, flag, ladder, lookup

EMPLOYMENT_SCHEMA = ("array<struct<title:string, organization_name:string, start_date:string, end_date:string, "
                     "current:boolean, kind:string, degree:string>>")
ORGANIZATION_SCHEMA = ("struct<name:string, estimated_num_employees:string, founded_year:string, industry:string, "
                       "industries:array<string>, keywords:array<string>, publicly_traded_symbol:string, "
                       "alexa_ranking:string, market_cap:string, twitter_url:string, facebook_url:string, "
                       "linkedin_url:string, organization_headcount_six_month_growth:string, "
                       "organization_headcount_twelve_month_growth:string, "
                       "organization_headcount_twenty_four_month_growth:string>")
ACCOUNT_SCHEMA = ("struct<created_at:string, crm_record_url:string, label_ids:array<string>, "
                  "account_stage_id:string, phone_status:string, existence_level:string>")
RESPONSE_SCHEMA = ("struct<extrapolated_email_confidence:string, intent_strength:string, functions:array<string>, "
                   "departments:array<string>, seniority:string, title:string, personal_emails:array<string>, "
                   "revealed_for_current_team:boolean>")


def parse_array(document: Column, schema: str) -> Column:
    """Typed array; null when the document is missing, broken or no array."""
    return F.when(F.json_array_length(document).isNotNull(), F.from_json(document, schema))


def parse_object(document: Column, schema: str) -> Column:
    """Typed struct; null when the document is missing, broken or no object."""
    return F.when(F.json_object_keys(document).isNotNull(), F.from_json(document, schema))


def _filled(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def _size(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0))


def _tenure(job: Column, this_year: int) -> Column:
    start = year_of_text(job.start_date)
    closed = _filled(job.end_date) & ~F.lower(job.end_date).isin(K.OPEN_END_DATES)
    end = F.coalesce(F.when(closed, year_of_text(job.end_date)), F.lit(this_year))
    return F.when(start > 0, F.greatest(end - start, F.lit(0)))


def _degree(job: Column) -> Column:
    degree = F.lower(job.degree)
    level = None
    for value, words in K.DEGREE_LEVELS:
        hit = any_of(degree, words)
        level = F.when(hit, value) if level is None else level.when(hit, value)
    return F.when(F.lower(job.kind) == "education", level)


def employment_features(df: DataFrame, as_of: datetime, column: str = "employment_history") -> DataFrame:
    """Job count, tenures, career span, progression, management, stability and education."""
    jobs = F.col("_jobs")
    years = F.flatten(F.transform(jobs, lambda j: F.array(
        F.left(j.start_date, F.lit(4)).try_cast("int"), F.left(j.end_date, F.lit(4)).try_cast("int"))))
    employers = F.array_distinct(F.filter(
        F.transform(jobs, lambda j: F.lower(j.organization_name)), lambda o: _filled(o)))
    tenures, career = F.col("_tenures"), F.col("_years")
    some = _size(jobs) > 0

    def known(value: Column, kind: str) -> Column:
        return F.when(some, F.coalesce(value.cast(kind), F.lit(0).cast(kind))).otherwise(F.lit(0).cast(kind))

    span = F.when(F.size(career) >= 2, F.array_max(career) - F.array_min(career)).otherwise(0)
    mean = F.aggregate(tenures, F.lit(0.0), lambda a, t: a + t) / F.nullif(F.size(tenures), F.lit(0))
    return (df
            .withColumn("_jobs", parse_array(F.col(column), EMPLOYMENT_SCHEMA))
            .withColumns({
                "_tenures": F.filter(F.transform(jobs, lambda j: _tenure(j, as_of.year)), lambda t: t.isNotNull()),
                "_years": F.filter(years, lambda y: y.isNotNull()),
            })
            .withColumns({
                "job_count": known(_size(jobs), "bigint"),
                "current_job_tenure_years": known(F.get(tenures, F.lit(0)), "bigint"),
                "avg_job_tenure_years": known(mean, "double"),
                "total_career_years": known(span, "bigint"),
                "job_progression_score": known(F.size(tenures) / F.greatest(span, F.lit(1)), "double"),
                "has_management_experience": known(flag(F.exists(
                    jobs, lambda j: F.coalesce(any_of(F.lower(j.title), K.MANAGEMENT_WORDS), F.lit(False)))), "int"),
                "industry_stability": known(1 / F.greatest(F.size(employers), F.lit(1)), "double"),
                "education_level": known(F.array_max(F.transform(jobs, _degree)), "int"),
            })
            .drop("_jobs", "_tenures", "_years"))


def organization_features(df: DataFrame, column: str = "organization_data") -> DataFrame:
    """Size bucket, listing, rank tier, social links, keywords, growth, tech, enterprise and market cap."""
    doc = F.col("_doc")
    employees = F.coalesce(doc.estimated_num_employees.try_cast("bigint"), F.lit(0).cast("bigint"))
    public = flag(_filled(doc.publicly_traded_symbol))
    rank = doc.alexa_ranking.try_cast("bigint")
    links = [doc.twitter_url, doc.facebook_url, doc.linkedin_url]
    tech = F.filter(doc.keywords, lambda k: any_of(F.lower(k), K.TECH_KEYWORDS))
    cap = F.lower(doc.market_cap)

    def growth(text: Column) -> Column:
        return F.coalesce(text.try_cast("double"), F.lit(0.0))

    return df.withColumn("_doc", parse_object(F.col(column), ORGANIZATION_SCHEMA)).withColumns({
        "company_size_bucket": F.when(employees != 0, ladder(employees, K.ORG_SIZE_BUCKETS, "unknown"))
                                .otherwise("unknown"),
        "has_public_trading": public,
        "alexa_rank_tier": ladder(F.nullif(rank, F.lit(0).cast("bigint")), K.RANK_TIERS, "unknown"),
        "has_social_presence": sum((flag(_filled(u)) for u in links[1:]), flag(_filled(links[0]))),
        "industry_keywords_count": _size(doc.keywords).cast("bigint"),
        "headcount_growth_6m": growth(doc.organization_headcount_six_month_growth),
        "headcount_growth_12m": growth(doc.organization_headcount_twelve_month_growth),
        "headcount_growth_24m": growth(doc.organization_headcount_twenty_four_month_growth),
        "is_tech_company": flag(_size(tech) >= 2),
        "is_enterprise": flag((employees > 1000) | (public == 1)),
        "market_cap_tier": F.when(~_filled(doc.market_cap), "unknown")
                            .when(F.contains(cap, F.lit("b")), "large_cap")
                            .when(F.contains(cap, F.lit("m")), "mid_cap").otherwise("small_cap"),
    }).drop("_doc")


def account_features(df: DataFrame, as_of: datetime, column: str = "account_data") -> DataFrame:
    """Account age, CRM link, labels, stage and the contactability scores."""
    doc = F.col("_doc")
    age = days_between(F.lit(as_of), F.try_to_timestamp(doc.created_at))
    return df.withColumn("_doc", parse_object(F.col(column), ACCOUNT_SCHEMA)).withColumns({
        "account_age_days": F.greatest(F.coalesce(age, F.lit(0).cast("bigint")), F.lit(0).cast("bigint")),
        "has_crm_integration": flag(_filled(doc.crm_record_url)),
        "label_count": _size(doc.label_ids).cast("bigint"),
        "account_stage_maturity": flag(_filled(doc.account_stage_id)),
        "phone_status_quality": lookup(doc.phone_status, K.CONTACTABILITY_SCORES, 0),
        "existence_level_score": lookup(doc.existence_level, K.CONTACTABILITY_SCORES, 0),
    }).drop("_doc")


def response_features(df: DataFrame, column: str = "api_response_raw") -> DataFrame:
    """Address confidence, intent, array sizes, decision maker, seniority score and reveal flags."""
    doc = F.col("_doc")
    seniority = F.lower(doc.seniority)
    levels = [F.when(F.contains(seniority, F.lit(word)), score) for word, score in K.SENIORITY_SCORES.items()]
    return df.withColumn("_doc", parse_object(F.col(column), RESPONSE_SCHEMA)).withColumns({
        "email_confidence": F.coalesce(doc.extrapolated_email_confidence.try_cast("double"), F.lit(0.0)),
        "intent_strength_score": lookup(F.lower(doc.intent_strength), K.INTENT_SCORES, 0),
        "functions_count": _size(doc.functions).cast("bigint"),
        "departments_count": _size(doc.departments).cast("bigint"),
        "is_decision_maker": flag(any_of(F.lower(doc.title), K.DECISION_WORDS)),
        "seniority_level": F.coalesce(F.greatest(*levels), F.lit(0)),
        "has_personal_emails": flag(_size(doc.personal_emails) > 0),
        "revealed_for_team": flag(doc.revealed_for_current_team),
    }).drop("_doc")


def keeping_existing(df: DataFrame, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Result of a feature block in which columns that were already there keep their values."""
    kept = {f"_kept_{c}": F.col(c) for c in df.columns}
    built = build(df.withColumns(kept))
    return built.withColumns({c: F.col(f"_kept_{c}") for c in df.columns}).drop(*kept)


def presence(columns: list[str]) -> dict[str, Column]:
    """Presence flag per document with their count and share."""
    flags = {f"has_{c}": flag(F.col(c).isNotNull()) for c in columns}
    total = sum(flags.values(), F.lit(0))
    return {**flags, "enrichment_completeness": total, "enrichment_completeness_pct": total / F.lit(len(columns))}


def flatten_document(column: str, fields: list[str]) -> dict[str, Column]:
    """Presence, text length, named fields, and for arrays the item count and first-item fields."""
    doc = F.col(column)
    out = {
        f"has_{column}": flag(doc.isNotNull()),
        f"{column}_length": F.length(doc).cast("bigint"),
        f"{column}_count": F.coalesce(F.json_array_length(doc), F.lit(0)).cast("bigint"),
    }
    for name in fields:
        out[f"{column}_{name}"] = F.coalesce(F.get_json_object(doc, f"$.{name}"), F.lit(""))
        out[f"{column}_first_{name}"] = F.coalesce(F.get_json_object(doc, f"$[0].{name}"), F.lit(""))
    return out


def has_stack(document: Column) -> Column:
    """1 for a non-empty list or object."""
    return flag((F.json_array_length(document) > 0) | (F.size(F.json_object_keys(document)) > 0))


def social_presence(document: Column) -> Column:
    """Share of up to three non-empty profiles in a name-to-address object."""
    profiles = F.from_json(document, "map<string,string>")
    filled = F.size(F.map_filter(profiles, lambda k, v: _filled(v)))
    return F.coalesce(F.least(filled, F.lit(3)) / 3.0, F.lit(0.0))


def key_profile(df: DataFrame, column: str) -> DataFrame:
    """Every key found in the documents of a column, with its number of rows and the value types seen."""
    keys = df.select(F.col(column).alias("_doc"), F.explode(F.json_object_keys(column)).alias("key"))
    value = F.call_function("get_json_object", F.col("_doc"), F.concat(F.lit("$."), F.col("key")))
    kind = (F.when(value.isNull(), "null").when(F.json_array_length(value).isNotNull(), "array")
            .when(F.json_object_keys(value).isNotNull(), "object")
            .when(value.try_cast("double").isNotNull(), "number")
            .when(value.isin("true", "false"), "boolean").otherwise("string"))
    return keys.groupBy("key", kind.alias("kind")).agg(F.count("*").alias("rows"))
