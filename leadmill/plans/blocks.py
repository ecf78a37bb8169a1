"""Feature-block, silver and gold reports, and the reports over the silver table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import json_features as J
from leadmill.functions.expr import cut, flag, half_even
from leadmill.operators import encode as E
from leadmill.operators import features as FE
from leadmill.operators import kpi
from leadmill.operators import layers as L
from leadmill.operators import quality as Q
from leadmill.operators import keyed as KY
from leadmill.operators import sinks as SK
from leadmill.operators.quantiles import hash_order
from leadmill.plans.functions import (ACCOUNT_SQL, EMPLOYMENT_CTE, EMPLOYMENT_FEATURES, HOUR_SQL, ORGANIZATION_SQL, RESPONSE_SQL, _any_sql,
                                      _calendar_sql, _clean_sql, _count_sql, _flag_sql, _grouped_sql, _rhythm_sql, _words_sql,
                                      distance_sql, quantile_code_sql)
from leadmill.plans.quality import rounded
from leadmill.plans.registry import AS_OF_SQL, on_contacts, query, sql_cut, sql_days, sql_ladder, sql_map
from leadmill.sources.tables import Tables

_TEXTS = list(K.TEXT_COLUMNS)
_YEAR = K.AS_OF.year
_AGE = f"({_YEAR} - organization_founded_year)"
_DAYS = sql_days(AS_OF_SQL, "timestamp_created")
TIME_SQL = {**_calendar_sql("timestamp_created", "created"), **_rhythm_sql("timestamp_created", "created"),
            "days_since_creation": _DAYS, "weeks_since_creation": f"CAST(floor({_DAYS} / 7.0) AS BIGINT)", **distance_sql()}
TEXT_CTE = ("texts AS (SELECT id, concat_ws(' ', " + ", ".join(_TEXTS) + ") AS raw_text, trim(concat_ws(' ', "
            + ", ".join(_clean_sql(c) for c in _TEXTS) + ")) AS combined_text, (" + " OR ".join(f"{c} IS NULL" for c in _TEXTS) + ") AS gap FROM contacts)")
_LEN = "CAST(greatest(length({c}), 1) AS DOUBLE)"
TEXT_SQL = {
    "combined_text": "combined_text", "text_length": "length(combined_text)", "text_word_count": _words_sql("combined_text"),
    "text_avg_word_length": f"round(length(combined_text) / CAST(greatest({_words_sql('combined_text')}, 1) AS DOUBLE), 6)",
    "text_uppercase_ratio": f"round({_count_sql('raw_text', '[A-Z]')} / {_LEN.format(c='raw_text')}, 6)",
    "text_digit_ratio": f"round({_count_sql('raw_text', '[0-9]')} / {_LEN.format(c='raw_text')}, 6)",
    "has_numbers_in_text": _flag_sql("regexp_matches(raw_text, '[0-9]')"), "has_email_in_text": _flag_sql("contains(raw_text, '@')"),
    "has_url_in_text": _flag_sql("contains(raw_text, 'http')"),
    "text_quality_score": f"{_flag_sql('length(combined_text) > 10')} + {_flag_sql(_words_sql('combined_text') + ' > 3')} + {_flag_sql('NOT gap')}",
}
_SINCE = sql_days(AS_OF_SQL, "enriched_at")
_FILLED = " + ".join(_flag_sql(f"{c} IS NOT NULL") for c in ("title", "organization_name", "organization_industry", "seniority", "departments_text", "functions_text"))
ENRICHMENT_SQL = {
    "has_enrichment": _flag_sql("enrichment_id IS NOT NULL"), "enrichment_success": _flag_sql("api_status = 'success'"),
    "company_size_category": f"coalesce({sql_cut('organization_employees', *K.SIZE_CATEGORY_BINS)}, 'nan')",
    "company_size_log": "round(ln(1 + coalesce(organization_employees, 0)), 6)", "company_age_years": _AGE,
    "company_age_category": f"coalesce({sql_cut(_AGE, *K.AGE_CATEGORY_BINS)}, 'nan')", "enrichment_cost": "CAST(credits_consumed AS DOUBLE)",
    "days_since_enrichment": _SINCE, "enrichment_freshness": f"coalesce({sql_cut(_SINCE, *K.FRESHNESS_BINS)}, 'nan')",
    "enrichment_data_completeness": _FILLED, "enrichment_data_completeness_pct": f"round(({_FILLED}) / 6.0, 6)",
    "is_high_value_title": _any_sql("lower(title)", K.HIGH_VALUE_TITLES), "is_high_value_seniority": _any_sql("lower(seniority)", K.HIGH_VALUE_SENIORITY),
    "is_tech_department": _any_sql("lower(departments_text)", K.TECH_DEPARTMENTS),
}


def listed_sql(features: dict[str, str]) -> str:
    return ", ".join(f"{s} AS {n}" for n, s in features.items())


@query("f_01_time_features", on_contacts(f"SELECT id, {listed_sql(TIME_SQL)} FROM contacts"))
def time_features(t: Tables) -> DataFrame:
    return FE.time_features(t.contacts("id", *K.TIMESTAMP_COLUMNS), K.AS_OF).drop(*K.TIMESTAMP_COLUMNS)


@query("f_02_text_features", on_contacts(f"SELECT id, {listed_sql(TEXT_SQL)} FROM texts", TEXT_CTE))
def text_features(t: Tables) -> DataFrame:
    return rounded(FE.text_features(t.contacts("id", *_TEXTS))).select("id", *TEXT_SQL)


_GROUPED = ["organization", "status", "upload_method", "assigned_to", "verification_status", "enrichment_status", "api_status", "city", "state", "country", "seniority"]
INTERACTION_SQL = {n: f"coalesce(CAST({a} AS VARCHAR), 'Unknown') || '_' || coalesce(CAST({b} AS VARCHAR), 'Unknown')" for n, (a, b) in FE.INTERACTIONS.items()}


@query("f_03_categorical_features", on_contacts(f"SELECT id, {listed_sql(INTERACTION_SQL)}, " + ", ".join(_grouped_sql(c) for c in _GROUPED) + " FROM contacts"))
def categorical_features(t: Tables) -> DataFrame:
    needed = dict.fromkeys([*_GROUPED, *[c for p in FE.INTERACTIONS.values() for c in p]])
    return FE.categorical_features(t.contacts("id", *needed)).select("id", *FE.INTERACTIONS, *[f"{c}_grouped" for c in _GROUPED])


_ENRICHED = ("id", "enrichment_id", "api_status", "organization_employees", "organization_founded_year", "credits_consumed", "enriched_at", "title",
             "organization_name", "organization_industry", "seniority", "departments", "functions")


@query("f_04_enrichment_features", on_contacts(f"SELECT id, {listed_sql(ENRICHMENT_SQL)} FROM contacts"))
def enrichment_features(t: Tables) -> DataFrame:
    return rounded(FE.enrichment_features(t.contacts(*_ENRICHED), K.AS_OF)).select("id", *ENRICHMENT_SQL)


# --- silver and gold --------------------------------------------------------------------
_SILVER_DOCS = {**ACCOUNT_SQL, **RESPONSE_SQL}
SILVER_CTE = f"""{TEXT_CTE}, {EMPLOYMENT_CTE}, featured AS (SELECT c.*, {listed_sql(TEXT_SQL)}, {listed_sql({k: v for k, v in TIME_SQL.items()})},
  {listed_sql(ENRICHMENT_SQL)}, {listed_sql(INTERACTION_SQL)}, {listed_sql(_SILVER_DOCS)}, job_count, avg_job_tenure_years, education_level,
  CASE WHEN email_click_count > 0 OR email_reply_count > 0 THEN 2 WHEN email_open_count > 0 THEN 1 ELSE 0 END AS engagement_level,
  campaign_size, campaign_duration_days, {HOUR_SQL.format(ts='timestamp_created')} AS created_hour_category
  FROM contacts c JOIN texts USING (id) JOIN employment USING (id)
  LEFT JOIN (SELECT campaign, count(*) AS campaign_size, {sql_days('max(timestamp_created)', 'min(timestamp_created)')} AS campaign_duration_days
    FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY campaign) USING (campaign) WHERE timestamp_created IS NOT NULL),
silver AS (SELECT * FROM (SELECT *, round(((CASE WHEN email IS NULL THEN 2.0::DOUBLE ELSE 3 END) / 3 + text_quality_score / 3.0::DOUBLE + 1) / 3, 6) AS data_quality_score,
  row_number() OVER (PARTITION BY email, campaign ORDER BY timestamp_created DESC, id DESC) AS place FROM featured) WHERE place = 1)"""
_SILVER_OUT = ["id", "email", "campaign", "engagement_level", "email_open_count", "created_day_of_week", "created_hour", "created_is_weekend", "days_since_creation",
               "days_between_last_click_and_created", "has_last_click", "text_length", "text_word_count", "text_quality_score", *FE.INTERACTIONS,
               *[c for c in ENRICHMENT_SQL if c != "company_age_years"], *_SILVER_DOCS, "job_count", "avg_job_tenure_years", "education_level",
               "campaign_size", "campaign_duration_days", "created_hour_category", "data_quality_score"]


def silver(t: Tables) -> DataFrame:
    return L.bronze_to_silver(t.contacts(), K.AS_OF)


@query("f_08_bronze_to_silver", on_contacts("SELECT " + ", ".join(_SILVER_OUT) + " FROM silver", SILVER_CTE))
def bronze_to_silver(t: Tables) -> DataFrame:
    return rounded(silver(t)).select(*_SILVER_OUT)


@query("f_09_silver_to_gold", on_contacts(f"""SELECT id, campaign, engagement_level, {sql_days(AS_OF_SQL, 'timestamp_last_contact')} AS lead_maturity_days, 1 AS is_mature_lead FROM silver
  WHERE timestamp_last_contact <= {AS_OF_SQL} - INTERVAL 30 DAY AND email IS NOT NULL AND data_quality_score >= 0.3 AND contact_key % 3 <> 0""", SILVER_CTE))
def silver_to_gold(t: Tables) -> DataFrame:
    done = t.contacts("id", "contact_key").filter("contact_key % 3 = 0").select("id")
    return L.silver_to_gold(silver(t), done, K.AS_OF).select("id", "campaign", "engagement_level", "lead_maturity_days", "is_mature_lead")


@query("f_10_complete_run", on_contacts(f"""SELECT 'silver' AS layer, count(*) AS rows, count(*) FILTER (WHERE engagement_level = 2) AS high_engagement FROM silver UNION ALL
  SELECT 'gold', count(*), count(*) FILTER (WHERE engagement_level = 2) FROM silver WHERE timestamp_last_contact <= {AS_OF_SQL} - INTERVAL 30 DAY AND email IS NOT NULL AND data_quality_score >= 0.3""", SILVER_CTE))
def complete_run(t: Tables) -> DataFrame:
    """Both layers are written; running every step twice adds nothing."""
    silver_path, gold_path = SK.fresh_folder(t.spark, "silver"), SK.fresh_folder(t.spark, "gold")
    built = silver(t)
    for batch in ("first", "first", "second"):  # a replay and a new run over the same rows
        KY.append_keyed(built, silver_path, ["id"], batch)
    stored = KY.read_keyed(t.spark, silver_path)
    for batch in ("first", "second"):
        KY.append_keyed(L.silver_to_gold(stored, None, K.AS_OF), gold_path, ["id"], batch)
    layers = stored.select("engagement_level", F.lit("silver").alias("layer")).unionByName(
        KY.read_keyed(t.spark, gold_path).select("engagement_level", F.lit("gold").alias("layer")))
    return layers.groupBy("layer").agg(F.count("*").alias("rows"), F.count_if(F.col("engagement_level") == 2).alias("high_engagement"))


@query("f_41_completeness", on_contacts(f"SELECT id, round(({' + '.join(_flag_sql(f'{c} IS NOT NULL') for c in ('title', 'seniority', 'country', 'assigned_to'))}) / 4.0, 6) AS feature_completeness_score FROM contacts"))
def completeness(t: Tables) -> DataFrame:
    return rounded(FE.completeness(t.contacts("id", "title", "seniority", "country", "assigned_to"))).select("id", "feature_completeness_score")


@query("dq_01_record_score", on_contacts("SELECT id, data_quality_score FROM silver", SILVER_CTE))
def record_score(t: Tables) -> DataFrame:
    return rounded(silver(t).select("id", "data_quality_score"))


_SCORED = ["engagement_level", "created_day_of_week", "created_month", "created_hour", "created_quarter", "has_updated", "text_quality_score",
           "is_high_value_title", "is_tech_department", "data_quality_score"]


@query("dq_14_constraints", on_contacts(" UNION ALL ".join(
    f"SELECT '{c} in [{K.CONSTRAINT_RANGES[c][0]}, {K.CONSTRAINT_RANGES[c][1]}]' AS rule, count(*) FILTER (WHERE NOT ({c} BETWEEN {K.CONSTRAINT_RANGES[c][0]} AND {K.CONSTRAINT_RANGES[c][1]})) AS violations, count(*) AS checked, TRUE AS passed FROM silver"
    for c in _SCORED), SILVER_CTE))
def constraints(t: Tables) -> DataFrame:
    return Q.violations(silver(t), Q.range_rules({c: K.CONSTRAINT_RANGES[c] for c in _SCORED}))


@query("snk_12_13_training_views", on_contacts("""SELECT 'silver' AS view, count(*) AS rows FROM silver WHERE data_quality_score >= 0.5 UNION ALL
  SELECT 'gold', count(*) FROM silver WHERE timestamp_last_contact <= TIMESTAMP '2024-03-01' - INTERVAL 30 DAY AND text_quality_score >= 0.3""", SILVER_CTE))
def training_views(t: Tables) -> DataFrame:
    """Rows of both training views, counted in one pass over silver."""
    known = F.col("engagement_level").isNotNull()
    old = F.col("timestamp_last_contact") <= F.lit(K.AS_OF) - F.make_dt_interval(F.lit(K.MATURITY_DAYS))
    good = known & (F.col("data_quality_score") >= K.TRAINING_MIN_QUALITY)
    ripe = known & old & (F.col("text_quality_score") >= 0.3)
    counts = silver(t).agg(F.count_if(good).alias("silver"), F.count_if(ripe).alias("gold"))
    return counts.select(F.explode(F.map_from_arrays(F.array(F.lit("silver"), F.lit("gold")), F.array("silver", "gold"))).alias("view", "rows"))


@query("snk_14_training_summary", on_contacts("""SELECT engagement_level, count(*) AS record_count, round(avg(data_quality_score), 5) AS avg_quality_score,
  round(avg(text_quality_score), 5) AS avg_text_quality, round(avg(campaign_size), 5) AS avg_campaign_size FROM silver GROUP BY 1""", SILVER_CTE))
def training_summary(t: Tables) -> DataFrame:
    return silver(t).groupBy("engagement_level").agg(
        F.count("*").alias("record_count"), F.round(F.avg("data_quality_score"), 5).alias("avg_quality_score"),
        F.round(F.avg("text_quality_score"), 5).alias("avg_text_quality"), F.round(F.avg("campaign_size"), 5).alias("avg_campaign_size"))


@query("agg_46_win_01_target_distribution", on_contacts("""SELECT engagement_level, count(*) AS rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS percentage
  FROM (SELECT CASE WHEN email_click_count > 0 OR email_reply_count > 0 THEN 2 WHEN email_open_count > 0 THEN 1 ELSE 0 END AS engagement_level FROM contacts) GROUP BY 1"""))
def target_distribution(t: Tables) -> DataFrame:
    return kpi.share_of_total(FE.target(t.contacts(*K.ENGAGEMENT_COUNTS)), "engagement_level")


@query("agg_47_feature_completeness", on_contacts("""SELECT count(text_length) AS has_text, count(created_day_of_week) AS has_time, CAST(sum(has_enrichment) AS BIGINT) AS enriched,
  round(avg(has_enrichment) * 100, 2) AS enrichment_rate, round(avg(data_quality_score), 3) AS avg_quality, round(avg(text_length), 0) AS avg_text_length FROM silver""", SILVER_CTE))
def feature_completeness(t: Tables) -> DataFrame:
    return silver(t).agg(
        F.count("text_length").alias("has_text"), F.count("created_day_of_week").alias("has_time"), F.sum("has_enrichment").alias("enriched"),
        F.round(F.avg("has_enrichment") * 100, 2).alias("enrichment_rate"), F.round(F.avg("data_quality_score"), 3).alias("avg_quality"),
        F.round(F.avg("text_length"), 0).alias("avg_text_length"))


@query("agg_48_enrichment_by_size", on_contacts(f"""SELECT company_size_category, count(*) AS rows, round(avg(is_high_value_title), 2) AS high_value_title_rate,
  round(avg(is_high_value_seniority), 2) AS high_value_seniority_rate, round(avg(is_tech_department), 2) AS tech_department_rate
  FROM (SELECT {listed_sql(ENRICHMENT_SQL)} FROM contacts) WHERE has_enrichment = 1 GROUP BY 1"""))
def enrichment_by_size(t: Tables) -> DataFrame:
    df = FE.enrichment_features(t.contacts(*_ENRICHED), K.AS_OF).filter("has_enrichment = 1")
    return df.groupBy("company_size_category").agg(F.count("*").alias("rows"), *[
        F.round(F.avg(f"is_{n}"), 2).alias(f"{n}_rate") for n in ("high_value_title", "high_value_seniority", "tech_department")])


@query("agg_49_50_freshness_duplicates", on_contacts("""SELECT count(*) AS total_records, strftime(min(timestamp_created), '%Y-%m-%d') AS first_insert, strftime(max(timestamp_created), '%Y-%m-%d') AS last_insert,
  count(DISTINCT CAST(timestamp_created AS DATE)) AS insert_days, count(email) - count(DISTINCT email) AS duplicate_count FROM contacts"""))
def freshness_duplicates(t: Tables) -> DataFrame:
    df = t.contacts("email", "timestamp_created").withColumn("day", F.to_date("timestamp_created"))
    # one row per (address, day): both distinct counts come from two small aggregates
    pairs = df.groupBy("email", "day").agg(F.count("*").alias("n"), F.count("email").alias("given"))
    mails = pairs.groupBy("email").agg(F.sum("n").alias("n"), F.sum("given").alias("given"), F.min("day").alias("first"), F.max("day").alias("last"))
    days = pairs.agg(F.count_distinct("day")).scalar()
    return mails.agg(F.sum("n").alias("total_records"), F.min("first").cast("string").alias("first_insert"),
                     F.max("last").cast("string").alias("last_insert"),
                     (F.sum("given") - F.count("email")).alias("duplicate_count")).withColumn("insert_days", days)


@query("agg_59_low_quality", on_contacts("SELECT count(*) AS rows, round(avg(CASE WHEN data_quality_score < 0.9 THEN 1.0 ELSE 0 END), 6) AS low_quality_rate, count(email) AS valid_email FROM silver", SILVER_CTE))
def low_quality(t: Tables) -> DataFrame:
    return silver(t).agg(F.count("*").alias("rows"), F.round(F.avg(flag(F.col("data_quality_score") < 0.9)), 6).alias("low_quality_rate"), F.count("email").alias("valid_email"))


# --- more aggregates ---------------------------------------------------------------------
@query("agg_43_tiers", on_contacts("""SELECT count(*) FILTER (WHERE organization_employees <= 50) AS small, count(*) FILTER (WHERE organization_employees > 50 AND organization_employees <= 500) AS medium,
  count(*) FILTER (WHERE organization_employees > 500) AS large, count(*) FILTER (WHERE organization_founded_year >= 2010) AS new, count(*) FILTER (WHERE organization_founded_year >= 1990 AND organization_founded_year < 2010) AS mid,
  count(*) FILTER (WHERE organization_founded_year < 1990) AS old FROM contacts"""))
def tiers(t: Tables) -> DataFrame:
    size, year = F.col("organization_employees"), F.col("organization_founded_year")
    return t.contacts("organization_employees", "organization_founded_year").agg(
        F.count_if(size <= 50).alias("small"), F.count_if((size > 50) & (size <= 500)).alias("medium"), F.count_if(size > 500).alias("large"),
        F.count_if(year >= 2010).alias("new"), F.count_if((year >= 1990) & (year < 2010)).alias("mid"), F.count_if(year < 1990).alias("old"))


@query("agg_44_engagement_means", on_contacts(" UNION ALL ".join(f"""SELECT '{c}' AS feature, round(avg({c}) FILTER (WHERE email_open_count > 0), 6) AS engaged_mean,
  round(avg({c}) FILTER (WHERE email_open_count = 0), 6) AS other_mean FROM contacts""" for c in ("organization_employees", "page_retrieved", "daily_limit"))))
def engagement_means(t: Tables) -> DataFrame:
    columns = ["organization_employees", "page_retrieved", "daily_limit"]
    opens = F.col("email_open_count")
    row = t.contacts("email_open_count", *columns).agg(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.round(F.avg(F.when(opens > 0, F.col(c))), 6).alias("engaged_mean"),
        F.round(F.avg(F.when(opens == 0, F.col(c))), 6).alias("other_mean")) for c in columns]).alias("r"))
    return row.select(F.inline("r"))


_INSPECT = {"title": "title", "seniority": "seniority", "size_bin": sql_cut("organization_employees", *K.INSPECT_SIZE_BINS), "age_bin": sql_cut(_AGE, *K.INSPECT_AGE_BINS)}


@query("agg_57_feature_inspection", on_contacts("SELECT dimension, value, contacts, open_rate FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY open_rate DESC NULLS LAST, value) AS place FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS dimension, {s} AS value, count(email_open_count) AS contacts, round(avg(email_open_count), 6) AS open_rate FROM contacts WHERE {s} IS NOT NULL GROUP BY 2" for n, s in _INSPECT.items())
    + ")) WHERE place <= 5"))
def feature_inspection(t: Tables) -> DataFrame:
    df = t.contacts("email_open_count", "title", "seniority", "organization_employees", "organization_founded_year").withColumns({
        "size_bin": cut(F.col("organization_employees"), *K.INSPECT_SIZE_BINS), "age_bin": cut(F.lit(_YEAR) - F.col("organization_founded_year"), *K.INSPECT_AGE_BINS)})
    counts = kpi.long_form(df, list(_INSPECT), ["email_open_count"]).groupBy("dimension", "value").agg(
        F.count("email_open_count").alias("contacts"), F.round(F.avg("email_open_count"), 6).alias("open_rate"))
    return kpi.top_per_group(counts, "dimension", "open_rate", "value", 5).drop("place")


@query("agg_57_correlations", on_contacts(" UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, email_open_count), 6) AS correlation FROM contacts" for c in ("daily_limit", "page_retrieved", "email_gap"))))
def inspection_correlations(t: Tables) -> DataFrame:
    columns = ["daily_limit", "page_retrieved", "email_gap"]
    row = t.contacts("email_open_count", *columns).agg(F.array(*[F.struct(F.lit(c).alias("feature"), F.round(F.corr(c, "email_open_count"), 6).alias("correlation")) for c in columns]).alias("r"))
    return row.select(F.inline("r"))


# --- sorts, sets, samples -----------------------------------------------------------------
@query("srt_01_02_largest_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def largest_orders(t: Tables) -> DataFrame:
    return kpi.top(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 20, ["o_orderkey"])


@query("srt_03_top_per_group", on_contacts("""SELECT seniority, organization_industry, rows, place FROM (SELECT *, row_number() OVER (PARTITION BY seniority ORDER BY rows DESC, organization_industry NULLS LAST) AS place
  FROM (SELECT seniority, organization_industry, count(*) AS rows FROM contacts GROUP BY 1, 2)) WHERE place <= 5"""))
def top_per_group(t: Tables) -> DataFrame:
    counts = t.contacts("seniority", "organization_industry").groupBy("seniority", "organization_industry").agg(F.count("*").alias("rows"))
    return kpi.top_per_group(counts, "seniority", "rows", "organization_industry", 5)


@query("srt_04_best_and_worst", "SELECT arg_max(o_orderpriority, avg_price) AS best, arg_min(o_orderpriority, avg_price) AS worst FROM (SELECT o_orderpriority, avg(o_totalprice) AS avg_price FROM orders GROUP BY 1)")
def best_and_worst(t: Tables) -> DataFrame:
    means = t.orders.groupBy("o_orderpriority").agg(F.avg("o_totalprice").alias("p"))
    return means.agg(F.max_by("o_orderpriority", "p").alias("best"), F.min_by("o_orderpriority", "p").alias("worst"))


@query("srt_05_custom_order", "SELECT dayname(ts) AS weekday, isodow(ts) AS place, count(*) AS events FROM events GROUP BY 1, 2")
def custom_order(t: Tables) -> DataFrame:
    days = t.events.groupBy(F.date_format("ts", "EEEE").alias("weekday")).agg(F.count("*").alias("events"))
    place = F.array_position(F.array(*map(F.lit, K.WEEKDAYS)), F.col("weekday")).cast("bigint")
    return days.withColumn("place", place).orderBy("place")


@query("srt_06_most_recent", "SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 5")
def most_recent(t: Tables) -> DataFrame:
    return t.events.orderBy(F.desc("ts"), "event_id").limit(5).select("event_id", "user_id", "event_type")


@query("set_03_union_timelines", "SELECT 'order' AS kind, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS rows FROM orders GROUP BY 2 UNION ALL SELECT 'shipment', strftime(l_shipdate, '%Y-%m'), count(*) FROM lineitem GROUP BY 2")
def union_timelines(t: Tables) -> DataFrame:
    def monthly(df: DataFrame, ts: str, kind: str) -> DataFrame:
        return df.groupBy(F.date_format(ts, "yyyy-MM").alias("month")).agg(F.count("*").alias("rows")).withColumn("kind", F.lit(kind))

    return monthly(t.orders, "o_orderdate", "order").unionByName(monthly(t.lineitem, "l_shipdate", "shipment"))


@query("set_01_interaction_profile", on_contacts(" UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", count(DISTINCT {s}) AS distinct_values, count(*) AS non_null FROM contacts" for n, s in list(INTERACTION_SQL.items())[:3])))
def interaction_profile(t: Tables) -> DataFrame:
    names = list(FE.INTERACTIONS)[:3]
    df = FE.interaction_features(t.contacts(*dict.fromkeys(c for n in names for c in FE.INTERACTIONS[n])))
    return Q.distinct_profile(df, names).select("column", "distinct_values", "non_null")


@query("smp_01_sample")
def sample(t: Tables) -> DataFrame:
    """Repeatable random sample of at most 1000 rows, in hash order."""
    return t.events.orderBy(F.xxhash64("event_id", F.lit(42)), "event_id").limit(1000)


@query("smp_01_sample_of_table", """SELECT least(count(*), 1000) AS rows, least(count(*), 1000) AS ids, least(count(*), 1000) AS in_table, 0 AS changed FROM events""")
def sample_of_table(t: Tables) -> DataFrame:
    """The sample's rows are different rows of the table, and the same ones from a table that is dealt out otherwise."""
    first = sample(t).select("event_id", "event_type")
    other = t.events.repartition(13, "event_type").orderBy(F.xxhash64("event_id", F.lit(42)), "event_id").limit(1000).select("event_id", F.lit(1).alias("again"))
    found = first.join(other, "event_id", "full").join(t.events.select("event_id", F.lit(1).alias("known")), "event_id", "left")
    return found.agg(F.count("event_type").alias("rows"), F.count_distinct("event_id").alias("ids"), F.count("known").alias("in_table"),
                     F.count_if(F.col("event_type").isNull() | F.col("again").isNull()).alias("changed"))


@query("smp_02_stratified_split", on_contacts("""SELECT level, count(*) AS rows, CAST(floor(count(*) * 0.25) AS BIGINT) AS test_rows FROM (
  SELECT CASE WHEN email_click_count > 0 OR email_reply_count > 0 THEN 2 WHEN email_open_count > 0 THEN 1 ELSE 0 END AS level FROM contacts) GROUP BY 1"""))
def stratified_split(t: Tables) -> DataFrame:
    from leadmill.ml.prepare import split

    df = FE.target(t.contacts("id", *K.ENGAGEMENT_COUNTS)).withColumnRenamed("engagement_level", "level")
    return split(df, "level", ["id"], 0.25).groupBy("level").agg(F.count("*").alias("rows"), F.count_if("is_test").alias("test_rows"))


# --- projections ----------------------------------------------------------------------------
@query("prj_01_02_existing_columns", on_contacts("SELECT id, email, campaign, title, city, email_open_count, timestamp_created IS NOT NULL AS known FROM contacts"))
def existing_columns(t: Tables) -> DataFrame:
    df = t.contacts("id", "email", "campaign", "title", "city", "email_open_count", "phone", "timestamp_created")
    return L.project_existing(df).withColumn("known", F.col("timestamp_created").isNotNull()).drop("timestamp_created")


@query("prj_03_drop_lists", on_contacts("SELECT id, campaign, title, daily_limit FROM contacts"))
def drop_lists(t: Tables) -> DataFrame:
    df = t.contacts("id", "email", "phone", "campaign", "title", "daily_limit", "email_click_count", "timestamp_last_click")
    return df.drop(*K.LEAKAGE_COLUMNS, *K.PII_COLUMNS)


# --- model-oriented blocks ---------------------------------------------------------------------
_BOOST = ("id", "daily_limit", "organization_employees", "organization_founded_year", "country", "state", "city", "organization_industry", "title",
          "esp_code", "campaign", "email_list", "upload_method", "link_tracking", "open_tracking", "email_gap", "timestamp_created", "timestamp_last_contact")
_BOOST_SQL = {
    "daily_limit_performance": sql_ladder("daily_limit", K.DAILY_LIMIT_SCORES, 0), "daily_limit_log": "round(ln(1 + coalesce(daily_limit, 0)), 6)",
    "daily_limit_squared": "CAST(coalesce(daily_limit, 0) * coalesce(daily_limit, 0) AS DOUBLE)", "daily_limit_is_optimal": _flag_sql("daily_limit BETWEEN 100 AND 150"),
    "employees_sqrt": "round(sqrt(coalesce(organization_employees, 0)), 6)", "is_mid_market": _flag_sql("organization_employees >= 200 AND organization_employees < 1000"),
    "esp_performance_score": sql_map("esp_code", K.ESP_SCORES, 0), "timestamp_created_hour": "hour(timestamp_created)",
    "timestamp_created_is_afternoon": _flag_sql("hour(timestamp_created) >= 12 AND hour(timestamp_created) < 18"),
    "country_frequency": "CASE WHEN country IS NULL THEN 0 ELSE count(country) OVER (PARTITION BY country) END",
    "industry_title_frequency": "count(*) OVER (PARTITION BY coalesce(organization_industry, 'nan') || '_' || coalesce(title, 'nan'))",
    "company_age_log": f"round(ln(1 + coalesce({_AGE}, 0)), 6)", "is_startup": _flag_sql(f"{_AGE} <= 5"),
}


@query("f_11_boosting_features", on_contacts(f"SELECT id, {listed_sql(_BOOST_SQL)} FROM contacts"))
def boosting_features(t: Tables) -> DataFrame:
    return rounded(FE.boosting_features(t.contacts(*_BOOST), K.AS_OF)).select("id", *_BOOST_SQL)


_FOREST = ("id", "daily_limit", "organization_employees", "organization_industry", "seniority", "country", "esp_code", "campaign", "personalization", "headline",
           "link_tracking", "email_gap", *K.JSON_COLUMNS)
_FOREST_TEXT = "concat_ws(' ', campaign, personalization, headline)"
_FOREST_SQL = {
    "daily_limit_performance_score": sql_ladder("daily_limit", K.DAILY_LIMIT_SCORES_COARSE, 0), "is_high_daily_limit": _flag_sql("daily_limit >= 500"),
    "size_level": sql_cut("coalesce(organization_employees, 0)", K.SIZE_CATEGORY_BINS[0], [1, 2, 3, 4, 5], lowest=False), "is_small_company": _flag_sql("organization_employees <= 50"),
    "is_tech_executive": f"({_any_sql('organization_industry', K.TECH_INDUSTRIES)}) * ({_any_sql('seniority', K.TECH_EXECUTIVE_SENIORITY)})",
    "is_high_engagement_country": _flag_sql("country IN ('United States', 'Canada', 'United Kingdom', 'Australia', 'Germany')"),
    "text_word_count": _words_sql(_FOREST_TEXT), "has_phone": _flag_sql(f"regexp_matches({_FOREST_TEXT}, '{K.PHONE_PATTERN}')"), "exclamation_count": _count_sql(_FOREST_TEXT, "!"),
    "caps_ratio": f"round({_count_sql(_FOREST_TEXT, '[A-Z]')} / (length({_FOREST_TEXT}) + 1.0), 6)", "has_account_data": _flag_sql("account_data IS NOT NULL"),
}


@query("f_12_forest_features", on_contacts(f"SELECT id, {listed_sql(_FOREST_SQL)} FROM contacts"))
def forest_features(t: Tables) -> DataFrame:
    return rounded(FE.forest_features(t.contacts(*_FOREST))).select("id", *_FOREST_SQL)


_EXPLAIN_SQL = {"opened": _flag_sql("email_open_count > 0"), "created_hour": "hour(timestamp_created)", "is_weekend": _flag_sql("isodow(timestamp_created) >= 6"),
                "org_size_category": sql_cut("organization_employees", K.SIZE_CATEGORY_BINS[0], [0, 1, 2, 3, 4]), "company_age": f"CAST({_AGE} AS DOUBLE)",
                "is_mature_company": _flag_sql(f"{_AGE} >= 20"), "has_account_data": _flag_sql("account_data IS NOT NULL")}


@query("f_13_explain_features", on_contacts(f"SELECT id, {listed_sql(_EXPLAIN_SQL)} FROM contacts"))
def explain_features(t: Tables) -> DataFrame:
    df = t.contacts("id", "email_open_count", "timestamp_created", "organization_employees", "organization_founded_year", *K.JSON_COLUMNS)
    return FE.explain_features(df, K.AS_OF).select("id", *_EXPLAIN_SQL)


_TIMED = ("timestamp_created", "timestamp_last_open", "timestamp_last_reply")


@query("f_14_every_time_column", on_contacts(f"SELECT id, {listed_sql({k: v for c in _TIMED for k, v in {**_calendar_sql(c, c), **_rhythm_sql(c, c)}.items()})} FROM contacts"))
def every_time_column(t: Tables) -> DataFrame:
    return FE.every_time_column(t.contacts("id", *_TIMED)).drop(*_TIMED)


_STEPPED = ["email_clicked_step", "email_clicked_variant", "email_opened_step", "assigned_to"]


@query("f_15_value_flags", on_contacts("SELECT id, " + ", ".join(f"{_flag_sql(f'{c} IS NOT NULL')} AS {c}_has_value" for c in _STEPPED) + ", coalesce(assigned_to, 'Unknown') AS assigned_to_category FROM contacts"))
def value_flags(t: Tables) -> DataFrame:
    return FE.value_flags(t.contacts("id", *_STEPPED), _STEPPED).drop(*_STEPPED)


@query("f_16_source_types", on_contacts("SELECT k.source_type, c.column_name AS \"column\" FROM (DESCRIBE SELECT email, phone, timestamp_created, payload, api_status, linkedin_url, city FROM contacts) c, (VALUES "
    + ", ".join(f"('{s}', '{w}')" for s, ws in K.SOURCE_TYPE_KEYWORDS.items() for w in ws) + ") k(source_type, word) WHERE contains(lower(c.column_name), k.word) GROUP BY ALL"))
def source_types(t: Tables) -> DataFrame:
    return FE.source_types(t.contacts("email", "phone", "timestamp_created", "payload", "api_status", "linkedin_url", "city"))


_TRAIN = ("id", *K.ENGAGEMENT_COUNTS, *K.TIMESTAMP_COLUMNS, *_TEXTS, *K.JSON_COLUMNS, "seniority", "organization_industry", "country", "email", "phone")
_TRAIN_SQL = ["id", "engagement_level", "created_month", "days_since_creation", "has_last_contact", "text_length", "enrichment_completeness", "geo_industry_interaction"]


@query("f_17_training_frame", on_contacts(f"""SELECT c.id, CASE WHEN email_click_count > 0 OR email_reply_count > 0 THEN 2 WHEN email_open_count > 0 THEN 1 ELSE 0 END AS engagement_level,
  month(timestamp_created) AS created_month, {_DAYS} AS days_since_creation, {_flag_sql('timestamp_last_contact IS NOT NULL')} AS has_last_contact, length(combined_text) AS text_length,
  {' + '.join(_flag_sql(f'{c} IS NOT NULL') for c in K.JSON_COLUMNS)} AS enrichment_completeness, {INTERACTION_SQL['geo_industry_interaction']} AS geo_industry_interaction
  FROM contacts c JOIN texts USING (id)""", TEXT_CTE))
def training_frame(t: Tables) -> DataFrame:
    return FE.training_frame(t.contacts(*_TRAIN), K.AS_OF).select(*_TRAIN_SQL)


@query("f_18_ml_04_label_codes", on_contacts("""SELECT id, CAST(email_gap AS DOUBLE) AS email_gap, CAST(coalesce(daily_limit, 0) AS DOUBLE) AS daily_limit,
  CAST(dense_rank() OVER (ORDER BY coalesce(title, 'Unknown')) - 1 AS DOUBLE) AS title_code, CAST(dense_rank() OVER (ORDER BY coalesce(seniority, 'Unknown')) - 1 AS DOUBLE) AS seniority_code FROM contacts"""))
def label_codes(t: Tables) -> DataFrame:
    return FE.numeric_frame(t.contacts("id", "title", "seniority", "email_gap", "daily_limit"), ["title", "seniority"], "none", ["id"])


# --- whole runs -----------------------------------------------------------------------------------
_FENCED = f"""marks AS (SELECT quantile_cont(organization_employees, 0.25) AS a, quantile_cont(organization_employees, 0.75) AS b FROM contacts),
fenced AS (SELECT *, CASE WHEN organization_employees IS NOT NULL THEN least(greatest(organization_employees, a - 1.5 * (b - a)), b + 1.5 * (b - a)) END AS fenced_employees FROM contacts, marks)"""
_MODE = "(SELECT seniority FROM contacts WHERE seniority IS NOT NULL GROUP BY seniority ORDER BY count(*) DESC, seniority LIMIT 1)"


@query("f_19_three_phase_run", on_contacts(f"""SELECT id, round(CAST(coalesce(fenced_employees, (SELECT quantile_cont(fenced_employees, 0.5) FROM fenced)) AS DOUBLE), 6) AS organization_employees,
  coalesce(seniority, {_MODE}) AS seniority, hour(timestamp_created) AS timestamp_created_hour, coalesce(country, 'Unknown') || '_' || coalesce(seniority, {_MODE}) AS country_seniority_interaction,
  CASE WHEN email_click_count > 0 THEN 2 WHEN email_open_count > 0 AND email_click_count = 0 THEN 1 ELSE 0 END AS engagement_level FROM fenced""", _FENCED))
def three_phase_run(t: Tables) -> DataFrame:
    from leadmill.operators.runs import three_phase

    df = t.contacts("id", "organization_employees", "seniority", "country", "timestamp_created", "email_open_count", "email_click_count")
    return rounded(three_phase(df, ["organization_employees"], ["seniority"])).select(
        "id", "organization_employees", "seniority", "timestamp_created_hour", "country_seniority_interaction", "engagement_level")


@query("f_19_model_ready", on_contacts(f"""SELECT level AS engagement_level, n - CAST(floor(n * 0.25) AS BIGINT) AS train_rows, CAST(floor(n * 0.25) AS BIGINT) AS test_rows,
  least(50, 2 + (SELECT count(DISTINCT coalesce(seniority, {_MODE})) FROM contacts) + 1) AS features, TRUE AS same_width
  FROM (SELECT CASE WHEN email_click_count > 0 THEN 2 WHEN email_open_count > 0 AND email_click_count = 0 THEN 1 ELSE 0 END AS level, count(*) AS n FROM contacts GROUP BY 1)"""))
def model_ready(t: Tables) -> DataFrame:
    """The third phase: selected features with label and split, counted per label."""
    from pyspark.ml.functions import vector_to_array

    from leadmill.operators.runs import model_ready, three_phase

    df = t.contacts("id", "organization_employees", "seniority", "country", "timestamp_created", "email_open_count", "email_click_count")
    ready = model_ready(three_phase(df, ["organization_employees"], ["seniority"]), ["organization_employees", "timestamp_created_hour"], ["seniority"], "engagement_level", "id")
    width = F.size(vector_to_array("features"))
    return ready.groupBy(F.col("engagement_level").cast("int").alias("engagement_level")).agg(
        F.count_if(~F.col("is_test")).alias("train_rows"), F.count_if("is_test").alias("test_rows"), F.max(width).alias("features"), (F.min(width) == F.max(width)).alias("same_width"))


_CREDITS = 2000


@query("f_20_daily_run", on_contacts(f"""SELECT 'health' AS step, CAST(NULL AS BIGINT) AS rows, (epoch_us({AS_OF_SQL}) - epoch_us(max(timestamp_created))) / 3.6e9 <= 24 AS ok FROM contacts UNION ALL
  SELECT 'ingest', count(*), TRUE FROM contacts UNION ALL
  SELECT 'enrich', least(50, greatest(0, {_CREDITS} - count(*) FILTER (WHERE enrichment_id IS NOT NULL AND date_trunc('month', enriched_at) = date_trunc('month', {AS_OF_SQL}))), count(*) FILTER (WHERE enrichment_id IS NULL)), TRUE FROM contacts UNION ALL
  SELECT 'gold', count(*), TRUE FROM silver WHERE timestamp_last_contact <= {AS_OF_SQL} - INTERVAL 30 DAY AND email IS NOT NULL AND data_quality_score >= 0.3 UNION ALL
  SELECT 'retrain', NULL, (epoch_us({AS_OF_SQL}) - epoch_us(max(ts))) / 8.64e10 >= 7 FROM events WHERE event_type = 'signup'""", SILVER_CTE))
def daily_run_steps(t: Tables) -> DataFrame:
    """The ledger of one run that is started twice: the second start finds every step done."""
    from leadmill.operators.runs import daily_run

    path = SK.fresh_folder(t.spark, "daily")
    registry = t.events.filter("event_type = 'signup'").select(F.col("ts").alias("created"))
    leads = t.contacts("id", "timestamp_created", "enrichment_id", "enriched_at")
    for _ in range(2):
        out = daily_run(leads, silver(t), registry, K.AS_OF, path, "today", credits=_CREDITS)
    return out.drop("run")
