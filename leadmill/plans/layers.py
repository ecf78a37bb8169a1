"""Source, join, filter, sink, layer and monitoring reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import dates as D
from leadmill.functions import scores as S
from leadmill.functions import text as T
from leadmill.functions.expr import days_between, flag, half_even, lookup, number, safe_ratio
from leadmill.operators import features as FE
from leadmill.operators import kpi
from leadmill.operators import layers as L
from leadmill.operators import monitor as M
from leadmill.operators import quality as Q
from leadmill.operators import keyed as KY
from leadmill.operators import sinks as SK
from leadmill.plans.functions import (ACCOUNT_SQL, EMPLOYMENT_CTE, HOUR_SQL, ORGANIZATION_SQL, REVENUE_SQL, RESPONSE_SQL, SIZE_WORD_SQL, VALID_ORGANIZATION_CTE, _SERVICE_SQL,
                                      _any_sql, _calendar_sql, _flag_sql, _grouped_sql, _rhythm_sql, distance_sql)
from leadmill.plans.quality import rounded
from leadmill.plans.registry import AS_OF_SQL, on_contacts, query, quoted, sql_cut, sql_days, sql_ladder, sql_map
from leadmill.sources import readers as R
from leadmill.sources.tables import Tables

MID = datetime(2024, 2, 12)  # a time at which part of the leads is mature
MID_SQL = "TIMESTAMP '2024-02-12'"
LATE = datetime(2024, 1, 31)
LATE_SQL = "TIMESTAMP '2024-01-31'"


def landed(df: DataFrame, name: str, form: str, **options) -> str:
    """Writes a derived table to the shared folder and returns its path."""
    path = SK.fresh_folder(df.sparkSession, name)
    df.write.options(**options).format(form).save(path)
    return path


# --- sources ----------------------------------------------------------------------------
@query("src_01_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(t: Tables) -> DataFrame:
    customers = t.customer
    path = landed(customers, "customers", "csv", header=True)
    return R.good_lines(R.read_csv(t.spark, path, customers.schema))


@query("src_02_full_scan", "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem")
def full_scan(t: Tables) -> DataFrame:
    return t.lineitem.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query("src_03_incremental", on_contacts(f"SELECT id FROM contacts WHERE timestamp_created >= {LATE_SQL} - INTERVAL 7 DAY OR timestamp_updated >= {LATE_SQL} - INTERVAL 7 DAY"))
def incremental(t: Tables) -> DataFrame:
    return L.recent(t.contacts("id", "timestamp_created", "timestamp_updated"), LATE, 7).select("id")


@query("src_04_processable", on_contacts("SELECT id FROM contacts WHERE timestamp_created IS NOT NULL "))
def processable(t: Tables) -> DataFrame:
    return L.processable(t.contacts("id", "timestamp_created")).select("id")


@query("src_05_pending_silver", on_contacts(f"""SELECT id FROM silver WHERE processed_timestamp >= {MID_SQL} - INTERVAL 7 DAY
  OR (timestamp_last_contact <= {MID_SQL} - INTERVAL 30 DAY AND id NOT IN (SELECT id FROM contacts WHERE contact_key % 3 = 0))""",
    "silver AS (SELECT id, timestamp_last_contact, coalesce(timestamp_last_contact, TIMESTAMP '2024-02-10') AS processed_timestamp FROM contacts)"))
def pending_silver(t: Tables) -> DataFrame:
    silver = t.contacts("id", "timestamp_last_contact").withColumn(
        "processed_timestamp", F.coalesce("timestamp_last_contact", F.lit(datetime(2024, 2, 10))))
    gold = t.contacts("id", "contact_key").filter("contact_key % 3 = 0").select("id")
    return L.pending_silver(silver, gold, MID).select("id")


@query("src_06_keyed_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def keyed_scan(t: Tables) -> DataFrame:
    wanted = t.customer.filter("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(wanted, "o_custkey", "left_semi")


@query("src_07_first_non_empty", "SELECT 'customer' AS source, count(*) AS rows FROM customer")
def first_non_empty(t: Tables) -> DataFrame:
    name, df = R.first_non_empty([("no supplier", t.supplier.filter("s_suppkey < 0")), ("customer", t.customer), ("orders", t.orders)])
    return df.agg(F.lit(name).alias("source"), F.count("*").alias("rows"))


@query("src_08_text_emails", on_contacts("SELECT email FROM contacts WHERE email IS NOT NULL"))
def text_emails(t: Tables) -> DataFrame:
    lines = t.contacts("id", "email").select(F.concat(F.lit(" "), F.coalesce("email", F.lit("no address"))).alias("value"))
    return R.emails_from_text(t.spark, landed(lines, "lines", "text"))


@query("src_09_csv_emails", on_contacts("SELECT DISTINCT email FROM contacts WHERE email IS NOT NULL"))
def csv_emails(t: Tables) -> DataFrame:
    table = t.contacts("id", "email", "campaign").withColumnRenamed("email", "Contact_Email")
    path = landed(table, "people", "csv", header=True)
    return R.emails_from_table(R.good_lines(R.read_csv(t.spark, path, table.schema)))


@query("src_10_page_unwrap", "SELECT event_id AS page, event_id + i AS item FROM events, range(2) r(i) WHERE i = 0 OR event_id % 3 < 2")
def page_unwrap(t: Tables) -> DataFrame:
    one = F.concat(F.lit('{"id": "'), F.col("event_id").cast("string"), F.lit('"}'))
    two = F.concat(F.lit("["), one, F.lit(', {"id": "'), (F.col("event_id") + 1).cast("string"), F.lit('"}]'))
    shape = F.col("event_id") % 3
    page = F.when(shape == 0, F.concat(F.lit('{"items": '), two, F.lit("}"))).when(shape == 1, two).otherwise(one)
    pages = t.events.select(F.col("event_id").alias("page"), page.alias("doc"))
    items = F.explode(R.unwrap_page(F.col("doc"), "struct<id:string>"))
    return pages.select("page", items.alias("i")).select("page", F.col("i.id").cast("bigint").alias("item"))


_RATES_JSON = {"open_rate": "CAST(coalesce(email_open_count, 0) / 8 AS STRING)", "click_rate": "'n/a'"}


@query("src_11_lead_payload", on_contacts("""SELECT id AS lead_id, campaign AS campaign_id, email, title,
  CAST(CAST(coalesce(email_open_count, 0) AS DOUBLE) / 8 AS DOUBLE) AS open_rate, 0.0::DOUBLE AS click_rate, 0.0::DOUBLE AS reply_rate FROM contacts"""))
def lead_payload(t: Tables) -> DataFrame:
    df = t.contacts("id", "campaign", "email", "title", "email_open_count")
    lead = F.struct(F.col("id"), F.col("campaign").alias("campaign_id"), "email", "title", F.lit("n/a").alias("click_rate"),
                    (F.coalesce("email_open_count", F.lit(0)) / 8).cast("string").alias("open_rate"))
    batches = df.select(F.to_json(F.struct(F.array(lead).alias("data"))).alias("payload"))
    return R.normal_leads(batches, "payload").select("lead_id", "campaign_id", "email", "title", "open_rate", "click_rate", "reply_rate")


def _people(t: Tables) -> DataFrame:
    df = t.contacts("id", "enrichment_id", "email", "enrichment_name", "title", "city", "state", "country", "organization_name",
                    "organization_industry", "organization_employees", "company_revenue", "departments", "organization_founded_year", "contact_key")
    jobs = F.array(F.struct(F.lit("Old Org").alias("organization_name"), F.lit("Clerk").alias("title"), F.lit("2001-01-01").alias("start_date"), F.lit(False).alias("current")),
                   F.struct(F.lit("New Org").alias("organization_name"), F.col("title"), F.lit("2015-01-01").alias("start_date"), (F.col("contact_key") % 2 == 0).alias("current")))
    organization = F.struct(F.col("organization_name").alias("name"), F.col("organization_industry").alias("industry"),
                            F.col("organization_employees").alias("estimated_num_employees"), F.col("company_revenue").alias("annual_revenue"),
                            F.col("organization_founded_year").alias("founded_year"), "city", "country")
    person = F.struct(F.col("enrichment_id").alias("id"), F.col("enrichment_name").alias("name"), "email", "title", "city", "state", "country", "departments",
                      organization.alias("organization"), jobs.alias("employment_history"))
    return df.select("id", F.to_json(F.struct(F.array(person).alias("people"), person.alias("person"))).alias("doc"))


@query("src_12_enrichment_payload", on_contacts("""SELECT id, email, organization_industry AS company_industry, company_revenue, organization_employees AS employee_count,
  concat_ws(', ', city, country) AS company_location FROM contacts"""))
def enrichment_payload(t: Tables) -> DataFrame:
    return R.normal_enrichment(_people(t), "id", "doc").select("id", "email", "company_industry", "company_revenue", "employee_count", "company_location")


@query("src_13_first_per_lead", "SELECT user_id, arg_min(event_id, struct_pack(t := ts, e := event_id)) AS event_id, arg_min(event_type, struct_pack(t := ts, e := event_id)) AS event_type FROM events GROUP BY user_id")
def first_per_lead(t: Tables) -> DataFrame:
    feed = t.events.select("user_id", "event_id", "event_type", "ts")
    return R.first_per_lead(feed, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("src_14_person_flatten", on_contacts("""SELECT id, enrichment_id, enrichment_name AS full_name, title, city, country, organization_name, organization_employees,
  CAST(organization_founded_year AS INTEGER) AS organization_founded, CASE WHEN contact_key % 2 = 0 THEN 'New Org' ELSE 'Old Org' END AS current_company,
  CASE WHEN contact_key % 2 = 0 THEN title ELSE 'Clerk' END AS current_title, replace(departments_text, ',', ', ') AS departments FROM contacts"""))
def person_flatten(t: Tables) -> DataFrame:
    return R.flat_person(_people(t), "id", "doc").select(
        "id", "enrichment_id", "full_name", "title", "city", "country", "organization_name", "organization_employees", "organization_founded",
        "current_company", "current_title", "departments")


@query("src_15_search_flatten", on_contacts("""SELECT id, enrichment_id AS person_id, enrichment_name AS name, email, title, organization_name AS company,
  organization_employees AS employees, concat_ws(', ', city, state, country) AS location FROM contacts"""))
def search_flatten(t: Tables) -> DataFrame:
    return R.flat_search(_people(t), "id", "doc")


_STEPS = "range(p_partkey % 3 + 1) s(i)"


def _sequences(t: Tables) -> DataFrame:
    variants = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("p_size") % 2), lambda v: F.struct(
        F.concat(F.lit("subject "), v.cast("string")).alias("subject"), F.col("p_name").alias("body")))
    steps = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("p_partkey") % 3), lambda i: F.struct(
        F.lit("email").alias("type"), (i * 2).cast("int").alias("delay"), variants.alias("variants")))
    return t.part.select(F.col("p_partkey").alias("campaign_id"), F.to_json(steps).alias("sequences"))


@query("src_16_campaign_steps", f"SELECT p_partkey AS campaign_id, i AS step_index, 'email' AS type, i * 2 AS delay FROM part, {_STEPS}")
def campaign_steps(t: Tables) -> DataFrame:
    return R.campaign_parts(_sequences(t), "campaign_id", "sequences")[0]


@query("src_16_campaign_variants", f"""SELECT p_partkey AS campaign_id, i AS step_index, v AS variant_index, 'subject ' || v AS subject, p_name AS body
  FROM part, {_STEPS}, range(p_size % 2 + 1) w(v)""")
def campaign_variants(t: Tables) -> DataFrame:
    return R.campaign_parts(_sequences(t), "campaign_id", "sequences")[1]


@query("src_17_latest_model", "SELECT p_type AS model_type, arg_max(p_partkey, p_partkey) AS version, arg_max(p_name, p_partkey) AS model_name FROM part WHERE p_size % 2 = 0 GROUP BY p_type")
def latest_model(t: Tables) -> DataFrame:
    active = t.part.filter("p_size % 2 = 0")
    return active.groupBy(F.col("p_type").alias("model_type")).agg(F.max("p_partkey").alias("version"),
                                                                   F.max_by("p_name", "p_partkey").alias("model_name"))


# --- service layer ------------------------------------------------------------------------
_LEAD_COLUMNS = ("id", "email", "campaign", "first_name", "last_name", "company_name", "title", "contact_key", "email_bounce_count",
                 "timestamp_created", "timestamp_last_contact", *K.ENGAGEMENT_COUNTS)


def service_leads(t: Tables) -> DataFrame:
    """Leads with rates of their day's mails; parts over ten, so that every rate is a short fraction."""
    df = t.contacts(*_LEAD_COLUMNS)
    rates = {r: F.least(F.coalesce(F.col(c), F.lit(0)) / 4, F.lit(1.0)) for r, c in (
        ("open_rate", "email_open_count"), ("click_rate", "email_click_count"), ("reply_rate", "email_reply_count"), ("bounce_rate", "email_bounce_count"))}
    return df.withColumns(rates).withColumnsRenamed({"id": "lead_id", "timestamp_created": "created_date", "timestamp_last_contact": "last_activity_date"})


def service_enrichment(t: Tables) -> DataFrame:
    return (t.contacts("id", "contact_key", "company_size_text", "company_revenue", "organization_industry", "organization_employees", "technologies", "social_profiles")
            .filter("contact_key % 4 <> 0").select(
        F.col("id").alias("lead_id"), F.col("company_size_text").alias("company_size"), "company_revenue",
        F.col("organization_industry").alias("company_industry"), F.col("organization_employees").alias("employee_count"), "technologies",
        F.col("social_profiles").alias("social_media_profiles")))


SERVICE_CTE = f"""service_leads AS (SELECT *, id AS lead_id, least(coalesce(email_open_count, 0) / 4.0::DOUBLE, 1) AS open_rate, least(coalesce(email_click_count, 0) / 4.0::DOUBLE, 1) AS click_rate,
  least(coalesce(email_reply_count, 0) / 4.0::DOUBLE, 1) AS reply_rate, least(coalesce(email_bounce_count, 0) / 4.0::DOUBLE, 1) AS bounce_rate FROM contacts),
joined AS (SELECT l.* EXCLUDE (company_size_text, company_revenue, organization_industry, organization_employees, technologies, social_profiles),
  CASE WHEN contact_key % 4 <> 0 THEN company_size_text END AS company_size_text, CASE WHEN contact_key % 4 <> 0 THEN company_revenue END AS company_revenue,
  CASE WHEN contact_key % 4 <> 0 THEN organization_industry END AS organization_industry, CASE WHEN contact_key % 4 <> 0 THEN organization_employees END AS organization_employees,
  CASE WHEN contact_key % 4 <> 0 THEN technologies END AS technologies, CASE WHEN contact_key % 4 <> 0 THEN social_profiles END AS social_profiles FROM service_leads l),
s1 AS (SELECT *, coalesce({sql_days(AS_OF_SQL, 'timestamp_last_contact')}, 0) AS quiet, coalesce({sql_days(AS_OF_SQL, 'timestamp_created')}, 0) AS age,
  {SIZE_WORD_SQL} AS size_word, {REVENUE_SQL} AS revenue_word, {_SERVICE_SQL} AS industry_word,
  coalesce(CASE WHEN technologies LIKE '[%' THEN json_array_length(technologies) > 0 WHEN technologies LIKE '{{%' THEN len(json_keys(technologies)) > 0 END, FALSE) AS stack,
  coalesce(least(len(list_filter(map_values(CAST(from_json(social_profiles, '"JSON"') AS MAP(VARCHAR, VARCHAR))), lambda v: coalesce(v, '') <> '')), 3) / 3.0::DOUBLE, 0) AS social FROM joined),
s2 AS (SELECT *, least(greatest((open_rate * 0.3::DOUBLE + click_rate * 0.25::DOUBLE + reply_rate * 0.35::DOUBLE + (1 - bounce_rate) * 0.1::DOUBLE)
  * CASE WHEN quiet > 30 THEN greatest(0.1::DOUBLE, 1 - (quiet - 30) / 365.0::DOUBLE) ELSE 1 END, 0), 1) AS score FROM s1),
service_silver AS (SELECT lead_id, open_rate AS avg_open_rate, click_rate AS avg_click_rate, reply_rate AS avg_reply_rate,
  CASE WHEN score > 0.7 THEN 'increasing' WHEN score < 0.3 THEN 'decreasing' ELSE 'stable' END AS engagement_trend, quiet AS days_since_last_activity, 1 AS total_emails_sent,
  size_word AS company_size_category, revenue_word AS revenue_category, industry_word AS industry_category,
  {sql_ladder('nullif(organization_employees, 0)', [(b, s) for b, _, s in K.EMPLOYEE_COUNT_BUCKETS], 'unknown', '<')} AS employee_count_bucket,
  stack AS has_technology_stack, round(social, 6) AS social_media_presence_score, age AS lead_age_days, CASE WHEN age > 0 THEN round(reply_rate / age, 6) ELSE 0 END AS response_velocity,
  CASE WHEN age > 0 THEN round(1.0::DOUBLE / age, 6) ELSE 0 END AS email_frequency, round(score, 6) AS engagement_score,
  score > 0.5 AND bounce_rate < 0.3 AND least(quiet, 365) < 60 AS is_qualified_lead, round(score * 0.6 + social * 0.2 + (1 - bounce_rate) * 0.2, 6) AS lead_quality_score,
  timestamp_created AS created_timestamp, score AS raw_score, quiet, timestamp_last_contact FROM s2)"""
_SERVICE_OUT = "* EXCLUDE (created_timestamp, raw_score, quiet, timestamp_last_contact)"


def service_silver(t: Tables) -> DataFrame:
    return L.service_features(L.joined_leads(service_leads(t), service_enrichment(t)), K.AS_OF)


@query("f_06_service_features", on_contacts(f"SELECT {_SERVICE_OUT} FROM service_silver", SERVICE_CTE))
def service_features(t: Tables) -> DataFrame:
    return rounded(service_silver(t)).drop("feature_vector")


@query("jn_01_leads_enrichment", on_contacts("SELECT lead_id, company_size_text AS company_size, organization_employees AS employee_count FROM joined", SERVICE_CTE))
def leads_enrichment(t: Tables) -> DataFrame:
    return L.joined_leads(service_leads(t).select("lead_id"), service_enrichment(t)).select("lead_id", "company_size", "employee_count")


@query("mth_08_09_scores", on_contacts("SELECT lead_id, engagement_score, engagement_trend, is_qualified_lead, lead_quality_score, response_velocity, email_frequency FROM service_silver", SERVICE_CTE))
def score_columns(t: Tables) -> DataFrame:
    return rounded(service_silver(t).select("lead_id", "engagement_score", "engagement_trend", "is_qualified_lead", "lead_quality_score", "response_velocity", "email_frequency"))


def _gold(t: Tables) -> DataFrame:
    created = service_leads(t).select("lead_id", F.col("created_date").alias("created_timestamp"), "contact_key")
    silver = service_silver(t).join(created, "lead_id")
    known = created.filter("contact_key % 3 = 0").select("lead_id")
    return L.service_gold(silver, known, MID)


_GOLD_CTE = SERVICE_CTE + f""", service_gold AS (SELECT lead_id, CASE o WHEN 'converted' THEN 2 WHEN 'ongoing' THEN 1 ELSE 0 END AS target_label, o AS lead_outcome,
  round(raw_score, 6) AS final_engagement_score, TRUE AS training_eligible, age AS data_maturity_days FROM (SELECT *,
  CASE WHEN raw_score > 0.7 AND is_qualified_lead THEN 'converted' WHEN raw_score > 0.4 AND is_qualified_lead THEN 'ongoing' WHEN quiet > 60 THEN 'cold' ELSE 'disqualified' END AS o,
  {sql_days(MID_SQL, 'created_timestamp')} AS age FROM service_silver WHERE created_timestamp <= {MID_SQL} - INTERVAL 30 DAY
  AND lead_id NOT IN (SELECT id FROM contacts WHERE contact_key % 3 = 0)))"""


@query("f_07_mth_10_service_gold", on_contacts("SELECT * FROM service_gold", _GOLD_CTE))
def service_gold(t: Tables) -> DataFrame:
    return rounded(_gold(t)).drop("feature_vector")


@query("src_18_training_rows", on_contacts("SELECT lead_id, target_label, quiet2 AS days_since_activity, size_code AS company_size_encoded FROM (SELECT g.*, least(s.days_since_last_activity, 365) AS quiet2, "
    + sql_map("s.company_size_category", K.SIZE_CODES, 0) + " AS size_code FROM service_gold g JOIN service_silver s USING (lead_id)) WHERE data_maturity_days >= 30", _GOLD_CTE))
def training_rows(t: Tables) -> DataFrame:
    return L.training_rows(_gold(t)).select("lead_id", "target_label", "days_since_activity", "company_size_encoded")


@query("mth_14_ratio_features", on_contacts(f"""SELECT lead_id, round(avg_click_rate / (avg_open_rate + 1e-6), 4) AS click_through_rate, round(avg_reply_rate / (raw_score + 1e-6), 4) AS engagement_reply_ratio,
  {sql_map('company_size_category', K.SIZE_CODES, 0)} * {sql_map('revenue_category', K.REVENUE_CODES, 0)} AS company_maturity,
  round(ln(1 + least(days_since_last_activity, 365)), 6) AS days_since_activity_log, round(ln(1 + least(lead_age_days, 365)), 6) AS lead_age_days_log FROM service_silver""", SERVICE_CTE))
def ratio_features(t: Tables) -> DataFrame:
    vectors = L.unpack_vector(service_silver(t).select("lead_id", "feature_vector"))
    places = {"click_through_rate": 4, "engagement_reply_ratio": 4}
    return vectors.select("lead_id", *[F.round(c, places.get(n, 6)).alias(n) if n != "company_maturity" else c.alias(n)
                                       for n, c in S.ratio_features().items()])


@query("mth_15_social_presence", on_contacts(f"""SELECT id, round(social, 6) AS presence,
  least({_flag_sql("coalesce(linkedin_url, '') <> ''")} * 0.5::DOUBLE + {_flag_sql("coalesce(website, '') <> ''")} * 0.3::DOUBLE + CASE WHEN stack THEN 0.2::DOUBLE ELSE 0 END, 1) AS direct FROM s1""",
    SERVICE_CTE.replace("CASE WHEN contact_key % 4 <> 0 THEN technologies END", "technologies").replace("CASE WHEN contact_key % 4 <> 0 THEN social_profiles END", "social_profiles")))
def social_presence(t: Tables) -> DataFrame:
    from leadmill.functions import json_features as J

    df = t.contacts("id", "social_profiles", "technologies", "linkedin_url", "website")
    direct = S.direct_social_presence(F.col("linkedin_url"), F.col("website"), J.has_stack(F.col("technologies")))
    return rounded(df.select("id", J.social_presence(F.col("social_profiles")).alias("presence"), direct.alias("direct")))


@query("mth_19_prediction_features", on_contacts(f"""SELECT id, coalesce(organization_employees, 0) AS employees, coalesce(TRY_CAST(regexp_replace(company_size_text, '[^0-9]', '', 'g') AS BIGINT), 0) AS size_digits,
  {K.AS_OF.year} - coalesce(organization_founded_year, {K.AS_OF.year}) AS company_age, page_retrieved AS page, {sql_map('esp_code', K.ESP_SCORES, 0)} AS esp_score,
  {_any_sql('lower(title)', K.HIGH_VALUE_TITLES)} AS is_high_value_title, {_any_sql('lower(title)', K.DECISION_WORDS)} AS is_decision_maker,
  coalesce(hour(timestamp_created), 0) AS hour, coalesce(isodow(timestamp_created) - 1, 0) AS weekday FROM contacts"""))
def prediction_features(t: Tables) -> DataFrame:
    df = t.contacts("id", "organization_employees", "company_size_text", "organization_founded_year", "page_retrieved", "esp_code", "title", "timestamp_created")
    year = F.lit(K.AS_OF.year)
    return df.select(
        "id", F.coalesce("organization_employees", F.lit(0)).alias("employees"), F.coalesce(T.digits_only(F.col("company_size_text")), F.lit(0)).alias("size_digits"),
        (year - F.coalesce("organization_founded_year", year)).alias("company_age"), F.col("page_retrieved").alias("page"),
        lookup(F.col("esp_code"), K.ESP_SCORES, 0).alias("esp_score"), T.keyword_flag(F.col("title"), K.HIGH_VALUE_TITLES).alias("is_high_value_title"),
        T.keyword_flag(F.col("title"), K.DECISION_WORDS).alias("is_decision_maker"), F.coalesce(F.hour("timestamp_created"), F.lit(0)).alias("hour"),
        F.coalesce(F.weekday("timestamp_created"), F.lit(0)).alias("weekday"))


# --- filters ----------------------------------------------------------------------------
@query("flt_01_mature", on_contacts(f"SELECT id, {sql_days(MID_SQL, 'timestamp_last_contact')} AS lead_maturity_days, 1 AS is_mature_lead FROM contacts WHERE timestamp_last_contact <= {MID_SQL} - INTERVAL 30 DAY"))
def mature(t: Tables) -> DataFrame:
    return L.mature(t.contacts("id", "timestamp_last_contact"), MID).select("id", "lead_maturity_days", "is_mature_lead")


@query("flt_02_gold_quality", on_contacts("SELECT id FROM contacts WHERE email IS NOT NULL AND (CASE WHEN title IS NULL THEN 0.2 ELSE 0.9 END) >= 0.3"))
def gold_quality(t: Tables) -> DataFrame:
    df = FE.target(t.contacts("id", "email", "title", *K.ENGAGEMENT_COUNTS)).withColumn(
        "data_quality_score", F.when(F.col("title").isNull(), 0.2).otherwise(0.9))
    return L.gold_quality(df).select("id")


@query("flt_03_created_mature", on_contacts(f"SELECT id FROM contacts WHERE timestamp_created <= {MID_SQL} - INTERVAL 30 DAY AND seniority IS NOT NULL"))
def created_mature(t: Tables) -> DataFrame:
    return (t.contacts("id", "timestamp_created", "seniority").filter("seniority IS NOT NULL")
            .filter(F.col("timestamp_created") <= F.lit(MID) - F.expr("INTERVAL 30 DAYS")).select("id"))


@query("flt_04_engagement_window", on_contacts(f"SELECT id FROM contacts WHERE timestamp_created >= {LATE_SQL} - INTERVAL 14 DAY AND (timestamp_last_click >= {LATE_SQL} - INTERVAL 14 DAY OR timestamp_last_click IS NULL)"))
def engagement_window(t: Tables) -> DataFrame:
    since = F.lit(LATE) - F.expr("INTERVAL 14 DAYS")
    active = F.col("timestamp_last_click")
    return (t.contacts("id", "timestamp_created", "timestamp_last_click")
            .filter((F.col("timestamp_created") >= since) & ((active >= since) | active.isNull())).select("id"))


@query("flt_05_stale", on_contacts("""SELECT id FROM (SELECT id, timestamp_updated, sum(coalesce(email_reply_count, 0)) OVER (PARTITION BY email) > 0 AS qualified FROM contacts)
  WHERE timestamp_updated <= TIMESTAMP '2024-04-10 00:00:00' - INTERVAL 60 DAY AND qualified"""))
def stale(t: Tables) -> DataFrame:
    df = t.contacts("id", "email", "timestamp_updated", "email_reply_count")
    replied = df.groupBy(F.col("email").alias("mail")).agg((F.sum(F.coalesce("email_reply_count", F.lit(0))) > 0).alias("is_qualified_lead"))
    return L.stale(df.join(replied, F.col("email").eqNullSafe(F.col("mail"))), datetime(2024, 4, 10)).select("id")


_SEASON = ["timestamp_last_interest_change", "enriched_at", "timestamp_created"]
_IN_SEASON = f"BETWEEN TIMESTAMP '2023-11-01' AND {AS_OF_SQL}"


@query("flt_06_realistic_window", on_contacts("SELECT id FROM contacts, (SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} {_IN_SEASON}) > 1000 AS u{i}" for i, c in enumerate(_SEASON)) + " FROM contacts) WHERE CASE "
    + " ".join(f"WHEN u{i} THEN {c} {_IN_SEASON}" for i, c in enumerate(_SEASON)) + " ELSE FALSE END"))
def realistic_window(t: Tables) -> DataFrame:
    return L.realistic_window(t.contacts("id", *_SEASON), _SEASON, K.AS_OF).select("id")


@query("flt_07_input_validation", on_contacts("""SELECT id, concat_ws(',', CASE WHEN email IS NULL THEN 'email' END, CASE WHEN title IS NULL THEN 'title' END,
  CASE WHEN company_name IS NULL THEN 'company_name' END) AS missing, email IS NOT NULL AND title IS NOT NULL AND company_name IS NOT NULL AS is_valid FROM contacts"""))
def input_validation(t: Tables) -> DataFrame:
    needed = ["email", "title", "company_name"]
    missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in needed]), lambda c: c.isNotNull())
    return t.contacts("id", *needed).select("id", F.array_join(missing, ",").alias("missing"), (F.size(missing) == 0).alias("is_valid"))


@query("flt_08_high_clickers", on_contacts("SELECT campaign, count(*) FILTER (WHERE email_click_count >= 5) AS five_plus, count(*) FILTER (WHERE email_click_count >= 3) AS three_plus FROM contacts GROUP BY campaign"))
def high_clickers(t: Tables) -> DataFrame:
    clicks = F.col("email_click_count")
    return t.contacts("campaign", "email_click_count").groupBy("campaign").agg(
        F.count_if(clicks >= 5).alias("five_plus"), F.count_if(clicks >= 3).alias("three_plus"))


@query("flt_09_other_finder", on_contacts("SELECT organization_industry AS value, regexp_matches(lower(organization_industry), 'other|unknown|nan') AS is_other, count(*) AS rows FROM contacts WHERE organization_industry IS NOT NULL GROUP BY 1, 2"))
def other_finder(t: Tables) -> DataFrame:
    value = F.col("organization_industry")
    return (t.contacts("organization_industry").dropna().groupBy(value.alias("value"), value.rlike("(?i)(other|unknown|nan)").alias("is_other"))
            .agg(F.count("*").alias("rows")))


@query("flt_10_11_maturity_settings", on_contacts(" UNION ALL ".join(
    f"SELECT '{env}' AS environment, count(*) FILTER (WHERE {sql_days(LATE_SQL, 'timestamp_created')} >= {m}) AS mature, "
    f"count(*) FILTER (WHERE timestamp_created >= {LATE_SQL} - INTERVAL {e} DAY) AS engaged FROM contacts" for env, (m, e) in K.MATURITY_SETTINGS.items())))
def maturity_settings(t: Tables) -> DataFrame:
    created = F.col("timestamp_created")
    aggs = [F.struct(F.lit(env).alias("environment"), F.count_if(D.is_mature(created, LATE, m)).alias("mature"),
                     F.count_if(created >= F.lit(LATE) - F.make_dt_interval(F.lit(e))).alias("engaged")) for env, (m, e) in K.MATURITY_SETTINGS.items()]
    return t.contacts("timestamp_created").agg(F.array(*aggs).alias("r")).select(F.inline("r"))


# --- joins --------------------------------------------------------------------------------
@query("jn_02_enriched_lead", on_contacts("""SELECT l.id, coalesce(json_extract_string(e.doc, '$.name'), l.first_name) AS first_name, TRY_CAST(json_extract_string(e.doc, '$.employees') AS INTEGER) AS employees
  FROM contacts l LEFT JOIN (SELECT id, '{"name": "N' || contact_key || '", "employees": "' || coalesce(company_size_text, 'x') || '"}' AS doc FROM contacts WHERE contact_key % 4 <> 0) e USING (id)"""))
def enriched_lead(t: Tables) -> DataFrame:
    doc = F.to_json(F.struct(F.concat(F.lit("N"), F.col("contact_key").cast("string")).alias("name"), F.coalesce("company_size_text", F.lit("x")).alias("employees")))
    enrichment = t.contacts("id", "contact_key", "company_size_text").filter("contact_key % 4 <> 0").select("id", doc.alias("doc"))
    return t.contacts("id", "first_name").join(enrichment, "id", "left").select(
        "id", F.coalesce(F.get_json_object("doc", "$.name"), "first_name").alias("first_name"), F.get_json_object("doc", "$.employees").try_cast("int").alias("employees"))


@query("jn_03_04_not_in_gold", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def not_in_gold(t: Tables) -> DataFrame:
    done = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(done, "c_custkey", "left_anti")


@query("jn_05_existing_and_new", "SELECT CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN 'existing' ELSE 'new' END AS state, count(*) AS rows FROM customer GROUP BY 1")
def existing_and_new(t: Tables) -> DataFrame:
    known = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    customers = t.customer.select("c_custkey")
    old = customers.join(known, "c_custkey", "left_semi").select(F.lit("existing").alias("state"))
    return old.unionByName(customers.join(known, "c_custkey", "left_anti").select(F.lit("new").alias("state"))).groupBy("state").agg(F.count("*").alias("rows"))


@query("jn_06_campaign_facts", on_contacts(f"""SELECT id, campaign_size, campaign_duration_days, {HOUR_SQL.format(ts='timestamp_created')} AS created_hour_category FROM contacts LEFT JOIN (
  SELECT campaign, count(*) AS campaign_size, {sql_days('max(timestamp_created)', 'min(timestamp_created)')} AS campaign_duration_days FROM contacts WHERE campaign IS NOT NULL GROUP BY campaign) USING (campaign)"""))
def campaign_facts(t: Tables) -> DataFrame:
    return FE.engagement_features(t.contacts("id", "campaign", "timestamp_created")).select("id", "campaign_size", "campaign_duration_days", "created_hour_category")


@query("jn_07_first_seen", on_contacts("SELECT id, strftime(min(timestamp_created) OVER (PARTITION BY email_list), '%Y-%m-%d %H:%M:%S') AS first_seen FROM contacts WHERE email_list IS NOT NULL"))
def first_seen(t: Tables) -> DataFrame:
    from leadmill.operators.timeseries import first_seen as seen

    return seen(t.contacts("id", "email_list", "timestamp_created"), "email_list", "timestamp_created").select("id", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


@query("jn_09_provider_lookup", on_contacts(f"SELECT id, {sql_map('esp_code', K.ESP_PROVIDERS, 'Unknown')} AS provider, {sql_map('esp_code', K.ESP_SCORES, 0)} AS score FROM contacts"))
def provider_lookup(t: Tables) -> DataFrame:
    code = F.col("esp_code")
    return t.contacts("id", "esp_code").select("id", lookup(code, K.ESP_PROVIDERS, "Unknown").alias("provider"), lookup(code, K.ESP_SCORES, 0).alias("score"))


@query("jn_10_top_values", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 10)")
def top_values(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    best = kpi.top(lines.groupBy("l_suppkey").agg(F.count("*").alias("n")), "n", 10, ["l_suppkey"]).select("l_suppkey")
    return lines.join(F.broadcast(best), "l_suppkey", "left_semi").drop("l_suppkey")


@query("jn_11_newest_match", "SELECT c_custkey, o_orderkey AS last_order FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) AS o_orderkey FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def newest_match(t: Tables) -> DataFrame:
    newest = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"))
    return t.customer.select("c_custkey").join(newest, "c_custkey", "left")


@query("jn_12_search_score", on_contacts("SELECT id, coalesce(CASE WHEN contact_key % 5 <> 0 THEN page_retrieved END, 100) + CASE WHEN contact_key % 4 <> 0 THEN 50 ELSE 0 END AS score FROM contacts"))
def search_score(t: Tables) -> DataFrame:
    pages = t.contacts("id", "page_retrieved", "contact_key").filter("contact_key % 5 <> 0").select("id", "page_retrieved")
    joined = t.contacts("id", "enrichment_id").join(pages, "id", "left")
    return joined.select("id", (F.coalesce("page_retrieved", F.lit(100)) + flag(F.col("enrichment_id").isNotNull()) * 50).alias("score"))


@query("jn_13_coverage", "SELECT count(DISTINCT c_custkey) AS leads, count(DISTINCT o_custkey) AS enriched, round(count(DISTINCT o_custkey) * 100.0 / count(DISTINCT c_custkey), 4) AS coverage_pct FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def coverage(t: Tables) -> DataFrame:
    # distinct keys before the join keep the join one to one
    known = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("hit", F.lit(1))
    return t.customer.select("c_custkey").distinct().join(known, "c_custkey", "left").agg(
        F.count("*").alias("leads"), F.count("hit").alias("enriched"), F.round(F.count("hit") * 100.0 / F.count("*"), 4).alias("coverage_pct"))


@query("jn_14_resume_set", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)")
def resume_set(t: Tables) -> DataFrame:
    done = t.part.filter("p_size > 25").select(F.col("p_partkey").alias("l_partkey"))
    return t.lineitem.select("l_partkey").distinct().join(done, "l_partkey", "left_anti")


# --- sinks -----------------------------------------------------------------------------------
@query("snk_01_append", "SELECT o_orderstatus, count(*) AS rows, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def append(t: Tables) -> DataFrame:
    path = SK.fresh_folder(t.spark, "orders")
    for status in ("F", "O", "P"):
        SK.append(t.orders.filter(F.col("o_orderstatus") == status), path)
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("snk_02_idempotent_append", "SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS keys FROM orders")
def idempotent_append(t: Tables) -> DataFrame:
    path = SK.fresh_folder(t.spark, "orders")
    for batch, part in (("even", t.orders.filter("o_orderkey % 2 = 0")), ("all", t.orders), ("all", t.orders), ("again", t.orders)):
        KY.append_keyed(part, path, ["o_orderkey"], batch)
    return KY.read_keyed(t.spark, path).agg(F.count("*").alias("rows"), F.count_distinct("o_orderkey").alias("keys"))


def _priced(t: Tables) -> tuple[DataFrame, DataFrame]:
    target = t.part.filter("p_partkey % 3 <> 0").select("p_partkey", "p_name", "p_retailprice", F.lit("old").alias("origin"))
    source = t.part.filter("p_partkey % 2 = 0").select("p_partkey", F.upper("p_name").alias("p_name"), (F.col("p_retailprice") + 1).alias("p_retailprice"), F.lit("new").alias("origin"))
    return target, source


@query("snk_03_upsert", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS p_name, p_retailprice + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS p_retailprice, CASE WHEN p_partkey % 2 = 0 THEN 'new' ELSE 'old' END AS origin FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0")
def upsert(t: Tables) -> DataFrame:
    path, (target, source) = SK.fresh_folder(t.spark, "parts"), _priced(t)
    slot = (F.col("p_partkey") % 8).alias("slot")
    for rows in (target, target, source, source.unionByName(source)):  # repeated writes and repeated keys change nothing
        SK.upsert_table(rows.select("*", slot), path, ["p_partkey"], "slot")
    return t.spark.read.parquet(path).drop("slot")


@query("snk_04_partial_upsert", "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_name ELSE upper(p_name) END AS p_name, p_retailprice + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS p_retailprice, CASE WHEN p_partkey % 3 <> 0 THEN 'old' ELSE 'new' END AS origin FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0")
def partial_upsert(t: Tables) -> DataFrame:
    return SK.merge_columns(*_priced(t), ["p_partkey"], ["p_retailprice"])


@query("snk_05_06_insert_ignore", "SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN 'old' ELSE 'new' END AS origin FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0")
def insert_ignore(t: Tables) -> DataFrame:
    target, source = _priced(t)
    return target.unionByName(SK.new_rows(source, target, ["p_partkey"])).select("p_partkey", "origin")


@query("snk_07_backfill", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, s) AS status FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderstatus, struct_pack(d := o_orderdate, k := o_orderkey)) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def backfill(t: Tables) -> DataFrame:
    target = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("status"))
    source = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("status"), "o_orderdate", "o_orderkey")
    return SK.backfill(target, source, ["c_custkey"], ["status"], [F.col("o_orderdate"), F.col("o_orderkey")])


@query("snk_08_f_40_align", on_contacts("SELECT id, email_open_count::BIGINT AS email_open_count, CAST(NULL AS BIGINT) AS days_since_reply, 0 AS has_reply, '' AS note, coalesce(title, '') AS title FROM (SELECT id, coalesce(email_open_count, 0) AS email_open_count, title FROM contacts)"))
def align(t: Tables) -> DataFrame:
    from pyspark.sql import types as TY

    schema = TY.StructType([TY.StructField("id", TY.StringType()), TY.StructField("email_open_count", TY.LongType()), TY.StructField("days_since_reply", TY.LongType()),
                            TY.StructField("has_reply", TY.IntegerType()), TY.StructField("note", TY.StringType()), TY.StructField("title", TY.StringType())])
    return FE.align_to_schema(t.contacts("id", "email_open_count", "title", "city"), schema)


@query("snk_09_report_files", "SELECT n_regionkey, count(*) AS nations, 2 AS copies FROM nation GROUP BY 1")
def report_files(t: Tables) -> DataFrame:
    from pyspark.sql import types as TY

    report = t.nation.groupBy("n_regionkey").agg(F.count("*").alias("nations"))
    path = SK.fresh_folder(t.spark, "report")
    SK.write_reports(report, path)
    schema = TY.StructType([TY.StructField("n_regionkey", TY.IntegerType()), TY.StructField("nations", TY.LongType())])
    both = t.spark.read.schema(schema).option("header", True).csv(f"{path}/csv").unionByName(t.spark.read.schema(schema).json(f"{path}/json"))
    return both.groupBy("n_regionkey", "nations").agg(F.count("*").cast("int").alias("copies"))


@query("snk_10_prediction_export", "SELECT label, level, count(*) AS rows, max(confidence) AS best FROM (SELECT label, CASE label % 3 WHEN 0 THEN 'No Engagement' WHEN 1 THEN 'Opened' ELSE 'Engaged' END AS level, round(greatest(abs(embedding[1]), abs(embedding[2]), abs(embedding[3])) * 100, 2) AS confidence FROM embeddings) GROUP BY 1, 2")
def prediction_export(t: Tables) -> DataFrame:
    parts = [F.abs(F.col("embedding")[i]) for i in range(3)]
    level = F.element_at(F.array(*map(F.lit, ("No Engagement", "Opened", "Engaged"))), F.col("label") % 3 + 1)
    return t.embeddings.select("label", level.alias("level"), F.round(F.greatest(*parts).cast("double") * 100, 2).alias("confidence")).groupBy("label", "level").agg(
        F.count("*").alias("rows"), F.max("confidence").alias("best"))


@query("snk_11_registry", """SELECT p_partkey AS version, p_type AS model_type,
  p_partkey = coalesce(max(CASE WHEN p_partkey % 5 = 0 THEN p_partkey END) OVER k, max(p_partkey) OVER k) AS is_active
  FROM part WINDOW k AS (PARTITION BY p_type)""")
def registry(t: Tables) -> DataFrame:
    rows = t.part.select(F.col("p_partkey").alias("version"), F.col("p_type").alias("model_type"), F.col("p_partkey").alias("created"))
    held = rows.filter("version % 5 <> 0")
    latest = held.groupBy("model_type").agg(F.max("version").alias("latest"))
    held = held.join(latest, "model_type").withColumn("is_active", F.col("version") == F.col("latest")).drop("latest")
    out = SK.register_model(held, rows.filter("version % 5 = 0"))
    return out.select("version", "model_type", "is_active")


# --- monitoring -----------------------------------------------------------------------------
@query("mon_01_system_metrics", on_contacts("""SELECT count(*) AS total_leads, count(*) FILTER (WHERE is_qualified_lead) AS qualified_leads, round(avg(raw_score), 6) AS avg_engagement,
  count(*) FILTER (WHERE created_timestamp >= TIMESTAMP '2024-01-30') AS ingested_today FROM service_silver""", SERVICE_CTE))
def system_metrics(t: Tables) -> DataFrame:
    created = service_leads(t).select("lead_id", "created_date")
    return service_silver(t).join(created, "lead_id").agg(
        F.count("*").alias("total_leads"), F.count_if("is_qualified_lead").alias("qualified_leads"), F.round(F.avg("engagement_score"), 6).alias("avg_engagement"),
        F.count_if(F.col("created_date") >= F.lit(datetime(2024, 1, 30))).alias("ingested_today"))


_METRICS_SQL = """SELECT 20000 - count(*) * 2 AS remaining_credits, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0 END), 6) AS quality_score,
  round(avg(CASE WHEN event_type = 'view' THEN 1.0 ELSE 0 END), 6) AS f1_score, round((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 3.6e9, 6) AS hours_since_update FROM events"""


def _metrics(t: Tables) -> DataFrame:
    return t.events.agg((F.lit(20000) - F.count("*") * 2).alias("remaining_credits"), F.round(F.avg(flag(F.col("value") > 50)), 6).alias("quality_score"),
                        F.round(F.avg(flag(F.col("event_type") == "view")), 6).alias("f1_score"),
                        F.round(M.hours_since(F.max("ts"), datetime(2024, 2, 1)), 6).alias("hours_since_update"))


def _alert_sql(category, metric, warning, critical, side) -> str:
    op = "<" if side == "below" else ">"
    return (f"SELECT '{category}' AS category, CASE WHEN {metric} {op} {critical} THEN 'critical' ELSE 'warning' END AS type, CAST({metric} AS DOUBLE) AS value "
            f"FROM metrics WHERE {metric} {op} {warning}")


@query("mon_02_alerts", f"WITH metrics AS ({_METRICS_SQL}) " + " UNION ALL ".join(_alert_sql(*a) for a in K.ALERT_THRESHOLDS))
def alerts(t: Tables) -> DataFrame:
    return M.alerts(_metrics(t))


@query("mon_03_cool_down", """WITH RECURSIVE fired AS (SELECT DISTINCT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events WHERE event_type = 'error'),
  sent AS (SELECT user_id, min(s) AS s FROM fired GROUP BY user_id UNION ALL
    SELECT q.user_id, q.n FROM (SELECT p.user_id, min(f.s) AS n FROM sent p JOIN fired f ON f.user_id = p.user_id AND f.s - p.s > 86400 GROUP BY p.user_id, p.s) q)
  SELECT user_id, strftime(make_timestamp(s * 1000000), '%Y-%m-%d %H:%M:%S') AS ts FROM sent""")
def cool_down(t: Tables) -> DataFrame:
    fired = t.events.filter("event_type = 'error'").select("user_id", "ts")
    return M.cool_down(fired, ["user_id"], "ts", 86400).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query("mon_04_credit_budget", on_contacts("""SELECT id FROM contacts WHERE enrichment_id IS NULL ORDER BY timestamp_created DESC NULLS LAST, id
  LIMIT (SELECT greatest(0, 1800 - count(*)) FROM contacts WHERE enrichment_id IS NOT NULL AND date_trunc('month', enriched_at) = TIMESTAMP '2024-02-01')"""))
def credit_budget(t: Tables) -> DataFrame:
    """Waiting contacts that the rest of a month's limit of 1,800 pays for; the usage log has a credit per enriched contact."""
    df = t.contacts("id", "enrichment_id", "timestamp_created", "enriched_at")
    usage = df.filter("enrichment_id IS NOT NULL").select("enriched_at", F.lit(1).alias("credits"))
    budget = M.remaining_credits(usage, "enriched_at", "credits", datetime(2024, 2, 15), 1800)
    return M.within_budget(df.filter("enrichment_id IS NULL"), [F.desc_nulls_last("timestamp_created"), F.col("id")], budget).select("id")


@query("mon_05_retraining", "SELECT round((epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(ts))) / 8.64e10, 6) AS days_since, (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(ts))) / 8.64e10 >= 7 AS due FROM events WHERE event_type = 'signup'")
def retraining(t: Tables) -> DataFrame:
    return rounded(M.retraining_due(t.events.filter("event_type = 'signup'").select("ts"), "ts", K.AS_OF)).drop("last_training")


@query("mon_06_enrichment_outcomes", on_contacts("SELECT enrichment_status, count(*) AS rows, round(count(*) * 100.0 / (SELECT count(*) FROM contacts), 6) AS rate_pct FROM contacts GROUP BY 1"))
def enrichment_outcomes(t: Tables) -> DataFrame:
    return rounded(M.status_rates(t.contacts("enrichment_status"), "enrichment_status"))


@query("mon_07_run_metrics", "SELECT 'orders' AS step, count(*) AS record_count, 'success' AS status FROM orders")
def run_metrics(t: Tables) -> DataFrame:
    path = SK.fresh_folder(t.spark, "runs")
    SK.append(t.orders.agg(F.lit("orders").alias("step"), F.count("*").alias("record_count"), F.lit("success").alias("status")), path)
    return t.spark.read.parquet(path)


@query("mon_08_stability", """WITH b AS (SELECT floor(value / 20) AS k, ts < TIMESTAMP '2024-01-16' AS early FROM events),
  p AS (SELECT k, count(*) FILTER (WHERE early) / CAST((SELECT count(*) FROM b WHERE early) AS DOUBLE) AS p, count(*) FILTER (WHERE NOT early) / CAST((SELECT count(*) FROM b WHERE NOT early) AS DOUBLE) AS q FROM b GROUP BY k)
  SELECT round(psi, 6) AS psi, psi > 0.1 AS drifted FROM (SELECT sum((q2 - p2) * ln(q2 / p2)) AS psi FROM (SELECT CASE WHEN p = 0 THEN 0.0001 ELSE p END AS p2, CASE WHEN q = 0 THEN 0.0001 ELSE q END AS q2 FROM p))""")
def stability(t: Tables) -> DataFrame:
    events = t.events.select("ts", F.floor(F.col("value") / 20).alias("bucket"))
    split = F.lit(datetime(2024, 1, 16))
    return rounded(M.stability_index(events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split), "bucket"))


@query("mon_08_performance_drop", "SELECT arg_max(m, month) AS latest, max(m) AS best, max(m) - arg_max(m, month) > 0.05 AS degraded FROM (SELECT strftime(o_orderdate, '%Y-%m') AS month, round_even(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END), 6) AS m FROM orders GROUP BY 1)")
def performance_drop(t: Tables) -> DataFrame:
    history = t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(half_even(F.avg(flag(F.col("o_orderstatus") == "F")), 6).alias("m"))
    return M.performance_drop(history, "m", "month")


@query("dq_11_overall_quality", on_contacts("""SELECT round(email_pct, 6) AS email_completeness, round(company_pct, 6) AS company_name_completeness, round(hours, 6) AS hours_since_update, records_24h, round(cov, 6) AS enrichment_coverage,
  round((email_pct + company_pct) / 200 * 0.4 + least(1, 24 / greatest(1, hours)) * 0.3 + cov * 0.3, 6) AS quality_score FROM (SELECT
  count(*) FILTER (WHERE w AND coalesce(email, '') <> '') * 100.0 / count(*) FILTER (WHERE w) AS email_pct, count(*) FILTER (WHERE w AND coalesce(company_name, '') <> '') * 100.0 / count(*) FILTER (WHERE w) AS company_pct,
  (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(timestamp_created))) / 3.6e9 AS hours, count(*) FILTER (WHERE timestamp_created >= TIMESTAMP '2024-01-30') AS records_24h,
  count(DISTINCT id) FILTER (WHERE m AND enrichment_id IS NOT NULL) / CAST(count(DISTINCT id) FILTER (WHERE m) AS DOUBLE) AS cov
  FROM (SELECT *, timestamp_created >= TIMESTAMP '2024-01-24' AS w, timestamp_created >= TIMESTAMP '2024-01-01' AS m FROM contacts))"""))
def overall_quality(t: Tables) -> DataFrame:
    leads = t.contacts("id", "email", "company_name", "timestamp_created")
    enriched = t.contacts("id", "enrichment_id").filter("enrichment_id IS NOT NULL")
    return rounded(M.overall_quality(leads, enriched, "id", "timestamp_created", ["email", "company_name"], LATE))


@query("dq_12_freshness", "SELECT round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3.6e9, 6) AS hours_since_update, (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3.6e9 > 24 AS is_stale FROM events")
def freshness(t: Tables) -> DataFrame:
    return rounded(M.freshness(t.events.select("ts"), "ts", LATE)).drop("latest")


@query("dq_13_agg_51_quality_check", """SELECT round(avg(q), 6) AS avg_quality, count(*) AS total_records, count(*) FILTER (WHERE q < 0.5) AS low_quality_records,
  round(count(*) FILTER (WHERE q < 0.5) / CAST(count(*) AS DOUBLE), 6) AS low_quality_rate, avg(q) >= 0.9 AND count(*) FILTER (WHERE q < 0.5) / CAST(count(*) AS DOUBLE) <= 0.1 AS passed
  FROM (SELECT coalesce(quality, 0.7) AS q FROM labels)""")
def quality_check(t: Tables) -> DataFrame:
    return rounded(M.quality_check(t.labels.select(F.coalesce(F.col("quality").cast("double"), F.lit(0.7)).alias("q")), "q"))


@query("agg_52_credit_usage", "SELECT CAST(sum(user_id % 5) AS BIGINT) AS used, count(*) AS calls, CAST(20000 - sum(user_id % 5) AS BIGINT) AS remaining, round(sum(user_id % 5) * 100.0 / 20000, 6) AS used_pct, CAST(greatest(20000 - sum(user_id % 5) - 2000, 0) AS BIGINT) AS available FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts <= TIMESTAMP '2024-01-31' AND event_type = 'signup'")
def credit_usage(t: Tables) -> DataFrame:
    log = t.events.select("ts", "event_type", (F.col("user_id") % 5).alias("credits"))
    return rounded(M.credit_usage(log, "ts", "credits", LATE, F.col("event_type") == "signup"))


@query("agg_53_prediction_statistics", "SELECT count(*) AS predictions, round(avg(value), 6) AS avg_score, count(*) FILTER (WHERE value > 70) AS high_scores FROM events WHERE ts >= TIMESTAMP '2024-01-24'")
def prediction_statistics(t: Tables) -> DataFrame:
    week = t.events.filter(F.col("ts") >= F.lit(LATE) - F.expr("INTERVAL 7 DAYS"))
    return week.agg(F.count("*").alias("predictions"), F.round(F.avg("value"), 6).alias("avg_score"), F.count_if(F.col("value") > 70).alias("high_scores"))


@query("agg_58_backlog", on_contacts("""SELECT count(*) AS total, count(timestamp_created) AS processable, strftime(min(timestamp_created), '%Y-%m-%d') AS earliest, strftime(max(timestamp_created), '%Y-%m-%d') AS latest,
  (SELECT count(*) FROM contacts WHERE contact_key % 3 = 0) AS in_silver, count(timestamp_created) - (SELECT count(*) FROM contacts WHERE contact_key % 3 = 0) AS remaining FROM contacts"""))
def backlog(t: Tables) -> DataFrame:
    row = M.backlog(t.contacts("id", "timestamp_created"), t.contacts("id", "contact_key").filter("contact_key % 3 = 0"))
    return row.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in ("earliest", "latest")})
