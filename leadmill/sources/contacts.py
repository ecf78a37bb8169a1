"""The bronze contact table, derived from customers and their events.

Grain: one row per (customer, active day); a customer without events keeps one
row whose engagement columns are null.  Only the day aggregation shuffles; all
descriptive columns are row-local expressions, so a query that selects three of
them reads and computes just those three.

The descriptive expressions use the SQL subset that Spark and ANSI engines
share, and are kept as text so that a checker can build the same input table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(expr: str, values: list) -> str:
    """SQL that cycles through ``values`` by ``expr`` modulo their count."""
    words = "|".join("~" if v is None else str(v) for v in values).replace("'", "''")
    part = f"split_part('{words}', '|', CAST(({expr}) % {len(values)} AS INT) + 1)"
    if None in values:
        part = f"NULLIF({part}, '~')"
    return part if any(isinstance(v, str) for v in values) else f"CAST({part} AS INT)"


_INDUSTRIES = [
    "information technology & services", "financial services", "hospital & health care", "machinery", "retail",
    "management consulting", "higher education", "marketing & advertising", "construction", "oil & energy",
    "government administration", "telecommunications", "mining & metals", "logistics & supply chain",
    "computer & network security", "staffing & recruiting", "research", "human resources", "law practice",
    "automotive", "accounting", "hospitality", None, "Technology", "Sales Software", "wine and spirits", "other",
]
_TITLES = [
    "CEO", "Chief Technology Officer", "VP Engineering", "Director of Operations", "Head of Marketing",
    "Product Manager", "Senior Software Engineer", "Data Analyst", "Sales Manager", "Consultant", "HR Director",
    "Founder & Owner", "Junior Associate", "Marketing Specialist", None, "Librarian", "Partner", "CFO",
    "Head of Product", "Team Lead", "Business Development Representative", "Owner",
]
_SENIORITIES = ["c_suite", "vp", "director", "manager", "senior", "entry", "owner", "partner", None, "head",
                "C-level", "Director"]
_ORG_INDUSTRIES_JSON = [
    '{"industries": ["computer software", "internet"], "industry": "computer software"}',
    '{"industry": "venture capital & private equity"}', "{}", '{"industry": "wellness"}', '{"name": "x"', None,
]
_DOMAINS = ["acme.io", "first-bank.com", "carehealth.net", "learnwell.edu", "city.gov", "dailynews.tv",
            "megashop.com", "plain.example", None, "hilltop.de"]
_COUNTRIES_EXTRA = ["United States", "Canada", "United Kingdom", None]
_ESP_CODES = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 999, 1000, 40, 300, 700]

_K = "c_custkey"
# every day of one customer falls into its own variant so that days differ
_KD = "(c_custkey + day_number)"

_EMPLOYMENT_JSON = f"""CASE
  WHEN {_K} % 11 = 0 THEN NULL
  WHEN {_K} % 11 = 1 THEN '[]'
  WHEN {_K} % 11 = 2 THEN '{{"title": "not a list"}}'
  WHEN {_K} % 11 = 3 THEN '[{{"title": "broken'
  WHEN {_K} % 11 = 4 THEN '[{{"title": "Engineer", "organization_name": "Org' || CAST({_K} % 9 AS STRING)
       || '", "start_date": "' || CAST(1990 + {_K} % 30 AS STRING) || '-02-01", "end_date": null, "current": true}}]'
  ELSE '[{{"title": "' || {_pick(_K, ["Director of Sales", "Analyst", "VP Finance", "Clerk", "Head of Data"])}
       || '", "organization_name": "Org' || CAST({_K} % 9 AS STRING) || '", "start_date": "'
       || CAST(2005 + {_K} % 15 AS STRING) || '-03-01", "end_date": "' || {_pick(_K, ["Present", "2022-01-01", "current", ""])}
       || '", "current": ' || {_pick(_K, ["true", "false", "false"])} || '}}, {{"title": "' || {_pick(_K, ["Clerk", "manager", "Tester"])}
       || '", "organization_name": "Org' || CAST({_K} % 4 AS STRING) || '", "start_date": "'
       || CAST(1995 + {_K} % 10 AS STRING) || '", "end_date": "' || CAST(2004 + {_K} % 12 AS STRING)
       || '-12-31", "current": false, "kind": "' || {_pick(_K, ["Education", "job"])} || '", "degree": "'
       || {_pick(_K, ["PhD Physics", "Master of Arts", "MBA", "Bachelor", "Associate degree", "none", "Doctorate"])} || '"}}]'
END"""

_ORGANIZATION_JSON = f"""CASE
  WHEN {_K} % 13 = 0 THEN NULL
  WHEN {_K} % 13 = 1 THEN '{{}}'
  WHEN {_K} % 13 = 2 THEN '{{"name": '
  ELSE '{{"name": "Company ' || CAST({_K} % 200 AS STRING) || '", "estimated_num_employees": '
       || CAST(({_K} * 37) % 3000 AS STRING) || ', "founded_year": ' || CAST(1950 + {_K} % 75 AS STRING)
       || ', "industry": "' || {_pick(_K, ["computer software", "wellness", "mining", "tourism"])} || '"'
       || {_pick(_K, [', "industries": ["banking", "insurance"]', ', "industries": ["internet"]', ""])}
       || ', "keywords": [' || {_pick(_K, ['"saas", "cloud tools"', '"big data"', "", '"retail", "food", "ai chips", "tech"'])} || ']'
       || {_pick(_K, [', "publicly_traded_symbol": "ABC"', "", ', "publicly_traded_symbol": ""', ""])}
       || {_pick(_K, [', "alexa_ranking": 500', ', "alexa_ranking": 9000', ', "alexa_ranking": 90000', ', "alexa_ranking": 900000', ""])}
       || {_pick(_K, [', "twitter_url": "http://t/x", "linkedin_url": "http://l/x"', ', "facebook_url": "http://f/x"', ""])}
       || {_pick(_K, [', "organization_headcount_six_month_growth": 0.25', ', "organization_headcount_twelve_month_growth": -0.5', ', "organization_headcount_twenty_four_month_growth": 1.75', ""])}
       || {_pick(_K, [', "market_cap": "2.5B"', ', "market_cap": "300 million"', ', "market_cap": "9000"', ""])} || '}}'
END"""

_ACCOUNT_JSON = f"""CASE
  WHEN {_K} % 7 = 0 THEN NULL
  ELSE '{{"created_at": "20' || CAST(15 + {_K} % 9 AS STRING) || '-0' || CAST(1 + {_K} % 9 AS STRING)
       || '-15T12:00:00Z", "crm_record_url": ' || {_pick(_K, ['"http://crm/1"', "null", '""'])}
       || ', "label_ids": [' || {_pick(_K, ['"a", "b"', '"a"', ""])} || ']'
       || {_pick(_K, [', "account_stage_id": "s1"', ""])}
       || ', "phone_status": "' || {_pick(_K, ["verified", "likely", "possible", "no_status"])}
       || '", "existence_level": "' || {_pick(_K, ["possible", "verified", "none", "likely", "x"])} || '"}}'
END"""

_API_JSON = f"""CASE
  WHEN {_K} % 9 = 0 THEN NULL
  ELSE '{{"extrapolated_email_confidence": ' || {_pick(_K, ["0.5", "0.75", "null", "1.0"])}
       || ', "intent_strength": "' || {_pick(_K, ["High", "medium", "low", "none", ""])}
       || '", "functions": [' || {_pick(_K, ['"sales"', '"it", "ops"', ""])}
       || '], "departments": [' || {_pick(_K, ['"c_suite", "master_sales"', ""])}
       || '], "seniority": "' || {_pick(_K, ["senior", "director", "svp", "c_level", "entry", "Manager", "owner"])}
       || '", "title": "' || {_pick(_K, ["Lead Engineer", "Clerk", "VP Sales", "Headhunter", "Nurse"])}
       || '", "personal_emails": [' || {_pick(_K, ['"a@b.example"', ""])}
       || '], "revealed_for_current_team": ' || {_pick(_K, ["true", "false"])} || '}}'
END"""

#: column name -> portable SQL over the joined base row
CONTACT_COLUMNS: dict[str, str] = {
    "id": f"CAST({_K} AS STRING) || '-' || CAST(day_number AS STRING)",
    "contact_key": _K,
    "email": f"CASE WHEN {_K} % 29 = 0 THEN NULL ELSE 'user' || CAST({_K} AS STRING) || '@mail' || CAST({_K} % 8 AS STRING) || '.example' END",
    "first_name": f"CASE WHEN {_K} % 11 = 0 THEN NULL ELSE 'First' || CAST({_K} % 50 AS STRING) END",
    "last_name": f"'Last' || CAST({_K} % 70 AS STRING)",
    "company_name": f"CASE WHEN {_K} % 6 = 0 THEN NULL ELSE 'Company-' || CAST({_K} % 200 AS STRING) || {_pick(_K, [' Inc', ' LLC', ' Corp', ''])} END",
    "phone": f"'555-' || CAST({_K} AS STRING)",
    "website": f"'http://site' || CAST({_K} % 200 AS STRING) || '.example'",
    "company_domain": _pick(_K, _DOMAINS),
    "linkedin_url": _pick(_K, ["https://www.linkedin.com/in/some-body-1?trk=x", "http://linkedin.com/in/abc/", "N/A", None,
                               "https://linkedin.com/company/abc", "https://www.linkedin.com/in/with_underscore"]),
    "organization": f"'org-' || CAST({_K} % 40 AS STRING)",
    "campaign": "c_mktsegment",
    "list_id": f"'list-' || CAST({_K} % 60 AS STRING)",
    "assigned_to": _pick(_K, ["ann", "bo", None]),
    "uploaded_by_user": _pick(_K, ["u1", "u2", "u3"]),
    "status": _pick(_K, [-3, -1, 0, 1, 3]),
    "campaign_status": f"({_K} + day_number) % 4",
    "upload_method": f"CASE WHEN {_KD} % 3 = 0 THEN 'api' ELSE 'manual' END",
    "verification_status": _pick(_K, ["verified", "risky", None]),
    "enrichment_status": _pick(_K, ["completed", "pending", "failed", "completed"]),
    "api_status": f"CASE WHEN {_K} % 4 <> 0 THEN 'success' ELSE 'error' END",
    "status_summary": _pick(_K, ["finance review!", "follow-up in 3 days", None, "OK", "http://crm.example/7"]),
    "personalization": f"'Hi ' || c_name || ', call 555-123-4567?'",
    "payload": f"'{{\"k\": ' || CAST({_K} % 100 AS STRING) || ', \"note\": \"' || c_mktsegment || '\"}}'",
    "enrichment_id": f"CASE WHEN {_K} % 4 <> 0 THEN 'p' || CAST({_K} AS STRING) END",
    "enrichment_name": "c_name",
    "headline": _pick(_K, ["Building THE future", "Growth @ scale!", None, "ex-Banker & investor"]),
    "title": _pick(_K, _TITLES),
    "seniority": _pick(_K, _SENIORITIES),
    "departments_text": _pick(_K, ["engineering,data", "sales", None, "human_resources", "marketing,digital"]),
    "functions_text": _pick(_K, ["engineering", None, "sales,support"]),
    "city": f"'City ' || CAST({_K} % 90 AS STRING)",
    "state": f"'State ' || CAST({_K} % 35 AS STRING)",
    "country": f"CASE WHEN {_K} % 10 < 4 THEN {_pick(_K, _COUNTRIES_EXTRA)} ELSE n_name END",
    "region": "r_name",
    "organization_name": f"CASE WHEN {_K} % 9 = 0 THEN NULL ELSE 'Company ' || CAST({_K} % 200 AS STRING) END",
    "organization_industry": _pick(_K, _INDUSTRIES),
    "organization_employees": f"CASE WHEN {_K} % 23 = 0 THEN NULL ELSE CAST(FLOOR(ABS(c_acctbal)) AS BIGINT) % CAST({_pick(_K, [10000, 12, 60, 250, 1200])} AS BIGINT) END",
    "organization_founded_year": f"CASE WHEN {_K} % 17 = 0 THEN NULL ELSE 1950 + {_K} % 75 END",
    "credits_consumed": f"{_K} % 5",
    "company_revenue": _pick(_K, ["$5 million", "50 Million USD", "250 million", "0 million", "unknown", None, "2 billion"]),
    "company_size_text": _pick(_K, ["Startup", "11-50 people", "medium", "251-1000", "1000+", None, "n/a"]),
    "technologies": _pick(_K, ['["spark", "sql"]', "[]", '{"crm": "x"}', None, "{}"]),
    "social_profiles": _pick(_K, ['{"twitter": "t", "linkedin": "l", "facebook": "", "xing": "x"}', '{"twitter": "t"}', "{}", None,
                                  '{"a": "1", "b": "2", "c": "3", "d": "4"}']),
    "email_list": f"CASE WHEN {_K} % 31 = 0 THEN NULL ELSE 'list ' || CAST({_K} % 60 AS STRING) || ': ' || "
                  + " || ".join(f"CASE WHEN {_K} % 60 % 14 >= {i} THEN 'a{i}@dom' || CAST(({_K} % 60 * {i} + {i}) % 5 AS STRING) || '.example;' ELSE '' END" for i in range(14))
                  + " END",
    "daily_limit": f"CASE WHEN {_K} % 19 = 0 THEN NULL ELSE {_K} % 15 * 50 + 50 END",
    "email_gap": f"{_K} % 7 + 5",
    "link_tracking": f"{_K} % 2 = 0",
    "open_tracking": f"{_K} % 3 = 0",
    "esp_code": _pick(_K, _ESP_CODES),
    "page_retrieved": f"{_K} % 130 + 1",
    "email_open_count": "opens",
    "email_click_count": "clicks",
    "email_reply_count": "replies",
    "email_bounce_count": "bounces",
    "email_clicked_step": f"CASE WHEN clicks > 0 THEN {_K} % 4 + 1 END",
    "email_clicked_variant": f"CASE WHEN clicks > 0 THEN {_K} % 3 END",
    "email_opened_step": f"CASE WHEN opens > 0 THEN {_KD} % 4 + 1 END",
    "timestamp_created": "first_ts",
    "timestamp_updated": f"last_ts + ({_K} % 3) * INTERVAL '1' DAY",
    "timestamp_last_contact": "last_ts",
    "timestamp_last_touch": f"CASE WHEN {_K} % 5 <> 0 THEN last_ts END",
    "timestamp_last_open": "last_open_ts",
    "timestamp_last_click": "last_click_ts",
    "timestamp_last_reply": "last_reply_ts",
    "timestamp_last_interest_change": f"CASE WHEN {_K} % 7 = 0 THEN last_ts + INTERVAL '1' HOUR END",
    "retrieval_timestamp": f"first_ts - ({_K} % 10) * INTERVAL '1' DAY",
    "inserted_at": "first_ts + INTERVAL '1' HOUR",
    "enriched_at": f"CASE WHEN {_K} % 4 <> 0 THEN first_ts - ({_K} % 200) * INTERVAL '1' DAY - INTERVAL '5' HOUR END",
    "employment_history": _EMPLOYMENT_JSON,
    "organization_data": _ORGANIZATION_JSON,
    "industry_json": _pick(_K, _ORG_INDUSTRIES_JSON),
    "account_data": _ACCOUNT_JSON,
    "api_response_raw": _API_JSON,
}

#: list columns, split from their text form
ARRAY_COLUMNS: dict[str, str] = {
    name: f"split({CONTACT_COLUMNS[name + '_text']}, ',')" for name in ("departments", "functions")
}


def contact_days(events: DataFrame) -> DataFrame:
    """Engagement counts per (user, day): opens, clicks, replies, bounces and time marks."""
    def n(kind: str):
        return F.count_if(F.col("event_type") == kind)

    def last(kind: str):
        return F.max(F.when(F.col("event_type") == kind, F.col("ts")))

    return events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        n("view").alias("opens"), n("click").alias("clicks"), n("purchase").alias("replies"),
        n("error").alias("bounces"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        last("view").alias("last_open_ts"), last("click").alias("last_click_ts"),
        last("purchase").alias("last_reply_ts"))


def contacts(customer: DataFrame, nation: DataFrame, region: DataFrame, events: DataFrame,
             columns: Sequence[str] = ()) -> DataFrame:
    """Customers with their contact days and place; all contact columns, or just ``columns``.

    Naming the columns keeps the plan small; which columns are read is the same
    either way.
    """
    base = (customer
            .join(contact_days(events), F.col("c_custkey") == F.col("user_id"), "left")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .withColumn("day_number", F.coalesce(F.unix_date("day"), F.lit(0)).cast("bigint")))
    wanted = list(dict.fromkeys(columns)) or [*CONTACT_COLUMNS, *ARRAY_COLUMNS]
    return base.selectExpr(*[f"{ARRAY_COLUMNS.get(c) or CONTACT_COLUMNS[c]} AS {c}" for c in wanted])


def sql_cte() -> str:
    """The same tables as common table expressions for an ANSI engine."""
    columns = ",\n  ".join(f"{sql} AS {name}" for name, sql in CONTACT_COLUMNS.items())
    return f"""contact_days AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
    count(*) FILTER (WHERE event_type = 'view') AS opens,
    count(*) FILTER (WHERE event_type = 'click') AS clicks,
    count(*) FILTER (WHERE event_type = 'purchase') AS replies,
    count(*) FILTER (WHERE event_type = 'error') AS bounces,
    min(ts) AS first_ts, max(ts) AS last_ts,
    max(ts) FILTER (WHERE event_type = 'view') AS last_open_ts,
    max(ts) FILTER (WHERE event_type = 'click') AS last_click_ts,
    max(ts) FILTER (WHERE event_type = 'purchase') AS last_reply_ts
  FROM events GROUP BY ALL),
contact_base AS (
  SELECT c.*, d.*, n_name, r_name, CAST(coalesce(d.day - DATE '1970-01-01', 0) AS BIGINT) AS day_number
  FROM customer c LEFT JOIN contact_days d ON c.c_custkey = d.user_id
  JOIN nation ON c.c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
contacts AS (SELECT
  {columns}
  FROM contact_base)"""
