"""Reports that exercise the text, category, date, number and document functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import categories as C
from leadmill.functions import dates as D
from leadmill.functions import json_features as J
from leadmill.functions import scores as S
from leadmill.functions import text as T
from leadmill.functions.expr import cut, flag, half_even, lookup, number
from leadmill.operators import encode as E
from leadmill.operators import features as FE
from leadmill.plans.quality import rounded
from leadmill.plans.registry import (AS_OF_SQL, INDUSTRY_SQL, SEGMENTS_CTE, TITLE_SQL, on_contacts, on_segments,
                                     query, quoted, sql_cut, sql_days, sql_fallback, sql_ladder, sql_map, sql_rules)
from leadmill.plans.segments import AGE_SQL, ERA_SQL, ESP_SQL, LIST_SIZE_SQL
from leadmill.sources.tables import Tables

YEAR = K.AS_OF.year


def report(name: str, table: str, key: list[str], features: dict[str, str], where: str = ""):
    """Register a row-level report with its SQL: ``features`` maps names to SQL expressions."""
    body = f"SELECT {', '.join(key)}, " + ",\n  ".join(f"{sql} AS {n}" for n, sql in features.items()) + f" FROM {table} {where}"
    return query(name, on_contacts(body) if table == "contacts" else body)


# --- text ---------------------------------------------------------------------------
def _clean_sql(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g'))"


def _words_sql(c: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({c}, '\\s+'), lambda w: w <> '')) AS BIGINT)"


def _count_sql(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, '{pattern}'))"


@report("str_01_clean_text", "documents", ["doc_id"], {
    "digest": f"md5({_clean_sql('text')})", "clean_length": f"length({_clean_sql('text')})"})
def clean_text(t: Tables) -> DataFrame:
    clean = T.clean_text(F.col("text"))
    return t.documents.select("doc_id", F.md5(clean).alias("digest"), F.length(clean).alias("clean_length"))


@report("str_02_combined_text", "contacts", ["id"], {
    "combined": "concat_ws(' ', campaign, status_summary, headline, title, seniority)"})
def combined_text(t: Tables) -> DataFrame:
    columns = ["campaign", "status_summary", "headline", "title", "seniority"]
    return t.contacts("id", *columns).select("id", T.combine(columns).alias("combined"))


_SHAPE_SQL = {
    "text_length": "length(text)", "text_word_count": _words_sql("text"), "text_char_count": "length(text)",
    "text_avg_word_length": f"round(length(text) / CAST(greatest({_words_sql('text')}, 1) AS DOUBLE), 6)",
    "text_uppercase_ratio": f"round({_count_sql('text', '[A-Z]')} / CAST(greatest(length(text), 1) AS DOUBLE), 6)",
    "text_digit_ratio": f"round({_count_sql('text', '[0-9]')} / CAST(greatest(length(text), 1) AS DOUBLE), 6)",
    "text_punctuation_ratio": f"round({_count_sql('text', '[^\\p{L}\\p{N}_\\s]')} / CAST(greatest(length(text), 1) AS DOUBLE), 6)",
}


@report("str_03_04_text_shape", "documents", ["doc_id"], _SHAPE_SQL)
def text_shape(t: Tables) -> DataFrame:
    return rounded(t.documents.select("doc_id", *[c.alias(n) for n, c in T.shape_features(F.col("text")).items()]))


@report("str_03_conversation_shape", "conversations", ["conv_id", "turn"], _SHAPE_SQL)
def conversation_shape(t: Tables) -> DataFrame:
    shape = T.shape_features(F.col("text"))
    return rounded(t.conversations.select("conv_id", "turn", *[c.alias(n) for n, c in shape.items()]))


def _flag_sql(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


@report("str_05_06_content_flags", "documents", ["doc_id"], {
    "has_numbers_in_text": _flag_sql("regexp_matches(text, '[0-9]')"), "has_email_in_text": _flag_sql("contains(text, '@')"),
    "has_url_in_text": _flag_sql("contains(text, 'http')"), "has_phone": _flag_sql(f"regexp_matches(text, '{K.PHONE_PATTERN}')"),
    "has_url": _flag_sql(f"regexp_matches(text, '{K.URL_PATTERN}')"), "exclamation_count": _count_sql("text", "!"),
    "question_count": _count_sql("text", "[?]"), "caps_ratio": f"round({_count_sql('text', '[A-Z]')} / (length(text) + 1.0), 6)"})
def content_flags(t: Tables) -> DataFrame:
    text = F.col("text")
    return rounded(t.documents.select("doc_id", *[c.alias(n) for n, c in {**T.content_flags(text), **T.marketing_flags(text)}.items()]))


@report("str_07_quality_score", "documents", ["doc_id"], {
    "score": f"{_flag_sql('length(text) > 10')} + {_flag_sql(_words_sql('text') + ' > 3')} + {_flag_sql('lang IS NOT NULL')}",
    "legacy_score": f"{_flag_sql('length(text) > 10')} + {_flag_sql(_words_sql('text') + ' > 3')} + {_flag_sql(chr(78) + 'OT contains(text, ' + quoted('nan') + ')')}"})
def quality_score(t: Tables) -> DataFrame:
    text = F.col("text")
    return t.documents.select("doc_id", T.quality_score(text, F.col("lang").isNull()).alias("score"),
                              T.quality_score(text, legacy=True).alias("legacy_score"))


_FOUND = f"regexp_extract_all(coalesce(email_list, ''), '{K.EMAIL_PATTERN}')"
_DOMAINS = f"len(list_distinct(list_transform({_FOUND}, lambda a: split_part(a, '@', 2))))"


@report("str_08_address_lists", "contacts", ["id"], {
    "email_count": f"len({_FOUND})", "unique_domains": _DOMAINS,
    "list_diversity": f"round({_DOMAINS} / CAST(greatest(len({_FOUND}), 1) AS DOUBLE), 6)",
    "list_length": "coalesce(length(email_list), 0)"})
def address_lists(t: Tables) -> DataFrame:
    parts = T.address_list_features(F.col("email_list"))
    return rounded(t.contacts("id", "email_list").select("id", *[c.alias(n) for n, c in parts.items()]))


@report("str_08_document_addresses", "documents", ["doc_id"], {
    "email_count": f"len(regexp_extract_all(text, '{K.EMAIL_PATTERN}'))",
    "unique_domains": f"len(list_distinct(list_transform(regexp_extract_all(text, '{K.EMAIL_PATTERN}'), lambda a: split_part(a, '@', 2))))"})
def document_addresses(t: Tables) -> DataFrame:
    parts = T.address_list_features(F.col("text"))
    return t.documents.select("doc_id", parts["email_count"].alias("email_count"), parts["unique_domains"].alias("unique_domains"))


_PROFILE_SQL = f"CASE WHEN regexp_matches(split_part(linkedin_url, '?', 1), '{K.PROFILE_URL_PATTERN}') THEN split_part(linkedin_url, '?', 1) END"


@report("str_09_profile_urls", "contacts", ["id"], {"profile_url": _PROFILE_SQL})
def profile_urls(t: Tables) -> DataFrame:
    return t.contacts("id", "linkedin_url").select("id", T.clean_profile_url(F.col("linkedin_url")).alias("profile_url"))


@query("str_09_profile_url_summary", on_contacts(f"SELECT count(*) AS rows, count(linkedin_url) AS given, count({_PROFILE_SQL}) AS valid FROM contacts"))
def profile_url_summary(t: Tables) -> DataFrame:
    return t.contacts("linkedin_url").agg(F.count("*").alias("rows"), F.count("linkedin_url").alias("given"),
                                          F.count(T.clean_profile_url(F.col("linkedin_url"))).alias("valid"))


@report("str_10_domain_guess", "contacts", ["id"], {
    "domain": "replace(replace(replace(replace(replace(trim(lower(company_name)), ' inc', ''), ' llc', ''), ' corp', ''), ' ', ''), '-', '') || '.com'"})
def domain_guess(t: Tables) -> DataFrame:
    return t.contacts("id", "company_name").select("id", T.domain_guess(F.col("company_name")).alias("domain"))


@report("str_11_interactions", "contacts", ["id"], {
    n: f"coalesce(CAST({a} AS VARCHAR), 'Unknown') || '_' || coalesce(CAST({b} AS VARCHAR), 'Unknown')"
    for n, (a, b) in FE.INTERACTIONS.items()})
def interactions(t: Tables) -> DataFrame:
    needed = {c for pair in FE.INTERACTIONS.values() for c in pair}
    return FE.interaction_features(t.contacts("id", *sorted(needed))).select("id", *FE.INTERACTIONS)


def _any_sql(c: str, words: list[str]) -> str:
    return _flag_sql(" OR ".join(f"contains({c}, {quoted(w)})" for w in words))


@report("str_12_13_keyword_flags", "contacts", ["id"], {
    "is_high_value_title": _any_sql("lower(title)", K.HIGH_VALUE_TITLES),
    "is_high_value_seniority": _any_sql("lower(seniority)", K.HIGH_VALUE_SENIORITY),
    "is_tech_department": _any_sql("lower(departments_text)", K.TECH_DEPARTMENTS),
    "is_tech_leadership": f"({_any_sql('organization_industry', K.TECH_INDUSTRIES)}) * ({_any_sql('title', K.TECH_LEADERSHIP_TITLES)})",
    "is_tech_executive": f"({_any_sql('organization_industry', K.TECH_INDUSTRIES)}) * ({_any_sql('seniority', K.TECH_EXECUTIVE_SENIORITY)})",
    "is_sales_professional": f"({_any_sql('organization_industry', K.SALES_INDUSTRIES)}) * ({_any_sql('seniority', K.SALES_SENIORITY)})"})
def keyword_flags(t: Tables) -> DataFrame:
    from leadmill.functions.expr import any_of

    df = t.contacts("id", "title", "seniority", "departments", "organization_industry")
    industry, title, seniority = F.col("organization_industry"), F.col("title"), F.col("seniority")
    tech = any_of(industry, K.TECH_INDUSTRIES)
    return df.select(
        "id", T.keyword_flag(title, K.HIGH_VALUE_TITLES).alias("is_high_value_title"),
        T.keyword_flag(seniority, K.HIGH_VALUE_SENIORITY).alias("is_high_value_seniority"),
        T.keyword_flag(F.concat_ws(",", "departments"), K.TECH_DEPARTMENTS).alias("is_tech_department"),
        flag(tech & any_of(title, K.TECH_LEADERSHIP_TITLES)).alias("is_tech_leadership"),
        flag(tech & any_of(seniority, K.TECH_EXECUTIVE_SENIORITY)).alias("is_tech_executive"),
        flag(any_of(industry, K.SALES_INDUSTRIES) & any_of(seniority, K.SALES_SENIORITY)).alias("is_sales_professional"))


_AMOUNT = "TRY_CAST(nullif(regexp_extract(company_revenue, '\\d+'), '') AS BIGINT)"
REVENUE_SQL = sql_ladder(f"(CASE WHEN contains(lower(company_revenue), 'million') THEN {_AMOUNT} END)", K.REVENUE_LEVELS, "unknown", "<")


@report("str_14_cat_09_revenue", "contacts", ["id"], {
    "revenue_category": REVENUE_SQL, "revenue_code": sql_map(f"({REVENUE_SQL})", K.REVENUE_CODES, 0)})
def revenue(t: Tables) -> DataFrame:
    category = C.revenue_category(F.col("company_revenue"))
    return t.contacts("id", "company_revenue").select("id", category.alias("revenue_category")).withColumn(
        "revenue_code", C.revenue_code(F.col("revenue_category")))


@report("str_15_digits", "contacts", ["id"], {"digits": "TRY_CAST(regexp_replace(company_size_text, '[^0-9]', '', 'g') AS BIGINT)"})
def digits(t: Tables) -> DataFrame:
    return t.contacts("id", "company_size_text").select("id", T.digits_only(F.col("company_size_text")).alias("digits"))


@report("str_16_short_labels", "documents", ["doc_id"], {
    "label": "CASE WHEN length(text) > 30 THEN left(text, 30) || '...' ELSE text END"})
def short_labels(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.shorten(F.col("text"), 30).alias("label"))


# --- categories ------------------------------------------------------------------------
_JSON_NAMES = """lower(CASE WHEN json_valid(industry_json) THEN coalesce(
  array_to_string(CAST(json_extract(industry_json, '$.industries') AS VARCHAR[]), ' '), json_extract_string(industry_json, '$.industry')) END)"""
_JSON_CATEGORY = f"CASE WHEN coalesce({_JSON_NAMES}, '') = '' THEN 'Other' ELSE {sql_rules(_JSON_NAMES, K.JSON_INDUSTRY_RULES)} END"


@query("cat_01_industry", on_contacts(f"SELECT id, {INDUSTRY_SQL} AS category FROM contacts"))
def industry(t: Tables) -> DataFrame:
    return t.contacts("id", "organization_industry").select("id", C.industry_category(F.col("organization_industry")).alias("category"))


@query("cat_02_03_industry_fallbacks", on_contacts(f"""SELECT id, c1 AS by_name, {sql_fallback('c1', 'c2')} AS with_document,
  CASE WHEN {sql_fallback('c1', 'c2')} = 'Other' THEN c3 ELSE {sql_fallback('c1', 'c2')} END AS with_domain FROM (
  SELECT id, {INDUSTRY_SQL} AS c1, {_JSON_CATEGORY} AS c2, {sql_rules('company_domain', K.DOMAIN_INDUSTRY_RULES)} AS c3 FROM contacts)"""))
def industry_fallbacks(t: Tables) -> DataFrame:
    df = t.contacts("id", "organization_industry", "industry_json", "company_domain").withColumn("names", C.json_industries(F.col("industry_json")))
    name, document, domain = F.col("organization_industry"), F.col("names"), F.col("company_domain")
    return df.select("id", C.industry_category(name).alias("by_name"), C.industry_category(name, document).alias("with_document"),
                     C.industry_category(name, document, domain).alias("with_domain"))


@query("cat_04_seniority", on_contacts(f"""SELECT id, {sql_rules('seniority', K.SENIORITY_RULES, last=True)} AS by_seniority,
  {sql_fallback(sql_rules('seniority', K.SENIORITY_RULES, last=True), sql_rules('title', K.TITLE_SENIORITY_RULES))} AS with_title FROM contacts"""))
def seniority(t: Tables) -> DataFrame:
    return t.contacts("id", "seniority", "title").select(
        "id", C.seniority_category(F.col("seniority")).alias("by_seniority"),
        C.seniority_category(F.col("seniority"), F.col("title")).alias("with_title"))


def _words_rules_sql(col: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN " + " OR ".join(f"regexp_matches(lower({col}), '\\b{w.lower()}\\b')" for w in words)
                              + f" THEN '{c}'" for c, words in rules) + " ELSE 'Other' END"


@query("cat_04_seniority_whole_words", on_contacts(f"SELECT id, {_words_rules_sql('title', K.TITLE_SENIORITY_RULES)} AS category FROM contacts"))
def seniority_whole_words(t: Tables) -> DataFrame:
    return t.contacts("id", "title").select(
        "id", C.categorise(F.col("title"), K.TITLE_SENIORITY_RULES, whole_words=True).alias("category"))


@query("cat_05_title", on_contacts(f"""SELECT id, {TITLE_SQL} AS by_title,
  {sql_fallback(TITLE_SQL, sql_rules('seniority', K.SENIORITY_TITLE_RULES))} AS with_seniority FROM contacts"""))
def title(t: Tables) -> DataFrame:
    return t.contacts("id", "seniority", "title").select(
        "id", C.title_category(F.col("title")).alias("by_title"), C.title_category(F.col("title"), F.col("seniority")).alias("with_seniority"))


_SERVICE_SQL = f"CASE WHEN coalesce(organization_industry, '') = '' THEN 'unknown' ELSE {sql_rules('organization_industry', K.SERVICE_INDUSTRY_RULES, default='other')} END"
_DIRECT_SQL = f"CASE WHEN coalesce(organization_industry, '') = '' THEN 0 ELSE CAST({sql_rules('organization_industry', [(str(c), w) for c, w in K.DIRECT_INDUSTRY_CODES], default='7')} AS INTEGER) END"


@report("cat_06_07_service_industry", "contacts", ["id"], {
    "category": _SERVICE_SQL, "code": sql_map(f"({_SERVICE_SQL})", K.SERVICE_INDUSTRY_CODES, 0), "direct_code": _DIRECT_SQL})
def service_industry(t: Tables) -> DataFrame:
    name = F.col("organization_industry")
    return t.contacts("id", "organization_industry").select(
        "id", C.service_industry(name).alias("category"), C.direct_industry_code(name).alias("direct_code")
    ).withColumn("code", C.service_industry_code(F.col("category")))


_BY_COUNT = sql_ladder("organization_employees", [(b, n) for b, n, _ in K.EMPLOYEE_COUNT_BUCKETS], None, "<")
SIZE_WORD_SQL = f"CASE WHEN coalesce(organization_employees, 0) <> 0 THEN {_BY_COUNT} ELSE {sql_rules('company_size_text', K.SIZE_TEXT_RULES, default='unknown')} END"


@report("cat_08_company_size", "contacts", ["id"], {
    "company_size": SIZE_WORD_SQL, "code": sql_map(f"({SIZE_WORD_SQL})", K.SIZE_CODES, 0),
    "bucket": sql_ladder("nullif(organization_employees, 0)", [(b, s) for b, _, s in K.EMPLOYEE_COUNT_BUCKETS], "unknown", "<")})
def company_size(t: Tables) -> DataFrame:
    employees = F.col("organization_employees")
    return t.contacts("id", "organization_employees", "company_size_text").select(
        "id", C.company_size(employees, F.col("company_size_text")).alias("company_size"),
        C.employee_bucket(employees).alias("bucket")).withColumn("code", C.company_size_code(F.col("company_size")))


@report("cat_10_esp", "contacts", ["id"], {"category": ESP_SQL})
def esp(t: Tables) -> DataFrame:
    return t.contacts("id", "esp_code").select("id", C.esp_category(F.col("esp_code")).alias("category"))


@report("cat_11_list_categories", "contacts", ["id"], {
    "list_size": LIST_SIZE_SQL,
    "domain": "CASE WHEN email_list IS NULL THEN 'Unknown' WHEN contains(lower(email_list), 'dom1') THEN 'Second' ELSE 'Other Domain' END"})
def list_categories(t: Tables) -> DataFrame:
    count = T.address_list_features(F.col("email_list"))["email_count"]
    return t.contacts("id", "email_list").select("id", C.list_size_category(count).alias("list_size"),
                                                 C.domain_category(F.col("email_list"), [("dom1", "Second")]).alias("domain"))


@report("cat_12_age_era", "contacts", ["id"], {"age_category": AGE_SQL, "era": ERA_SQL})
def age_era(t: Tables) -> DataFrame:
    founded = F.col("organization_founded_year")
    return t.contacts("id", "organization_founded_year").select(
        "id", C.company_age_category(founded, K.AS_OF).alias("age_category"), C.business_era(founded).alias("era"))


@report("cat_13_daily_limit", "contacts", ["id"], {
    "bucket": sql_ladder("daily_limit", K.DAILY_LIMIT_LEVELS, "Unknown"), "score": sql_ladder("daily_limit", K.DAILY_LIMIT_SCORES, 0),
    "coarse_score": sql_ladder("daily_limit", K.DAILY_LIMIT_SCORES_COARSE, 0)})
def daily_limit(t: Tables) -> DataFrame:
    limit = F.col("daily_limit")
    return t.contacts("id", "daily_limit").select("id", C.daily_limit_bucket(limit).alias("bucket"), C.daily_limit_score(limit).alias("score"),
                                                  C.daily_limit_score(limit, coarse=True).alias("coarse_score"))


@query("cat_14_correlation_label", """SELECT event_type, round(r, 6) AS correlation, CASE WHEN abs(r) < 0.1 THEN 'Very weak'
  WHEN abs(r) < 0.3 THEN 'Weak' WHEN abs(r) < 0.5 THEN 'Moderate' ELSE 'Strong' END AS strength
  FROM (SELECT event_type, corr(user_id, value) AS r FROM events GROUP BY event_type)""")
def correlation_label(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.corr("user_id", "value").alias("r")).select(
        "event_type", F.round("r", 6).alias("correlation"), C.correlation_label(F.col("r")).alias("strength"))


def _grouped_sql(c: str, n: int = 20) -> str:
    return (f"CASE WHEN CAST({c} AS VARCHAR) IN (SELECT CAST({c} AS VARCHAR) FROM contacts WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT {n}) THEN CAST({c} AS VARCHAR) ELSE 'Other' END AS {c}_grouped")


@query("cat_15_rare_groups", on_contacts("SELECT id, " + ", ".join(_grouped_sql(c) for c in ("city", "country", "status", "organization")) + " FROM contacts"))
def rare_groups(t: Tables) -> DataFrame:
    columns = ["city", "country", "status", "organization"]
    return E.group_rare(t.contacts("id", *columns), columns).select("id", *[f"{c}_grouped" for c in columns])


@query("cat_16_coverage", on_segments(" UNION ALL ".join(
    f"""SELECT '{c}' AS field, {c} AS category, count(*) AS rows, round(count(*) * 100.0 / (SELECT count(*) FROM segments), 4) AS percentage
  FROM segments GROUP BY {c}""" for c in ("industry_category", "seniority_category", "title_category"))))
def coverage(t: Tables) -> DataFrame:
    from leadmill.operators.kpi import long_form
    from leadmill.plans.segments import segments

    fields = ["industry_category", "seniority_category", "title_category"]
    counts = long_form(segments(t, *fields), fields).groupBy("dimension", "value").agg(F.count("*").alias("rows"))
    totals = counts.groupBy("dimension").agg(F.sum("rows").alias("total"))
    return counts.join(totals, "dimension").select(
        F.col("dimension").alias("field"), F.col("value").alias("category"), "rows",
        F.round(F.col("rows") * 100.0 / F.col("total"), 4).alias("percentage"))


# --- dates ------------------------------------------------------------------------------
@report("dat_01_parse_time", "conversations", ["conv_id", "turn"], {
    "parsed": "strftime(TRY_CAST('2024-0' || CAST(1 + turn % 9 AS VARCHAR) || '-1' || CAST(conv_id % 13 AS VARCHAR) AS TIMESTAMP), '%Y-%m-%d')"})
def parse_time(t: Tables) -> DataFrame:
    text = F.concat(F.lit("2024-0"), (F.col("turn") % 9 + 1).cast("string"), F.lit("-1"), (F.col("conv_id") % 13).cast("string"))
    return t.conversations.select("conv_id", "turn", F.date_format(D.parse_time(text), "yyyy-MM-dd").alias("parsed"))


def _calendar_sql(ts: str, p: str) -> dict[str, str]:
    return {f"{p}_day_of_week": f"isodow({ts}) - 1", f"{p}_month": f"month({ts})", f"{p}_hour": f"hour({ts})", f"{p}_quarter": f"quarter({ts})"}


def _rhythm_sql(ts: str, p: str) -> dict[str, str]:
    return {f"{p}_is_weekend": _flag_sql(f"isodow({ts}) >= 6"), f"{p}_is_business_hours": _flag_sql(f"hour({ts}) BETWEEN 9 AND 17"),
            f"{p}_is_morning": _flag_sql(f"hour({ts}) <= 12"), f"{p}_season": f"CAST(floor(month({ts}) % 12 / 3.0) AS INTEGER)"}


HOUR_SQL = sql_cut("hour({ts})", *K.HOUR_BINS)


@report("dat_02_03_event_calendar", "events", ["event_id"], {**_calendar_sql("ts", "at"), **_rhythm_sql("ts", "at")})
def event_calendar(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select("event_id", *[c.alias(n) for n, c in {**D.calendar_parts(ts, "at"), **D.work_rhythm(ts, "at")}.items()])


@report("dat_04_05_day_parts", "events", ["event_id"], {
    "at_is_morning": _flag_sql("hour(ts) >= 6 AND hour(ts) < 12"), "at_is_afternoon": _flag_sql("hour(ts) >= 12 AND hour(ts) < 18"),
    "hour_category": HOUR_SQL.format(ts="ts")})
def day_parts(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select("event_id", *[c.alias(n) for n, c in D.day_parts(ts, "at").items()], D.hour_category(ts).alias("hour_category"))


_DAYS_OLD = sql_days(AS_OF_SQL, "timestamp_created")


@report("dat_06_ages", "contacts", ["id"], {"days_since_creation": _DAYS_OLD, "weeks_since_creation": f"CAST(floor({_DAYS_OLD} / 7.0) AS BIGINT)"})
def ages(t: Tables) -> DataFrame:
    return t.contacts("id", "timestamp_created").select("id", *[c.alias(n) for n, c in D.ages(F.col("timestamp_created"), K.AS_OF).items()])


def distance_sql() -> dict[str, str]:
    out = {}
    for c in K.TIMESTAMP_COLUMNS[1:]:
        stem = D.short_name(c)
        days = sql_days(c, "timestamp_created")
        out[f"days_between_{stem}_and_created"] = days
        out[f"days_between_{stem}_and_created_abs"] = f"abs({days})"
        out[f"has_{stem}"] = _flag_sql(f"{c} IS NOT NULL")
    return out


@report("dat_07_distances", "contacts", ["id"], distance_sql())
def distances(t: Tables) -> DataFrame:
    df = t.contacts("id", *K.TIMESTAMP_COLUMNS)
    return df.select("id", *[c.alias(n) for n, c in D.distances(K.TIMESTAMP_COLUMNS[1:], "timestamp_created").items()])


@report("dat_08_date_parts", "orders", ["o_orderkey"], {
    "date": "strftime(o_orderdate, '%Y-%m-%d')", "week": "week(o_orderdate)", "year": "year(o_orderdate)", "day_name": "dayname(o_orderdate)",
    "days_since_start": sql_days("o_orderdate", "(SELECT min(o_orderdate) FROM orders)")})
def date_parts(t: Tables) -> DataFrame:
    from leadmill.functions.expr import days_between

    orders = t.orders.select("o_orderkey", "o_orderdate")
    start = orders.agg(F.min("o_orderdate")).scalar()
    day = F.col("o_orderdate")
    return orders.select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("date"), F.weekofyear(day).alias("week"),
                         F.year(day).alias("year"), F.date_format(day, "EEEE").alias("day_name"),
                         days_between(day, start).alias("days_since_start"))


@report("dat_09_capped_age", "contacts", ["id"], {"age": f"least(coalesce({sql_days(AS_OF_SQL, 'timestamp_last_contact')}, 999), 365)"})
def capped_age(t: Tables) -> DataFrame:
    return t.contacts("id", "timestamp_last_contact").select("id", D.capped_age(F.col("timestamp_last_contact"), K.AS_OF).alias("age"))


def stage_sql(as_of: str, created: str, active: str, maturity: int = 30, engagement: int = 14, extended: int = 30) -> str:
    age, quiet = sql_days(as_of, created), f"coalesce({sql_days(as_of, active)}, {sql_days(as_of, created)})"
    return f"""CASE WHEN {created} IS NULL THEN 'unknown' WHEN {age} <= 1 THEN 'immediate'
  WHEN {age} <= {engagement} THEN CASE WHEN {quiet} <= 3 THEN 'hot' WHEN {quiet} <= 7 THEN 'warm' ELSE 'cooling' END
  WHEN {age} <= {extended} THEN CASE WHEN {quiet} <= 7 THEN 'lukewarm' ELSE 'cold' END
  WHEN {age} >= {maturity} THEN 'mature' ELSE 'aging' END"""


@report("dat_10_lead_stage", "contacts", ["id"], {
    "stage": stage_sql("TIMESTAMP '2024-02-05'", "timestamp_created", "timestamp_last_click"),
    "long_stage": stage_sql("TIMESTAMP '2024-02-05'", "timestamp_created", "timestamp_last_reply", 45, 20, 28)})
def lead_stage(t: Tables) -> DataFrame:
    from datetime import datetime

    now = datetime(2024, 2, 5)
    df = t.contacts("id", "timestamp_created", "timestamp_last_click", "timestamp_last_reply")
    created = F.col("timestamp_created")
    return df.select("id", D.lead_stage(created, F.col("timestamp_last_click"), now).alias("stage"),
                     D.lead_stage(created, F.col("timestamp_last_reply"), now, 45, 20, 28).alias("long_stage"))


@report("dat_11_year_of_text", "contacts", ["id"], {"year": "CASE WHEN length(city) >= 4 THEN TRY_CAST(left(city, 4) AS INTEGER) END",
    "start_year": "TRY_CAST(left(CAST(organization_founded_year AS VARCHAR) || '-05', 4) AS INTEGER)"})
def year_of_text(t: Tables) -> DataFrame:
    text = F.concat(F.col("organization_founded_year").cast("string"), F.lit("-05"))
    return t.contacts("id", "city", "organization_founded_year").select(
        "id", D.year_of_text(F.col("city")).alias("year"), D.year_of_text(text).alias("start_year"))


# --- numbers --------------------------------------------------------------------------
@report("mth_01_logs", "contacts", ["id"], {
    "log_size": "round(ln(1 + coalesce(organization_employees, 0)), 6)", "sqrt_size": "round(sqrt(coalesce(organization_employees, 0)), 6)",
    "squared_limit": "CAST(coalesce(daily_limit, 0) * coalesce(daily_limit, 0) AS DOUBLE)"})
def logs(t: Tables) -> DataFrame:
    employees, limit = number("organization_employees"), number("daily_limit")
    return t.contacts("id", "organization_employees", "daily_limit").select(
        "id", F.round(F.log1p(employees), 6).alias("log_size"), F.round(F.sqrt(employees), 6).alias("sqrt_size"),
        F.pow(limit, F.lit(2)).alias("squared_limit"))


@report("mth_02_lenient_number", "contacts", ["id"], {"value": "coalesce(TRY_CAST(company_size_text AS DOUBLE), 0)",
    "limit_value": "coalesce(CAST(daily_limit AS DOUBLE), 0)"})
def lenient_number(t: Tables) -> DataFrame:
    return t.contacts("id", "company_size_text", "daily_limit").select("id", number("company_size_text").alias("value"), number("daily_limit").alias("limit_value"))


_BIN_SETS = {"size_category": ("organization_employees", K.SIZE_CATEGORY_BINS, True), "page_category": ("page_retrieved", K.PAGE_BINS, False),
             "employee_range": ("organization_employees", K.EMPLOYEE_RANGE_BINS, True),
             "age_category": (f"({YEAR} - organization_founded_year)", K.AGE_CATEGORY_BINS, True),
             "inspect_age": (f"({YEAR} - organization_founded_year)", K.INSPECT_AGE_BINS, True)}


@report("mth_03_fixed_bins", "contacts", ["id"], {n: sql_cut(c, *b, lowest=low) for n, (c, b, low) in _BIN_SETS.items()})
def fixed_bins(t: Tables) -> DataFrame:
    df = t.contacts("id", "organization_employees", "page_retrieved", "organization_founded_year")
    return df.select("id", *[cut(F.expr(c), *b, lowest=low).alias(n) for n, (c, b, low) in _BIN_SETS.items()])


@query("mth_04_equal_width", "SELECT l_orderkey, l_linenumber, CASE " + " ".join(
    f"WHEN l_extendedprice <= lo + (hi - lo) / 5 * {i + 1} THEN '{K.FIVE_LEVELS[i]}'" for i in range(4))
    + " ELSE 'Very High' END AS l_extendedprice_binned FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)")
def equal_width(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return E.equal_width_labels(df, "l_extendedprice", K.FIVE_LEVELS).drop("l_extendedprice")


def quantile_code_sql(value: str, source: str, q: int) -> str:
    probs = "[" + ", ".join(str(i / q) for i in range(q + 1)) + "]"
    edges = f"(SELECT list_distinct(quantile_cont({value}, {probs})) FROM {source})"
    return f"greatest(CAST(len(list_filter({edges}, lambda e: e < {value})) AS INTEGER) - 1, 0)"


_FILLED_CTE = """filled AS (SELECT id, CAST(coalesce(daily_limit, -1) AS DOUBLE) AS daily_limit, CAST(coalesce(organization_employees, -1) AS DOUBLE) AS organization_employees,
  CAST(esp_code AS DOUBLE) AS esp_code FROM contacts)"""


@query("mth_05_quantile_codes", on_contacts("SELECT id, " + ", ".join(
    f"{quantile_code_sql(c, 'filled', q)} AS {c}_quantile" for c, q in (("daily_limit", 10), ("organization_employees", 20), ("esp_code", 5)))
    + " FROM filled", _FILLED_CTE))
def quantile_codes(t: Tables) -> DataFrame:
    specs = {"daily_limit": 10, "organization_employees": 20, "esp_code": 5}
    return E.quantile_codes(t.contacts("id", *specs), specs, -1).select("id", *[f"{c}_quantile" for c in specs])


@query("mth_05_price_quantile_codes", f"SELECT l_orderkey, l_linenumber, {quantile_code_sql('l_extendedprice', 'lineitem', 15)} AS l_extendedprice_quantile FROM lineitem")
def price_quantile_codes(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return E.quantile_codes(df, {"l_extendedprice": 15}, None, bounded=False).drop("l_extendedprice")


@query("mth_06_jn_08_frequency", on_contacts("SELECT id, " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 0 ELSE count({c}) OVER (PARTITION BY {c}) END AS {c}_frequency, "
    f"round(CASE WHEN {c} IS NULL THEN 0 ELSE count({c}) OVER (PARTITION BY {c}) END / CAST((SELECT max(n) FROM (SELECT count({c}) AS n FROM contacts GROUP BY {c})) AS DOUBLE), 6) AS {c}_frequency_norm"
    for c in ("country", "city", "email_list")) + " FROM contacts"))
def frequency(t: Tables) -> DataFrame:
    columns = ["country", "city", "email_list"]
    return rounded(E.with_frequency(t.contacts("id", *columns), columns, normalise=True).drop(*columns))


@report("mth_07_size_age_flags", "contacts", ["id"], {
    "is_enterprise": _flag_sql("organization_employees >= 1000"), "is_mid_market": _flag_sql("organization_employees >= 200 AND organization_employees < 1000"),
    "is_smb": _flag_sql("organization_employees < 200"), "is_very_small": _flag_sql("organization_employees <= 10"),
    "is_startup": _flag_sql(f"{YEAR} - organization_founded_year <= 5"), "is_mature_company": _flag_sql(f"{YEAR} - organization_founded_year >= 20"),
    "is_very_old_company": _flag_sql(f"{YEAR} - organization_founded_year >= 50")})
def size_age_flags(t: Tables) -> DataFrame:
    flags = {**FE.size_flags(F.col("organization_employees")), **FE.age_flags(F.lit(YEAR) - F.col("organization_founded_year"))}
    flags.pop("company_age")
    return t.contacts("id", "organization_employees", "organization_founded_year").select("id", *[c.alias(n) for n, c in flags.items()])


@report("mth_11_12_13_targets", "contacts", ["id"], {
    "level": "CASE WHEN email_click_count > 0 OR email_reply_count > 0 THEN 2 WHEN email_open_count > 0 THEN 1 ELSE 0 END",
    "click_level": "CASE WHEN email_click_count > 0 THEN 2 WHEN email_open_count > 0 AND email_click_count = 0 THEN 1 ELSE 0 END",
    "opened": _flag_sql("email_open_count > 0"), "clicked": _flag_sql("email_click_count > 0"), "replied": _flag_sql("email_reply_count > 0")})
def targets(t: Tables) -> DataFrame:
    o, c, r = (F.col(n) for n in K.ENGAGEMENT_COUNTS)
    return t.contacts("id", *K.ENGAGEMENT_COUNTS).select("id", S.engagement_level(o, c, r).alias("level"), S.click_level(o, c).alias("click_level"),
                                                         *[x.alias(n) for n, x in S.outcome_flags().items()])


_PRODUCTS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("mth_16_pairwise_products", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round({a} * {b}, 4) AS {a}_x_{b}" for i, a in enumerate(_PRODUCTS) for b in _PRODUCTS[i + 1:]) + " FROM lineitem")
def pairwise_products(t: Tables) -> DataFrame:
    products = S.pairwise_products(_PRODUCTS)
    return t.lineitem.select("l_orderkey", "l_linenumber", *[F.round(c, 4).alias(n) for n, c in products.items()])


@report("mth_17_clipped_age", "contacts", ["id"], {"company_age": f"least(greatest({YEAR} - coalesce(organization_founded_year, 2020), 0), 100)"})
def clipped_age(t: Tables) -> DataFrame:
    age = F.lit(YEAR) - F.coalesce(F.col("organization_founded_year"), F.lit(2020))
    return t.contacts("id", "organization_founded_year").select("id", F.least(F.greatest(age, F.lit(0)), F.lit(100)).alias("company_age"))


@query("mth_18_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 4, 1) AS quarter_quantity, round_even(l_quantity / 8, 2) AS eighth FROM lineitem")
def half_even_rounding(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", half_even(q / 4, 1).alias("quarter_quantity"), half_even(q / 8, 2).alias("eighth"))


# --- documents ----------------------------------------------------------------------------
_PRESENT = " + ".join(_flag_sql(f"{c} IS NOT NULL") for c in K.JSON_COLUMNS)


@report("jsn_01_presence", "contacts", ["id"], {
    **{f"has_{c}": _flag_sql(f"{c} IS NOT NULL") for c in K.JSON_COLUMNS}, "enrichment_completeness": _PRESENT, "enrichment_completeness_pct": f"({_PRESENT}) / 4.0::DOUBLE"})
def presence(t: Tables) -> DataFrame:
    return t.contacts("id", *K.JSON_COLUMNS).select("id", *[c.alias(n) for n, c in J.presence(K.JSON_COLUMNS).items()])


_JOB = '[{"title":"VARCHAR","organization_name":"VARCHAR","start_date":"VARCHAR","end_date":"VARCHAR","current":"BOOLEAN","kind":"VARCHAR","degree":"VARCHAR"}]'
_TENURE = f"""CASE WHEN length(j.start_date) >= 4 AND TRY_CAST(left(j.start_date, 4) AS INTEGER) > 0 THEN greatest(coalesce(
  CASE WHEN coalesce(j.end_date, '') <> '' AND lower(j.end_date) NOT IN ('present', 'current') AND length(j.end_date) >= 4 THEN TRY_CAST(left(j.end_date, 4) AS INTEGER) END, {YEAR})
  - TRY_CAST(left(j.start_date, 4) AS INTEGER), 0) END"""
EMPLOYMENT_CTE = f"""parsed_jobs AS (SELECT id, CASE WHEN json_valid(employment_history) AND json_type(employment_history) = 'ARRAY'
    THEN from_json(employment_history, '{_JOB}') END AS jobs FROM contacts),
job_rows AS (SELECT id, unnest(jobs) AS j, generate_subscripts(jobs, 1) AS pos FROM parsed_jobs),
job_facts AS (SELECT id, count(*) AS job_count,
  first({_TENURE} ORDER BY pos) FILTER (WHERE {_TENURE} IS NOT NULL) AS current_tenure, avg({_TENURE}) AS avg_tenure, count({_TENURE}) AS tenures,
  max(greatest(coalesce(TRY_CAST(left(j.start_date, 4) AS INTEGER), -1), coalesce(TRY_CAST(left(j.end_date, 4) AS INTEGER), -1))) AS last_year,
  min(least(coalesce(TRY_CAST(left(j.start_date, 4) AS INTEGER), 99999), coalesce(TRY_CAST(left(j.end_date, 4) AS INTEGER), 99999))) AS first_year,
  count(TRY_CAST(left(j.start_date, 4) AS INTEGER)) + count(TRY_CAST(left(j.end_date, 4) AS INTEGER)) AS years,
  max({_any_sql('lower(j.title)', K.MANAGEMENT_WORDS)}) AS management,
  count(DISTINCT nullif(lower(j.organization_name), '')) AS employers,
  max(CASE WHEN lower(j.kind) = 'education' THEN CASE WHEN contains(lower(j.degree), 'phd') OR contains(lower(j.degree), 'doctorate') THEN 4
    WHEN contains(lower(j.degree), 'master') OR contains(lower(j.degree), 'mba') THEN 3 WHEN contains(lower(j.degree), 'bachelor') THEN 2
    WHEN contains(lower(j.degree), 'associate') THEN 1 END END) AS education FROM job_rows GROUP BY id),
employment AS (SELECT id, coalesce(job_count, 0) AS job_count, CAST(coalesce(current_tenure, 0) AS BIGINT) AS current_job_tenure_years,
  round(coalesce(avg_tenure, 0), 6) AS avg_job_tenure_years, CAST(CASE WHEN years >= 2 THEN last_year - first_year ELSE 0 END AS BIGINT) AS total_career_years,
  round(coalesce(tenures / CAST(greatest(CASE WHEN years >= 2 THEN last_year - first_year ELSE 0 END, 1) AS DOUBLE), 0), 6) AS job_progression_score,
  coalesce(management, 0) AS has_management_experience, round(CASE WHEN job_count > 0 THEN 1.0 / greatest(employers, 1) ELSE 0 END, 6) AS industry_stability,
  coalesce(education, 0) AS education_level FROM contacts LEFT JOIN job_facts USING (id))"""
EMPLOYMENT_FEATURES = ["job_count", "current_job_tenure_years", "avg_job_tenure_years", "total_career_years", "job_progression_score",
                       "has_management_experience", "industry_stability", "education_level"]


@query("jsn_02_employment", on_contacts("SELECT * FROM employment", EMPLOYMENT_CTE))
def employment(t: Tables) -> DataFrame:
    return rounded(J.employment_features(t.contacts("id", "employment_history"), K.AS_OF).drop("employment_history"))


def _doc(c: str, path: str) -> str:
    return f"(CASE WHEN json_valid({c}) AND json_type({c}) = 'OBJECT' THEN json_extract_string({c}, '$.{path}') END)"


def _doc_len(c: str, path: str) -> str:
    return f"(CASE WHEN json_valid({c}) AND json_type({c}) = 'OBJECT' THEN coalesce(json_array_length({c}, '$.{path}'), 0) ELSE 0 END)"


_ORG = "organization_data"
_EMP = f"coalesce(TRY_CAST({_doc(_ORG, 'estimated_num_employees')} AS BIGINT), 0)"
_PUBLIC = _flag_sql(f"coalesce({_doc(_ORG, 'publicly_traded_symbol')}, '') <> ''")
_TECH = (f"len(list_filter(CASE WHEN json_valid({_ORG}) AND json_type({_ORG}) = 'OBJECT' THEN CAST(json_extract({_ORG}, '$.keywords') AS VARCHAR[]) END, lambda k: "
         + " OR ".join(f"contains(lower(k), '{w}')" for w in K.TECH_KEYWORDS) + "))")
_CAP = f"lower({_doc(_ORG, 'market_cap')})"
ORGANIZATION_SQL = {
    "company_size_bucket": f"CASE WHEN {_EMP} = 0 THEN 'unknown' ELSE {sql_ladder(_EMP, K.ORG_SIZE_BUCKETS, 'unknown')} END",
    "has_public_trading": _PUBLIC,
    "alexa_rank_tier": sql_ladder(f"nullif(TRY_CAST({_doc(_ORG, 'alexa_ranking')} AS BIGINT), 0)", K.RANK_TIERS, "unknown"),
    "has_social_presence": " + ".join(_flag_sql(f"coalesce({_doc(_ORG, u)}, '') <> ''") for u in ("twitter_url", "facebook_url", "linkedin_url")),
    "industry_keywords_count": _doc_len(_ORG, "keywords"),
    **{f"headcount_growth_{n}": f"coalesce(TRY_CAST({_doc(_ORG, f'organization_headcount_{w}_month_growth')} AS DOUBLE), 0)"
       for n, w in (("6m", "six"), ("12m", "twelve"), ("24m", "twenty_four"))},
    "is_tech_company": _flag_sql(f"coalesce({_TECH}, 0) >= 2"), "is_enterprise": _flag_sql(f"{_EMP} > 1000 OR ({_PUBLIC}) = 1"),
    "market_cap_tier": f"CASE WHEN coalesce({_CAP}, '') = '' THEN 'unknown' WHEN contains({_CAP}, 'b') THEN 'large_cap' WHEN contains({_CAP}, 'm') THEN 'mid_cap' ELSE 'small_cap' END",
}
_ACC = "account_data"
ACCOUNT_SQL = {
    "account_age_days": f"greatest(coalesce({sql_days(AS_OF_SQL, f'TRY_CAST(replace({_doc(_ACC, chr(99) + chr(114) + chr(101) + chr(97) + chr(116) + chr(101) + chr(100) + chr(95) + chr(97) + chr(116))}, chr(90), chr(32)) AS TIMESTAMP)')}, 0), 0)",
    "has_crm_integration": _flag_sql(f"coalesce({_doc(_ACC, 'crm_record_url')}, '') <> ''"), "label_count": _doc_len(_ACC, "label_ids"),
    "account_stage_maturity": _flag_sql(f"coalesce({_doc(_ACC, 'account_stage_id')}, '') <> ''"),
    "phone_status_quality": sql_map(_doc(_ACC, "phone_status"), K.CONTACTABILITY_SCORES, 0),
    "existence_level_score": sql_map(_doc(_ACC, "existence_level"), K.CONTACTABILITY_SCORES, 0),
}
_API = "api_response_raw"
RESPONSE_SQL = {
    "email_confidence": f"coalesce(TRY_CAST({_doc(_API, 'extrapolated_email_confidence')} AS DOUBLE), 0)",
    "intent_strength_score": sql_map(f"lower({_doc(_API, 'intent_strength')})", K.INTENT_SCORES, 0),
    "functions_count": _doc_len(_API, "functions"), "departments_count": _doc_len(_API, "departments"),
    "is_decision_maker": _any_sql(f"lower({_doc(_API, 'title')})", K.DECISION_WORDS),
    "seniority_level": "greatest(" + ", ".join(f"CASE WHEN contains(lower({_doc(_API, 'seniority')}), '{w}') THEN {s} ELSE 0 END" for w, s in K.SENIORITY_SCORES.items()) + ")",
    "has_personal_emails": _flag_sql(f"{_doc_len(_API, 'personal_emails')} > 0"),
    "revealed_for_team": _flag_sql(f"{_doc(_API, 'revealed_for_current_team')} = 'true'"),
}


VALID_ORGANIZATION_CTE = """valid_contacts AS MATERIALIZED (SELECT * REPLACE (CASE WHEN json_valid(organization_data) THEN organization_data END AS organization_data) FROM contacts)"""


@query("jsn_03_organization", on_contacts("SELECT id, " + ", ".join(f"{s} AS {n}" for n, s in ORGANIZATION_SQL.items()) + " FROM valid_contacts",
                                          VALID_ORGANIZATION_CTE))
def organization(t: Tables) -> DataFrame:
    return J.organization_features(t.contacts("id", _ORG)).drop(_ORG)


@report("jsn_04_account", "contacts", ["id"], ACCOUNT_SQL)
def account(t: Tables) -> DataFrame:
    return J.account_features(t.contacts("id", _ACC), K.AS_OF).drop(_ACC)


@report("jsn_05_response", "contacts", ["id"], RESPONSE_SQL)
def response(t: Tables) -> DataFrame:
    return J.response_features(t.contacts("id", _API)).drop(_API)


@query("jsn_06_keep_existing", on_contacts("SELECT id, -1 AS label_count, " + ", ".join(
    f"{s} AS {n}" for n, s in ACCOUNT_SQL.items() if n != "label_count") + " FROM contacts"))
def keeping_existing(t: Tables) -> DataFrame:
    base = t.contacts("id", _ACC).withColumn("label_count", F.lit(-1))
    return J.keeping_existing(base, lambda df: J.account_features(df, K.AS_OF)).drop(_ACC)


@query("jsn_07_key_profile", """SELECT k AS key, CASE json_type(props, '$.' || k) WHEN 'UBIGINT' THEN 'number' WHEN 'BIGINT' THEN 'number' WHEN 'DOUBLE' THEN 'number' ELSE 'string' END AS kind,
  count(*) AS rows FROM (SELECT props, unnest(json_keys(props)) AS k FROM events) GROUP BY 1, 2""")
def key_profile(t: Tables) -> DataFrame:
    return J.key_profile(t.events.select("props"), "props")


@query("jsn_07_organization_keys")
def organization_keys(t: Tables) -> DataFrame:
    return J.key_profile(t.contacts(_ORG), _ORG)


def _first_sql(c: str, path: str) -> str:
    return f"coalesce(CASE WHEN json_valid({c}) THEN json_extract_string({c}, '{path}') END, '')"


@report("jsn_08_flatten", "contacts", ["id"], {
    "has_employment_history": _flag_sql("employment_history IS NOT NULL"), "employment_history_length": "length(employment_history)",
    "employment_history_count": "CASE WHEN json_valid(employment_history) AND json_type(employment_history) = 'ARRAY' THEN json_array_length(employment_history) ELSE 0 END",
    **{f"employment_history_{n}": _first_sql("employment_history", f"$.{n}") for n in ("title", "organization_name")},
    **{f"employment_history_first_{n}": _first_sql("employment_history", f"$[0].{n}") for n in ("title", "organization_name")}})
def flatten(t: Tables) -> DataFrame:
    df = t.contacts("id", "employment_history")
    parts = J.flatten_document("employment_history", ["title", "organization_name"])
    return df.select("id", *[c.alias(n) for n, c in parts.items()])


@query("jsn_09_json_cast", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_cast(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("jsn_10_vector_pack", on_contacts("SELECT id, CAST(email_open_count AS DOUBLE) AS opens, CAST(daily_limit AS DOUBLE) AS daily_limit FROM contacts"))
def vector_pack(t: Tables) -> DataFrame:
    packed = t.contacts("id", "email_open_count", "daily_limit").select(
        "id", F.to_json(F.struct(F.col("email_open_count").alias("opens"), "daily_limit")).alias("vector"))
    return packed.select("id", F.from_json("vector", "struct<opens:double, daily_limit:double>").alias("v")).select("id", "v.*")


@report("jsn_11_stack_presence", "contacts", ["id"], {
    "has_stack": _flag_sql("""CASE WHEN json_valid(employment_history) THEN CASE json_type(employment_history) WHEN 'ARRAY' THEN json_array_length(employment_history) > 0
      WHEN 'OBJECT' THEN len(json_keys(employment_history)) > 0 END END""")})
def stack_presence(t: Tables) -> DataFrame:
    return t.contacts("id", "employment_history").select("id", J.has_stack(F.col("employment_history")).alias("has_stack"))
