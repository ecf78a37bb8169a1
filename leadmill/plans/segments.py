"""Segment reports: key figures by campaign, company, person and setting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import categories as C
from leadmill.functions import scores as S
from leadmill.functions import text as T
from leadmill.functions.expr import cut, flag, half_even, lookup, safe_ratio
from leadmill.operators import kpi
from leadmill.plans.registry import (SIZE_SQL, kpi_sql, on_contacts, on_segments, query, sql_cut, sql_ladder,
                                     sql_map, sql_rules)
from leadmill.sources.tables import Tables


_CATEGORIES = {  # category column: columns it needs, expression
    "company_size": (["organization_employees"], lambda: C.company_size_band(F.col("organization_employees"))),
    "industry_category": (["organization_industry"], lambda: C.industry_category(F.col("organization_industry"))),
    "seniority_category": (["seniority", "title"], lambda: C.seniority_category(F.col("seniority"), F.col("title"))),
    "title_category": (["title"], lambda: C.title_category(F.col("title"))),
}


def segments(t: Tables, *columns: str) -> DataFrame:
    """Contacts with counts, outcome flags and the named contact or category columns."""
    base = [*K.ENGAGEMENT_COUNTS, *[c for c in columns if c not in _CATEGORIES]]
    for c in columns:
        base += _CATEGORIES[c][0] if c in _CATEGORIES else []
    return t.contacts(*base).withColumns({
        **S.outcome_flags(), **{c: _CATEGORIES[c][1]() for c in columns if c in _CATEGORIES}})


# --- campaign and segment key figures ---------------------------------------
_PLAIN = {
    # name: keys, least contacts, least open rate, rows
    "agg_01_campaign": (["campaign"], 50, None, 20),
    "agg_02_campaign_size": (["campaign", "company_size"], 20, 0.05, 15),
    "agg_03_campaign_industry": (["campaign", "industry_category"], 25, 0.05, None),
    "agg_04_campaign_seniority": (["campaign", "seniority_category"], 20, 0.05, None),
    "agg_05_campaign_title": (["campaign", "title_category"], 20, 0.05, None),
    "agg_06_campaign_list": (["campaign", "email_list"], 15, 0.05, None),
    "agg_08_campaign_esp": (["campaign", "esp_code"], 20, 0.05, None),
    "agg_11_industry_size": (["industry_category", "company_size"], 30, None, None),
    "agg_12_size_seniority": (["company_size", "seniority_category"], 20, None, None),
    "agg_13_industry_seniority": (["industry_category", "seniority_category"], 25, None, None),
}


def _plain(keys, least, rate, rows):
    return lambda t: kpi.segment_kpis(segments(t, *keys), keys, least, rate, rows)


for _name, (_keys, _least, _rate, _rows) in _PLAIN.items():
    query(_name, on_segments(kpi_sql(_keys, _least, _rate, _rows)))(_plain(_keys, _least, _rate, _rows))


_TOP_COUNTRIES = """top_countries AS (SELECT country FROM segments WHERE country IS NOT NULL
  GROUP BY country ORDER BY count(*) DESC, country LIMIT {n}),
in_top AS (SELECT * FROM segments WHERE country IN (SELECT country FROM top_countries))"""


@query("agg_07_campaign_country", on_segments(kpi_sql(["campaign", "country"], 20, 0.05, source="in_top"),
                                              _TOP_COUNTRIES.format(n=10)))
def campaign_country(t: Tables) -> DataFrame:
    keys = ["campaign", "country"]
    totals = kpi.segment_totals(segments(t, *keys), keys)
    return kpi.segment_rates(kpi.within_largest(totals, "country", 10), keys, 20, 0.05)


_BEST = """best AS (SELECT campaign FROM segments GROUP BY campaign HAVING count(*) >= 50
  ORDER BY round_even(avg(opened), 4) DESC, campaign LIMIT {n}),
in_best AS (SELECT * FROM segments WHERE campaign IN (SELECT campaign FROM best))"""


def _targeting(dimension: str, n: int):
    @query(f"agg_09_targeting_{dimension}",
           on_segments(kpi_sql(["campaign", dimension], 10, None, 20, "in_best"), _BEST.format(n=n)))
    def build(t: Tables) -> DataFrame:
        keys = ["campaign", dimension]
        totals = kpi.segment_totals(segments(t, *keys), keys)
        best = kpi.segment_rates(kpi.roll_up(totals, ["campaign"]), ["campaign"], 50, top_n=n).select("campaign")
        return kpi.segment_rates(totals.join(F.broadcast(best), "campaign", "left_semi"), keys, 10, top_n=20)
    return build


for _dim, _n in (("industry_category", 10), ("company_size", 10), ("title_category", 15)):
    _targeting(_dim, _n)


@query("agg_10_segment_triples", on_segments(
    kpi_sql(["segment"], 50, None, 20, "joined"),
    "joined AS (SELECT *, industry_category || ' | ' || coalesce(company_size, 'nan') || ' | ' || seniority_category AS segment "
    "FROM segments)"))
def segment_triples(t: Tables) -> DataFrame:
    parts = ["industry_category", "company_size", "seniority_category"]
    triple = F.concat_ws(" | ", *[F.coalesce(F.col(c), F.lit("nan")) for c in parts])
    return kpi.segment_kpis(segments(t, *parts).withColumn("segment", triple), ["segment"], 50, top_n=20)


_DIMS = [("company_size", 50), ("industry_category", 100), ("seniority_category", 50)]


@query("agg_14_single_dimension", on_segments(" UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS value, count(*) AS contact_count, round_even(avg(opened), 4) AS open_rate "
    f"FROM segments WHERE {d} IS NOT NULL GROUP BY {d} HAVING count(*) >= {n}" for d, n in _DIMS)))
def single_dimension(t: Tables) -> DataFrame:
    dims = [d for d, _ in _DIMS]
    counts = kpi.long_form(segments(t, *dims), dims, ["opened"]).groupBy("dimension", "value").agg(
        F.count("*").alias("contact_count"), half_even(F.avg("opened"), 4).alias("open_rate"))
    return counts.filter(F.col("contact_count") >= lookup(F.col("dimension"), dict(_DIMS)))


def engagement_table(df: DataFrame, keys: list[str], *keep: str) -> DataFrame:
    """Counts with per-contact rates in percent (opens, clicks and replies may exceed the contacts)."""
    out = df.dropna(subset=keys).groupBy(*keys).agg(
        F.count("*").alias("rows"), F.count("email_open_count").alias("contact_count"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (
            ("email_open_count", "total_opens"), ("email_click_count", "total_clicks"),
            ("email_reply_count", "total_replies"))])
    return out.withColumns({f"{n}_rate": half_even(safe_ratio(F.col(f"total_{p}"), F.col("contact_count")) * 100, 2)
                            for n, p in (("open", "opens"), ("click", "clicks"), ("reply", "replies"))}).drop(*{"rows"} - {*keep})


def engagement_sql(keys: str, source: str) -> str:
    rate = "round_even(CAST(sum({c}) AS DOUBLE) / nullif(count(email_open_count), 0) * 100, 2)"
    return f"""SELECT {keys}, count(email_open_count) AS contact_count,
  CAST(coalesce(sum(email_open_count), 0) AS BIGINT) AS total_opens,
  CAST(coalesce(sum(email_click_count), 0) AS BIGINT) AS total_clicks,
  CAST(coalesce(sum(email_reply_count), 0) AS BIGINT) AS total_replies,
  {rate.format(c='email_open_count')} AS open_rate, {rate.format(c='email_click_count')} AS click_rate,
  {rate.format(c='email_reply_count')} AS reply_rate FROM {source}
  WHERE {' AND '.join(k + ' IS NOT NULL' for k in keys.split(', '))} GROUP BY {keys}"""


@query("agg_15_country_engagement", on_segments(engagement_sql("country", "in_top"), _TOP_COUNTRIES.format(n=20)))
def country_engagement(t: Tables) -> DataFrame:
    # the table itself holds one row per country, so the largest ones are picked from it
    return kpi.top(engagement_table(t.contacts("country", *K.ENGAGEMENT_COUNTS), ["country"], "rows"), "rows", 20,
                   ["country"]).drop("rows")


@query("agg_16_seniority_engagement", on_contacts(engagement_sql("seniority", "contacts")))
def seniority_engagement(t: Tables) -> DataFrame:
    return engagement_table(t.contacts("seniority", *K.ENGAGEMENT_COUNTS), ["seniority"])


@query("agg_17_size_engagement", on_segments(engagement_sql("company_size", "segments")))
def size_engagement(t: Tables) -> DataFrame:
    return engagement_table(segments(t, "company_size"), ["company_size"])


@query("agg_17_size_seniority_engagement", on_segments(engagement_sql("company_size, seniority", "segments")))
def size_seniority_engagement(t: Tables) -> DataFrame:
    return engagement_table(segments(t, "company_size", "seniority"), ["company_size", "seniority"])


_VOLUME = "SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(email_open_count) AS volume, " \
          "CAST(coalesce(sum(email_open_count), 0) AS BIGINT) AS total_opens, " \
          "round_even(avg(email_open_count), 3) AS avg_opens FROM segments WHERE {w} GROUP BY {d}"
_IN_TOP = "{d} IN (SELECT {d} FROM segments WHERE {d} IS NOT NULL GROUP BY {d} ORDER BY count(*) DESC, {d} LIMIT 10)"


@query("agg_18_volume_performance", on_segments(" UNION ALL ".join(
    [_VOLUME.format(d=d, w=f"{d} IS NOT NULL") for d in ("company_size", "seniority", "status")]
    + [_VOLUME.format(d=d, w=_IN_TOP.format(d=d)) for d in ("country", "organization_industry", "esp_code")])))
def volume_performance(t: Tables) -> DataFrame:
    every, largest = ["company_size", "seniority", "status"], ["country", "organization_industry", "esp_code"]
    table = kpi.long_form(segments(t, *every, *largest), every + largest, ["email_open_count"]).groupBy(
        "dimension", "value").agg(
        F.count("*").alias("rows"), F.count("email_open_count").alias("volume"),
        F.coalesce(F.sum("email_open_count"), F.lit(0)).alias("total_opens"),
        half_even(F.avg("email_open_count"), 3).alias("avg_opens"))
    # codes rank as numbers, names as text; only dimensions with a limit are ranked, so that tasks drop all others early
    order = Window.partitionBy("dimension").orderBy(
        F.desc("rows"), F.col("value").try_cast("bigint").asc_nulls_last(), "value")
    top = (table.filter(F.col("dimension").isin(largest)).withColumn("place", F.row_number().over(order))
           .filter(F.col("place") <= 10).drop("place"))
    return table.filter(F.col("dimension").isin(every)).unionByName(top).drop("rows")


_METHOD = """SELECT upload_method, count(email_open_count) AS contacts,
  {sums} FROM contacts GROUP BY upload_method""".format(sums=", ".join(
    f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS total_{n}, round_even(avg({c}), 3) AS avg_{n}, "
    f"CAST(coalesce(sum({c}), 0) AS DOUBLE) / nullif(count(email_open_count), 0) AS {n}_per_contact"
    for c, n in (("email_open_count", "opens"), ("email_click_count", "clicks"), ("email_reply_count", "replies"))))


@query("agg_19_upload_method", on_contacts(_METHOD))
def upload_method(t: Tables) -> DataFrame:
    aggs = [F.count("email_open_count").alias("contacts")]
    for c, n in (("email_open_count", "opens"), ("email_click_count", "clicks"), ("email_reply_count", "replies")):
        total = F.coalesce(F.sum(c), F.lit(0))
        aggs += [total.alias(f"total_{n}"), half_even(F.avg(c), 3).alias(f"avg_{n}"),
                 safe_ratio(total, F.count("email_open_count")).alias(f"{n}_per_contact")]
    return t.contacts("upload_method", *K.ENGAGEMENT_COUNTS).groupBy("upload_method").agg(*aggs)


@query("agg_20_campaign_statistics", on_segments("""SELECT * FROM (
  SELECT round(avg(opened), 6) AS overall_open_rate, round(avg(clicked), 6) AS overall_click_rate,
    round(avg(replied), 6) AS overall_reply_rate, count(DISTINCT campaign) AS campaigns, count(*) AS contacts,
    count(*) / CAST(count(DISTINCT campaign) AS DOUBLE) AS contacts_per_campaign FROM segments),
  (SELECT round(avg(open_rate), 6) AS mean_open_rate, round(avg(click_rate), 6) AS mean_click_rate,
    round(avg(reply_rate), 6) AS mean_reply_rate, max(open_rate) AS best_open_rate, min(open_rate) AS worst_open_rate,
    count(*) AS significant_campaigns FROM (""" + kpi_sql(["campaign"], 50) + "))"))
def campaign_statistics(t: Tables) -> DataFrame:
    sums = ["opened", "clicked", "replied"]
    # one row per campaign, from which both levels follow
    per = segments(t, "campaign").groupBy("campaign").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums])
    big = F.col("n") >= 50

    def rate(c):
        return F.when(big, half_even(F.col(c) / F.col("n"), 4))

    return per.agg(
        *[F.round(F.sum(c) / F.sum("n"), 6).alias(f"overall_{n}_rate") for c, n in zip(sums, ("open", "click", "reply"))],
        F.count("campaign").alias("campaigns"), F.sum("n").alias("contacts"),
        (F.sum("n") / F.count("campaign")).alias("contacts_per_campaign"),
        *[F.round(F.avg(rate(c)), 6).alias(f"mean_{n}_rate") for c, n in zip(sums, ("open", "click", "reply"))],
        F.max(rate("opened")).alias("best_open_rate"), F.min(rate("opened")).alias("worst_open_rate"),
        F.count_if(big).alias("significant_campaigns"))


# --- sending settings ---------------------------------------------------------
def _limit_aggs():
    return [F.count("email_open_count").alias("contacts"),
            F.coalesce(F.sum("email_open_count"), F.lit(0)).alias("total_opens"),
            half_even(F.avg("email_open_count"), 3).alias("avg_opens"),
            half_even(F.stddev("email_open_count"), 3).alias("opens_std")]


_LIMIT_SQL = """count(email_open_count) AS contacts,
  CAST(coalesce(sum(email_open_count), 0) AS BIGINT) AS total_opens,
  round_even(avg(email_open_count), 3) AS avg_opens, round_even(stddev(email_open_count), 3) AS opens_std"""
_BUCKET_SQL = sql_ladder("daily_limit", K.DAILY_LIMIT_LEVELS, "Unknown")


@query("agg_21_daily_limit_bucket", on_contacts(f"""SELECT daily_limit_bucket, {_LIMIT_SQL},
  round_even(avg(daily_limit), 3) AS avg_limit, min(daily_limit) AS min_limit, max(daily_limit) AS max_limit,
  round(sum(email_open_count) / CAST(count(email_open_count) AS DOUBLE), 6) AS open_rate
  FROM (SELECT *, {_BUCKET_SQL} AS daily_limit_bucket FROM contacts) GROUP BY daily_limit_bucket"""))
def daily_limit_bucket(t: Tables) -> DataFrame:
    df = t.contacts("daily_limit", "email_open_count").withColumn("daily_limit_bucket", C.daily_limit_bucket(F.col("daily_limit")))
    return df.groupBy("daily_limit_bucket").agg(
        *_limit_aggs(), half_even(F.avg("daily_limit"), 3).alias("avg_limit"), F.min("daily_limit").alias("min_limit"),
        F.max("daily_limit").alias("max_limit"),
        F.round(F.sum("email_open_count") / F.count("email_open_count"), 6).alias("open_rate"))


_LIMITS_CTE = f"""limits AS (SELECT daily_limit, {_LIMIT_SQL},
  round(sum(email_open_count) / CAST(count(email_open_count) AS DOUBLE), 6) AS open_rate
  FROM contacts WHERE daily_limit IS NOT NULL GROUP BY daily_limit HAVING count(email_open_count) >= 10)"""


@query("agg_22_daily_limit_values", on_contacts("""(SELECT 'best' AS side, * FROM limits
  ORDER BY open_rate DESC, daily_limit LIMIT 10) UNION ALL
  (SELECT 'worst' AS side, * FROM limits ORDER BY open_rate, daily_limit LIMIT 5)""", _LIMITS_CTE))
def daily_limit_values(t: Tables) -> DataFrame:
    limits = (t.contacts("daily_limit", "email_open_count").filter("daily_limit IS NOT NULL").groupBy("daily_limit")
              .agg(*_limit_aggs(), F.round(F.sum("email_open_count") / F.count("email_open_count"), 6).alias("open_rate"))
              .filter("contacts >= 10"))
    best = kpi.top(limits, "open_rate", 10, ["daily_limit"]).withColumn("side", F.lit("best"))
    worst = kpi.top(limits, "open_rate", 5, ["daily_limit"], descending=False).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


_BY_SQL = """SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(daily_limit) AS contacts,
  round_even(avg(daily_limit), 3) AS avg_limit, round_even(stddev(daily_limit), 3) AS limit_std,
  round_even(avg(email_open_count), 3) AS avg_opens FROM segments WHERE daily_limit IS NOT NULL AND {d} IS NOT NULL
  GROUP BY {d} HAVING count(daily_limit) >= {n}"""


@query("agg_23_daily_limit_by_setting", on_segments(" UNION ALL ".join(
    _BY_SQL.format(d=d, n=n) for d, n in (("upload_method", 0), ("esp_code", 100), ("company_size", 0)))))
def daily_limit_by_setting(t: Tables) -> DataFrame:
    least = {"upload_method": 0, "esp_code": 100, "company_size": 0}
    df = segments(t, "daily_limit", *least).filter("daily_limit IS NOT NULL")
    return (kpi.long_form(df, [*least], ["daily_limit", "email_open_count"]).groupBy("dimension", "value")
            .agg(F.count("daily_limit").alias("contacts"), half_even(F.avg("daily_limit"), 3).alias("avg_limit"),
                 half_even(F.stddev("daily_limit"), 3).alias("limit_std"),
                 half_even(F.avg("email_open_count"), 3).alias("avg_opens"))
            .filter(F.col("contacts") >= lookup(F.col("dimension"), least)))


# --- company age and size -------------------------------------------------------
def performance_table(df: DataFrame, key: str, median_of: str, name: str) -> DataFrame:
    """Counts, opens with spread, true rates and a median per category.

    The median column holds whole numbers of a bounded range (ages, head counts),
    so the exact percentile keeps at most one counter per distinct number.
    """
    return df.groupBy(key).agg(
        F.count("*").alias("contacts"),
        F.coalesce(F.sum("email_open_count"), F.lit(0)).alias("total_opens"),
        half_even(F.avg("email_open_count"), 3).alias("avg_opens"),
        half_even(F.stddev("email_open_count"), 3).alias("std_opens"),
        half_even(F.avg("email_click_count"), 3).alias("avg_clicks"),
        half_even(F.avg("email_reply_count"), 3).alias("avg_replies"),
        F.round(F.avg(flag(F.col("email_open_count") > 0)), 6).alias("open_rate"),
        F.round(F.avg(flag(F.col("email_click_count") > 0)), 6).alias("click_rate"),
        F.round(F.avg(flag(F.col("email_reply_count") > 0)), 6).alias("reply_rate"),
        F.percentile(median_of, F.lit(0.5)).alias(name))


def performance_sql(key: str, expr: str, median_of: str, name: str) -> str:
    return f"""SELECT {key}, count(*) AS contacts, CAST(coalesce(sum(email_open_count), 0) AS BIGINT) AS total_opens,
  round_even(avg(email_open_count), 3) AS avg_opens, round_even(stddev(email_open_count), 3) AS std_opens,
  round_even(avg(email_click_count), 3) AS avg_clicks, round_even(avg(email_reply_count), 3) AS avg_replies,
  round(avg(opened), 6) AS open_rate, round(avg(clicked), 6) AS click_rate, round(avg(replied), 6) AS reply_rate,
  CAST(quantile_cont({median_of}, 0.5) AS DOUBLE) AS {name}
  FROM (SELECT *, {expr} AS {key} FROM segments) GROUP BY {key}"""


_YEAR = K.AS_OF.year
AGE_SQL = (f"CASE WHEN {_YEAR} - organization_founded_year < 0 THEN 'Invalid' ELSE "
           + sql_ladder(f"({_YEAR} - organization_founded_year)", K.COMPANY_AGE_LEVELS, "Unknown") + " END")
ERA_SQL = sql_ladder("organization_founded_year", K.BUSINESS_ERAS, "Unknown", "<")


@query("agg_24_company_age", on_segments(performance_sql(
    "company_age_category", AGE_SQL, f"{_YEAR} - organization_founded_year", "median_age")))
def company_age(t: Tables) -> DataFrame:
    df = t.contacts("organization_founded_year", *K.ENGAGEMENT_COUNTS).withColumns({
        "company_age_category": C.company_age_category(F.col("organization_founded_year"), K.AS_OF),
        "company_age": F.lit(_YEAR) - F.col("organization_founded_year")})
    return performance_table(df, "company_age_category", "company_age", "median_age")


@query("agg_25_founding_decade", on_segments(performance_sql(
    "decade", "CAST(floor(organization_founded_year / 10.0) * 10 AS BIGINT)", "organization_founded_year",
    "median_year") + " HAVING count(*) >= 10 AND decade >= 1900"))
def founding_decade(t: Tables) -> DataFrame:
    decade = (F.floor(F.col("organization_founded_year") / 10) * 10).cast("bigint")
    table = performance_table(t.contacts("organization_founded_year", *K.ENGAGEMENT_COUNTS).withColumn("decade", decade), "decade", "organization_founded_year",
                              "median_year")
    return table.filter("contacts >= 10 AND decade >= 1900")


@query("agg_26_business_era", on_segments(performance_sql(
    "business_era", ERA_SQL, "organization_founded_year", "median_year") + " HAVING count(*) >= 10"))
def business_era(t: Tables) -> DataFrame:
    df = t.contacts("organization_founded_year", *K.ENGAGEMENT_COUNTS).withColumn("business_era", C.business_era(F.col("organization_founded_year")))
    return performance_table(df, "business_era", "organization_founded_year", "median_year").filter("contacts >= 10")


@query("agg_27_employee_level", on_segments(performance_sql(
    "employee_level", sql_ladder("organization_employees", K.EMPLOYEE_LEVELS, "Unknown"), "organization_employees",
    "median_employees")))
def employee_level(t: Tables) -> DataFrame:
    df = t.contacts("organization_employees", *K.ENGAGEMENT_COUNTS).withColumn("employee_level", C.employee_level(F.col("organization_employees")))
    return performance_table(df, "employee_level", "organization_employees", "median_employees")


@query("agg_27_employee_range", on_segments(performance_sql(
    "employee_range", sql_cut("organization_employees", *K.EMPLOYEE_RANGE_BINS), "organization_employees",
    "median_employees") + " HAVING count(*) >= 10 AND employee_range IS NOT NULL"))
def employee_range(t: Tables) -> DataFrame:
    df = t.contacts("organization_employees", *K.ENGAGEMENT_COUNTS).withColumn("employee_range", cut(F.col("organization_employees"), *K.EMPLOYEE_RANGE_BINS))
    table = performance_table(df, "employee_range", "organization_employees", "median_employees")
    return table.filter("contacts >= 10 AND employee_range IS NOT NULL")


# --- mail provider, result page, status --------------------------------------
ESP_SQL = ("CASE " + " ".join(f"WHEN esp_code IN ({', '.join(map(str, c))}) THEN '{n}'" for c, n in K.ESP_LABELS)
           + f" ELSE {sql_ladder('esp_code', K.ESP_RANGES, K.ESP_RANGES[-1][1])} END")
_OPENS_SQL = """count(email_open_count) AS contacts, CAST(coalesce(sum(email_open_count), 0) AS BIGINT) AS total_opens,
  round_even(avg(email_open_count), 3) AS avg_opens"""


@query("agg_28_esp_code", on_contacts(f"SELECT esp_code, {_OPENS_SQL} FROM contacts GROUP BY esp_code"))
def esp_code(t: Tables) -> DataFrame:
    return kpi.opens_by(t.contacts("esp_code", "email_open_count"), ["esp_code"], 3)


@query("agg_28_esp_category", on_contacts(f"SELECT {ESP_SQL} AS esp_category, {_OPENS_SQL} FROM contacts GROUP BY 1"))
def esp_category(t: Tables) -> DataFrame:
    return kpi.opens_by(t.contacts("esp_code", "email_open_count"), [C.esp_category(F.col("esp_code")).alias("esp_category")], 3)


_PAGES_CTE = """pages_table AS (SELECT page_retrieved, count(email_open_count) AS contacts,
  CAST(coalesce(sum(email_open_count), 0) AS BIGINT) AS total_opens,
  round_even(CAST(sum(email_open_count) AS DOUBLE) / nullif(count(email_open_count), 0) * 100, 2) AS open_rate
  FROM contacts GROUP BY page_retrieved)"""


def page_table(df: DataFrame) -> DataFrame:
    return df.groupBy("page_retrieved").agg(
        F.count("email_open_count").alias("contacts"),
        F.coalesce(F.sum("email_open_count"), F.lit(0)).alias("total_opens"),
        half_even(safe_ratio(F.sum("email_open_count"), F.count("email_open_count")) * 100, 2).alias("open_rate"))


@query("agg_29_result_page", on_contacts("""SELECT *,
  CASE WHEN contacts > 0 THEN round(open_rate * ln(contacts), 6) END AS efficiency_score FROM pages_table""",
                                         _PAGES_CTE))
def result_page(t: Tables) -> DataFrame:
    return page_table(t.contacts("page_retrieved", "email_open_count")).withColumn(
        "efficiency_score", F.when(F.col("contacts") > 0, F.round(F.col("open_rate") * F.ln("contacts"), 6)))


@query("agg_29_result_page_category", on_contacts(
    f"SELECT {sql_cut('page_retrieved', *K.PAGE_BINS, lowest=False)} AS page_category, {_OPENS_SQL} "
    "FROM contacts GROUP BY 1"))
def result_page_category(t: Tables) -> DataFrame:
    category = cut(F.col("page_retrieved"), *K.PAGE_BINS, lowest=False)
    return kpi.opens_by(t.contacts("page_retrieved", "email_open_count"), [category.alias("page_category")], 3)


_ROI = """SELECT *, round_even(open_rate * ln(contact_count), 2) AS roi_score FROM ({src}) WHERE contact_count > 0
  ORDER BY roi_score DESC, {key} LIMIT 15"""


def roi(table: DataFrame, key: str) -> DataFrame:
    scored = table.filter("contact_count > 0").withColumn(
        "roi_score", half_even(F.col("open_rate") * F.ln("contact_count"), 2))
    return kpi.top(scored, "roi_score", 15, [key])


@query("agg_30_country_roi", on_segments(_ROI.format(src=engagement_sql("country", "in_top"), key="country"),
                                         _TOP_COUNTRIES.format(n=20)))
def country_roi(t: Tables) -> DataFrame:
    return roi(country_engagement(t), "country")


@query("agg_30_seniority_roi", on_contacts(_ROI.format(src=engagement_sql("seniority", "contacts"),
                                                       key="seniority NULLS LAST")))
def seniority_roi(t: Tables) -> DataFrame:
    return roi(seniority_engagement(t), "seniority")


@query("agg_31_status", on_contacts(" UNION ALL ".join(
    f"SELECT '{c}' AS field, CAST({c} AS BIGINT) AS value, {_OPENS_SQL} FROM contacts GROUP BY {c}"
    for c in ("status", "campaign_status"))))
def status(t: Tables) -> DataFrame:
    df = t.contacts("status", "campaign_status", "email_open_count")
    table = kpi.opens_by(kpi.long_form(df, ["status", "campaign_status"], ["email_open_count"]),
                         ["dimension", "value"], 3)
    return table.select(F.col("dimension").alias("field"), F.col("value").cast("bigint").alias("value"), "contacts",
                        "total_opens", "avg_opens")


_CROSS = ", ".join(f"count(*) FILTER (WHERE campaign_status = {v}) AS \"{v}\"" for v in range(4))


@query("agg_32_status_crosstab", on_contacts(f"""SELECT CASE WHEN grouping(status) = 1 THEN 'All' ELSE CAST(status AS VARCHAR) END AS status, {_CROSS},
  count(*) FILTER (WHERE campaign_status IS NULL OR campaign_status NOT IN (0, 1, 2, 3)) AS other,
  count(*) AS total FROM contacts GROUP BY GROUPING SETS ((status), ())"""))
def status_crosstab(t: Tables) -> DataFrame:
    """Counts per status and campaign status; what is none of the four known values is counted as other."""
    known = [0, 1, 2, 3]
    cell = {str(v): F.count_if(F.col("campaign_status") == v) for v in known}
    cell["other"] = F.count_if(F.col("campaign_status").isNull() | ~F.col("campaign_status").isin(known))
    table = t.contacts("status", "campaign_status").rollup("status").agg(
        F.grouping("status").alias("all"), *[c.alias(n) for n, c in cell.items()], F.count("*").alias("total"))
    return table.select(F.when(F.col("all") == 1, "All").otherwise(F.col("status").cast("string")).alias("status"), *map(lambda n: F.col(f"`{n}`"), cell), "total")


_SENIOR_CATS = [c for c, _ in K.SENIORITY_RULES]
_SIZES = K.SIZE_BINS[1]


def _pivot_sql(rows: str, cols: str, values: list[str]) -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE {cols} = '{v}') AS \"{v}\"" for v in values)
    return f"SELECT {rows}, {cells} FROM segments WHERE {rows} IS NOT NULL GROUP BY {rows}"


def _pivot(name: str, rows: str, cols: str, values: list[str]):
    query(f"agg_33_{name}", on_segments(_pivot_sql(rows, cols, values)))(
        lambda t: kpi.pivot_counts(segments(t, rows, cols), rows, cols, values))


_pivot("size_by_seniority", "company_size", "seniority_category", _SENIOR_CATS)
_pivot("industry_by_size", "industry_category", "company_size", _SIZES)
_pivot("country_by_size", "country", "company_size", _SIZES)
_pivot("country_by_seniority", "country", "seniority_category", _SENIOR_CATS)


@query("agg_34_month_region_means", on_contacts("""SELECT strftime(timestamp_created, '%Y-%m') AS month,
  """ + ", ".join(f"round(avg(email_open_count) FILTER (WHERE region = '{r}'), 6) AS \"{r}\"" for r in (
    "AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")) + " FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1"))
def month_region_means(t: Tables) -> DataFrame:
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    df = t.contacts("timestamp_created", "region", "email_open_count").dropna(subset=["timestamp_created"]).withColumn("month", F.date_format("timestamp_created", "yyyy-MM"))
    return df.groupBy("month").pivot("region", regions).agg(F.round(F.avg("email_open_count"), 6))


@query("agg_34_weekday_setting_means", on_contacts("""SELECT dayname(timestamp_created) AS weekday,
  round(avg(email_open_count) FILTER (WHERE link_tracking), 6) AS "true",
  round(avg(email_open_count) FILTER (WHERE NOT link_tracking), 6) AS "false" FROM contacts
  WHERE timestamp_created IS NOT NULL GROUP BY 1"""))
def weekday_setting_means(t: Tables) -> DataFrame:
    df = t.contacts("timestamp_created", "link_tracking", "email_open_count").dropna(subset=["timestamp_created"]).withColumn("weekday", F.date_format("timestamp_created", "EEEE"))
    return (df.groupBy("weekday").pivot("link_tracking", [True, False])
            .agg(F.round(F.avg("email_open_count"), 6)))


# --- clicks ---------------------------------------------------------------------
_CLICK_COLS = ["email_click_count", "email_clicked_step", "email_clicked_variant", "link_tracking", "list_size"]
_LIST_COUNT_SQL = f"len(regexp_extract_all(coalesce(email_list, ''), '{K.EMAIL_PATTERN}'))"
LIST_SIZE_SQL = (f"CASE WHEN {_LIST_COUNT_SQL} BETWEEN 1 AND 3 THEN 'Small Lists (1-3)' "
                 f"WHEN {_LIST_COUNT_SQL} BETWEEN 4 AND 10 THEN 'Medium Lists (4-10)' ELSE 'Large Lists (11+)' END")


@query("agg_35_click_distribution", on_contacts(" UNION ALL ".join(
    f"""SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value, count(*) AS contacts,
  round_even(avg(email_click_count), 3) AS avg_clicks,
  round(avg(CASE WHEN email_click_count > 0 THEN 1.0 ELSE 0.0 END), 6) AS click_rate,
  round(count(*) * 100.0 / (SELECT count({c}) FROM listed), 4) AS percentage
  FROM listed WHERE {c} IS NOT NULL GROUP BY {c}""" for c in _CLICK_COLS),
    f"listed AS (SELECT *, {LIST_SIZE_SQL} AS list_size FROM contacts)"))
def click_distribution(t: Tables) -> DataFrame:
    count = T.address_list_features(F.col("email_list"))["email_count"]
    df = t.contacts("email_list", *_CLICK_COLS[:-1]).withColumn("list_size", C.list_size_category(count))
    long = kpi.long_form(df, _CLICK_COLS, ["email_click_count"])
    counts = long.groupBy("dimension", "value").agg(
        F.count("*").alias("contacts"), half_even(F.avg("email_click_count"), 3).alias("avg_clicks"),
        F.round(F.avg(flag(F.col("email_click_count") > 0)), 6).alias("click_rate"))
    totals = counts.groupBy("dimension").agg(F.sum("contacts").alias("total"))
    return counts.join(totals, "dimension").select(
        "dimension", "value", "contacts", "avg_clicks", "click_rate",
        F.round(F.col("contacts") * 100.0 / F.col("total"), 4).alias("percentage"))


@query("agg_36_click_overview", on_contacts("""SELECT count(*) AS contacts,
  CAST(sum(email_click_count) AS BIGINT) AS total_clicks,
  count(*) FILTER (WHERE email_click_count > 0) AS clicking_contacts,
  round(count(*) FILTER (WHERE email_click_count > 0) / CAST(count(*) AS DOUBLE), 6) AS click_rate,
  round(sum(email_click_count) / CAST(count(*) AS DOUBLE), 6) AS clicks_per_contact,
  round(sum(email_click_count) / CAST(count(*) FILTER (WHERE email_click_count > 0) AS DOUBLE), 6) AS clicks_per_clicker
  FROM contacts"""))
def click_overview(t: Tables) -> DataFrame:
    clickers = F.count_if(F.col("email_click_count") > 0)
    clicks = F.sum("email_click_count")
    return t.contacts("email_click_count").agg(
        F.count("*").alias("contacts"), clicks.alias("total_clicks"), clickers.alias("clicking_contacts"),
        F.round(clickers / F.count("*"), 6).alias("click_rate"),
        F.round(clicks / F.count("*"), 6).alias("clicks_per_contact"),
        F.round(safe_ratio(clicks, clickers), 6).alias("clicks_per_clicker"))


@query("agg_37_link_tracking_impact", on_contacts("""SELECT
  count(*) FILTER (WHERE link_tracking) AS contacts_on, count(*) FILTER (WHERE NOT link_tracking) AS contacts_off,
  round(avg(email_open_count) FILTER (WHERE link_tracking), 6) AS avg_opens_on,
  round(avg(email_open_count) FILTER (WHERE NOT link_tracking), 6) AS avg_opens_off,
  round(count(*) FILTER (WHERE link_tracking AND email_open_count > 0) / CAST(count(*) FILTER (WHERE link_tracking) AS DOUBLE), 6) AS open_rate_on,
  round(count(*) FILTER (WHERE NOT link_tracking AND email_open_count > 0) / CAST(count(*) FILTER (WHERE NOT link_tracking) AS DOUBLE), 6) AS open_rate_off,
  round((avg(email_open_count) FILTER (WHERE link_tracking) - avg(email_open_count) FILTER (WHERE NOT link_tracking))
    / avg(email_open_count) FILTER (WHERE NOT link_tracking) * 100, 4) AS impact_pct FROM contacts"""))
def link_tracking_impact(t: Tables) -> DataFrame:
    on, off = F.col("link_tracking"), ~F.col("link_tracking")

    def mean(side):
        return F.avg(F.when(side, F.col("email_open_count")))

    def rate(side):
        return F.round(F.count_if(side & (F.col("email_open_count") > 0)) / F.count_if(side), 6)

    return t.contacts("link_tracking", "email_open_count").agg(
        F.count_if(on).alias("contacts_on"), F.count_if(off).alias("contacts_off"),
        F.round(mean(on), 6).alias("avg_opens_on"), F.round(mean(off), 6).alias("avg_opens_off"),
        rate(on).alias("open_rate_on"), rate(off).alias("open_rate_off"),
        F.round((mean(on) - mean(off)) / mean(off) * 100, 4).alias("impact_pct"))
