"""Data-quality, profile and statistics reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import text as T
from leadmill.functions.expr import flag, half_even
from leadmill.operators import kpi
from leadmill.operators import quality as Q
from leadmill.operators import stats as ST
from leadmill.operators.quantiles import bounded_quantiles, exact_quantiles, with_row
from leadmill.plans.registry import AS_OF_SQL, on_contacts, query, quoted, sql_cut, sql_days
from leadmill.sources.tables import Tables

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for reports."""
    return df.withColumns({f.name: F.round(f.name, places) for f in df.schema if f.dataType.typeName() == "double"})


# --- profiles --------------------------------------------------------------------
_PROFILED = ["email", "campaign", "company_domain", "title", "seniority", "status_summary", "timestamp_last_click",
             "timestamp_last_interest_change", "organization_employees", "employment_history", "functions_text"]


@query("dq_08_missing_profile", on_contacts(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing, round((count(*) - count({c})) * 100.0 / count(*), 6) AS missing_pct,
  CASE WHEN (count(*) - count({c})) * 100.0 / count(*) > 50 THEN 'high' WHEN (count(*) - count({c})) * 100.0 / count(*) > 10 THEN 'moderate' ELSE 'low' END AS level FROM contacts"""
    for c in _PROFILED)))
def missing_profile(t: Tables) -> DataFrame:
    return rounded(Q.missing_profile(t.contacts(*_PROFILED)))


@query("dq_08_missing_summary", on_contacts("SELECT round(avg(p), 6) AS avg_missing_pct, count(*) FILTER (WHERE p > 50) AS high_missing, "
    "count(*) FILTER (WHERE p > 10 AND p <= 50) AS moderate_missing FROM (" + " UNION ALL ".join(
        f"SELECT (count(*) - count({c})) * 100.0 / count(*) AS p FROM contacts" for c in _PROFILED) + ")"))
def missing_summary(t: Tables) -> DataFrame:
    return Q.missing_profile(t.contacts(*_PROFILED)).agg(
        F.round(F.avg("missing_pct"), 6).alias("avg_missing_pct"), F.count_if(F.col("level") == "high").alias("high_missing"),
        F.count_if(F.col("level") == "moderate").alias("moderate_missing"))


@query("dq_10_cell_quality", on_contacts(
    f"SELECT count(*) AS rows, {len(_PROFILED)} AS columns, round(({' + '.join(f'count({c})' for c in _PROFILED)}) * 100.0 / "
    f"(count(*) * {len(_PROFILED)}), 6) AS quality_pct FROM contacts"))
def cell_quality(t: Tables) -> DataFrame:
    return rounded(Q.cell_quality(t.contacts(*_PROFILED)))


_CARDINAL = ["campaign", "title", "country", "city", "email_list", "assigned_to"]


@query("agg_40_distinct_profile", on_contacts(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values, count({c}) AS non_null,
  count(*) - count({c}) AS missing, count(DISTINCT {c}) > 50 AS high_cardinality FROM contacts""" for c in _CARDINAL)))
def distinct_profile(t: Tables) -> DataFrame:
    return Q.distinct_profile(t.contacts(*_CARDINAL), _CARDINAL)


@query("agg_40_distinct_estimate")
def distinct_estimate(t: Tables) -> DataFrame:
    return Q.distinct_profile(t.contacts(*_CARDINAL), _CARDINAL, approximate=True)


@query("agg_41_value_counts", on_contacts("""SELECT title, rows, round(rows * 100.0 / (SELECT count(*) FROM contacts), 2) AS percentage
  FROM (SELECT title, count(*) AS rows FROM contacts GROUP BY title) WHERE title IS NOT NULL ORDER BY rows DESC, title LIMIT 20"""))
def value_counts(t: Tables) -> DataFrame:
    return kpi.top(kpi.share_of_total(t.contacts("title"), "title").filter("title IS NOT NULL"), "rows", 20, ["title"])


def _describe_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS std,
  CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum, round(skewness({c}), 6) AS skewness,
  round(kurtosis({c}), 6) AS kurtosis, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
  round(quantile_cont({c}, 0.75), 6) AS q3, round(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 6) AS iqr,
  abs(avg({c}) - quantile_cont({c}, 0.5)) > stddev({c}) * 0.5 AS mean_far_from_median FROM {table}""" for c in columns)


@query("sta_01_moments", _describe_sql("lineitem", LINE))
def moments(t: Tables) -> DataFrame:
    return rounded(ST.describe(t.lineitem.select(*LINE), LINE))


_COUNTED = ["email_open_count", "email_click_count", "daily_limit", "organization_employees"]


@query("agg_42_describe_contacts", on_contacts(_describe_sql("contacts", _COUNTED)))
def describe_contacts(t: Tables) -> DataFrame:
    return rounded(ST.describe(t.contacts(*_COUNTED), _COUNTED))


@query("sta_02_mean_median_gap", f"""SELECT event_type, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median,
  abs(avg(value) - quantile_cont(value, 0.5)) > stddev(value) * 0.5 AS far FROM events GROUP BY event_type""")
def mean_median_gap(t: Tables) -> DataFrame:
    events = t.events.select("event_type", "value")
    marks = exact_quantiles(events, ["value"], [0.5], ["event_type"]).select("event_type", F.col("q0").alias("median"))
    means = events.groupBy("event_type").agg(F.avg("value").alias("mean"), F.stddev("value").alias("s"))
    return means.join(marks, "event_type").select(
        "event_type", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"),
        (F.abs(F.col("mean") - F.col("median")) > F.col("s") * 0.5).alias("far"))


@query("sta_03_correlations", " UNION ALL ".join(
    f"""SELECT '{a}' AS "left", '{b}' AS "right", round(corr({a}, {b}), 6) AS correlation FROM lineitem"""
    for i, a in enumerate(LINE) for b in LINE[i + 1:]))
def correlations(t: Tables) -> DataFrame:
    return rounded(ST.correlations(t.lineitem.select(*LINE), LINE))


_AGES = ["company_age", "email_open_count", "email_click_count", "email_reply_count"]


@query("sta_03_company_age_correlation", on_contacts(" UNION ALL ".join(
    f"""SELECT '{c}' AS metric, round(r, 6) AS correlation, CASE WHEN abs(r) < 0.1 THEN 'Very weak' WHEN abs(r) < 0.3 THEN 'Weak'
  WHEN abs(r) < 0.5 THEN 'Moderate' ELSE 'Strong' END AS strength FROM (SELECT corr({K.AS_OF.year} - organization_founded_year, {c}) AS r FROM contacts)"""
    for c in _AGES[1:])))
def company_age_correlation(t: Tables) -> DataFrame:
    from leadmill.functions.categories import correlation_label

    df = t.contacts("organization_founded_year", *K.ENGAGEMENT_COUNTS).withColumn(
        "company_age", F.lit(K.AS_OF.year) - F.col("organization_founded_year"))
    table = ST.correlations(df, _AGES).filter("left = 'company_age'")
    return table.select(F.col("right").alias("metric"), F.round("correlation", 6).alias("correlation"),
                        correlation_label(F.col("correlation")).alias("strength"))


_TEST_SQL = """SELECT *, p_value < 0.05 AS significant,
  CASE WHEN abs(cohens_d) < 0.2 THEN 'Small' WHEN abs(cohens_d) < 0.5 THEN 'Medium' ELSE 'Large' END AS effect FROM (
  SELECT n_on, n_off, round(m1, 6) AS mean_on, round(m2, 6) AS mean_off, round(t, 6) AS t_statistic,
  round((m1 - m2) / sqrt(s), 6) AS cohens_d,
  round(1 - 2 * (abs(t) / 2000) / 3 * (SELECT sum((CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
    * exp(lgamma((f + 1) / 2) - lgamma(f / 2)) / sqrt(f * pi()) * pow(1 + pow(i * abs(t) / 2000, 2) / f, -(f + 1) / 2))
    FROM range(2001) r(i)), 6) AS p_value FROM (
  SELECT *, (m1 - m2) / sqrt(s * (1.0 / n_on + 1.0 / n_off)) AS t, CAST(n_on + n_off - 2 AS DOUBLE) AS f FROM (
  SELECT *, ((n_on - 1) * v1 + (n_off - 1) * v2) / (n_on + n_off - 2) AS s FROM (
  SELECT count(email_open_count) FILTER (WHERE link_tracking) AS n_on, count(email_open_count) FILTER (WHERE NOT link_tracking) AS n_off,
    avg(email_open_count) FILTER (WHERE link_tracking) AS m1, avg(email_open_count) FILTER (WHERE NOT link_tracking) AS m2,
    var_samp(email_open_count) FILTER (WHERE link_tracking) AS v1, var_samp(email_open_count) FILTER (WHERE NOT link_tracking) AS v2
  FROM contacts))))"""


@query("sta_04_05_two_sample_test", on_contacts(_TEST_SQL))
def two_sample_test(t: Tables) -> DataFrame:
    df = t.contacts("link_tracking", "email_open_count").filter("email_open_count IS NOT NULL")
    return rounded(ST.two_sample(df, F.col("link_tracking"), "email_open_count"))


@query("sta_06_histogram", """SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 30), 29) AS BIGINT) AS bin, count(*) AS rows
  FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) GROUP BY 1""")
def histogram(t: Tables) -> DataFrame:
    return ST.histogram(t.lineitem.select("l_extendedprice"), "l_extendedprice", 30)


@query("sta_07_box_plot", """SELECT l_returnflag, min(l_extendedprice) AS minimum, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3,
  max(l_extendedprice) AS maximum FROM lineitem GROUP BY l_returnflag""")
def box_plot(t: Tables) -> DataFrame:
    return rounded(ST.five_numbers(t.lineitem.select("l_returnflag", "l_extendedprice"), "l_returnflag", "l_extendedprice"))


# --- outliers ----------------------------------------------------------------------
_FENCE = """SELECT {cols} FROM lineitem"""


def _fence_cte(columns: list[str]) -> str:
    marks = ", ".join(f"quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_lo, "
                      f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS {c}_hi, "
                      f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in columns)
    return f"WITH marks AS (SELECT {marks} FROM lineitem)"


@query("dq_04_winsorise", _fence_cte(LINE) + "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(CASE WHEN {c} < {c}_lo THEN {c}_lo WHEN {c} > {c}_hi THEN {c}_hi ELSE {c} END, 6) AS {c}" for c in LINE)
    + " FROM lineitem, marks")
def winsorise(t: Tables) -> DataFrame:
    return rounded(Q.winsorise(t.lineitem.select("l_orderkey", "l_linenumber", *LINE), LINE))


@query("dq_05_log_if_skewed", """WITH f AS (SELECT avg(value) AS m, stddev_pop(value) AS s, skewness(value) AS g, min(value) AS lo, max(value) AS hi FROM events)
  SELECT event_id, value, CASE WHEN s > 0 AND greatest(abs(lo - m), abs(hi - m)) / s > 3 AND g > 1 THEN round(ln(1 + value), 6) END AS value_log
  FROM events, f""")
def log_if_skewed(t: Tables) -> DataFrame:
    return Q.log_if_skewed(t.events.select("event_id", "value"), "value").withColumn("value_log", F.round("value_log", 6))


@query("dq_06_isolation_forest")
def isolation_forest(t: Tables) -> DataFrame:
    scored = Q.isolation_scores(t.events.select("event_id", "value"), "value", "event_id")
    return scored.withColumn("is_outlier", F.col("isolation_score") > 0.5)


@query("dq_06_tree_samples", """WITH n AS (SELECT least(count(value), 25600) AS n FROM events), d AS (SELECT n, greatest(n // 256, 1) AS decks FROM n)
  SELECT 100 AS trees, n // decks AS smallest, (n + decks - 1) // decks AS largest, 0 AS repeated FROM d""")
def tree_samples(t: Tables) -> DataFrame:
    """How many rows the trees are grown from, and how many a tree has twice."""
    dealt = Q.tree_samples(t.events.select("event_id", "value"), "value", "event_id")
    sizes = dealt.groupBy("tree").agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("ids"))
    return sizes.agg(F.count("*").alias("trees"), F.min("rows").alias("smallest"), F.max("rows").alias("largest"), F.sum(F.col("rows") - F.col("ids")).alias("repeated"))


@query("dq_07_outlier_report", _fence_cte(LINE) + " UNION ALL ".join(
    f"""SELECT *, CASE WHEN zscore_outliers < iqr_outliers THEN 'zscore' ELSE 'iqr' END AS method FROM (
  SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < {c}_lo OR {c} > {c}_hi) AS iqr_outliers,
  count(*) FILTER (WHERE {c}_s > 0 AND abs({c} - {c}_m) / {c}_s > 3) AS zscore_outliers, count({c}) AS total_records
  FROM lineitem, marks)""" for c in LINE))
def outlier_report(t: Tables) -> DataFrame:
    return Q.outlier_report(t.lineitem.select(*LINE), LINE)


@query("dq_07_event_outliers", """WITH m AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, avg(value) AS v, stddev_pop(value) AS s FROM events)
  SELECT *, CASE WHEN zscore_outliers < iqr_outliers THEN 'zscore' ELSE 'iqr' END AS method FROM (
  SELECT 'value' AS "column", count(*) FILTER (WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) AS iqr_outliers,
  count(*) FILTER (WHERE abs(value - v) / s > 3) AS zscore_outliers, count(value) AS total_records FROM events, m)""")
def event_outliers(t: Tables) -> DataFrame:
    return Q.outlier_report(t.events.select("value"), ["value"])


# --- clipping, imputation, duplicates -----------------------------------------------
_CLIP = ["days_since_creation", "email_open_count", "email_click_count", "email_reply_count"]
_CLIP_CTE = f"""dated AS (SELECT id, email_open_count, email_click_count, email_reply_count,
  {sql_days(AS_OF_SQL, 'timestamp_created')} AS days_since_creation FROM contacts), """


def _clip_sql(columns: list[str], low: float | None, high: float) -> str:
    def one(c: str) -> str:
        hi = f"(SELECT quantile_cont({c}, {high}) FROM dated)"
        if low is None:
            return f"least({c}, {hi})"
        lo = f"(SELECT quantile_cont({c}, {low}) FROM dated)"
        return f"CASE WHEN {hi} > {lo} THEN greatest(least({c}, {hi}), {lo}) ELSE {c} END"
    return "SELECT id, " + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN round(CAST({one(c)} AS DOUBLE), 6) END AS {c}" for c in columns) + " FROM dated"


def _dated(t: Tables) -> DataFrame:
    from leadmill.functions.dates import ages

    df = t.contacts("id", "timestamp_created", *K.ENGAGEMENT_COUNTS)
    return df.withColumn("days_since_creation", ages(F.col("timestamp_created"), K.AS_OF)["days_since_creation"]).drop("timestamp_created")


@query("dq_02_clip_extremes", on_contacts(_clip_sql(_CLIP, 0.01, 0.99), _CLIP_CTE.rstrip(", ")))
def clip_extremes(t: Tables) -> DataFrame:
    return rounded(Q.clip_extremes(_dated(t), _CLIP)).select("id", *_CLIP)


@query("dq_03_upper_caps", on_contacts(_clip_sql(_CLIP[1:], None, 0.95), _CLIP_CTE.rstrip(", ")))
def upper_caps(t: Tables) -> DataFrame:
    return rounded(Q.cap_upper(_dated(t), _CLIP[1:])).select("id", *_CLIP[1:])


@query("dq_03_document_length_cap", """SELECT doc_id, round(CAST(least(length(text), (SELECT quantile_cont(length(text), 0.95) FROM documents)) AS DOUBLE), 6) AS text_length
  FROM documents""")
def document_length_cap(t: Tables) -> DataFrame:
    df = t.documents.select("doc_id", F.length("text").alias("text_length"))
    return rounded(Q.cap_upper(df, ["text_length"]))


@query("dq_09_impute", on_contacts("""SELECT id, round(CAST(coalesce(organization_employees, (SELECT quantile_cont(organization_employees, 0.5) FROM contacts)) AS DOUBLE), 6) AS organization_employees,
  round(CAST(coalesce(email_open_count, (SELECT quantile_cont(email_open_count, 0.5) FROM contacts)) AS DOUBLE), 6) AS email_open_count,
  coalesce(title, (SELECT title FROM contacts WHERE title IS NOT NULL GROUP BY title ORDER BY count(*) DESC, title LIMIT 1)) AS title,
  coalesce(country, (SELECT country FROM contacts WHERE country IS NOT NULL GROUP BY country ORDER BY count(*) DESC, country LIMIT 1)) AS country
  FROM contacts"""))
def impute(t: Tables) -> DataFrame:
    df = t.contacts("id", "organization_employees", "email_open_count", "title", "country")
    return rounded(Q.impute(df, ["organization_employees", "email_open_count"], ["title", "country"]))


@query("win_28_newest_per_key", on_contacts("""SELECT email, campaign, id FROM (SELECT *, row_number() OVER (PARTITION BY email, campaign
  ORDER BY timestamp_created DESC NULLS LAST, id DESC) AS place FROM contacts) WHERE place = 1"""))
def newest_per_key(t: Tables) -> DataFrame:
    df = t.contacts("id", "email", "campaign", "timestamp_created")
    return Q.latest_per_key(df, ["email", "campaign"], [F.col("timestamp_created"), F.col("id")]).select("email", "campaign", "id")


@query("win_28_oldest_per_key", on_contacts("""SELECT email, campaign, id FROM (SELECT *, row_number() OVER (PARTITION BY email, campaign
  ORDER BY timestamp_created NULLS FIRST, id) AS place FROM contacts) WHERE place = 1"""))
def oldest_per_key(t: Tables) -> DataFrame:
    df = t.contacts("id", "email", "campaign", "timestamp_created")
    return Q.latest_per_key(df, ["email", "campaign"], [F.col("timestamp_created"), F.col("id")], newest=False
                            ).select("email", "campaign", "id")


@query("win_29_distinct_rows", "SELECT DISTINCT user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS level FROM events")
def distinct_rows(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type", F.floor(F.col("value") / 10).alias("level")).dropDuplicates()


@query("win_29_distinct_texts", "SELECT lang, count(*) AS rows, count(DISTINCT text) AS texts, count(*) - count(DISTINCT text) AS removed FROM documents GROUP BY lang")
def distinct_texts(t: Tables) -> DataFrame:
    # whole texts decide equality; a digest of the text keeps the exchange small
    keyed = t.documents.select("lang", F.sha2("text", 256).alias("digest"), F.length("text").alias("n"))
    per_text = keyed.groupBy("lang", "digest", "n").agg(F.count("*").alias("copies"))
    return per_text.groupBy("lang").agg(F.sum("copies").alias("rows"), F.count("*").alias("texts"),
                                        (F.sum("copies") - F.count("*")).alias("removed"))


# --- rules ------------------------------------------------------------------------------
_EMAIL_OK = "regexp_full_match(email, '" + K.EMAIL_PATTERN + "')"
_RULES_SQL = {
    "email present": "email IS NOT NULL", "campaign present": "campaign IS NOT NULL",
    "created present": "timestamp_created IS NOT NULL", "email format": _EMAIL_OK,
    "company name length": "length(company_name) <= 100", "title length": "length(title) <= 200",
    "employees in range": "organization_employees BETWEEN 1 AND 1000000",
    "revenue is numeric": "TRY_CAST(company_revenue AS DOUBLE) IS NOT NULL OR company_revenue IS NULL",
}


@query("dq_15_config_rules", on_contacts(" UNION ALL ".join(
    f"SELECT '{n}' AS rule, count(*) FILTER (WHERE NOT ({c})) AS violations, count(*) AS checked, count(*) FILTER (WHERE NOT ({c})) = 0 AS passed FROM contacts"
    for n, c in _RULES_SQL.items())))
def config_rules(t: Tables) -> DataFrame:
    c = F.col
    rules = {
        "email present": c("email").isNotNull(), "campaign present": c("campaign").isNotNull(),
        "created present": c("timestamp_created").isNotNull(), "email format": c("email").rlike(f"^{K.EMAIL_PATTERN}$"),
        "company name length": F.length("company_name") <= 100, "title length": F.length("title") <= 200,
        "employees in range": c("organization_employees").between(1, 1_000_000),
        "revenue is numeric": c("company_revenue").try_cast("double").isNotNull() | c("company_revenue").isNull(),
    }
    needed = ("email", "campaign", "timestamp_created", "company_name", "title", "organization_employees", "company_revenue")
    return Q.violations(t.contacts(*needed), rules)


_WANTED = ["id", "email", "campaign", "timestamp_created", "email_open_count", "seniority", "country", "it_interest_status", "job_title"]
_HAVE = ["id", "email", "campaign", "timestamp_created", "email_open_count", "seniority", "country", "city"]


@query("set_02_schema_diff", on_contacts("""SELECT coalesce(h.c, w.c) AS "column", CASE WHEN h.c IS NULL THEN 'missing' WHEN w.c IS NULL THEN 'extra' ELSE 'common' END AS state
  FROM (SELECT column_name AS c FROM (DESCRIBE SELECT {h} FROM contacts)) h FULL JOIN (SELECT unnest([{w}]) AS c) w ON h.c = w.c""".format(
    h=", ".join(_HAVE), w=", ".join(map(quoted, _WANTED)))))
def schema_diff(t: Tables) -> DataFrame:
    return Q.schema_diff(t.contacts(*_HAVE), _WANTED)


@query("dq_16_schema_status", on_contacts("SELECT 7 AS common, 2 AS missing, 1 AS extra, round(700.0 / 9, 6) AS coverage_pct, 'FAILED' AS status"))
def schema_status(t: Tables) -> DataFrame:
    return rounded(Q.schema_status(Q.schema_diff(t.contacts(*_HAVE), _WANTED)))


@query("dq_17_quality_dimensions", """WITH m AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
  SELECT *, completeness >= 0.95 AS complete, uniqueness >= 0.95 AS unique, age_hours <= 24 AS timely, anomaly_share <= 0.1 AS regular FROM (
  SELECT round((count(event_id) + count(ts) + count(user_id) + count(value)) / (count(*) * 4.0), 6) AS completeness, count(*) AS rows,
  round((epoch(TIMESTAMP '2024-03-01') - floor(epoch(max(ts)))) / 3600, 6) AS age_hours,
  round(count(*) FILTER (WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) / CAST(count(*) AS DOUBLE), 6) AS anomaly_share,
  round(count(DISTINCT event_id) / CAST(count(*) AS DOUBLE), 6) AS uniqueness FROM events, m)""")
def quality_dimensions(t: Tables) -> DataFrame:
    df = t.events.select("event_id", "ts", "user_id", "value")
    return rounded(Q.dimension_scores(df, "event_id", "ts", "value", K.AS_OF, 24))


@query("prj_04_usable_numeric", on_contacts("SELECT id, CAST(daily_limit AS DOUBLE) AS daily_limit, CAST(email_open_count AS DOUBLE) AS email_open_count FROM contacts"))
def usable_numeric(t: Tables) -> DataFrame:
    df = t.contacts("id", "title", "daily_limit", "email_open_count").withColumns({
        "always_one": F.lit(1), "never": F.lit(None).cast("double")})
    keep = Q.usable_numeric_columns(df)
    return df.select("id", *[F.col(c).cast("double").alias(c) for c in keep])


@query("prj_05_drop_sparse", on_contacts("SELECT id, email, email_clicked_step FROM contacts"))
def drop_sparse(t: Tables) -> DataFrame:
    df = t.contacts("id", "email", "email_clicked_step", "timestamp_last_interest_change")
    return Q.drop_sparse(df, protect=["email_clicked_step"])


# --- row scores -----------------------------------------------------------------------
@query("set_01_feature_ranges", on_contacts(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS total, count({c}) AS non_null, CAST(min({c}) AS DOUBLE) AS min_val, CAST(max({c}) AS DOUBLE) AS max_val FROM contacts"
    for c in ("email_open_count", "daily_limit", "organization_employees", "page_retrieved"))))
def feature_ranges(t: Tables) -> DataFrame:
    columns = ["email_open_count", "daily_limit", "organization_employees", "page_retrieved"]
    total = F.count(F.lit(1))
    table = ST.per_column(t.contacts(*columns), columns, {
        "total": lambda c: total, "non_null": F.count, "min_val": lambda c: F.min(c).cast("double"),
        "max_val": lambda c: F.max(c).cast("double")})
    return table.withColumnRenamed("column", "feature")


_ROLE_SQL = """CASE WHEN "column" LIKE 'timestamp%' OR "column" LIKE '%_at' THEN 'time' WHEN "column" LIKE 'email%' THEN 'engagement'
  WHEN "column" LIKE 'organization%' OR "column" IN ('title', 'seniority') THEN 'enrichment' ELSE 'other' END"""


@query("set_04_column_roles", on_contacts(f"""SELECT "column", {_ROLE_SQL} AS role FROM (SELECT column_name AS "column" FROM (
  DESCRIBE SELECT id, email, email_open_count, timestamp_created, inserted_at, organization_industry, title, city FROM contacts))"""))
def column_roles(t: Tables) -> DataFrame:
    table = Q.schema_table(t.contacts("id", "email", "email_open_count", "timestamp_created", "inserted_at",
                                      "organization_industry", "title", "city"))
    name = F.col("column")
    role = (F.when(name.startswith("timestamp") | name.endswith("_at"), "time").when(name.startswith("email"), "engagement")
            .when(name.startswith("organization") | name.isin("title", "seniority"), "enrichment").otherwise("other"))
    return table.select("column", role.alias("role"))
