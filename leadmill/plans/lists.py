"""Address-list and calendar reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import categories as C
from leadmill.functions import dates as D
from leadmill.functions import text as T
from leadmill.functions.expr import cut, days_between, flag, half_even, safe_ratio
from leadmill.operators import kpi
from leadmill.operators import timeseries as TS
from leadmill.operators.quantiles import exact_quantiles
from leadmill.plans.registry import AS_OF_SQL, on_contacts, query, sql_cut, sql_days, sql_ladder
from leadmill.plans.segments import AGE_SQL, LIST_SIZE_SQL
from leadmill.sources.tables import Tables

_BASE = ("timestamp_created", "email_list", *K.ENGAGEMENT_COUNTS)
_FOUND = f"regexp_extract_all(coalesce(email_list, ''), '{K.EMAIL_PATTERN}')"
LISTED_CTE = f"""listed AS (SELECT *, CAST(timestamp_created AS DATE) AS date,
  CAST(len({_FOUND}) AS BIGINT) AS email_count,
  CAST(len(list_distinct(list_transform({_FOUND}, lambda a: split_part(a, '@', 2)))) AS BIGINT) AS unique_domains,
  len(list_distinct(list_transform({_FOUND}, lambda a: split_part(a, '@', 2)))) / CAST(greatest(len({_FOUND}), 1) AS DOUBLE) AS list_diversity,
  CAST(coalesce(length(email_list), 0) AS BIGINT) AS list_length FROM contacts)"""
DAILY_CTE = LISTED_CTE + """, daily AS (SELECT *, total_opens / CAST(nullif(contacts, 0) AS DOUBLE) AS open_rate,
  total_clicks / CAST(nullif(contacts, 0) AS DOUBLE) AS click_rate FROM (SELECT date, count(email_open_count) AS contacts,
  CAST(sum(email_open_count) AS BIGINT) AS total_opens, round_even(avg(email_open_count), 3) AS avg_opens,
  CAST(sum(email_click_count) AS BIGINT) AS total_clicks, round_even(avg(email_click_count), 3) AS avg_clicks,
  CAST(sum(email_reply_count) AS BIGINT) AS total_replies, round_even(avg(email_reply_count), 3) AS avg_replies,
  count(DISTINCT email_list) AS unique_lists, round_even(avg(list_diversity), 3) AS avg_diversity
  FROM listed WHERE date IS NOT NULL GROUP BY date))"""
_LIST_WEEKS_CTE = LISTED_CTE + f""", firsts AS (SELECT email_list, min(timestamp_created) AS first_seen FROM contacts
  WHERE email_list IS NOT NULL AND timestamp_created IS NOT NULL GROUP BY email_list),
aged AS (SELECT l.*, first_seen, strftime(first_seen, '%Y-%m') AS cohort_month,
  CAST(round_even({sql_days('timestamp_created', 'first_seen')} / 7.0, 0) AS BIGINT) AS weeks_since
  FROM listed l JOIN firsts USING (email_list))"""


def listed(t: Tables, *columns: str) -> DataFrame:
    """Contacts with the features of their address list."""
    return t.contacts(*_BASE, *columns).withColumns(T.address_list_features(F.col("email_list")))


def daily(t: Tables) -> DataFrame:
    return TS.daily_metrics(listed(t))


def aged(t: Tables) -> DataFrame:
    """Contacts with the cohort month of their list and the weeks since its first contact."""
    weeks = days_between(F.col("timestamp_created"), F.col("first_seen")) / 7
    return TS.first_seen(listed(t), "email_list", "timestamp_created").dropna(subset=["first_seen"]).withColumns({
        "cohort_month": F.date_format("first_seen", "yyyy-MM"),
        "weeks_since": half_even(weeks, 0).cast("bigint")})


def _day(name: str = "date"):
    return F.col(name).cast("string").alias(name)


# --- daily series ---------------------------------------------------------------
@query("win_02_daily_metrics", on_contacts(
    "SELECT * REPLACE (CAST(date AS VARCHAR) AS date, round(open_rate, 6) AS open_rate, "
    "round(click_rate, 6) AS click_rate) FROM daily", DAILY_CTE))
def daily_metrics(t: Tables) -> DataFrame:
    return daily(t).withColumns({"date": F.col("date").cast("string"), "open_rate": F.round("open_rate", 6),
                                 "click_rate": F.round("click_rate", 6)})


def _centred_sql(n: int) -> str:
    after = (n - 1) // 2
    frame = f"(ORDER BY date ROWS BETWEEN {n - 1 - after} PRECEDING AND {after} FOLLOWING)"
    return f"CASE WHEN count(open_rate) OVER {frame} = {n} THEN round(avg(open_rate) OVER {frame}, 6) END AS open_rate_{n}d"


@query("win_03_centred_means", on_contacts(
    f"SELECT CAST(date AS VARCHAR) AS date, {_centred_sql(7)}, {_centred_sql(30)} FROM daily", DAILY_CTE))
def centred_means(t: Tables) -> DataFrame:
    return daily(t).select(_day(), *[F.round(TS.centred_mean("open_rate", "date", n), 6).alias(f"open_rate_{n}d")
                                     for n in (7, 30)])


_METHOD_DAYS_CTE = """method_days AS (SELECT CAST(timestamp_created AS DATE) AS date,
  count(*) FILTER (WHERE upload_method = 'api') AS api, count(*) FILTER (WHERE upload_method = 'manual') AS manual, count(*) AS uploads
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1),
shares AS (SELECT CAST(c.d AS DATE) AS date, coalesce(api, 0) AS api, coalesce(manual, 0) AS manual,
  coalesce(api, 0) / CAST(nullif(coalesce(uploads, 0), 0) AS DOUBLE) AS api_share,
  coalesce(manual, 0) / CAST(nullif(coalesce(uploads, 0), 0) AS DOUBLE) AS manual_share
  FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM method_days) c
  LEFT JOIN method_days m ON m.date = CAST(c.d AS DATE)),
rolled AS (SELECT *, CASE WHEN count(api_share) OVER w = 7 THEN avg(api_share) OVER w END AS api_share_7d
  FROM shares WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"""


def method_shares(t: Tables) -> DataFrame:
    """Uploads by api and by hand per day and their shares of all uploads; days without uploads are filled in."""
    counts = (t.contacts("timestamp_created", "upload_method").dropna(subset=["timestamp_created"])
              .groupBy(F.to_date("timestamp_created").alias("date"))
              .agg(*[F.count_if(F.col("upload_method") == m).alias(m) for m in ("api", "manual")], F.count("*").alias("uploads")))
    filled = TS.calendar(counts, "date").join(counts, "date", "left").na.fill(0, ["api", "manual", "uploads"])
    return filled.withColumns({f"{m}_share": safe_ratio(F.col(m), F.col("uploads")) for m in ("api", "manual")})


@query("win_04_trailing_mean", on_contacts(
    "SELECT CAST(date AS VARCHAR) AS date, round(api_share_7d, 6) AS api_share_7d FROM rolled", _METHOD_DAYS_CTE))
def trailing_mean(t: Tables) -> DataFrame:
    return method_shares(t).select(_day(), F.round(TS.rolling_mean("api_share", "date", 6, 0), 6).alias("api_share_7d"))


_SERIES_CTE = """series AS (SELECT campaign, CAST(timestamp_created AS DATE) AS date, count(*) AS contacts,
  row_number() OVER (PARTITION BY campaign ORDER BY CAST(timestamp_created AS DATE)) AS rn,
  CAST(greatest(least(7, floor(count(*) OVER (PARTITION BY campaign) / 10)), 1) AS INTEGER) AS w
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY campaign, CAST(timestamp_created AS DATE))"""


@query("win_05_06_smoothing", on_contacts("""SELECT a.campaign, CAST(a.date AS VARCHAR) AS date,
  CAST(a.contacts AS DOUBLE) AS contacts, a.w AS "window",
  round(avg(b.contacts) FILTER (WHERE b.rn > a.rn - a.w), 6) AS contacts_sma,
  round(sum(b.contacts * pow(1 - 2.0 / (a.w + 1), a.rn - b.rn)) / sum(pow(1 - 2.0 / (a.w + 1), a.rn - b.rn)), 6) AS contacts_ema
  FROM series a JOIN series b ON a.campaign = b.campaign AND b.rn <= a.rn GROUP BY ALL""", _SERIES_CTE))
def smoothing(t: Tables) -> DataFrame:
    days = (t.contacts("campaign", "timestamp_created").dropna(subset=["timestamp_created"])
            .groupBy("campaign", F.to_date("timestamp_created").alias("date")).agg(F.count("*").alias("contacts")))
    smoothed = TS.smooth(days, ["campaign"], "date", "contacts")
    return smoothed.withColumns({"date": F.col("date").cast("string"), "contacts_sma": F.round("contacts_sma", 6),
                                 "contacts_ema": F.round("contacts_ema", 6)})


@query("win_07_cumulative_pages", on_contacts("""SELECT page_retrieved,
  CAST(sum(opens) OVER w AS BIGINT) AS cumulative_opens, CAST(sum(contacts) OVER w AS BIGINT) AS cumulative_contacts,
  round(sum(opens) OVER w * 100.0 / nullif(sum(contacts) OVER w, 0), 6) AS cumulative_open_rate
  FROM (SELECT page_retrieved, count(email_open_count) AS contacts, coalesce(sum(email_open_count), 0) AS opens
    FROM contacts GROUP BY page_retrieved) WINDOW w AS (ORDER BY page_retrieved)"""))
def cumulative_pages(t: Tables) -> DataFrame:
    pages = kpi.opens_by(t.contacts("page_retrieved", "email_open_count"), ["page_retrieved"])
    so_far = Window.orderBy("page_retrieved").rowsBetween(Window.unboundedPreceding, 0)
    opens, contacts = F.sum("total_opens").over(so_far), F.sum("contacts").over(so_far)
    return pages.select("page_retrieved", opens.alias("cumulative_opens"), contacts.alias("cumulative_contacts"),
                        F.round(safe_ratio(opens * 100, contacts), 6).alias("cumulative_open_rate"))


@query("win_08_first_last_week", on_contacts("""SELECT round(early, 6) AS early, round(recent, 6) AS recent,
  round(recent - early, 6) AS trend FROM (SELECT avg(open_rate) FILTER (WHERE a <= 7) AS early,
    avg(open_rate) FILTER (WHERE b <= 7) AS recent FROM (SELECT open_rate, row_number() OVER (ORDER BY date) AS a,
    row_number() OVER (ORDER BY date DESC) AS b FROM daily))""", DAILY_CTE))
def first_last_week(t: Tables) -> DataFrame:
    row = TS.ends(daily(t), "date", "open_rate", 7)
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@query("win_09_trend_forecast", on_contacts("""SELECT round(slope, 6) AS slope, round(last_value, 6) AS last_value,
  round(last_value + 7 * slope, 6) AS forecast, round(volatility, 6) AS volatility FROM (
  SELECT regr_slope(open_rate, n) FILTER (WHERE back <= 14) AS slope, arg_max(open_rate, date) AS last_value,
    stddev(open_rate) AS volatility FROM (SELECT *, row_number() OVER (ORDER BY date) AS n,
    row_number() OVER (ORDER BY date DESC) AS back FROM daily))""", DAILY_CTE))
def trend_forecast(t: Tables) -> DataFrame:
    row = TS.recent_trend(daily(t), "date", "open_rate")
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


# --- calendar patterns ------------------------------------------------------------
def _pattern(t: Tables, key, name: str) -> DataFrame:
    return kpi.opens_by(listed(t).dropna(subset=["timestamp_created"]), [key.alias(name)], 3,
                        [half_even(F.avg("list_diversity"), 3).alias("avg_diversity")])


def _pattern_sql(key: str, name: str) -> str:
    return f"""SELECT {key} AS {name}, count(email_open_count) AS contacts,
  CAST(coalesce(sum(email_open_count), 0) AS BIGINT) AS total_opens, round_even(avg(email_open_count), 3) AS avg_opens,
  round_even(avg(list_diversity), 3) AS avg_diversity FROM listed WHERE timestamp_created IS NOT NULL GROUP BY 1"""


@query("win_10_weekday", on_contacts(f"""SELECT *, list_position([{', '.join(f"'{d}'" for d in K.WEEKDAYS)}], weekday) AS place,
  round(total_opens / CAST(contacts AS DOUBLE), 6) AS open_rate,
  weekday = (SELECT weekday FROM days ORDER BY total_opens / CAST(contacts AS DOUBLE) DESC, weekday LIMIT 1) AS is_best,
  weekday = (SELECT weekday FROM days ORDER BY total_opens / CAST(contacts AS DOUBLE), weekday LIMIT 1) AS is_worst FROM days""",
                                     LISTED_CTE + f", days AS ({_pattern_sql('dayname(timestamp_created)', 'weekday')})"))
def weekday(t: Tables) -> DataFrame:
    days = _pattern(t, F.date_format("timestamp_created", "EEEE"), "weekday").withColumn(
        "rate", F.col("total_opens") / F.col("contacts"))
    best = Window.orderBy(F.desc("rate"), "weekday")  # seven rows
    worst = Window.orderBy(F.asc("rate"), "weekday")
    place = F.array_position(F.array(*map(F.lit, K.WEEKDAYS)), F.col("weekday")).cast("int")
    return days.select("weekday", "contacts", "total_opens", "avg_opens", "avg_diversity", place.alias("place"),
                       F.round("rate", 6).alias("open_rate"), (F.row_number().over(best) == 1).alias("is_best"),
                       (F.row_number().over(worst) == 1).alias("is_worst"))


@query("win_11_month", on_contacts(_pattern_sql("month(timestamp_created)", "month"), LISTED_CTE))
def month(t: Tables) -> DataFrame:
    return _pattern(t, F.month("timestamp_created").cast("bigint"), "month")


@query("win_11_hour", on_contacts(_pattern_sql("hour(timestamp_created)", "hour"), LISTED_CTE))
def hour(t: Tables) -> DataFrame:
    return _pattern(t, F.hour("timestamp_created").cast("bigint"), "hour")


@query("win_11_weekend_effect", on_contacts("""SELECT round(weekday_rate, 6) AS weekday_rate,
  round(weekend_rate, 6) AS weekend_rate,
  round(CASE WHEN weekday_rate > 0 AND weekend_rate > 0 THEN (weekend_rate - weekday_rate) / weekday_rate * 100 ELSE 0 END, 6) AS effect_pct
  FROM (SELECT avg(email_open_count) FILTER (WHERE isodow(timestamp_created) < 6) AS weekday_rate,
    avg(email_open_count) FILTER (WHERE isodow(timestamp_created) >= 6) AS weekend_rate FROM contacts)"""))
def weekend_effect(t: Tables) -> DataFrame:
    late = F.weekday("timestamp_created") >= 5
    rates = t.contacts("timestamp_created", "email_open_count").agg(
        F.avg(F.when(~late, F.col("email_open_count"))).alias("weekday_rate"),
        F.avg(F.when(late, F.col("email_open_count"))).alias("weekend_rate"))
    a, b = F.col("weekday_rate"), F.col("weekend_rate")
    return rates.select(F.round(a, 6).alias("weekday_rate"), F.round(b, 6).alias("weekend_rate"),
                        F.round(F.when((a > 0) & (b > 0), (b - a) / a * 100).otherwise(0.0), 6).alias("effect_pct"))


@query("win_12_sunday_weeks", on_contacts("""SELECT strftime(timestamp_created, '%Y-W%U') AS week, count(*) AS contacts,
  CAST(sum(email_open_count) AS BIGINT) AS total_opens, round_even(avg(email_open_count), 2) AS avg_opens,
  count(DISTINCT email_list) AS unique_lists FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1"""))
def sunday_weeks(t: Tables) -> DataFrame:
    return (t.contacts("timestamp_created", "email_open_count", "email_list").dropna(subset=["timestamp_created"])
            .groupBy(D.sunday_week(F.col("timestamp_created")).alias("week"))
            .agg(F.count("*").alias("contacts"), F.sum("email_open_count").alias("total_opens"),
                 half_even(F.avg("email_open_count"), 2).alias("avg_opens"),
                 F.count_distinct("email_list").alias("unique_lists")))


@query("win_12_order_weeks", """SELECT strftime(o_orderdate, '%Y-W%U') AS week, count(*) AS orders,
  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def order_weeks(t: Tables) -> DataFrame:
    return t.orders.groupBy(D.sunday_week(F.col("o_orderdate")).alias("week")).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


_MONTH_SQL = """count(*) AS contacts, CAST(sum(email_open_count) AS BIGINT) AS total_opens,
  round_even(avg(email_open_count), 2) AS avg_opens, count(DISTINCT email_list) AS unique_lists,
  round_even(avg(organization_employees), 2) AS avg_company_size"""


def _monthly(df: DataFrame, *keys) -> DataFrame:
    return (df.dropna(subset=["timestamp_created"])
            .groupBy(F.date_format("timestamp_created", "yyyy-MM").alias("month"), *keys)
            .agg(F.count("*").alias("contacts"), F.sum("email_open_count").alias("total_opens"),
                 half_even(F.avg("email_open_count"), 2).alias("avg_opens"),
                 F.count_distinct("email_list").alias("unique_lists"),
                 half_even(F.avg("organization_employees"), 2).alias("avg_company_size")))


_MONTHLY_COLUMNS = ("timestamp_created", "email_open_count", "email_list", "organization_employees")


@query("win_13_monthly", on_contacts(f"""SELECT strftime(timestamp_created, '%Y-%m') AS month, {_MONTH_SQL}
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1"""))
def monthly(t: Tables) -> DataFrame:
    return _monthly(t.contacts(*_MONTHLY_COLUMNS))


@query("win_13_order_months", """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders,
  round(sum(o_totalprice), 2) AS total, round_even(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 4) AS closed_share
  FROM orders GROUP BY 1""")
def order_months(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        half_even(F.avg(flag(F.col("o_orderstatus") == "F")), 4).alias("closed_share"))


def _monthly_by(name: str, needs: list[str], category, sql: str):
    @query(f"win_14_monthly_{name}", on_contacts(
        f"""SELECT strftime(timestamp_created, '%Y-%m') AS month, {sql} AS category, {_MONTH_SQL}
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1, 2"""))
    def build(t: Tables) -> DataFrame:
        return _monthly(t.contacts(*_MONTHLY_COLUMNS, *needs), category().alias("category"))
    return build


SENDER_GROUPS = [("dom0", "First Domain"), ("dom3", "Fourth Domain")]
_monthly_by("company_age", ["organization_founded_year"],
            lambda: C.company_age_category(F.col("organization_founded_year"), K.AS_OF), AGE_SQL)
_monthly_by("company_size", [], lambda: C.employee_level(F.col("organization_employees")),
            sql_ladder("organization_employees", K.EMPLOYEE_LEVELS, "Unknown"))
_monthly_by("link_tracking", ["link_tracking"], lambda: F.col("link_tracking").cast("string"),
            "CAST(link_tracking AS VARCHAR)")
_monthly_by("domain", [], lambda: C.domain_category(F.col("email_list"), SENDER_GROUPS),
            "CASE WHEN email_list IS NULL THEN 'Unknown' WHEN contains(lower(email_list), 'dom0') THEN 'First Domain' "
            "WHEN contains(lower(email_list), 'dom3') THEN 'Fourth Domain' ELSE 'Other Domain' END")
_monthly_by("list_size", [], lambda: C.list_size_category(T.address_list_features(F.col("email_list"))["email_count"]),
            LIST_SIZE_SQL)


# --- cohorts and list life cycle -----------------------------------------------
_COHORT_SQL = """count(email_open_count) AS contacts, CAST(sum(email_open_count) AS BIGINT) AS total_opens,
  round_even(avg(email_open_count), 3) AS avg_opens"""


def _cohort(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=["weeks_since"]).groupBy(*keys).agg(
        F.count("email_open_count").alias("contacts"), F.sum("email_open_count").alias("total_opens"),
        half_even(F.avg("email_open_count"), 3).alias("avg_opens"))


@query("win_15_cohorts", on_contacts(f"""SELECT cohort_month, weeks_since, {_COHORT_SQL}
  FROM aged WHERE weeks_since IS NOT NULL GROUP BY 1, 2""", _LIST_WEEKS_CTE))
def cohorts(t: Tables) -> DataFrame:
    return _cohort(aged(t), "cohort_month", "weeks_since")


@query("win_16_cohort_decay", on_contacts("""SELECT round(w0, 6) AS week0, round(w1, 6) AS week1,
  round((w0 - w1) / w0 * 100, 6) AS decay_pct FROM (SELECT avg(email_open_count) FILTER (WHERE weeks_since = 0) AS w0,
  avg(email_open_count) FILTER (WHERE weeks_since = 1) AS w1 FROM aged)""", _LIST_WEEKS_CTE))
def cohort_decay(t: Tables) -> DataFrame:
    def week(n: int):
        return F.avg(F.when(F.col("weeks_since") == n, F.col("email_open_count")))

    rates = aged(t).agg(week(0).alias("w0"), week(1).alias("w1"))
    return rates.select(F.round("w0", 6).alias("week0"), F.round("w1", 6).alias("week1"),
                        F.round((F.col("w0") - F.col("w1")) / F.col("w0") * 100, 6).alias("decay_pct"))


@query("win_16_cohort_matrix", on_contacts("""SELECT cohort_month, 'week_' || weeks_since AS week, round(avg(email_open_count), 6) AS avg_opens
  FROM aged WHERE weeks_since IS NOT NULL GROUP BY 1, 2""", _LIST_WEEKS_CTE))
def cohort_matrix(t: Tables) -> DataFrame:
    """All cells of the matrix, one row each, so that no week of a longer history is left out."""
    return aged(t).dropna(subset=["weeks_since"]).groupBy("cohort_month", F.concat(F.lit("week_"), "weeks_since").alias("week")).agg(
        F.round(F.avg("email_open_count"), 6).alias("avg_opens"))


_LIFE_CTE = _LIST_WEEKS_CTE + """, weekly AS (SELECT email_list, weeks_since,
  sum(email_open_count) / CAST(nullif(count(email_open_count), 0) AS DOUBLE) AS open_rate
  FROM aged WHERE weeks_since IS NOT NULL GROUP BY 1, 2),
lives AS (SELECT email_list, arg_min(open_rate, weeks_since) AS initial_rate, arg_max(open_rate, weeks_since) AS final_rate,
  count(*) AS weeks_tracked FROM weekly GROUP BY 1 HAVING count(*) >= 3)"""


@query("win_17_list_life", on_contacts("""SELECT email_list, round(initial_rate, 6) AS initial_rate,
  round(final_rate, 6) AS final_rate, weeks_tracked,
  round(CASE WHEN initial_rate > 0 THEN (initial_rate - final_rate) / initial_rate * 100 ELSE 0 END, 4) AS degradation_pct
  FROM lives ORDER BY degradation_pct DESC, email_list LIMIT 5""", _LIFE_CTE))
def list_life(t: Tables) -> DataFrame:
    weekly = _cohort(aged(t), "email_list", "weeks_since").withColumn(
        "open_rate", safe_ratio(F.col("total_opens"), F.col("contacts")))
    lives = weekly.groupBy("email_list").agg(
        F.min_by("open_rate", "weeks_since").alias("a"), F.max_by("open_rate", "weeks_since").alias("b"),
        F.count("*").alias("weeks_tracked")).filter("weeks_tracked >= 3")
    loss = F.when(F.col("a") > 0, (F.col("a") - F.col("b")) / F.col("a") * 100).otherwise(0.0)
    table = lives.select("email_list", F.round("a", 6).alias("initial_rate"), F.round("b", 6).alias("final_rate"),
                         "weeks_tracked", F.round(loss, 4).alias("degradation_pct"))
    return kpi.top(table, "degradation_pct", 5, ["email_list"])


# --- timeline events ---------------------------------------------------------------
@query("win_18_high_activity", on_contacts("""SELECT CAST(date AS VARCHAR) AS date, contacts FROM daily
  WHERE contacts >= (SELECT quantile_cont(contacts, 0.8) FROM daily)""", DAILY_CTE))
def high_activity(t: Tables) -> DataFrame:
    days = daily(t).select("date", "contacts")
    bound = days.agg(F.percentile("contacts", F.lit(0.8))).scalar()
    return days.filter(F.col("contacts") >= bound).select(_day(), "contacts")


_CHANGES_CTE = """day_sets AS (SELECT CAST(timestamp_created AS DATE) AS date,
  string_agg(DISTINCT upload_method, ',' ORDER BY upload_method) AS methods
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1),
changes AS (SELECT date, methods FROM (SELECT *, lag(methods, 1, '') OVER (ORDER BY date) AS before FROM day_sets)
  WHERE methods <> before)"""


def method_changes(df: DataFrame) -> DataFrame:
    """Days whose set of upload methods differs from the day before."""
    sets = df.dropna(subset=["timestamp_created"]).groupBy(F.to_date("timestamp_created").alias("date")).agg(
        F.array_join(F.array_sort(F.collect_set("upload_method")), ",").alias("methods"))
    before = F.lag("methods", 1, "").over(Window.orderBy("date"))
    return sets.withColumn("before", before).filter("methods <> before").drop("before")


@query("win_19_method_changes", on_contacts("SELECT CAST(date AS VARCHAR) AS date, methods FROM changes", _CHANGES_CTE))
def method_change_days(t: Tables) -> DataFrame:
    return method_changes(t.contacts("timestamp_created", "upload_method")).select(_day(), "methods")


@query("win_20_timeline_events", on_contacts("""SELECT CAST(date AS VARCHAR) AS date, event FROM (
  SELECT min(date) AS date, 'Campaign start' AS event FROM daily UNION ALL
  SELECT max(date), 'Latest activity' FROM daily UNION ALL
  SELECT date, 'High activity day' FROM daily WHERE contacts >= (SELECT quantile_cont(contacts, 0.8) FROM daily) UNION ALL
  SELECT date, 'Upload method change' FROM changes)""", DAILY_CTE + ", " + _CHANGES_CTE))
def timeline_events(t: Tables) -> DataFrame:
    return marked_days(t).orderBy("date", "event").select(_day(), "event")


def marked_days(t: Tables, most_busy: int | None = None, most_changes: int | None = None) -> DataFrame:
    """Days worth a mark on a time line; on demand only the first busy days and the first changes."""
    days = daily(t).select("date", "contacts")
    bound = days.agg(F.percentile("contacts", F.lit(0.8))).scalar()
    busy = days.filter(F.col("contacts") >= bound)
    changed = method_changes(t.contacts("timestamp_created", "upload_method"))
    busy = busy if most_busy is None else busy.orderBy("date").limit(most_busy)
    changed = changed if most_changes is None else changed.orderBy("date").limit(most_changes)
    parts = [days.agg(F.min("date").alias("date")).withColumn("event", F.lit("Campaign start")),
             days.agg(F.max("date").alias("date")).withColumn("event", F.lit("Latest activity")),
             busy.select("date", F.lit("High activity day").alias("event")),
             changed.select("date", F.lit("Upload method change").alias("event"))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_PERIOD_CTE = DAILY_CTE + """, rolled7 AS (SELECT date, CASE WHEN count(avg_opens) OVER w = 7 THEN round_even(avg(avg_opens) OVER w, 3) END AS m
  FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
full7 AS (SELECT *, row_number() OVER (ORDER BY date) AS a, row_number() OVER (ORDER BY date DESC) AS b FROM rolled7 WHERE m IS NOT NULL)"""


@query("win_21_best_period", on_contacts("""SELECT CAST((SELECT date FROM full7 ORDER BY m DESC, date LIMIT 1) AS VARCHAR) AS best_period,
  CAST((SELECT date FROM full7 ORDER BY m, date LIMIT 1) AS VARCHAR) AS worst_period, max(m) AS best, min(m) AS worst,
  round((avg(m) FILTER (WHERE b <= 7) - avg(m) FILTER (WHERE a <= 7)) / avg(m) FILTER (WHERE a <= 7) * 100, 4) AS trend_pct
  FROM full7""", _PERIOD_CTE))
def best_period(t: Tables) -> DataFrame:
    mean = daily(t).select("date", half_even(TS.centred_mean("avg_opens", "date", 7), 3).alias("m")).dropna()
    a, b = Window.orderBy("date"), Window.orderBy(F.desc("date"))
    numbered = mean.withColumns({"a": F.row_number().over(a), "b": F.row_number().over(b),
                                 "days": F.unix_date("date")})
    early, recent = (F.avg(F.when(F.col(c) <= 7, F.col("m"))) for c in ("a", "b"))
    return numbered.agg(
        F.max_by("date", F.struct("m", -F.col("days"))).cast("string").alias("best_period"),
        F.min_by("date", F.struct("m", "days")).cast("string").alias("worst_period"),
        F.max("m").alias("best"), F.min("m").alias("worst"),
        F.round((recent - early) / early * 100, 4).alias("trend_pct"))


# --- upload methods ------------------------------------------------------------
@query("win_22_method_adoption", on_contacts("""SELECT CAST(min(date) FILTER (WHERE api_share > 0) AS VARCHAR) AS first_api,
  CAST(max(date) FILTER (WHERE api_share > 0) AS VARCHAR) AS last_api,
  (SELECT CAST(date AS VARCHAR) FROM rolled WHERE api_share > 0 ORDER BY api_share DESC, date LIMIT 1) AS peak_api,
  round(max(api_share), 6) AS peak_share,
  date_diff('day', min(date) FILTER (WHERE api_share > 0), max(date) FILTER (WHERE api_share > 0)) AS api_days,
  round(avg(api_share_7d) FILTER (WHERE a <= 7), 6) AS early_adoption, round(avg(api_share_7d) FILTER (WHERE b <= 7), 6) AS recent_adoption,
  round((avg(api_share_7d) FILTER (WHERE b <= 7) - avg(api_share_7d) FILTER (WHERE a <= 7))
    / nullif(avg(api_share_7d) FILTER (WHERE a <= 7), 0) * 100, 4) AS growth_pct
  FROM (SELECT *, row_number() OVER (ORDER BY date) AS a, row_number() OVER (ORDER BY date DESC) AS b FROM rolled)""",
                                             _METHOD_DAYS_CTE))
def method_adoption(t: Tables) -> DataFrame:
    shares = method_shares(t).withColumns({
        "m": TS.rolling_mean("api_share", "date", 6, 0), "a": F.row_number().over(Window.orderBy("date")),
        "b": F.row_number().over(Window.orderBy(F.desc("date"))), "back": -F.unix_date("date")})
    used = F.when(F.col("api_share") > 0, F.col("date"))
    early, recent = (F.avg(F.when(F.col(c) <= 7, F.col("m"))) for c in ("a", "b"))
    return shares.agg(
        F.min(used).cast("string").alias("first_api"), F.max(used).cast("string").alias("last_api"),
        F.max_by(used, F.when(F.col("api_share") > 0, F.struct("api_share", "back"))).cast("string").alias("peak_api"),
        F.round(F.max("api_share"), 6).alias("peak_share"),
        F.datediff(F.max(used), F.min(used)).cast("bigint").alias("api_days"),
        F.round(early, 6).alias("early_adoption"), F.round(recent, 6).alias("recent_adoption"),
        F.round(F.try_divide(recent - early, early) * 100, 4).alias("growth_pct"))


def _method_pct_sql(key: str) -> str:
    return (f"SELECT {key}, count(*) AS contacts, round(count(*) FILTER (WHERE upload_method = 'api') * 100.0 / count(*), 4) AS api_pct, "
            f"round(count(*) FILTER (WHERE upload_method = 'manual') * 100.0 / count(*), 4) AS manual_pct "
            "FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1")


def _method_pct(t: Tables, pattern: str, name: str) -> DataFrame:
    def pct(method: str):
        return F.round(F.count_if(F.col("upload_method") == method) * 100.0 / F.count("*"), 4).alias(f"{method}_pct")

    return (t.contacts("timestamp_created", "upload_method").dropna(subset=["timestamp_created"])
            .groupBy(F.date_format("timestamp_created", pattern).alias(name))
            .agg(F.count("*").alias("contacts"), pct("api"), pct("manual")))


@query("win_23_method_by_weekday", on_contacts(_method_pct_sql("dayname(timestamp_created) AS weekday")))
def method_by_weekday(t: Tables) -> DataFrame:
    return _method_pct(t, "EEEE", "weekday")


_EVENT_SQL = """CASE WHEN api_pct > 5 AND coalesce(max(CASE WHEN api_pct > 5 THEN 1 END) OVER w, 0) = 0 THEN 'adoption begins'
  WHEN api_pct > 30 THEN 'peak usage'
  WHEN api_pct < 5 AND coalesce(max(CASE WHEN api_pct > 5 THEN 1 END) OVER w, 0) = 1 THEN 'usage drops' END"""


@query("win_23_method_by_month", on_contacts(f"""SELECT *, {_EVENT_SQL} AS event FROM months
  WINDOW w AS (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
                                             f"months AS ({_method_pct_sql(chr(39).join(['strftime(timestamp_created, ', '%Y-%m', ') AS month']))})"))
def method_by_month(t: Tables) -> DataFrame:
    earlier = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.coalesce(F.max(flag(F.col("api_pct") > 5)).over(earlier), F.lit(0)) == 1
    api = F.col("api_pct")
    event = (F.when((api > 5) & ~begun, "adoption begins").when(api > 30, "peak usage")
             .when((api < 5) & begun, "usage drops"))
    return _method_pct(t, "yyyy-MM", "month").withColumn("event", event)


# --- clicks over time -----------------------------------------------------------
_CLICK_SQL = """count(*) AS contacts, CAST(sum(email_click_count) AS BIGINT) AS total_clicks,
  round_even(avg(email_click_count), 3) AS avg_clicks,
  round(count(*) FILTER (WHERE email_click_count > 0) / CAST(count(*) AS DOUBLE), 6) AS click_rate,
  count(*) FILTER (WHERE email_click_count >= 3) AS high_clickers"""


def _clicks(df: DataFrame, *keys) -> DataFrame:
    clicks = F.col("email_click_count")
    return df.dropna(subset=["timestamp_created"]).groupBy(*keys).agg(
        F.count("*").alias("contacts"), F.sum(clicks).alias("total_clicks"),
        half_even(F.avg(clicks), 3).alias("avg_clicks"),
        F.round(F.count_if(clicks > 0) / F.count("*"), 6).alias("click_rate"),
        F.count_if(clicks >= 3).alias("high_clickers"))


@query("win_24_click_days", on_contacts(f"""SELECT CAST(CAST(timestamp_created AS DATE) AS VARCHAR) AS date, {_CLICK_SQL}
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1"""))
def click_days(t: Tables) -> DataFrame:
    return _clicks(t.contacts("timestamp_created", "email_click_count"),
                   F.to_date("timestamp_created").cast("string").alias("date"))


@query("win_24_click_months", on_contacts(f"""SELECT strftime(timestamp_created, '%Y-%m') AS month, {_CLICK_SQL}
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1"""))
def click_months(t: Tables) -> DataFrame:
    return _clicks(t.contacts("timestamp_created", "email_click_count"),
                   F.date_format("timestamp_created", "yyyy-MM").alias("month"))


@query("win_25_click_weekdays", on_contacts(f"""SELECT dayname(timestamp_created) AS weekday, {_CLICK_SQL}
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1"""))
def click_weekdays(t: Tables) -> DataFrame:
    return _clicks(t.contacts("timestamp_created", "email_click_count"),
                   F.date_format("timestamp_created", "EEEE").alias("weekday"))


@query("win_25_click_heatmap", on_contacts("SELECT month(timestamp_created) AS month, " + ", ".join(
    f"coalesce(round(avg(CASE WHEN email_click_count > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE isodow(timestamp_created) - 1 = {d}), 6), 0) AS day_{d}"
    for d in range(7)) + " FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1"))
def click_heatmap(t: Tables) -> DataFrame:
    df = t.contacts("timestamp_created", "email_click_count").dropna(subset=["timestamp_created"])
    wide = (df.withColumn("day", F.weekday("timestamp_created"))
            .groupBy(F.month("timestamp_created").cast("bigint").alias("month"))
            .pivot("day", list(range(7))).agg(F.round(F.avg(flag(F.col("email_click_count") > 0)), 6)).na.fill(0.0))
    return wide.withColumnsRenamed({str(d): f"day_{d}" for d in range(7)})


@query("win_26_monthly_correlation", on_contacts("""SELECT strftime(timestamp_created, '%Y-%m') AS month, count(*) AS n,
  round(corr(daily_limit, email_open_count), 6) AS correlation FROM contacts WHERE timestamp_created IS NOT NULL
  GROUP BY 1 HAVING count(*) >= 10"""))
def monthly_correlation(t: Tables) -> DataFrame:
    return (t.contacts("timestamp_created", "daily_limit", "email_open_count").dropna(subset=["timestamp_created"])
            .groupBy(F.date_format("timestamp_created", "yyyy-MM").alias("month"))
            .agg(F.count("*").alias("n"), F.round(F.corr("daily_limit", "email_open_count"), 6).alias("correlation"))
            .filter("n >= 10"))


@query("win_26_order_correlation", """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
  round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  GROUP BY 1 HAVING count(*) >= 10""")
def order_correlation(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice")
    return (t.orders.select("o_orderkey", "o_orderdate").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
            .agg(F.count("*").alias("n"), F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("correlation"))
            .filter("n >= 10"))


@query("win_27_hourly_activity", """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00') AS hour, count(*) AS events
  FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR GROUP BY 1""")
def hourly_activity(t: Tables) -> DataFrame:
    events = t.events.select("ts")
    since = events.agg(F.max("ts") - F.expr("INTERVAL 24 HOURS")).scalar()
    return (events.filter(F.col("ts") >= since)
            .groupBy(F.date_format("ts", "yyyy-MM-dd HH:00").alias("hour")).agg(F.count("*").alias("events")))


# --- list performance -------------------------------------------------------------
_LIST_PERF_CTE = LISTED_CTE + f""", perf AS (SELECT email_list, count(email_open_count) AS contacts,
  CAST(sum(email_open_count) AS BIGINT) AS total_opens, round_even(avg(email_open_count), 3) AS avg_opens,
  round_even(stddev(email_open_count), 3) AS opens_std,
  CAST(sum(email_click_count) AS BIGINT) AS total_clicks, round_even(avg(email_click_count), 3) AS avg_clicks,
  CAST(sum(email_reply_count) AS BIGINT) AS total_replies, round_even(avg(email_reply_count), 3) AS avg_replies,
  round_even(max(list_diversity), 3) AS diversity, max(email_count) AS email_count,
  min({sql_days('timestamp_created', '(SELECT min(timestamp_created) FROM contacts)')}) AS first_day,
  max({sql_days('timestamp_created', '(SELECT min(timestamp_created) FROM contacts)')}) AS last_day
  FROM listed WHERE email_list IS NOT NULL GROUP BY email_list HAVING count(email_open_count) >= 10),
scored AS (SELECT *, total_opens / CAST(contacts AS DOUBLE) AS open_rate, total_clicks / CAST(contacts AS DOUBLE) AS click_rate,
  total_replies / CAST(contacts AS DOUBLE) AS reply_rate, 1 - coalesce(opens_std / nullif(avg_opens, 0), 0) AS consistency,
  last_day - first_day AS longevity_days FROM perf),
final AS (SELECT *, open_rate * 0.5 + click_rate * 0.3 + reply_rate * 0.2 AS performance_score FROM scored)"""


def list_performance(df: DataFrame, min_contacts: int = 10) -> DataFrame:
    """Engagement, consistency, longevity and score per address list."""
    start = df.agg(F.min("timestamp_created")).scalar()
    day = days_between(F.col("timestamp_created"), start)
    aggs = [F.count("email_open_count").alias("contacts"),
            half_even(F.stddev("email_open_count"), 3).alias("opens_std"),
            # both depend on the list text alone, so any row of the list carries the same value
            half_even(F.max("list_diversity"), 3).alias("diversity"), F.max("email_count").alias("email_count"),
            F.min(day).alias("first_day"), F.max(day).alias("last_day")]
    for c, n in (("email_open_count", "opens"), ("email_click_count", "clicks"), ("email_reply_count", "replies")):
        aggs += [F.sum(c).alias(f"total_{n}"), half_even(F.avg(c), 3).alias(f"avg_{n}")]
    table = df.dropna(subset=["email_list"]).groupBy("email_list").agg(*aggs).filter(F.col("contacts") >= min_contacts)

    def rate(n: str):
        return F.col(f"total_{n}") / F.col("contacts")

    return table.withColumns({
        "open_rate": rate("opens"), "click_rate": rate("clicks"), "reply_rate": rate("replies"),
        "consistency": 1 - F.coalesce(F.try_divide("opens_std", "avg_opens"), F.lit(0.0)),
        "longevity_days": F.col("last_day") - F.col("first_day"),
        "performance_score": rate("opens") * 0.5 + rate("clicks") * 0.3 + rate("replies") * 0.2})


@query("agg_38_list_performance", on_contacts("SELECT * REPLACE (" + ", ".join(
    f"round({c}, 6) AS {c}" for c in ("open_rate", "click_rate", "reply_rate", "consistency", "performance_score"))
    + ") FROM final", _LIST_PERF_CTE))
def list_performance_table(t: Tables) -> DataFrame:
    table = list_performance(listed(t))
    return table.withColumns({c: F.round(c, 6) for c in (
        "open_rate", "click_rate", "reply_rate", "consistency", "performance_score")})


_FATIGUE_SQL = sql_cut("freq", *K.FATIGUE_BINS)


@query("agg_39_list_fatigue", on_contacts(f"""SELECT {_FATIGUE_SQL} AS fatigue_category, CAST(sum(contacts) AS BIGINT) AS contacts,
  CAST(sum(opens) AS BIGINT) AS total_opens, count(*) AS unique_lists,
  round(sum(opens) / CAST(nullif(sum(contacts), 0) AS DOUBLE), 6) AS open_rate,
  round(sum(diversity * freq) / sum(freq), 6) AS avg_diversity FROM (
  SELECT email_list, count(*) AS freq, count(email_open_count) AS contacts, sum(email_open_count) AS opens,
    avg(list_diversity) AS diversity FROM listed WHERE email_list IS NOT NULL GROUP BY email_list) GROUP BY 1""", LISTED_CTE))
def list_fatigue(t: Tables) -> DataFrame:
    # the contact frequency is the list's own count, so the second level works on one row per list
    lists = listed(t).dropna(subset=["email_list"]).groupBy("email_list").agg(
        F.count("*").alias("freq"), F.count("email_open_count").alias("n"), F.sum("email_open_count").alias("opens"),
        F.sum("list_diversity").alias("diversity"))
    return lists.groupBy(cut(F.col("freq"), *K.FATIGUE_BINS, lowest=False).alias("fatigue_category")).agg(
        F.sum("n").alias("contacts"), F.sum("opens").alias("total_opens"), F.count("*").alias("unique_lists"),
        F.round(safe_ratio(F.sum("opens"), F.sum("n")), 6).alias("open_rate"),
        F.round(F.sum("diversity") / F.sum("freq"), 6).alias("avg_diversity"))


@query("agg_45_value_maps", on_contacts("""SELECT CAST(date AS VARCHAR) AS date, CAST(sum(n) AS BIGINT) AS contacts,
  string_agg(esp_code || ':' || n, ',' ORDER BY place) FILTER (WHERE place <= 3) AS top_esp_codes FROM (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY n DESC, esp_code) AS place FROM (
    SELECT CAST(timestamp_created AS DATE) AS date, esp_code, count(*) AS n FROM contacts
    WHERE timestamp_created IS NOT NULL GROUP BY 1, 2)) GROUP BY date"""))
def value_maps(t: Tables) -> DataFrame:
    counts = (t.contacts("timestamp_created", "esp_code").dropna(subset=["timestamp_created"])
              .groupBy(F.to_date("timestamp_created").alias("date"), "esp_code").agg(F.count("*").alias("n")))
    # a first cut by slices of the values keeps what meets in one group at three entries a slice
    slices = counts.groupBy("date", F.pmod(F.xxhash64("esp_code"), F.lit(64)).alias("slice")).agg(
        F.sum("n").alias("n"), F.slice(value_counts_ordered("n", "esp_code"), 1, 3).alias("first"))
    best = F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, 3)
    text = F.array_join(F.transform(best, lambda e: F.concat(e.value.cast("string"), F.lit(":"), e.rows.cast("string"))), ",")
    return slices.groupBy("date").agg(F.sum("n").alias("contacts"), text.alias("top_esp_codes")).select(
        _day(), "contacts", "top_esp_codes")


def value_counts_ordered(count: str, value: str):
    """Aggregate of counted values into (value, rows) entries, the most frequent first, ties by value."""
    entries = F.collect_list(F.struct((-F.col(count)).alias("k"), F.col(value).alias("value"),
                                      F.col(count).alias("rows")))
    return F.array_sort(entries)


@query("agg_45_value_counts_map", on_contacts("""SELECT CAST(CAST(timestamp_created AS DATE) AS VARCHAR) AS date,
  count(*) FILTER (WHERE upload_method = 'api') AS api, count(*) FILTER (WHERE upload_method = 'manual') AS manual
  FROM contacts WHERE timestamp_created IS NOT NULL GROUP BY 1"""))
def value_counts_map(t: Tables) -> DataFrame:
    named = t.contacts("timestamp_created", "upload_method").dropna(subset=["timestamp_created"])
    return named.groupBy(F.to_date("timestamp_created").alias("date")).agg(
        *[F.count_if(F.col("upload_method") == m).alias(m) for m in ("api", "manual")]).select(_day(), "api", "manual")


@query("agg_54_list_thresholds", on_contacts("""SELECT round(quantile_cont(diversity, 0.75), 6) AS diversity_p75,
  round(quantile_cont(performance_score, 0.8), 6) AS score_p80 FROM final""", _LIST_PERF_CTE))
def list_thresholds(t: Tables) -> DataFrame:
    # the number of lists has no bound, so the ranks are found bucket by bucket
    found = exact_quantiles(list_performance(listed(t)), ["diversity", "performance_score"], [0.75, 0.8])

    def pick(column: str, place: str):
        return F.round(F.max(F.when(F.col("column") == column, F.col(place))), 6)

    return found.agg(pick("diversity", "q0").alias("diversity_p75"), pick("performance_score", "q1").alias("score_p80"))


@query("agg_55_list_length", on_contacts("""SELECT email_count, count(email_open_count) AS contacts,
  round(avg(email_open_count), 6) AS avg_opens FROM listed GROUP BY 1""", LISTED_CTE))
def list_length(t: Tables) -> DataFrame:
    return listed(t).groupBy("email_count").agg(
        F.count("email_open_count").alias("contacts"), F.round(F.avg("email_open_count"), 6).alias("avg_opens"))


@query("agg_56_api_vs_manual", on_contacts("""SELECT round(api, 6) AS api_opens, round(manual, 6) AS manual_opens,
  round((api - manual) / manual * 100, 4) AS api_advantage_pct, round(share, 4) AS api_share_pct FROM (
  SELECT avg(email_open_count) FILTER (WHERE upload_method = 'api') AS api,
    avg(email_open_count) FILTER (WHERE upload_method = 'manual') AS manual,
    avg(CASE WHEN upload_method = 'api' THEN 1.0 ELSE 0.0 END) * 100 AS share FROM contacts)"""))
def api_vs_manual(t: Tables) -> DataFrame:
    def mean(method: str):
        return F.avg(F.when(F.col("upload_method") == method, F.col("email_open_count")))

    api, manual = mean("api"), mean("manual")
    return t.contacts("upload_method", "email_open_count").agg(
        F.round(api, 6).alias("api_opens"), F.round(manual, 6).alias("manual_opens"),
        F.round((api - manual) / manual * 100, 4).alias("api_advantage_pct"),
        F.round(F.avg(flag(F.col("upload_method") == "api")) * 100, 4).alias("api_share_pct"))
