"""Streaming jobs run to completion over the given tables; each result is read back from what the job wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import dates as D
from leadmill.functions import scores as S
from leadmill.operators import keyed as KY
from leadmill.operators import layers as L
from leadmill.operators import sinks as SK
from leadmill.plans.registry import AS_OF_SQL, query, sql_days
from leadmill.sources.tables import Tables
from leadmill.streaming import jobs


def _paths(t: Tables, name: str) -> tuple[str, str]:
    return SK.fresh_folder(t.spark, name), SK.fresh_folder(t.spark, f"{name}-progress")


#: The user of the record that only moves the watermark on.
HEARTBEAT = -1


def in_batches(t: Tables, rows: DataFrame, run: Callable[[DataFrame], None], batches: int = 3) -> None:
    """Lands ``rows`` (user_id, ts) in parts by time and starts the job anew after each, so that it goes on from its
    checkpoint; at last a record far behind all others lets the watermark pass them."""
    folder = SK.fresh_folder(t.spark, "landed")
    second = F.unix_seconds("ts")
    facts = rows.agg(F.percentile_approx(second, [n / batches for n in range(1, batches)], 1000).alias("cuts"), F.max("ts").alias("newest")).first()
    edges = [None, *(facts["cuts"] or []), None]
    for low, high in zip(edges, edges[1:]):
        part = rows.filter((second > low if low is not None else F.lit(True)) & (second <= high if high is not None else F.lit(True)))
        part.write.mode("append").parquet(folder)
        run(t.spark.readStream.schema(rows.schema).parquet(folder))
    if facts["newest"] is not None:
        beat = t.spark.range(1).select(F.lit(HEARTBEAT).cast(rows.schema["user_id"].dataType).alias("user_id"), (F.lit(facts["newest"]) + F.expr("INTERVAL 30 DAYS")).cast(rows.schema["ts"].dataType).alias("ts"))
        beat.write.mode("append").parquet(folder)
        run(t.spark.readStream.schema(rows.schema).parquet(folder))


def real(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("user_id").eqNullSafe(F.lit(HEARTBEAT)))


@query("st_01_incremental_silver", "SELECT event_id AS id, isodow(ts) - 1 AS created_day_of_week, hour(ts) AS created_hour, CASE event_type WHEN 'click' THEN 2 WHEN 'purchase' THEN 2 WHEN 'view' THEN 1 ELSE 0 END AS engagement_level FROM events")
def incremental_silver(t: Tables) -> DataFrame:
    def build(df: DataFrame) -> DataFrame:
        kind = F.col("event_type")
        level = S.engagement_level((kind == "view").cast("int"), (kind == "click").cast("int"), (kind == "purchase").cast("int"))
        parts = D.calendar_parts(F.col("ts"), "created")
        return df.select(F.col("event_id").alias("id"), *[parts[c].alias(c) for c in ("created_day_of_week", "created_hour")], level.alias("engagement_level"))

    path, progress = _paths(t, "stream-silver")
    for restart in ("a", "b"):  # a second run from scratch finds every key in place
        jobs.incremental_keyed(jobs.stream_table(t.spark, t.path, "events"), build, path, f"{progress}-{restart}")
    return KY.read_keyed(t.spark, path)


@query("st_02_activity_windows", "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS events, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def activity_windows(t: Tables) -> DataFrame:
    path, progress = _paths(t, "stream-windows")
    jobs.write_updates(jobs.activity_windows(jobs.stream_table(t.spark, t.path, "events")), path, progress)
    rows = jobs.latest_updates(t.spark.read.parquet(path), ["start", "event_type"])
    return rows.withColumns({"start": F.date_format("start", "yyyy-MM-dd HH:mm"), "value": F.round("value", 4)})


@query("st_03_first_contacts", "SELECT count(DISTINCT user_id) AS contacts FROM events")
def first_contacts(t: Tables) -> DataFrame:
    path, progress = _paths(t, "stream-first")
    firsts = jobs.first_contacts(jobs.stream_table(t.spark, t.path, "events"), "user_id").select("user_id")
    jobs.run_available(firsts, lambda df, _: df.write.mode("append").parquet(path), progress)
    return t.spark.read.parquet(path).agg(F.count("*").alias("contacts"))


@query("st_04_gold_promotion", f"SELECT event_id AS id, {sql_days(AS_OF_SQL, 'ts')} AS lead_maturity_days FROM events WHERE ts <= {AS_OF_SQL} - INTERVAL 30 DAY AND value >= 30")
def gold_promotion(t: Tables) -> DataFrame:
    def step(df: DataFrame, n: int) -> None:
        silver = df.select(F.col("event_id").alias("id"), F.lit("x").alias("email"), F.lit(0).alias("engagement_level"),
                           F.col("ts").alias("timestamp_last_contact"), (F.col("value") / 100).alias("data_quality_score"))
        jobs.promote(silver, path, K.AS_OF, str(n))

    path, progress = _paths(t, "stream-gold")
    jobs.run_available(jobs.stream_table(t.spark, t.path, "events"), step, progress)
    return KY.read_keyed(t.spark, path).select("id", "lead_maturity_days")


@query("st_05_alert_cool_down", """WITH RECURSIVE fired AS (SELECT DISTINCT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events WHERE event_type = 'error'),
  sent AS (SELECT user_id, min(s) AS s FROM fired GROUP BY user_id UNION ALL
    SELECT q.user_id, q.n FROM (SELECT p.user_id, min(f.s) AS n FROM sent p JOIN fired f ON f.user_id = p.user_id AND f.s - p.s > 86400 GROUP BY p.user_id, p.s) q)
  SELECT user_id, s AS second FROM sent""")
def alert_cool_down(t: Tables) -> DataFrame:
    """Alerts land in three parts; the job starts again for each and lets through what one pass over all would."""
    path, progress = _paths(t, "stream-alerts")
    alerts = t.events.filter("event_type = 'error'").select("user_id", "ts")
    in_batches(t, alerts, lambda df: jobs.run_available(jobs.timed_cool_down(df, "user_id", 86400), lambda part, n: part.write.mode("overwrite").parquet(f"{path}/batch={n}"), progress))
    return real(t.spark.read.schema("user_id bigint, second bigint").parquet(path).select("user_id", "second"))


@query("st_06_sliding_rate", """SELECT strftime(s, '%Y-%m-%d') AS start, count(*) FILTER (WHERE event_type = 'view') AS opens, count(*) AS events
  FROM (SELECT event_type, unnest(generate_series(CAST(CAST(ts AS DATE) - 6 AS TIMESTAMP), CAST(CAST(ts AS DATE) AS TIMESTAMP), INTERVAL 1 DAY)) AS s FROM events) GROUP BY 1""")
def sliding_rate(t: Tables) -> DataFrame:
    path, progress = _paths(t, "stream-rate")
    jobs.write_updates(jobs.engagement_rate(jobs.stream_table(t.spark, t.path, "events")), path, progress)
    return jobs.latest_updates(t.spark.read.parquet(path), ["start"]).withColumn("start", F.date_format("start", "yyyy-MM-dd"))


@query("st_07_sessions", """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS events FROM (SELECT *, sum(CASE WHEN before IS NULL OR epoch_us(ts) - epoch_us(before) >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)) GROUP BY user_id, s""")
def sessions(t: Tables) -> DataFrame:
    """All sessions come from the stream, which reads three parts with a restart between them."""
    path, progress = _paths(t, "stream-sessions")
    in_batches(t, t.events.select("user_id", "ts"), lambda df: jobs.write_updates(jobs.sessions(df, late="1 day"), path, progress, "append"))
    return real(t.spark.read.parquet(path)).select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "events")
