"""The daily run: ledger, resume after a failure, credits over several runs; the model-ready phase."""

import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadmill.operators import keyed as KY
from leadmill.operators import runs as R

AS_OF = datetime(2024, 3, 10)


def tables(spark):
    leads = spark.range(60).select(F.col("id"), F.lit(datetime(2024, 3, 9, 20)).alias("timestamp_created"),
                                   F.when(F.col("id") % 2 == 0, F.col("id")).alias("enrichment_id"),
                                   F.when(F.col("id") % 2 == 0, F.lit(datetime(2024, 3, 5))).alias("enriched_at"))
    silver = spark.range(40).select("id", F.lit("a@b").alias("email"), F.lit(1).alias("engagement_level"), F.lit(0.9).alias("data_quality_score"),
                                    F.when(F.col("id") < 25, F.lit(datetime(2024, 1, 1))).otherwise(F.lit(AS_OF)).alias("timestamp_last_contact"))
    registry = spark.createDataFrame([(datetime(2024, 3, 1),)], "created timestamp")
    return leads, silver, registry


def steps(df, run):
    return {r["step"]: (r["rows"], r["ok"]) for r in df.filter(F.col("run") == run).collect()}


def test_a_run_is_done_once_and_credits_run_out(spark):
    path, trained = tempfile.mkdtemp(prefix="daily-"), []
    go = lambda run: R.daily_run(*tables(spark), AS_OF, path, run, limit=20, credits=55, train=lambda: trained.append(run))
    first = go("one")
    assert steps(first, "one") == {"health": (None, True), "ingest": (60, True), "enrich": (20, True), "gold": (25, True), "retrain": (None, True)}
    assert first.count() == 5 and go("one").count() == 5 and trained == ["one"]
    again = go("two")  # 30 enriched and 20 asked for leave five credits
    assert steps(again, "two") == {"health": (None, True), "ingest": (0, True), "enrich": (5, True), "gold": (0, True), "retrain": (None, True)}
    asked = KY.read_keyed(spark, f"{path}/requests")
    assert asked.count() == 25 == asked.select("id").distinct().count() and asked.filter("id % 2 = 0").count() == 0


def test_a_failed_step_is_done_again(spark):
    path = tempfile.mkdtemp(prefix="daily-")

    def fail():
        raise RuntimeError("no machine")

    with pytest.raises(RuntimeError):
        R.daily_run(*tables(spark), AS_OF, path, "one", train=fail)
    assert sorted(steps(R.ledger(spark, f"{path}/ledger"), "one")) == ["enrich", "gold", "health", "ingest"]
    done = R.daily_run(*tables(spark), AS_OF, path, "one", train=lambda: None)
    assert steps(done, "one")["ingest"] == (60, True) and done.count() == 5


def test_model_ready(spark):
    df = spark.range(400).select("id", F.when(F.col("id") % 9 > 0, F.col("id") % 50).alias("a"), F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("c"),
                                 ((F.col("id") % 7) > 4).cast("int").alias("level"))
    out = R.model_ready(df, ["a"], ["c"], "level", "id", keep=3)
    rows = out.collect()
    assert len(rows) == 400 and {len(r.features) for r in rows} == {3}
    assert sum(r.is_test for r in rows) == sum(int(0.25 * sum(x.level == c for x in rows)) for c in (0, 1))
    assert out.columns == ["id", "level", "is_test", "features"]
