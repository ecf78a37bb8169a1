"""Whole runs: the three-phase preparation and the daily run with its ledger."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import scores as S
from leadmill.operators import features as FE
from leadmill.operators import keyed as KY
from leadmill.operators import layers as L
from leadmill.operators import monitor as M
from leadmill.operators import quality as Q
from leadmill.operators.dictionary import stored
from leadmill.operators.sinks import new_rows, read_or_none


def three_phase(df: DataFrame, numbers: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Clean (fences, imputation), build features (time columns, interactions), add the click target."""
    clean = Q.impute(Q.winsorise(df, numbers), numbers, categories)
    built = FE.interaction_features(FE.every_time_column(clean))
    return built.withColumn("engagement_level", S.click_level(F.col("email_open_count"), F.col("email_click_count")))


def model_ready(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], label: str, identity: str, keep: int = 50, test_share: float = 0.25) -> DataFrame:
    """(identity, label, is_test, features): robustly scaled numbers and one-hot categories, of which the ``keep`` best by
    ANOVA stay. Scaling and choice are fitted on the rows that are not for testing."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import UnivariateFeatureSelector

    from leadmill.ml import prepare as P

    typed = df.withColumns({**{c: F.col(c).cast("double") for c in numbers}, label: F.col(label).cast("double")})
    parts = stored(P.split(typed, label, [identity], test_share), "split")
    best = UnivariateFeatureSelector(featuresCol="all_features", labelCol=label, outputCol="features", selectionMode="numTopFeatures")
    best = best.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(keep)
    stages = Pipeline(stages=[P.transformer(numbers, categories, robust=True, output="all_features"), best])
    return stages.fit(parts.filter("NOT is_test")).transform(parts).select(identity, label, "is_test", "features")


# --- the daily run -----------------------------------------------------------------------------
def ledger(spark: SparkSession, path: str) -> DataFrame:
    """(run, step, rows, ok): the steps that were done."""
    return spark.read.schema("run string, step string, rows bigint, ok boolean").parquet(path) if read_or_none(spark, path) is not None else spark.createDataFrame(
        [], "run string, step string, rows bigint, ok boolean")


def step_once(spark: SparkSession, path: str, run: str, step: str, work: Callable[[], tuple[int | None, bool]]) -> None:
    """Does a step of a run and records it, unless the ledger has it. A step that fails is not recorded and is done again."""
    if ledger(spark, path).filter((F.col("run") == run) & (F.col("step") == step)).isEmpty():
        rows, ok = work()
        spark.createDataFrame([(run, step, rows, ok)], "run string, step string, rows bigint, ok boolean").write.mode("append").parquet(path)


def daily_run(leads: DataFrame, silver: DataFrame, registry: DataFrame, as_of: datetime, path: str, run: str, limit: int = 50,
              credits: int = K.MONTHLY_CREDITS, train: Callable[[], None] | None = None) -> DataFrame:
    """The five daily steps of one run, each recorded in ``path/ledger`` and done once however often the run is started:
    health of the input, new leads into ``path/bronze``, waiting leads that the month's credits pay for, ``limit`` at most,
    into ``path/requests``, mature leads into ``path/gold``, and training by ``train`` where it is due. Tables are keyed by
    lead and written under the run's name. There is no scheduler; any timer may call it."""
    spark, book = leads.sparkSession, f"{path}/ledger"

    def health() -> tuple[int | None, bool]:
        return None, not M.freshness(leads, "timestamp_created", as_of).first()["is_stale"]

    def ingest() -> tuple[int | None, bool]:
        return KY.append_keyed(leads, f"{path}/bronze", ["id"], run), True

    def enrich() -> tuple[int | None, bool]:
        asked = KY.read_keyed(spark, f"{path}/requests")
        usage = leads.filter("enrichment_id IS NOT NULL").select("enriched_at", F.lit(1).alias("credits"))
        if asked is not None:
            usage = usage.unionByName(asked.select(F.col("requested_at").alias("enriched_at"), F.lit(1).alias("credits")))
        budget = min(limit, M.remaining_credits(usage, "enriched_at", "credits", as_of, credits))
        waiting = new_rows(leads.filter("enrichment_id IS NULL"), asked, ["id"])
        chosen = M.within_budget(waiting, [F.desc_nulls_last("timestamp_created"), F.col("id")], budget)
        return KY.append_keyed(chosen.select("id", F.lit(as_of).alias("requested_at")), f"{path}/requests", ["id"], run), True

    def gold() -> tuple[int | None, bool]:
        return KY.append_keyed(L.silver_to_gold(silver, None, as_of), f"{path}/gold", ["id"], run), True

    def retrain() -> tuple[int | None, bool]:
        due = M.retraining_due(registry, "created", as_of).first()["due"]
        if due and train is not None:
            train()
        return None, due

    for step in (health, ingest, enrich, gold, retrain):
        step_once(spark, book, run, step.__name__, step)
    return ledger(spark, book)
