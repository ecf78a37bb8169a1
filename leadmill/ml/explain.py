"""Explanations that hold for every model: permutation importance, and names of vector slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.operators.dictionary import stored
from leadmill.operators.quantiles import hash_order


def permuted(df: DataFrame, values: str, identity: str, width: int, repeats: int = 1, seed: int = 42) -> DataFrame:
    """Every row once per column and repeat, with the array ``values`` in which only that column is permuted: ``column``,
    ``turn`` and the columns of ``df``.

    A row takes the value of the row that has its place in another order by hash, one order per column and repeat, so each
    value is given to exactly one row. Only the values go by column and repeat; the rows meet them in one exchange, and are
    never broadcast, as the size of a stored table says little of its size in memory."""
    columns, turns = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (width, repeats))
    placed = stored(hash_order(df, [], [identity], seed).drop("group_rows"), "placed")
    every = placed.select(identity, values).withColumn("column", columns).withColumn("turn", turns)
    donors = hash_order(every.select(identity, "column", "turn", F.get(values, F.col("column")).alias("_given")),
                        ["column", "turn"], [identity, "column", "turn"], seed + 1).select("column", "turn", "position", "_given")
    given = F.transform(values, lambda x, i: F.when(i == F.col("column"), F.col("_given")).otherwise(x))
    return placed.hint("merge").join(donors, "position").select(*df.columns, "column", "turn", "_given").withColumn(values, given).drop("_given")


def permutation_importance(model, df: DataFrame, names: Sequence[str], features: str = "features", label: str = "label", identity: str = "id",
                           repeats: int = 5, seed: int = 42) -> DataFrame:
    """(feature, importance, spread, place): accuracy that the fitted model loses when one feature is permuted, mean and
    spread over the repeats, for any model that gives ``prediction``. All features are scored in one pass."""
    right = F.avg((F.col("prediction") == F.col(label)).cast("double"))
    base = model.transform(df).agg(right).first()[0] or 0.0
    rows = df.select(identity, label, vector_to_array(features).alias("_v"))
    long = permuted(rows, "_v", identity, len(names), repeats, seed).withColumn(features, array_to_vector("_v"))
    lost = model.transform(long).groupBy("column", "turn").agg((F.lit(base) - right).alias("lost"))
    feature = F.get(F.array(*[F.lit(n) for n in names]), F.col("column"))
    found = lost.groupBy("column").agg(F.avg("lost").alias("importance"), F.coalesce(F.stddev_samp("lost"), F.lit(0.0)).alias("spread")).select(
        feature.alias("feature"), "importance", "spread").collect()  # a row per feature
    ranked = sorted(found, key=lambda r: (-r["importance"], r["feature"]))
    return df.sparkSession.createDataFrame([(*r, n + 1) for n, r in enumerate(ranked)], "feature string, importance double, spread double, place int")


def slots(model, transformed: DataFrame, features: str = "features") -> DataFrame:
    """(slot, name, column, value, type): what each place of a feature vector means, by walking back the stages of a fitted
    pipeline from the vector to the source columns; ``name`` is the attribute that the stages left on the vector.

    A number's slot has its column; a category's also the value, with null for values not seen; a text's also the term."""
    made = {}
    for stage in model.stages:
        ends = [[stage.getOrDefault(f"{side}Cols")] if stage.hasParam(f"{side}Cols") and stage.isSet(f"{side}Cols") else [stage.getOrDefault(f"{side}Col")]
                for side in ("input", "output")]
        inputs, outputs = ([*x[0]] if isinstance(x[0], (list, tuple)) else x for x in ends)
        paired = len(outputs) > 1 or len(inputs) == 1
        for n, out in enumerate(outputs):
            made[out] = stage, n, [inputs[n]] if paired else inputs

    def root(column: str) -> str:
        return root(made[column][2][0]) if column in made else column

    def meaning(column: str) -> list[tuple]:
        if column not in made:
            return [(column, None, "number")]
        stage, n, inputs = made[column]
        kind = type(stage).__name__
        if kind == "CountVectorizerModel":
            return [(root(column), term, "text") for term in stage.vocabulary]
        if kind == "OneHotEncoderModel":
            indexer, place, _ = made[inputs[0]]
            return [(root(column), value, "category") for value in [*indexer.labelsArray[place], None]]
        return [m for c in inputs for m in meaning(c)]

    attributes = transformed.schema[features].metadata["ml_attr"]
    names = {a["idx"]: a.get("name", str(a["idx"])) for kind in attributes.get("attrs", {}).values() for a in kind}
    found = meaning(features)
    if len(found) != attributes["num_attrs"]:
        raise ValueError(f"the vector has {attributes['num_attrs']} places, its stages explain {len(found)}")
    rows = [(n, names.get(n, str(n)), *m) for n, m in enumerate(found)]
    return transformed.sparkSession.createDataFrame(rows, "slot int, name string, column string, value string, type string")


def importance_by_slot(slot_table: DataFrame, values: Sequence[float]) -> DataFrame:
    """``slots`` with the importance of each; sum over ``column`` for that of a source column."""
    own = F.array(*[F.lit(float(v)) for v in values])
    return slot_table.withColumn("importance", F.get(own, F.col("slot")))
