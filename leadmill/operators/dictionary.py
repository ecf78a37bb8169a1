"""A dictionary of all values of several columns: rows, share and code of each, made in one pass and looked up at any size.

Places in an order are found without putting all rows into one task: rows are dealt by range, every range numbers its
own, and the counts of the ranges before are added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.operators.kpi import long_form
from leadmill.operators.sinks import fresh_folder

#: A value with at least this share of the rows is hot, so a column has at most as many hot ones.
HOT = 1024


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered_positions(df: DataFrame, order: Sequence[str | Column], into: str = "position") -> DataFrame:
    """Adds the place of every row, from 1, in the ascending order of columns or values, which should tell all rows apart."""
    keyed = df.withColumns({f"_o{n}": F.col(o) if isinstance(o, str) else o for n, o in enumerate(order)})
    keys = [f"_o{n}" for n in range(len(order))]
    pieces = stored(keyed.repartitionByRange(*keys).withColumn("_piece", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = (pieces.groupBy("_piece").agg(F.count("*").alias("_n"))
             .select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    inside = F.row_number().over(Window.partitionBy("_piece").orderBy(*keys))
    return pieces.join(bases, "_piece").withColumn(into, F.col("_base") + inside).drop("_piece", "_base", *keys)


def value_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(dimension, value, n, share, code): rows of each non-null value, their share of the most frequent one's, and the
    value's place, from 0, in the alphabetical order of its column. One pass over ``df`` serves all columns."""
    counts = long_form(df, columns).groupBy("dimension", "value").agg(F.count("*").alias("n"))
    placed = stored(ordered_positions(counts, ["dimension", "value"]), "dictionary")
    facts = placed.groupBy("dimension").agg(F.max("n").alias("_most"), F.min("position").alias("_first"))  # a row per column
    return placed.join(F.broadcast(facts), "dimension").select(
        "dimension", "value", "n", (F.col("n") / F.col("_most")).alias("share"), (F.col("position") - F.col("_first")).cast("int").alias("code"))


def with_facts(df: DataFrame, columns: Sequence[str], facts: Mapping[str, str], missing: str | None = None) -> DataFrame:
    """Adds ``<column>_<name>`` for every column and every (name, fact of the dictionary); null where the value is null,
    unless ``missing`` stands for nulls.

    The frame is stored once, with a number per row. Hot values, at most ``HOT`` per column, are broadcast; the cells of
    all other values are joined in one exchange, in which no key is hot, and come back by row number."""
    value = {c: F.col(c).cast("string") if missing is None else F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns}
    held = stored(df.withColumn("_row", F.monotonically_increasing_id()), "frame")
    dictionary = stored(value_dictionary(held.select(*[v.alias(c) for c, v in value.items()]), columns), "dictionary")
    least, entry = held.count() / HOT, F.struct(*[F.col(fact).alias(name) for name, fact in facts.items()])
    hot, cold = dictionary.filter(F.col("n") >= least), dictionary.filter(F.col("n") < least)
    for n, c in enumerate(columns):
        own = hot.filter(F.col("dimension") == c).select(F.col("value").alias(f"_v{n}"), entry.alias(f"_hot{n}"))
        held = held.withColumn(f"_v{n}", value[c]).join(F.broadcast(own), f"_v{n}", "left")
    cells = F.array(*[F.struct(F.lit(c).alias("dimension"), F.when(F.col(f"_hot{n}").isNull(), F.col(f"_v{n}")).alias("value")) for n, c in enumerate(columns)])
    found = (held.select("_row", F.inline(F.filter(cells, lambda x: x["value"].isNotNull()))).join(cold, ["dimension", "value"])
             .groupBy("_row").agg(*[F.max(F.when(F.col("dimension") == c, entry)).alias(f"_cold{n}") for n, c in enumerate(columns)]))
    out = held.join(found, "_row", "left").withColumns(
        {f"{c}_{name}": F.coalesce(F.col(f"_hot{n}"), F.col(f"_cold{n}"))[name] for n, c in enumerate(columns) for name in facts})
    return out.drop("_row", *[f"_{kind}{n}" for kind in ("v", "hot", "cold") for n in range(len(columns))])
