"""Splits, weights, scaling and feature pipelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml import feature as MF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill.operators.encode import group_rare
from leadmill.operators.quantiles import hash_order


#: Rows of a part of the tables that models are fitted on.
PART_ROWS = 1 << 16


def spread(df: DataFrame, keys: Sequence[str], rows: int = PART_ROWS) -> DataFrame:
    """``df`` dealt by hash to parts of about ``rows`` rows: a stored table of few bytes is read in few parts, however many
    rows it has, and a fit has no more tasks than that. One part's worth of rows is left as it is. ``df`` should be stored."""
    parts = -(-df.count() // rows)
    return df.repartition(parts, *keys) if parts > 1 else df


def split(df: DataFrame, label: str, identity: Sequence[str], test_share: float = 0.25, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: exactly ``floor(share * n)`` rows of every label, chosen by hash."""
    ordered = hash_order(df, [label], identity, seed)
    return ordered.withColumn("is_test", F.col("position") <= F.floor(F.col("group_rows") * test_share)
                              ).drop("position", "group_rows")


def folds(df: DataFrame, label: str, identity: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` 0 to k-1 with equal shares of every label."""
    ordered = hash_order(df, [label], identity, seed)
    return ordered.withColumn("fold", ((F.col("position") - 1) % k).cast("int")).drop("position", "group_rows")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Adds ``weight`` = rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    facts = counts.agg(F.struct(F.sum("_n").alias("n"), F.count("*").alias("k"))).scalar()
    weights = counts.withColumn("_f", facts).select(
        label, (F.col("_f.n") / (F.col("_f.k") * F.col("_n"))).alias("weight"))
    return df.join(weights, label)


def numeric_stages(columns: Sequence[str], robust: bool = False) -> list:
    """Median imputer, assembler and scaler; output column ``numbers``."""
    filled = [f"{c}_filled" for c in columns]
    scaler = (MF.RobustScaler(inputCol="raw_numbers", outputCol="numbers", withCentering=True) if robust
              else MF.StandardScaler(inputCol="raw_numbers", outputCol="numbers", withMean=True))
    return [MF.Imputer(strategy="median", inputCols=list(columns), outputCols=filled),
            MF.VectorAssembler(inputCols=filled, outputCol="raw_numbers"), scaler]


def category_stages(columns: Sequence[str]) -> list:
    """Index and one-hot of (already capped) categories; unseen values get their own slot."""
    index, hot = [f"{c}_index" for c in columns], [f"{c}_hot" for c in columns]
    return [MF.StringIndexer(inputCols=list(columns), outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
            MF.OneHotEncoder(inputCols=index, outputCols=hot, handleInvalid="keep")]


class Vocabulary(Estimator):
    """The vocabulary of a ``CountVectorizer``: of the terms in at least ``min_df`` documents and in no larger share of them
    than ``max_df``, the ``size`` most frequent, ties by the term. It is counted by shuffles, so no document is held."""

    def __init__(self, tokens: str, output: str, size: int, min_df: float, max_df: float):
        super().__init__()
        self.tokens, self.output, self.size, self.min_df, self.max_df = tokens, output, size, min_df, max_df

    def _fit(self, dataset: DataFrame) -> MF.CountVectorizerModel:
        most = self.max_df * dataset.count()

        def seen(tokens, times: int, documents: int):
            return F.transform(tokens, lambda t: F.struct(t.alias("term"), F.lit(times).alias("n"), F.lit(documents).alias("documents")))

        every = dataset.select(F.inline(F.concat(seen(F.col(self.tokens), 1, 0), seen(F.array_distinct(self.tokens), 0, 1))))
        counts = every.groupBy("term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
        kept = counts.filter((F.col("documents") >= self.min_df) & (F.col("documents") <= most))
        terms = [r["term"] for r in kept.orderBy(F.desc("n"), "term").limit(self.size).collect()]  # at most ``size`` terms
        if not terms:  # a model without terms can only be fitted
            return MF.CountVectorizer(inputCol=self.tokens, outputCol=self.output, vocabSize=self.size, minDF=self.min_df, maxDF=self.max_df).fit(dataset)
        return MF.CountVectorizerModel.from_vocabulary(terms, self.tokens, self.output)


def text_stages(column: str, terms: int = 300, min_df: float = 2.0, max_df: float = 0.95) -> list:
    """TF-IDF over single words and word pairs; output column ``text_vector`` of unit length."""
    def counted(tokens: str, name: str, size: int) -> list:
        return [Vocabulary(tokens, f"{name}_tf", size, min_df, max_df),
                MF.IDF(inputCol=f"{name}_tf", outputCol=f"{name}_idf")]

    return [MF.RegexTokenizer(inputCol=column, outputCol="words", pattern=r"(?U)\W+", toLowercase=True, minTokenLength=2),
            MF.StopWordsRemover(inputCol="words", outputCol="kept_words"),
            MF.NGram(n=2, inputCol="kept_words", outputCol="pairs"),
            *counted("kept_words", "single", terms - terms // 3), *counted("pairs", "pair", terms // 3),
            MF.VectorAssembler(inputCols=["single_idf", "pair_idf"], outputCol="text_raw"),
            MF.Normalizer(inputCol="text_raw", outputCol="text_vector")]


def transformer(numbers: Sequence[str] = (), categories: Sequence[str] = (), text: str | None = None, robust: bool = False,
                output: str = "features", terms: int = 300) -> Pipeline:
    """Imputed and scaled numbers, one-hot categories and TF-IDF text in one vector."""
    stages, parts = [], []
    if numbers:
        stages += numeric_stages(numbers, robust)
        parts.append("numbers")
    if categories:
        stages += category_stages(categories)
        parts += [f"{c}_hot" for c in categories]
    if text:
        stages += text_stages(text, terms)
        parts.append("text_vector")
    return Pipeline(stages=[*stages, MF.VectorAssembler(inputCols=parts, outputCol=output)])


def cap_categories(df: DataFrame, columns: Sequence[str], cap: int = 30) -> DataFrame:
    """Categories reduced to their most frequent values, in place."""
    capped = group_rare(df, columns, cap)
    return capped.withColumns({c: F.col(f"{c}_grouped") for c in columns}).drop(*[f"{c}_grouped" for c in columns])
