"""Learning reports: preparation, selection, balancing, models, evaluation and scoring over the contact table."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import feature as MF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions.expr import flag
from leadmill.ml import balance as B
from leadmill.ml import explain as EX
from leadmill.ml import models as MD
from leadmill.ml import prepare as P
from leadmill.ml import select as SE
from leadmill.operators import features as FE
from leadmill.operators import sinks as SK
from leadmill.operators.dictionary import stored
from leadmill.plans.layers import service_silver
from leadmill.plans.quality import rounded
from leadmill.plans.registry import on_contacts, query, quoted
from leadmill.sources.tables import Tables

NUMBERS = ["daily_limit", "organization_employees", "organization_founded_year", "page_retrieved", "email_gap"]
# sizes of the models in these reports: boosting rounds and trees are parameters of ``classifiers``
SIZES = {"trees": 100, "rounds": 50, "iterations": 100}
PHASES = [{"regParam": [0.0, 0.01, 0.1]}, {"elasticNetParam": [0.0, 0.5, 1.0]}, {"fitIntercept": [True, False]}]
CATEGORIES = ["seniority", "upload_method"]
_ENGAGED = list(K.ENGAGEMENT_COUNTS)


def labelled(t: Tables) -> DataFrame:
    """Contacts with the engagement level, which is the label of three classes."""
    df = FE.target(t.contacts("id", *K.ENGAGEMENT_COUNTS, *NUMBERS, *CATEGORIES, "headline"))
    return df.withColumns({"label": F.col("engagement_level").cast("double"), **{c: F.col(c).cast("double") for c in NUMBERS},
                           **{c: F.coalesce(c, F.lit("Unknown")) for c in CATEGORIES}}).drop(*K.ENGAGEMENT_COUNTS)


def prepared(t: Tables) -> DataFrame:
    """Labelled contacts with the numeric feature vector, written once so that every fit reads the same rows."""
    df = P.split(labelled(t), "label", ["id"], 0.25)
    path = SK.fresh_folder(t.spark, "prepared")
    P.transformer(NUMBERS).fit(df).transform(df).select("id", "label", "engagement_level", "is_test", "features").write.parquet(path)
    return t.spark.read.parquet(path)


_LABELLED = """labelled AS (SELECT *, CASE WHEN email_open_count > 0 THEN 1 ELSE 0 END AS label, CASE WHEN email_click_count > 0 OR email_reply_count > 0 THEN 2 WHEN email_open_count > 0 THEN 1 ELSE 0 END AS level FROM contacts)"""


@query("ml_01_02_imputed_scaled")
def imputed_scaled(t: Tables) -> DataFrame:
    df = labelled(t)
    vector = P.transformer(NUMBERS, robust=True).fit(df).transform(df)
    return vector.select("id", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


@query("ml_01_robust_centres", on_contacts(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, TRUE AS median_zero, TRUE AS spread_one FROM contacts" for c in NUMBERS)))
def robust_centres(t: Tables) -> DataFrame:
    """Every robustly scaled number has the median zero and, unless its quartiles are equal, the distance one between them."""
    df = labelled(t)
    scaled = P.transformer(NUMBERS, robust=True).fit(df).transform(df).select(F.posexplode(vector_to_array("features")).alias("slot", "x"))
    quarters = F.percentile("x", F.array(*map(F.lit, (0.25, 0.5, 0.75))))
    per = scaled.groupBy("slot").agg(F.count("*").alias("rows"), quarters.alias("q"))
    wide = F.get("q", F.lit(2)) - F.get("q", F.lit(0))
    return per.select(F.get(F.array(*map(F.lit, NUMBERS)), F.col("slot")).alias("column"), "rows", (F.abs(F.get("q", F.lit(1))) < 0.05).alias("median_zero"),
                      ((F.abs(wide - 1) < 0.05) | (wide == 0)).alias("spread_one"))


@query("ml_02_standardised", "SELECT l_orderkey, l_linenumber, round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev(l_quantity) FROM lineitem), 5) AS quantity FROM lineitem")
def standardised(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    stages = [MF.VectorAssembler(inputCols=["l_quantity"], outputCol="raw"), MF.StandardScaler(inputCol="raw", outputCol="v", withMean=True)]
    out = Pipeline(stages=stages).fit(df).transform(df)
    return out.select("l_orderkey", "l_linenumber", F.round(vector_to_array("v")[0], 5).alias("quantity"))


@query("ml_03_one_hot")
def one_hot(t: Tables) -> DataFrame:
    df = P.cap_categories(labelled(t), CATEGORIES, 30)
    out = P.transformer(categories=CATEGORIES).fit(df).transform(df)
    return out.select("id", vector_to_array("features").alias("features"))


@query("ml_03_slot_counts", on_contacts(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", coalesce({c}, 'Unknown') AS value, count(*) AS rows FROM contacts GROUP BY 2" for c in CATEGORIES)))
def slot_counts(t: Tables) -> DataFrame:
    """How many rows set each slot of the one-hot vector, under the name that the fitted stages give the slot."""
    df = P.cap_categories(labelled(t), CATEGORIES, 30)
    stages = P.transformer(categories=CATEGORIES).fit(df)
    out = stages.transform(df)
    filled = out.select(F.posexplode(vector_to_array("features")).alias("slot", "x")).where("x <> 0").groupBy("slot").agg(F.sum("x").cast("long").alias("rows"))
    return EX.slots(stages, out).join(filled, "slot").select("column", "value", "rows")


@query("ml_05_unit_texts", "SELECT count(*) AS rows, count(*) AS unit_or_empty, TRUE AS terms_in_range FROM documents")
def unit_texts(t: Tables) -> DataFrame:
    found = tf_idf(t)
    return found.agg(F.count("*").alias("rows"), F.count_if((F.abs(F.col("norm") - 1) < 1e-3) | ((F.col("norm") == 0) & (F.col("terms") == 0))).alias("unit_or_empty"),
                     F.bool_and(F.col("terms").between(0, 300)).alias("terms_in_range"))


@query("ml_05_tf_idf")
def tf_idf(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text")
    out = P.transformer(text="text", terms=300).fit(docs).transform(docs)
    v = vector_to_array("features")
    return out.select("doc_id", F.size(F.filter(v, lambda x: x != 0)).alias("terms"), F.round(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x), 4).alias("norm"))


@query("ml_06_column_transformer")
def column_transformer(t: Tables) -> DataFrame:
    """The whole vector of every contact: scaled numbers, one-hot categories and up to 300 weighted terms."""
    df = P.cap_categories(labelled(t), CATEGORIES, 30).na.fill("", ["headline"])
    out = P.transformer(NUMBERS, CATEGORIES, "headline", terms=300).fit(df).transform(df)
    return out.select("id", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


@query("ml_06_slots_filled", on_contacts("SELECT count(*) AS rows, count(*) AS one_value_each, count(*) AS unit_text, TRUE AS centred FROM contacts"))
def slots_filled(t: Tables) -> DataFrame:
    """Every category has one slot set, the terms have unit length or none, the scaled numbers the mean zero."""
    df = P.cap_categories(labelled(t), CATEGORIES, 30).na.fill("", ["headline"])
    stages = P.transformer(NUMBERS, CATEGORIES, "headline", terms=300).fit(df)
    out = stages.transform(df)
    whole, n = vector_to_array("features"), len(NUMBERS)
    hot = sum(1 + len(labels) for labels in stages.stages[3].labelsArray)
    ones = F.aggregate(F.slice("v", n + 1, hot), F.lit(0.0), lambda a, x: a + x)
    length = F.aggregate(F.slice("v", n + hot + 1, 1000), F.lit(0.0), lambda a, x: a + x * x)
    return out.select(whole.alias("v")).select("v", ones.alias("ones"), length.alias("length")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("ones") == len(CATEGORIES)).alias("one_value_each"),
        F.count_if((F.abs(F.col("length") - 1) < 1e-6) | (F.col("length") == 0)).alias("unit_text"),
        *[F.abs(F.avg(F.get("v", F.lit(i)))).alias(f"m{i}") for i in range(n)]).select(
        "rows", "one_value_each", "unit_text", (F.greatest(*[F.col(f"m{i}") for i in range(n)]) < 1e-6).alias("centred"))


@query("ml_07_variance", on_contacts(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(var_samp({c}), 4) AS variance, var_samp({c}) > 0.01 AS kept FROM contacts" for c in NUMBERS)))
def variance(t: Tables) -> DataFrame:
    return SE.low_variance(t.contacts(*NUMBERS), NUMBERS).withColumn("variance", F.round("variance", 4))


@query("ml_08_redundant", on_contacts(" UNION ".join(f"SELECT '{b}' AS \"column\" FROM doubled HAVING abs(corr({a}, {b})) > 0.95"
    for i, a in enumerate([*NUMBERS, "twice"]) for b in [*NUMBERS, "twice"][i + 1:]), "doubled AS (SELECT *, page_retrieved * 2 AS twice FROM contacts)"))
def redundant(t: Tables) -> DataFrame:
    return SE.redundant(t.contacts(*NUMBERS).withColumn("twice", F.col("page_retrieved") * 2), [*NUMBERS, "twice"])


def _mi_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", round(sum(n / t * ln(n * t / (nv * nl))), 6) AS mutual_information FROM (SELECT CAST(count(*) AS DOUBLE) AS n, sum(count(*)) OVER (PARTITION BY {c}) AS nv,
  sum(count(*)) OVER (PARTITION BY label) AS nl, sum(count(*)) OVER () AS t FROM labelled GROUP BY {c}, label)"""


@query("ml_09_mutual_information", on_contacts(" UNION ALL ".join(_mi_sql(c) for c in ("seniority", "campaign", "email_gap")), _LABELLED))
def mutual_information(t: Tables) -> DataFrame:
    df = t.contacts("seniority", "campaign", "email_gap", "email_open_count").withColumn("label", flag(F.col("email_open_count") > 0))
    return rounded(SE.mutual_information(df, ["seniority", "campaign", "email_gap"], "label"))


@query("ml_10_anova", on_contacts(" UNION ALL ".join(f"""SELECT '{c}' AS "column", round((sum(n * m * m) - sum(n) * pow(sum(n * m) / sum(n), 2)) / (count(*) - 1) / (sum((n - 1) * s2) / (sum(n) - count(*))), 4) AS f_value
  FROM (SELECT level, count({c}) AS n, avg({c}) AS m, var_samp({c}) AS s2 FROM labelled GROUP BY level)""" for c in NUMBERS[:5]), _LABELLED))
def anova(t: Tables) -> DataFrame:
    return SE.anova_f(labelled(t), NUMBERS[:5], "label").withColumn("f_value", F.round("f_value", 4))


@query("ml_10_select_best")
def select_best(t: Tables) -> DataFrame:
    df = prepared(t)
    return SE.select_best(df, 3).transform(df).select("id", vector_to_array("selected").alias("selected"))


_FILLED = "filled AS (SELECT level, " + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM contacts))::DOUBLE AS {c}" for c in NUMBERS) + " FROM labelled)"


@query("ml_10_best_names", on_contacts("SELECT \"column\" FROM (" + " UNION ALL ".join(f"""SELECT '{c}' AS "column", {n} AS place, (sum(n * m * m) - sum(n) * pow(sum(n * m) / sum(n), 2)) / (count(*) - 1) / (sum((n - 1) * s2) / (sum(n) - count(*))) AS f
  FROM (SELECT level, count(*) AS n, avg({c}) AS m, var_samp({c}) AS s2 FROM filled GROUP BY level)""" for n, c in enumerate(NUMBERS)) + ") WHERE NOT isnan(f) ORDER BY f DESC, place LIMIT 3", f"{_LABELLED}, {_FILLED}"))
def best_names(t: Tables) -> DataFrame:
    """The columns that the selector of the three best keeps of the imputed numbers."""
    chosen = SE.select_best(prepared(t), 3).selectedFeatures
    return t.spark.createDataFrame([(NUMBERS[n],) for n in chosen], "column string")


@query("ml_11_component_shares", on_contacts("SELECT count(*) AS rows, TRUE AS share_reached, TRUE AS none_too_many, TRUE AS unrelated FROM contacts"))
def component_shares(t: Tables) -> DataFrame:
    """The kept components hold 95 % of the variance of the numbers, would not without the last one, and are unrelated."""
    df = prepared(t)
    out = SE.principal_components(df, "features", len(NUMBERS)).select(vector_to_array("features").alias("v"), F.col("components").alias("c"))
    kept = len(out.first()["c"])
    spread = lambda name, i: F.var_samp(F.get(name, F.lit(i)))
    own = [spread("c", i) for i in range(kept)]
    pairs = [F.abs(F.coalesce(F.corr(F.get("c", F.lit(i)), F.get("c", F.lit(j))), F.lit(0.0))) for i in range(kept) for j in range(i)]
    whole, held, last = sum(spread("v", i) for i in range(len(NUMBERS))), sum(own), own[-1]
    return out.agg(F.count("*").alias("rows"), (held / whole >= 0.95 - 1e-9).alias("share_reached"), ((held - last) / whole < 0.95).alias("none_too_many"),
                   (F.greatest(F.lit(0.0), F.lit(0.0), *pairs) < 1e-6).alias("unrelated"))


@query("ml_11_components")
def components(t: Tables) -> DataFrame:
    out = SE.principal_components(prepared(t), "features", len(NUMBERS))
    return out.select("id", F.size("components").alias("kept"))


@query("ml_12_class_weights", on_contacts("SELECT level, count(*) AS rows, round(max(total) / (3 * count(*)), 6) AS weight FROM labelled, (SELECT count(*)::DOUBLE AS total FROM labelled) GROUP BY level", _LABELLED))
def class_weights(t: Tables) -> DataFrame:
    df = FE.target(t.contacts(*K.ENGAGEMENT_COUNTS)).withColumnRenamed("engagement_level", "level")
    return rounded(P.class_weights(df, "level").groupBy("level").agg(F.count("*").alias("rows"), F.max("weight").alias("weight")))


@query("ml_13_oversample", on_contacts("SELECT level AS label, (SELECT max(n) FROM (SELECT count(*) AS n FROM labelled GROUP BY level)) AS rows FROM labelled GROUP BY level", _LABELLED))
def oversample(t: Tables) -> DataFrame:
    """Every class at the size of the largest, by rows between neighbours."""
    made = B.oversample(prepared(t), "features", "label", "id")
    return made.groupBy(F.col("label").cast("int").alias("label")).agg(F.count("*").alias("rows"))


@query("ml_13_undersample", on_contacts("SELECT label, (SELECT min(n) FROM (SELECT count(*) AS n FROM labelled GROUP BY label)) AS rows FROM labelled GROUP BY label", _LABELLED))
def undersample(t: Tables) -> DataFrame:
    df = t.contacts("id", "email_open_count").withColumn("label", flag(F.col("email_open_count") > 0))
    return B.undersample(df, "label", "id").groupBy("label").agg(F.count("*").alias("rows"))


@query("ml_14_adaptive_and_edited")
def adaptive_and_edited(t: Tables) -> DataFrame:
    df = prepared(t)
    weights = B.adaptive_weights(df, "features", "label", "id", 2.0).agg(F.lit("foreign share").alias("measure"), F.avg("foreign_share").alias("value"))
    kept = B.edited(df, "features", "label", "id").agg(F.lit("kept rows").alias("measure"), F.count("*").cast("double").alias("value"))
    return weights.unionByName(kept)


@query("ml_14_balanced_classes", on_contacts("""SELECT method, level AS label, CASE WHEN method = 'original' THEN n ELSE max(n) OVER (PARTITION BY method) END::BIGINT AS rows, TRUE AS kept_within
  FROM (SELECT level, count(*) AS n FROM labelled GROUP BY level), (VALUES ('original'), ('smote'), ('adasyn'), ('smote_enn')) m(method)""", _LABELLED))
def balanced_classes(t: Tables) -> DataFrame:
    """Rows per class of every balanced table, that of the edited one before its rows were edited away."""
    tables = B.balanced_tables(prepared(t), "features", "label", "id")
    label = F.col("label").cast("int").alias("label")
    counts = {m: df.groupBy(label).agg(F.count("*").alias("rows")) for m, df in tables.items()}
    kept = counts["smote"].join(counts["smote_enn"].withColumnRenamed("rows", "kept"), "label", "left")
    out = kept.select(F.lit("smote_enn").alias("method"), "label", "rows", F.coalesce(F.col("kept"), F.lit(0)).between(0, F.col("rows")).alias("kept_within"))
    for method in ("original", "smote", "adasyn"):
        out = out.unionByName(counts[method].select(F.lit(method).alias("method"), "label", "rows", F.lit(True).alias("kept_within")))
    return out


@query("ml_14_chosen_balance", on_contacts("""SELECT method, CASE WHEN method <> 'smote_enn' THEN 3 * max(n - CAST(floor(n * 0.25) AS BIGINT)) END::BIGINT AS train_rows, sum(CAST(floor(n * 0.25) AS BIGINT))::BIGINT AS test_rows, TRUE AS choice_is_best
  FROM (SELECT level, count(*) AS n FROM labelled GROUP BY level), (VALUES ('smote'), ('adasyn'), ('smote_enn')) m(method) GROUP BY method""", _LABELLED))
def chosen_balance(t: Tables) -> DataFrame:
    """The balanced tables tried with boosted trees; the row count after editing is left out, as SQL cannot state it."""
    df = prepared(t)
    test = df.filter("is_test")
    tables = B.balanced_tables(df.filter("NOT is_test"), "features", "label", "id")
    model, tried = B.choose_balance(tables, MD.classifiers(**SIZES)["gradient_boosting"], test)
    scored = model.transform(test).agg(F.count("*")).first()[0]
    best = max(r["accuracy"] for r in tried)
    rows = [(r["method"], None if r["method"] == "smote_enn" else r["train_rows"], scored, r["chosen"] == (r["accuracy"] == best) or not r["chosen"]) for r in tried]
    return t.spark.createDataFrame(rows, "method string, train_rows bigint, test_rows bigint, choice_is_best boolean")


@query("ml_15_18_24_model_comparison")
def model_comparison(t: Tables) -> DataFrame:
    df = prepared(t)
    train, test = df.filter("NOT is_test"), df.filter("is_test")
    tables, named = [], MD.classifiers(**SIZES)
    for name, model in zip(named, MD.fitted(list(named.values()), train)):
        scored = model.transform(test)
        area = MD.weighted_area(MD.class_areas(scored.withColumn("_scores", vector_to_array("rawPrediction")), "label", "_scores"))
        tables.append(MD.summary(MD.confusion(scored)).withColumn("model", F.lit(name)).withColumn("auc_weighted", area.scalar()))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return rounded(out)


@query("ml_24_comparison")
def cross_validated_comparison(t: Tables) -> DataFrame:
    """Cross-validated mean and spread per model, means of their families, the best and the most stable one."""
    df = P.folds(prepared(t), "label", ["id"], 3)
    path = SK.fresh_folder(t.spark, "folds")
    df.write.parquet(path)
    rows = MD.comparison(t.spark.read.parquet(path), MD.classifiers(**SIZES))
    return rounded(t.spark.createDataFrame([tuple(r.values()) for r in rows], "model string, family string, cv_mean double, cv_spread double, family_mean double, is_best boolean, is_most_stable boolean"))


@query("ml_19_votes", on_contacts("SELECT count(*) AS rows, count(DISTINCT id) AS ids FROM contacts"))
def votes(t: Tables) -> DataFrame:
    """Every row has exactly one vote."""
    return MD.nearest_vote(prepared(t), "features", "label", "id").agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids"))


@query("ml_19_nearest_vote")
def nearest_vote(t: Tables) -> DataFrame:
    return MD.nearest_vote(prepared(t), "features", "label", "id").groupBy("prediction").agg(F.count("*").alias("rows"))


@query("ml_20_soft_vote")
def soft_vote(t: Tables) -> DataFrame:
    df = prepared(t)
    train = df.filter("NOT is_test")
    models = MD.fitted([m for n, m in MD.classifiers(**SIZES).items() if n in ("gradient_boosting", "logistic_regression")], train)
    return rounded(MD.summary(MD.confusion(MD.soft_vote(df.filter("is_test"), models))))


@query("ml_21_22_grid_search")
def grid_search(t: Tables) -> DataFrame:
    """All settings of a search in three phases, with mean F1 and spread over the folds."""
    df = P.folds(prepared(t).filter("NOT is_test"), "label", ["id"], 3)
    path = SK.fresh_folder(t.spark, "folds")
    df.write.parquet(path)
    _, tried = MD.phased_search(t.spark.read.parquet(path), MD.classifiers(**SIZES)["logistic_regression"], PHASES)
    return rounded(t.spark.createDataFrame([tuple(r.values()) for r in tried], "phase int, setting string, f1 double, spread double"))


SPACE = {"maxDepth": [2, 3, 5, 7], "stepSize": [0.05, 0.1, 0.2], "subsamplingRate": [0.8, 0.9, 1.0], "minInstancesPerNode": [1, 3, 5]}


@query("ml_21_boosted_search")
def boosted_search(t: Tables) -> DataFrame:
    """All settings of a search over boosted trees for opened or not, with the rounds that early stopping left."""
    df = prepared(t).filter("NOT is_test").withColumn("label", (F.col("label") > 0).cast("double"))
    _, tried = MD.boosted_search(df, SPACE, first=4, rounds=40, k=2)
    return rounded(t.spark.createDataFrame([tuple(r.values()) for r in tried], "phase int, setting string, rounds int, auc double, spread double"))


_REPORT_SQL = """WITH m AS (SELECT quality AS label, CASE WHEN n_chars > 900 THEN 1 ELSE 0 END AS prediction, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2),
r AS (SELECT a.label, support, coalesce(hit / nullif(guessed, 0)::DOUBLE, 0) AS p, hit / support::DOUBLE AS r, hit FROM (SELECT label, sum(n)::BIGINT AS support, coalesce(sum(n) FILTER (WHERE label = prediction), 0)::BIGINT AS hit FROM m GROUP BY 1) a
  LEFT JOIN (SELECT prediction AS label, sum(n)::BIGINT AS guessed FROM m GROUP BY 1) g USING (label))"""


def _judged(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", flag(F.col("n_chars") > 900).alias("prediction"))
    return t.labels.select("doc_id", F.col("quality").alias("label")).join(docs, "doc_id")


@query("ml_23_class_report", _REPORT_SQL + "SELECT label, support, round(p, 6) AS precision, round(r, 6) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 6) AS f1, hit FROM r")
def class_report(t: Tables) -> DataFrame:
    return rounded(MD.class_report(MD.confusion(_judged(t))))


@query("ml_23_summary", _REPORT_SQL + ", f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM r) SELECT round(sum(hit) / sum(support)::DOUBLE, 6) AS accuracy, round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro, "
    "round(sum(p * support) / sum(support), 6) AS precision_weighted, round(sum(r * support) / sum(support), 6) AS recall_weighted, round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM f")
def summary(t: Tables) -> DataFrame:
    return rounded(MD.summary(MD.confusion(_judged(t))))


@query("ml_23_auc", """WITH s AS (SELECT quality AS y, n_chars AS x FROM labels JOIN documents USING (doc_id))
  SELECT round(avg(CASE WHEN a.x > b.x THEN 1.0 WHEN a.x = b.x THEN 0.5 ELSE 0 END), 6) AS auc FROM s a JOIN s b ON a.y = 1 AND b.y = 0""")
def auc(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return rounded(MD.auc(t.labels.select("doc_id", F.col("quality").alias("label")).join(docs, "doc_id"), "label", "score"))


_STATUS = {"F": 0, "O": 1, "P": 2}
_SCORES = ["o_totalprice", "-o_totalprice", "o_custkey % 50"]


@query("ml_23_class_areas", "WITH long AS (" + " UNION ALL ".join(f"SELECT {c} AS class, o_orderstatus = '{s}' AS hit, CAST({_SCORES[c]} AS DOUBLE) AS s FROM orders" for s, c in _STATUS.items()) + """),
ranked AS (SELECT class, hit, rank() OVER (PARTITION BY class ORDER BY s) + (count(*) OVER (PARTITION BY class, s) - 1) / 2.0 AS r FROM long),
areas AS (SELECT class, count(*) FILTER (WHERE hit) AS rows, (sum(r) FILTER (WHERE hit) - count(*) FILTER (WHERE hit) * (count(*) FILTER (WHERE hit) + 1) / 2.0) / (count(*) FILTER (WHERE hit) * count(*) FILTER (WHERE NOT hit)) AS auc FROM ranked GROUP BY class)
SELECT class, rows, round(auc, 6) AS auc, round(sum(auc * rows) OVER () / sum(rows) OVER (), 6) AS auc_weighted FROM areas""")
def class_areas(t: Tables) -> DataFrame:
    """Each order status against the rest, by one score per status, and their weighted mean."""
    status = F.col("o_orderstatus")
    label = F.when(status == "F", 0).when(status == "O", 1).when(status == "P", 2)
    areas = MD.class_areas(t.orders.select(label.alias("label"), F.array(*[F.expr(f"CAST({s} AS DOUBLE)") for s in _SCORES]).alias("scores")), "label", "scores")
    return rounded(areas.withColumn("auc_weighted", MD.weighted_area(areas).scalar()))


@query("ml_26_permuted_columns", "WITH v AS (SELECT l_orderkey * 8 + l_linenumber AS id, l_quantity, l_extendedprice, l_discount FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS rows, count(DISTINCT id) AS ids, round(sum({c}), 2) AS total, round(max({c}), 4) AS largest, TRUE AS others_kept, TRUE AS unrelated FROM v" for c in ("l_quantity", "l_extendedprice", "l_discount")))
def permuted_columns(t: Tables) -> DataFrame:
    """A permuted column has the same values in other rows: it keeps its sum and loses its relation to itself."""
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    numbers = F.array(*[F.col(c).cast("double") for c in names])
    rows = t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), numbers.alias("v"), numbers.alias("was"))
    own, before = F.get("v", F.col("column")), F.get("was", F.col("column"))
    kept = F.forall(F.sequence(F.lit(0), F.lit(2)), lambda i: (i == F.col("column")) | (F.get("v", i) == F.get("was", i)))
    # stored narrow, so that counting the ids does not send the other sums of every id through its exchange
    moved = stored(EX.permuted(rows, "v", "id", len(names)).select("id", "column", own.alias("own"), before.alias("before"), kept.alias("kept")), "moved")
    ids = moved.groupBy("column").agg(F.count_distinct("id").alias("ids"))
    facts = moved.groupBy("column").agg(F.count("*").alias("rows"), F.round(F.sum("own"), 2).alias("total"), F.max("own").alias("largest"), F.bool_and("kept").alias("others_kept"),
                                        (F.abs(F.corr("own", "before")) < 0.1).alias("unrelated"))
    return rounded(facts.join(ids, "column").select(F.get(F.array(*map(F.lit, names)), F.col("column")).alias("feature"), "rows", "ids", "total", "largest", "others_kept", "unrelated"))


@query("ml_26_permutation_importance")
def permutation_importance(t: Tables) -> DataFrame:
    """Accuracy that a forest loses with each feature permuted, over the test rows."""
    df = prepared(t)
    model = MD.classifiers(**SIZES)["random_forest"].fit(df.filter("NOT is_test"))
    return rounded(EX.permutation_importance(model, df.filter("is_test"), NUMBERS))


@query("ml_25_importance")
def importance(t: Tables) -> DataFrame:
    model = MD.classifiers(**SIZES)["random_forest"].fit(prepared(t))
    return MD.importance(t.spark, NUMBERS, model.featureImportances.toArray())


def _hot_sql(c: str) -> str:
    return f"SELECT '{c}' AS \"column\", 'category' AS type, least(count(DISTINCT coalesce({c}, 'Unknown')), 31) + 1 AS slots, least(count(DISTINCT coalesce({c}, 'Unknown')), 31) AS named, TRUE AS in_range FROM contacts"


@query("ml_25_32_slots", on_contacts(" UNION ALL ".join([f"SELECT '{c}' AS \"column\", 'number' AS type, 1 AS slots, 0 AS named, TRUE AS in_range" for c in NUMBERS] + [_hot_sql(c) for c in CATEGORIES])))
def slot_importance(t: Tables) -> DataFrame:
    """Importance per slot of a forest's vector, stored with the model, read back and summed per source column."""
    df = P.cap_categories(labelled(t), CATEGORIES, 30)
    preparation = P.transformer(NUMBERS, CATEGORIES).fit(df)
    ready = preparation.transform(df)
    forest = MD.classifiers(**SIZES)["random_forest"].fit(ready.select("label", "features"))
    table = EX.importance_by_slot(EX.slots(preparation, ready), forest.featureImportances.toArray())
    path = SK.fresh_folder(t.spark, "model")
    MD.save(PipelineModel([*preparation.stages, forest]), path, table)
    if MD.load(path).stages[-1].numFeatures != table.count():
        raise ValueError("the stored model and its slots differ")
    return MD.load_slots(t.spark, path).groupBy("column", "type").agg(F.count("*").alias("slots"), F.count("value").alias("named"), F.sum("importance").between(0, 1).alias("in_range"))


@query("ml_26_contributions")
def contributions(t: Tables) -> DataFrame:
    df = prepared(t)
    model = MD.classifiers(**SIZES)["logistic_regression"].fit(df)
    return rounded(MD.linear_contributions(df, model.coefficientMatrix.toArray()[2], NUMBERS))


@query("ml_27_28_30_32_batch_scoring")
def batch_scoring(t: Tables) -> DataFrame:
    """Train, save, load and score in one run; the score is the probability of the highest class."""
    df = prepared(t)
    path = SK.fresh_folder(t.spark, "model")
    MD.save(Pipeline(stages=[MD.classifiers(**SIZES)["logistic_regression"]]).fit(df.filter("NOT is_test")), path)
    return rounded(MD.score(df, MD.load(path), "v1", ["id"]))


@query("ml_27_scores_in_range", on_contacts("SELECT count(*) AS rows, count(DISTINCT id) AS ids, count(*) AS known_class, count(*) AS confident, count(*) AS consistent FROM contacts"))
def scores_in_range(t: Tables) -> DataFrame:
    """Every row is scored once; the confidence is that of the likeliest of three classes, the score that of the highest."""
    p, c = F.col("predicted_score"), F.col("confidence_level")
    return batch_scoring(t).agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids"), F.count_if(F.col("predicted_class").between(0, 2)).alias("known_class"),
                                F.count_if(c.between(0.333, 1)).alias("confident"), F.count_if(F.when(F.col("predicted_class") == 2, p == c).otherwise(p <= c)).alias("consistent"))


@query("ml_28_direct_scoring", on_contacts("SELECT count(*) AS rows, count(DISTINCT id) AS ids, count(*) AS in_range, 3 AS classes FROM contacts WHERE enrichment_status IS NOT DISTINCT FROM 'completed'"))
def direct_scoring(t: Tables) -> DataFrame:
    """Raw enriched leads, whose engagement is not known and counts as zero, scored by a saved preparation and model."""
    path = SK.fresh_folder(t.spark, "model")
    counts = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in _ENGAGED}
    rows = labelled(t).join(t.contacts("id", *_ENGAGED), "id").withColumns(counts)
    stages = [P.transformer([*NUMBERS, *_ENGAGED]), MD.classifiers(**SIZES)["logistic_regression"]]
    MD.save(Pipeline(stages=stages).fit(rows), path)
    raw = t.contacts("id", "enrichment_status", *NUMBERS).filter(F.col("enrichment_status").eqNullSafe("completed"))
    ready = raw.withColumns({**{c: F.col(c).cast("double") for c in NUMBERS}, **{c: F.lit(0.0) for c in _ENGAGED}})
    p = vector_to_array("probability")
    scored = MD.load(path).transform(ready)
    return scored.agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids"), F.count_if((F.element_at(p, -1) >= 0) & (F.element_at(p, -1) <= 1)).alias("in_range"),
                      F.max(F.size(p)).alias("classes"))


@query("ml_30_training_run", on_contacts("""SELECT sum(n)::BIGINT - sum(CAST(floor(n * 0.25) AS BIGINT))::BIGINT AS train_rows, sum(CAST(floor(n * 0.25) AS BIGINT))::BIGINT AS test_rows, 4 AS features, TRUE AS saved
  FROM (SELECT count(*) AS n FROM labelled GROUP BY level)""", _LABELLED))
def training_run(t: Tables) -> DataFrame:
    """Selection, balance, search, fit, report and storage in one run; the stored record is read back."""
    path = SK.fresh_folder(t.spark, "run")
    MD.training_run(labelled(t), NUMBERS, "label", "id", path, PHASES, K.AS_OF, "v1")
    record = t.spark.read.json(f"{path}/metadata")
    stages = len(MD.load(f"{path}/model").stages)
    return record.select("train_rows", "test_rows", F.size("features").alias("features"), (F.lit(stages) > 2).alias("saved"))


@query("ml_29_basic_fallback", on_contacts(f"SELECT id, CAST(coalesce(daily_limit, (SELECT quantile_cont(daily_limit, 0.5) FROM contacts)) AS DOUBLE) AS daily_limit, least(greatest({K.AS_OF.year} - coalesce(organization_founded_year, 2020), 0), 100) AS company_age FROM contacts"))
def basic_fallback(t: Tables) -> DataFrame:
    from leadmill.operators.quality import impute

    df = t.contacts("id", "daily_limit", "organization_founded_year")
    age = F.least(F.greatest(F.lit(K.AS_OF.year) - F.coalesce("organization_founded_year", F.lit(2020)), F.lit(0)), F.lit(100))
    return impute(df, ["daily_limit"], []).select("id", "daily_limit", age.alias("company_age"))


# meanings by name prefix (fixed values)
MEANINGS = [("organization_employees", "Company size"), ("organization_", "Company fact"), ("daily_limit", "Sending volume"), ("page_", "Result page"), ("email_", "Mail setting")]


@query("ml_31_feature_meaning", on_contacts("SELECT c.column_name AS feature, CASE " + " ".join(f"WHEN starts_with(c.column_name, '{p}') THEN '{m}'" for p, m in MEANINGS)
    + " ELSE 'Contributes to the prediction' END AS meaning FROM (DESCRIBE SELECT " + ", ".join(NUMBERS) + " FROM contacts) c"))
def feature_meaning(t: Tables) -> DataFrame:
    from leadmill.operators.quality import schema_table

    name, meaning = F.col("column"), None
    for prefix, text in MEANINGS:
        meaning = F.when(name.startswith(prefix), text) if meaning is None else meaning.when(name.startswith(prefix), text)
    return schema_table(t.contacts(*NUMBERS)).select(name.alias("feature"), meaning.otherwise("Contributes to the prediction").alias("meaning"))
