"""Hand rows for edges and quirks, and brute-force checks of the distributed operators."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill import constants as K
from leadmill.functions import categories as C
from leadmill.functions import dates as D
from leadmill.functions import scores as S
from leadmill.functions import text as T
from leadmill.functions.expr import cut, days_between
from leadmill.operators import encode as E
from leadmill.operators import monitor as M
from leadmill.operators import quality as Q
from leadmill.operators import quantiles as QU
from leadmill.operators import sinks as SK


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def test_engagement_level_reads_text_counts(spark):
    df = spark.createDataFrame([("3", "0", None), ("x", None, None), ("0", "1", "0"), (None, None, "2"), ("0", "0", "0")], "o string, c string, r string")
    assert values(df.select(S.engagement_level(F.col("o"), F.col("c"), F.col("r")).alias("v"))) == [1, 0, 2, 2, 0]


def test_cut_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 10.0, 10.5, 50.0, 1e9, None)], "x double")
    got = values(df.select(cut(F.col("x"), *K.SIZE_CATEGORY_BINS).alias("v")))
    assert got == [None, "Startup", "Startup", "Small", "Small", "Enterprise", None]
    assert values(df.select(C.company_size_band(F.col("x")).alias("v"))) == [None, "Unknown", "1-10", "11-50", "11-50", "10000+", None]


def test_elapsed_days_are_floored(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2), datetime(2024, 1, 1, 12)), (datetime(2024, 1, 1), datetime(2024, 1, 1, 12))], "a timestamp, b timestamp")
    assert values(df.select(days_between(F.col("a"), F.col("b")).alias("v"))) == [0, -1]


def test_maturity_edges(spark):
    now = datetime(2024, 3, 1)
    df = spark.createDataFrame([(now - timedelta(days=d),) for d in (29, 30, 31)] + [(None,)], "t timestamp")
    assert values(df.select(D.is_mature(F.col("t"), now).alias("v"))) == [False, True, True, False]


def test_text_edges(spark):
    df = spark.createDataFrame([("",), ("  a  B ",), ("!?.",), ("Élan vital, 2x",), ("finance department report",)], "t string")
    assert values(df.select(T.word_count(F.col("t")).alias("v"))) == [0, 2, 1, 3, 3]
    assert values(df.select(T.clean_text(F.col("t")).alias("v"))) == ["", "a b", "", "élan vital 2x", "finance department report"]
    assert values(df.select(T.quality_score(F.col("t"), legacy=True).alias("v")))[4] == 1


def test_category_quirks(spark):
    df = spark.createDataFrame([("financial services", "Director", None)], "i string, t string, n string")
    row = df.select(C.industry_category(F.col("i")).alias("industry"), C.seniority_category(F.col("n"), F.col("t")).alias("loose"),
                    C.seniority_category(F.col("n"), F.col("t"), whole_words=True).alias("strict"),
                    C.service_industry(F.lit("hospitality")).alias("service")).first()
    # the last rule holds "nan", and "cto" is part of "director", "it" of "hospitality"
    assert (row.industry, row.loose, row.strict, row.service) == ("Other", "C-Level", "VP/Director", "technology")


def test_newest_row_wins_and_null_keys_stay(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), (None, 5, "x"), (None, 4, "y")], "k string, t int, v string")
    assert sorted(values(Q.latest_per_key(df, ["k"], [F.col("t")]))) == ["new", "x"]


@pytest.mark.parametrize("size", [1, 2, 300, 120_000])
@pytest.mark.parametrize("hot", [0.0, 0.35, 1.0])
def test_quantiles_match_numpy_with_a_hot_value(spark, size, hot):
    rng = np.random.default_rng(3)
    data = np.where(rng.random(size) < hot, 7.25, rng.lognormal(2, 1.5, size))
    df = spark.createDataFrame([(float(x),) for x in data], "x double").repartition(6)
    row = QU.exact_quantiles(df, ["x"], [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]).first()
    expected = np.quantile(data, [0.0, 0.01, 0.25, 0.5, 0.95, 1.0])
    assert np.allclose([row[f"q{i}"] for i in range(6)], expected, rtol=1e-12)
    by = QU.exact_quantiles(df.withColumn("g", F.lit("a")), ["x"], [0.25, 0.5], ["g"]).first()
    assert np.allclose([by.q0, by.q1], np.quantile(data, [0.25, 0.5]), rtol=1e-12)


def test_hash_order_is_a_permutation_per_group(spark):
    df = spark.range(5000).withColumn("g", (F.col("id") % 7 == 0).cast("int"))
    got = QU.hash_order(df, ["g"], ["id"]).groupBy("g").agg(
        F.count("*").alias("n"), F.count_distinct("position").alias("d"), F.min("position").alias("lo"), F.max("position").alias("hi"), F.max("group_rows").alias("size"))
    for r in got.collect():
        assert r.n == r.d == r.hi == r["size"] and r.lo == 1


def test_cool_down_against_brute_force(spark):
    rng = np.random.default_rng(5)
    start = datetime(2024, 1, 1)
    fired = [(int(k), start + timedelta(seconds=int(s))) for k, s in zip(rng.integers(0, 3, 400), rng.integers(0, 200_000, 400))]
    expected = set()
    for key in {k for k, _ in fired}:
        last = None
        for _, ts in sorted(f for f in fired if f[0] == key):
            if last is None or (ts - last).total_seconds() > 3600:
                expected.add((key, ts))
                last = ts
    got = M.cool_down(spark.createDataFrame(fired, "k int, ts timestamp"), ["k"], "ts")
    assert {(r.k, r.ts) for r in got.collect()} == expected


def test_upsert_and_partial_upsert(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    source = spark.createDataFrame([(2, "B", 9, 1), (3, "c", 3, 1), (3, "C", 4, 2)], "k int, v string, w int, o int")
    merged = SK.merge_upsert(target, source, ["k"], order=[F.col("o")]).drop("o")
    assert sorted(map(tuple, merged.collect())) == [(1, "a", 1), (2, "B", 9), (3, "C", 4)]
    partial = SK.merge_columns(target, source.filter("k = 2").drop("o"), ["k"], ["w"])
    assert sorted(map(tuple, partial.collect())) == [(1, "a", 1), (2, "b", 9)]


def test_upsert_table_rewrites_only_touched_partitions(spark):
    path = SK.fresh_folder(spark, "table")
    first = spark.createDataFrame([(1, 0, "a"), (2, 1, "b")], "k int, p int, v string")
    SK.upsert_table(first, path, ["k"], "p")
    SK.upsert_table(spark.createDataFrame([(2, 1, "B"), (3, 1, "c")], "k int, p int, v string"), path, ["k"], "p")
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_append_new_twice_adds_nothing(spark):
    path = SK.fresh_folder(spark, "ids")
    for _ in range(2):
        SK.append_new(spark.range(10), path, ["id"])
    assert spark.read.parquet(path).count() == 10


def test_frequency_of_hot_and_null_values(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",), (None,)], "c string")
    got = {r.c: (r.c_frequency, r.c_frequency_norm) for r in E.with_frequency(df, ["c"], True).collect()}
    assert got == {"a": (5, 1.0), "b": (1, 0.2), None: (0, 0.0)}


def test_smoothing_matches_pandas(spark):
    import pandas as pd

    from leadmill.operators.timeseries import smooth

    data = [("s", i, float((i * 7) % 11)) for i in range(40)]
    got = smooth(spark.createDataFrame(data, "g string, d int, v double"), ["g"], "d", "v").orderBy("d").toPandas()
    series = pd.Series([v for _, _, v in data])
    assert np.allclose(got["v_sma"], series.rolling(4, min_periods=1).mean())
    assert np.allclose(got["v_ema"], series.ewm(span=4).mean())


def test_first_upsert_is_a_merge(spark):
    path = SK.fresh_folder(spark, "table")
    rows = spark.createDataFrame([(1, 0, "a", 1), (1, 0, "b", 2), (2, 1, "c", 1)], "k int, p int, v string, o int")
    for _ in range(2):
        SK.upsert_table(rows, path, ["k"], "p", stamp=F.lit("now"), order=[F.col("o")])
        assert sorted((r.k, r.v, r.updated_timestamp) for r in spark.read.parquet(path).collect()) == [(1, "b", "now"), (2, "c", "now")]


def test_append_new_keeps_one_row_per_key(spark):
    path = SK.fresh_folder(spark, "ids")
    rows = spark.createDataFrame([(1, "x", 0), (1, "y", 0), (2, "z", 1), (None, "n", 0)], "id int, v string, part int")
    for _ in range(2):
        SK.append_new(rows, path, ["id"], ["part"], order=[F.col("v")])
    got = [(r.id, r.v) for r in spark.read.parquet(path).where("id IS NOT NULL").collect()]
    assert sorted(got) == [(1, "y"), (2, "z")]


def test_an_older_entry_is_activated(spark):
    registry = spark.createDataFrame([("a", 1, 10, True), ("a", 2, 9, False), ("b", 1, 5, True)], "model_type string, version int, created int, is_active boolean")
    entry = spark.createDataFrame([("a", 3, 1), ("a", 4, 2)], "model_type string, version int, created int")
    out = {(r.model_type, r.version): r.is_active for r in SK.register_model(registry, entry).collect()}
    assert out == {("a", 1): False, ("a", 2): False, ("a", 3): False, ("a", 4): True, ("b", 1): True}


def test_streams_over_a_folder_of_files(spark):
    from leadmill.streaming import jobs

    base = SK.fresh_folder(spark, "lake")
    rows = [(n, datetime(2024, 1, 1) + timedelta(minutes=7 * n), n % 3) for n in range(40)]
    df = spark.createDataFrame([*rows, rows[5]], "event_id long, ts timestamp, user_id int")
    df.repartition(4).write.parquet(f"{base}/events.parquet")
    path = SK.fresh_folder(spark, "out")
    for run in ("a", "b"):  # the second run replays everything
        jobs.incremental_silver(jobs.stream_table(spark, base, "events"), lambda d: d.select(F.col("event_id").alias("id")), path, SK.fresh_folder(spark, run))
    assert sorted(values(spark.read.parquet(path), "id")) == list(range(40))
    sent = SK.fresh_folder(spark, "sent")
    alerts = jobs.cool_down(jobs.stream_table(spark, base, "events"), "user_id", 3600)
    jobs.run_available(alerts, lambda d, _: d.write.mode("append").parquet(sent), SK.fresh_folder(spark, "progress"))
    want = []
    for user in range(3):
        last = None
        for n in range(user, 40, 3):
            if last is None or 420 * (n - last) > 3600:
                last = n
                want.append((user, n))
    got = {(r.user_id, (r.second - spark.sql("SELECT unix_seconds(TIMESTAMP '2024-01-01')").first()[0]) // 420) for r in spark.read.parquet(sent).collect()}
    assert got == set(want)


def test_shared_folder_must_be_named_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError):
        SK.shared_folder(Session())


def test_isolation_samples_are_bounded_and_outliers_stand_out(spark):
    """An id that most rows share fills no tree beyond its size, and the score falls towards the middle of the values."""
    rows = [(7, float(n % 50)) for n in range(30_000)] + [(100 + n, 25.0 + n % 3) for n in range(4_000)] + [(9_000, 4_000.0), (9_001, None)]
    df = spark.createDataFrame(rows, "id long, x double")
    for part in (df, df.limit(700), df.where("x > 100")):
        n = part.where("x is not null").count()
        sizes = [r["count"] for r in Q.tree_samples(part, "x", "id").groupBy("tree").count().collect()]
        decks = max(1, min(n, 25_600) // 256)
        assert len(sizes) == 100 and min(sizes) == min(n, 25_600) // decks and max(sizes) == -(-min(n, 25_600) // decks)
    every = [tuple(r) for r in Q.tree_samples(df, "x", "id", trees=4, sample=100).collect()]
    assert sorted(every) == sorted(tuple(r) for r in Q.tree_samples(df.repartition(11), "x", "id", trees=4, sample=100).collect())
    score = {r.id: r.isolation_score for r in Q.isolation_scores(df, "x", "id").where("id <> 7").collect()}
    assert score[9_000] > max(s for i, s in score.items() if i < 9_000) and score[9_001] is None
    assert Q.isolation_scores(df.where("x is null"), "x", "id").first()["isolation_score"] is None
