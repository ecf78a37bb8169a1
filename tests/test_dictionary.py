"""Value dictionary and places in an order beside plain Python."""

import random
from collections import Counter

from pyspark.sql import functions as F

from leadmill.operators import dictionary as D
from leadmill.operators import encode as E


def frame(spark, n=6000):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"v{rng.randrange(2500)}", rng.choice(["x", "y", None]), rng.randrange(5000)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, a string, b string, c long").repartition(7)


def test_positions_without_one_task(spark):
    rows, df = frame(spark)
    placed = D.ordered_positions(df, [-F.col("c"), "id"])
    got = {r["id"]: r["position"] for r in placed.collect()}
    assert got == {r[0]: n + 1 for n, r in enumerate(sorted(rows, key=lambda r: (-r[3], r[0])))}
    assert D.ordered_positions(df.limit(0), ["id"]).count() == 0


def test_dictionary(spark):
    rows, df = frame(spark)
    got = {(r["dimension"], r["value"]): (r["n"], round(r["share"], 9), r["code"]) for r in D.value_dictionary(df, ["a", "b", "c"]).collect()}
    want = {}
    for place, name in enumerate("abc", 1):
        counts = Counter(str(r[place]) for r in rows if r[place] is not None)
        want |= {(name, v): (n, round(n / max(counts.values()), 9), code) for code, (v, n) in enumerate(sorted(counts.items()))}
    assert got == want


def test_facts_of_hot_and_rare_values(spark):
    rows, df = frame(spark)
    got = {r["id"]: r.asDict() for r in E.with_frequency(df, ["a", "b", "c"], normalise=["a"]).collect()}
    counts = [Counter(str(r[p]) for r in rows if r[p] is not None) for p in (1, 2, 3)]
    assert len(got) == len(rows) and "b_frequency_norm" not in got[0]
    for r in rows:
        own = got[r[0]]
        assert [own[f"{c}_frequency"] for c in "abc"] == [counts[p][str(r[p + 1])] if r[p + 1] is not None else 0 for p in range(3)]
        assert own["a"] == r[1] and abs(own["a_frequency_norm"] - own["a_frequency"] / max(counts[0].values())) < 1e-12
    coded = {r["id"]: (r["a_code"], r["b_code"]) for r in E.label_codes(df, ["a", "b"]).collect()}
    orders = [{v: n for n, v in enumerate(sorted({r[p] or "Unknown" for r in rows}))} for p in (1, 2)]
    assert coded == {r[0]: (orders[0][r[1] or "Unknown"], orders[1][r[2] or "Unknown"]) for r in rows}


def test_no_exchange_into_one_task(spark):
    _, df = frame(spark)
    plan = E.label_codes(df, ["a", "b"])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_empty_frame(spark):
    _, df = frame(spark)
    assert E.with_frequency(df.limit(0), ["a"], normalise=True).count() == 0
