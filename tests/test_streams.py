"""Stateful streams over several batches with restarts beside plain Python."""

import random
import tempfile
import time
from datetime import datetime, timedelta, timezone

import pytest

from leadmill.streaming import jobs

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def land(spark, rows, folder):
    spark.createDataFrame([(u, START + timedelta(seconds=s)) for u, s in rows], "user_id long, ts timestamp").coalesce(1).write.mode("append").parquet(folder)


def through(rows, seconds):
    out = []
    for user in {u for u, _ in rows}:
        last = None
        for second in sorted({s for u, s in rows if u == user}):
            if last is None or second - last > seconds:
                out.append((user, second))
                last = second
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_cool_down_over_restarts(spark, seed):
    """Three batches with a restart each; a user has a third of all alerts; alerts come out of order by up to two hours."""
    rng = random.Random(seed)
    rows = [(0 if n % 3 == 0 else rng.randrange(1, 12), n * 97 % 300_000) for n in range(900)]
    rows = sorted(rows, key=lambda r: r[1] + rng.randrange(7200))
    rows += rows[::50]  # repeats
    rows.sort(key=lambda r: r[1] // 7200)
    folder, out, progress = (tempfile.mkdtemp(prefix=f"{n}-") for n in ("landed", "out", "progress"))
    at = int(START.timestamp())
    for part in (rows[:300], rows[300:500], rows[500:], [(-1, 10_000_000)]):
        land(spark, part, folder)
        stream = spark.readStream.schema("user_id long, ts timestamp").parquet(folder)
        jobs.run_available(jobs.timed_cool_down(stream, "user_id", 5000, "6 hours"), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), progress)
    got = [(r["user_id"], r["second"] - at) for r in spark.read.schema("user_id long, second long, batch long").parquet(out).collect() if r["user_id"] >= 0]
    assert sorted(got) == through(rows, 5000)


def test_first_contacts_may_be_forgotten(spark):
    folder = tempfile.mkdtemp(prefix="landed-")
    outs = {}
    for name, forget in (("ever", None), ("hour", "1 hour")):
        out, progress, folder = (tempfile.mkdtemp(prefix=f"{n}-") for n in ("out", "progress", "landed"))
        for part in ([(1, 0), (1, 60), (2, 100)], [(3, 20_000)], [(2, 30_000), (3, 20_050)], [(1, 40_000), (3, 40_001)]):
            land(spark, part, folder)
            stream = spark.readStream.schema("user_id long, ts timestamp").parquet(folder)
            jobs.run_available(jobs.first_contacts(stream, "user_id", forget), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), progress)
        outs[name] = sorted(r["user_id"] for r in spark.read.schema("user_id long, ts timestamp, batch long").parquet(out).collect())
    assert outs == {"ever": [1, 2, 3], "hour": [1, 1, 2, 2, 3, 3]}


def test_many_keys_cool_down_at_a_time(spark):
    """20,000 keys of few alerts beside one of many: a job of a timer per alert took more than a minute for them."""
    rng = random.Random(5)
    rows = [(n, rng.randrange(300_000)) for n in range(1, 20_001) for _ in range(3)] + [(0, s) for s in range(0, 200_000, 3)]
    folder, out, progress = (tempfile.mkdtemp(prefix=f"{n}-") for n in ("landed", "out", "progress"))
    at, started = int(START.timestamp()), time.monotonic()
    for part in (rows, [(-1, 10_000_000)]):
        land(spark, part, folder)
        stream = spark.readStream.schema("user_id long, ts timestamp").parquet(folder)
        jobs.run_available(jobs.timed_cool_down(stream, "user_id", 86_400), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), progress)
    took = time.monotonic() - started
    got = [(r["user_id"], r["second"] - at) for r in spark.read.schema("user_id long, second long, batch long").parquet(out).collect() if r["user_id"] >= 0]
    own = {}
    for user, second in rows:
        own.setdefault(user, []).append((user, second))
    assert sorted(got) == sorted(x for mine in own.values() for x in through(mine, 86_400))
    assert took < 60
