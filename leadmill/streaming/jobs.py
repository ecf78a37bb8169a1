"""Structured Streaming forms of the incremental paths.

Every job reads files as they land, keeps its progress in a checkpoint of the
shared folder and processes what is available, so that it can be started by any
timer and survives lost executors.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from leadmill.operators import keyed as KY
from leadmill.operators import layers as L
from leadmill.operators import sinks as SK


def stream_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet files of one table as a stream, with session-zone timestamps.

    A table may be a folder of files, which is the stream itself, or one file, which is picked out of its folder."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        df = source.parquet(path)
    else:
        df = source.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


def on_disk(spark: SparkSession) -> None:
    """State of the queries started from now on is kept on the executors' disks with a copy in the checkpoint, not in memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_available(df: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Processes all available input once and returns when it is done."""
    query = (df.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


# --- incremental layers -------------------------------------------------------------
def incremental_silver(events: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                       keys: Sequence[str] = ("id",)) -> None:
    """Row-local features of new records, appended once per key to a plain table: a replayed batch adds nothing."""
    run_available(events, lambda df, _: SK.append_new(build(df), path, keys), checkpoint)


def incremental_keyed(events: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                      keys: Sequence[str] = ("id",)) -> None:
    """The same into a keyed table: a replayed batch is not looked at again, and one of another run reads only the folders
    that may hold its keys."""
    run = zlib.crc32(checkpoint.encode())
    run_available(events, lambda df, n: KY.append_keyed(build(df), path, keys, f"{run}-{n}"), checkpoint)


def promote(silver: DataFrame, path: str, as_of: datetime, batch: str) -> None:
    """Mature silver rows that the keyed gold table lacks.  Maturity depends on the given time alone, so no state is kept."""
    KY.append_keyed(L.gold_quality(L.mature(silver, as_of)), path, ["id"], batch)


# --- windows -----------------------------------------------------------------------
def activity_windows(events: DataFrame, window: str = "1 hour", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Events and value per time window and type; the watermark bounds the state."""
    span = F.window("ts", window, slide) if slide else F.window("ts", window)
    return (events.withWatermark("ts", late).groupBy(span.alias("w"), "event_type")
            .agg(F.count("*").alias("events"), F.sum("value").alias("value"))
            .select(F.col("w.start").alias("start"), "event_type", "events", "value"))


def write_updates(df: DataFrame, path: str, checkpoint: str, mode: str = "update") -> None:
    """Changed rows of an aggregation (or, with mode ``append``, finished ones) with the number of the batch that wrote them.

    A batch has a folder of its own, so that a replayed one replaces what it wrote before."""
    run_available(df, lambda part, n: part.write.mode("overwrite").parquet(f"{path}/batch={n}"), checkpoint, mode)


def latest_updates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last written state of every key."""
    from leadmill.operators.quality import latest_per_key

    return latest_per_key(df, keys, [F.col("batch")]).drop("batch")


def engagement_rate(events: DataFrame, window: str = "7 days", slide: str = "1 day", late: str = "1 day") -> DataFrame:
    """Opens per event over a sliding window."""
    return (events.withWatermark("ts", late).groupBy(F.window("ts", window, slide).alias("w"))
            .agg(F.count_if(F.col("event_type") == "view").alias("opens"), F.count("*").alias("events"))
            .select(F.col("w.start").alias("start"), "opens", "events"))


def first_contacts(events: DataFrame, key: str, forget: str | None = None) -> DataFrame:
    """The first record of each key.

    Without ``forget`` however long ago the key was seen before: the state holds one entry per key and never expires, on
    the executors' disks. With it a key leaves the state once the watermark has passed its first record by so long, and is new again."""
    on_disk(events.sparkSession)
    return events.withWatermark("ts", forget).dropDuplicatesWithinWatermark([key]) if forget else events.dropDuplicates([key])


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """Activity sessions per user; with ``late`` usable on a stream."""
    held = events.withWatermark("ts", late) if late else events
    return (held.groupBy("user_id", F.session_window("ts", gap).alias("s")).agg(F.count("*").alias("events"))
            .select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events"))


# --- alert cool-down -----------------------------------------------------------------
#: Groups that the keys are dealt to by hash; a checkpoint wants the same number again.
GROUPS = 1024
#: Alerts that are gathered before repeats are taken out.
GATHERED = 1 << 20


def let_through(of: np.ndarray, second: np.ndarray, last: np.ndarray, seconds: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, second) of the alerts that pass, all keys at a time; ``of`` and ``second`` are in order, ``last`` has a place
    per key and is brought up to date. A turn finds the next alert of every key that has one."""
    low, high = (np.searchsorted(of, np.arange(len(last)), side) for side in ("left", "right"))
    least = int(second.min()) if len(second) else 0
    span = int(second.max()) - least + 2 if len(second) else 1
    place, keys, sent = of * span + (second - least), np.flatnonzero(high > low), []
    while len(keys):
        after = np.clip(last[keys] + seconds + 1 - least, 0, span - 1)
        at = np.searchsorted(place, keys * span + after)
        found = at < high[keys]
        keys, at = keys[found], at[found]
        last[keys] = second[at]
        sent.append((keys, second[at]))
    return tuple(np.concatenate(x) for x in zip(*sent)) if sent else (np.zeros(0, np.int64),) * 2


def timed_cool_down(alerts: DataFrame, key: str, seconds: int = 3600, late: str = "1 day") -> DataFrame:
    """Alerts let through per key, at most one within ``seconds``, given once the watermark has passed them; alerts that come
    more than ``late`` behind the newest are not counted.

    Keys are judged many at a time, ``GROUPS`` groups of them, as calls by key cost more than the work. A key's state, on
    the executors' disks, is the last alert that passed, until the cool-down is over, and the distinct seconds that wait
    for the watermark; repeats go chunk by chunk, so the size follows the time that waits, not the alerts."""
    on_disk(alerts.sparkSession)
    never = np.iinfo(np.int64).min // 2

    def step(_, batches, state: GroupState):
        names, last, of, second = state.get if state.exists else ([], b"", b"", b"")
        last, of, second = (np.frombuffer(x, np.int64).copy() for x in (last, of, second))
        place, passed = {name: n for n, name in enumerate(names)}, state.getCurrentWatermarkMs()
        parts = [(of, second)]
        for pdf in () if state.hasTimedOut else batches:
            pdf = pdf.dropna(subset=["second"])
            own = pdf["second"].to_numpy(np.int64)
            codes, found = pd.factorize(pdf["name"].to_numpy(object)[own * 1000 > passed], use_na_sentinel=False)
            found = [None if pd.isna(x) else x for x in found]
            at = np.array([place.setdefault(name, len(place)) for name in found], np.int64)
            parts.append((at[codes], own[own * 1000 > passed]))
            if sum(len(x) for x, _ in parts[1:]) > GATHERED + len(parts[0][0]):
                parts = [tuple(np.unique(np.concatenate(parts, axis=1), axis=1))]
        of, second = np.unique(np.concatenate(parts, axis=1), axis=1)
        last = np.concatenate([last, np.full(len(place) - len(last), never)])
        due = second * 1000 <= passed
        keys, sent = let_through(of[due], second[due], last, seconds)
        of, second, names = of[~due], second[~due], list(place)
        kept = np.flatnonzero((np.bincount(of, minlength=len(names)) > 0) | ((last > never) & ((last + seconds) * 1000 >= passed)))
        if len(kept):
            new = np.zeros(len(names), np.int64)
            new[kept] = np.arange(len(kept))
            state.update(([names[n] for n in kept], last[kept].tobytes(), new[of].tobytes(), second.tobytes()))
            moment = min([int(second.min())] if len(second) else [int(last[kept].max()) + seconds + 1])
            state.setTimeoutTimestamp(max(moment * 1000, passed + 1))
        elif state.exists:
            state.remove()
        if len(sent):
            yield pd.DataFrame({"name": pd.Series([names[n] for n in keys], dtype=object), "second": sent})

    group = F.pmod(F.xxhash64(key), F.lit(GROUPS)).cast("int").alias("_group")
    moments = alerts.withWatermark("ts", late).select(group, F.col(key).cast("string").alias("name"), "ts", F.unix_seconds("ts").alias("second"))
    out = moments.groupBy("_group").applyInPandasWithState(step, "name string, second bigint", "names array<string>, last binary, of binary, waiting binary", "append",
                                                          GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("name").cast(dict(alerts.dtypes)[key]).alias(key), "second")


def cool_down(alerts: DataFrame, key: str, seconds: int = 3600, late: str = "1 day") -> DataFrame:
    """Alerts let through per key, at most one within ``seconds``.

    Alerts are judged in the batch they come in, which answers at once but holds the distinct seconds of a key and batch
    in memory and wants batches in order; ``timed_cool_down`` does without either. The state is one time per key and is
    dropped when the watermark is past the cool-down, since the next alert passes anyway."""
    def step(keys: tuple, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        times = np.unique(np.concatenate([pdf["second"].to_numpy(np.int64) for pdf in batches]))
        sent = []
        while len(times):
            times = times if last is None else times[np.searchsorted(times, last + seconds, "right"):]
            if len(times):
                last = int(times[0])
                sent.append(last)
        if last is not None:
            state.update((last,))
            state.setTimeoutTimestamp(max((last + seconds + 1) * 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [keys[0]] * len(sent), "second": pd.Series(sent, dtype="int64")})

    moments = alerts.withWatermark("ts", late).select(key, "ts", F.unix_seconds("ts").alias("second"))
    kind = dict(alerts.dtypes)[key]
    return moments.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, second bigint", "last bigint", "append",
                                                       GroupStateTimeout.EventTimeTimeout)
