"""Structured Streaming forms of the stateful operators.

State is bounded by watermarks or by a fixed size; each function takes and gives streaming DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def dedup(stream: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """First row of each key; a key is remembered for ``delay`` after the watermark."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def running_stats(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Count, mean and sum per key, for update or complete output."""
    return stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.sum(value).alias("total"))


def windowed_stats(stream: DataFrame, time: str, key: str, value: str, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Count and sum per key and window, late rows dropped after ``delay``."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    out = timed.groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n", "total")


def reservoir(stream: DataFrame, size: int, key: str, seed: int = 0, shards: int = 16) -> DataFrame:
    """The ``size`` rows of least lot so far, one row per shard and batch with the shard's keys and lots; the least ``size``
    over all shards are the sample. Rows enter by lot, so the sample doesn't depend on their order."""

    def step(shard, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        lots, keys = (list(x) for x in state.get) if state.exists else ([], [])
        best = dict(zip(keys, lots))
        for pdf in frames:
            best.update(zip(pdf["key"], pdf["lot"]))
            if len(best) > size:
                best = dict(sorted(best.items(), key=lambda kv: (kv[1], kv[0]))[:size])
        state.update((list(best.values()), list(best)))
        yield pd.DataFrame({"shard": [shard[0]], "lots": [list(best.values())], "keys": [list(best)]})

    lot = F.md5(F.concat(F.lit(f"{seed}-"), F.col(key).cast("string")))
    rows = stream.select(F.col(key).cast("string").alias("key"), lot.alias("lot"), F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard"))
    return rows.groupBy("shard").applyInPandasWithState(step, "shard int, lots array<string>, keys array<string>", "lots array<string>, keys array<string>", "update", GroupStateTimeout.NoTimeout)


def recent(stream: DataFrame, key: str, time: str, value: str, max_points: int = 1000) -> DataFrame:
    """Summary of the latest ``max_points`` points per key, from a ring of that size in the state."""

    def step(k, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, values = (list(x) for x in state.get) if state.exists else ([], [])
        points = list(zip(times, values))
        for pdf in frames:
            points = sorted(points + list(zip(pdf["t"], pdf["v"])))[-max_points:]
        state.update(([p[0] for p in points], [p[1] for p in points]))
        v = [p[1] for p in points]
        yield pd.DataFrame({"key": [k[0]], "n": [len(v)], "mean": [sum(v) / len(v)], "lo": [min(v)], "hi": [max(v)], "latest": [v[-1]]})

    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").cast("double").alias("t"), F.col(value).cast("double").alias("v")).dropna()
    return rows.groupBy("key").applyInPandasWithState(step, "key string, n long, mean double, lo double, hi double, latest double", "t array<double>, v array<double>", "update", GroupStateTimeout.NoTimeout)


def join_static(stream: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    return stream.join(lookup, key, how)


def write_partitions(stream: DataFrame, path: str, key: Column, checkpoint: str):
    """A query that appends each micro-batch to one folder per key."""
    from tidemark.operators.partitioning import partition_key

    def put(batch: DataFrame, _: int) -> None:
        batch.withColumn("_key", partition_key(key)).write.mode("append").partitionBy("_key").json(path)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).start()
