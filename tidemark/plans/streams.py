"""The streaming operators, each run over the whole events table until no input is left, with the same in SQL.

A run keeps its offsets and its output in the shared checkpoint folder, in a folder of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.tables import load
from tidemark.streaming import operators as ops


def _events(spark: SparkSession, d: str) -> DataFrame:
    return spark.readStream.schema(load(spark, d, "events").schema).parquet(f"{d}/events*.parquet")


def drain(stream: DataFrame, mode: str = "update", keys: list[str] | None = None) -> DataFrame:
    """Runs a streaming query over what there is; of rows updated several times, by ``keys``, the last."""
    spark = stream.sparkSession
    at = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, n: int) -> None:
        batch.withColumn("__batch", F.lit(n)).write.mode("overwrite").parquet(f"{at}/out/__part={n}")

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{at}/offsets").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.option("basePath", f"{at}/out").parquet(f"{at}/out/*").drop("__part")
    if keys is None:
        return out.drop("__batch")
    last = F.max_by(F.struct(*[c for c in out.columns if c != "__batch"]), "__batch")
    return out.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(last.alias("r")).select("r.*")


def stream_dedup(spark, d):
    return drain(ops.dedup(_events(spark, d), ["event_id"], "ts").select("event_id", "event_type"), "append")


def stream_stats(spark, d):
    return drain(ops.running_stats(_events(spark, d), "event_type", "value"), "update", ["event_type"])


def stream_windows(spark, d):
    out = drain(ops.windowed_stats(_events(spark, d), "ts", "event_type", "value", "1 day"), "update", ["start", "event_type"])
    return out.select(F.col("start").cast("date").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def stream_reservoir(spark, d):
    shards = drain(ops.reservoir(_events(spark, d), 50, "event_id", 7), "update", ["shard"])
    flat = shards.select(F.explode(F.arrays_zip("lots", "keys")).alias("x")).select(F.col("x.lots").alias("lot"), F.col("x.keys").cast("long").alias("event_id"))
    return flat.orderBy("lot", "event_id").limit(50).select("event_id")


def stream_recent(spark, d):
    return drain(ops.recent(_events(spark, d), "event_type", "ts", "value", 100), "update", ["key"]).select("key", "n", "lo", "hi")


def stream_join(spark, d):
    lookup = load(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    joined = ops.join_static(_events(spark, d), lookup, "user_id")
    return drain(ops.running_stats(joined, "c_mktsegment", "value"), "update", ["c_mktsegment"]).select("c_mktsegment", "n")


QUERIES = {f.__name__: f for f in (stream_dedup, stream_stats, stream_windows, stream_reservoir, stream_recent, stream_join)}
SQL = {
    "stream_dedup": "SELECT event_id, event_type FROM events",
    "stream_stats": "SELECT event_type, count(*) AS n, avg(value) AS mean, sum(value) AS total FROM events GROUP BY 1",
    "stream_windows": "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "stream_reservoir": "SELECT event_id FROM events ORDER BY md5('7-' || event_id), event_id LIMIT 50",
    "stream_recent": "SELECT event_type AS key, count(*) AS n, min(value) AS lo, max(value) AS hi FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, value DESC) AS rn FROM events WHERE value IS NOT NULL) WHERE rn <= 100 GROUP BY 1",
    "stream_join": "SELECT c_mktsegment, count(*) AS n FROM events LEFT JOIN customer ON user_id = c_custkey GROUP BY 1",
}
