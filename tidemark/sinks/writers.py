"""Sinks: JSON lines, one JSON array, CSV, Parquet, per-key folders, tables and JDBC."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.partitioning import OTHER, partition_key

FORMATS = ("jsonl", "json", "csv")


def to_jsonl(df: DataFrame, path: str) -> int:
    """A folder of JSON lines, nulls written; returns the number of rows, counted by the job that writes."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def json_array(texts: DataFrame, path: str, indent: int = 2) -> int:
    """One JSON array in one file from a column of JSON texts, for results of report size. The texts are written by the
    executors first, which also ends any observation of them; then they are streamed in order, never held at once."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    parts, spark, n = f"{path}.parts", texts.sparkSession, 0
    texts.write.mode("overwrite").text(parts)
    texts = spark.read.text(parts).select("value", F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i")).orderBy("f", "i").select("value")
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for row in texts.toLocalIterator():
            body = json.dumps(json.loads(row[0]), ensure_ascii=False, indent=indent)
            f.write(("," if n else "") + "\n" + "\n".join(" " * indent + x for x in body.split("\n")))
            n += 1
        f.write("\n]\n" if n else "]\n")
    at = spark._jvm.org.apache.hadoop.fs.Path(parts)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return n


def to_json(df: DataFrame, path: str, indent: int = 2) -> int:
    """One JSON array, nulls written."""
    return json_array(df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})), path, indent)


def to_csv(df: DataFrame, path: str, fields: list[str] | None = None) -> None:
    """With header; ``fields`` are the columns to write, absent ones empty."""
    if fields is not None:
        df = df.select(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string")).alias(c) for c in fields])
    elif not df.columns:
        raise ValueError("no fields")
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="", nullValue="").csv(path)


def export(df: DataFrame, path: str, fmt: str = "jsonl", **how):
    name = fmt.lower().lstrip(".")
    if name not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    return to_jsonl(df, path) if name == "jsonl" else to_json(df, path, **how) if name == "json" else to_csv(df, path, **how)


def to_partitions(df: DataFrame, path: str, key: str, default: str = OTHER) -> None:
    """One folder of JSON lines per key, ``/`` and ``\\`` in keys as ``_``. A hot key is written by as many tasks as hold it."""
    safe = F.translate(partition_key(F.col(f"`{key}`"), default), "/\\", "__")
    df.withColumn("_key", safe).write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("_key").json(path)


def to_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def to_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 1000, **options) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_size, **options).mode("append").save()


def to_chunks(df: DataFrame, path: str, order: list[str], chunks: int, column: str = "value") -> None:
    """Contiguous chunks of text lines, a folder each, lines in order within it."""
    from tidemark.operators.partitioning import split_chunks

    split_chunks(df, order, chunks).repartition("chunk").sortWithinPartitions("chunk", *order).select("chunk", column).write.mode("overwrite").partitionBy("chunk").text(path)
