"""JSON-lines sources, read as variants or under a schema, in bulk or strictly."""

from __future__ import annotations

import glob
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import strip


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return len(at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []) > 0


def _paths(spark: SparkSession, paths: str | list[str]) -> list[str]:
    paths = [paths] if isinstance(paths, str) else list(paths)
    for p in paths:
        if not _exists(spark, p):
            raise FileNotFoundError(p)
    return paths


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None, skip_errors: bool = True, place: bool = False) -> DataFrame:
    """Records of JSON lines. Blank lines, malformed lines and the literal ``null`` are left out; ``skip_errors=False``
    fails on a malformed line. With a schema the columns are typed, else there is one variant column ``record``. ``place`` adds
    ``__place``, which orders records as they lie in the files."""
    at = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    extra = ["__place"] if place else []
    lines = spark.read.text(_paths(spark, paths))
    lines = (lines.select("value", at.alias("__place")) if place else lines).filter(strip(F.col("value")) != "")
    parse = F.try_parse_json if skip_errors else F.parse_json
    parsed = lines.select(parse("value").alias("record"), *extra).filter(F.col("record").isNotNull() & (F.schema_of_variant("record") != "VOID"))
    if schema is None:
        return parsed
    return parsed.select(*extra, *[F.try_variant_get("record", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def read_existing(spark: SparkSession, paths: list[str], **how) -> DataFrame:
    """Union of the files that exist; missing ones are skipped."""
    there = [p for p in paths if _exists(spark, p)]
    if not there:
        raise FileNotFoundError(", ".join(paths))
    return read_jsonl(spark, there, **how)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) with line numbers from 1, over files in the order of their names. A line's block of its file (at most
    ``spark.sql.files.maxPartitionBytes``) is what is numbered by itself; lines of the blocks before are counted and added."""
    from tidemark.operators.partitioning import number_within

    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    raw = spark.read.text(_paths(spark, path)).select("value", place.alias("block"), F.monotonically_increasing_id().alias("i"))
    return number_within(raw, "block", ["i"], 1).select(F.col("rn").alias("line"), "value")


def count_lines(spark: SparkSession, path: str) -> int:
    """Lines, blank ones and an unterminated last one among them."""
    return spark.read.text(_paths(spark, path)).count()


def files_of(spark: SparkSession, pattern: str, recursive: bool = False) -> list[tuple[str, int]]:
    """(path, bytes) of the files a path or pattern names, by name, through the file-system API, so of any file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(pattern)
    fs, out = at.getFileSystem(conf), []
    for found in fs.globStatus(at) or []:
        if found.isFile():
            out.append((found.getPath().toString(), found.getLen()))
            continue
        inside = fs.listFiles(found.getPath(), recursive)
        while inside.hasNext():
            f = inside.next()
            if not f.getPath().getName().startswith(("_", ".")):
                out.append((f.getPath().toString(), f.getLen()))
    return sorted(out)


def count_newlines(spark: SparkSession, path: str) -> int:
    """Newline bytes; an unterminated last line isn't counted. Lines are counted in splits; of each file only the last byte is
    read besides."""
    rows = spark.read.option("lineSep", "\n").text(_paths(spark, path)).count()
    open_end = 0
    for name, size in files_of(spark, path):
        if size:
            at = spark._jvm.org.apache.hadoop.fs.Path(name)
            stream = at.getFileSystem(spark._jsc.hadoopConfiguration()).open(at)
            try:
                stream.seek(size - 1)
                open_end += stream.read() != 10
            finally:
                stream.close()
    return rows - open_end


def list_jsonl(folder: str, recursive: bool = False, spark: SparkSession | None = None) -> list[str]:
    """Names of the ``*.jsonl`` files of a folder; with a session, of a folder of any file system."""
    if spark is not None:
        return [p for p, _ in files_of(spark, folder, recursive) if p.endswith(".jsonl")]
    return sorted(glob.glob(os.path.join(folder, "**" if recursive else "", "*.jsonl"), recursive=recursive))


def size_mb(path: str, spark: SparkSession | None = None) -> float:
    """Megabytes of a file, 0 if it is absent; with a session, of a file or folder of any file system."""
    if spark is not None:
        return sum(n for _, n in files_of(spark, path, True)) / (1 << 20)
    return os.path.getsize(path) / (1 << 20) if os.path.exists(path) else 0.0


def read_json_or(path: str, default=None):
    """A whole JSON file, or the default on any failure."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, ValueError):
        return default


def synthetic(spark: SparkSession, n: int) -> DataFrame:
    """Records of the benchmark shape."""
    i = F.col("id")
    return spark.range(n).select(i, F.format_string("This is synthetic review number %d for benchmarking purposes.", i).alias("text"), (i % 5 + 1).alias("stars"), (i % 3).alias("useful"), (i % 2).alias("funny"), (i % 4).alias("cool"))
