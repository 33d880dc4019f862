"""Queries of the sources and sinks: each writes a table, reads it back and gives its rows, with the same in SQL.

Files go to the shared checkpoint folder, each run to a folder of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.cli.main import first_lines
from tidemark.functions import hashing, validate
from tidemark.operators import dedup, partitioning, transform
from tidemark.plans import warehouse
from tidemark.session import ensure_checkpoint_dir
from tidemark.sinks import writers
from tidemark.sources import jsonl
from tidemark.sources.tables import load

REVIEW_COLUMNS = [f.name for f in schemas.REVIEW.fields]


def _folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def _reviews_file(spark: SparkSession, d: str, *more: str) -> str:
    at = _folder(spark)
    writers.to_jsonl(load(spark, d, "yelp_review").select(*more, *REVIEW_COLUMNS), at)
    return at


_SCHEMA_ID = T.StructType([T.StructField("row_id", T.LongType()), *schemas.REVIEW.fields])


def jsonl_round_trip(spark, d):
    got = jsonl.read_jsonl(spark, _reviews_file(spark, d, "row_id"), _SCHEMA_ID)
    return got.select("row_id", "review_id", "stars", "useful", F.md5("text").alias("digest"), "date")


def jsonl_broken_lines(spark, d):
    """Lines some of which are blank, broken, null or no object; what is read is counted per kind."""
    at = _folder(spark)
    k = F.col("event_id") % 5
    line = F.when(k == 0, F.lit("  ")).when(k == 1, F.lit('{"event_id": ')).when(k == 2, F.lit("null")).when(k == 3, F.lit("[1]")).otherwise(F.to_json(F.struct("event_id")))
    load(spark, d, "events").select(line.alias("value")).write.text(at)
    kind = F.regexp_extract(F.schema_of_variant("record"), "^([A-Z]+)", 1)
    return jsonl.read_jsonl(spark, at).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def several_files(spark, d):
    """Two files and one that isn't there."""
    a, b = _folder(spark), _folder(spark)
    for at, table, c in ((a, "customer", "c_custkey"), (b, "supplier", "s_suppkey")):
        writers.to_jsonl(load(spark, d, table).select(F.col(c).alias("key")), at)
    got = jsonl.read_existing(spark, [a, b, "/not/there.jsonl"], schema=T.StructType([T.StructField("key", T.LongType())]))
    return got.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def csv_round_trip(spark, d):
    at = _folder(spark)
    writers.export(load(spark, d, "part").withColumn("p_name", F.concat("p_name", F.lit(', "x"'))), at, ".CSV", fields=["p_partkey", "p_name", "absent"])
    return spark.read.option("header", True).option("escape", '"').csv(at).select(F.col("p_partkey").cast("long"), "p_name", F.col("absent").cast("string").alias("absent"))


def parquet_safe_round_trip(spark, d):
    at = _folder(spark)
    nested = load(spark, d, "nation").select("n_nationkey", F.struct("n_name", "n_regionkey").alias("about"), F.array("n_name").alias("names"))
    transform.parquet_safe(nested).write.parquet(at)
    return spark.read.parquet(at)


def partition_files(spark, d):
    at = _folder(spark)
    writers.to_partitions(load(spark, d, "documents").select("doc_id", "source"), at, "source")
    return spark.read.json(at).groupBy(F.col("_key").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


def split_lines(spark, d):
    """Lines of a file in seven chunks, all there, in order."""
    at, to = _folder(spark), _folder(spark)
    load(spark, d, "yelp_review").select(F.format_string("%09d %s", "row_id", F.md5(F.coalesce("text", F.lit("")))).alias("value")).orderBy("value").write.text(at)
    writers.to_chunks(jsonl.numbered_lines(spark, at), to, ["line"], 7)
    return spark.read.text(to).select("chunk", "value")


def line_numbers(spark, d):
    at = _folder(spark)
    load(spark, d, "orders").select(F.format_string("%09d", "o_orderkey").alias("value")).orderBy("value").write.text(at)
    return jsonl.numbered_lines(spark, at)


def line_counts(spark, d):
    """Lines and newline bytes of a file whose last line is open, and how many chunks its size gives."""
    at = _folder(spark)
    load(spark, d, "events").select(F.format_string("event %08d", "event_id").alias("value")).coalesce(1).write.text(at)
    lines, size = jsonl.count_lines(spark, at), jsonl.size_mb(at, spark)
    rows = [(lines, jsonl.count_newlines(spark, at), round(size * (1 << 20)), partitioning.estimate_chunks(size, size / 3.5))]
    return spark.createDataFrame(rows, "lines long, newlines long, bytes long, chunks int")


def file_digest(spark, d):
    at = _folder(spark)
    load(spark, d, "region").select(F.concat_ws("|", F.col("r_regionkey").cast("string"), "r_name").alias("value")).coalesce(1).sortWithinPartitions("value").write.text(at)
    return hashing.file_digests(spark, at).select("sha256")


def file_dedup(spark, d):
    """First of the records that are equal but for the order of their keys."""
    at = _folder(spark)
    a, b = F.col("user_id") % 20, F.col("event_type")
    some = F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(a.alias("a"), b.alias("b")))).otherwise(F.to_json(F.struct(b.alias("b"), a.alias("a"))))
    load(spark, d, "events").orderBy("event_id").select(some.alias("value")).write.text(at)
    kept = dedup.dedup_first(first_lines(jsonl.numbered_lines(spark, at), None).select("line", "value", "k"), ["k"], ["line"])
    return kept.select("line", F.get_json_object("value", "$.a").cast("int").alias("a"), F.get_json_object("value", "$.b").alias("b"))


def syntax_errors(spark, d):
    at = _folder(spark)
    load(spark, d, "orders").select(F.when(F.col("o_orderkey") % 1000 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("o_orderkey"))).alias("value"), "o_orderkey").orderBy("o_orderkey").select("value").write.text(at)
    return validate.jsonl_syntax_errors(spark, at, 1_000_000).select("line")


def required_fields(spark, d):
    """Fields that records lack; a key with a null value is there."""
    at = _folder(spark)
    load(spark, d, "yelp_tip").select(F.when(F.col("text").isNull(), F.to_json(F.struct("row_id"))).otherwise(F.to_json(F.struct("row_id", "text", "business_id"), {"ignoreNullFields": "false"})).alias("value")).write.text(at)
    got = jsonl.read_jsonl(spark, at)
    return got.select(F.try_variant_get("record", "$.row_id", "long").alias("row_id"), validate.missing_fields(F.col("record"), ["row_id", "text", "business_id"]).alias("missing"))


def warehouse_load(spark, d):
    """Bulk load to variants, flattened with typed columns."""
    flat = warehouse.flatten_reviews(warehouse.load_raw(spark, _reviews_file(spark, d, "row_id")), "lexicon")
    return flat.groupBy("business_id").agg(F.count(F.lit(1)).alias("n"), F.sum("review_stars").alias("stars"), F.count("review_text").alias("texts"))


def created_table(spark, d):
    """A table made from a query, written in two batches and read by SQL with a parameter."""
    name = f"tidemark_{uuid.uuid4().hex}"
    at = _folder(spark)
    spark.sql(f"CREATE TABLE {name} (n_nationkey INT, n_name STRING) USING parquet LOCATION '{at}'")
    n = load(spark, d, "nation").select("n_nationkey", "n_name")
    for part in (n.filter("n_nationkey < 10"), n.filter("n_nationkey >= 10")):
        part.write.insertInto(name)
    rows = warehouse.execute_query(spark, f"SELECT n_nationkey, n_name FROM {name} WHERE n_nationkey >= :least", {"least": 5})
    total = warehouse.table_row_count(spark, name) if warehouse.table_exists(spark, name) else -1
    spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame([(*r, total) for r in rows], "n_nationkey int, n_name string, rows long")


QUERIES = {f.__name__: f for f in (jsonl_round_trip, jsonl_broken_lines, several_files, csv_round_trip, parquet_safe_round_trip, partition_files, split_lines, line_numbers, line_counts, file_digest, file_dedup, syntax_errors, required_fields, warehouse_load, created_table)}
SQL = {
    "jsonl_round_trip": "SELECT row_id, review_id, stars, useful, md5(text) AS digest, date FROM yelp_review",
    "jsonl_broken_lines": "SELECT CASE event_id % 5 WHEN 3 THEN 'ARRAY' ELSE 'OBJECT' END AS kind, count(*) AS n FROM events WHERE event_id % 5 >= 3 GROUP BY 1",
    "several_files": "SELECT key, count(*) AS n FROM (SELECT c_custkey AS key FROM customer UNION ALL SELECT s_suppkey FROM supplier) GROUP BY 1",
    "csv_round_trip": "SELECT p_partkey, p_name || ', \"x\"' AS p_name, CAST(NULL AS VARCHAR) AS absent FROM part",
    "parquet_safe_round_trip": "SELECT n_nationkey, '{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}' AS about, '[\"' || n_name || '\"]' AS names FROM nation",
    "partition_files": "SELECT coalesce(source, '__other__') AS key, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents GROUP BY 1",
    "split_lines": "SELECT CAST(least(rn // (c // 7), 6) AS INTEGER) AS chunk, value FROM (SELECT printf('%09d %s', row_id, md5(coalesce(text, ''))) AS value, row_number() OVER (ORDER BY row_id) - 1 AS rn, count(*) OVER () AS c FROM yelp_review)",
    "line_numbers": "SELECT row_number() OVER (ORDER BY o_orderkey) AS line, printf('%09d', o_orderkey) AS value FROM orders",
    "line_counts": "SELECT count(*) AS lines, count(*) AS newlines, CAST(sum(15) AS BIGINT) AS bytes, 4 AS chunks FROM events",
    "file_digest": "SELECT sha256(string_agg(r_regionkey || '|' || r_name || chr(10), '' ORDER BY r_regionkey)) AS sha256 FROM region",
    "file_dedup": "SELECT min(line) AS line, a, b FROM (SELECT row_number() OVER (ORDER BY event_id) AS line, CAST(user_id % 20 AS INTEGER) AS a, event_type AS b FROM events) GROUP BY 2, 3",
    "syntax_errors": "SELECT line FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS line FROM orders) WHERE o_orderkey % 1000 = 0",
    "required_fields": "SELECT row_id, CASE WHEN text IS NULL THEN ['text', 'business_id'] ELSE [] END AS missing FROM yelp_tip",
    "warehouse_load": "SELECT business_id, count(*) AS n, sum(stars) AS stars, count(text) AS texts FROM yelp_review GROUP BY 1",
    "created_table": "SELECT n_nationkey, n_name, (SELECT count(*) FROM nation) AS rows FROM nation WHERE n_nationkey >= 5",
}
