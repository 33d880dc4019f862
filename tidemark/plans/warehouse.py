"""Raw variant tables, their flattened forms, and the analytics over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.sentiment import sentiment, warehouse_label

REVIEW_FIELDS = {"business_id": "string", "review_date": ("date", "date"), "user_id": "string", "review_stars": ("stars", "double"), "review_text": ("text", "string")}
BUSINESS_FIELDS = {"business_id": "string", "name": "string", "city": "string", "state": "string", "review_count": "long", "stars": "double", "categories": "string"}


def load_raw(spark: SparkSession, path: str) -> DataFrame:
    """Bulk load of JSON files or one object into one variant column ``v``; malformed lines are null rows."""
    return spark.read.text(path).select(F.try_parse_json("value").alias("v"))


def project(raw: DataFrame, fields: dict, column: str = "v") -> DataFrame:
    """Typed columns by path; a value that doesn't fit its type is null."""
    cols = []
    for name, spec in fields.items():
        path, kind = spec if isinstance(spec, tuple) else (name, spec)
        cols.append(F.try_variant_get(column, f"$.{path}", kind).alias(name))
    return raw.select(*cols)


def flatten_reviews(raw: DataFrame, backend: str = "auto", whole_stars: bool = False) -> DataFrame:
    """``whole_stars`` rounds ratings half up to whole numbers, as a number type without scale does."""
    flat = project(raw, REVIEW_FIELDS)
    if whole_stars:
        flat = flat.withColumn("review_stars", F.col("review_stars").cast("decimal(38,0)"))
    return flat.withColumn("sentiments", warehouse_label(sentiment(F.col("review_text"), backend)["polarity"]))


def flatten_businesses(raw: DataFrame, limit: int | None = None) -> DataFrame:
    """``limit`` keeps the first businesses by id; none by default, as a limit loses rows of later joins."""
    flat = project(raw, BUSINESS_FIELDS)
    return flat if limit is None else flat.orderBy("business_id").limit(limit)


def top_users_by_category(reviews: DataFrame, businesses: DataFrame, pattern: str, n: int = 10) -> DataFrame:
    wanted = businesses.filter(F.col("categories").ilike(f"%{pattern}%"))
    counts = reviews.join(wanted.select("business_id"), "business_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "user_id").limit(n)


def labels_by_city(reviews: DataFrame, businesses: DataFrame, label: str = "sentiments") -> DataFrame:
    return reviews.join(businesses.select("business_id", "city"), "business_id").groupBy("city", label).agg(F.count(F.lit(1)).alias("n")).orderBy("city", label)


def monthly_counts(reviews: DataFrame, date: str = "review_date") -> DataFrame:
    return reviews.groupBy(F.date_trunc("month", F.col(date)).cast("date").alias("month")).agg(F.count(F.lit(1)).alias("n")).orderBy("month")


def top_by_label(reviews: DataFrame, businesses: DataFrame, label: str, value: str, n: int = 10) -> DataFrame:
    kept = reviews.filter(F.col(label) == value).join(businesses.select("business_id", "name", "city"), "business_id")
    return kept.groupBy("name", "city").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name", "city").limit(n)


def execute_query(spark: SparkSession, sql: str, params: dict | None = None) -> list:
    return spark.sql(sql, args=params or {}).collect()


def iterate_query(spark: SparkSession, sql: str, params: dict | None = None):
    return spark.sql(sql, args=params or {}).toLocalIterator()


def table_exists(spark: SparkSession, table: str, schema: str | None = None) -> bool:
    try:
        return spark.catalog.tableExists(f"{schema}.{table}" if schema else table)
    except Exception:
        return False


def table_row_count(spark: SparkSession, table: str) -> int:
    return spark.table(table).count()


def upload(spark: SparkSession, local_path: str, folder: str, overwrite: bool = True) -> str:
    """Copies a file of the driver's machine to a folder of any file system; its new path."""
    import os

    jvm, name = spark._jvm, os.path.basename(local_path)
    to = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + name)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to.getParent())
    fs.copyFromLocalFile(False, overwrite, jvm.org.apache.hadoop.fs.Path("file://" + os.path.abspath(local_path)), to)
    return to.toString()


def list_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
