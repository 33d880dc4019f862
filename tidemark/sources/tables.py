"""Adapters for the Parquet tables the queries run over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review-shaped view of lineitem and orders; ``ord`` is the order of arrival."""
    li, o = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "orders")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("l_suppkey").cast("string").alias("business_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        (F.lit(1) + (F.col("l_quantity").cast("int") % 9) / F.lit(2.0)).cast("double").alias("stars"),
        F.col("l_linenumber").cast("long").alias("useful"),
        F.to_date("o_orderdate").alias("date"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").alias("ord"),
    )


def businesses_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = load(spark, sf_dir, "supplier"), load(spark, sf_dir, "nation")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("business_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("city"),
        F.col("n_regionkey").cast("string").alias("state"),
    )
