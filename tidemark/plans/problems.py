"""Queries of the general data problems (1, 5 and 6) over their whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.heavy_keys import heavy_keys, key_summary, running
from tidemark.operators.orphans import broken_references
from tidemark.operators.packed import explode_packed
from tidemark.sources.tables import load

HEAVY_SHARE = 0.03


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    parts = [
        explode_packed(load(spark, d, table), ["row_id"], field).select(F.lit(table).alias("src"), "row_id", "pos", "val")
        for table, field in (("yelp_business", "categories"), ("yelp_checkin", "date"))
    ]
    return parts[0].unionByName(parts[1])


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    """How often each category is named."""
    return p1_found(spark, d).filter(F.col("src") == "yelp_business").groupBy("val").agg(F.count(F.lit(1)).alias("n"))


REFERENCES = (
    ("yelp_review", "business_id", "yelp_business"),
    ("yelp_review", "user_id", "yelp_user"),
    ("yelp_checkin", "business_id", "yelp_business"),
)


def _broken(spark: SparkSession, d: str) -> DataFrame:
    removed = load(spark, d, "deleted_key")
    out = []
    for src, field, target in REFERENCES:
        gone = removed.filter(F.col("table_name") == target).select(F.col("key_value").alias(field))
        found = broken_references(
            load(spark, d, src).select("row_id", field, "loaded_at"), [field], load(spark, d, target).select(field, "loaded_at"), [field],
            row_id="row_id", ref_time="loaded_at", target_time="loaded_at", deleted=gone,
        )
        out.append(found.select(F.lit(src).alias("src"), "row_id", F.lit(field).alias("field"), "state", "at"))
    return reduce(DataFrame.unionByName, out)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _broken(spark, d).select("src", "row_id", "field", "state")


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    """Broken references per table, field, state and month of arrival."""
    month = F.date_trunc("month", "at").cast("date").alias("month")
    return _broken(spark, d).groupBy("src", "field", "state", month).agg(F.count(F.lit(1)).alias("n"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return heavy_keys(load(spark, d, "yelp_review").select("business_id", "row_id"), "business_id", "row_id", HEAVY_SHARE).select("business_id")


def p6_stats(spark: SparkSession, d: str) -> DataFrame:
    """Per business: reviews, mean stars, votes, first and last row."""
    votes = ["useful", "funny", "cool"]
    df = load(spark, d, "yelp_review").select("business_id", "row_id", "stars", *votes)
    return key_summary(df, "business_id", "row_id", sums=votes, means=["stars"]).filter(F.col("business_id").isNotNull()).drop("pieces")


def p6_running(spark: SparkSession, d: str) -> DataFrame:
    """Each review's rank within its business and the mean stars so far."""
    df = load(spark, d, "yelp_review").select("business_id", "row_id", "stars")
    return running(df, "business_id", ["row_id"], "stars").filter(F.col("business_id").isNotNull()).select("row_id", "rank_in_key", "running_mean")


def running_wide(spark: SparkSession, d: str) -> DataFrame:
    """The same rank and mean on whole records."""
    df = load(spark, d, "yelp_review").withColumn("digest", F.md5("text"))
    return running(df, "business_id", ["row_id"], "stars").select("row_id", "business_id", "digest", "rank_in_key", "running_mean")


QUERIES = {f.__name__: f for f in (p1_found, p1_counts, p5_found, p5_report, p6_found, p6_stats, p6_running, running_wide)}

_P5 = """
WITH b AS (SELECT business_id AS k, min(loaded_at) AS came FROM yelp_business WHERE business_id IS NOT NULL GROUP BY 1),
u AS (SELECT user_id AS k, min(loaded_at) AS came FROM yelp_user WHERE user_id IS NOT NULL GROUP BY 1),
refs AS (
 SELECT 'yelp_review' AS src, row_id, 'business_id' AS field, business_id AS k, loaded_at, 'yelp_business' AS t FROM yelp_review
 UNION ALL SELECT 'yelp_review', row_id, 'user_id', user_id, loaded_at, 'yelp_user' FROM yelp_review
 UNION ALL SELECT 'yelp_checkin', row_id, 'business_id', business_id, loaded_at, 'yelp_business' FROM yelp_checkin),
there AS (SELECT 'yelp_business' AS t, k, came FROM b UNION ALL SELECT 'yelp_user', k, came FROM u),
gone AS (SELECT DISTINCT table_name AS t, key_value AS k FROM deleted_key),
broken AS (
 SELECT r.src, r.row_id, r.field, r.loaded_at,
        CASE WHEN h.k IS NOT NULL THEN 'late' WHEN g.k IS NOT NULL THEN 'deleted' ELSE 'missing' END AS state
 FROM refs r LEFT JOIN there h ON h.t = r.t AND h.k = r.k LEFT JOIN gone g ON g.t = r.t AND g.k = r.k
 WHERE r.k IS NOT NULL AND (h.k IS NULL OR h.came > r.loaded_at))
"""

SQL = {
    "p5_found": _P5 + "SELECT src, row_id, field, state FROM broken",
    "p5_report": _P5 + "SELECT src, field, state, CAST(date_trunc('month', loaded_at) AS DATE) AS month, count(*) AS n FROM broken GROUP BY 1, 2, 3, 4",
    "p6_found": "SELECT business_id FROM yelp_review WHERE business_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 0.03 * (SELECT count(*) FROM yelp_review)",
    "p6_stats": """SELECT business_id, count(*) AS n, min(row_id) AS first_row_id, max(row_id) AS last_row_id, CAST(sum(useful) AS BIGINT) AS sum_useful,
        CAST(sum(funny) AS BIGINT) AS sum_funny, CAST(sum(cool) AS BIGINT) AS sum_cool, avg(stars) AS mean_stars FROM yelp_review WHERE business_id IS NOT NULL GROUP BY 1""",
    "running_wide": """SELECT row_id, business_id, md5(text) AS digest, count(*) OVER w AS rank_in_key, avg(stars) OVER w AS running_mean FROM yelp_review
        WINDOW w AS (PARTITION BY business_id ORDER BY row_id ROWS UNBOUNDED PRECEDING)""",
    "p6_running": """SELECT row_id, count(*) OVER w AS rank_in_key, avg(stars) OVER w AS running_mean FROM yelp_review WHERE business_id IS NOT NULL
        WINDOW w AS (PARTITION BY business_id ORDER BY row_id ROWS UNBOUNDED PRECEDING)""",
}
