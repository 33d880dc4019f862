"""Aggregates of reviews per business and overall, percentiles, reports and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_REVIEWS = 5


def stars_of(c: Column) -> Column:
    """A missing rating counts as 0."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def star_key(c: Column) -> Column:
    """Histogram bucket: half-even rounding, within 1 and 5."""
    return F.greatest(F.lit(1), F.least(F.lit(5), F.bround(stars_of(c)).cast("int")))


def business_stats(df: DataFrame, key: str = "business_id", order: str | None = None) -> DataFrame:
    """review_count, average_stars, useful_sum, positive_count (stars >= 4) and negative_count (<= 2) per non-empty key,
    and ``first_ord`` if an order is given."""
    s = stars_of(F.col("stars"))
    aggs = [
        F.count(F.lit(1)).alias("review_count"),
        (F.sum(s) / F.count(F.lit(1))).alias("average_stars"),
        F.sum(F.coalesce(F.col("useful").try_cast("long"), F.lit(0))).alias("useful_sum"),
        F.count_if(s >= 4).alias("positive_count"),
        F.count_if(s <= 2).alias("negative_count"),
    ]
    if order:
        aggs.append(F.min(order).alias("first_ord"))
    return df.filter(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(*aggs)


def one_business(stats: DataFrame, value: str, key: str = "business_id") -> DataFrame:
    """The row of one key, if it has any."""
    return stats.filter(F.col(key) == value)


def rounded_stats(stats: DataFrame) -> DataFrame:
    """The stats as a report shows them, averages to three places."""
    return stats.withColumn("average_stars", F.round("average_stars", 3)).select("business_id", "review_count", "average_stars", "useful_sum", "positive_count", "negative_count")


def partial_business_stats(df: DataFrame, key: str = "business_id") -> DataFrame:
    """Mergeable sums of ``business_stats``."""
    s = stars_of(F.col("stars"))
    return df.filter(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(s).alias("stars_sum"), F.sum(F.coalesce(F.col("useful").try_cast("long"), F.lit(0))).alias("useful_sum"), F.count_if(s >= 4).alias("positive_count"), F.count_if(s <= 2).alias("negative_count"))


def merge_business_stats(*parts: DataFrame, key: str = "business_id") -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole.groupBy(key).agg(
        F.sum("n").alias("review_count"), (F.sum("stars_sum") / F.sum("n")).alias("average_stars"), F.sum("useful_sum").alias("useful_sum"),
        F.sum("positive_count").alias("positive_count"), F.sum("negative_count").alias("negative_count"),
    )


def star_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy(star_key(F.col("stars")).alias("star")).agg(F.count(F.lit(1)).alias("n"))


def label_histogram(df: DataFrame, column: str = "sentiment_label") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def star_summary(df: DataFrame, percentiles: tuple[float, ...] = (25, 75, 90)) -> DataFrame:
    """total_records, mean, median, population deviation and exact percentiles over the histogram buckets. Computed from the
    five counts of the histogram, so it is one small aggregate at any size; all 0 for an empty table."""
    if any(not 0 <= p <= 100 for p in percentiles):
        raise ValueError("percentile outside [0, 100]")
    h = star_histogram(df)
    k, n = F.col("star").cast("double"), F.col("n")
    rank = [F.coalesce(F.percentile("star", p / 100, n), F.lit(0.0)).alias(f"p{p:g}") for p in percentiles]
    return h.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(k * n) / F.sum(n), F.lit(0.0)).alias("mean_stars"),
        F.coalesce(F.percentile("star", 0.5, n), F.lit(0.0)).alias("median_stars"),
        F.coalesce(F.sqrt(F.greatest(F.lit(0.0), F.sum(k * k * n) / F.sum(n) - F.pow(F.sum(k * n) / F.sum(n), 2))), F.lit(0.0)).alias("stddev_stars"),
        *rank,
    )


def top_businesses(stats: DataFrame, n: int = 10, least: int = MIN_REVIEWS, key: str = "business_id") -> DataFrame:
    """The best by average among those with enough reviews; ties by first appearance, then key."""
    return stats.filter(F.col("review_count") >= least).orderBy(F.desc("average_stars"), F.asc("first_ord"), key).limit(n)


def filter_businesses(stats: DataFrame, min_reviews: int = 0, min_avg: float = 0.0, max_avg: float = 5.0) -> DataFrame:
    return stats.filter((F.col("review_count") >= min_reviews) & F.col("average_stars").between(min_avg, max_avg)).orderBy(F.desc("average_stars"), F.asc("first_ord"))


def report_summary(stats: DataFrame, total: DataFrame) -> DataFrame:
    """total_reviews, unique_businesses and avg_reviews_per_business to two places."""
    per = stats.agg(F.count(F.lit(1)).alias("unique_businesses"), F.coalesce(F.round(F.avg("review_count"), 2), F.lit(0.0)).alias("avg_reviews_per_business"))
    return total.agg(F.count(F.lit(1)).alias("total_reviews")).join(F.broadcast(per), F.lit(True))


def series_summary(df: DataFrame, time: str, value: str, tie: str, max_points: int = 1000) -> DataFrame:
    """count, mean, min, max and last of the latest ``max_points`` points (a feature of the series, not a cap)."""
    last = df.orderBy(F.desc(time), F.desc(tie)).limit(max_points)
    return last.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.max_by(value, F.struct(time, tie)).alias("latest"))
