"""Samples that don't depend on partitioning: rows are ranked by a hash of their key and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lot(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")))


def bernoulli(df: DataFrame, rate: float, seed: int | None = None) -> DataFrame:
    if not 0 < rate <= 1:
        raise ValueError("rate must be in (0, 1]")
    return df if rate == 1 else df.sample(False, rate, seed)


def reservoir(df: DataFrame, size: int, key: str, seed: int = 0) -> DataFrame:
    """A uniform sample of ``size`` rows: top-k by lot, so no full sort and no gathering."""
    if size < 1:
        raise ValueError("size must be at least 1")
    return df.withColumn("__lot", lot(F.col(key), seed)).orderBy("__lot", key).limit(size).drop("__lot")


def stratified(df: DataFrame, stratum: str, rate: float, key: str, seed: int = 0) -> DataFrame:
    """Exactly max(1, round-half-even(n * rate)) rows of each stratum, null being one.

    A stratum's quota is found without gathering it: lots are cut into 4096 buckets, the running count of buckets gives
    the one in which the quota ends; rows of later buckets are dropped, the others ranked within their bucket.
    """
    if not 0 < rate <= 1:
        raise ValueError("rate must be in (0, 1]")
    s = F.col(f"`{stratum}`")
    drawn = df.withColumn("__lot", lot(F.col(key), seed)).withColumn("__b", F.substring("__lot", 1, 3))
    sizes = drawn.groupBy(s.alias("__s"), "__b").agg(F.count(F.lit(1)).alias("c"))
    up = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("__s")
    plan = sizes.select("__s", F.col("__b").alias("__pb"), (F.sum("c").over(up) - F.col("c")).alias("before"), "c", F.greatest(F.lit(1), F.bround(F.sum("c").over(whole) * F.lit(rate)).cast("long")).alias("quota"))
    joined = drawn.join(plan, s.eqNullSafe(F.col("__s")) & (F.col("__b") == F.col("__pb"))).filter(F.col("before") < F.col("quota"))
    rank = F.row_number().over(Window.partitionBy("__s", "__b").orderBy("__lot", key))
    return joined.withColumn("__n", rank).filter(F.col("before") + F.col("__n") <= F.col("quota")).select(*df.columns)


def strata_counts(df: DataFrame, stratum: str) -> DataFrame:
    return df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
