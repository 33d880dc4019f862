"""Ordered splitting into contiguous chunks, and partitioning by key."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import range_number

OTHER = "__other__"


def number_within(df: DataFrame, part: str, order: list[str], start: int = 0) -> DataFrame:
    """``df`` with ``rn`` from ``start``, in the order of ``part`` and, within it, of ``order``. ``part`` must be a function of
    the row. Parts are counted by their own map-side aggregate, of which only the counts are moved and put in order."""
    counts = df.groupBy(F.col(f"`{part}`").alias("__q")).agg(F.count(F.lit(1)).alias("__c"))
    before = F.coalesce(F.sum("__c").over(Window.orderBy("__q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__q", before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy(F.col(f"`{part}`")).orderBy(*[F.col(f"`{o}`") for o in order])) - 1
    joined = df.withColumn("__n", inside).join(offsets, F.col(f"`{part}`").eqNullSafe(F.col("__q")))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__n") + F.col("__before") + start).cast("long").alias("rn"))


def with_row_number(df: DataFrame, order: list[str]) -> DataFrame:
    """``rn`` from 0 in the total order, without one task that sees all rows: each range of the order is numbered by itself,
    and the counts of the ranges before, of which there are few, are added. The range is a function of the row
    (``range_number``), so every row is counted and numbered in the same one. Rows that tie on ``order`` get neighbouring
    numbers in no set order."""
    return number_within(df.withColumn("__p", range_number(df, order)), "__p", order).drop("__p")


def split_chunks(df: DataFrame, order: list[str], chunks: int) -> DataFrame:
    """``chunk`` of each row: equal contiguous parts, the whole remainder in the last; at most one chunk per row."""
    if chunks < 1:
        raise ValueError("chunks must be at least 1")
    total = df.count()
    if total == 0:
        raise ValueError("nothing to split")
    n = min(chunks, total)
    return with_row_number(df, order).withColumn("chunk", F.least(F.floor(F.col("rn") / (total // n)), F.lit(n - 1)).cast("int")).drop("rn")


def split_plan(df: DataFrame, order: list[str], chunks: int) -> DataFrame:
    """Rows per chunk, nothing written."""
    return split_chunks(df, order, chunks).groupBy("chunk").agg(F.count(F.lit(1)).alias("lines"))


def estimate_chunks(size_mb: float, target_mb: float) -> int:
    if target_mb <= 0:
        raise ValueError("target must be positive")
    return max(1, ceil(size_mb / target_mb))


def partition_key(c: Column, default: str = OTHER) -> Column:
    return F.coalesce(c.cast("string"), F.lit(default))


def partition_sizes(df: DataFrame, key: Column, default: str = OTHER) -> DataFrame:
    return df.groupBy(partition_key(key, default).alias("partition_key")).agg(F.count(F.lit(1)).alias("n"))


def get_partition(df: DataFrame, key: Column, value: str, default: str = OTHER) -> DataFrame:
    return df.filter(partition_key(key, default) == value)
