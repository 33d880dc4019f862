"""Order-aware deduplication: the first row of each key survives."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedup_first(df: DataFrame, keys: Sequence[str] | None, order: Sequence[str]) -> DataFrame:
    """First row by ``order`` of each combination of ``keys`` (all columns but the order if None); null equals null. Of rows
    that tie on keys and order any one stays."""
    by = list(keys) if keys is not None else [c for c in df.columns if c not in order]
    return extreme_rows(df, by, order, F.min)


def extreme_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick: Callable[[Column], Column]) -> DataFrame:
    """The row of the least (``pick`` = min) or greatest ``order`` of each key.

    Where the order is one column of fixed width, key and order alone are aggregated by hash, map-side first, so a key with
    many rows is no hot task; the rows are then fetched by a semi-join, which sorts only what can be a result. Any other order
    is a grouped extreme of a struct.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    if len(order) == 1 and isinstance(df.schema[order[0]].dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        o = order[0]
        best = df.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]).agg(pick(F.col(f"`{o}`")).alias("__o"))
        same = reduce(and_, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in zip(keys, names)], F.col(f"`{o}`").eqNullSafe(F.col("__o")))
        return df.join(best, same, "left_semi").dropDuplicates(list(keys))
    at = F.struct(*[F.col(f"`{x}`") for x in order])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    picked = (F.min_by if pick is F.min else F.max_by)(row, at)
    return df.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]).agg(picked.alias("__row")).select("__row.*")


def dedup_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """seen, unique and dropped rows."""
    per = df.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("n"))
    seen, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return per.agg(seen.alias("seen"), unique.alias("unique"), (seen - unique).alias("dropped"))
