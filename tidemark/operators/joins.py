"""Lookup joins: the right side is reduced to one row per key, so a left row never multiplies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import extreme_rows

SIDE = "__r_"


def lookup(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per non-null key, the last by ``order``; no key gathers its rows (``extreme_rows``)."""
    return extreme_rows(df.filter(F.col(f"`{key}`").isNotNull()), [key], order, F.max)


def _right(lookup_df: DataFrame, key: str, prefix: str, taken: set[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """The lookup under names that can't clash, and (inner name, output name) of the columns to add."""
    names = [(f"{SIDE}{i}", f"{prefix}{c}", c) for i, c in enumerate(lookup_df.columns)]
    renamed = lookup_df.select(*[F.col(f"`{c}`").alias(n) for n, _, c in names])
    renamed = renamed.withColumnRenamed(next(n for n, _, c in names if c == key), f"{SIDE}key")
    return renamed, [(n, out) for n, out, c in names if c != key and out not in taken]


def lookup_join(left: DataFrame, lookup_df: DataFrame, key: str, left_key: str | None = None, prefix: str = "", how: str = "left") -> DataFrame:
    """Left or inner join with a lookup. Its key column is dropped and its other columns get ``prefix``; where a name is
    already there, the left value stays, null or not. The planner broadcasts the lookup only where its size allows."""
    right, add = _right(lookup_df, key, prefix, set(left.columns))
    joined = left.join(right, F.col(f"`{left_key or key}`") == F.col(f"{SIDE}key"), how)
    return joined.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(n).alias(out) for n, out in add])


def lookup_anti(left: DataFrame, lookup_df: DataFrame, key: str, left_key: str | None = None) -> DataFrame:
    """Left rows without an entry; rows with a null key are among them."""
    right = lookup_df.select(F.col(f"`{key}`").alias(f"{SIDE}key")).distinct()
    return left.join(right, F.col(f"`{left_key or key}`") == F.col(f"{SIDE}key"), "left_anti")


def lookup_right(left: DataFrame, lookup_df: DataFrame, key: str, order: list[str], left_key: str | None = None, prefix: str = "", fill_value=None) -> DataFrame:
    """One row per lookup entry with the last left row of its key; the entry's value wins where a name is in both.
    ``fill_value`` replaces nulls of the left columns of entries without a left row."""
    left_key = left_key or key
    last = lookup(left, left_key, order)
    entry = lookup_df.select(*[F.col(f"`{c}`").alias(c if c == key else f"{prefix}{c}") for c in lookup_df.columns])
    taken = set(entry.columns)
    inner = last.select(F.col(f"`{left_key}`").alias(f"{SIDE}key"), *[F.col(f"`{c}`").alias(f"{SIDE}{i}") for i, c in enumerate(last.columns)])
    joined = entry.join(inner, F.col(f"`{key}`") == F.col(f"{SIDE}key"), "left")
    added = []
    for i, c in enumerate(last.columns):
        if c in taken or c == left_key:
            continue
        v = F.col(f"{SIDE}{i}")
        if fill_value is not None:
            v = F.when(F.col(f"{SIDE}key").isNull(), F.lit(fill_value).try_cast(last.schema[c].dataType)).otherwise(v)
        added.append(v.alias(c))
    return joined.select(*[F.col(f"`{c}`") for c in entry.columns], *added)
