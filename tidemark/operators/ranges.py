"""Range numbers that are a function of the row, by sampled quantiles.

``repartitionByRange`` samples its bounds anew in every branch of a plan, so the number of a physical partition isn't the
same for one row in two branches. Here the bounds are sampled once and become part of the expression: a row has one number
wherever it is worked out, whatever is pruned, coalesced or run again. Results never rest on where the bounds lie.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER_RANGE = 1_000_000  # rows a range is meant to hold
MOST = 2048  # ranges; beyond, ranges grow, and the sorts over them spill
SAMPLED = 40  # sampled rows a range


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.lit(value).cast(kind)


def bounds(df: DataFrame, order: list[str], partitions: int | None = None) -> list[Column]:
    """At most ``partitions`` - 1 increasing literals (structs of the order columns): quantiles of a sample of at most
    about ``SAMPLED`` rows a range, which are all that comes to the driver."""
    keys = df.select(*[F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order)])
    total = keys.count()
    n = partitions or min(MOST, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(total / PER_RANGE)))
    share = min(1.0, SAMPLED * n / max(total, 1))
    got = (keys.sample(False, share, 17) if share < 1 else keys).orderBy(*keys.columns).collect()
    picked = []
    for i in range(1, n):
        row = got[i * len(got) // n] if got else None
        if row is not None and (not picked or row != picked[-1]):
            picked.append(row)
    return [F.struct(*[_literal(row[f.name], f.dataType).alias(f.name) for f in keys.schema.fields]) for row in picked]


def range_number(df: DataFrame, order: list[str], partitions: int | None = None) -> Column:
    """Number of the range a row of ``df`` falls in, from 0; nulls first. A balanced tree of comparisons, so a row costs the
    logarithm of the number of ranges."""
    cuts = bounds(df, order, partitions)
    at = F.struct(*[F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order)])

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(at < cuts[mid], tree(low, mid)).otherwise(tree(mid + 1, high))

    return tree(0, len(cuts))
