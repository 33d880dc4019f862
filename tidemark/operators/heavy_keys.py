"""Per-key results where a few keys hold most rows.

Rows are range-partitioned on the composite (key, order) by sampled quantiles, so a heavy key is cut into
several partitions at order values and no partition depends on how rows spread over keys. Each partition
makes one partial state per key it holds; a key has more than one state only where it crosses partition
boundaries. The states, never more than keys + partitions, are stitched by key.

A null key is a key of its own in the states; callers drop it where it is no result. Null order values
come first. Rows that tie on key and order may fall into either partition, which no stitched result depends
on, apart from ``running``, where ties are ordered by the remaining order columns given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ranges import range_number


def cut(df: DataFrame, key: str, order: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned on (key, order...), with ``part``, the partition's number. For results that come from one
    branch of a plan; another branch may draw other bounds. The number of partitions is that of the shuffle, which the
    cluster sets with the size of the data."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, F.col(f"`{key}`"), *[F.col(f"`{o}`") for o in order])
    return ranged.withColumn("part", F.spark_partition_id())


def partial_states(ranged: DataFrame, key: str, aggs: list[Column]) -> DataFrame:
    """One state per (partition, key). The grouping has the partition's number in it, so map-side combine
    ends the work before the exchange and one row per state is moved."""
    return ranged.groupBy("part", F.col(f"`{key}`")).agg(*aggs)


def stitch(states: DataFrame, key: str, aggs: list[Column]) -> DataFrame:
    return states.groupBy(F.col(f"`{key}`")).agg(F.count(F.lit(1)).alias("pieces"), *aggs)


def key_summary(df: DataFrame, key: str, order: str, *, sums: list[str] = (), means: list[str] = (), partitions: int | None = None) -> DataFrame:
    """Per key: ``n``, ``sum_*``, ``mean_*`` (nulls left out; null if all are), first and last ``order``."""
    ranged = cut(df.select(key, order, *dict.fromkeys([*sums, *means])), key, [order], partitions)
    part = [F.count(F.lit(1)).alias("n"), F.min(order).alias("lo"), F.max(order).alias("hi")]
    part += [F.sum(c).alias(f"s_{c}") for c in dict.fromkeys([*sums, *means])] + [F.count(c).alias(f"n_{c}") for c in means]
    whole = [F.sum("n").alias("n"), F.min("lo").alias(f"first_{order}"), F.max("hi").alias(f"last_{order}")]
    whole += [F.sum(f"s_{c}").alias(f"sum_{c}") for c in sums]
    whole += [(F.sum(f"s_{c}") / F.sum(f"n_{c}")).alias(f"mean_{c}") for c in means]
    return stitch(partial_states(ranged, key, part), key, whole)


def heavy_keys(df: DataFrame, key: str, order: str, share: float, partitions: int | None = None) -> DataFrame:
    """Non-null keys that hold at least ``share`` of all rows, null keys counted among the rows.

    The total is taken from the stitched counts by a one-row aggregate joined back; no row is dropped.
    """
    counts = key_summary(df, key, order, partitions=partitions).select(F.col(key), "n")
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), F.col("n") >= share * F.col("total")).filter(F.col(key).isNotNull()).select(key, "n", "total")


def running(df: DataFrame, key: str, order: list[str], value: str, partitions: int | None = None) -> DataFrame:
    """``df`` with each row's rank within its key (``rank_in_key``) and the mean of ``value`` so far
    (``running_mean``, nulls left out).

    The window runs inside (range, key), whose size the quantiles bound; what earlier ranges hold of the same key is added
    from their states. The range is a function of the row, the same for the rows and for the states, whatever other columns
    ``df`` has; of those named like the results, the results stay.
    """
    by = [key, *order]
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    k, v, o = names[key], names[value], [names[x] for x in order]
    ranged = rows.withColumn("part", range_number(rows, [names[x] for x in by], partitions))
    states = partial_states(ranged, k, [F.count(F.lit(1)).alias("n"), F.sum(v).alias("s"), F.count(v).alias("c")])
    before = Window.partitionBy(k).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = states.select(
        F.col("part").alias("o_part"), F.col(k).alias("o_key"),
        *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"o_{x}") for x in ("n", "s", "c")],
    )
    inside = Window.partitionBy("part", k).orderBy(*o).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({
        "l_n": F.count(F.lit(1)).over(inside), "l_s": F.coalesce(F.sum(v).over(inside), F.lit(0.0)), "l_c": F.count(v).over(inside),
    })
    joined = local.join(offsets, (F.col("part") == F.col("o_part")) & F.col(k).eqNullSafe(F.col("o_key")), "left")
    n, s, c = (F.col(f"l_{x}") + F.coalesce(F.col(f"o_{x}"), F.lit(0)) for x in ("n", "s", "c"))
    kept = [F.col(n).alias(c) for c, n in names.items() if c not in ("rank_in_key", "running_mean")]
    return joined.select(*kept, n.alias("rank_in_key"), F.when(c > 0, s / c).alias("running_mean"))
