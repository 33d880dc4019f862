"""References to records that do not exist, are gone, or arrive later.

A reference is one or more columns. Rows are grouped by null mask (which of the columns are null), and each
mask is anti-joined on its non-null columns. What a partly null reference means is declared by ``match``:

* ``simple``  - any null: no reference, never an orphan (the usual SQL rule);
* ``partial`` - the non-null columns must occur together in some target row;
* ``full``    - all null: no reference; partly null: an orphan of state ``incomplete``.

Keys compare exactly as written; a blank string is a reference.

Heavy keys. References are aggregated to distinct keys, with map-side combine, before any join, so a key
that holds a third of all rows meets the target as one row. Only keys found broken go back to the rows, and
that join's row side is split by adaptive skew handling.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mask(columns: list[str]) -> Column:
    return F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])


def broken_references(
    refs: DataFrame,
    columns: list[str],
    target: DataFrame,
    target_columns: list[str],
    *,
    row_id: str,
    ref_time: str | None = None,
    target_time: str | None = None,
    deleted: DataFrame | None = None,
    match: str = "simple",
) -> DataFrame:
    """One row ``(row_id, state)`` per broken reference, plus ``ref_time`` if given.

    ``deleted`` holds removed keys under ``target_columns``. State is ``late`` if the key is in the target but
    first arrives after the row, ``deleted`` if it is absent and in ``deleted``, else ``missing``
    (``incomplete`` under ``match='full'``). A null time on either side is never late. An empty target makes
    every reference missing or deleted.
    """
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match {match!r}")
    keys = [f"k{i}" for i in range(len(columns))]
    rows = refs.select(
        F.col(f"`{row_id}`").alias("row_id"),
        *[F.col(f"`{c}`").alias(k) for c, k in zip(columns, keys)],
        (F.col(f"`{ref_time}`") if ref_time else F.lit(None).cast("timestamp")).alias("at"),
    )
    there = target.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(target_columns, keys)],
        (F.col(f"`{target_time}`") if target_time else F.lit(None).cast("timestamp")).alias("came"),
    )
    out = []
    for bits in product("10", repeat=len(keys)):
        present = [k for k, b in zip(keys, bits) if b == "1"]
        whole = len(present) == len(keys)
        if not present or (match == "simple" and not whole):
            continue
        mine = rows.filter(_mask(keys) == "".join(bits)) if len(keys) > 1 else rows.filter(F.col(keys[0]).isNotNull())
        if match == "full" and not whole:
            out.append(mine.select("row_id", "at", F.lit("incomplete").alias("state")))
            continue
        distinct = mine.groupBy(*present).agg(F.min("at").alias("first_at"))
        first = there.dropna(subset=present).groupBy(*present).agg(F.min("came").alias("came"), F.lit(True).alias("there"))
        keyed = distinct.join(first, present, "left").filter(F.col("there").isNull() | (F.col("came") > F.col("first_at")))
        if deleted is not None:
            gone = deleted.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(target_columns, keys)]).select(*present).dropna().distinct()
            keyed = keyed.join(gone.withColumn("gone", F.lit(True)), present, "left")
        else:
            keyed = keyed.withColumn("gone", F.lit(None).cast("boolean"))
        broken = mine.join(keyed.select(*present, "there", "came", "gone"), present).filter(F.col("there").isNull() | (F.col("came") > F.col("at")))
        state = F.when(F.col("there").isNotNull(), "late").when(F.col("gone"), "deleted").otherwise("missing")
        out.append(broken.select("row_id", "at", state.alias("state")))
    if not out:
        return rows.filter(F.lit(False)).select("row_id", "at", F.lit("").alias("state"))
    return reduce(DataFrame.unionByName, out)
