"""Record transformations as DataFrame functions: rename, coerce, compute, map, drop, normalise, filter."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_fields(df: DataFrame, mapping: Mapping[str, str], drop_missing: bool = False) -> DataFrame:
    """Renames columns; absent ones are ignored. ``drop_missing`` keeps the mapped columns only. Of two columns that end
    under one name the later wins."""
    kept = {}
    for c in df.columns:
        if c in mapping:
            kept[mapping[c]] = c
        elif not drop_missing:
            kept[c] = c
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in kept.items()])


def coerce_types(df: DataFrame, schema: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Casts columns that exist. A value that can't be cast becomes null and its original goes to ``_coerce_error``, a map
    from column to text; ``strict`` raises instead."""
    there = {c: t for c, t in schema.items() if c in df.columns}
    if strict:
        return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in there.items()})
    lost = [F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull(), F.struct(F.lit(c).alias("k"), F.col(f"`{c}`").cast("string").alias("v"))) for c, t in there.items()]
    errors = F.map_from_entries(F.filter(F.array(*lost), lambda x: x.isNotNull())) if lost else F.lit(None).cast("map<string,string>")
    return df.withColumns({"_coerce_error": errors, **{c: F.col(f"`{c}`").try_cast(t) for c, t in there.items()}})


def add_computed(df: DataFrame, computations: Mapping[str, Column | tuple[Callable, str]]) -> DataFrame:
    """All expressions see the record as it came, not one another's results. A Python callable goes with its type; it gets
    the row as a dict, in Arrow batches (the slow path), and gives null where it fails."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumns({n: c if isinstance(c, Column) else _called(c[0], c[1])(row) for n, c in computations.items()})


def map_values(df: DataFrame, field: str, mapping: Mapping, default=None) -> DataFrame:
    """Values in ``mapping`` are replaced, null among the results; others become ``default``, or stay if it is None."""
    if field not in df.columns or not mapping:
        return df if default is None or field not in df.columns else df.withColumn(field, F.lit(default))
    c, out = F.col(f"`{field}`"), None
    for k, v in mapping.items():
        test = c.isNull() if k is None else c == F.lit(k)
        out = F.when(test, F.lit(v)) if out is None else out.when(test, F.lit(v))
    return df.withColumn(field, out.otherwise(c if default is None else F.lit(default)))


def drop_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.drop(*fields)


def normalise_fields(df: DataFrame, chains: Mapping[str, Sequence[Callable[[Column], Column]]], strict: bool = False) -> DataFrame:
    """Applies each column's functions in order; absent columns are ignored, or an error if ``strict``."""
    absent = [c for c in chains if c not in df.columns]
    if absent and strict:
        raise KeyError(absent[0])
    return df.withColumns({c: reduce(lambda x, f: f(x), fs, F.col(f"`{c}`")) for c, fs in chains.items() if c not in absent})


def _called(f: Callable, kind: str = "boolean"):
    """``f`` of rows as dicts, as an Arrow function. As a predicate its result is taken for true or false and its failures
    are raised; as a computation they are null."""

    @F.arrow_udf(kind)
    def call(rows: pa.Array) -> pa.Array:
        if kind == "boolean":
            return pa.array([bool(f(r)) for r in rows.to_pylist()], pa.bool_())
        out = []
        for r in rows.to_pylist():
            try:
                out.append(f(r))
            except Exception:
                out.append(None)
        return pa.array(out, arrow_kind)

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_kind = to_arrow_type(T._parse_datatype_string(kind)) if kind != "boolean" else None
    return call


def keep_if(df: DataFrame, predicates: Sequence[Column | Callable]) -> DataFrame:
    """Rows for which every predicate holds; null counts as false. A Python callable gets the row as a dict; it is the slow
    path, in Arrow batches."""
    cols = []
    for p in predicates:
        cols.append(p if isinstance(p, Column) else _called(p)(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return df.filter(F.coalesce(reduce(and_, cols), F.lit(False))) if cols else df


def process(df: DataFrame, filters: Sequence[Column] = (), sample_rate: float = 1.0, seed: int | None = None, transforms: Sequence[Callable[[DataFrame], DataFrame]] = ()) -> DataFrame:
    """Filter, then sample, then transform."""
    if not 0 < sample_rate <= 1:
        raise ValueError("sample_rate must be in (0, 1]")
    out = keep_if(df, filters)
    if sample_rate < 1:
        out = out.sample(False, sample_rate, seed)
    return reduce(lambda d, f: d.transform(f), transforms, out)


def min_stars(df: DataFrame, least: float, column: str = "stars") -> DataFrame:
    return df.filter(F.coalesce(F.col(column).try_cast("double"), F.lit(0.0)) >= least)


def parquet_safe(df: DataFrame, scalar_only: bool = True) -> DataFrame:
    """Structs, arrays, maps and variants as JSON text."""
    if not scalar_only:
        return df
    nested = ("struct", "array", "map", "variant")
    return df.withColumns({n: F.to_json(F.col(f"`{n}`"), {"ignoreNullFields": "false"}) for n, t in df.dtypes if t.startswith(nested)})
