"""Field normalisers as Column functions; none of them fails on any input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import WS, strip, text_of


def to_float(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def to_int(c: Column, numeric: bool = False) -> Column:
    """A string must be an integer literal, else 0; a number is truncated."""
    if numeric:
        return F.coalesce(c.try_cast("long"), F.lit(0))
    t = strip(c.cast("string"))
    return F.coalesce(F.when(t.rlike(r"^[+-]?[0-9]+$"), t).try_cast("long"), F.lit(0))


def strip_whitespace(c: Column) -> Column:
    return strip(text_of(c))


def normalise_stars(c: Column) -> Column:
    """Within [1, 5]; 0 if no number; 5 for NaN."""
    v = c.try_cast("double")
    return F.coalesce(F.when(v.isNotNull(), F.greatest(F.lit(1.0), F.least(F.lit(5.0), v))), F.lit(0.0))


def normalise_phone(c: Column) -> Column:
    """White space and ``-().+`` removed; letters stay."""
    return F.regexp_replace(text_of(c), rf"[{WS}\-().+]", "")


def lowercase_strip(c: Column) -> Column:
    return strip(F.lower(text_of(c)))
