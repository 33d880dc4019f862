"""Validators as Column predicates, and a declarative record schema compiled to an array of errors."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import strip, text_of


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def valid_stars(c: Column) -> Column:
    return _sure(c.try_cast("double").between(1, 5))


def valid_email(c: Column) -> Column:
    return _sure(strip(c).rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$"))


def valid_date(c: Column) -> Column:
    """Shape only: any ``dddd-dd-dd``."""
    return _sure(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"))


def valid_business_id(c: Column) -> Column:
    return strip(text_of(c)) != ""


def valid_review_id(c: Column) -> Column:
    return _sure(c.rlike(r"^[A-Za-z0-9_\-]{1,100}$"))


def valid_coordinates(lat: Column, lon: Column) -> Column:
    return _sure(lat.between(-90, 90) & lon.between(-180, 180))


def valid_length(c: Column, least: int, most: int) -> Column:
    return _sure(F.length(c).between(least, most))


def sanitize(c: Column, most: int = 10_000) -> Column:
    return F.substring(strip(F.replace(text_of(c), F.lit("\u0000"), F.lit(""))), 1, most)


TYPES = {"str": {"STRING"}, "int": {"BIGINT", "BOOLEAN"}, "float": {"DECIMAL", "DOUBLE", "FLOAT"}, "bool": {"BOOLEAN"}, "list": {"ARRAY"}, "dict": {"OBJECT"}, "any": set()}


@dataclass(frozen=True)
class FieldSpec:
    """What a field of a record must be. ``kind`` is a key of TYPES; a boolean passes as int, an int fails float."""

    name: str
    kind: str = "any"
    required: bool = True
    min_value: float | None = None
    max_value: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    allowed: Sequence | None = None

    def __post_init__(self) -> None:
        if self.kind not in TYPES:
            raise ValueError(f"unknown type {self.kind!r}")

    def errors(self, record: Column) -> list[Column]:
        """Error messages (or null) on a variant record. A wrong type ends the checks of the field."""
        path = f"$.{self.name}"
        v = F.try_variant_get(record, path, "variant")
        shape = F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)
        absent = v.isNull() | (shape == "VOID")
        typed = F.lit(True) if self.kind == "any" else shape.isin(*TYPES[self.kind])
        ok = ~absent & typed
        number = F.when(shape.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN"), F.try_variant_get(record, path, "double"))
        text = F.when(shape == "STRING", F.try_variant_get(record, path, "string"))
        # of texts and lists; nothing else has a length
        length = F.when(shape == "ARRAY", F.size(F.try_variant_get(record, path, "array<variant>"))).otherwise(F.length(text))
        checks = [(absent & F.lit(self.required), "required field is missing"), (~absent & ~typed, f"expected {self.kind}")]
        if self.min_value is not None:
            checks.append((ok & (number < self.min_value), f"below {self.min_value}"))
        if self.max_value is not None:
            checks.append((ok & (number > self.max_value), f"above {self.max_value}"))
        if self.min_length is not None:
            checks.append((ok & (length < self.min_length), f"shorter than {self.min_length}"))
        if self.max_length is not None:
            checks.append((ok & (length > self.max_length), f"longer than {self.max_length}"))
        if self.allowed:
            words, numbers = [x for x in self.allowed if isinstance(x, str)], [float(x) for x in self.allowed if isinstance(x, (int, float))]
            found = F.coalesce(text.isin(*words), F.lit(False)) | F.coalesce(number.isin(*numbers), F.lit(False))
            checks.append((ok & ~found, "value not allowed"))
        return [F.when(c, F.lit(f"{self.name}: {m}")) for c, m in checks]


def schema_errors(record: Column, specs: Sequence[FieldSpec]) -> Column:
    """All errors of a variant record, in the order of the specs; empty if it is valid."""
    return F.filter(F.array(*[e for s in specs for e in s.errors(record)]), lambda e: e.isNotNull())


def filter_valid(df: DataFrame, record: str, specs: Sequence[FieldSpec]) -> DataFrame:
    return df.filter(F.size(schema_errors(F.col(record), specs)) == 0)


def validation_metrics(df: DataFrame, valid: Column) -> DataFrame:
    """total, valid, invalid, valid_rate and error_rate (0 of an empty table)."""
    n, ok = F.count(F.lit(1)), F.count_if(valid)
    rate = F.coalesce(ok / F.nullif(n, F.lit(0)), F.lit(0.0))
    return df.agg(n.alias("total"), ok.alias("valid"), (n - ok).alias("invalid"), rate.alias("valid_rate"), F.when(n > 0, 1 - rate).otherwise(0.0).alias("error_rate"))


def jsonl_syntax_errors(spark: SparkSession, path: str, max_errors: int = 100) -> DataFrame:
    """(line, value) of lines that are no JSON, blanks left out, in line order; line numbers count from 1 within the path."""
    from tidemark.sources.jsonl import numbered_lines

    bad = numbered_lines(spark, path).filter((strip(F.col("value")) != "") & F.try_parse_json("value").isNull())
    return bad.orderBy("line").limit(max_errors)


def valid_review_record(record: Column) -> Column:
    """Is a variant an object with review_id, user_id, business_id and stars, of which the last is a number from 1 to 5?"""
    return (F.size(missing_fields(record, ["review_id", "user_id", "business_id", "stars"])) == 0) & valid_stars(F.try_variant_get(record, "$.stars", "string"))


def input_path(path: str) -> str:
    """The absolute path of a file that exists, is a file and can be read."""
    full = os.path.realpath(path)
    if not os.path.isfile(full) or not os.access(full, os.R_OK):
        raise ValueError(f"{full}: {'not a file' if os.path.exists(full) else 'does not exist'}" if not os.path.isfile(full) else f"{full}: not readable")
    return full


def output_prefix(prefix: str) -> str:
    if not prefix:
        raise ValueError("the output prefix is empty")
    return prefix


def missing_fields(record: Column, required: Sequence[str]) -> Column:
    """Required keys that a variant object lacks; a key with a null value is there."""
    there = F.coalesce(F.json_object_keys(F.to_json(record)), F.array().cast("array<string>"))
    return F.array_except(F.array(*map(F.lit, required)), there)
