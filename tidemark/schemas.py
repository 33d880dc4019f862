"""Schemas of the six record types and the predicates derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import categories, checkin_count, strip, text_of, word_count
from tidemark.functions.validate import valid_date


def _schema(text: str) -> T.StructType:
    kinds = {"s": T.StringType(), "d": T.DoubleType(), "l": T.LongType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (x.split(":") for x in text.split())])


REVIEW = _schema("review_id:s user_id:s business_id:s stars:d useful:l funny:l cool:l text:s date:s")
BUSINESS = _schema("business_id:s name:s city:s state:s stars:d review_count:l is_open:l categories:s latitude:d longitude:d")
USER = _schema("user_id:s name:s review_count:l average_stars:d useful:l funny:l cool:l fans:l")
CHECKIN = _schema("business_id:s date:s")
PHOTO = _schema("photo_id:s business_id:s caption:s label:s")
TIP = _schema("user_id:s business_id:s text:s date:s compliment_count:l")


def _there(name: str) -> Column:
    return F.coalesce(F.length(F.col(name)) >= 1, F.lit(False))


def _at_least(name: str, least: float, most: float | None = None) -> Column:
    c = F.coalesce(F.col(name), F.lit(0))
    return c >= least if most is None else c.between(least, most)


VALID = {
    "review": lambda: _there("review_id") & _there("user_id") & _there("business_id") & _at_least("stars", 1, 5) & _at_least("useful", 0) & _at_least("funny", 0) & _at_least("cool", 0) & ((F.coalesce(F.col("date"), F.lit("")) == "") | valid_date(F.col("date"))),
    "business": lambda: _there("business_id") & _there("name") & _at_least("stars", 1, 5) & _at_least("review_count", 0),
    "user": lambda: _there("user_id") & _at_least("average_stars", 0, 5) & _at_least("review_count", 0) & _at_least("fans", 0),
    "checkin": lambda: _there("business_id"),
    "photo": lambda: _there("photo_id") & _there("business_id"),
    "tip": lambda: _there("user_id") & _there("business_id") & _at_least("compliment_count", 0),
}


def total_votes() -> Column:
    return sum((F.coalesce(F.col(c), F.lit(0)) for c in ("useful", "funny", "cool")), F.lit(0))


def review_flags() -> dict[str, Column]:
    s = F.col("stars")
    return {"total_votes": total_votes(), "is_positive": F.coalesce(s >= 4, F.lit(False)), "is_negative": F.coalesce(s <= 2, F.lit(False)), "word_count": word_count(F.col("text"))}


def business_flags() -> dict[str, Column]:
    return {"category_list": categories(F.col("categories")), "highly_rated": F.coalesce(F.col("stars") >= 4, F.lit(False)), "has_coordinates": F.col("latitude").isNotNull() & F.col("longitude").isNotNull()}


def user_flags() -> dict[str, Column]:
    elite = (F.col("review_count") >= 100) & (F.col("average_stars") >= 4)
    return {"total_votes": total_votes(), "elite_candidate": F.coalesce(elite, F.lit(False))}


def checkin_flags() -> dict[str, Column]:
    return {"checkin_count": checkin_count(F.col("date"))}


def photo_flags() -> dict[str, Column]:
    return {"has_caption": strip(text_of(F.col("caption"))) != ""}


def record_json(*columns: str) -> Column:
    """A record as JSON, nulls written."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def record_from_json(c: Column, schema: T.StructType) -> Column:
    return F.from_json(c, schema)
