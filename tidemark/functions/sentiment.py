"""Sentiment polarity and labels.

Three backends give polarity and subjectivity: ``textblob`` where that library can be imported, ``neutral`` (0, 0), which is
the defined result without it, and ``lexicon``, a small word list of our own that runs as built-in expressions. ``auto``
takes the first of textblob and neutral that is there. Labels are always built-in expressions over the polarity.
"""

from __future__ import annotations

import importlib.util

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import bind, strip_punctuation, text_of, words

POSITIVE, NEGATIVE = 0.1, -0.1

# The words of the lexicon backend.
GOOD = "good great excellent superb lovely charming delightful perfect fresh friendly best love loved nice polished memorable thoughtful flawless".split()
BAD = "bad awful terrible horrible worst sour soggy bland burnt stale rude dirty slow overpriced mediocre greasy chaotic careless".split()


@F.pandas_udf(T.StructType([T.StructField("polarity", T.DoubleType()), T.StructField("subjectivity", T.DoubleType())]))
def _textblob(s: pd.Series) -> pd.DataFrame:
    def one(t):
        try:
            from textblob import TextBlob

            r = TextBlob(t).sentiment
            return float(r.polarity), float(r.subjectivity)
        except Exception:
            return 0.0, 0.0

    return pd.DataFrame([one(t) if t else (0.0, 0.0) for t in s], columns=["polarity", "subjectivity"])


def lexicon_score(c: Column) -> Column:
    w = words(F.lower(strip_punctuation(text_of(c))))

    def counts(w: Column) -> Column:
        return F.struct(F.size(F.filter(w, lambda x: x.isin(*GOOD))).alias("good"), F.size(F.filter(w, lambda x: x.isin(*BAD))).alias("bad"), F.size(w).alias("n"))

    def score(s: Column) -> Column:
        hits = s["good"] + s["bad"]
        polarity = F.when(hits > 0, (s["good"] - s["bad"]) / hits).otherwise(0.0)
        return F.struct(polarity.alias("polarity"), F.when(s["n"] > 0, hits / s["n"]).otherwise(0.0).alias("subjectivity"))

    return bind(bind(w, counts), score)


def sentiment(c: Column, backend: str = "auto") -> Column:
    """Struct of polarity and subjectivity; (0, 0) for a null or empty text."""
    if backend == "auto":
        backend = "textblob" if importlib.util.find_spec("textblob") else "neutral"
    if backend == "textblob":
        return _textblob(text_of(c))
    if backend == "lexicon":
        return lexicon_score(c)
    if backend == "neutral":
        return F.struct(F.lit(0.0).alias("polarity"), F.lit(0.0).alias("subjectivity"))
    raise ValueError(f"unknown backend {backend!r}")


def label(polarity: Column, positive: float = POSITIVE, negative: float = NEGATIVE) -> Column:
    """positive, negative or neutral; both bounds are strict."""
    if positive <= negative:
        raise ValueError("the positive bound must be above the negative one")
    return F.when(polarity > positive, "positive").when(polarity < negative, "negative").otherwise("neutral")


def warehouse_label(polarity: Column) -> Column:
    """The warehouse vocabulary, with bounds at zero."""
    return F.when(polarity > 0, "Positive").when(polarity < 0, "Negative").otherwise("Neutral")


def enrich(df: DataFrame, text: str = "text", backend: str = "auto", positive: float = POSITIVE, negative: float = NEGATIVE) -> DataFrame:
    """Adds sentiment_polarity, sentiment_subjectivity and sentiment_label; the backend runs once per row."""
    scored = df.withColumn("__s", sentiment(F.col(text), backend))
    return scored.withColumns({"sentiment_polarity": F.col("__s.polarity"), "sentiment_subjectivity": F.col("__s.subjectivity"), "sentiment_label": label(F.col("__s.polarity"), positive, negative)}).drop("__s")


def result(c: Column, backend: str = "auto", positive: float = POSITIVE, negative: float = NEGATIVE) -> Column:
    """Struct of polarity and subjectivity to four places, and the label of the polarity before rounding."""

    def parts(s: Column) -> Column:
        return F.struct(F.round(s["polarity"], 4).alias("polarity"), F.round(s["subjectivity"], 4).alias("subjectivity"), label(s["polarity"], positive, negative).alias("label"))

    return bind(sentiment(c, backend), parts)


def label_counts(df: DataFrame, column: str = "sentiment_label") -> DataFrame:
    c = F.col(column)
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(c == v).alias(v) for v in ("positive", "negative", "neutral")])


def register(spark: SparkSession, name: str = "analyze_sentiment") -> None:
    """The label function for SQL, as a SQL function over built-in expressions where no library is there."""
    if importlib.util.find_spec("textblob"):

        @F.pandas_udf(T.StringType())
        def fn(s: pd.Series) -> pd.Series:
            p = _textblob.func(s)["polarity"]
            return p.map(lambda v: "Positive" if v > 0 else "Negative" if v < 0 else "Neutral")

        spark.udf.register(name, fn)
    else:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS STRING RETURN 'Neutral'")
