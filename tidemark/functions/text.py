"""Text cleaning, extraction and statistics as Column functions.

All are built-in expressions, apart from Unicode NFKC, for which Spark has none: it runs as an Arrow UDF on texts that
hold a non-ASCII character and is skipped for all others. Null texts are treated as empty unless stated.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unicode white space with the separators \x1c-\x1f, punctuation, and the patterns of the cleaner.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
HTML = r"<[^>]+>"
URL = rf"(?i)https?://[^{WS}]+|www\.[^{WS}]+"
REPEATED = r"([!?.]){3,}"
PUNCT = r"[!-/:-@\[-`{-~]"
EMAIL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
PHONE = rf"\+?\p{{Nd}}[\p{{Nd}}{WS}\-().]{{5,}}\p{{Nd}}"
STOPWORDS = (
    "a an the and or but in on at to of for with is are was were be been being "
    "have has had do does did will would could should may might shall can"
).split()
VOWELS = "[aeiouAEIOU]+"


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def nfkc(c: Column) -> Column:
    return F.when(c.rlike(r"[^\x00-\x7F]"), _nfkc(c)).otherwise(c)


def strip_html(c: Column) -> Column:
    return F.regexp_replace(c, HTML, " ")


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL, " ")


def collapse_punctuation(c: Column) -> Column:
    """A run of three or more of ``!?.`` becomes its last character twice."""
    return F.regexp_replace(c, REPEATED, "$1$1")


def strip_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, PUNCT, " ")


def collapse_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"[{WS}]+", " "))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def clean_text(
    c: Column, *, unicode: bool = True, html: bool = True, urls: bool = True, repeated: bool = True, punctuation: bool = False,
    lower: bool = True, whitespace: bool = True, max_length: int | None = None, null_as: str | None = None,
) -> Column:
    """The whole cleaner, in fixed order. ``null_as='none'`` reproduces the text that a null turns into elsewhere."""
    steps = [(unicode, nfkc), (html, strip_html), (urls, strip_urls), (repeated, collapse_punctuation), (punctuation, strip_punctuation), (lower, F.lower), (whitespace, collapse_whitespace)]
    start = F.coalesce(c.cast("string"), F.lit(null_as)) if null_as else text_of(c)
    out = reduce(lambda x, step: step[1](x) if step[0] else x, steps, start)
    return out if max_length is None else F.substring(out, 1, max_length)


def cleaner_counters(before: Column, uncut: Column, max_length: int | None = None) -> list[Column]:
    """Aggregates of a cleaning: total_cleaned (texts that weren't empty), empty_inputs, chars_removed and truncated. ``uncut`` is
    the text cleaned without ``max_length``, as a text of exactly that length isn't cut."""
    b, a = F.length(text_of(before)), F.length(uncut)
    left = a if max_length is None else F.least(a, F.lit(max_length))
    cut = F.count_if((b > 0) & (a > max_length)) if max_length is not None else F.sum(F.lit(0))
    removed = F.sum(F.when(b > 0, F.greatest(F.lit(0), b - left)).otherwise(0))
    return [F.count_if(b > 0).alias("total_cleaned"), F.count_if(b == 0).alias("empty_inputs"), F.coalesce(removed, F.lit(0)).alias("chars_removed"), F.coalesce(cut, F.lit(0)).cast("long").alias("truncated")]


def cleaner_stats(df: DataFrame, before: str, uncut: str, max_length: int | None = None) -> DataFrame:
    """One row of ``cleaner_counters``."""
    return df.agg(*cleaner_counters(F.col(f"`{before}`"), F.col(f"`{uncut}`"), max_length))


def extract_emails(c: Column) -> Column:
    return F.regexp_extract_all(text_of(c), F.lit(EMAIL), 0)


def extract_phones(c: Column) -> Column:
    return F.regexp_extract_all(text_of(c), F.lit(PHONE), 0)


def words(c: Column) -> Column:
    """Runs of characters other than white space."""
    return F.filter(F.split(strip(text_of(c)), f"[{WS}]+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.regexp_count(text_of(c), F.lit(f"[^{WS}]+"))


def bind(value: Column, f) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def packed_stats(c: Column) -> Column:
    """What ``text_stats`` is made of, as one struct; the words are cut once."""
    t = text_of(c)
    # a sentence is a run without stops that holds a character other than white space
    pieces = F.regexp_count(t, F.lit(f"[^.!?{WS}][^.!?]*"))

    def parts(w: Column) -> Column:
        stops = F.size(F.filter(w, lambda x: F.lower(x).isin(*STOPWORDS)))
        unique = F.size(F.array_distinct(F.transform(w, F.lower)))
        return F.struct(F.size(w).alias("n"), stops.alias("stops"), unique.alias("unique"), F.length(F.array_join(w, "")).alias("letters"), pieces.alias("pieces"), F.length(t).alias("chars"))

    return bind(words(c), parts)


def stats_of(s: Column) -> dict[str, Column]:
    """char_count, word_count, sentence_count, unique_words, avg_word_length, stopword_ratio and diversity of a packed struct."""
    n = s["n"]
    return {
        "char_count": s["chars"],
        "word_count": n,
        "sentence_count": F.when(n > 0, F.greatest(F.lit(1), s["pieces"])).otherwise(0),
        "unique_words": s["unique"],
        "avg_word_length": F.when(n > 0, s["letters"] / n).otherwise(0.0),
        "stopword_ratio": F.when(n > 0, s["stops"] / n).otherwise(0.0),
        "diversity": F.when(n > 0, s["unique"] / n).otherwise(0.0),
    }


def text_stats(c: Column) -> dict[str, Column]:
    return stats_of(packed_stats(c))


def add_text_stats(df: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``keep`` and the statistics; the packed struct is a column of its own, so it is worked out once a row."""
    packed = df.select(*keep, packed_stats(F.col(column)).alias("__packed"))
    return packed.select(*keep, *[v.alias(k) for k, v in stats_of(F.col("__packed")).items()])


def lexical_diversity(c: Column) -> Column:
    w = words(c)
    return F.when(F.size(w) > 0, F.size(F.array_distinct(F.transform(w, F.lower))) / F.size(w)).otherwise(0.0)


def reading_ease(c: Column, places: int | None = 2) -> Column:
    """Flesch reading ease, rounded to ``places``; 0 for a text without words; a syllable is a group of vowels."""
    w = words(c)
    n, sentences = F.size(w), text_stats(c)["sentence_count"]
    syllables = F.aggregate(w, F.lit(0), lambda acc, x: acc + F.greatest(F.lit(1), F.regexp_count(x, F.lit(VOWELS))))
    ease = F.lit(206.835) - F.lit(1.015) * (n / sentences) - F.lit(84.6) * (syllables / n)
    return F.when(n > 0, ease if places is None else F.round(ease, places)).otherwise(0.0)


def top_words(df: DataFrame, key: str, text: str, n: int = 10, exclude_stopwords: bool = True) -> DataFrame:
    """(key, word, n, rank): the most frequent words of each text; ties go to the word met first. Counted within the row, so
    nothing is shuffled; a text without words gives no row."""
    bare = F.transform(words(F.col(text)), lambda w: F.btrim(F.lower(w), F.lit(".,!?;:\"'")))
    if exclude_stopwords:
        bare = F.filter(bare, lambda w: (w != "") & ~w.isin(*STOPWORDS))
    kind = df.schema[key].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            top = [Counter(ws).most_common(n) for ws in batch.column(1).to_pylist()]  # in order of first sight among equals
            sizes = np.array([len(t) for t in top], np.int64)
            rank = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
            flat = [x for t in top for x in t]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(top)), sizes))), pa.array([w for w, _ in flat], pa.string()), pa.array([c for _, c in flat], pa.int64()), pa.array(rank, pa.int32())],
                [key, "word", "n", "rank"],
            )

    return df.select(F.col(f"`{key}`").alias(key), bare.alias("__words")).mapInArrow(count, f"`{key}` {kind}, word string, n bigint, rank int")


def categories(c: Column) -> Column:
    """Comma list to trimmed names, blanks left out."""
    return F.filter(F.transform(F.split(text_of(c), ","), strip), lambda x: x != "")


def checkin_count(c: Column) -> Column:
    return F.size(categories(c))
