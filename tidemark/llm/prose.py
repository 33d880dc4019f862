"""Text statistics of every document, and which documents are not natural prose.

Each document gets the statistics of ``STATS``. Per language, mean and covariance of prose are estimated
robustly over all documents: from coordinate-wise medians and absolute deviations, then twice from the
documents within a chi-square distance of the estimate before, as one grouped aggregate each. A document's
Mahalanobis distance to its language's prose is the sum of one contribution per statistic. A document is
an outlier beyond ``LIMIT``; the contributions then tell a list, a table or junk (``kind_of``), and an outlier to
which none of the telling statistics contributes stays prose (text that is merely unusual).

The language is that of the common words it uses most, else that of its label (``EN``, ``en-XX`` and ``en``
are one), else the largest. Null, empty and blank texts have all statistics 0 and are no case. Whole texts
are read; every pass runs over all documents, and only means and covariances, a few numbers per language,
come to the driver.
"""

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, spread

STATS = (
    "log_words", "mean_word_length", "symbol_ratio", "digit_ratio", "ended_lines", "common_words", "words_per_line",
    "item_share", "cell_share", "odd_words", "cycle_share", "inner_capitals",
)
LIMIT = 60.0  # squared distance of an outlier, about twice the quantile below, as statistics of texts have wide tails
WORDS = 32.9  # the 0.999 quantile of chi-square with 12 degrees: what words that are none contribute to nonsense
TRIM = 26.2  # the 0.99 quantile, for the trimmed estimates
FLOOR = {"log_words": 0.3, "mean_word_length": 0.06, "words_per_line": 0.5}  # least standard deviations
FLOOR_ELSE = 0.04

_WORD = re.compile(r"[^\W_]+(?:['’\-][^\W_]+)*")
_STOPS = frozenset(".!?…。！？")
_PARTS = re.compile(r"[,;•·/]|\band\b")
_BULLET = re.compile(r"\s*(?:[-–—*•·»›+◦‣▪]|\[[ xX]?\]|\(?\d{1,3}[.)]|\(?[A-Za-z][.)]|#\d+)\s+\S")
_CELLS = re.compile(r"\s*\|\s*|\t+|\s*;\s*|(?<=\S)(?: {2,})(?=\S)")
_LEADER = re.compile(r"\S\s*(?:\.{3,}|…|_{3,}|-{3,})\s*\S+\s*$")
_ODD = re.compile(r"(?i)[bcdfghjklmnpqrstvwxz]{5}|^[bcdfghjklmnpqrstvwxz]{4,}$|[aeiou]{4}|^.{25,}$|\d[^\W\d]+\d|[^\W\d]\d+[^\W\d]|q[^u]|[jvwxz][jqvxz]|\w[vwxj]$")
_INNER = re.compile(r"[a-zß-ÿ][A-Z]|\d[A-Z]|[A-Z]{2}[a-z]")


@lru_cache(1 << 16)
def _is_odd(word: str) -> bool:
    """Letters that words of natural languages hardly have in a row."""
    return _ODD.search(word) is not None


@lru_cache(1)
def _phases(size: int) -> np.ndarray:
    """A fixed point of the unit circle for each of ``size`` words."""
    return np.exp(2j * np.pi * np.random.RandomState(10).rand(size))


def _period(words: list[str]) -> float:
    """Share of words equal to the word one period before, for the best period of at most half the text. All periods are
    weighed at once by one autocorrelation over the whole list, n log n; the strongest are counted exactly."""
    n, seen = len(words), {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words])
    if n > 64:
        size = 1 << (2 * n - 1).bit_length()
        power = np.abs(np.fft.fft(_phases(1 << max(12, (len(seen) - 1).bit_length()))[ids], size)) ** 2
        periods = np.arange(1, n // 2 + 1)
        weight = np.fft.ifft(power)[1 : n // 2 + 1].real / (n - periods)
        periods = periods[np.argsort(-weight, kind="stable")[:8]]
    else:
        periods = range(1, n // 2 + 1)
    return max(float((ids[p:] == ids[:-p]).mean()) for p in periods)


def _cycle(words: list[str]) -> float:
    """Share of words equal to the word one period before, for the best period of at most half the text, of whatever length
    and wherever it begins; 0 where none holds for four fifths of the words."""
    n = len(words)
    # of n - p >= n / 2 words, such a period repeats three fifths together with the word after them
    if n < 6 or len(set(zip(words, words[1:]))) > 0.7 * n + 1:
        return 0.0
    share = _period(words)
    return share if share > 0.8 else 0.0


def _separated(lines: list[str]) -> tuple[str, int] | None:
    """The separator that occurs equally often, at least twice, in most of at least three lines, and how often: rows of one
    table. Commas and spaces apart, as in sentences, don't count: a field follows a comma without a space."""
    best = None
    if len(lines) >= 3:
        for mark in (",", ";", "|", "\t", "="):
            counts = Counter(x.count(mark) for x in lines)
            n, lines_with = max(((c, k) for c, k in counts.items() if c >= 2), key=lambda x: x[1], default=(0, 0))
            if 2 * lines_with > len(lines) and (mark != "," or 10 * sum(x.count(", ") for x in lines) <= sum(x.count(",") for x in lines)):
                if best is None or lines_with > best[2]:
                    best = (mark, n, lines_with)
    return best and best[:2]


def statistics(text: str | None, common: dict[str, frozenset[str]]) -> tuple[str | None, int, list[float]]:
    """(language by common words, number of words, statistics in the order of ``STATS``)."""
    if not text or not text.strip():
        return None, 0, [0.0] * len(STATS)
    lines, sizes, words = [], [], []
    for line in text.lower().split("\n"):
        body = line.strip()
        if body:
            found = _WORD.findall(body)
            lines.append((body, found))
            sizes.append(len(found) or 1)
            words += found
    n = len(words)
    counts = Counter(words)
    shares = {g: sum(counts[w] for w in ws.intersection(counts)) / max(1, n) for g, ws in common.items()}
    lang = max(sorted(shares), key=shares.get) if shares and max(shares.values()) > 0.1 else None
    share = max(shares.values()) if shares else 0.0
    visible = sum(map(len, text.split()))
    run = "".join(words)
    digits = sum(map(text.count, "0123456789"))
    letters = len(run) - sum(map(run.count, "'’-")) - digits
    items = cells = ended = 0
    weight = sum(sizes)
    separated = _separated([body for body, found in lines if found])
    for (body, found), size in zip(lines, sizes):
        ended += body.rstrip("'\"”’»)]")[-1:] in _STOPS
        if not found:  # a line without a word is neither an item nor a row
            continue
        if separated and body.count(separated[0]) == separated[1] and size <= 6 * (separated[1] + 1):
            cells += size
            continue
        if len(lines) > 1 and ("|" in body or "\t" in body or ";" in body or "  " in body):
            pieces = [p for p in _CELLS.split(body) if p.strip()]
            dense = len(pieces) >= 3 and size <= 6 * len(pieces)
            if (dense or (len(pieces) == 2 and ("|" in body or "\t" in body))) and sum(len(p.split()) <= 6 for p in pieces) >= 0.7 * len(pieces):
                cells += size
                continue
        if size <= 15 and (_BULLET.match(body) or (size <= 12 and _LEADER.search(body))):
            items += size
        elif "," in body and size > 5:
            most = 1 + sum(map(body.count, ",;•·/")) + body.count("and")
            if most >= 5 and size <= 8 * most and body.count(". ") + body.count("! ") + body.count("? ") <= 1 + most // 10:
                parts = [p for p in _PARTS.split(body) if p.strip()]
                short = sum(len(p.split()) <= 5 for p in parts)
                if len(parts) >= 5 and short >= 0.8 * len(parts):
                    items += size
        elif len(lines) >= 4 and size <= 8 and body[-1] not in _STOPS and sum(any(w in ws for ws in common.values()) for w in found) <= 0.25 * len(found):
            items += size
    odd = sum(c for w, c in counts.items() if _is_odd(w))
    inner = len(_INNER.findall(text))
    values = [
        math.log1p(n),
        math.log1p(sum(map(len, words)) / max(1, n)),
        (visible - letters - digits) / max(1, visible),
        digits / max(1, visible),
        ended / len(lines),
        share,
        math.log1p(sorted(sizes)[len(sizes) // 2]),
        items / weight,
        cells / weight,
        odd / max(1, n),
        _cycle(words),
        min(1.0, inner / max(1, n)),
    ]
    return lang, n, values


def document_statistics(df: DataFrame, key: str, text: str, lang: str, common: DataFrame) -> DataFrame:
    """``key``, ``language``, ``words`` and one double per statistic. ``common`` is the list of common words
    (columns lang, word): a fixed reference, read to the driver and sent along with the function."""
    lists: dict[str, set[str]] = {}
    for r in common.select("lang", "word").dropna().collect():
        lists.setdefault(r["lang"], set()).add(r["word"].lower())
    sets = {g: frozenset(ws) for g, ws in lists.items()}
    fallback = "en" if "en" in sets or not sets else min(sets)
    kind = df.schema[key].dataType.simpleString()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                guess, n, values = statistics(t, sets)
                label = (label or "").strip().lower()[:2]
                rows.append((guess or (label if label in sets else fallback), n, values))
            stats = np.array([r[2] for r in rows], float).reshape(len(rows), len(STATS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), *map(pa.array, stats.T)],
                [key, "language", "words", *STATS],
            )

    schema = f"`{key}` {kind}, language string, words bigint, " + ", ".join(f"{s} double" for s in STATS)
    narrow = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").cast("string").alias("__text"), F.col(f"`{lang}`").cast("string").alias("__lang"))
    return spread(narrow).mapInArrow(scan, schema)


def _with_distance(stats: DataFrame, model: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Adds ``contribution`` (array in the order of STATS) and ``distance`` by vectorised batches."""
    langs, fields = sorted(model), stats.columns

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(fields.index(s)).to_numpy(zero_copy_only=False) for s in STATS]) if b.num_rows else np.zeros((0, len(STATS)))
            of = np.array(b.column(fields.index("language")).to_pylist(), dtype=object)
            c = np.zeros_like(x)
            for g in langs:
                at = of == g
                d = x[at] - model[g][0]
                c[at] = d * (d @ model[g][1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(c), pa.list_(pa.float64())), pa.array(c.sum(1))], [*fields, "contribution", "distance"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields)
    return stats.mapInArrow(add, kinds + ", contribution array<double>, distance double")


def _model(rows: list, k: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean and inverse covariance per language from sums of values and products. The least deviations keep the covariance
    regular for any number of documents."""
    floor = np.array([FLOOR.get(s, FLOOR_ELSE) for s in STATS]) ** 2
    out = {}
    for r in rows:
        n, s, q = r["n"], np.array(r["s"], float), np.array(r["q"], float)
        mean = s / n
        cov = np.zeros((k, k))
        cov[np.triu_indices(k)] = q / n
        cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
        out[r["language"]] = (mean, np.linalg.inv(cov + np.diag(floor)))
    return out


def prose_model(stats: DataFrame, steps: int = 2) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Robust mean and inverse covariance of prose per language, over all non-empty documents."""
    k = len(STATS)
    real = stats.filter(F.col("words") > 0)
    mid = real.groupBy("language").agg(*[F.percentile_approx(s, [0.25, 0.5, 0.75], 2000).alias(s) for s in STATS]).collect()
    model = {}
    for r in mid:
        q = np.array([r[s] for s in STATS], float)
        sd = np.maximum((q[:, 2] - q[:, 0]) / 1.349, [FLOOR.get(s, FLOOR_ELSE) * 1.5 for s in STATS])
        model[r["language"]] = (q[:, 1], np.diag(1 / sd**2))
    for step in range(steps):
        near = _with_distance(real, model).filter(F.col("distance") <= TRIM * (2 if step == 0 else 1))
        sums = near.groupBy("language").agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(s) for s in STATS]).alias("s"),
            F.array(*[F.sum(F.col(STATS[i]) * F.col(STATS[j])) for i, j in zip(*np.triu_indices(k))]).alias("q"),
        )
        model |= _model(sums.collect(), k)
    return model


NONSENSE = ("odd_words", "inner_capitals", "mean_word_length")
NOISE = ("symbol_ratio", "digit_ratio")
REPEATED = 0.95  # share of words that repeat the word a period before, of one thing over and over


def kind_of(limit: float = LIMIT) -> Column:
    """list, table, junk or prose, of a row with statistics, distance and contributions.

    Of an outlier the contributions say what sets it apart from its language's prose. Words that are none, or one thing
    over and over, make junk where their contributions alone pass the limit, whatever its form. Otherwise rows or
    items, whichever contributes more, decide if they hold most of the text, as table and list are defined; else
    junk if symbols and digits pass the limit by themselves. An outlier by nothing of this is prose of an unusual kind."""

    def part(name: str) -> Column:
        return F.greatest(F.col("contribution")[STATS.index(name)], F.lit(0.0))

    def total(names: tuple[str, ...]) -> Column:
        return sum((part(n) for n in names[1:]), part(names[0]))

    over = F.when(F.col("cycle_share") > REPEATED, part("cycle_share")).otherwise(0.0)
    rows, items = part("cell_share"), part("item_share")
    return (
        F.when(F.col("distance") <= limit, "prose")
        .when((total(NONSENSE) > WORDS) | (over > limit), "junk")
        .when((rows >= items) & (F.col("cell_share") > 0.5), "table")
        .when((items >= rows) & (F.col("item_share") > 0.5), "list")
        .when(total(NOISE) + total(NONSENSE) + over > limit, "junk")
        .otherwise("prose")
    )


def classify(df: DataFrame, key: str, text: str, lang: str, common: DataFrame) -> DataFrame:
    """Statistics, ``distance``, ``contribution`` per statistic and ``kind`` of every document."""
    stats = cut_lineage(document_statistics(df, key, text, lang, common))
    model = prose_model(stats)
    scored = _with_distance(stats, model)
    return scored.withColumn("kind", F.when((F.col("words") == 0) & (F.col("symbol_ratio") == 0), "prose").otherwise(kind_of()))
