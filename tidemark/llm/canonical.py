"""Free-entered values mapped to the entries of a reference list, or reported as unmatched.

Token-level repair. Distinct values are cut into tokens; each distinct token is joined to the reference
vocabulary by edit distance (transpositions count one) through shared deletion variants, an equi-join that
compares only tokens within reach. Corrected tokens are then combined by soft TF-IDF: a candidate entry's
score is the weight of its repaired tokens times their similarity, against the weights of value and entry,
so a missing or a foreign token costs its share. The best entry wins if it scores at least ``ACCEPT``.

The reference list is small and fixed; its size is checked before it is sent to the executors, and beyond
``MAX_REFERENCE`` rows the same joins run shuffled. Work grows with distinct values, which meet the rows again
by one join at the end.

Null and blank values give no row; values without a candidate get ``UNMATCHED``. Of equally scored entries
the one in the row's state wins, then the smallest id.
"""

import re
import unicodedata
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage, spread

UNMATCHED = -1
ACCEPT = 0.86
LEAST_SIM = 0.8625  # of tokens within reach, so that a value of one token is accepted wherever the reach allows
MAX_REFERENCE = 20_000

# Words around a place name that do not change which place is meant, and short forms.
FILLERS = frozenset("city of the town village township area downtown greater metro metropolitan old near central center centre region district usa us".split())
SHORT = {
    "n": "north", "no": "north", "nth": "north", "s": "south", "so": "south", "sth": "south", "e": "east", "w": "west", "st": "saint", "ste": "saint",
    "ft": "fort", "mt": "mount", "mtn": "mountain", "pt": "port", "prt": "port", "lk": "lake", "bch": "beach", "jct": "junction", "jctn": "junction", "jn": "junction",
    "hts": "heights", "hgts": "heights", "hghts": "heights", "pk": "park", "prk": "park", "spgs": "springs", "spr": "springs", "spg": "springs", "sprgs": "springs", "fls": "falls",
    "nw": "new", "vlg": "village", "is": "island", "hbr": "harbor", "vly": "valley",
}
_PIECE = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z]{3})(?=[A-Z][a-z]{2})")


def tokens_of(value: str, states: frozenset[str] = frozenset()) -> list[str]:
    """Tokens of a value: accents and case folded, short forms written out, fillers, numbers and a trailing
    state code left out. A value of fillers only keeps them."""
    text = value.strip()
    if text[:1].isupper() or text[:1].islower() and not text[1:2].isupper():
        text = _CAMEL.sub(" ", text)
    text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
    found = _PIECE.findall(text)
    while len(found) > 1 and found[-1] in states:
        found.pop()
    full = [SHORT.get(t, t) for t in found]
    if len(full[-1:]) and full[-1].endswith("area") and len(full[-1]) > 9:
        full[-1] = full[-1][:-4]
    kept = [t for t in full if t not in FILLERS]
    return kept or full


def deletions(token: str, reach: int) -> list[str]:
    """The token and all that is left of it after up to ``reach`` deletions."""
    out = {token}
    for k in range(1, min(reach, len(token) - 1) + 1):
        out.update("".join(c for i, c in enumerate(token) if i not in gone) for gone in map(set, combinations(range(len(token)), k)))
    return sorted(out)


def osa(a: str, b: str) -> int:
    """Edit distance with adjacent transpositions."""
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
    return last[-1]


def reach_of(token: str) -> int:
    """Edits allowed in a token: none up to 3 letters, one up to 6, else two."""
    return 0 if len(token) <= 3 else 1 if len(token) <= 6 else 2


def _udf_tokens(states: frozenset[str]):
    @F.pandas_udf("array<string>")
    def tokens(s: pd.Series) -> pd.Series:
        return s.map(lambda v: tokens_of(v, states))

    return tokens


@F.pandas_udf(T.ArrayType(T.StringType()))
def _variants(s: pd.Series) -> pd.Series:
    return s.map(lambda t: deletions(t, reach_of(t)))


@F.pandas_udf(T.IntegerType())
def _edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([osa(x, y) for x, y in zip(a, b)], dtype="int32")


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_REFERENCE else df


def map_to_reference(values: DataFrame, value: str, state: str, ref: DataFrame, ref_id: str, ref_name: str, ref_state: str) -> DataFrame:
    """``value``, ``state``, ``entry`` (id or UNMATCHED), ``score`` per distinct (value, state).

    A name that occurs in several states is decided by the row's state; if that names none of them, by a
    state code at the end of the value.
    """
    names = ref.select(F.col(ref_id).alias("entry"), F.col(ref_name).alias("name"), F.upper(F.trim(ref_state)).alias("entry_state")).dropna(subset=["entry", "name"])
    size = names.count()
    # codes of at most three letters, of which there are under 20 000 whatever the list
    codes = frozenset(r[0].lower() for r in names.select("entry_state").filter(F.col("entry_state").rlike("^[A-Z]{1,3}$")).distinct().collect())
    tokens = _udf_tokens(codes)

    entries = cut_lineage(names.withColumn("toks", F.array_distinct(tokens("name"))))
    weight = F.log(F.lit(1.0 + size) / F.col("df")) + 0.2
    flat = entries.select("entry", F.explode("toks").alias("tok"))
    vocab = flat.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).select("tok", weight.alias("w"))
    entry_tokens = flat.join(vocab, "tok")
    entry_weight = entry_tokens.groupBy("entry").agg(F.sum("w").alias("ew"), F.count(F.lit(1)).alias("en"))
    joined = entries.select("entry", F.concat_ws("", "toks").alias("joined"))

    text = F.col(f"`{value}`").cast("string")
    given = cut_lineage(values.filter(F.length(F.trim(text)) > 0).select(text.alias("value"), F.col(f"`{state}`").alias("state")).distinct())
    cut = given.select("value", F.upper(F.regexp_extract(F.trim("value"), r"(?i)[\s,/(]([A-Z]{2})\)?(?:\s+\d+)?\s*$", 1)).alias("code")).distinct().withColumn("toks", F.array_distinct(tokens("value")))
    cut = cut_lineage(cut.withColumn("whole", F.concat_ws("", "toks")))

    # tokens within reach of the vocabulary, by shared deletion variants
    terms = F.broadcast(vocab) if size <= MAX_REFERENCE else vocab
    near_ref = terms.select(F.col("tok").alias("ref_tok"), "w", F.explode(_variants("tok")).alias("v"))
    own = cut.select(F.explode("toks").alias("tok")).distinct()
    own = cut_lineage(own)
    repaired = _repair(own, near_ref.select("ref_tok", "v"), size).join(_sized(vocab.withColumnRenamed("tok", "ref_tok"), size), "ref_tok")

    # run-together values: the whole value against each entry's tokens joined
    near_whole = joined.select(F.col("joined").alias("ref_tok"), F.explode(_variants("joined")).alias("v")).distinct()
    whole = _repair(cut.select(F.col("whole").alias("tok")).distinct(), near_whole, size)

    value_tokens = cut.select("value", F.explode("toks").alias("tok"))
    # what an unknown token weighs: as one of a vocabulary entry that occurs once
    rare = F.log(F.lit(1.0 + size)) + 0.2
    hits = value_tokens.join(repaired, "tok").join(_sized(entry_tokens.select("entry", F.col("tok").alias("ref_tok")), size), "ref_tok")
    best = hits.groupBy("value", "entry", "ref_tok", "w").agg(F.max("sim").alias("sim"), F.max_by("tok", "sim").alias("by"))
    # a token stands for one token of an entry
    once = best.groupBy("value", "entry", "by").agg(F.max(F.col("w") * F.col("sim")).alias("part"))
    got = once.groupBy("value", "entry").agg(F.sum("part").alias("gain"), F.collect_set("by").alias("used"))
    unused = F.size(F.array_except("toks", "used"))
    scored = (
        got.join(cut.select("value", "toks"), "value")
        .join(_sized(entry_weight, size), "entry")
        .select("value", "entry", (F.col("gain") / (F.col("ew") + unused * rare)).alias("score"))
    )
    run_on = cut.join(whole.withColumnRenamed("tok", "whole"), "whole").join(_sized(joined.withColumnRenamed("joined", "ref_tok"), size), "ref_tok").select("value", "entry", F.col("sim").alias("score"))
    candidates = scored.unionByName(run_on).filter(F.col("score") >= ACCEPT).groupBy("value", "entry").agg(F.max("score").alias("score"))

    ranked = (
        given.join(cut.select("value", "code"), "value")
        .join(candidates, "value", "left")
        .join(_sized(names.select("entry", "entry_state"), size), "entry", "left")
        .withColumn("agrees", F.when(F.upper(F.trim("state")) == F.col("entry_state"), 2).when(F.col("code") == F.col("entry_state"), 1).otherwise(0))
    )
    # the best score within a hair of the top, then the state, then the smallest id
    order = Window.partitionBy("value", "state").orderBy(F.round("score", 3).desc_nulls_last(), F.desc("agrees"), F.col("entry").asc_nulls_last())
    top = ranked.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") == 1)
    return top.select("value", "state", F.coalesce("entry", F.lit(UNMATCHED)).alias("entry"), "score")


def _repair(tokens: DataFrame, near_ref: DataFrame, size: int) -> DataFrame:
    """(tok, ref_tok, sim) of all pairs within the allowed edits; the entries decide among them.

    No pair is further apart in length than the edits allowed, so tokens longer than the longest reference by more than that make
    no variants. Of the pairs that share a variant, the built-in edit distance, in which a transposition counts two, rules out
    most before transpositions are weighed."""
    longest_ref = near_ref.agg(F.coalesce(F.max(F.length("ref_tok")), F.lit(0)).alias("__longest"))
    short = tokens.join(F.broadcast(longest_ref), F.length("tok") <= F.col("__longest") + 2).select("tok")
    pairs = spread(short).withColumn("v", F.explode(_variants("tok"))).join(_sized(near_ref, size), "v").select("tok", "ref_tok").distinct()
    reach = F.least(_reach(F.col("tok")), _reach(F.col("ref_tok")))
    near = pairs.filter((F.abs(F.length("tok") - F.length("ref_tok")) <= reach) & (F.levenshtein("tok", "ref_tok") <= 2 * reach))
    cores = tokens.sparkSession.sparkContext.defaultParallelism
    measured = near.repartition(max(cores, int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))).withColumn("edits", _edits("tok", "ref_tok"))
    measured = cut_lineage(measured)
    allowed = F.least(_reach(F.col("tok")), _reach(F.col("ref_tok")))
    # a token that lost or gained letters is measured by the longer of the two
    longest = F.greatest(F.length("tok"), F.length("ref_tok"))
    sim = F.greatest(F.lit(1.0) - F.col("edits") / longest * 0.55, F.lit(LEAST_SIM))
    return measured.filter(F.col("edits") <= F.greatest(allowed, F.lit(0))).select("tok", "ref_tok", sim.alias("sim"))


def _reach(token: Column) -> Column:
    return F.when(F.length(token) <= 3, 0).when(F.length(token) <= 6, 1).otherwise(2)


def map_rows(rows: DataFrame, key: str, value: str, state: str, ref: DataFrame, ref_id: str, ref_name: str, ref_state: str) -> DataFrame:
    """``key`` and ``entry`` of each distinct key with a value that is neither null nor blank. A key
    delivered with several values keeps the smallest matched entry."""
    named = rows.select(F.col(f"`{key}`").alias(key), F.col(f"`{value}`").cast("string").alias("value"), F.col(f"`{state}`").alias("state"))
    named = named.filter(F.col(key).isNotNull() & (F.length(F.trim("value")) > 0)).distinct()
    mapped = map_to_reference(named, "value", "state", ref, ref_id, ref_name, ref_state)
    joined = named.alias("n").join(mapped.alias("m"), (F.col("n.value") == F.col("m.value")) & F.col("n.state").eqNullSafe(F.col("m.state")), "left")
    entry = F.min(F.when(F.col("entry") >= 0, F.col("entry")))
    return joined.groupBy(key).agg(F.coalesce(entry, F.lit(UNMATCHED)).alias("entry"))
