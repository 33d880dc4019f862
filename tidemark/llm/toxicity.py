"""Scores of abusive, hateful or sexual content, learned from confirmed examples and unlabelled text.

Non-negative positive-unlabelled learning. Confirmed toxic texts (P) and unlabelled ones (U) are cut into
sentences; a linear model over hashed features is fitted with numpy to the class-prior-corrected risk

    prior * R_P(+) + max(0, R_U(-) - prior * R_P(-)),

where a negative part that falls below zero is pushed back, as the non-negative estimator demands. A confirmed
text has mostly harmless sentences, so a first fit takes all of its sentences as P and a second only the one
that scores highest. The prior is estimated from the shares of U that reach the scores that ``HITS`` of P reach. The threshold is
where the F1 of held-out texts, with precision taken from the prior, is highest.

A text's score is the logistic of its highest sentence, over the whole text; a sentence ends at a stop, a line end or
tag, and where a capital follows a small letter (stops are often left out). Tokens are folded so that masked,
spaced, respelled and look-alike spellings meet: look-alike letters and digits are mapped, invisible characters
dropped, runs collapsed, and each token also counts as the set of its letters, which swapped letters share.

The sample to fit is bounded by ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` (documented parameters, chosen by a hash of
the key, the same at every size); every text is scored. Null, empty and blank texts score 0.
"""

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import spread

MAX_POSITIVE = 3000
MAX_UNLABELLED = 10_000
DIMENSIONS = 1 << 18
THRESHOLD = 0.5

# Characters that stand for Latin letters.
_ALIKE = str.maketrans(
    {
        **dict(zip("аеорсухіјѕԁɡһкмтвнӏ", "aeopcyxijsdghkmtbhl")),
        **dict(zip("αεορυικτνβ", "aeopuiktvb")),
        **dict(zip("áàâäãåéèêëíìîïóòôöõúùûüñç", "aaaaaaeeeeiiiiooooouuuunc")),
        **dict.fromkeys("​‌‍⁠﻿­‎‏"),
    }
)
_DIGIT_LETTERS = str.maketrans("@$0134578!|+", "asoieastbiit")
_EDGE = "\"'“”‘’.,;:?!()[]{}<>…«»¿¡&"
_END = re.compile(r"[.!?…]['\"”’)\]]*$")
_MASKED = re.compile(r"^[a-z]?[a-z]?[*#_.\-]+[a-z]?[a-z]?$|^[a-z]+[*#]+[a-z]*$")
_RUN = re.compile(r"(.)\1+")
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def fold(token: str) -> str:
    """The spelling-independent form of a lower-case token; ``#`` for a number, ``*`` kept for masked letters."""
    t = token.translate(_ALIKE)
    end = t.strip(_EDGE) if t[:1] not in "$@" else t.rstrip(_EDGE)
    if not end:
        return ""
    letters = sum(map(str.isalpha, end))
    if not letters and not ("*" in end):
        return "#" if any(map(str.isdigit, end)) and not re.search(r"\d{2,}[a-z$@!]|[$@!]\w*[$@!]", end) else end[:1]
    if letters and "*" not in end and not end.isalpha():
        digits = re.sub(r"[^a-z0-9@$!|+]", "", end)
        if not re.fullmatch(r"[$]?\d+(?:st|nd|rd|th|am|pm|min|h|k)?", digits):
            end = digits.translate(_DIGIT_LETTERS)
    return _RUN.sub(r"\1", end)


class Features:
    """Hashed features of the sentences of a batch of texts; tokens met before are looked up."""

    CACHE = 1 << 20  # tokens held before the cache starts anew; a bound on memory, not on results

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int, int]] = {}

    def _token(self, raw: str) -> tuple[int, int, int]:
        if raw == "\ue000":
            return 0, 0, 1
        t = fold(raw)
        if not t:
            return 0, 0, int(bool(_END.search(raw)))
        shape = f"*{t[0]}{t[-1]}" if _MASKED.match(t) and "*" in t else "".join(sorted(set(t)))
        word = "*" if "*" in t else t
        return xxhash.xxh64_intdigest(word), xxhash.xxh64_intdigest("~" + shape), int(bool(_END.search(raw)))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(features [tokens, 4], start of each sentence, text of each sentence); index 0 is no feature."""
        t = pc.fill_null(texts.cast(pa.string()), "")
        t = pc.replace_substring_regex(t, r"<[^>]*>|\n+", " \ue000 ")
        t = pc.replace_substring_regex(t, r"([\p{Ll}\p{N}]) +(\p{Lu}\p{Ll})", "\\1 \ue000 \\2")
        words = pc.utf8_split_whitespace(pc.utf8_lower(t))
        sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        if len(coded) == 0:
            return np.zeros((0, 4), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.known) > self.CACHE:
            self.known.clear()
        table = []
        for raw in coded.dictionary.to_pylist():
            got = self.known.get(raw)
            if got is None:
                got = self.known[raw] = self._token(raw)
            table.append(got)
        table = np.array(table, dtype=np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]
        doc = np.repeat(np.arange(len(sizes)), sizes)
        word, shape, ends = table[:, 0], table[:, 1], table[:, 2]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (ends[:-1] == 1)
        starts = np.flatnonzero(new)
        sentence = np.cumsum(new)
        # drop what is no word; pairs and triples are of words of one sentence
        keep = word != 0
        w, s, g = word[keep], shape[keep], sentence[keep]
        two, three = np.zeros(len(w), np.uint64), np.zeros(len(w), np.uint64)
        if len(w) > 1:
            same = g[1:] == g[:-1]
            pair = w[:-1] * _MULT[0] + (w[1:] ^ _MULT[1]) * _MULT[2]
            two[:-1] = np.where(same, pair, 0)
        if len(w) > 2:
            same = g[2:] == g[:-2]
            three[:-2] = np.where(same, (pair[:-1] ^ _MULT[1]) * _MULT[0] + w[2:] * _MULT[2], 0)
        out = np.zeros((len(doc), 4), np.int64)
        hashed = np.stack([w, s, two, three], 1)
        out[keep] = np.where(hashed == 0, 0, 1 + ((hashed ^ (hashed >> np.uint64(29))) % np.uint64(DIMENSIONS - 1)).astype(np.int64))
        return out, starts, doc[starts]


@dataclass
class Model:
    weights: np.ndarray  # by feature; 0 for feature 0
    bias: float
    prior: float

    def sentences(self, features: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weights[features].sum(1), starts) + self.bias if len(starts) else np.zeros(0)

    def scores(self, texts: pa.Array, make: Features) -> np.ndarray:
        out = np.zeros(len(texts))
        features, starts, doc = make(texts)
        if len(starts):
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            worded = np.logical_or.reduceat(features[:, 0] != 0, starts)
            top = np.maximum.reduceat(np.where(worded, self.sentences(features, starts), -np.inf), first)
            out[doc[first]] = np.where(np.isneginf(top), 0, 1 / (1 + np.exp(-np.clip(top, -30, 30))))
        return out


def _fit(p, u, prior: float, epochs: int, rate: float, l2: float, floor: float, size: int) -> tuple[np.ndarray, float]:
    """nnPU by full-batch Adagrad over ``size`` features; ``p`` and ``u`` are (features, sentence of each token, number of
    sentences)."""
    w, b = np.zeros(size), -2.0
    gw, gb = np.full(size, 1e-8), 1e-8

    def logits(x):
        return np.bincount(x[1], w[x[0]].sum(1), x[2]) + b

    def back(x, grad):
        return np.bincount(x[0].ravel(), np.repeat(grad[x[1]], 4), size), grad.sum()

    for _ in range(epochs):
        sp, su = 1 / (1 + np.exp(-logits(p))), 1 / (1 + np.exp(-logits(u)))
        # logistic loss: log(1 + e^-z) on P as positive, log(1 + e^z) as negative
        negative = np.mean(-np.log1p(-np.clip(su, 0, 1 - 1e-9))) - prior * np.mean(-np.log1p(-np.clip(sp, 0, 1 - 1e-9)))
        if negative >= 0:
            dp, du = (prior * (sp - 1) - prior * sp) / p[2], su / u[2]
        else:  # the negative part has gone below zero: step against it
            dp, du = prior * sp / p[2], -su / u[2]
        (a, c), (d, e) = back(p, dp), back(u, du)
        step, bias = a + d + l2 * w, c + e
        step[0] = 0
        gw += step * step
        gb += bias * bias
        w = np.maximum(w - rate * step / np.sqrt(gw), floor)
        b -= rate * bias / np.sqrt(gb)
    return w, b


Instances = tuple[np.ndarray, np.ndarray, int]


def _part(x: Instances, keep: np.ndarray) -> Instances:
    """The sentences that ``keep`` marks."""
    new, at = np.cumsum(keep) - 1, keep[x[1]]
    return x[0][at], new[x[1][at]], int(keep.sum())


def _logits(x: Instances, model: tuple[np.ndarray, float]) -> np.ndarray:
    return np.bincount(x[1], model[0][x[0]].sum(1), x[2]) + model[1]


def _highest(z: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Each text's highest sentence, by text number; -inf for texts without one."""
    top = np.full(int(doc.max()) + 1, -np.inf)
    np.maximum.at(top, doc, z)
    return top


def _balance(p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float]:
    """(F1, threshold) at the best threshold of held-out scores of confirmed (``p``) and unlabelled (``u``) texts: recall is the
    share of ``p`` over it, precision the prior times recall over the share of ``u`` over it."""
    at = np.unique(np.concatenate([p, u]))
    recall = 1 - np.searchsorted(np.sort(p), at) / len(p)
    flagged = 1 - np.searchsorted(np.sort(u), at) / len(u)
    gain = 2 * prior * recall / (prior + np.maximum(flagged, prior * recall))
    # F1 is flat below its top where hardly any score lies, and the prior is an estimate: of the thresholds from there down
    # that are nearly as good, the middle of the widest gap between scores, where least depends on either
    top, gap = int(np.argmax(gain)), np.diff(at, prepend=at[0])
    best = int(np.argmax(np.where((gain >= NEAR * gain[top]) & (np.arange(len(at)) <= top), gap, -1)))
    return float(gain[top]), float(at[best] - gap[best] / 2)


SLACKS = (1.0, 1.5, 2.0, 3.0)
FOLDS = 3
NEAR = 0.97  # of the best F1
HITS = (0.4, 0.5, 0.6, 0.7)  # shares of the confirmed texts over the scores at which the prior is estimated


def train(positive: list[str], unlabelled: list[str], prior: float = 0.03, epochs: int = 60, rate: float = 0.3, l2: float = 1e-6, floor: float = -0.2, slacks: tuple[float, ...] = SLACKS) -> Model:
    """A model from confirmed and unlabelled texts. Without confirmed texts every score is near 0.

    Sentences, the prior and the threshold are judged across folds, each by a model of the others, so none rests on
    scores of the texts that were fitted. The fit takes a multiple of the estimated prior (too small a prior in the risk
    loses toxic texts, too large a one takes harmless ones along); which of ``slacks`` and which threshold is decided by the
    estimated F1 of held-out texts; the model is the mean of the fits to the folds. Of the priors estimated at each multiple the two least count, as whatever is flagged
    wrongly adds to an estimate.
    """
    make = Features()

    def instances(texts: list[str]) -> tuple[Instances, np.ndarray]:
        features, starts, doc = make(pa.array(texts, pa.string()))
        of = np.zeros(len(features), np.int64)
        of[starts] = 1
        return (features, np.cumsum(of) - 1, len(starts)), doc

    if not positive or not unlabelled:
        return Model(np.zeros(DIMENSIONS), -10.0, 0.0)
    p, p_doc = instances(positive)
    u, u_doc = instances(unlabelled)
    if not p[2] or not u[2]:
        return Model(np.zeros(DIMENSIONS), -10.0, 0.0)
    per_text = u[2] / len(np.unique(u_doc))
    # only features that occur are fitted; 0 stays none
    occur, place = np.unique(np.concatenate([[0], p[0].ravel(), u[0].ravel()]), return_inverse=True)
    cut = 1 + p[0].size
    p, u = (place[1:cut].reshape(-1, 4), *p[1:]), (place[cut:].reshape(-1, 4), *u[1:])

    def held_out(weight: float, folds: int = FOLDS) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, float]]]:
        """Scores of all sentences, by fits to the kept sentences of the other folds, and these fits."""
        zp, zu, fits = np.zeros(p[2]), np.zeros(u[2]), []
        for fold in range(folds):
            other, mine = (p_doc % folds == fold, u_doc % folds == fold), (p_doc % folds != fold, u_doc % folds != fold)
            if not all(x.any() for x in (mine[0] & keep, mine[1], *other)):
                continue
            model = _fit(_part(p, mine[0] & keep), _part(u, mine[1]), weight / per_text, epochs, rate, l2, floor, len(occur))
            zp[other[0]], zu[other[1]] = _logits(_part(p, other[0]), model), _logits(_part(u, other[1]), model)
            fits.append(model)
        return zp, zu, fits

    def tops(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _highest(zp, p_doc)[np.unique(p_doc)], _highest(zu, u_doc)[np.unique(u_doc)]

    def share(top_p: np.ndarray, top_u: np.ndarray) -> float:
        at = np.quantile(top_p, 1 - np.array(HITS))
        over_u, over_p = (np.mean(z[:, None] >= at, axis=0) for z in (top_u, top_p))
        return float(np.clip(np.mean(over_u / over_p), 0.001, 0.3))

    keep = np.ones(p[2], bool)
    zp, zu, _ = held_out(max(slacks) * prior, 2)
    prior = share(*tops(zp, zu))
    # the highest sentence of each confirmed text; texts labelled wrongly have none that stands out
    told = (zp == _highest(zp, p_doc)[p_doc]) & (zp > np.quantile(zu, 1 - min(0.2, 3 * prior / per_text)))
    if told.sum() >= 4:
        keep = told
    tried = [held_out(slack * prior) for slack in slacks]
    judged = [tops(zp, zu) for zp, zu, _ in tried]
    prior = float(np.mean(sorted(share(*tp) for tp in judged)[:2]))
    best = max(range(len(slacks)), key=lambda i: _balance(*judged[i], prior)[0])
    # the mean of the folds' fits, whose scores are of the scale the threshold was found on; one fit to all if there is no fold
    fits = tried[best][2] or [_fit(_part(p, keep), u, slacks[best] * prior / per_text, epochs, rate, l2, floor, len(occur))]
    fitted, b = np.mean([f[0] for f in fits], axis=0), float(np.mean([f[1] for f in fits]))
    w = np.zeros(DIMENSIONS)
    w[occur] = fitted
    # a text without any known feature scores the bias, which must stay below the threshold
    return Model(w, b - max(_balance(*judged[best], prior)[1], b + 1), prior)


_HELD: dict[int, Model] = {}


def trained(positive: list[str], unlabelled: list[str]) -> Model:
    """``train``; the last models are held by a hash of what they were fitted to, as several queries need the same one."""
    h = xxhash.xxh3_64()
    for texts in (positive, unlabelled):
        h.update(f"\0{len(texts)}\0".encode())
        for t in texts:
            h.update(t.encode("utf-8", "replace") + b"\0")
    key = h.intdigest()
    if key not in _HELD:
        while len(_HELD) > 3:
            _HELD.pop(next(iter(_HELD)))
        _HELD[key] = train(positive, unlabelled)
    return _HELD[key]


def sample(texts: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str) -> tuple[list[str], list[str]]:
    """(confirmed, unlabelled) texts of the bounded sample, from one scan.

    Confirmed keys are the ``MAX_POSITIVE`` of least hash; unlabelled rows those whose hash is under a limit set by
    the number of rows. Only the bounded list of keys is broadcast.
    """
    picked = labels.filter((F.col(label) == 1) & F.col(label_key).isNotNull()).select(F.col(label_key).alias("k"), F.xxhash64(label_key).alias("h"))
    picked = picked.distinct().orderBy("h", "k").limit(MAX_POSITIVE).select("k", F.lit(True).alias("confirmed"))
    rows = texts.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").cast("string").alias("t")).filter(F.col("k").isNotNull() & (F.length("t") > 0))
    share = min(1.0, MAX_UNLABELLED / max(1, texts.count()))
    lucky = F.pmod(F.xxhash64("k", F.lit(7)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    got = rows.join(F.broadcast(picked), "k", "left").filter(F.col("confirmed") | lucky).select("k", "t", "confirmed").dropDuplicates(["k"]).collect()
    got.sort(key=lambda r: r["k"])
    return [r["t"] for r in got if r["confirmed"]], [r["t"] for r in got if not r["confirmed"]]


def score(texts: DataFrame, columns: list[str], text: str, model: Model) -> DataFrame:
    """``columns`` and ``score`` of every row. The model, two megabytes at most, goes along as a broadcast value."""
    sent = texts.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.prior))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, make = Model(*sent.value), Features()
        for batch in batches:
            last = batch.num_columns - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(mine.scores(batch.column(last), make), pa.float64())], [*columns, "score"])

    schema = ", ".join(f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in columns)
    return spread(texts.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{text}`").cast("string").alias("__text"))).mapInArrow(scan, f"{schema}, score double")
