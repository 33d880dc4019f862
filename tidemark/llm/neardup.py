"""Near-duplicate texts with small edits, insertions or reordering.

Two texts are linked if they share at least ``share`` of the distinct words of the smaller one. Candidates come from
token-combination prefixes. Words are put into classes by document frequency: a word in at most ``ONE`` texts is of class 1,
any other of the least class k for which k independent words as frequent would meet by chance in ``POSTING`` texts. Of a
class-k part of its prefix a text indexes all k-word combinations: single words where they are rare, combinations where they
are frequent. A text's prefix is extended, from rare to frequent, until it holds enough words that the allowed number of
differing words can't spoil every combination (a part of c words survives c - k differing ones), or until the last class
(the one that words in a share ``REACH`` of all texts are in, so that the same words are indexed at any size of the collection;
``exhaustive=True`` goes on through all classes at a higher cost of the index). Candidate
pairs that the bitmaps of their words don't rule out are verified on the word sets.

Which links are found. Of a text whose prefix reaches that bound, all, whatever the differing words are. Texts whose prefix
doesn't reach it (all texts made of a few hundred frequent words) have those links that any combination of their prefix
survives, which the worst choice of differing words could prevent. So these texts are compared with each other on bitmaps, by
a bound that no link fails, and all links are found; the index is then made of the signatures that some text with a
certificate has, as all other pairs are compared anyway. A text is compared with ``GROUPED`` others of like words at once, with
all groups of a side in bit-sliced sums. That takes about a nanosecond a pair but
grows with the square of the number of such texts; ``complete=False`` leaves it out, for collections of such texts that can't
afford it, and then the index alone decides.

A class's words are spread over slots by a hash, about ``group`` of a text's words in each, to bound the combinations; words
combine within their slot. Words of a stock phrase come together, so that their combinations would be as frequent as the phrase;
of such words in more than ``PHRASE`` of all texts (told by least document hashes) only one is used. A phrase that makes up half
of a text or more, as the template of a page does, is indexed by itself.

Texts with the same word set are one class: copies met in one task are indexed once, and pairs of classes are
expanded by membership where single pairs are wanted. Texts of fewer than ``least`` distinct words, null and empty ones
have no link. Texts are cut into words once; what follows works on 64-bit hashes of words, which are taken for the words. Classes
go to the executors as one byte for each of ``BUCKETS`` buckets of word hashes, of a fixed size; words that share a bucket count
together, which can only put a word into a wider class. Besides, at most average length / ``PHRASE`` words are sent.
A posting list longer than ``BLOCK`` is compared block by block in several tasks.
"""

import re
from collections.abc import Iterable, Iterator
from itertools import combinations, islice
from math import ceil, comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranges import range_number
from tidemark.session import cut_lineage, spread

SHARE, LEAST = 0.75, 60
POSTING = 0.2
ONE = 8  # texts a word of class 1 is in at most
REACH = 0.1  # share of texts up to which words are indexed
GROUP = 3.5  # mean number of a text's words of a class in one slot
PHRASE = 1e-3  # share of texts over which words that come together are told
BUCKETS = 1 << 21
BLOCK = 200  # posting lists up to this length are paired as they are
SIDE = 1000  # texts in one side of a block of a longer list
CELL = 1 << 19  # texts in one side of a cell of the bitmap comparison
GROUPED = 8  # texts of one side that are compared as one, before each by itself
TILE = 1 << 10  # 64-bit words of groups, and all such words, that are summed at once
WORK = 1 << 18
OWN = 832  # most frequent words, each with a bit of its own in a sketch
CERTIFIED = 1 << 22  # buckets of signatures by which those of texts with a certificate are told
PIECE = 1 << 18  # combinations made at once

_WORD = re.compile(r"[^\W_]+")


def word_set(text: str | None) -> list[str]:
    """Distinct maximal runs of letters and digits of the lower-cased text."""
    return sorted(set(_WORD.findall(text.lower()))) if text else []


def needed(share: float, size: int) -> int:
    """Least overlap that links a text of ``size`` words with a larger one."""
    return ceil(share * size - 1e-9)


SKIPPED = 255  # class of words that are left out
MINIMA = 4  # hashes by which words that come together are told


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def followers(rows: Iterable[tuple[int, int, tuple[int, ...]]]) -> dict[int, int]:
    """Words, with the word each follows, whose documents are nearly those of another word, as the words of one stock phrase are: their
    combinations would be as frequent as the phrase. Of (word, count, least document hashes), words that agree in all
    but one of the least hashes and in count within a fifth follow the first of them."""
    out: dict[int, int] = {}
    first: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for word, n, low in sorted(rows, key=lambda r: (-r[1], r[0])):
        keys = [(skip, *low[:skip], *low[skip + 1 :]) for skip in range(len(low))]
        lead = next((w for k in keys for m, w in first.get(k, ()) if m * 0.8 <= n), None)
        if lead is not None:
            out[word] = lead
            continue
        for k in keys:
            first.setdefault(k, []).append((n, word))
    return out


def _picks(c: int, k: int) -> Iterator[np.ndarray]:
    """All k-subsets of c places, a piece at a time."""
    held = combinations(range(c), k)
    while part := list(islice(held, PIECE // max(1, k))):
        yield np.array(part, np.int64)


class Classes:
    """Class and slot of every word, and the prefixes and signatures of texts by them."""

    def __init__(self, table: np.ndarray, slots: np.ndarray, skipped: np.ndarray, leads: np.ndarray, share: float, least: int, widest: int, own: np.ndarray = np.zeros(0, np.uint64)):
        order = np.argsort(skipped)
        self.rank = np.argsort(own)
        self.own = own[self.rank]
        self.table, self.slots, self.skipped, self.leads, self.widest = table, slots, skipped[order], leads[order], widest
        self.tau_from = needed(share, least)
        self.rows: dict[tuple[int, int], np.ndarray] = {}

    def follow(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words follow another, and which word each of those follows."""
        at = np.minimum(np.searchsorted(self.skipped, words), len(self.skipped) - 1)
        hit = self.skipped[at] == words
        return hit, self.leads[at[hit]]

    def bits(self, words: np.ndarray) -> np.ndarray:
        """Bit of each word in a sketch: the most frequent words have one each, all others share the rest."""
        hashed = _mix(words)
        if not len(self.own):
            return (hashed % np.uint64(64 * BITS)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.own, words), len(self.own) - 1)
        place = np.where(self.own[at] == words, self.rank[at], OWN + (hashed % np.uint64(64 * BITS - OWN)).astype(np.int64))
        return place * 389 % (64 * BITS)  # frequent words spread evenly

    def phrases(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leading word, text) of every phrase that makes up half of a text's words or more."""
        hit, lead = self.follow(words)
        of = np.repeat(np.arange(len(sizes)), sizes)[hit]
        pairs, count = np.unique(np.stack([of.astype(np.uint64), lead]), axis=1, return_counts=True)
        long = 2 * (count + 1) >= sizes[pairs[0].astype(np.int64)]
        return pairs[1][long], pairs[0][long].astype(np.int64)

    def parts(self, words: np.ndarray, sizes: np.ndarray):
        """Of texts laid end to end: words in prefix order, and of every part that combines its text, class, slot, first word
        and length; last, which texts' prefixes reach the bound."""
        doc = np.repeat(np.arange(len(sizes)), sizes)
        k = self.table[(words % np.uint64(BUCKETS)).astype(np.int64)].astype(np.int64)
        if len(self.skipped):
            k[self.follow(words)[0]] = SKIPPED
        slot = ((words >> np.uint64(32)) % self.slots[k].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((words, slot, k, doc))
        words, doc, k, slot = words[order], doc[order], k[order], slot[order]
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (k[1:] != k[:-1]) | (slot[1:] != slot[:-1])]) if len(doc) else np.zeros(0, np.int64)
        c = np.diff(np.r_[new, len(doc)])
        of, kind, place = doc[new], k[new], slot[new]
        units = np.where((kind <= self.widest) & (c >= kind), c - kind + 1, 0)
        want = sizes - self.tau_from + 1  # differing words that can be, and one
        total = np.cumsum(units)
        before = np.concatenate([[0], total])[np.searchsorted(of, np.arange(len(sizes)))] if len(of) else np.zeros(len(sizes), np.int64)
        have = total - units - before[of] if len(of) else total
        used = (units > 0) & (have < want[of])
        length = np.minimum(c, kind - 1 + want[of] - have)
        reached = np.zeros(len(sizes), bool)
        if len(of):
            reached[of[used & (have + units >= want[of])]] = True
        return words, of[used], kind[used], place[used], new[used], length[used], reached

    def signatures(self, words: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(signatures, texts): hashed combinations of the prefixes, and the leading words of long phrases."""
        if len(self.skipped):
            lead, of = self.phrases(words, sizes)
            yield _mix(lead ^ np.uint64(0x5851F42D4C957F2D)), of
        words, of, kind, place, first, length, _ = self.parts(words, sizes)
        hashed = _mix(words)
        shapes = length * 64 + kind
        for shape in np.unique(shapes):
            c, k = divmod(int(shape), 64)
            mine = np.flatnonzero(shapes == shape)
            tag = (kind[mine] * 1_000_003 + place[mine]).astype(np.uint64)[:, None]
            if comb(c, k) <= PIECE:
                if (c, k) not in self.rows:
                    self.rows[c, k] = np.array(list(combinations(range(c), k)), np.int64).reshape(-1, k)
                pieces: Iterable[np.ndarray] = (self.rows[c, k],)
            else:  # a very long text: the same in pieces
                pieces = _picks(c, k)
            for pick in pieces:
                step = max(1, PIECE // len(pick))
                for i in range(0, len(mine), step):
                    at = mine[i : i + step]
                    h = hashed[first[at][:, None] + np.arange(c)]
                    yield _mix(h[:, pick].sum(2) ^ tag[i : i + step]).ravel(), np.repeat(of[at], len(pick))


def _long_enough(df: DataFrame, key: str, text: str, least: int) -> DataFrame:
    t = F.col(f"`{text}`").cast("string")
    return spread(df.select(F.col(f"`{key}`").alias("key"), t.alias("text")).filter(F.col("key").isNotNull() & (F.length("text") >= 2 * least - 1)))


def word_sets(df: DataFrame, key: str, text: str, least: int = LEAST) -> DataFrame:
    """(key, doc, words): of every text that can have links its word-set class and, where the class is met first in a task, the
    sorted hashes of its words; null where it was met before."""
    kind = df.schema[key].dataType.simpleString()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        seen: set[int] = set()
        for b in batches:
            at, docs, sets = [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                words = set(_WORD.findall(text.lower()))
                if len(words) < least:
                    continue
                if len(known) > 1 << 20:
                    known.clear()
                hashes = []
                for w in words:
                    h = known.get(w)
                    if h is None:
                        h = known[w] = xxhash.xxh64_intdigest(w)
                    hashes.append(h)
                packed = np.sort(np.array(hashes, np.uint64)).tobytes()
                doc = xxhash.xxh64_intdigest(packed)
                at.append(i)
                docs.append(doc)
                sets.append(None if doc in seen else packed)
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(doc)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), _signed(np.array(docs, np.uint64)), pa.array(sets, pa.binary())], ["key", "doc", "words"])

    return _long_enough(df, key, text, least).mapInArrow(scan, f"key {kind}, doc bigint, words binary")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, sizes) of a column of packed sets."""
    sets = column.to_pylist()
    return np.frombuffer(b"".join(sets), np.uint64), np.array([len(x) // 8 for x in sets], np.int64)


def _word_counts(uniq: DataFrame) -> DataFrame:
    """(word, n, m0..m3): texts and least document hashes of every word, combined map-side over a task's batches."""
    names = [f"m{q}" for q in range(MINIMA)]

    def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        words, n, *low = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(words, kind="stable")
        words = words[order]
        first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
        return words[first], np.add.reduceat(n[order], first), *(np.minimum.reduceat(x[order], first) for x in low)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for b in batches:
            words, sizes = _flat(b.column(1))
            if not len(words):
                continue
            of = np.repeat(b.column(0).to_numpy().view(np.uint64), sizes)
            low = [_mix(of ^ np.uint64(0xA0761D6478BD642F * (q + 1) % (1 << 64))).view(np.int64) for q in range(MINIMA)]
            held.append(merged([(words, np.ones(len(words), np.int64), *low)]))
            if sum(len(x[0]) for x in held) > 1_000_000:
                held = [merged(held)]
                if len(held[0][0]) > 500_000:
                    yield pa.RecordBatch.from_arrays([_signed(held[0][0]), *map(pa.array, held[0][1:])], ["word", "n", *names])
                    held = []
        if held:
            whole = merged(held)
            yield pa.RecordBatch.from_arrays([_signed(whole[0]), *map(pa.array, whole[1:])], ["word", "n", *names])

    counted = uniq.select("doc", "words").mapInArrow(scan, "word bigint, n bigint, " + ", ".join(f"{m} bigint" for m in names))
    return counted.groupBy("word").agg(F.sum("n").alias("n"), *[F.min(m).alias(m) for m in names])


def _classes(uniq: DataFrame, share: float, least: int, exhaustive: bool, posting: float, group: float) -> Classes:
    """Classes from the document frequencies of all texts."""
    counts = cut_lineage(_word_counts(uniq))
    texts = max(2, uniq.count())
    bound = np.array([0.0, 0.0] + [min(1.0, (posting / texts) ** (1 / k)) for k in range(2, 41)])
    common = counts.filter(F.col("n") > PHRASE * texts).filter(F.col("n") > ONE).collect()
    follow = followers((r["word"], r["n"], tuple(r[f"m{q}"] for q in range(MINIMA))) for r in common if r["n"] / texts > bound[2])
    bucket = F.col("word").bitwiseAND(F.lit(BUCKETS - 1)).cast("int")  # BUCKETS is a power of two
    held = counts.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).filter(F.col("n") > ONE).toArrow()
    own = np.array([r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(OWN).collect()], np.int64).view(np.uint64)
    b, n = held.column("b").to_numpy(), held.column("n").to_numpy()
    table = np.ones(BUCKETS, np.uint8)
    kinds = np.minimum(2 + np.searchsorted(bound[2:], n / texts - 1e-12), 40)
    table[b] = kinds
    widths = np.bincount(kinds, weights=n / texts, minlength=256) if len(n) else np.zeros(256)
    slots = np.maximum(1, np.round(widths / group)).astype(np.int64)
    return Classes(table, slots, np.array(list(follow), np.int64).view(np.uint64), np.array(list(follow.values()), np.int64).view(np.uint64), share, least, 40 if exhaustive else int(2 + np.searchsorted(bound[2:], min(REACH, bound[-1]))), own)


def _certified(uniq: DataFrame, sent) -> np.ndarray:
    """Which buckets of signatures hold one of a text whose prefix reaches the bound."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = sent.value
        found = np.zeros(CERTIFIED, bool)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                words, sizes = _flat(whole.column(0).slice(at, 1000))
                reached = classes.parts(words, sizes)[-1]
                if reached.any():
                    for sigs, _ in classes.signatures(words[np.repeat(reached, sizes)], sizes[reached]):
                        found[(sigs % np.uint64(CERTIFIED)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(found).astype(np.int32))], ["b"])

    out = np.zeros(CERTIFIED, bool)
    out[uniq.select("words").mapInArrow(scan, "b int").distinct().toArrow().column("b").to_numpy()] = True
    return out


def _signature_rows(uniq: DataFrame, sent, kept=None) -> DataFrame:
    """(sig, doc) of every word-set class; of the signatures in ``kept`` buckets (packed bits) if these are given."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = sent.value
        wanted = None if kept is None else np.unpackbits(kept.value).astype(bool)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                words, sizes = _flat(b.column(1))
                docs = b.column(0).to_numpy()
                for sigs, of in classes.signatures(words, sizes):
                    if wanted is not None:
                        some = wanted[(sigs % np.uint64(CERTIFIED)).astype(np.int64)]
                        sigs, of = sigs[some], of[some]
                    if len(sigs):
                        yield pa.RecordBatch.from_arrays([_signed(sigs), pa.array(docs[of])], ["sig", "doc"])

    return uniq.select("doc", "words").mapInArrow(scan, "sig bigint, doc bigint")


def _pairs_of_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the docs of each signature, from rows sorted by (sig, doc). A run longer than BLOCK comes out as rows
    with its length instead, to be compared block by block elsewhere."""
    names = ["a", "b", "sig", "size"]

    def out(sig: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
        new = np.r_[True, (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])] if len(sig) else np.zeros(0, bool)
        sig, doc = sig[new], doc[new]
        start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
        size = np.diff(np.r_[start, len(sig)])
        of = np.repeat(size, size)
        at = np.arange(len(sig)) - np.repeat(start, size)
        left, right = [], []
        few = (of > 1) & (of <= BLOCK)
        for d in range(1, min(BLOCK, int(of[few].max()) if few.any() else 1)):
            i = np.flatnonzero(few & (at + d < of))
            left.append(doc[i])
            right.append(doc[i + d])
        if left:
            both = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1), axis=0)
            n = len(both)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
        many = of > BLOCK
        if many.any():
            n = int(many.sum())
            yield pa.RecordBatch.from_arrays([pa.array(doc[many]), pa.nulls(n, pa.int64()), pa.array(sig[many]), pa.array(of[many])], names)

    sig, doc = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for b in batches:
        sig = np.concatenate([sig, b.column(0).to_numpy(zero_copy_only=False)])
        doc = np.concatenate([doc, b.column(1).to_numpy(zero_copy_only=False)])
        if len(sig) < 100_000:
            continue
        # the last run may go on in the next batch
        last = int(np.searchsorted(sig, sig[-1]))
        if last:
            yield from out(sig[:last], doc[:last])
            sig, doc = sig[last:], doc[last:]
    yield from out(sig, doc)


BITS = 16  # words of 64 bits in a sketch
FOLD = 4  # and in its first, coarser form


def _sketches(uniq: DataFrame, sent) -> DataFrame:
    """(doc, n, reached, s0..s15) of every word-set class: number of words, whether its prefix reaches the bound, and a
    bitmap of hashed words that bounds overlaps from above."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                words, sizes = _flat(b.column(1))
                bits = np.zeros((len(sizes), 64 * BITS), np.uint8)
                bits[np.repeat(np.arange(len(sizes)), sizes), classes.bits(words)] = 1
                table = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
                reached = classes.parts(words, sizes)[-1]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes.astype(np.int32)), pa.array(reached), *(_signed(np.ascontiguousarray(table[:, i])) for i in range(BITS))], ["doc", "n", "reached", *(f"s{i}" for i in range(BITS))])

    schema = "doc bigint, n int, reached boolean, " + ", ".join(f"s{i} bigint" for i in range(BITS))
    return uniq.select("doc", "words").mapInArrow(scan, schema).dropDuplicates(["doc"])


def _near(x: np.ndarray, y: np.ndarray | None, nx: np.ndarray, ny: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of sketches (a row per 64 bits) that may be linked; without ``y``, pairs within ``x``.

    A linked pair's smaller text lacks at most n - share * n of its words in the other, so at most as many of its bits."""
    own = y is None
    y, ny = (x, nx) if own else (y, ny)
    fx, fy = (np.ascontiguousarray(np.bitwise_or.reduce(z.reshape(-1, FOLD, z.shape[1]), 0)) for z in (x, y))
    for f in (fx, fy):
        f[0] &= ~np.uint64(1)  # 255 bits, to be counted in a byte
    spare_x, spare_y = (n - np.ceil(share * n - 1e-9).astype(np.int64) for n in (nx, ny))
    # the least of the two bounds, so that it holds whichever text is the smaller one
    low_x, low_y = (np.maximum(np.bitwise_count(f).sum(0, dtype=np.int64) - s, 0).astype(np.uint8) for f, s in ((fx, spare_x), (fy, spare_y)))
    all_x, all_y = (np.bitwise_count(z).sum(0, dtype=np.int64) - s for z, s in ((x, spare_x), (y, spare_y)))
    high, wide = 16, 4096
    common, count, more, low = (np.empty((high, wide), t) for t in (np.uint64, np.uint8, np.uint8, np.uint8))
    for i in range(0, x.shape[1], high):
        a, lows = fx[:, i : i + high], low_x[i : i + high, None]
        for j in range(i // wide * wide if own else 0, y.shape[1], wide):
            b = fy[:, j : j + wide]
            at = slice(a.shape[1]), slice(b.shape[1])
            np.bitwise_count(np.bitwise_and(a[0][:, None], b[0], out=common[at]), out=count[at])
            for q in range(1, FOLD):
                np.bitwise_count(np.bitwise_and(a[q][:, None], b[q], out=common[at]), out=more[at])
                np.add(count[at], more[at], out=count[at])
            p, q = np.divmod(np.flatnonzero(count[at] >= np.minimum(lows, low_y[j : j + wide], out=low[at])), b.shape[1])
            p, q = p + i, q + j
            if own:
                p, q = p[p < q], q[p < q]
            if len(p):
                shared = np.bitwise_count(x[:, p] & y[:, q]).sum(0, dtype=np.int64)
                small = nx[p] <= ny[q]
                keep = np.where(small, shared >= all_x[p], shared >= all_y[q]) | ((nx[p] == ny[q]) & (shared >= all_y[q]))
                if keep.any():
                    yield p[keep], q[keep]


def _likeness(s: np.ndarray) -> np.ndarray:
    """A number for each sketch (a row per text) by which texts of like words come together: its bits that fewer than half of
    the texts have, the most frequent first."""
    held = np.zeros(64 * BITS, np.int64)
    for i in range(0, len(s), 1 << 14):
        held += np.unpackbits(s[i : i + (1 << 14)].view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    key = np.zeros(len(s), np.uint64)
    for bit in [b for b in np.argsort(-held, kind="stable") if 2 * held[b] <= len(s)][:40]:
        key = (key << np.uint64(1)) | (s[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)
    return key


def _over(rows: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Bit-sliced sums: of ``rows`` (row, text, word of 64 groups), which bits are set in more than ``limit`` (by text) rows.
    ``rows`` are used up. The sum starts at a power of two less limit and one, so that more than the limit carries over."""
    top = max(1, int(limit.max() + 1).bit_length())
    start = (1 << top) - (limit + 1)
    if len(rows) + int(start.max()) < 1 << top:
        return np.zeros(rows.shape[1:], np.uint64)
    carry, other = (np.empty((len(rows) // 2 + 2, *rows.shape[1:]), np.uint64) for _ in range(2))
    odd = np.empty((len(rows) // 3 + 1, *rows.shape[1:]), np.uint64)
    level = rows
    for i in range(top):
        one = (np.uint64(0) - (start >> i & 1).astype(np.uint64))[:, None]
        n = 1
        if len(level) > 1:
            a, b, u = level[0], level[1], odd[0]
            np.bitwise_xor(a, b, out=u)
            np.bitwise_or(a & b, u & one, out=carry[0])
            np.bitwise_xor(u, one, out=b)
            level = level[1:]
        else:
            np.bitwise_and(level[0], one, out=carry[0])
        while len(level) > 2:  # three rows of a weight make one, and one of twice the weight
            h = len(level) // 3
            a, b, c, u, up = level[:h], level[h : 2 * h], level[2 * h : 3 * h], odd[:h], carry[n : n + h]
            np.bitwise_and(a, b, out=up)
            np.bitwise_xor(a, b, out=u)
            np.bitwise_xor(u, c, out=a)
            np.bitwise_and(u, c, out=u)
            np.bitwise_or(up, u, out=up)
            n += h
            rest = len(level) - 3 * h
            level[h : h + rest] = level[3 * h :]
            level = level[: h + rest]
        if len(level) == 2:
            np.bitwise_and(level[0], level[1], out=carry[n])
            n += 1
        level, carry, other = carry[:n], other, carry
    return np.bitwise_or.reduce(level, 0)


def _ones(s: np.ndarray) -> np.ndarray:
    """Bits set in each row of sketches: counts of bytes, then of lanes of 16 bits, that can't run over."""
    counts = np.bitwise_count(s).view(np.uint64)
    both = counts[:, 0] + counts[:, 1]
    lanes = np.uint64(0x00FF00FF00FF00FF)
    both = (both & lanes) + (both >> np.uint64(8) & lanes)
    return (both * np.uint64(0x0001000100010001) >> np.uint64(48)).astype(np.int64)


def _grouped(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of sketches (a row per text) that may be linked, a text of ``x`` being the smaller or of equal size.

    It lacks at most n - share * n of its words in the other, so at most as many of its bits in the union of a group that holds
    the other. Its bits that fewest groups have are counted for all groups at once; what is left is compared with halves of groups
    and then with texts."""
    if not len(x) or not len(y):
        return
    spare, full = nx - np.ceil(share * nx - 1e-9).astype(np.int64), _ones(x)
    order = np.argsort(_likeness(y), kind="stable")
    more = -len(y) % (64 * GROUPED)
    y, ny = np.concatenate([y[order], np.zeros((more, BITS), np.uint64)]), np.concatenate([ny[order], np.full(more, -1)])
    groups, half = len(y) // GROUPED, GROUPED // 2
    halves = np.bitwise_or.reduce(y.reshape(-1, half, BITS), 1)
    whole = np.bitwise_or.reduce(halves.reshape(-1, 2, BITS), 1)
    lacks = np.zeros((64 * BITS + 1, groups // 64), np.uint64)  # a row per bit, of the groups without it
    for i in range(0, groups, 8192):
        bits = np.unpackbits(whole[i : i + 8192].view(np.uint8), axis=1, bitorder="little")
        lacks[:-1, i // 64 : i // 64 + len(bits) // 64] = ~np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
    rare = np.argsort(-np.bitwise_count(lacks[:-1]).sum(1, dtype=np.int64), kind="stable")
    lacks[:-1] = lacks[rare]
    tile = min(lacks.shape[1], TILE)
    by_size = np.argsort(nx, kind="stable")
    at = 0
    while at < len(x):
        mine = by_size[at : at + max(1, WORK // (tile * (8 + 3 * int(spare[by_size[at]]))))]
        at += len(mine)
        bits = np.unpackbits(x[mine].view(np.uint8), axis=1, bitorder="little")[:, rare]
        of, bit = np.nonzero(bits.view(bool))
        nth = np.arange(len(of)) - np.searchsorted(of, np.arange(len(mine)))[of]
        used = nth < 8 + 3 * int(spare[mine].max())
        rows = np.full((int(nth[used].max(initial=0)) + 1, len(mine)), 64 * BITS)
        rows[nth[used], of[used]] = bit[used]
        for j in range(0, lacks.shape[1], tile):
            near = ~_over(lacks[:, j : j + tile][rows], spare[mine])
            left = np.bitwise_count(near).sum(dtype=np.int64)
            if 4 * left > near.size * 64:  # groups rule out little here
                part = slice(j * 64 * GROUPED, (j + tile) * 64 * GROUPED)
                for p, q in _near(np.ascontiguousarray(x[mine].T), np.ascontiguousarray(y[part].T), nx[mine], ny[part], share):
                    keep = nx[mine][p] <= ny[part][q]
                    yield mine[p[keep]], order[q[keep] + part.start]
                continue
            eights = near.view(np.uint8).ravel()
            some = np.flatnonzero(eights.astype(bool))
            set_bits = np.flatnonzero(np.unpackbits(eights[some], bitorder="little").view(bool))
            text, group = np.divmod(some[set_bits >> 3] * 8 + (set_bits & 7), near.shape[1] * 64)
            text, group = mine[text], group + j * 64
            for i in range(0, len(text), 1 << 11):
                p, q = text[i : i + (1 << 11)], group[i : i + (1 << 11)]
                for size, table in ((2, halves), (half, y)):
                    p, q = np.repeat(p, size), (q[:, None] * size + np.arange(size)).ravel()
                    common = x.take(p, 0)
                    common &= table.take(q, 0)
                    keep = full[p] - _ones(common) <= spare[p]
                    p, q = p[keep], q[keep]
                keep = nx[p] <= ny[q]
                if keep.any():
                    yield p[keep], order[q[keep]]


def _compared(sketch: DataFrame, texts: int, share: float) -> DataFrame:
    """(a, b), a < b: pairs of all of ``sketch`` that its bitmaps don't rule out. Texts go by size to sides of about CELL
    texts at most, and each pair of sides is one task."""
    cores = sketch.sparkSession.sparkContext.defaultParallelism
    m = max(1, ceil(texts / CELL))
    while m * (m + 1) < 4 * cores and texts > 1000 * m:
        m += 1
    names = [f"s{i}" for i in range(BITS)]
    sides = sketch.select("doc", "n", *names).withColumn("at", range_number(sketch, ["n", "doc"], m))
    dealt = sides.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    low, top = F.least("at", "other"), F.greatest("at", "other")
    cells = dealt.select((top * (top + 1) / 2).cast("int").alias("__low"), low.alias("__x"), (F.col("at") == low).alias("left"), (low == top).alias("own"), "doc", "n", *names)
    cells = cells.select((F.col("__low") + F.col("__x")).cast("int").alias("cell"), "left", "own", "doc", "n", *names).repartitionById(m * (m + 1) // 2, "cell")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[bool, list[tuple[np.ndarray, ...]]] = {True: [], False: []}
        own = False
        for b in batches:
            if not b.num_rows:
                continue
            own, left = b.column("own")[0].as_py(), b.column("left").to_numpy(zero_copy_only=False)
            doc, n = b.column("doc").to_numpy(), b.column("n").to_numpy().astype(np.int64)
            s = np.stack([b.column(c).to_numpy() for c in names], 1).view(np.uint64)
            for which in (True, False):
                if (left == which).any():
                    sides[which].append((doc[left == which], n[left == which], s[left == which]))
        if not sides[True] or not (own or sides[False]):
            return
        of, nx, x = (np.concatenate(z) for z in zip(*sides.pop(True)))
        to, ny, y = (of, nx, x) if own else (np.concatenate(z) for z in zip(*sides.pop(False)))
        for p, q in _grouped(x, y, nx, ny, share):
            u, v = of[p], to[q]
            other = u != v
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)[other]), pa.array(np.maximum(u, v)[other])], ["a", "b"])

    return cells.mapInArrow(compare, "a bigint, b bigint")


def _blockwise(heavy: DataFrame, sketch: DataFrame, share: float) -> DataFrame:
    """(a, b), a < b: pairs of docs that share a frequent signature and that their bitmaps don't rule out. Docs go to
    ceil(size / SIDE) blocks; each pair of blocks is compared on its own, so no list is held whole and only pairs that may be
    links come out."""
    names = [f"s{i}" for i in range(BITS)]
    blocks = F.ceil(F.col("size") / SIDE).cast("int")
    mine = heavy.select("sig", F.col("a").alias("doc"), blocks.alias("m")).withColumn("at", F.pmod(F.xxhash64("doc"), F.col("m")).cast("int"))
    dealt = mine.join(sketch.select("doc", "n", *names), "doc").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    cells = dealt.select("sig", F.least("at", "other").alias("x"), F.greatest("at", "other").alias("y"), (F.col("at") <= F.col("other")).alias("left"), "doc", "n", *names)
    cells = cells.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        s = np.ascontiguousarray(np.stack([t.column(c).to_numpy() for c in names])).view(np.uint64)
        doc, n = t.column("doc").to_numpy(), t.column("n").to_numpy().astype(np.int64)
        if t.column("x")[0].as_py() == t.column("y")[0].as_py():
            of, to, found = doc, doc, _near(s, None, n, n, share)
        else:
            left = t.column("left").to_numpy()
            of, to, found = doc[left], doc[~left], _near(np.ascontiguousarray(s[:, left]), np.ascontiguousarray(s[:, ~left]), n[left], n[~left], share)
        for p, q in found:
            u, v = of[p], to[q]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["a", "b"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            cell = np.stack([t.column(c).to_numpy() for c in ("sig", "x", "y")])
            cuts = np.flatnonzero(np.r_[True, (cell[:, 1:] != cell[:, :-1]).any(0)])
            for i, j in zip(cuts[:-1], cuts[1:]):
                yield from pairs(t.slice(i, j - i))
            held = t.slice(cuts[-1])
        if held is not None:
            yield from pairs(held)

    return cells.mapInArrow(compare, "a bigint, b bigint").distinct()


def _indexed(uniq: DataFrame, sent, sketch: DataFrame, share: float, kept=None) -> DataFrame:
    """(a, b), a < b: pairs that share a signature and that the bitmaps don't rule out; every link of a text that reaches
    the bound is among them, as of two texts the one whose prefix ends first has all its combinations met by the other."""
    sigs = _signature_rows(uniq, sent, kept)
    runs = sigs.repartition("sig").sortWithinPartitions("sig", "doc").mapInArrow(_pairs_of_runs, "a bigint, b bigint, sig bigint, size bigint")
    runs = cut_lineage(runs)
    candidates = runs.filter(F.col("b").isNotNull()).select("a", "b").distinct()
    heavy = _blockwise(runs.filter(F.col("b").isNull()), sketch, share)

    a = sketch.select(F.col("doc").alias("a"), F.col("n").alias("na"), *[F.col(f"s{i}").alias(f"a{i}") for i in range(BITS)])
    b = sketch.select(F.col("doc").alias("b"), F.col("n").alias("nb"), *[F.col(f"s{i}").alias(f"b{i}") for i in range(BITS)])
    both = candidates.join(a, "a").join(b, "b")

    def only(x: str, y: str):
        total = F.lit(0)
        for i in range(BITS):
            total = total + F.bit_count(F.col(f"{x}{i}").bitwiseAND(F.bitwise_not(F.col(f"{y}{i}"))))
        return total

    most = F.least(F.col("na") - only("a", "b"), F.col("nb") - only("b", "a"))
    return both.filter(most >= share * F.least("na", "nb") - 1e-9).select("a", "b").unionByName(heavy).distinct()


def class_links(sets: DataFrame, *, share: float = SHARE, least: int = LEAST, exhaustive: bool = False, complete: bool = True, posting: float = POSTING, group: float = GROUP) -> DataFrame:
    """(a, b), a < b: linked word-set classes of ``word_sets``."""
    uniq = sets.filter(F.col("words").isNotNull()).select("doc", "words")
    sent = sets.sparkSession.sparkContext.broadcast(_classes(uniq, share, least, exhaustive, posting, group))
    sketch = cut_lineage(_sketches(uniq, sent))
    if complete:
        rest = sketch.filter(~F.col("reached"))
        likely = _compared(rest, rest.count(), share)
        kept = _certified(uniq, sent)
        if kept.any():
            likely = likely.unionByName(_indexed(uniq, sent, sketch, share, sets.sparkSession.sparkContext.broadcast(np.packbits(kept))))
        likely = likely.distinct()
    else:
        likely = _indexed(uniq, sent, sketch, share)
    likely = cut_lineage(likely)

    wanted = likely.select(F.col("a").alias("doc")).unionByName(likely.select(F.col("b").alias("doc"))).distinct()
    words = uniq.join(wanted, "doc", "left_semi").dropDuplicates(["doc"])
    pairs = likely.join(words.select(F.col("doc").alias("a"), F.col("words").alias("wa")), "a").join(words.select(F.col("doc").alias("b"), F.col("words").alias("wb")), "b")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            keep = np.zeros(x.num_rows, bool)
            for i, (s, t) in enumerate(zip(x.column(2).to_pylist(), x.column(3).to_pylist())):
                u, v = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                keep[i] = len(np.intersect1d(u, v, assume_unique=True)) >= share * min(len(u), len(v)) - 1e-9
            yield pa.RecordBatch.from_arrays([x.column(0).filter(pa.array(keep)), x.column(1).filter(pa.array(keep))], ["a", "b"])

    return pairs.select("a", "b", "wa", "wb").mapInArrow(verify, "a bigint, b bigint")


def linked_pairs(df: DataFrame, key: str, text: str, **how) -> DataFrame:
    """(key_a, key_b), a < b: all linked pairs of keys, those of one word-set class among them."""
    sets = cut_lineage(word_sets(df, key, text, how.get("least", LEAST)))
    of = sets.select("key", "doc").distinct()
    a, b = of.select(F.col("key").alias("key_a"), F.col("doc").alias("a")), of.select(F.col("key").alias("key_b"), F.col("doc").alias("b"))
    between = class_links(sets, **how).join(a, "a").join(b, "b").select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b"))
    several = of.groupBy("doc").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc")
    some = of.join(several, "doc")
    within = some.select("doc", F.col("key").alias("key_a")).join(some.select("doc", F.col("key").alias("key_b")), "doc").filter(F.col("key_a") < F.col("key_b")).select("key_a", "key_b")
    return between.filter(F.col("key_a") != F.col("key_b")).unionByName(within).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component, for nodes with edges ``a``, ``b``.

    Large-star and small-star rounds: each node links its neighbours to the least one it sees, until nothing changes.
    No node gathers its neighbours; minima are combined map-side, and lineage is cut every round.
    """
    e = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    e = cut_lineage(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        # large star: neighbours above the node go to the least of its neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the node and its lower neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u")
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        e = cut_lineage(small)
        now = e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def groups(df: DataFrame, key: str, text: str, **how) -> DataFrame:
    """One row per distinct key: ``key``, ``group_id`` (least key of its group; its own if it has no link) and ``links``,
    the number of other texts it is linked with, copies counted."""
    sets = cut_lineage(word_sets(df, key, text, how.get("least", LEAST)))
    of = sets.select("key", "doc").distinct()
    links = cut_lineage(class_links(sets, **how))
    sizes = of.groupBy("doc").agg(F.count(F.lit(1)).alias("c"), F.min("key").alias("first"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    outside = both.join(sizes.select(F.col("doc").alias("b"), "c"), "b").groupBy(F.col("a").alias("doc")).agg(F.sum("c").alias("outside"))
    root = components(links).withColumnRenamed("node", "doc")
    named = sizes.join(root, "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    name = named.groupBy("root").agg(F.min("first").alias("group_id"))
    per = named.join(name, "root").join(outside, "doc", "left").select("doc", "group_id", (F.coalesce("outside", F.lit(0)) + F.col("c") - 1).alias("links"))
    placed = of.join(per, "doc").select("key", "group_id", "links")
    everyone = df.select(F.col(f"`{key}`").alias("key")).filter(F.col("key").isNotNull()).distinct()
    return everyone.join(placed, "key", "left").select("key", F.coalesce("group_id", "key").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"))
