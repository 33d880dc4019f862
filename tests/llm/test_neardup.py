import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neardup as N


def corpus(seed=0, base=25):
    rs = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for i in range(base):
        words = rs.sample(vocabulary, rs.randint(20, 30))
        out.append(words)
        for _ in range(rs.randint(0, 3)):
            copy = words[:]
            for _ in range(rs.randint(0, 7)):
                copy[rs.randrange(len(copy))] = rs.choice(vocabulary)
            out.append(copy + rs.sample(vocabulary, rs.choice([0, 0, 10])))
    return [(f"k{i:03}", " ".join(w)) for i, w in enumerate(out)]


def brute(rows, share, least):
    sets = {}
    for k, t in rows:
        if k is not None and len(N.word_set(t)) >= least:
            sets[k] = set(N.word_set(t))
    return {(a, b) for a, b in combinations(sorted(sets), 2) if len(sets[a] & sets[b]) >= share * min(len(sets[a]), len(sets[b])) - 1e-9}


@pytest.mark.parametrize("seed", [0, 1])
def test_exhaustive_equals_brute_force(spark, seed):
    rows = corpus(seed) + [("k000", None), ("zz", None), (None, "x"), ("short", "a b c")]
    df = spark.createDataFrame(rows, "key string, text string").withColumnRenamed("key", "sig")
    got = N.linked_pairs(df, "sig", "text", share=0.75, least=15, exhaustive=True, group=50).collect()
    assert len(got) == len(set(map(tuple, got))) and set(map(tuple, got)) == brute(rows, 0.75, 15)


def test_copies_blocks_and_groups(spark, monkeypatch):
    rows = corpus(3, 12)
    rows += [(f"copy{i:03}", rows[0][1].upper()) for i in range(20)]
    df = spark.createDataFrame(rows, "key string, text string")
    want = brute(rows, 0.75, 15)
    monkeypatch.setattr(N, "BLOCK", 3)
    assert set(map(tuple, N.linked_pairs(df, "key", "text", least=15, exhaustive=True, group=50).collect())) == want
    parent = {k: k for k, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in want:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    links = {k: sum(k in p for p in want) for k in parent}
    got = {r["key"]: (r["group_id"], r["links"]) for r in N.groups(df, "key", "text", least=15, exhaustive=True, group=50).collect()}
    assert got == {k: (root(k), links[k]) for k in parent}


def test_blockwise_pairs(spark, monkeypatch):
    """A long posting list in many blocks: all pairs that the bitmaps leave, each once."""
    rows = corpus(5, 30)
    sets = N.word_sets(spark.createDataFrame(rows, "key string, text string"), "key", "text", 15).filter("words is not null")
    sent = spark.sparkContext.broadcast(N._classes(sets.select("doc", "words"), 0.75, 15, False, 0.2, 3.5))
    sketch = N._sketches(sets, sent)
    n = sketch.count()
    heavy = sketch.select(F.lit(7).cast("long").alias("sig"), F.col("doc").alias("a"), F.lit(n).cast("long").alias("size"))
    heavy = heavy.unionByName(heavy.limit(5).withColumn("sig", F.lit(8).cast("long")).withColumn("size", F.lit(5).cast("long")))
    whole = {tuple(r) for r in N._blockwise(heavy, sketch, 0.75).collect()}
    monkeypatch.setattr(N, "SIDE", 9)
    split = N._blockwise(heavy, sketch, 0.75).collect()
    assert len(split) == len(whole) and {tuple(r) for r in split} == whole and len(whole) >= 20


def test_empty_and_components(spark):
    empty = spark.createDataFrame([], "key string, text string")
    assert N.linked_pairs(empty, "key", "text").collect() == [] and N.groups(empty, "key", "text").collect() == []
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (100, 102)], "a long, b long")
    got = {r["node"]: r["root"] for r in N.components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100}


def test_long_text_signatures_come_in_pieces(monkeypatch):
    monkeypatch.setattr(N, "PIECE", 5000)
    words = np.arange(700, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    c = N.Classes(np.full(N.BUCKETS, 2, np.uint8), np.ones(256, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0.75, 60, 6)
    got = list(c.signatures(words, np.array([700])))
    assert sum(len(s) for s, _ in got) == 657 * 656 // 2 == len(set(np.concatenate([s for s, _ in got]).tolist())) and max(len(s) for s, _ in got) <= 5000


def test_prefix_of_rare_and_frequent_words():
    """Single words of class 1 first, then pairs, until more words are held than may differ."""
    table = np.ones(N.BUCKETS, np.uint8)
    table[1000:2000] = 2
    c = N.Classes(table, np.ones(256, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0.75, 60, 6)
    words = np.r_[np.arange(10), np.arange(1000, 1050)].astype(np.uint64)
    sizes = np.array([60])
    _, of, kind, _, _, length, reached = c.parts(words, sizes)
    # 60 - 45 differing words and one: ten singles and six of pairs, which are seven words
    assert list(kind) == [1, 2] and list(length) == [10, 7] and reached[0]
    assert sum(len(s) for s, _ in c.signatures(words, sizes)) == 10 + 21


def varied(rs, words, n, swapped, tag):
    """``n`` variants of a text with ``swapped`` words replaced by words of their own."""
    out = []
    for i in range(n):
        new = words[:]
        for at in rs.sample(range(len(new)), swapped):
            new[at] = f"{tag}{i}x{at}"
        out.append((f"{tag}{i:03}", " ".join(new)))
    return out


def apart(base=400, seed=5):
    rs = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    return [(f"k{i:03}", " ".join(rs.sample(vocabulary, 80))) for i in range(base)]


def test_near_copies_in_own_words(spark):
    rows = apart() + varied(random.Random(1), [f"own{i}" for i in range(100)], 30, 2, "v")
    df = spark.createDataFrame(rows, "key string, text string")
    want = brute(rows, 0.75, 60)
    assert len(want) >= 435 and set(map(tuple, N.linked_pairs(df, "key", "text").collect())) == want
    assert set(map(tuple, N.linked_pairs(df, "key", "text", exhaustive=True).collect())) == want


def test_variants_of_one_text_in_a_third_of_all_rows(spark):
    rows = apart(200)
    rows += varied(random.Random(2), rows[0][1].split(), 100, 10, "v")
    df = spark.createDataFrame(rows, "key string, text string")
    want = brute(rows, 0.75, 60)
    got = N.linked_pairs(df, "key", "text").collect()
    assert len(want) > 100 and len(got) == len(want) and set(map(tuple, got)) == want


def test_class_limits_of_a_larger_input_lose_nothing(spark):
    """Links whose differing words are the rarest; class limits as of an input of 10 million times the rows."""
    rs = random.Random(4)
    rows = [(f"k{i:03}", " ".join(f"w{int(400 * rs.random() ** 2)}" for _ in range(110))) for i in range(150)]
    for i in range(30):
        words = sorted(set(rows[i][1].split()), key=lambda w: int(w[1:]))
        rows.append((f"z{i:03}", " ".join(words[: -(len(words) // 5)] + [f"n{i}x{j}" for j in range(len(words) // 5)])))
    df = spark.createDataFrame(rows, "key string, text string")
    want = brute(rows, 0.75, 60)
    assert len(want) >= 30 and set(map(tuple, N.linked_pairs(df, "key", "text", posting=0.2 / 1e7).collect())) == want


def test_bitmap_comparison_keeps_every_link(monkeypatch, spark):
    monkeypatch.setattr(N, "CELL", 40)
    rows = corpus(7, 60)
    df = spark.createDataFrame(rows, "key string, text string")
    assert set(map(tuple, N.linked_pairs(df, "key", "text", least=15, posting=1e-9).collect())) == brute(rows, 0.75, 15)


def test_pages_of_one_template(spark):
    """40 texts of 70 words of a template and 10 of their own, among 400 others: all 780 links, by the index alone too."""
    rows = apart() + [(f"t{i:03}", " ".join([f"tpl{j}" for j in range(70)] + [f"own{i}x{j}" for j in range(10)])) for i in range(40)]
    df = spark.createDataFrame(rows, "key string, text string")
    want = brute(rows, 0.75, 60)
    assert len(want) >= 780
    for how in ({}, {"exhaustive": True}, {"complete": False}):
        assert set(map(tuple, N.linked_pairs(df, "key", "text", **how).collect())) == want


def test_recall_of_the_index_alone(spark):
    rows = apart() + [r for i in range(30) for r in varied(random.Random(i), [f"s{(i * 37 + j * 11) % 900}" for j in range(100)], 3, 8, f"v{i}n")]
    df = spark.createDataFrame(rows, "key string, text string")
    want = brute(rows, 0.75, 60)
    got = set(map(tuple, N.linked_pairs(df, "key", "text", complete=False).collect()))
    assert got <= want and len(got) >= 0.9 * len(want) > 50


@pytest.mark.parametrize("density", [0.03, 0.1, 0.4])
def test_groups_of_texts_lose_no_pair(monkeypatch, density):
    """Bit-sliced sums over groups, in one tile and in several: the pairs that comparing each with each gives, each once."""
    rs = np.random.default_rng(0)
    bits = (rs.random((600, 64 * N.BITS)) < (rs.random(64 * N.BITS) ** 3 * density * 3).clip(0, 1)).astype(np.uint8)
    for i in range(0, 599, 7):
        bits[i + 1] = bits[i]
        bits[i + 1, rs.integers(0, 64 * N.BITS, 8)] ^= 1
    s, n = np.packbits(bits, axis=1, bitorder="little").view(np.uint64), bits.sum(1).astype(np.int64)
    lacking = n[:, None] - bits.astype(int) @ bits.T.astype(int)
    want = set(zip(*(z.tolist() for z in np.nonzero((lacking <= n[:, None] - np.ceil(0.75 * n - 1e-9)[:, None]) & (n[:, None] <= n)))))
    for tile, work in ((N.TILE, N.WORK), (3, 1 << 11)):
        monkeypatch.setattr(N, "TILE", tile)
        monkeypatch.setattr(N, "WORK", work)
        got = [pair for p, q in N._grouped(s, s, n, n, 0.75) for pair in zip(p.tolist(), q.tolist())]
        assert len(got) == len(set(got)) and set(got) == want


def test_few_pairs_are_compared_one_by_one(monkeypatch):
    """Of a million pairs of unlike texts less than a tenth come to a comparison of their own."""
    rs = np.random.default_rng(1)
    bits = np.zeros((1000, 64 * N.BITS), np.uint8)
    for row in bits:
        row[rs.choice(64 * N.BITS, 80, replace=False)] = 1
    s, n = np.packbits(bits, axis=1, bitorder="little").view(np.uint64), np.full(1000, 80)
    seen, ones = [], N._ones
    monkeypatch.setattr(N, "_ones", lambda z: seen.append(len(z)) or ones(z))
    monkeypatch.setattr(N, "_near", None)
    got = [pair for p, q in N._grouped(s, s, n, n, 0.75) for pair in zip(p.tolist(), q.tolist())]
    assert sorted(got) == [(i, i) for i in range(1000)] and sum(seen) < 100_000


def test_index_only_of_what_certified_texts_share(spark):
    """Texts with and without a certificate together: all links, though signatures only texts without one have aren't made."""
    rs = random.Random(6)
    rows = [(f"f{i:03}", " ".join(f"w{int(300 * rs.random() ** 2)}" for _ in range(120))) for i in range(80)]
    rows += varied(random.Random(8), [f"w{i}" for i in range(100)], 10, 12, "u")
    for i in range(40):
        rows += varied(random.Random(i), [f"r{i}x{j}" for j in range(70)] + [f"w{j}" for j in range(10)], 2, 9, f"c{i:02}n")
    df = spark.createDataFrame(rows, "key string, text string")
    uniq = N.word_sets(df, "key", "text").filter("words is not null").select("doc", "words")
    sent = spark.sparkContext.broadcast(N._classes(uniq, 0.75, 60, False, N.POSTING, N.GROUP))
    reached = N._sketches(uniq, sent).filter("reached").count()
    kept = N._certified(uniq, sent)
    assert 0 < reached < uniq.count() and kept.any()
    assert N._signature_rows(uniq, sent, spark.sparkContext.broadcast(np.packbits(kept))).count() < N._signature_rows(uniq, sent).count()
    want = brute(rows, 0.75, 60)
    assert len(want) >= 80 and set(map(tuple, N.linked_pairs(df, "key", "text").collect())) == want
