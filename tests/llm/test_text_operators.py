import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import canonical, encode, mixing, prose, toxicity


# ---- canonical ----


@pytest.mark.parametrize("a,b,d", [("", "", 0), ("abc", "abc", 0), ("abcd", "acbd", 1), ("kitten", "sitting", 3), ("a", "", 1)])
def test_osa(a, b, d):
    assert canonical.osa(a, b) == d


@given(st.text("abc", min_size=5, max_size=9), st.text("abc", min_size=5, max_size=9))
@settings(max_examples=300, deadline=None)
def test_deletions_meet_within_reach(a, b):
    if canonical.osa(a, b) <= 2:
        assert set(canonical.deletions(a, 2)) & set(canonical.deletions(b, 2))


def test_cities(spark):
    ref = spark.createDataFrame([(1, "Inkinmont", "HN"), (2, "West Oskominster", "HN"), (3, "Oskominster", "HN"), (4, "Pelenmere", "AV"), (5, "Pelenmere", "DN"), (6, "Pelerquay Beach", "GL"), (7, "Saint Ardegate", "EM")], "id int, city string, state string")
    cases = [("Inkimnont", None, 1), ("west_oskominster", "HN", 2), ("W. Oskominster (HN)", "HN", 2), ("WestOskominster", "HN", 2), ("Downtown Oskominster", "hn", 3), ("Pelenmere", "DN", 5), ("pelenmere, AV", None, 4), ("Pelerquay Bch 34493", "GL", 6), ("St. Ardegate", "EM", 7), ("Caldumabdale", "HN", -1), ("unknown", None, -1), ("12345", "HN", -1)]
    rows = [(f"b{i}", c, s) for i, (c, s, _) in enumerate(cases)] + [("blank", "  ", "HN"), ("none", None, "HN"), (None, "Inkinmont", "HN"), ("b0", "Inkimnont", None)]
    df = spark.createDataFrame(rows, "business_id string, city string, state string")
    got = {r["business_id"]: r["entry"] for r in canonical.map_rows(df, "business_id", "city", "state", ref, "id", "city", "state").collect()}
    assert got == {f"b{i}": e for i, (_, _, e) in enumerate(cases)}
    assert canonical.map_rows(df.limit(0), "business_id", "city", "state", ref, "id", "city", "state").collect() == []
    assert {r["entry"] for r in canonical.map_rows(df, "business_id", "city", "state", ref.limit(0), "id", "city", "state").collect()} == {-1}


# ---- encode ----


def test_encoding_is_that_of_public_libraries():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rs = random.Random(1)
    alphabet = "ab Z9'\n\t\x1c\x85\xa0　éß中😀<|endoftext|>'s're.,!?-_٣½\r\x0b"
    texts = ["".join(rs.choice(alphabet) for _ in range(rs.randint(1, 60))) for _ in range(3000)] + ["a" * 20_000, "é" * 3000, " " * 999]
    e = encode.encoder()
    assert [e.encode(x) for x in texts] == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [e.decode(e.encode(x)) for x in texts] == texts


def test_encode_table(spark):
    df = spark.createDataFrame([(1, "Hello world", [1]), (2, None, [1]), (3, "", [1]), (4, "  ", [1]), (1, "Hello world", [1])], "doc_id long, text string, ids array<int>")
    got = sorted((r["doc_id"], list(r["ids"])) for r in encode.encode_table(df, "doc_id", "text").collect())
    assert got == [(1, [15496, 995]), (1, [15496, 995]), (2, []), (3, []), (4, [220, 220])]
    assert [r["n"] for r in df.select(encode.token_count(F.col("text")).alias("n")).collect()] == [2, 0, 0, 2, 2]
    back = encode.encode_table(df, "doc_id", "text").select(encode.decode_ids(F.col("ids")).alias("t")).collect()
    assert [r["t"] for r in back] == ["Hello world", "", "", "  ", "Hello world"]
    assert encode.encode_table(df.limit(0), "doc_id", "text").collect() == []


# ---- mixing ----


def test_route_meets_quotas_and_caps():
    target = {"a": (0.5, 1), "b": (0.3, 2), "c": (0.2, 4), "absent": (0.2, 2)}
    patterns = {("a",): 1000, ("b",): 400, ("c",): 60, ("a", "b"): 100, ("b", "c"): 50, ("other",): 999}
    got = mixing.route(patterns, target)
    by = {s: sum(v for (_, x), v in got.items() if x == s) for s in "abc"}
    total = sum(by.values())
    for s in "abc":
        assert abs(by[s] / total - target[s][0]) < 0.01
        for (p, x), v in got.items():
            assert x != s or v <= patterns[p] * target[s][1]
    assert mixing.route({}, target) == {} and mixing.route(patterns, {"z": (1.0, 1)}) == {}


def test_route_finds_the_largest_total():
    """Two sources that share their texts: half of them each is the most."""
    target = {"a": (0.5, 1), "b": (0.5, 1)}
    got = mixing.route({("a", "b"): 10_000}, target)
    assert sum(got.values()) >= 19_990 if sum(got.values()) > 10_000 else sum(got.values()) >= 9_990
    by = mixing.route({("a", "b"): 900, ("a",): 100, ("b", "c"): 50}, target | {"c": (0.0, 1)})
    a, b = (sum(v for (_, x), v in by.items() if x == s) for s in "ab")
    assert abs(a - b) <= 2 and a + b > 900


def test_many_patterns_are_folded(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 2)
    rows = [(f"{s}{i}", f"text {i} of {g}", s) for g, n in (("a", 40), ("b", 30), ("ab", 20), ("bc", 10), ("abc", 5)) for i in range(n) for s in g]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 1), ("c", 0.1, 2)], "source string, target_share double, max_repeat int")
    got = mixing.select_mix(docs, "doc_id", "text", "source", targets)
    share = {r["source"]: r["actual_share"] for r in mixing.shares(got, targets).collect()}
    assert abs(share["a"] - 0.5) < 0.06 and abs(share["b"] - 0.4) < 0.06 and abs(share["c"] - 0.1) < 0.06


def test_select_mix(spark):
    rs = random.Random(0)
    words = "soup bread table light warm cold river stone".split()
    text = lambda: " ".join(rs.choice(words) for _ in range(rs.randint(5, 40)))
    rows = [(i, text(), "big") for i in range(600)] + [(1000 + i, text(), "small") for i in range(40)]
    rows += [(2000, rows[0][1], "small"), (2001, rows[0][1], "big"), (2002, None, "big"), (2003, "", "small"), (2004, "x", None), (2005, "y", "unlisted")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3), ("absent", 0.1, 2)], "source string, target_share double, max_repeat int")
    got = mixing.select_mix(docs, "doc_id", "text", "source", targets)
    picked = got.collect()
    assert all(1 <= r["uses"] <= (3 if r["source"] == "small" else 1) for r in picked)
    assert not {r["doc_id"] for r in picked} & {2002, 2003, 2004, 2005}
    shares = {r["source"]: r["actual_share"] for r in mixing.shares(got, targets).collect()}
    assert abs(shares["big"] - 0.6) < 0.03 and abs(shares["small"] - 0.4) < 0.03 and shares["absent"] == 0
    again = mixing.select_mix(docs.repartition(3), "doc_id", "text", "source", targets).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, picked))
    assert mixing.select_mix(docs.limit(0), "doc_id", "text", "source", targets).collect() == []


# ---- prose ----

EN = "the and was of a to in it we for with at is that they were our had very not".split()


def test_kinds(spark):
    rs = random.Random(0)
    nouns = "kitchen soup waiter garden window bread evening table coffee music light street friend menu corner".split()
    verbs = "served brought praised liked found tasted missed ordered shared finished noticed".split()

    def sentence():
        return f"The {rs.choice(nouns)} was {rs.choice(verbs)} and we {rs.choice(verbs)} the {rs.choice(nouns)} with a {rs.choice(nouns)} in the {rs.choice(nouns)}."

    rows = [(i, " ".join(sentence() for _ in range(rs.randint(2, 12))), "en") for i in range(300)]
    odd = {
        900: ("\n".join(f"{i}. {rs.choice(nouns)} {rs.choice(nouns)}" for i in range(1, 15)), "list"),
        901: ("\n".join(f"| {rs.choice(nouns)} | {i} | {i * 3} |" for i in range(12)), "table"),
        902: ("soup bread " * 80, "junk"),
        903: ("".join(rs.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(400)), "junk"),
        904: (", ".join(f"{rs.choice(nouns)} {rs.choice(nouns)}" for _ in range(25)), "list"),
        905: ("#*&^%$ " * 50, "junk"),
    }
    rows += [(k, t, "EN") for k, (t, _) in odd.items()] + [(950, None, "en"), (951, "", None), (952, " \n", "en"), (953, sentence().upper() + " " + sentence().upper(), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("distance", F.lit(1))
    common = spark.createDataFrame([("en", w) for w in EN], "lang string, word string")
    got = {r["doc_id"]: r for r in prose.classify(docs, "doc_id", "text", "lang", common).collect()}
    assert {k: got[k]["kind"] for k in odd} == {k: v for k, (_, v) in odd.items()}
    assert {r["kind"] for k, r in got.items() if k not in odd} == {"prose"}
    assert all(abs(sum(r["contribution"]) - r["distance"]) < 1e-6 * max(1, r["distance"]) for r in got.values())
    assert prose.classify(docs.limit(0), "doc_id", "text", "lang", common).collect() == []


# ---- toxicity ----


@pytest.mark.parametrize("raw,folded", [("pооr", "por"), ("m0r0n", "moron"), ("POOOOR".lower(), "por"), ("p​oor", "por"), ("f-o-o", "fo"), ("$31", "#"), ("hello,", "helo"), ("x" * 5000, "x")])
def test_fold(raw, folded):
    assert toxicity.fold(raw) == folded


def test_learns_from_positive_and_unlabelled():
    rs = random.Random(0)
    nouns = "soup bread table waiter menu window garden coffee".split()
    good = lambda: f"The {rs.choice(nouns)} was {rs.choice('warm cold nice slow bright'.split())} and the {rs.choice(nouns)} too."
    bad = lambda: f"What a {rs.choice('moron idiot cretin'.split())} that {rs.choice('cook clerk owner'.split())} is."
    doc = lambda t: " ".join([good() for _ in range(rs.randint(2, 6))] + [bad()] * t)
    model = toxicity.train([doc(1) for _ in range(60)], [doc(int(rs.random() < 0.05)) for _ in range(1500)])
    make = toxicity.Features()
    texts = [doc(1) for _ in range(100)] + [doc(0) for _ in range(300)] + [None, "", "  "]
    s = model.scores(pa.array(texts, pa.string()), make)
    assert (s[:100] > 0.5).mean() > 0.95 and (s[100:400] > 0.5).mean() < 0.01 and (s[400:] == 0).all()
    assert toxicity.train([], ["a"]).scores(pa.array(["a b"]), make)[0] < 0.01
    assert np.allclose(model.scores(pa.array(["What a moron that cook is. " + "fine day. " * 3000]), make), model.scores(pa.array(["fine. What a moron that cook is."]), make), atol=0.2)


def test_toxicity_tables(spark):
    rows = [(f"r{i}", f"text number {i} is fine", "web") for i in range(50)] + [("bad", "you moron go away", None), ("none", None, "web"), (None, "x", "web"), ("bad", "you moron go away", "ios")]
    df = spark.createDataFrame(rows, "review_id string, text string, source string")
    labels = spark.createDataFrame([("bad", 1), ("r1", 0), ("gone", 1), (None, 1)], "review_id string, toxic int")
    p, u = toxicity.sample(df, "review_id", "text", labels, "review_id", "toxic")
    assert p == ["you moron go away"] and len(u) == 50
    scored = toxicity.score(df, ["review_id", "source"], "text", toxicity.train(p, u)).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.sample(df.limit(0), "review_id", "text", labels, "review_id", "toxic") == ([], [])


def test_long_passages_over_and_over_are_cycles():
    rs = random.Random(3)
    stock = [f"w{i}" for i in range(300)]
    for size in (60, 201, 401, 650, 900, 3000):
        passage = [stock[int(300 * rs.random() ** 2)] for _ in range(size)]
        assert prose._cycle(passage * 8) > 0.95 and prose._cycle(["title", "of", "it", *passage * 3, "end"]) > 0.95
        noisy = [w if rs.random() > 0.01 else "odd" for w in passage * 6]
        assert prose._cycle(noisy) > 0.95
        assert prose._cycle([stock[int(300 * rs.random() ** 2)] for _ in range(8 * size)]) < 0.5
    # a word pair that comes back often within the passage
    assert prose._cycle((["a", "b", "c"] + ["a", "b", "d", "e"] * 9 + stock[:160]) * 8) > 0.95


def test_cities_two_edits_away_and_nearer_wrong_tokens(spark):
    ref = spark.createDataFrame([(1, "Marwick", "HN"), (2, "Tolbergen Ridge", "HN"), (3, "Tolbarden Quay", "HN")], "id int, city string, state string")
    # two edits of seven letters; a first token one edit from entry 3 and two from entry 2, whose other token it has
    cases = [("Mxrwyck", 1), ("Tolbargen Ridge", 2), ("Ridge Tolbarden", 2), ("Mxrwxyk", -1)]
    rows = spark.createDataFrame([(f"b{i}", c, "HN") for i, (c, _) in enumerate(cases)], "business_id string, city string, state string")
    got = dict(map(tuple, canonical.map_rows(rows, "business_id", "city", "state", ref, "id", "city", "state").collect()))
    assert got == {f"b{i}": e for i, (_, e) in enumerate(cases)}


# ---- mixing, any number of patterns ----


def test_mix_is_the_same_at_any_number_of_patterns(spark, monkeypatch):
    rows = [(f"{s}{i}", f"text {i} of {g}", s) for g, n in (("a", 40), ("b", 30), ("ab", 20), ("bc", 10), ("abc", 5)) for i in range(n) for s in g]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 1), ("c", 0.1, 2)], "source string, target_share double, max_repeat int")
    want = sorted(map(tuple, mixing.select_mix(docs, "doc_id", "text", "source", targets).collect()))
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 2)
    assert sorted(map(tuple, mixing.select_mix(docs, "doc_id", "text", "source", targets).collect())) == want and len(want) > 20


def test_fill_moves_what_others_took():
    """As much as possible at least cost, against all ways to deal out a few tokens."""
    rs = random.Random(3)
    for _ in range(60):
        tokens, most, quota = np.array([rs.randint(1, 2) for _ in range(2)]), np.array([rs.randint(1, 2) for _ in range(2)]), np.array([rs.randint(0, 4) for _ in range(2)])
        holds = np.array([[rs.random() < 0.8 for _ in range(2)] for _ in range(2)])
        cap = np.where(holds, tokens[:, None] * most, 0)

        def cost(n, t):
            return sum(i // t for i in range(n))

        def rank(flow):
            return -sum(map(sum, flow)), sum(cost(sum(r), t) + sum(cost(n, t) for n in r) for r, t in zip(flow, tokens.tolist()))

        ways = [((a, b), (c, d)) for a in range(cap[0, 0] + 1) for b in range(cap[0, 1] + 1) for c in range(cap[1, 0] + 1) for d in range(cap[1, 1] + 1)]
        ways = [w for w in ways if w[0][0] + w[1][0] <= quota[0] and w[0][1] + w[1][1] <= quota[1] and all(sum(r) <= m for r, m in zip(w, cap.max(1)))]
        got = mixing.fill(tokens, holds, most, quota).tolist()
        assert tuple(map(tuple, got)) in ways and rank(got) == min(map(rank, ways))
        assert mixing.fill(tokens, holds, most, quota, False).sum() == -min(map(rank, ways))[0]


def test_route_of_many_patterns():
    """All of 20 000 patterns of 15 sources go to the flow, in seconds, and all shares are met."""
    names = [f"s{i:02}" for i in range(15)]
    patterns = {tuple(s for j, s in enumerate(names) if i >> j & 1): 100 + i % 977 for i in range(1, 20_001)}
    target = {s: (1.0 + i % 3, 1 + i % 2) for i, s in enumerate(names)}
    got = mixing.route(patterns, target)
    by = {s: sum(v for (_, x), v in got.items() if x == s) for s in names}
    assert all(abs(by[s] / sum(by.values()) - target[s][0] / sum(t[0] for t in target.values())) < 1e-3 for s in names)
    assert any(len(p) > 1 and x != p[0] for p, x in got)
