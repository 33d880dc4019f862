import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregate, dedup, joins, partitioning, sampling, transform


def test_half_even_histogram(spark):
    df = spark.createDataFrame([(3.7,), (3.2,), (3.5,), (2.5,), (4.5,), (None,), (9.0,)], "stars double")
    assert {r["star"]: r["n"] for r in aggregate.star_histogram(df).collect()} == {4: 3, 3: 1, 2: 1, 1: 1, 5: 1}
    empty = aggregate.star_summary(df.limit(0)).first()
    assert empty["total_records"] == 0 and empty["mean_stars"] == 0.0 and empty["p25"] == 0.0
    with pytest.raises(ValueError):
        aggregate.star_summary(df, (101,))


def test_percentiles(spark):
    got = aggregate.star_summary(spark.createDataFrame([(float(i),) for i in (1, 2, 3, 4)], "stars double")).first()
    assert got["p25"] == 1.75 and got["median_stars"] == 2.5 and abs(got["stddev_stars"] - 1.118034) < 1e-6


def test_stats_skip_empty_keys(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 4.0, None), ("", 5.0, 1), (None, 5.0, 1)], "business_id string, stars double, useful long")
    r = aggregate.business_stats(df).collect()
    assert [(x["business_id"], x["review_count"], x["average_stars"], x["positive_count"], x["negative_count"], x["useful_sum"]) for x in r] == [("a", 2, 2.0, 1, 1, 1)]


def test_joins(spark):
    left = spark.createDataFrame([(1, "A", None), (2, "B", 3.0), (3, None, 1.0), (4, "A", 2.0)], "id int, k string, stars double")
    right = joins.lookup(spark.createDataFrame([("A", "old", 5.0, 1), ("A", "Zoé", 4.0, 2), (None, "x", 1.0, 3), ("C", "c", 2.0, 4)], "k string, name string, stars double, ord int"), "k", ["ord"]).drop("ord")
    assert {(r["id"], r["name"], r["stars"]) for r in joins.lookup_join(left, right, "k").collect()} == {(1, "Zoé", None), (2, None, 3.0), (3, None, 1.0), (4, "Zoé", 2.0)}
    assert joins.lookup_join(left, right, "k", prefix="b_", how="inner").columns == ["id", "k", "stars", "b_name", "b_stars"]
    assert {r["id"] for r in joins.lookup_anti(left, right, "k").collect()} == {2, 3}
    assert {(r["k"], r["id"], r["stars"]) for r in joins.lookup_right(left, right, "k", ["id"], fill_value=-1).collect()} == {("A", 4, 4.0), ("C", -1, 2.0)}


def test_transform(spark):
    df = spark.createDataFrame([("1", "x", True), ("y", None, None)], "a string, b string, c boolean")
    assert transform.rename_fields(df, {"a": "b", "zz": "q"}).columns in (["b", "c"],)
    got = transform.coerce_types(df, {"a": "int", "nope": "int"}).collect()
    assert [r["a"] for r in got] == [1, None] and got[1]["_coerce_error"] == {"a": "y"}
    assert [r["b"] for r in transform.map_values(df, "b", {"x": None, None: "n"}).collect()] == [None, "n"]
    assert [r["b"] for r in transform.map_values(df, "b", {"q": "r"}, default="d").collect()] == ["d", "d"]
    assert transform.keep_if(df, [F.col("c")]).count() == 1 and transform.keep_if(df, [lambda r: r["a"] == "y"]).count() == 1
    some = transform.add_computed(df, {"n": (lambda r: len(r["a"] + r["b"]), "long"), "d": F.upper("b")}).collect()
    assert [(r["n"], r["d"]) for r in some] == [(2, "X"), (None, None)]
    with pytest.raises(KeyError):
        transform.normalise_fields(df, {"zz": [F.upper]}, strict=True)
    with pytest.raises(ValueError):
        transform.process(df, sample_rate=0)


def test_dedup(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "a", 3), (4, None, 4)], "ord int, k string, v int")
    assert {r["ord"] for r in dedup.dedup_first(df, ["k"], ["ord"]).collect()} == {1, 2}
    assert tuple(dedup.dedup_stats(df, ["k"]).first()) == (4, 2, 2)
    assert tuple(dedup.dedup_stats(df.limit(0), ["k"]).first()) == (0, 0, 0)


def test_stratified_is_exact(spark):
    rows = [(i, "big" if i < 2000 else "one" if i == 2000 else None) for i in range(2026)]
    df = spark.createDataFrame(rows, "id long, s string")
    counts = {r["s"]: r["count"] for r in sampling.stratified(df, "s", 0.1, "id").groupBy("s").count().collect()}
    assert counts == {"big": 200, "one": 1, None: 2}
    a, b = (sorted(r["id"] for r in sampling.stratified(df.repartition(n), "s", 0.1, "id").collect()) for n in (2, 5))
    assert a == b
    assert sampling.reservoir(df, 10, "id").count() == 10
    for f in (lambda: sampling.reservoir(df, 0, "id"), lambda: sampling.bernoulli(df, 2)):
        with pytest.raises(ValueError):
            f()


def test_split_remainder_goes_last(spark):
    df = spark.createDataFrame([(i,) for i in range(11)], "i long")
    assert [(r["chunk"], r["lines"]) for r in partitioning.split_plan(df, ["i"], 3).orderBy("chunk").collect()] == [(0, 3), (1, 3), (2, 5)]
    assert partitioning.split_chunks(df, ["i"], 50).select("chunk").distinct().count() == 11
    assert partitioning.estimate_chunks(0, 5) == 1 and partitioning.estimate_chunks(11, 5) == 3
    for bad in (lambda: partitioning.split_chunks(df, ["i"], 0), lambda: partitioning.split_chunks(df.limit(0), ["i"], 2), lambda: partitioning.estimate_chunks(1, 0)):
        with pytest.raises(ValueError):
            bad()
