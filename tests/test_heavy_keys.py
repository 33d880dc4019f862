from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.heavy_keys import cut, heavy_keys, key_summary, running
from tidemark.operators.partitioning import with_row_number


def table(spark):
    rows = [("hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 11}", i, float(i % 5) if i % 4 else None) for i in range(600)]
    return rows, spark.createDataFrame(rows, "k string, n_row long, v double")


def test_hot_key_is_split(spark):
    _, df = table(spark)
    parts = cut(df.filter("k = 'hot'"), "k", ["n_row"], 4).groupBy("part").count().collect()
    assert len(parts) == 4 and max(p["count"] for p in parts) < 120


def test_summary_and_heavy(spark):
    rows, df = table(spark)
    want = defaultdict(list)
    for k, i, v in rows:
        want[k].append((i, v))
    got = {r["k"]: r for r in key_summary(df, "k", "n_row", sums=["v"], means=["v"], partitions=5).collect()}
    assert set(got) == set(want)
    for k, xs in want.items():
        vs = [v for _, v in xs if v is not None]
        assert (got[k]["n"], got[k]["first_n_row"], got[k]["last_n_row"], got[k]["sum_v"]) == (len(xs), xs[0][0], xs[-1][0], sum(vs))
        assert abs(got[k]["mean_v"] - sum(vs) / len(vs)) < 1e-9
    assert {r["k"] for r in heavy_keys(df, "k", "n_row", 0.1).collect()} == {k for k, xs in want.items() if k and len(xs) >= 60}
    assert heavy_keys(df.limit(0), "k", "n_row", 0.1).collect() == []


def test_running(spark):
    rows, df = table(spark)
    seen = defaultdict(list)
    want = {}
    for k, i, v in rows:
        seen[k].append(v)
        vs = [x for x in seen[k] if x is not None]
        want[i] = (len(seen[k]), sum(vs) / len(vs) if vs else None)
    for r in running(df, "k", ["n_row"], "v", 5).collect():
        n, mean = want[r["n_row"]]
        assert r["rank_in_key"] == n and (mean is None and r["running_mean"] is None or abs(r["running_mean"] - mean) < 1e-9)


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_ranks_and_numbers_of_wide_rows(spark, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    n = F.col("id")
    df = spark.range(0, 400_000, 1, 8).select((n * 7919 % 400_000).alias("at"), F.when(n % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), n % 50)).alias("k"), F.lit(2.0).alias("v"), F.concat(F.lit("text "), n).alias("part"), F.lit("x").alias("rank_in_key"))
    got = running(df, "k", ["at"], "v", 12)
    want = F.row_number().over(Window.partitionBy("k").orderBy("at"))
    assert got.columns.count("rank_in_key") == 1 and got.withColumn("w", want).filter("w = rank_in_key and running_mean = 2 and part is not null").count() == 400_000
    assert with_row_number(df, ["at"]).filter("rn = at").count() == 400_000
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_numbers_with_nulls_ties_and_structs(spark):
    rows = [(None if i % 5 == 0 else i // 3, f"r{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b string").withColumn("s", F.struct("a", "b"))
    got = [r["b"] for r in with_row_number(df, ["s"]).orderBy("rn").collect()]
    assert got == [b for _, b in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))]
    assert sorted(r["rn"] for r in with_row_number(df, ["a"]).collect()) == list(range(300))
    assert with_row_number(df.limit(0), ["a"]).collect() == []
