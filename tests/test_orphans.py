from datetime import datetime as D

import pytest

from tidemark.operators.orphans import broken_references

T0, T1, T2 = D(2020, 1, 1), D(2020, 2, 1), D(2020, 3, 1)


def test_states(spark):
    refs = spark.createDataFrame([(1, "a", T1), (2, "b", T1), (3, "c", T1), (4, "d", T1), (5, None, T1), (6, "", T1), (7, "A", T1), (8, "b", None), (2, "b", T1)], "row_id long, k string, at timestamp")
    target = spark.createDataFrame([("a", T0), ("b", T2), ("a", T2), (None, T0)], "k string, at timestamp")
    gone = spark.createDataFrame([("c",), ("a",)], "k string")
    got = broken_references(refs, ["k"], target, ["k"], row_id="row_id", ref_time="at", target_time="at", deleted=gone)
    assert sorted((r["row_id"], r["state"]) for r in got.collect()) == [(2, "late"), (2, "late"), (3, "deleted"), (4, "missing"), (6, "missing"), (7, "missing")]
    empty = broken_references(refs, ["k"], target.limit(0), ["k"], row_id="row_id", ref_time="at", target_time="at", deleted=gone)
    assert empty.count() == 8
    assert broken_references(refs.limit(0), ["k"], target, ["k"], row_id="row_id").count() == 0


@pytest.mark.parametrize(
    "match,orphans",
    [("simple", [(2, "missing")]), ("partial", [(2, "missing"), (4, "missing")]), ("full", [(2, "missing"), (3, "incomplete"), (4, "incomplete")])],
)
def test_partly_null_references(spark, match, orphans):
    refs = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "a", None), (4, None, 9), (5, None, None)], "row_id long, x string, y int")
    target = spark.createDataFrame([("a", 1), (None, 9), ("b", 2)], "x string, y int").filter("x is not null")
    got = broken_references(refs, ["x", "y"], target, ["x", "y"], row_id="row_id", match=match)
    assert sorted((r["row_id"], r["state"]) for r in got.collect()) == orphans
    with pytest.raises(ValueError):
        broken_references(refs, ["x"], target, ["x"], row_id="row_id", match="other")
