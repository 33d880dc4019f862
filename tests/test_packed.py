import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators.packed import explode_packed, split_packed


@pytest.mark.parametrize(
    "text,values",
    [
        (None, []), ("", []), ("  ", []), (",", []), (",,;|", []),
        ("Bars", ["Bars"]), ("Bars, Yoga", ["Bars", "Yoga"]), ("Bars,,Yoga;", ["Bars", "Yoga"]), ("Bars, Bars", ["Bars", "Bars"]),
        ('"Beer, Wine", Yoga', ["Beer, Wine", "Yoga"]), ("'Tools | Hardware', Gyms", ["Tools | Hardware", "Gyms"]),
        ('["Pizza; Pasta","Gyms"]', ["Pizza; Pasta", "Gyms"]), ('"The ""Corner"" Deli"', ['The "Corner" Deli']),
        ("Women's Shoes, Men's Tailoring", ["Women's Shoes", "Men's Tailoring"]), ("'Women's Shoes', Bars", ["Women's Shoes", "Bars"]),
        ("2017-01-02 10:00:01 • 2017-01-03T09:00:00Z", ["2017-01-02 10:00:01", "2017-01-03T09:00:00Z"]),
        ("Delis；Laundry，Pubs & Lounges\tB&B\nYoga", ["Delis", "Laundry", "Pubs & Lounges", "B&B", "Yoga"]),
        ('Bars, "unclosed', ["Bars", "unclosed"]), ("[Bars]", ["Bars"]), ("Tapas/Small Plates (new)", ["Tapas/Small Plates (new)"]),
    ],
)
def test_values(text, values):
    assert split_packed(text) == values


@given(st.lists(st.text("abc &,;|'\"", min_size=1, max_size=8).filter(lambda s: s.strip() == s and s), max_size=6), st.sampled_from([",", ";", "|", "\t", "•"]))
@settings(max_examples=300, deadline=None)
def test_quoted_values_come_back(values, sep):
    text = sep.join('"' + v.replace('"', '""') + '"' for v in values)
    assert split_packed(text) == [v for v in values if v.strip()]


def test_table(spark):
    long = ", ".join(["Bars"] * 5000)
    df = spark.createDataFrame([(1, "a, b", 7, 8), (2, None, 7, 8), (3, long, 7, 8), (1, "a, b", 7, 8)], "row_id long, f string, pos int, val int")
    rows = explode_packed(df, ["row_id"], "f").collect()
    assert len(rows) == 5004 and sorted(r for r in rows if r["row_id"] == 1)[0] == (1, 1, "a")
    assert max(r["pos"] for r in rows) == 5000
    assert explode_packed(df.limit(0), ["row_id"], "f").collect() == []
