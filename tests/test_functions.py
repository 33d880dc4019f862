import pytest
from pyspark.sql import functions as F

from tidemark.functions import hashing, normalize, sentiment, text, validate


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw,cleaned",
    [
        ("<b>Hi</b>", "hi"), ("see https://x.y/z now", "see now"), ("wow?!?!.", "wow.."), ("Great!!!!!!!!", "great!!"), ("a \xa0\x1c b", "a b"),
        (None, ""), ("", ""), ("ﬁne", "fine"), ("x  " * 3000, ("x " * 3000).strip()),
    ],
)
def test_clean(spark, raw, cleaned):
    assert one(spark, text.clean_text(F.col("c")), raw) == cleaned


def test_clean_options(spark):
    c = F.col("c")
    assert one(spark, text.clean_text(c, punctuation=True), "one,two") == "one two"
    assert one(spark, text.clean_text(c, max_length=4), "abc def") == "abc "
    assert one(spark, text.clean_text(c, max_length=0), "abc") == ""
    assert one(spark, text.clean_text(c, null_as="None")) == "none"


def test_stats_of_nothing(spark):
    for value in (None, "", "  "):
        got = spark.createDataFrame([(value,)], "c string").select(*[v.alias(k) for k, v in text.text_stats(F.col("c")).items()]).first()
        assert got["word_count"] == 0 and got["sentence_count"] == 0 and got["char_count"] == len(value or "")
    assert one(spark, text.reading_ease(F.col("c")), "") == 0.0


def test_top_words_ties(spark):
    df = spark.createDataFrame([(1, "Pie cake pie, cake! tea the the the"), (2, None)], "id int, t string")
    assert [(r["word"], r["n"]) for r in text.top_words(df, "id", "t", 2).orderBy("rank").collect()] == [("pie", 2), ("cake", 2)]
    assert text.top_words(df, "id", "t", 1, exclude_stopwords=False).first()["word"] == "the"


@pytest.mark.parametrize("raw,f,i,s", [("3.9", 3.9, 0, 3.9), ("7", 7.0, 7, 5.0), ("x", 0.0, 0, 0.0), (None, 0.0, 0, 0.0), ("NaN", float("nan"), 0, 5.0), ("0", 0.0, 0, 1.0)])
def test_numbers(spark, raw, f, i, s):
    c = F.col("c")
    got = one(spark, normalize.to_float(c), raw)
    assert got == f or got != got and f != f
    assert one(spark, normalize.to_int(c), raw) == i and one(spark, normalize.normalise_stars(c), raw) == s


def test_other_normalisers(spark):
    c = F.col("c")
    assert one(spark, normalize.normalise_phone(c), "+1 (555) a-0.1") == "1555a01"
    assert one(spark, normalize.lowercase_strip(c), " \xa0AbC ") == "abc"
    assert one(spark, normalize.strip_whitespace(c)) == ""
    assert one(spark, normalize.to_int(c, numeric=True), 3.9, "double") == 3


@pytest.mark.parametrize(
    "check,good,bad",
    [
        (validate.valid_stars, ["1", "5", "4.5"], ["0", "6", "x", None, "NaN"]), (validate.valid_email, ["a@b.c", " a@b.co "], ["a@b", "@b.c", "", None]),
        (validate.valid_date, ["9999-99-99"], ["2020-1-1", None, "2020-01-01x"]), (validate.valid_business_id, ["x"], ["", "  ", None]),
        (validate.valid_review_id, ["a-_9"], ["", "a b", "x" * 101, None]),
    ],
)
def test_validators(spark, check, good, bad):
    rows = spark.createDataFrame([(v,) for v in good + bad], "c string").select(check(F.col("c")).alias("x")).collect()
    assert [r["x"] for r in rows] == [True] * len(good) + [False] * len(bad)


def test_schema(spark):
    specs = [validate.FieldSpec("i", "int", min_value=2), validate.FieldSpec("f", "float", required=False), validate.FieldSpec("s", "str", max_length=3, allowed=["abc", "abcd"])]
    cases = [('{"i": 4, "f": 4.0, "s": "abc"}', []), ('{"i": true, "s": "abc"}', ["i: below 2"]), ('{"i": "4", "f": 4, "s": "abcd"}', ["i: expected int", "f: expected float", "s: longer than 3"]), ('{"s": null, "i": 1}', ["i: below 2", "s: required field is missing"])]
    df = spark.createDataFrame([(c,) for c, _ in cases], "j string").select(validate.schema_errors(F.parse_json("j"), specs).alias("e"))
    assert [r["e"] for r in df.collect()] == [e for _, e in cases]
    with pytest.raises(ValueError):
        validate.FieldSpec("x", "date")


def test_hashes(spark):
    assert one(spark, hashing.sha256_hex(F.col("c")), "hello").startswith("2cf24dba5fb0a30e")
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    same = df.select("b", "a")
    assert df.select(hashing.record_fingerprint(df)).first() == same.select(hashing.record_fingerprint(same)).first()
    other = spark.createDataFrame([(1.0, "x")], "a double, b string")
    assert df.select(hashing.record_fingerprint(df)).first() != other.select(hashing.record_fingerprint(other)).first()
    with pytest.raises(ValueError):
        hashing.record_fingerprint(df, algorithm="crc")
    with pytest.raises(ValueError):
        hashing.short_id(df, length=65)


def test_sentiment(spark):
    rows = spark.createDataFrame([("great great place",), ("awful",), (None,), ("",)], "text string")
    assert [r["sentiment_label"] for r in sentiment.enrich(rows, backend="lexicon").collect()] == ["positive", "negative", "neutral", "neutral"]
    assert {r["sentiment_label"] for r in sentiment.enrich(rows, backend="neutral").collect()} == {"neutral"}
    labels = spark.createDataFrame([(0.1,), (0.11,), (-0.1,), (-0.2,)], "p double").select(sentiment.label(F.col("p")).alias("l"), sentiment.warehouse_label(F.col("p")).alias("w")).collect()
    assert [(r["l"], r["w"]) for r in labels] == [("neutral", "Positive"), ("positive", "Positive"), ("neutral", "Negative"), ("negative", "Negative")]
    with pytest.raises(ValueError):
        sentiment.label(F.col("p"), 0.1, 0.2)


def test_warehouse_labels_read_the_text(spark, data):
    from tidemark.plans import relational

    rows = relational.QUERIES["warehouse_lexicon_labels"](spark, data).collect()
    assert {r["label"] for r in rows} == {"Positive", "Negative", "Neutral"}
    assert sum(r["n"] for r in rows) == sum(r["n"] for r in relational.QUERIES["warehouse_labels"](spark, data).collect())


@pytest.mark.parametrize(
    "value,emails",
    [("Mail a@b.com. or x%y@c.org", ["a@b.com", "x%y@c.org"]), ("z@1.2", []), ("first.last+tag@sub.example.co.uk!", ["first.last+tag@sub.example.co.uk"]), (None, []), ("", [])],
)
def test_emails(spark, value, emails):
    assert one(spark, text.extract_emails(F.col("c")), value) == emails


def test_phones_and_stop_words(spark):
    assert one(spark, text.extract_phones(F.col("c")), "call +1 (512) 555-0140 or ٠١٢٣٤٥٦٧ or 12345") == ["+1 (512) 555-0140", "٠١٢٣٤٥٦٧"]
    assert len(text.STOPWORDS) == len(set(text.STOPWORDS))
    assert {"shall", "can"} <= set(text.STOPWORDS) and not {"by", "from"} & set(text.STOPWORDS)


def test_truncated_counts_cut_texts(spark):
    df = spark.createDataFrame([("abcd",), ("abcde",), ("",), (None,)], "t string").withColumn("u", text.clean_text(F.col("t")))
    assert text.cleaner_stats(df, "t", "u", 4).first().asDict() == {"total_cleaned": 2, "empty_inputs": 2, "chars_removed": 1, "truncated": 1}


def test_lengths_of_lists_and_allowed_values(spark):
    specs = [validate.FieldSpec("l", "list", min_length=4), validate.FieldSpec("n", "any", required=False, allowed=[1, "x"])]
    cases = [('{"l": [1, 2, 3]}', ["l: shorter than 4"]), ('{"l": ["a", null, {}, 4], "n": 1.0}', []), ('{"l": "long enough"}', ["l: expected list"]), ('{"l": [1,2,3,4], "n": "1"}', ["n: value not allowed"])]
    df = spark.createDataFrame([(c,) for c, _ in cases], "j string").select(validate.schema_errors(F.parse_json("j"), specs).alias("e"))
    assert [r["e"] for r in df.collect()] == [e for _, e in cases]


def test_paths(tmp_path):
    with pytest.raises(ValueError):
        validate.input_path(str(tmp_path))
    with pytest.raises(ValueError):
        validate.output_prefix("")
    (tmp_path / "f").write_text("x")
    assert validate.input_path(str(tmp_path / "f")).endswith("/f") and validate.output_prefix("p") == "p"
