"""Queries of the review engine's own operators, each over its whole tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import hashing, normalize, sentiment, text, validate
from tidemark.operators import aggregate, dedup, joins, partitioning, sampling, transform
from tidemark.plans import warehouse
from tidemark.schemas import VALID, business_flags, checkin_flags, record_json, review_flags, user_flags
from tidemark.session import spread
from tidemark.sources.jsonl import synthetic
from tidemark.sources.tables import businesses_v, load, reviews_v

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# Fragments of SQL. Every pattern and word list is spelled out here, so that the SQL doesn't rest on the functions it checks.
_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_EMAIL_SQL = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
_PHONE_SQL = rf"\+?\p{{Nd}}[\p{{Nd}}{_WS}\-().]{{5,}}\p{{Nd}}"
_PUNCT_SQL = r"[!-/:-@\[-`{-~]"


def _strip(sql: str) -> str:
    return f"regexp_replace({sql}, '^[{_WS}]+|[{_WS}]+$', '', 'g')"


_WORDS = "list_filter(regexp_split_to_array(" + _strip("coalesce(text, '')") + ", '[" + _WS + "]+'), lambda w: w <> '')"
_STARS = "coalesce(stars, 0.0)"
_KEY = "greatest(1, least(5, CAST(round_even(" + _STARS + ", 0) AS INTEGER)))"
_STOPS = """['a', 'an', 'the', 'and', 'or', 'but', 'in', 'on', 'at', 'to', 'of', 'for', 'with', 'is', 'are', 'was', 'were', 'be', 'been', 'being',
    'have', 'has', 'had', 'do', 'does', 'did', 'will', 'would', 'could', 'should', 'may', 'might', 'shall', 'can']"""


def _clean_sql(column: str) -> str:
    out = f"coalesce({column}, '')"
    for pattern, to in (("<[^>]+>", " "), (rf"(?i)https?://[^{_WS}]+|www\.[^{_WS}]+", " "), ("([!?.]){3,}", r"\1\1")):
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return f"trim(regexp_replace(lower({out}), '[{_WS}]+', ' ', 'g'), ' ')"


_NEEDED = {"yelp_review": ["row_id", "text", "stars", "useful", "funny", "cool"], "documents": ["doc_id", "lang", "text"]}


def _texts(spark: SparkSession, d: str, table: str) -> DataFrame:
    """The columns of a table of texts that these queries read, dealt out over the cores where it is small."""
    return spread(load(spark, d, table).select(*_NEEDED[table]))


# ---- text ------------------------------------------------------------------------------------------------


@query(f"SELECT lang, count(*) AS docs, avg(CAST(len({_WORDS}) AS DOUBLE)) AS avg_words, count(*) FILTER (len({_WORDS}) > 50) AS long_docs FROM (SELECT lang, {_clean_sql('text')} AS text FROM documents) GROUP BY 1")
def word_summary(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: clean every document, count words, summarise per language."""
    cleaned = _texts(spark, d, "documents").select("lang", text.clean_text(F.col("text"), unicode=False).alias("text"))
    n = text.word_count(F.col("text"))
    return cleaned.select("lang", n.alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.avg(F.col("n").cast("double")).alias("avg_words"), F.count_if(F.col("n") > 50).alias("long_docs"))


@query(f"SELECT row_id, {_clean_sql('text')} AS cleaned FROM yelp_review")
def clean_reviews(spark, d):
    return _texts(spark, d, "yelp_review").select("row_id", text.clean_text(F.col("text"), unicode=False).alias("cleaned"))


@query()
def clean_reviews_nfkc(spark, d):
    return _texts(spark, d, "yelp_review").select("row_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(f"""SELECT count(*) FILTER (length(coalesce(text, '')) > 0) AS total_cleaned, count(*) FILTER (length(coalesce(text, '')) = 0) AS empty_inputs,
    CAST(sum(greatest(0, length(coalesce(text, '')) - least(length({_clean_sql('text')}), 200))) AS BIGINT) AS chars_removed,
    count(*) FILTER (length({_clean_sql('text')}) > 200) AS truncated FROM yelp_review""")
def cleaner_counters(spark, d):
    df = _texts(spark, d, "yelp_review").select("text", text.clean_text(F.col("text"), unicode=False).alias("cleaned"))
    return text.cleaner_stats(df, "text", "cleaned", 200)


@query(f"SELECT row_id, regexp_extract_all(coalesce(text, ''), '{_EMAIL_SQL}') AS emails, regexp_extract_all(coalesce(text, ''), '{_PHONE_SQL}') AS phones FROM yelp_review")
def extract_contacts(spark, d):
    return _texts(spark, d, "yelp_review").select("row_id", text.extract_emails(F.col("text")).alias("emails"), text.extract_phones(F.col("text")).alias("phones"))


@query(f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
    s AS (SELECT doc_id, t, w, len(w) AS n, len(list_filter(regexp_split_to_array(t, '[.!?]+'), lambda x: {_strip('x')} <> '')) AS p FROM t)
    SELECT doc_id, length(t) AS char_count, CAST(n AS INTEGER) AS word_count, CAST(CASE WHEN n > 0 THEN greatest(1, p) ELSE 0 END AS INTEGER) AS sentence_count,
    CAST(len(list_distinct(list_transform(w, lambda x: lower(x)))) AS INTEGER) AS unique_words,
    CASE WHEN n > 0 THEN CAST(list_sum(list_transform(w, lambda x: length(x))) AS DOUBLE) / n ELSE 0.0 END AS avg_word_length,
    CASE WHEN n > 0 THEN CAST(len(list_filter(w, lambda x: list_contains({_STOPS}, lower(x)))) AS DOUBLE) / n ELSE 0.0 END AS stopword_ratio,
    CASE WHEN n > 0 THEN CAST(len(list_distinct(list_transform(w, lambda x: lower(x)))) AS DOUBLE) / n ELSE 0.0 END AS diversity FROM s""")
def text_statistics(spark, d):
    return text.add_text_stats(_texts(spark, d, "documents"), "text", ["doc_id"])


@query(f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
    s AS (SELECT doc_id, w, len(w) AS n, greatest(1, len(list_filter(regexp_split_to_array(t, '[.!?]+'), lambda x: {_strip('x')} <> ''))) AS p,
    CAST(list_sum(list_transform(w, lambda x: greatest(1, len(regexp_extract_all(x, '[aeiouAEIOU]+'))))) AS DOUBLE) AS y FROM t)
    SELECT doc_id, CASE WHEN n > 0 THEN (CAST(206.835 AS DOUBLE) - CAST(1.015 AS DOUBLE) * (CAST(n AS DOUBLE) / p) - CAST(84.6 AS DOUBLE) * (y / n)) ELSE 0.0 END AS ease FROM s""")
def reading_levels(spark, d):
    return _texts(spark, d, "documents").select("doc_id", text.reading_ease(F.col("text"), None).alias("ease"))


@query(f"""WITH w AS (SELECT doc_id, unnest({_WORDS}) AS w, generate_subscripts({_WORDS}, 1) AS pos FROM documents),
    b AS (SELECT doc_id, pos, trim(lower(w), '.,!?;:"''') AS word FROM w), c AS (SELECT doc_id, word, count(*) AS n, min(pos) AS first FROM b WHERE word <> '' AND NOT list_contains({_STOPS}, word) GROUP BY 1, 2)
    SELECT doc_id, word, n, rank FROM (SELECT doc_id, word, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS rank FROM c) WHERE rank <= 3""")
def top_words(spark, d):
    return text.top_words(_texts(spark, d, "documents"), "doc_id", "text", 3)


# ---- records ---------------------------------------------------------------------------------------------


@query(f"""SELECT row_id, coalesce(useful, 0) + coalesce(funny, 0) + coalesce(cool, 0) AS total_votes, coalesce(stars >= 4, false) AS is_positive, coalesce(stars <= 2, false) AS is_negative,
    CAST(len({_WORDS}) AS INTEGER) AS word_count FROM yelp_review""")
def review_model(spark, d):
    df = _texts(spark, d, "yelp_review")
    return df.select("row_id", *[v.alias(k) for k, v in review_flags().items()])


@query(f"""SELECT row_id, list_filter(list_transform(string_split(coalesce(categories, ''), ','), lambda x: {_strip('x')}), lambda x: x <> '') AS category_list,
    coalesce(stars >= 4, false) AS highly_rated, latitude IS NOT NULL AND longitude IS NOT NULL AS has_coordinates FROM yelp_business""")
def business_model(spark, d):
    return load(spark, d, "yelp_business").select("row_id", *[v.alias(k) for k, v in business_flags().items()])


@query("SELECT row_id, coalesce(useful, 0) + coalesce(funny, 0) + coalesce(cool, 0) AS total_votes, coalesce(review_count >= 100 AND average_stars >= 4, false) AS elite_candidate FROM yelp_user")
def user_model(spark, d):
    return load(spark, d, "yelp_user").select("row_id", *[v.alias(k) for k, v in user_flags().items()])


@query(f"SELECT row_id, CAST(len(list_filter(list_transform(string_split(coalesce(date, ''), ','), lambda x: {_strip('x')}), lambda x: x <> '')) AS INTEGER) AS checkin_count FROM yelp_checkin")
def checkin_model(spark, d):
    return load(spark, d, "yelp_checkin").select("row_id", *[v.alias(k) for k, v in checkin_flags().items()])


@query("SELECT r_regionkey, '{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}' AS record FROM region")
def record_to_json(spark, d):
    return load(spark, d, "region").select("r_regionkey", record_json("r_regionkey", "r_name").alias("record"))


@query(r"""SELECT row_id, coalesce(length(review_id) >= 1, false) AND coalesce(length(user_id) >= 1, false) AND coalesce(length(business_id) >= 1, false) AND coalesce(stars, 0) BETWEEN 1 AND 5
    AND coalesce(useful, 0) >= 0 AND coalesce(funny, 0) >= 0 AND coalesce(cool, 0) >= 0 AND (coalesce(date, '') = '' OR regexp_full_match(date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')) AS ok FROM yelp_review""")
def review_constraints(spark, d):
    return load(spark, d, "yelp_review").select("row_id", VALID["review"]().alias("ok"))


# ---- transformations --------------------------------------------------------------------------------------


@query("SELECT c_custkey AS id, c_mktsegment AS segment FROM customer")
def rename_whitelist(spark, d):
    return transform.rename_fields(load(spark, d, "customer"), {"c_custkey": "id", "c_mktsegment": "segment"}, drop_missing=True)


@query("SELECT row_id, TRY_CAST(date AS DATE) AS day FROM (SELECT row_id, CASE WHEN regexp_full_match(date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN date END AS date FROM yelp_review)")
def coerce_dates(spark, d):
    df = load(spark, d, "yelp_review").select("row_id", F.when(validate.valid_date(F.col("date")), F.col("date")).alias("day"))
    return transform.coerce_types(df, {"day": "date"}).select("row_id", "day")


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, o_totalprice + 1 AS plus_one FROM orders")
def computed_fields(spark, d):
    p = F.col("o_totalprice")
    return transform.add_computed(load(spark, d, "orders").select("o_orderkey", "o_totalprice"), {"o_totalprice": p * 2, "plus_one": p + 1})


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'tap' WHEN 'view' THEN NULL ELSE event_type END AS event_type FROM events")
def mapped_values(spark, d):
    return transform.map_values(load(spark, d, "events").select("event_id", "event_type"), "event_type", {"click": "tap", "view": None})


@query("SELECT s_suppkey, s_name FROM supplier")
def dropped_fields(spark, d):
    return transform.drop_fields(load(spark, d, "supplier"), ["s_nationkey", "s_acctbal", "not_there"])


@query(f"SELECT row_id, {_strip('lower(coalesce(name, ' + chr(39) * 2 + '))')} AS name, CASE WHEN stars IS NULL THEN 0.0 ELSE greatest(1.0, least(5.0, stars)) END AS stars FROM yelp_business")
def normalised_fields(spark, d):
    df = load(spark, d, "yelp_business").select("row_id", "name", "stars")
    return transform.normalise_fields(df, {"name": [normalize.lowercase_strip], "stars": [normalize.normalise_stars]})


@query(f"""SELECT doc_id, regexp_replace(coalesce(lang, ''), '[{_WS}\\-().+]', '', 'g') AS phone, CASE WHEN regexp_full_match({_strip("coalesce(source, '')")}, '[+-]?[0-9]+') THEN 1 ELSE 0 END AS number,
    coalesce(TRY_CAST(n_chars AS DOUBLE), 0.0) AS chars FROM documents""")
def normaliser_functions(spark, d):
    return load(spark, d, "documents").select("doc_id", normalize.normalise_phone(F.col("lang")).alias("phone"), normalize.to_int(F.col("source")).cast("int").alias("number"), normalize.to_float(F.col("n_chars")).alias("chars"))


@query("SELECT row_id, stars FROM yelp_review WHERE coalesce(stars, 0) >= 4 AND coalesce(useful >= 1, false)")
def filtered_reviews(spark, d):
    df = load(spark, d, "yelp_review").select("row_id", "stars", "useful")
    return transform.keep_if(transform.min_stars(df, 4), [F.col("useful") >= 1]).select("row_id", "stars")


@query("SELECT row_id, stars FROM yelp_review WHERE coalesce(stars, 0) >= 3 ORDER BY row_id LIMIT 100")
def first_records(spark, d):
    """The first records of a pipeline, by arrival (the limit is the feature)."""
    return transform.min_stars(load(spark, d, "yelp_review").select("row_id", "stars"), 3).orderBy("row_id").limit(100)


# ---- joins -----------------------------------------------------------------------------------------------

_LOOKUP = "lk AS (SELECT business_id AS k, name AS b_name, city AS b_city, stars AS b_stars FROM (SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY row_id DESC) AS rn FROM yelp_business WHERE business_id IS NOT NULL) WHERE rn = 1)"


def _lookup(spark, d) -> DataFrame:
    b = load(spark, d, "yelp_business").select("business_id", "name", "city", "stars", "row_id")
    return joins.lookup(b, "business_id", ["row_id"]).drop("row_id")


@query(f"WITH {_LOOKUP} SELECT row_id, business_id, stars, b_name AS name, b_city AS city FROM yelp_review LEFT JOIN lk ON business_id = k")
def lookup_left(spark, d):
    """``stars`` is in both: the left value stays."""
    return joins.lookup_join(load(spark, d, "yelp_review").select("row_id", "business_id", "stars"), _lookup(spark, d), "business_id")


@query(f"WITH {_LOOKUP} SELECT row_id, business_id, stars, b_name, b_city, b_stars FROM yelp_review JOIN lk ON business_id = k")
def lookup_inner(spark, d):
    return joins.lookup_join(load(spark, d, "yelp_review").select("row_id", "business_id", "stars"), _lookup(spark, d), "business_id", prefix="b_", how="inner")


@query(f"WITH {_LOOKUP} SELECT row_id, business_id FROM yelp_review ANTI JOIN lk ON business_id = k")
def lookup_anti(spark, d):
    return joins.lookup_anti(load(spark, d, "yelp_review").select("row_id", "business_id"), _lookup(spark, d), "business_id")


@query(f"""WITH {_LOOKUP}, m AS (SELECT business_id AS mk, row_id, useful FROM (SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY row_id DESC) AS rn FROM yelp_review WHERE business_id IS NOT NULL) WHERE rn = 1)
    SELECT k AS business_id, b_name AS name, b_city AS city, b_stars AS stars, row_id, useful FROM lk LEFT JOIN m ON k = mk""")
def lookup_right(spark, d):
    left = load(spark, d, "yelp_review").select("row_id", "business_id", "stars", "useful")
    return joins.lookup_right(left, _lookup(spark, d), "business_id", ["row_id"])


@query("SELECT l_returnflag, n_name, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2")
def warehouse_join(spark, d):
    li, s, n = load(spark, d, "lineitem"), load(spark, d, "supplier"), load(spark, d, "nation")
    joined = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("l_returnflag", "n_name").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


# ---- aggregates -------------------------------------------------------------------------------------------

_STATS = f"""SELECT business_id, count(*) AS review_count, sum({_STARS}) / count(*) AS average_stars, CAST(sum(coalesce(useful, 0)) AS BIGINT) AS useful_sum,
    count(*) FILTER ({_STARS} >= 4) AS positive_count, count(*) FILTER ({_STARS} <= 2) AS negative_count"""
_HAVING_KEY = "FROM yelp_review WHERE business_id IS NOT NULL AND business_id <> '' GROUP BY 1"


@query(f"{_STATS} {_HAVING_KEY}")
def business_stats(spark, d):
    return aggregate.business_stats(load(spark, d, "yelp_review"))


@query(f"{_STATS} {_HAVING_KEY}")
def merged_stats(spark, d):
    """Partial sums of two halves, merged."""
    r = load(spark, d, "yelp_review")
    return aggregate.merge_business_stats(aggregate.partial_business_stats(r.filter("row_id % 2 = 0")), aggregate.partial_business_stats(r.filter("row_id % 2 = 1")))


@query(f"SELECT business_id, review_count, round(average_stars, 3) AS average_stars, useful_sum, positive_count, negative_count FROM ({_STATS} {_HAVING_KEY}) WHERE business_id = (SELECT max(business_id) FROM yelp_business)")
def business_lookup(spark, d):
    """The stats of one business, the one with the greatest id."""
    stats, last = aggregate.business_stats(load(spark, d, "yelp_review")), load(spark, d, "yelp_business").agg(F.max("business_id")).first()[0]
    return aggregate.rounded_stats(aggregate.one_business(stats, last))


@query(f"SELECT * FROM ({_STATS}, min(row_id) AS first_ord {_HAVING_KEY}) WHERE review_count >= 5 ORDER BY average_stars DESC, first_ord LIMIT 10")
def top_businesses(spark, d):
    return aggregate.top_businesses(aggregate.business_stats(load(spark, d, "yelp_review"), order="row_id"))


@query(f"SELECT * FROM ({_STATS}, min(row_id) AS first_ord {_HAVING_KEY}) WHERE review_count >= 3 AND average_stars BETWEEN 2.5 AND 4.5")
def filter_businesses(spark, d):
    return aggregate.filter_businesses(aggregate.business_stats(load(spark, d, "yelp_review"), order="row_id"), 3, 2.5, 4.5)


@query(f"SELECT {_KEY} AS star, count(*) AS n FROM yelp_review GROUP BY 1")
def star_histogram(spark, d):
    return aggregate.star_histogram(load(spark, d, "yelp_review"))


@query(f"""WITH k AS (SELECT CAST({_KEY} AS DOUBLE) AS k FROM yelp_review) SELECT count(*) AS total_records, avg(k) AS mean_stars, median(k) AS median_stars, stddev_pop(k) AS stddev_stars,
    quantile_cont(k, 0.25) AS p25, quantile_cont(k, 0.75) AS p75, quantile_cont(k, 0.9) AS p90 FROM k""")
def star_summary(spark, d):
    return aggregate.star_summary(load(spark, d, "yelp_review"))


@query(f"""WITH s AS (SELECT business_id, count(*) AS c {_HAVING_KEY}) SELECT (SELECT count(*) FROM yelp_review) AS total_reviews, count(*) AS unique_businesses, round(avg(c), 2) AS avg_reviews_per_business FROM s""")
def report_summary(spark, d):
    r = load(spark, d, "yelp_review")
    return aggregate.report_summary(aggregate.business_stats(r), r)


@query("SELECT count(*) AS n, avg(value) AS mean, min(value) AS lo, max(value) AS hi, arg_max(value, (ts, event_id)) AS latest FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)")
def series_summary(spark, d):
    return aggregate.series_summary(load(spark, d, "events"), "ts", "value", "event_id")


@query("SELECT event_id, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS rolling FROM events")
def rolling_mean(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-9, 0)
    return load(spark, d, "events").select("event_id", F.avg("value").over(w).alias("rolling"))


# ---- warehouse analytics -----------------------------------------------------------------------------------


def _flat(spark, d):
    r = load(spark, d, "yelp_review").select("business_id", "user_id", F.when(validate.valid_date(F.col("date")), F.col("date")).try_cast("date").alias("review_date"), F.when(F.col("stars") >= 4, "Positive").when(F.col("stars") <= 2, "Negative").otherwise("Neutral").alias("sentiments"))
    b = _lookup(spark, d).join(joins.lookup(load(spark, d, "yelp_business").select("business_id", "categories", "row_id"), "business_id", ["row_id"]).drop("row_id"), "business_id")
    return r, b


_FLAT = """b AS (SELECT business_id, name, city, categories FROM (SELECT *, row_number() OVER (PARTITION BY business_id ORDER BY row_id DESC) AS rn FROM yelp_business WHERE business_id IS NOT NULL) WHERE rn = 1),
    r AS (SELECT business_id, user_id, TRY_CAST(CASE WHEN regexp_full_match(date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN date END AS DATE) AS review_date,
    CASE WHEN stars >= 4 THEN 'Positive' WHEN stars <= 2 THEN 'Negative' ELSE 'Neutral' END AS sentiments FROM yelp_review)"""


@query(f"WITH {_FLAT} SELECT user_id, count(*) AS n FROM r JOIN b USING (business_id) WHERE categories ILIKE '%bars%' GROUP BY 1 ORDER BY n DESC, user_id NULLS FIRST LIMIT 10")
def top_users_by_category(spark, d):
    return warehouse.top_users_by_category(*_flat(spark, d), "bars")


@query(f"WITH {_FLAT} SELECT city, sentiments, count(*) AS n FROM r JOIN b USING (business_id) GROUP BY 1, 2")
def labels_by_city(spark, d):
    return warehouse.labels_by_city(*_flat(spark, d))


@query(f"WITH {_FLAT} SELECT CAST(date_trunc('month', review_date) AS DATE) AS month, count(*) AS n FROM r GROUP BY 1")
def monthly_counts(spark, d):
    return warehouse.monthly_counts(_flat(spark, d)[0])


@query(f"WITH {_FLAT} SELECT name, city, count(*) AS n FROM r JOIN b USING (business_id) WHERE sentiments = 'Positive' GROUP BY 1, 2 ORDER BY n DESC, name NULLS FIRST, city NULLS FIRST LIMIT 10")
def top_positive(spark, d):
    return warehouse.top_by_label(*_flat(spark, d), "sentiments", "Positive")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def variant_extract(spark, d):
    raw = load(spark, d, "events").select("event_id", F.try_parse_json("props").alias("v"))
    return raw.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"))


@query("SELECT row_id, CAST(floor(stars + 0.5) AS DOUBLE) AS whole FROM yelp_review")
def whole_stars(spark, d):
    """Ratings as a number type without scale holds them."""
    return load(spark, d, "yelp_review").select("row_id", F.col("stars").cast("decimal(38,0)").cast("double").alias("whole"))


# ---- dedup, sampling, partitioning ------------------------------------------------------------------------


@query("SELECT review_id, row_id, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY review_id ORDER BY row_id) AS rn FROM yelp_review) WHERE rn = 1")
def dedup_first(spark, d):
    return dedup.dedup_first(load(spark, d, "yelp_review").select("review_id", "row_id", "loaded_at"), ["review_id"], ["row_id"])


@query("SELECT count(*) AS seen, count(DISTINCT user_id || '|' || event_type) AS \"unique\", count(*) - count(DISTINCT user_id || '|' || event_type) AS dropped FROM events")
def dedup_counts(spark, d):
    return dedup.dedup_stats(load(spark, d, "events"), ["user_id", "event_type"])


@query("SELECT event_id FROM events ORDER BY md5('7-' || event_id), event_id LIMIT 500")
def reservoir_sample(spark, d):
    return sampling.reservoir(load(spark, d, "events").select("event_id"), 500, "event_id", 7)


@query("""SELECT event_id, event_type FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('7-' || event_id), event_id) AS rn,
    count(*) OVER (PARTITION BY event_type) AS c FROM events) WHERE rn <= greatest(1, CAST(round_even(c * 0.1, 0) AS BIGINT))""")
def stratified_sample(spark, d):
    return sampling.stratified(load(spark, d, "events").select("event_id", "event_type"), "event_type", 0.1, "event_id", 7)


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1")
def strata_counts(spark, d):
    return sampling.strata_counts(load(spark, d, "documents"), "source")


@query()
def bernoulli_sample(spark, d):
    return sampling.bernoulli(load(spark, d, "events"), 0.5, 7)


_SPLIT = "WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rn, count(*) OVER () AS c FROM documents), s AS (SELECT doc_id, CAST(least(rn // (c // 7), 6) AS INTEGER) AS chunk FROM n)"


@query(f"{_SPLIT} SELECT doc_id, chunk FROM s")
def split_chunks(spark, d):
    return partitioning.split_chunks(load(spark, d, "documents").select("doc_id"), ["doc_id"], 7)


@query(f"""WITH n AS (SELECT row_id, text, row_number() OVER (ORDER BY row_id) - 1 AS rn, count(*) OVER () AS c FROM yelp_review)
    SELECT row_id, md5(text) AS digest, CAST(least(rn // (c // 7), 6) AS INTEGER) AS chunk FROM n""")
def split_records(spark, d):
    """Whole records with their chunk."""
    df = load(spark, d, "yelp_review").select("row_id", "text", "stars", "date")
    return partitioning.split_chunks(df, ["row_id"], 7).select("row_id", F.md5("text").alias("digest"), "chunk")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS rn FROM lineitem")
def numbered(spark, d):
    """Rows of many columns numbered in a total order."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return partitioning.with_row_number(load(spark, d, "lineitem"), order).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "rn")


@query(f"{_SPLIT} SELECT chunk, count(*) AS lines FROM s GROUP BY 1")
def split_plan(spark, d):
    return partitioning.split_plan(load(spark, d, "documents").select("doc_id"), ["doc_id"], 7)


@query("SELECT coalesce(source, '__other__') AS partition_key, count(*) AS n FROM documents GROUP BY 1")
def partition_sizes(spark, d):
    return partitioning.partition_sizes(load(spark, d, "documents"), F.col("source"))


@query("SELECT doc_id FROM documents WHERE source = 'menu_pages'")
def one_partition(spark, d):
    return partitioning.get_partition(load(spark, d, "documents"), F.col("source"), "menu_pages").select("doc_id")


@query("SELECT key, count(*) AS n FROM (SELECT c_name AS key FROM customer UNION ALL SELECT s_name FROM supplier) GROUP BY 1")
def union_all(spark, d):
    both = load(spark, d, "customer").select(F.col("c_name").alias("key")).unionByName(load(spark, d, "supplier").select(F.col("s_name").alias("key")))
    return both.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


# ---- hashing, validation ------------------------------------------------------------------------------------


@query("SELECT row_id, sha256(text) AS sha, md5(text) AS md FROM yelp_review")
def text_digests(spark, d):
    return load(spark, d, "yelp_review").select("row_id", hashing.sha256_hex(F.col("text")).alias("sha"), hashing.md5_hex(F.col("text")).alias("md"))


@query("SELECT n_nationkey, sha256('{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}') AS fp, left(sha256('{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}'), 8) AS short FROM nation")
def fingerprints(spark, d):
    df, keys = load(spark, d, "nation"), ["n_regionkey", "n_name"]
    return df.select("n_nationkey", hashing.record_fingerprint(df, keys).alias("fp"), hashing.short_id(df, keys).alias("short"))


@query(f"""SELECT row_id, coalesce(stars BETWEEN 1 AND 5, false) AS stars_ok, coalesce(regexp_full_match(date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), false) AS date_ok,
    {_strip("coalesce(business_id, '')")} <> '' AS business_ok, coalesce(regexp_full_match(review_id, '[A-Za-z0-9_\\-]{{1,100}}'), false) AS id_ok, coalesce(length(text) BETWEEN 1 AND 500, false) AS length_ok FROM yelp_review""")
def review_validators(spark, d):
    return load(spark, d, "yelp_review").select(
        "row_id", validate.valid_stars(F.col("stars")).alias("stars_ok"), validate.valid_date(F.col("date")).alias("date_ok"), validate.valid_business_id(F.col("business_id")).alias("business_ok"),
        validate.valid_review_id(F.col("review_id")).alias("id_ok"), validate.valid_length(F.col("text"), 1, 500).alias("length_ok"),
    )


@query("SELECT row_id, coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, false) AS ok FROM yelp_business")
def coordinate_validator(spark, d):
    return load(spark, d, "yelp_business").select("row_id", validate.valid_coordinates(F.col("latitude"), F.col("longitude")).alias("ok"))


_SPECS = [validate.FieldSpec("p_name", "str", min_length=1), validate.FieldSpec("p_size", "int", min_value=10, max_value=40), validate.FieldSpec("p_brand", "str", allowed=["Brand#11", "Brand#12", "Brand#13"])]
_ERRORS = """list_filter([CASE WHEN p_name IS NULL THEN 'p_name: required field is missing' END, CASE WHEN length(p_name) < 1 THEN 'p_name: shorter than 1' END,
    CASE WHEN p_size IS NULL THEN 'p_size: required field is missing' END, CASE WHEN p_size < 10 THEN 'p_size: below 10' END, CASE WHEN p_size > 40 THEN 'p_size: above 40' END,
    CASE WHEN p_brand IS NULL THEN 'p_brand: required field is missing' END, CASE WHEN p_brand NOT IN ('Brand#11', 'Brand#12', 'Brand#13') THEN 'p_brand: value not allowed' END], lambda x: x IS NOT NULL)"""


def _part_records(spark, d) -> DataFrame:
    return load(spark, d, "part").select("p_partkey", F.parse_json(record_json("p_name", "p_size", "p_brand")).alias("record"))


@query(f"SELECT p_partkey, {_ERRORS} AS errors FROM part")
def schema_errors(spark, d):
    return _part_records(spark, d).select("p_partkey", validate.schema_errors(F.col("record"), _SPECS).alias("errors"))


@query(f"SELECT p_partkey FROM part WHERE len({_ERRORS}) = 0")
def valid_records(spark, d):
    return validate.filter_valid(_part_records(spark, d), "record", _SPECS).select("p_partkey")


@query("""SELECT event_id, list_filter([CASE WHEN k < 2 THEN 'tags: shorter than 2' END, CASE WHEN k > 5 THEN 'tags: longer than 5' END, CASE WHEN event_type NOT IN ('click', 'view') THEN 'kind: value not allowed' END], lambda x: x IS NOT NULL) AS errors
    FROM (SELECT event_id, event_type, event_id % 8 AS k FROM events)""")
def list_schema_errors(spark, d):
    """A list's length is its number of elements."""
    e = load(spark, d, "events").select("event_id", "event_type")
    tags = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.when(i <= F.col("event_id") % 8, i))
    record = F.parse_json(F.to_json(F.struct(F.array_compact(tags).alias("tags"), F.col("event_type").alias("kind"))))
    specs = [validate.FieldSpec("tags", "list", min_length=2, max_length=5), validate.FieldSpec("kind", "str", allowed=["click", "view"])]
    return e.select("event_id", validate.schema_errors(record, specs).alias("errors"))


@query("SELECT row_id, review_id IS NOT NULL AND user_id IS NOT NULL AND coalesce(stars BETWEEN 1 AND 5, false) AS ok FROM yelp_review")
def review_records(spark, d):
    """Records with their required fields and a rating; a null key is written as no field here, an absent business_id isn't."""
    r = load(spark, d, "yelp_review").select("row_id", "review_id", "user_id", "business_id", "stars")
    some = F.to_json(F.struct("review_id", "user_id", "stars"))
    record = F.parse_json(F.concat(F.regexp_replace(some, r"\}$", F.when(some == "{}", "").otherwise(",")), F.lit('"business_id":null}')))
    return r.select("row_id", validate.valid_review_record(record).alias("ok"))


@query("""WITH v AS (SELECT count(*) AS total, count(*) FILTER (stars BETWEEN 1 AND 5) AS valid FROM yelp_review)
    SELECT total, valid, total - valid AS invalid, CAST(valid AS DOUBLE) / total AS valid_rate, 1 - CAST(valid AS DOUBLE) / total AS error_rate FROM v""")
def validation_metrics(spark, d):
    return validate.validation_metrics(load(spark, d, "yelp_review"), validate.valid_stars(F.col("stars")))


# ---- sentiment ---------------------------------------------------------------------------------------------

_LEX = "list_filter(regexp_split_to_array(" + _strip(f"lower(regexp_replace(coalesce(text, ''), '{_PUNCT_SQL}', ' ', 'g'))") + f", '[{_WS}]+'), lambda w: w <> '')"
_GOOD = "['good', 'great', 'excellent', 'superb', 'lovely', 'charming', 'delightful', 'perfect', 'fresh', 'friendly', 'best', 'love', 'loved', 'nice', 'polished', 'memorable', 'thoughtful', 'flawless']"
_BAD = "['bad', 'awful', 'terrible', 'horrible', 'worst', 'sour', 'soggy', 'bland', 'burnt', 'stale', 'rude', 'dirty', 'slow', 'overpriced', 'mediocre', 'greasy', 'chaotic', 'careless']"
_POLARITY = f"""s AS (SELECT row_id, source, len(list_filter(w, lambda x: list_contains({_GOOD}, x))) AS g, len(list_filter(w, lambda x: list_contains({_BAD}, x))) AS b, len(w) AS n FROM (SELECT row_id, source, {_LEX} AS w FROM yelp_review)),
    p AS (SELECT row_id, source, CASE WHEN g + b > 0 THEN CAST(CAST(g AS BIGINT) - CAST(b AS BIGINT) AS DOUBLE) / (g + b) ELSE 0.0 END AS polarity, CASE WHEN n > 0 THEN CAST(g + b AS DOUBLE) / n ELSE 0.0 END AS subjectivity FROM s)"""
_LABEL = "CASE WHEN polarity > 0.1 THEN 'positive' WHEN polarity < -0.1 THEN 'negative' ELSE 'neutral' END"


@query(f"WITH {_POLARITY} SELECT row_id, polarity AS sentiment_polarity, subjectivity AS sentiment_subjectivity, {_LABEL} AS sentiment_label FROM p")
def lexicon_sentiment(spark, d):
    return sentiment.enrich(_texts(spark, d, "yelp_review").select("row_id", "text"), backend="lexicon").drop("text")


@query(f"WITH {_POLARITY} SELECT row_id, round(polarity, 4) AS polarity, round(subjectivity, 4) AS subjectivity, {_LABEL} AS label FROM p")
def sentiment_results(spark, d):
    """Results as they are shown, to four places."""
    r = _texts(spark, d, "yelp_review").select("row_id", sentiment.result(F.col("text"), "lexicon").alias("r"))
    return r.select("row_id", "r.polarity", "r.subjectivity", "r.label")


@query(f"WITH {_POLARITY} SELECT {_LABEL} AS label, count(*) AS n FROM p GROUP BY 1")
def label_histogram(spark, d):
    return aggregate.label_histogram(sentiment.enrich(_texts(spark, d, "yelp_review").select("text"), backend="lexicon"))


@query(f"WITH {_POLARITY} SELECT count(*) AS total, count(*) FILTER (polarity > 0.1) AS positive, count(*) FILTER (polarity < -0.1) AS negative, count(*) FILTER (polarity BETWEEN -0.1 AND 0.1) AS neutral FROM p")
def label_counts(spark, d):
    return sentiment.label_counts(sentiment.enrich(_texts(spark, d, "yelp_review").select("text"), backend="lexicon"))


@query("SELECT source, 'Neutral' AS label, count(*) AS n FROM yelp_review GROUP BY 1")
def warehouse_labels(spark, d):
    """The defined result without a sentiment library."""
    p = sentiment.sentiment(F.col("text"), "neutral")["polarity"]
    return load(spark, d, "yelp_review").select("source", sentiment.warehouse_label(p).alias("label")).groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_POLARITY} SELECT source, CASE WHEN polarity > 0 THEN 'Positive' WHEN polarity < 0 THEN 'Negative' ELSE 'Neutral' END AS label, count(*) AS n FROM p GROUP BY 1, 2")
def warehouse_lexicon_labels(spark, d):
    """The warehouse labels of the texts themselves, by the lexicon."""
    p = sentiment.sentiment(F.col("text"), "lexicon")["polarity"]
    return load(spark, d, "yelp_review").select("source", sentiment.warehouse_label(p).alias("label")).groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"))


# ---- derived views, generator --------------------------------------------------------------------------------


@query("""SELECT CAST(l_suppkey AS VARCHAR) AS business_id, n_name AS city, count(*) AS n, avg(CAST(1 + (CAST(l_quantity AS INTEGER) % 9) / 2.0 AS DOUBLE)) AS mean FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""")
def derived_reviews(spark, d):
    joined = reviews_v(spark, d).join(businesses_v(spark, d).select("business_id", "city"), "business_id")
    return joined.groupBy("business_id", "city").agg(F.count(F.lit(1)).alias("n"), F.avg("stars").alias("mean"))


@query("SELECT i AS id, 'This is synthetic review number ' || i || ' for benchmarking purposes.' AS text, i % 5 + 1 AS stars, i % 3 AS useful, i % 2 AS funny, i % 4 AS cool FROM range(1000) t(i)")
def synthetic_reviews(spark, d):
    return synthetic(spark, 1000)
