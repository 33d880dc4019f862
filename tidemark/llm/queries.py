"""Queries of the text problems over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import canonical, encode, mixing, neardup, pii, prose, toxicity
from tidemark.session import spread
from tidemark.sources.tables import load


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_pii(load(spark, d, "yelp_review"), "review_id", "text", pii.given_names(load(spark, d, "yelp_user"), "name"))


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every delivery of a review with typed placeholders in its text."""
    return spread(load(spark, d, "yelp_review").select("row_id", "review_id", "text")).select("row_id", "review_id", pii.redact(F.col("text"), pii.given_names(load(spark, d, "yelp_user"), "name")).alias("text"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.linked_pairs(load(spark, d, "yelp_review"), "review_id", "text")
    return pairs.select(F.col("key_a").alias("review_id_a"), F.col("key_b").alias("review_id_b"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct review with its group and its number of links."""
    return neardup.groups(load(spark, d, "yelp_review"), "review_id", "text").withColumnRenamed("key", "review_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    mapped = canonical.map_rows(load(spark, d, "yelp_business"), "business_id", "city", "state", load(spark, d, "city_ref"), "city_id", "city", "state")
    return mapped.select("business_id", F.col("entry").cast("int").alias("city_id"))


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that no entry was found for, and how many businesses have them."""
    rows = load(spark, d, "yelp_business")
    mapped = canonical.map_to_reference(rows, "city", "state", load(spark, d, "city_ref"), "city_id", "city", "state")
    lost = mapped.filter(F.col("entry") == canonical.UNMATCHED).select("value").distinct()
    return rows.select("business_id", F.col("city").alias("value")).join(lost, "value").groupBy("value").agg(F.countDistinct("business_id").alias("n"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """One row per distinct review with its source and score. Deliveries repeat a review's text, so any row's score is the
    review's; a review delivered by several sources counts for the least of their names."""
    rows, labels = load(spark, d, "yelp_review"), load(spark, d, "review_label")
    model = toxicity.train(*toxicity.sample(rows, "review_id", "text", labels, "review_id", "toxic"))
    return toxicity.score(rows, ["review_id", "source"], "text", model).filter(F.col("review_id").isNotNull())


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).filter(F.col("score") > toxicity.THRESHOLD).select("review_id").distinct()


def p7_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).groupBy("review_id").agg(F.min("source").alias("source"), F.max("score").alias("score"))


def p7_rates(spark: SparkSession, d: str) -> DataFrame:
    """Per source: distinct reviews, how many are over the threshold, and the rate."""
    flagged = F.col("score") > toxicity.THRESHOLD
    return p7_scores(spark, d).groupBy("source").agg(
        F.count(F.lit(1)).alias("reviews"), F.count_if(flagged).alias("toxic"), F.avg(flagged.cast("double")).alias("rate"), F.avg("score").alias("mean_score")
    )


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_table(load(spark, d, "documents"), "doc_id", "text")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The selected documents, the source each stands for, its uses and its tokens."""
    return mixing.select_mix(load(spark, d, "documents"), "doc_id", "text", "source", load(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(p9_mix(spark, d), load(spark, d, "mix_target"))


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return prose.classify(load(spark, d, "documents"), "doc_id", "text", "lang", load(spark, d, "common_word"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _classified(spark, d).filter(F.col("kind") != "prose").select("doc_id", "kind")


def p10_stats(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its statistics, distance and the contribution of each statistic to it."""
    parts = [F.col("contribution")[i].alias(f"from_{s}") for i, s in enumerate(prose.STATS)]
    return _classified(spark, d).select("doc_id", "language", "words", *prose.STATS, "distance", *parts, "kind")


QUERIES = {f.__name__: f for f in (p2_found, p2_redacted, p3_found, p3_groups, p4_found, p4_unmatched, p7_found, p7_scores, p7_rates, p8_ids, p9_mix, p9_shares, p10_found, p10_stats)}
_PAIRS = r"""t AS (SELECT DISTINCT review_id, text FROM yelp_review WHERE review_id IS NOT NULL AND text IS NOT NULL),
    s AS (SELECT review_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS ws FROM t), l AS (SELECT review_id, ws, len(ws) AS n FROM s WHERE len(ws) >= 60),
    e AS (SELECT review_id, n, unnest(ws) AS w FROM l),
    pairs AS (SELECT a.review_id AS review_id_a, b.review_id AS review_id_b FROM e a JOIN e b ON a.w = b.w AND a.review_id < b.review_id GROUP BY 1, 2, a.n, b.n HAVING count(*) >= 0.75 * least(a.n, b.n) - 1e-9)"""
SQL: dict[str, str] = {
    "p3_found": f"WITH {_PAIRS} SELECT DISTINCT review_id_a, review_id_b FROM pairs",
    "p3_groups": f"""WITH RECURSIVE {_PAIRS}, ways AS (SELECT review_id_a AS x, review_id_b AS y FROM pairs UNION SELECT review_id_b, review_id_a FROM pairs),
        r AS (SELECT x, y FROM ways UNION SELECT r.x, ways.y FROM r JOIN ways ON r.y = ways.x)
        SELECT k.review_id, coalesce(g.least, k.review_id) AS group_id, coalesce(c.links, 0) AS links FROM (SELECT DISTINCT review_id FROM yelp_review WHERE review_id IS NOT NULL) k
        LEFT JOIN (SELECT x, least(x, min(y)) AS least FROM r GROUP BY 1) g ON g.x = k.review_id LEFT JOIN (SELECT x, count(*) AS links FROM ways GROUP BY 1) c ON c.x = k.review_id""",
}
