"""Command line: ``python -m tidemark.cli.main COMMAND``: run, sentiment, report, dedup, partition, validate, split, bench."""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.sentiment import NEGATIVE, POSITIVE, enrich
from tidemark.functions.text import clean_text, cleaner_counters
from tidemark.functions.validate import jsonl_syntax_errors, missing_fields
from tidemark.operators import aggregate, dedup, partitioning, transform
from tidemark.session import build_session
from tidemark.sinks import writers
from tidemark.sources.jsonl import numbered_lines, read_jsonl, size_mb, synthetic
from tidemark.support import RunMetrics

# Names of the report's sections.
SECTIONS = ("summary", "star_distribution", "top_businesses")


def run_pipeline(spark: SparkSession, source: str, target: str, fmt: str = "jsonl", min_stars: float | None = None, sample_rate: float = 1.0, seed: int | None = None, max_records: int | None = None, backend: str = "auto") -> dict:
    """Scan, filter, sample, clean, add sentiment, write. Counts come from the job that writes, by observation, so they
    are of the rows written (with ``max_records``, those read are counted before). ``max_records`` keeps the first records in the order of the input."""
    start = time.perf_counter()
    out_path = f"{target}/pipeline_output.{fmt.lower().lstrip('.')}"
    read, cleaned = Observation(), Observation()
    rows = read_jsonl(spark, source, schemas.REVIEW, place=True)
    if min_stars is not None:
        rows = transform.min_stars(rows, min_stars)
    rows = transform.process(rows, sample_rate=sample_rate, seed=seed)
    if max_records is None:
        rows = rows.observe(read, F.count(F.lit(1)).alias("n"))
    else:
        total = rows.count()  # rows before the limit may be scanned twice, which an observation would count twice
        rows = rows.orderBy("__place").limit(max_records)
    both = rows.drop("__place").withColumn("__raw", F.col("text")).withColumn("text", clean_text(F.col("text")))
    out = enrich(both.observe(cleaned, F.count(F.lit(1)).alias("n"), *cleaner_counters(F.col("__raw"), F.col("text"))), backend=backend).drop("__raw")
    writers.export(out, out_path, fmt)
    stats = dict(cleaned.get)
    written = stats.pop("n")
    return {"input": source, "output": out_path, "records_read": read.get["n"] if max_records is None else total, "records_written": written, "elapsed_sec": round(time.perf_counter() - start, 3), "workers": spark.sparkContext.defaultParallelism, "cleaner_stats": stats}


def build_report(rows: DataFrame, top_n: int = 10, sections: tuple[str, ...] = SECTIONS) -> dict:
    """Sections of the report, each from one aggregate."""
    stats = aggregate.business_stats(rows.withColumn("__ord", F.monotonically_increasing_id()), order="__ord")
    out: dict = {}
    if "summary" in sections:
        whole = aggregate.report_summary(stats, rows).first()
        labels = rows if "sentiment_label" in rows.columns else rows.withColumn("sentiment_label", F.lit(None).cast("string"))
        counts = {r["label"]: r["n"] for r in aggregate.label_histogram(labels).orderBy("label").collect()}
        out["summary"] = {"total_records": whole["total_reviews"], "unique_businesses": whole["unique_businesses"], "average_reviews_per_business": whole["avg_reviews_per_business"], "sentiment_counts": counts}
    if "star_distribution" in sections:
        out["star_distribution"] = {r["star"]: r["n"] for r in aggregate.star_histogram(rows).orderBy("star").collect()}
    if "top_businesses" in sections:
        out["top_businesses"] = [r.asDict() for r in aggregate.rounded_stats(aggregate.top_businesses(stats, top_n)).collect()]
    return out


def _table(head: tuple[str, str], rows) -> list[str]:
    bars = "|" + "|".join("-" * (len(h) + 2) for h in head) + "|"
    return [f"| {head[0]} | {head[1]} |", bars, *(f"| {k} | {v} |" for k, v in rows), ""]


def markdown(report: dict) -> str:
    """The report as Markdown; sections that aren't in it are left out."""
    lines = ["# Pipeline Report", ""]
    if whole := report.get("summary"):
        metrics = {"Total records": "total_records", "Unique businesses": "unique_businesses", "Avg reviews/business": "average_reviews_per_business"}
        lines += ["## Summary", "", *_table(("Metric", "Value"), [(title, whole[k]) for title, k in metrics.items()])]
        lines += ["### Sentiment Counts", "", *_table(("Sentiment", "Count"), whole["sentiment_counts"].items())]
    if "star_distribution" in report:
        lines += ["## Star Distribution", "", *_table(("Stars", "Count"), sorted(report["star_distribution"].items()))]
    if "top_businesses" in report:
        lines += ["## Top Businesses", "", *(f"- **{b['business_id']}**: {b['review_count']} reviews, avg {b['average_stars']:.2f} stars" for b in report["top_businesses"])]
    return "\n".join(lines) + "\n"


def first_lines(lines: DataFrame, fields: list[str] | None) -> DataFrame:
    """Lines of JSON with ``k``, what tells records apart: their values, whatever the order of keys or the spacing, with
    their types (``1``, ``1.0`` and ``"1"`` differ). A field that is missing counts as null; lines that are no JSON are left out."""
    parsed = lines.withColumn("v", F.try_parse_json("value")).filter(F.col("v").isNotNull())
    parts = [F.try_variant_get("v", f"$.{k}", "variant") for k in fields] if fields else [F.col("v")]
    told = [F.concat_ws(" ", F.coalesce(F.to_json(p), F.lit("null")), F.coalesce(F.schema_of_variant(p), F.lit("VOID"))) for p in parts]
    return parsed.withColumn("k", F.to_json(F.array(*told)))


def analyze(spark: SparkSession, source: str, target: str, text_field: str = "text", positive: float = POSITIVE, negative: float = NEGATIVE, fmt: str = "jsonl", backend: str = "auto") -> dict:
    """Every record of a file with its sentiment, other fields as they are, and the counts of labels, from the job that writes."""
    seen = Observation()
    rows = read_jsonl(spark, source).filter(F.schema_of_variant("record").startswith("OBJECT"))
    scored = enrich(rows.withColumn("__text", F.try_variant_get("record", f"$.{text_field}", "string")), "__text", backend, positive, negative).drop("__text")
    label = F.col("sentiment_label")
    counted = scored.observe(seen, F.count(F.lit(1)).alias("total"), *[F.count_if(label == v).alias(v) for v in ("positive", "negative", "neutral")])
    added = {c: counted[c] for c in ("sentiment_polarity", "sentiment_subjectivity", "sentiment_label")}
    # the fields of an object and those added, in one object
    whole = F.concat(F.regexp_replace(F.to_json("record"), r"\}$", ""), F.when(F.to_json("record") == "{}", "").otherwise(","), F.regexp_replace(F.to_json(F.struct(*[c.alias(n) for n, c in added.items()])), r"^\{", ""))
    if fmt == "json":
        writers.json_array(counted.select(whole.alias("j")), target)
    else:
        counted.select(whole.alias("value")).write.mode("overwrite").text(target)
    return dict(seen.get)


def validate_file(spark: SparkSession, path: str, required: list[str], max_errors: int = 100) -> list[str]:
    """Syntax errors by line; only if there is none, lines that lack required fields."""
    bad = [f"Line {r['line']}: no JSON" for r in jsonl_syntax_errors(spark, path, max_errors).collect()]
    if bad or not required:
        return bad
    parsed = numbered_lines(spark, path).withColumn("v", F.try_parse_json("value")).filter(F.col("v").isNotNull())
    lacking = parsed.withColumn("m", missing_fields(F.col("v"), required)).filter(F.size("m") > 0)
    return [f"Line {r['line']}: missing {', '.join(r['m'])}" for r in lacking.orderBy("line").limit(max_errors).collect()]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, target: bool = True, **extra):
        q = sub.add_parser(name)
        q.add_argument("source")
        if target:
            q.add_argument("target")
        for flag, kw in extra.items():
            q.add_argument("--" + flag.replace("_", "-"), **kw)

    add("run", format={"default": "jsonl"}, min_stars={"type": float}, sample_rate={"type": float, "default": 1.0}, seed={"type": int}, max_records={"type": int}, backend={"default": "auto"})
    add("sentiment", format={"default": "jsonl", "choices": ["jsonl", "json"]}, backend={"default": "auto"}, text_field={"default": "text"}, positive_threshold={"type": float, "default": POSITIVE}, negative_threshold={"type": float, "default": NEGATIVE})
    add("report", False, output={}, format={"default": "json"}, top={"type": int, "default": 10}, sections={"nargs": "*", "default": list(SECTIONS)})
    add("dedup", key_fields={"nargs": "*"}, stats={"action": "store_true"})
    add("partition", field={"default": "stars"})
    add("validate", False, required={"nargs": "*", "default": []}, max_errors={"type": int, "default": 100})
    add("split", chunks={"type": int, "default": 10}, dry_run={"action": "store_true"})
    add("bench", True, records={"type": int, "default": 10_000}, chunks={"type": int, "default": 10})
    return p


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = build_session()
    try:
        if a.command == "run":
            print(json.dumps(run_pipeline(spark, a.source, a.target, a.format, a.min_stars, a.sample_rate, a.seed, a.max_records, a.backend)))
        elif a.command == "sentiment":
            print(json.dumps(analyze(spark, a.source, a.target, a.text_field, a.positive_threshold, a.negative_threshold, a.format, a.backend)))
        elif a.command == "report":
            rows = read_jsonl(spark, a.source, T.StructType([*schemas.REVIEW.fields, T.StructField("sentiment_label", T.StringType())]))
            report = build_report(rows, a.top, tuple(a.sections))
            body = markdown(report) if a.format == "markdown" else json.dumps(report, indent=2)
            if a.output:
                with open(a.output, "w", encoding="utf-8") as f:
                    f.write(body)
            else:
                print(body)
        elif a.command == "dedup":
            keyed = first_lines(numbered_lines(spark, a.source), a.key_fields)
            dedup.dedup_first(keyed.select("line", "value", "k"), ["k"], ["line"]).orderBy("line").select("value").write.mode("overwrite").text(a.target)
            if a.stats:
                print(json.dumps(dedup.dedup_stats(keyed, ["k"]).first().asDict()))
        elif a.command == "partition":
            lines = spark.read.text(a.source).withColumn("v", F.try_parse_json("value")).filter(F.col("v").isNotNull())
            key = partitioning.partition_key(F.try_variant_get("v", f"$.{a.field}", "string"))
            lines.select("value", F.translate(key, "/\\", "__").alias("_key")).write.mode("overwrite").partitionBy("_key").text(a.target)
        elif a.command == "validate":
            errors = validate_file(spark, a.source, a.required, a.max_errors)
            print("\n".join(errors) or "valid")
            return 1 if errors else 0
        elif a.command == "split":
            lines = numbered_lines(spark, a.source)
            if a.dry_run:
                for r in partitioning.split_plan(lines, ["line"], a.chunks).orderBy("chunk").collect():
                    print(r["chunk"], r["lines"])
            else:
                writers.to_chunks(lines, a.target, ["line"], a.chunks)
        elif a.command == "bench":
            writers.to_jsonl(synthetic(spark, a.records), a.source)
            start = time.perf_counter()
            writers.to_chunks(numbered_lines(spark, a.source), a.target, ["line"], a.chunks)
            took = time.perf_counter() - start
            print(json.dumps(RunMetrics("split", a.records, a.records, took, size_mb(a.source, spark)).to_dict()))
        return 0
    except (FileNotFoundError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
