import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.cli import main as cli
from tidemark.plans import warehouse
from tidemark.sinks import writers
from tidemark.sources import jsonl
from tidemark.support import ExpiringCache, LruCache, MaxRetriesExceeded, Profile, RetryConfig, RunMetrics, memory, retry

LINES = ['{"id": 1, "text": "a", "stars": 4.5}', "", "  ", "not json", "null", '{"id": 2, "text": null, "meta": {"x": [1]}}', "[1]"]


@pytest.fixture
def lines(tmp_path):
    p = tmp_path / "in.jsonl"
    p.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(p)


def test_scan(spark, lines):
    assert jsonl.read_jsonl(spark, lines).count() == 3
    with pytest.raises(FileNotFoundError):
        jsonl.read_jsonl(spark, lines + "x")
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, lines, skip_errors=False).collect()
    assert jsonl.read_existing(spark, [lines, lines + "x"]).count() == 3
    assert jsonl.count_lines(spark, lines) == 7 and jsonl.count_newlines(spark, lines) == 7
    with open(lines, "a") as f:
        f.write("tail")
    assert jsonl.count_lines(spark, lines) == 8 and jsonl.count_newlines(spark, lines) == 7


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None), (2, 'q"', "x")], "a int, b string, c string")
    assert writers.export(df, str(tmp_path / "o"), ".JSONL") == 2
    assert spark.read.json(str(tmp_path / "o")).count() == 2
    assert writers.to_json(df, str(tmp_path / "r" / "o.json")) == 2
    assert json.loads((tmp_path / "r" / "o.json").read_text())[0] == {"a": 1, "b": "é", "c": None}
    writers.export(df, str(tmp_path / "c"), "csv", fields=["b", "zz"])
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).columns == ["b", "zz"]
    writers.to_partitions(df, str(tmp_path / "p"), "c")
    assert {x.name for x in (tmp_path / "p").iterdir() if x.is_dir()} == {"_key=x", "_key=__other__"}
    with pytest.raises(ValueError):
        writers.export(df, "x", "xml")


def test_warehouse(spark, tmp_path):
    p = tmp_path / "raw.json"
    p.write_text('{"business_id":"b","date":"2018-07-07 22:09:11","user_id":"u","stars":4.5,"text":"t"}\nbroken\n')
    flat = warehouse.flatten_reviews(warehouse.load_raw(spark, str(p)), "neutral", whole_stars=True).collect()
    assert str(flat[0]["review_date"]) == "2018-07-07" and flat[0]["review_stars"] == 5 and flat[1]["business_id"] is None
    assert not warehouse.table_exists(spark, "no_such_table")


def test_cli(spark, tmp_path, capsys):
    src = tmp_path / "r.jsonl"
    src.write_text("".join(json.dumps({"review_id": f"r{i}", "business_id": f"b{i % 2}", "stars": 1.0 + i % 5, "useful": i, "text": "<b>Great!!!!</b> https://x.y" if i else None, "date": "2020-01-01"}) + "\n" for i in range(12)))
    got = cli.run_pipeline(spark, str(src), str(tmp_path / "out"), min_stars=2.0, max_records=5)
    assert got["records_written"] == 5 and got["records_read"] == 9 and got["cleaner_stats"]["empty_inputs"] == 0
    assert [r["review_id"] for r in spark.read.json(got["output"]).orderBy("review_id").collect()] == ["r1", "r2", "r3", "r4", "r6"]
    assert {r["text"] for r in spark.read.json(got["output"]).collect()} == {"great!!"}
    for fmt in ("json", "csv"):
        assert cli.run_pipeline(spark, str(src), str(tmp_path / fmt), fmt)["records_written"] == 12
    assert cli.analyze(spark, str(src), str(tmp_path / "a.json"), "business_id", fmt="json", backend="neutral") == {"total": 12, "positive": 0, "negative": 0, "neutral": 12}
    assert json.loads((tmp_path / "a.json").read_text())[0]["sentiment_label"] == "neutral"
    report = cli.build_report(jsonl.read_jsonl(spark, str(src), schemas.REVIEW))
    assert report["summary"]["total_records"] == 12 and report["summary"]["sentiment_counts"] == {"unknown": 12} and sum(report["star_distribution"].values()) == 12
    assert report["top_businesses"][0] == {"business_id": "b1", "review_count": 6, "average_stars": 2.833, "useful_sum": 36, "positive_count": 2, "negative_count": 3}
    assert "| Total records | 12 |" in cli.markdown(report) and "- **b1**: 6 reviews, avg 2.83 stars" in cli.markdown(report)
    assert cli.main(["validate", str(src), "--required", "review_id"]) == 0
    assert cli.main(["validate", str(src), "--required", "nope"]) == 1
    assert cli.main(["split", str(src), str(tmp_path / "s"), "--chunks", "5"]) == 0
    assert spark.read.text(str(tmp_path / "s")).filter(F.col("chunk") == 4).count() == 4
    assert cli.main(["dedup", str(src), str(tmp_path / "d"), "--key-fields", "business_id", "--stats"]) == 0
    assert spark.read.text(str(tmp_path / "d")).count() == 2
    assert cli.main(["report", str(tmp_path / "absent.jsonl")]) == 2


def test_support():
    tried = []

    @retry(delay=0)
    def flaky():
        tried.append(1)
        if len(tried) < 3:
            raise OSError
        return "ok"

    assert flaky() == "ok" and len(tried) == 3
    with pytest.raises(MaxRetriesExceeded):
        RetryConfig((ZeroDivisionError,), 2, 0).as_decorator()(lambda: 1 / 0)()
    with pytest.raises(ValueError):
        RetryConfig(max_attempts=0)
    f = LruCache(lambda x: x * 2, 1)
    assert [f(1), f(1), f(2), f(1)] == [2, 2, 4, 2] and f.stats == {"hits": 1, "misses": 3, "evictions": 2, "hit_rate": 0.25}
    p = Profile(f)
    p(3)
    assert p.stats["calls"] == 1 and memory()["peak_mb"] > 0
    assert RunMetrics("x", 10, 5, 2.0).to_dict()["drop_rate"] == 0.5 and RunMetrics("x", 1, 5).to_dict()["drop_rate"] == 0
    c = ExpiringCache(size=1)
    c.put("a", 1)
    c.put("b", 2)
    assert c.get("a") is None and c.get("b") == 2


def test_every_line_is_kept_and_numbered(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 8).select(F.format_string("%07d some text", F.col("id")).alias("value"))
    df.write.text(str(tmp_path / "lines"))
    for aqe in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        got = jsonl.numbered_lines(spark, str(tmp_path / "lines"))
        assert got.filter(F.col("value").substr(1, 7).cast("long") == F.col("line") - 1).count() == 400_000
        writers.to_chunks(got, str(tmp_path / f"chunks{aqe}"), ["line"], 3)
        assert spark.read.text(str(tmp_path / f"chunks{aqe}")).groupBy("chunk").count().orderBy("chunk").collect() == [(0, 133_333), (1, 133_333), (2, 133_334)]
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_dedup_by_content(spark, tmp_path):
    p = tmp_path / "d.jsonl"
    p.write_text('{"a":1,"b":2}\n{"b": 2, "a": 1}\n{"a":1.0,"b":2}\n{"a":"1","b":2}\n{"a":true,"b":2}\nnot json\n')
    assert cli.main(["dedup", str(p), str(tmp_path / "o")]) == 0
    assert spark.read.text(str(tmp_path / "o")).count() == 4


def test_checkpoints_of_a_cluster_need_a_shared_folder(spark):
    from types import SimpleNamespace as N

    from tidemark.session import ensure_checkpoint_dir, session_params

    unset = N(isDefined=lambda: False)
    fake = N(sparkContext=N(master="local-cluster[3,2,3000]", _jsc=N(sc=lambda: N(getCheckpointDir=lambda: unset))), conf=N(get=lambda k, d: None))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(fake)
    assert session_params("X_", ("url",), {"X_URL": "u", "Y": "1"}) == {"url": "u"}
    with pytest.raises(OSError):
        session_params("X_", ("url", "user"), {"X_URL": "u"})
