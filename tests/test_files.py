"""Sinks and sources that read and write files, and the fan-out to several models."""

import json

from pyspark.sql import functions as F

from termloom.operators import evaluate, verify
from termloom.sources import files, sinks


def text_of(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_json_array(spark, tmp_path):
    for k, rows in enumerate(([], [(1, "a")], [(1, "a"), (2, None), (3, "c")])):
        sinks.write_json_array(spark.createDataFrame(rows, "k int, v string").orderBy("k"), f"{tmp_path}/{k}")
        assert json.loads(text_of(tmp_path / str(k))) == [{"k": a, "v": b} for a, b in rows]


def test_copies_progress_failures(spark, tmp_path):
    texts = spark.createDataFrame([("a", "x"), ("b", "y")], "stem string, text string")
    sinks.copy_selected(texts, spark.createDataFrame([("b",), ("b",), ("c",)], "stem string"), f"{tmp_path}/copy")
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/copy").collect()] == [("b", "y")]
    for _ in range(2):
        sinks.write_progress(spark.createDataFrame([("a", None), ("b", "bad")], "file_id string, error string"), f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p/completed").count() == 1 and spark.read.parquet(f"{tmp_path}/p/failed").count() == 2
    assert files.read_progress(spark, f"{tmp_path}/p/completed", "file_id string").count() == 1
    assert files.read_progress(spark, f"{tmp_path}/none", "file_id string").count() == 0
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_bytes(b"no parquet")
    assert files.read_progress(spark, f"{tmp_path}/broken", "file_id string").count() == 0
    sinks.write_failures(spark.createDataFrame([("u", "t", "m", "now")], "url string, error_type string, error_msg string, timestamp string"), f"{tmp_path}/f")
    assert text_of(tmp_path / "f").startswith("# ") and [r.url for r in files.retry_urls(spark.read.text(f"{tmp_path}/f")).collect()] == ["u"]
    assert sinks.unwritten(texts, lambda df: df.count()) is None and sinks.unwritten(texts, lambda df: 1 / 0) is texts


def test_turn_documents(spark, tmp_path):
    doc = {"version": 2, "initial_output": "$", "turns": [{"turn_id": 1, "action": {"type": "command", "content": "ls"}, "observation": {"content": "x"}}]}
    (tmp_path / "v2").mkdir()
    (tmp_path / "v2" / "7.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "lines.json").write_text(json.dumps(doc | {"file_id": "l1"}) + "\n" + json.dumps(doc | {"file_id": "l2"}) + "\n")
    got = files.read_turn_documents(spark, str(tmp_path)).orderBy("file_id").collect()
    assert [(r.file_id, r.turns[0].action.content) for r in got] == [("7", "ls"), ("l1", "ls"), ("l2", "ls")]


def test_texts_beside_recordings(spark):
    casts = spark.createDataFrame([("/d/v1/a.cast",), ("/d/v1/b.cast",), ("/d/v1/c.cast",)], "path string")
    texts = spark.createDataFrame([("/d/v1/a.txt", "own"), ("/d/txt/a.txt", "other"), ("/d/txt/b.txt", "sibling")], "path string, text string")
    assert sorted((r.path[-6], r.truth) for r in verify.with_texts(casts, texts).collect()) == [("a", "own"), ("b", "sibling"), ("c", None)]


def test_fan_out(spark):
    def models(batches):
        for pdf in batches:
            bad = pdf["key"].str.endswith(":m2") & (pdf["prompt"] == "Y") | (pdf["prompt"] == "Z")
            yield pdf.assign(response=(pdf["key"] + pdf["prompt"]).where(~bad, None), error=bad.map({True: "failed", False: None}))[["key", "response", "error"]]

    def judge(batches):
        for pdf in batches:
            yield pdf.assign(response=pdf["prompt"], error=None)[["key", "response", "error"]]

    rows = spark.createDataFrame([("a:1", "x"), ("b", "y"), ("c", "z")], "file_id string, text string")
    answers, verdicts = evaluate.fan_out(rows, ["m1", "m2"], models, judge, F.upper)
    assert sorted((r.file_id, r.model, r.error) for r in answers.collect()) == [("a:1", "m1", None), ("a:1", "m2", None), ("b", "m1", None), ("b", "m2", "failed"), ("c", "m1", "failed"), ("c", "m2", "failed")]
    assert {r.file_id: r.response for r in verdicts.collect()} == {"a:1": "### m1\na:1:m1X\n\n### m2\na:1:m2X", "b": "### m1\nb:m1Y"}
