"""Streaming forms against their batch forms."""

import pandas as pd
from pyspark.sql import functions as F

from termloom.streaming import jobs


def test_live_turns(spark, tmp_path):
    events = [("a", 0, 0.0, "o", "$ "), ("a", 1, 1.0, "i", "ls\r"), ("a", 2, 1.5, "o", "ls\r\nx\r\n"), ("b", 0, 0.0, "i", "pwd\r"), ("a", 3, 2.0, "i", "make\r"), ("a", 4, 2.5, "o", "make\r\nok\r\n"), ("a", 5, 3.0, "i", "exit\r")]
    schema = "cast_id string, seq int, t double, type string, data string"
    for k, part in enumerate((events[:3], events[3:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    source = jobs.with_event_time(source.withColumn("ts", F.timestamp_millis((F.col("t") * 1000).cast("long"))), late="1 second")
    got = jobs.collected(jobs.live_turns(source, idle_ms=3_600_000), "live_turns_test", f"{tmp_path}/cp").collect()
    assert sorted((r.cast_id, r.turn_id, r.action, r.observation) for r in got) == [("a", 1, "ls", "x\n"), ("a", 2, "make", "ok\n")]


def test_resume(spark, tmp_path):
    spark.createDataFrame([("a",), ("b",)], "file_id string").write.parquet(f"{tmp_path}/in")

    def run():
        jobs.run_to(spark.readStream.schema("file_id string").parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        return sorted(r.file_id for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run() == ["a", "b"]
    spark.createDataFrame([("b",), ("c",)], "file_id string").write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == ["a", "b", "c"] == run()


def test_responder(spark, tmp_path):
    spark.createDataFrame([("a", "p"), ("b", "q")], "key string, prompt string").write.parquet(f"{tmp_path}/in")

    def answer(batches):
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "response": pdf["prompt"].str.upper(), "error": None})

    jobs.respond_to(spark.readStream.schema("key string, prompt string").parquet(f"{tmp_path}/in"), answer, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sorted((r.key, r.response) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", "P"), ("b", "Q")]


def test_windows_equal_batch(spark, sf):
    batch = jobs.windows(spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")), "2 hours", "1 hour")
    assert batch.agg(F.sum("n")).first()[0] == 2 * spark.read.parquet(f"{sf}/events.parquet").count()
