"""Streaming queries over `events`, run until the table is read; they equal their batch forms."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..streaming import jobs
from . import inputs as i


def _stream(spark: SparkSession, d: str) -> DataFrame:
    static = i.table(spark, d, "events")
    source = spark.readStream.schema(static.schema)
    # a stream reads a folder: the table's own, or the one that its single file lies in
    if static.inputFiles()[0].endswith("/events.parquet"):
        return jobs.with_event_time(source.option("pathGlobFilter", "events.parquet").parquet(d))
    return jobs.with_event_time(source.parquet(f"{d}/events.parquet"))


def _written(spark: SparkSession, df: DataFrame, mode: str) -> DataFrame:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="termloom-")
    place = f"{base.rstrip('/')}/termloom/stream-{uuid.uuid4().hex}"
    return jobs.written(df, f"{place}/rows", f"{place}/checkpoint", mode)


def stream_sessions(spark, d):
    found = _written(spark, jobs.sessions(_stream(spark, d)), "complete")
    return found.select("user_id", F.unix_micros("start").alias("start_us"), "n")


def stream_windows(spark, d):
    found = _written(spark, jobs.windows(_stream(spark, d), "1 hour", by=("event_type",)), "complete")
    return found.select(F.unix_micros("start").alias("start_us"), "event_type", "n")


def stream_dedupe(spark, d):
    both = jobs.without_repeats(_stream(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))))
    return _written(spark, both.select("event_id"), "append")


SESSIONS = "SELECT user_id, min(epoch_us(ts)) AS start_us, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, session"
QUERIES = {"stream_sessions": stream_sessions, "stream_windows": stream_windows, "stream_dedupe": stream_dedupe}
ORACLE_SQL = {
    "stream_sessions": SESSIONS,
    "stream_windows": "SELECT epoch_us(ts) // 3600000000 * 3600000000 AS start_us, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_dedupe": "SELECT event_id FROM events",
}
