"""Structured Streaming forms: sessions, duplicates, turns as they are typed, and work that resumes."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.responses import Responder, respond
from ..operators.turns import Turn, TypedSession
from ..sources.sinks import append_results


def with_event_time(events: DataFrame, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """A watermark needs a timestamp with time zone; tables may hold one without."""
    return events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def sessions(events: DataFrame, gap: str = "30 minutes", key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Events of a key with less than `gap` between them: key, start, end, n. In append mode a session appears once the
    watermark has passed its end; complete mode equals the batch result."""
    w = F.session_window(ts, gap).alias("w")
    return events.groupBy(key, w).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windows(events: DataFrame, width: str, slide: str | None = None, by: tuple[str, ...] = (), ts: str = "ts") -> DataFrame:
    """Counts in tumbling or sliding windows."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return events.groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def without_repeats(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows of a key that come again within the watermark's delay go; state is dropped behind the watermark."""
    return events.dropDuplicatesWithinWatermark([key])


TURN_ROW = "cast_id string, turn_id int, action string, observation string, duration_ms double"


def _rows(cast: str, turns: list[Turn], sent: int) -> pd.DataFrame:
    rows = [(cast, sent + k, t["content"], t["observation"], t["duration_ms"]) for k, t in enumerate((turn.row(0) for turn in turns), 1)]
    return pd.DataFrame(rows, columns=["cast_id", "turn_id", "action", "observation", "duration_ms"]).astype({"turn_id": "int32"})


def live_turns(events: DataFrame, idle_ms: int = 600_000, version: int = 2) -> DataFrame:
    """events: cast_id, seq, ts (with a watermark), t, type, data (input-driven recordings, in order across batches).
    A turn is emitted when the next one begins; the last one once the watermark is idle_ms past the recording's
    last event. State holds a recording's open turn and how many came before it, not these."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        session, sent = pickle.loads(state.get[0]) if state.exists else (TypedSession(version), 0)
        if state.hasTimedOut:
            state.remove()
            yield _rows(key[0], session.turns, sent)
            return
        rows = pd.concat(list(batches)).sort_values("seq")
        for t, kind, data in zip(rows["t"], rows["type"], rows["data"]):
            session.event(float(t), kind, data or "")
        done, session.turns = session.turns[:-1], session.turns[-1:]
        session.before.clear()  # what came before the first turn is in none
        state.update((pickle.dumps((session, sent + len(done))),))
        state.setTimeoutTimestamp(max(int(rows["ts"].max().timestamp() * 1000), state.getCurrentWatermarkMs()) + idle_ms)
        yield _rows(key[0], done, sent)

    return events.groupBy("cast_id").applyInPandasWithState(step, TURN_ROW, "session binary", "append", GroupStateTimeout.EventTimeTimeout)


def run_to(df: DataFrame, path: str, checkpoint: str, key: str = "file_id"):
    """Append new keys to path until the input is read: a restart goes on where it stopped, and no key comes twice."""
    return df.writeStream.foreachBatch(lambda batch, _: append_results(batch, path, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def respond_to(prompts: DataFrame, responder: Responder | DataFrame, path: str, checkpoint: str):
    """Ask a responder about each prompt (key, prompt) as it comes; answers and errors are kept alike."""

    def sink(batch: DataFrame, _: int) -> None:
        append_results(respond(batch, responder), path, "key")

    return prompts.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def written(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a streaming query over what its input holds now, into Parquet at path: in complete mode the last result replaces
    what was there."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").start(path)
    else:
        query = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def collected(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a streaming query over what its input holds now, into a table in memory: for tests and small results."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
