"""Sinks: partitioned Parquet for what the library reads again, JSON where people or other tools read it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_documents(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Turn-based or event-stream documents, a folder for each version."""
    df.write.mode(mode).partitionBy("version").parquet(path)


def write_json(df: DataFrame, path: str, single: bool = False, mode: str = "errorifexists") -> None:
    """JSON lines; single: one file, for exports that are small by nature (reports)."""
    (df.coalesce(1) if single else df).write.mode(mode).json(path)


def report_row(df: DataFrame) -> DataFrame:
    """A report of a few rows as one JSON document."""
    return df.agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("report"))


def write_routed(df: DataFrame, path: str, route: str = "outcome", mode: str = "errorifexists") -> None:
    """A folder for each outcome; rows whose route is null aren't written."""
    df.where(F.col(route).isNotNull()).write.mode(mode).partitionBy(route).json(path)


def write_responses(df: DataFrame, path: str, mode: str = "append") -> None:
    """Raw model responses: file_id, model, step, turn_id, response and times."""
    df.write.mode(mode).partitionBy("model", "step").parquet(path)


def write_json_array(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One file that holds a JSON array, a row a line, in df's order: for exports that are small by nature. Rows stream to the file."""
    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    last = df.sparkSession.range(1).select(F.lit(None).cast("string").alias("value")).union(rows).coalesce(1)  # without rows there would be no task

    def framed(batches):
        import pyarrow as pa

        held = None
        for batch in batches:
            rows = [r for r in batch.column(0).to_pylist() if r is not None]
            lines = ([("[" if held is None else held + ",")] if rows else []) + [r + "," for r in rows[:-1]]
            held = rows[-1] if rows else held
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[", "]"] if held is None else [held, "]"])], names=["value"])

    last.mapInArrow(framed, "value string").write.mode(mode).text(path)


def copy_selected(texts: DataFrame, chosen: DataFrame, path: str, key: str = "stem", mode: str = "errorifexists") -> None:
    """texts: key and text of files. Those whose key is chosen go to path, each under its key in one dataset."""
    texts.join(chosen.select(key).distinct(), key, "left_semi").select(key, "text").write.mode(mode).parquet(path)


def unwritten(df: DataFrame, write) -> DataFrame | None:
    """write(df); None if that went well, else df itself, for another try elsewhere."""
    try:
        write(df)
    except Exception:
        return df
    return None


def write_progress(results: DataFrame, path: str, key: str = "file_id") -> None:
    """results: key, error. Finished keys go to path/completed once each; failures to path/failed, each time they happen."""
    append_results(results.where(F.col("error").isNull()).select(key), f"{path}/completed", key)
    results.where(F.col("error").isNotNull()).select(key, "error").write.mode("append").parquet(f"{path}/failed")


def append_results(df: DataFrame, path: str, key: str = "file_id") -> None:
    """Progress that restarts can rely on: only keys that are not there yet are appended, once each."""
    fresh = df.dropDuplicates([key])
    try:
        fresh = fresh.join(df.sparkSession.read.parquet(path).select(key), key, "left_anti")
    except Exception as e:  # the first run has no folder yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    fresh.write.mode("append").parquet(path)


def write_failures(df: DataFrame, path: str, mode: str = "append", header: str = "what could not be had; a line of JSON each") -> None:
    """url, error_type, error_msg, timestamp of what could not be had, as JSON lines; each file begins with a comment, which
    retry_urls() passes over."""
    rows = df.select(F.to_json(F.struct("url", "error_type", "error_msg", "timestamp")).alias("value"))

    def commented(batches):
        import pyarrow as pa

        begun = False
        for batch in batches:
            if batch.num_rows and not begun:
                begun = True
                yield pa.RecordBatch.from_arrays([pa.array([f"# {header}"])], names=["value"])
            yield batch

    rows.mapInArrow(commented, "value string").write.mode(mode).text(path)
