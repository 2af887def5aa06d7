"""Recordings: reading files, telling their version, and their events, with built-in functions.

A recording is one row; its events are an array in file order. Nothing here shuffles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

EVENTS = "array<struct<t:double,type:string,data:string>>"
#: Event codes and their names in the event stream; other codes stay as they are.
NAMES = {"o": "output", "i": "input", "m": "marker", "r": "resize", "x": "exit"}


def read_texts(spark: SparkSession, path: str, glob: str = "*", errors: str = "strict") -> DataFrame:
    """path, stem, text of files found recursively. errors 'strict': text is null where bytes are no UTF-8; 'ignore':
    such bytes are left out. Line ends become \\n. Files of no bytes at all are not listed by Spark and give no row."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    if errors == "strict":
        raw = F.col("content").cast("string")
        text = F.when(F.is_valid_utf8(raw), raw)
    else:

        @F.pandas_udf("string")
        def text_of(contents: pd.Series) -> pd.Series:
            return contents.map(lambda b: b.decode("utf-8", "ignore"))

        text = text_of("content")
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    return files.select("path", stem.alias("stem"), F.regexp_replace(text, "\r\n?", "\n").alias("text"))


def read_casts(spark: SparkSession, path: str) -> DataFrame:
    """Version folders v1, v2, v3 if any of them holds recordings, else the folder itself; events included."""
    all_files = read_texts(spark, path, "*.cast")
    versioned = F.col("path").rlike(r"/v[123]/[^/]*$")
    some = all_files.agg(F.coalesce(F.max(versioned), F.lit(False))).scalar()
    return with_events(with_version(all_files.where(versioned | ~some)))


def _first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def _json_kind(text: Column) -> Column:
    """object, array, other or null for what doesn't parse."""
    trimmed = F.regexp_extract(text, r"^\s*(.)", 1)
    parsed = F.try_parse_json(text)
    return F.when(parsed.isNull(), None).when(trimmed == "{", "object").when(trimmed == "[", "array").otherwise("other")


def detect_version(text: Column | str) -> Column:
    """struct(version, error): 1, 2, 3, or null and why."""
    text = F.col(text) if isinstance(text, str) else text
    whole, first = _json_kind(text), _first_line(text)
    kind = _json_kind(first)
    number = F.get_json_object(first, "$.version")
    second = F.get(F.split(text, "\n", -1), F.lit(1))
    listed = (_json_kind(second) == "array") & (F.size(F.from_json(second, "array<string>")) >= 3)
    old = F.get_json_object(first, "$.width").isNotNull() & F.get_json_object(first, "$.height").isNotNull() & number.isNull() & F.coalesce(listed, F.lit(False))
    blank = F.regexp_replace(text, r"\s", "") == ""
    version = (
        F.when(text.isNull() | blank, None)
        .when((whole == "object") & F.get_json_object(text, "$.stdout").isNotNull(), 1)
        .when(kind != "object", None)
        .when(number == "2", 2)
        .when(number == "3", 3)
        .when(old, 2)
    )
    error = (
        F.when(text.isNull(), "Not UTF-8")
        .when(blank, "Empty file")
        .when(version.isNotNull(), None)
        .when(F.regexp_replace(first, r"\s", "") == "", "Empty first line")
        .when(kind.isNull(), "Invalid JSON in first line")
        .when(kind != "object", "First line is not an object")
        .otherwise("Unknown format")
    )
    return F.struct(version.cast("int").alias("version"), error.alias("error"))


def with_version(files: DataFrame) -> DataFrame:
    found = detect_version("text")
    return files.withColumn("detected", found).select("*", "detected.version", "detected.error").drop("detected")


def _running(rows: Column) -> Column:
    """array of struct(gap, type, data) -> events with t as the sum of gaps so far (from the first gap that is no number on: none)."""

    @F.pandas_udf("array<double>")
    def sums(gaps: pd.Series) -> pd.Series:
        return gaps.map(lambda g: np.cumsum(np.asarray(g, float)), na_action="ignore")

    times = sums(F.transform(rows, lambda x: F.coalesce(x["gap"], F.lit(float("nan")))))
    return F.zip_with(rows, times, lambda x, t: F.struct(F.nanvl(t, F.lit(None)).alias("t"), x["type"].alias("type"), x["data"].alias("data")))


def _lines(text: Column) -> Column:
    """Event lines: parsed lists of three and more."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.ltrim(x).startswith("["))
    parsed = F.transform(lines, lambda x: F.from_json(x, "array<string>"))
    return F.filter(parsed, lambda x: x.isNotNull() & (F.size(x) >= 3) & F.get(x, F.lit(0)).try_cast("double").isNotNull())


def _event(x: Column, name: str) -> Column:
    return F.struct(F.get(x, F.lit(0)).try_cast("double").alias(name), F.get(x, F.lit(1)).alias("type"), F.get(x, F.lit(2)).alias("data"))


def events_of(text: Column | str, version: Column | str) -> Column:
    """Events in file order, with absolute times."""
    text, version = (F.col(c) if isinstance(c, str) else c for c in (text, version))
    frames = F.filter(F.from_json(F.get_json_object(text, "$.stdout"), "array<array<string>>"), lambda x: F.size(x) >= 2)
    one = F.transform(frames, lambda x: F.struct(F.get(x, F.lit(0)).try_cast("double").alias("gap"), F.lit("o").alias("type"), F.get(x, F.lit(1)).alias("data")))
    two = F.transform(_lines(text), lambda x: _event(x, "t"))
    three = F.transform(_lines(text), lambda x: _event(x, "gap"))
    return F.when(version == 2, two).when(version.isin(1, 3), _running(F.when(version == 1, one).when(version == 3, three)))


def header_of(text: Column | str, version: Column | str) -> Column:
    """struct(width, height, duration, command, title, shell, term). In version 2 and 3 the last object line counts."""
    text, version = (F.col(c) if isinstance(c, str) else c for c in (text, version))
    objects = F.filter(F.split(text, "\n", -1), lambda x: F.ltrim(x).startswith("{") & F.try_parse_json(x).isNotNull())
    head = F.when(version == 1, text).otherwise(F.try_element_at(objects, F.lit(-1)))

    def field(*paths: str):
        return F.coalesce(*[F.get_json_object(head, p) for p in paths])

    return F.struct(
        F.coalesce(F.when(version == 3, field("$.term.cols")).otherwise(field("$.width")).try_cast("int"), F.lit(80)).alias("width"),
        F.coalesce(F.when(version == 3, field("$.term.rows")).otherwise(field("$.height")).try_cast("int"), F.lit(24)).alias("height"),
        F.coalesce(field("$.duration").try_cast("double"), F.lit(0.0)).alias("duration"),
        F.coalesce(field("$.command"), F.lit("")).alias("command"),
        F.coalesce(field("$.title"), F.lit("")).alias("title"),
        F.coalesce(field("$.env.SHELL"), F.lit("")).alias("shell"),
        F.coalesce(field("$.term.type", "$.env.TERM"), F.lit("")).alias("term"),
    )


def with_events(casts: DataFrame) -> DataFrame:
    return casts.withColumns({"header": header_of("text", "version"), "events": events_of("text", "version")})


def event_stream(casts: DataFrame) -> DataFrame:
    """Adds the event stream document: events with long names and rounded times, and statistics."""
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    stream = F.transform("events", lambda e: F.struct(F.round(e["t"], 6).alias("t"), F.coalesce(F.element_at(names, e["type"]), e["type"]).alias("type"), e["data"].alias("data")))

    def count(code: str):
        return F.size(F.filter("events", lambda e: e["type"] == code)).cast("long")

    first, last = F.get("events", F.lit(0))["t"], F.try_element_at("events", F.lit(-1))["t"]
    duration = F.when(F.size("events") == 0, F.when(F.col("version") == 3, 0.0).otherwise(F.col("header.duration"))).when(F.col("version") == 2, last - first).otherwise(last)
    counts = {f"{n}_events": count(c) for c, n in NAMES.items()}
    statistics = F.struct(F.size("events").cast("long").alias("total_events"), *[v.alias(k) for k, v in counts.items()], F.round(duration, 2).alias("duration"))
    return casts.withColumns({"stream": stream, "statistics": statistics})


def output_text(events: Column | str = "events") -> Column:
    return F.array_join(F.transform(F.filter(events, lambda e: e["type"] == "o"), lambda e: e["data"]), "")


CAST_SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("path", T.StringType()), ("stem", T.StringType()), ("text", T.StringType()), ("version", T.IntegerType()), ("error", T.StringType()))])
