"""Summaries: conditional counts over files, turns and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def turn_analysis(turns: DataFrame, key: str = "file_id") -> DataFrame:
    """turns: key, action, observation, type. Counts of turns, empty parts and kinds, mean observation length."""
    kind = F.coalesce("type", F.lit("command"))
    return turns.groupBy(key).agg(
        F.count("*").alias("n_turns"),
        F.count_if(F.trim(F.coalesce("action", F.lit(""))) == "").alias("empty_actions"),
        F.count_if(F.trim(F.coalesce("observation", F.lit(""))) == "").alias("empty_observations"),
        F.count_if(kind == "heredoc").alias("heredocs"),
        F.count_if(kind == "interactive_program").alias("interactive"),
        F.count_if(~kind.isin("heredoc", "interactive_program")).alias("commands"),
        F.round(F.avg(F.length(F.coalesce("observation", F.lit("")))), 2).alias("avg_observation"),
    )


def by_version(files: DataFrame) -> DataFrame:
    """files: version, n_turns. A row per version and one for all (version null): files, turns, avg."""
    return files.rollup("version").agg(F.count("*").alias("files"), F.coalesce(F.sum("n_turns"), F.lit(0)).cast("long").alias("turns"), F.round(F.avg("n_turns"), 2).alias("avg_turns"))


def batch_summary(results: DataFrame) -> DataFrame:
    """results: version, turn_success, stream_success, n_turns, n_events."""
    return results.rollup("version").agg(
        F.count("*").alias("files"),
        F.count_if(F.coalesce("turn_success", F.lit(False))).alias("turn_success"),
        F.count_if(F.coalesce("stream_success", F.lit(False))).alias("stream_success"),
        F.coalesce(F.sum("n_turns"), F.lit(0)).cast("long").alias("turns"),
        F.coalesce(F.sum("n_events"), F.lit(0)).cast("long").alias("events"),
    )


def three_valued(results: DataFrame, flag: str, by: str = "version") -> DataFrame:
    """passed, failed and not applicable by group, and for all."""
    return results.rollup(by).agg(F.count_if(F.col(flag).eqNullSafe(True)).alias("passed"), F.count_if(F.col(flag).eqNullSafe(False)).alias("failed"), F.count_if(F.col(flag).isNull()).alias("not_applicable"))


def run_summary(results: DataFrame) -> DataFrame:
    """results: status, seconds."""
    return results.groupBy("status").agg(F.count("*").alias("n"), F.round(F.avg("seconds"), 3).alias("avg_seconds"))


def manifest(files: DataFrame) -> DataFrame:
    """files: version, name."""
    return files.groupBy("version").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("name")).alias("names"))


def missing_paths(records: DataFrame, listing: DataFrame, fields: tuple[str, ...], most: int = 100) -> DataFrame:
    """field, path: the first `most` paths of each field that aren't there, by name."""
    stacked = ", ".join(f"'{f}', {f}" for f in fields)
    named = records.selectExpr(f"stack({len(fields)}, {stacked}) as (field, path)").where("path is not null and path <> ''")
    gone = named.join(listing.select("path"), "path", "left_anti")
    return gone.withColumn("place", F.row_number().over(W.partitionBy("field").orderBy("path"))).where(F.col("place") <= most).select("field", "path")


def path_existence(records: DataFrame, listing: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Per path field: exist, missing, percent. Empty paths don't count. listing: path."""
    stacked = ", ".join(f"'{f}', {f}" for f in fields)
    named = records.selectExpr(f"stack({len(fields)}, {stacked}) as (field, path)").where("path is not null and path <> ''")
    here = listing.select("path").distinct().withColumn("here", F.lit(True))
    return named.join(here, "path", "left").groupBy("field").agg(F.count("here").alias("existing"), F.count_if(F.col("here").isNull()).alias("missing"), F.round(100 * F.count("here") / F.count("*"), 2).alias("percent"))
