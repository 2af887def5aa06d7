"""Filters and exports: rules, verdicts, token limits, simplified records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.responses import count_tokens
from ..functions.text import strip


def rule_filter(records: DataFrame, min_similarity: float = 0.95, min_turns: int = 1) -> DataFrame:
    """records: n_turns, similarity (null: 0). Strictly more similar than the limit."""
    return records.where((F.col("n_turns") >= min_turns) & (F.coalesce("similarity", F.lit(0.0)) > min_similarity))


def rule_summary(kept: DataFrame) -> DataFrame:
    """kept: file_id, n_turns, perfect_match. One row: total, total_turns, perfect_matches, files."""
    return kept.agg(
        F.count("*").alias("total"),
        F.coalesce(F.sum("n_turns"), F.lit(0)).cast("long").alias("total_turns"),
        F.count_if(F.coalesce("perfect_match", F.lit(False))).alias("perfect_matches"),
        F.array_sort(F.collect_list("file_id")).alias("files"),
    )


def token_gate(texts: DataFrame, limit: int, text: str = "text", load=None) -> tuple[DataFrame, DataFrame]:
    """(within, too large), each with n_tokens."""
    counted = texts.withColumn("n_tokens", count_tokens(text, load))
    return counted.where(F.col("n_tokens") <= limit), counted.where(F.col("n_tokens") > limit)


def verdict_counts(results: DataFrame) -> DataFrame:
    """results: result (true, false, null) and error."""
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("result").eqNullSafe(True)).alias("suitable"),
        F.count_if(F.col("result").eqNullSafe(False)).alias("not_suitable"),
        F.count_if(F.col("result").isNull()).alias("errors"),
    )


def suitable_sources(results: DataFrame, sources: DataFrame, key: str = "file_id") -> DataFrame:
    """Sources of suitable results; a source that isn't there leaves nulls and missing = true."""
    good = results.where(F.col("result").eqNullSafe(True)).select(key)
    return good.join(sources.withColumn("here", F.lit(True)), key, "left").withColumn("missing", F.col("here").isNull()).drop("here")


def remaining(files: DataFrame, processed: DataFrame, key: str = "file_id", retry_errors: bool = False) -> DataFrame:
    """Files without a result; with retry_errors, results that hold an error don't count."""
    done = processed.where(F.col("error").isNull()) if retry_errors else processed
    return files.join(done.select(key), key, "left_anti")


def simplified(turns: Column | str = "turns") -> Column:
    """array of (action, observation), or null for records that go: an interrupt in an observation, or at most one
    turn once a closing `exit` is taken off."""
    turns = F.col(turns) if isinstance(turns, str) else turns
    last = F.lower(strip(F.try_element_at(turns, F.lit(-1))["action"])) == "exit"
    kept = F.when((F.size(turns) > 0) & F.coalesce(last, F.lit(False)), F.slice(turns, 1, F.greatest(F.size(turns) - 1, F.lit(0)))).otherwise(turns)
    stopped = F.exists(turns, lambda t: F.coalesce(t["observation"].contains("^C"), F.lit(False)))
    pairs = F.transform(kept, lambda t: F.struct(t["action"].alias("action"), t["observation"].alias("observation")))
    return F.when(~stopped & (F.size(kept) > 1), pairs)


def prompt_turns(turns: Column | str = "turns") -> Column:
    """Turns as the judge sees them, in JSON: no raw output, timing or key strokes."""
    return F.to_json(F.transform(turns, lambda t: F.struct(F.struct(t["type"].alias("type"), t["content"].alias("content")).alias("action"), F.struct(t["observation"].alias("content")).alias("observation"))))


def suitability_prompt(turns_json: Column | str, text: Column | str | None = None) -> Column:
    """What a judge is asked about one recording."""
    ask = F.lit("Below is a terminal session as a list of actions and observations. Is it complete, readable and free of private data, so that an agent could learn from it? End with \\boxed{true} or \\boxed{false}.\n\nSession:\n")
    parts = [ask, F.col(turns_json) if isinstance(turns_json, str) else turns_json]
    if text is not None:
        parts += [F.lit("\n\nText of the recording:\n"), F.coalesce(text, F.lit("[text not found]"))]
    return F.concat(*parts)


def renamed_parse(turns: Column | str = "turns") -> Column:
    """A parse's turns under the names input and output."""
    return F.transform(turns, lambda t: F.struct(t["turn_id"].alias("turn_id"), t["prompt"].alias("prompt"), t["action"].alias("input"), t["observation"].alias("output")))
