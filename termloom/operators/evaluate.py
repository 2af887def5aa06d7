"""Several parsers' results and a judge's choice, checked by majority."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.responses import Responder, respond
from ..functions.similarity import guarded_ratio, sequence_ratio
from ..functions.text import collapse_blank_lines

#: The gates' codes in the order they are tried.
CODES = ("file_read_error", "judge_rejected", "no_results", "no_winner", "turn_count_minority", "similar_models_minority", "no_input_file", "low_final_similarity")


def assembled(models: DataFrame, judged: DataFrame) -> DataFrame:
    """One row per judged file, by one shuffle on the file: judged's columns, and from its models (file_id, model,
    initial_output, turns) n_models, won (the winner's, null if it isn't there), same_count (models with as many
    turns) and peers (the others among these). What follows in this module keeps to that partitioning."""
    row = F.struct("model", "initial_output", "turns") if "initial_output" in models.columns else F.struct("model", F.lit("").alias("initial_output"), "turns")
    files = models.groupBy("file_id").agg(F.collect_list(row).alias("results"))
    j = judged.join(files, "file_id", "left").withColumn("results", F.coalesce("results", F.array().cast(files.schema["results"].dataType)))
    j = j.withColumns({"n_models": F.size("results").cast("long"), "won": F.get(F.filter("results", lambda r: r["model"] == F.col("winner")), F.lit(0))})
    alike = F.filter("results", lambda r: F.size(r["turns"]) == F.size(F.col("won.turns")))
    j = j.withColumn("alike", alike).withColumns({"same_count": F.size("alike").cast("long"), "peers": F.filter("alike", lambda r: r["model"] != F.col("winner"))})
    return j.drop("results", "alike")


def majority(models: DataFrame, judged: DataFrame) -> DataFrame:
    """judged: file_id, winner. file_id, winner, n_turns, same_count, n_models, majority: the winner's own group is more than half."""
    a = assembled(models, judged).where(F.col("won").isNotNull())
    return a.select("file_id", "winner", F.size("won.turns").alias("n_turns"), "same_count", "n_models", (F.col("same_count") * 2 > F.col("n_models")).alias("majority"))


def _peer_similarity(a: DataFrame, ratio) -> DataFrame:
    peers = a.select("file_id", F.col("won.turns").alias("w"), F.explode("peers").alias("p")).select("file_id", "w", "p.model", F.col("p.turns").alias("turns"))
    pairs = peers.select("file_id", "model", F.size("w").alias("n"), F.explode_outer(F.arrays_zip("turns", "w")).alias("p"))
    both = (guarded_ratio(F.col("p.w.input"), F.col("p.turns.input"), ratio) + guarded_ratio(F.col("p.w.output"), F.col("p.turns.output"), ratio)) / 2
    return pairs.withColumn("likeness", F.when(F.col("n") > 0, both).otherwise(0.0)).groupBy("file_id", "model").agg(F.avg("likeness").alias("similarity"))


def model_similarity(models: DataFrame, judged: DataFrame, ratio=sequence_ratio) -> DataFrame:
    """Mean likeness of inputs and outputs to the winner's, of each other model with as many turns: file_id, model, similarity."""
    return _peer_similarity(assembled(models, judged), ratio)


def _with_similar(a: DataFrame, threshold: float, ratio) -> DataFrame:
    n = _peer_similarity(a, ratio).groupBy("file_id").agg(F.count_if(F.col("similarity") >= threshold).alias("near"))
    return a.join(n, "file_id", "left").withColumn("similar", 1 + F.coalesce("near", F.lit(0))).drop("near")


def similar_models(models: DataFrame, judged: DataFrame, threshold: float = 0.9, ratio=sequence_ratio) -> DataFrame:
    """file_id, similar (the winner included), n_models, majority."""
    a = assembled(models, judged).where(F.col("won").isNotNull())
    return _with_similar(a, threshold, ratio).select("file_id", "similar", "n_models", (F.col("similar") * 2 > F.col("n_models")).alias("majority"))


def turn_content(turn: Column | str, first: str, second: str) -> Column:
    """A turn's content: of the field `first` (input, output), or of `second` (action, observation) where the first isn't there; else ''."""
    turn = F.col(turn) if isinstance(turn, str) else turn
    return F.coalesce(F.when(turn[first].isNotNull(), F.coalesce(turn[first]["content"], F.lit(""))), turn[second]["content"], F.lit(""))


def fan_out(files: DataFrame, models: list[str], responder: Responder | DataFrame, judge: Responder | DataFrame, prompt: Callable[[Column], Column] = lambda text: text) -> tuple[DataFrame, DataFrame]:
    """files: file_id, text. Asks each model about each file (keys file_id:model), then a judge once a file (key file_id) with all that came
    back. Returns (answers: file_id, model, response, error; verdicts: file_id, response, error). A responder sees the key. A file
    none of whose models answered isn't judged."""
    each = files.select(F.col("file_id").cast("string").alias("file_id"), prompt(F.col("text")).alias("prompt"), F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    asked = respond(each.select(F.concat_ws(":", "file_id", "model").alias("key"), "prompt"), responder)
    named = asked.select(F.regexp_extract("key", "(?s)^(.*):[^:]*$", 1).alias("file_id"), F.substring_index("key", ":", -1).alias("model"), "response", "error")
    said = named.where(F.col("response").isNotNull()).groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("model", "response"))).alias("said"))
    listed = F.array_join(F.transform("said", lambda x: F.concat(F.lit("### "), x["model"], F.lit("\n"), x["response"])), "\n\n")
    verdicts = respond(said.select(F.col("file_id").alias("key"), listed.alias("prompt")), judge)
    return named, verdicts.select(F.col("key").alias("file_id"), "response", "error")


def result_text(initial: Column | str, turns: Column | str) -> Column:
    """A parse as text: parts that aren't empty, line by line. turns: prompt, input, output."""
    initial, turns = (F.col(c) if isinstance(c, str) else c for c in (initial, turns))
    parts = F.flatten(F.transform(turns, lambda t: F.array(F.concat(F.coalesce(t["prompt"], F.lit("")), F.coalesce(t["input"], F.lit(""))), t["output"])))
    return F.array_join(F.filter(F.concat(F.array(initial), parts), lambda x: x.isNotNull() & (x != "")), "\n")


def final_similarity(original: Column | str, rebuilt: Column | str, ratio=sequence_ratio) -> Column:
    return guarded_ratio(collapse_blank_lines(original), collapse_blank_lines(rebuilt), ratio)


def gate(judged: DataFrame, models: DataFrame, originals: DataFrame, threshold: float = 0.9, final_threshold: float = 0.85, ratio=sequence_ratio) -> DataFrame:
    """judged: file_id, success, suitable, winner. models: file_id, model, initial_output, turns. originals: file_id, text.
    One row per judged file: file_id, code (null: success), final_similarity. The first failing gate names the code.
    The costly ratios run only on rows that the cheap gates leave."""
    a = assembled(models, judged).join(originals.select("file_id", F.col("text").alias("original")), "file_id", "left")
    early = (
        F.when(~F.coalesce("success", F.lit(True)), "file_read_error")
        .when(~F.coalesce("suitable", F.lit(True)), "judge_rejected")
        .when(F.col("n_models") == 0, "no_results")
        .when(F.col("won").isNull(), "no_winner")
        .when(F.col("same_count") * 2 <= F.col("n_models"), "turn_count_minority")
    )
    # rows that a cheap gate stops bring no peers and no text to the ratios
    a = a.withColumn("early", early)
    stopped = F.col("early").isNotNull()
    a = a.withColumns({"peers": F.when(stopped, F.slice("peers", 1, 0)).otherwise(F.col("peers")), "original": F.when(~stopped, F.col("original"))})
    a = _with_similar(a, threshold, ratio).withColumn("enough", F.col("similar") * 2 > F.col("n_models"))
    checked = ~stopped & F.col("enough") & F.col("original").isNotNull()
    rebuilt = F.when(checked, result_text("won.initial_output", "won.turns"))
    a = a.withColumns({"original": F.when(checked, F.col("original")), "rebuilt": rebuilt, "no_file": F.col("original").isNull()})
    a = a.withColumn("final_similarity", F.when(F.col("rebuilt").isNotNull(), final_similarity("original", "rebuilt", ratio)))
    late = F.when(~F.col("enough"), "similar_models_minority").when(F.col("no_file"), "no_input_file").when(F.col("final_similarity") < final_threshold, "low_final_similarity")
    return a.select("file_id", F.coalesce("early", late).alias("code"), "final_similarity")


def outcome_counts(results: DataFrame) -> DataFrame:
    """results: code. outcome, n, rate."""
    n = results.groupBy(F.coalesce("code", F.lit("success")).alias("outcome")).agg(F.count("*").alias("n"))
    return n.withColumn("rate", F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))))


def fail_reasons(results: DataFrame, reason: str = "fail_reason") -> DataFrame:
    return results.where(F.col(reason).isNotNull()).groupBy(F.substring_index(reason, ":", 1).alias("reason")).agg(F.count("*").alias("n"))


def judge_defaults(reply: Column | str) -> Column:
    """A judge's reply (JSON, or null where asking failed) as a struct, with defaults for what is missing."""
    reply = F.col(reply) if isinstance(reply, str) else reply

    def field(name: str, kind: str, default) -> Column:
        return F.when(reply.isNull(), None).otherwise(F.coalesce(F.get_json_object(reply, f"$.{name}").try_cast(kind), F.lit(default)))

    return F.struct(
        F.coalesce(field("winner", "string", "model_a"), F.lit("all_incorrect")).alias("winner"),
        field("confidence", "double", 0.5).alias("confidence"),
        F.coalesce(field("suitable_for_training", "boolean", True), F.lit(False)).alias("suitable"),
        field("rejection_type", "string", "").alias("rejection_type"),
        field("reason", "string", "").alias("reason"),
    )


def routed(judged: DataFrame) -> DataFrame:
    """Where a judged record goes besides the judge's folder: rejected (by type), results, or nowhere."""
    rejected = F.concat(F.lit("rejected/"), F.when(F.coalesce("rejection_type", F.lit("")) != "", F.col("rejection_type")).otherwise("empty"))
    accepted = F.array_contains("labels", F.col("winner"))
    return judged.withColumn("route", F.when(~F.col("suitable"), rejected).when(accepted, "results"))
