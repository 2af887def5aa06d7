"""Is an extraction true to its recording?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import similarity as sim, text as tx
from ..functions.terminal import screen
from ..sources.casts import output_text
from .turns import session_text


def against_text(initial: Column | str, turns: Column | str, text: Column | str, version: int = 2, ratio=sim.text_ratio) -> Column:
    """struct(verified, perfect_match, similarity, perfect_match_length_check)."""
    norm = tx.normalize_v1 if version == 1 else tx.normalize
    a, b = norm(session_text(initial, turns, version)), norm(text)
    return F.struct(F.lit(True).alias("verified"), (a == b).alias("perfect_match"), F.round(ratio(a, b), 4).alias("similarity"), (F.length(a) == F.length(b)).alias("perfect_match_length_check"))


def command_match(json_commands: Column | str, txt_commands: Column | str, least: float = 0.8) -> Column:
    """struct(status, matched, total, ratio): a text's command counts as matched if it contains, or lies in, one of the others."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (json_commands, txt_commands))
    hit = F.size(F.filter(b, lambda x: F.exists(a, lambda y: x.contains(y) | y.contains(x))))
    share = hit / F.size(b)
    status = F.when(F.size(b) == 0, "no_txt_commands").when(F.size(a) == 0, "no_json_commands").when(share >= least, "match").otherwise("mismatch")
    return F.struct(status.alias("status"), F.when(F.size(b) > 0, hit).alias("matched"), F.size(b).alias("total"), F.when(F.size(b) > 0, share).alias("ratio"))


def command_match_rows(json_rows: DataFrame, txt_rows: DataFrame, key: str = "file_id") -> DataFrame:
    """The same over rows (key, command): a semi join with the file as equality key, never a product of all rows."""
    a, b = json_rows.select(F.col(key).alias("k"), F.col("command").alias("other")), txt_rows.select(key, "command")
    both = b.join(a, (F.col(key) == F.col("k")) & (F.col("command").contains(F.col("other")) | F.col("other").contains(F.col("command"))), "left_semi")
    total = b.groupBy(key).agg(F.count("*").alias("total"))
    return total.join(both.groupBy(key).agg(F.count("*").alias("matched")), key, "left").withColumns({"matched": F.coalesce("matched", F.lit(0)), "ratio": F.coalesce("matched", F.lit(0)) / F.col("total")})


def final_screens(casts: DataFrame) -> DataFrame:
    """Adds screen: what the terminal shows in the end."""
    return casts.withColumn("screen", screen(output_text(), F.col("header.width"), F.col("header.height")))


def rebuilt_output(casts: DataFrame) -> DataFrame:
    """path, version, output, n_output, duration (the last time) of recordings."""
    return casts.select("path", "version", output_text().alias("output"), F.size(F.filter("events", lambda e: e["type"] == "o")).alias("n_output"), F.try_element_at("events", F.lit(-1))["t"].alias("duration"))


def stream_matches(casts: DataFrame, streams: DataFrame, key: str = "stem") -> DataFrame:
    """Event stream documents against recordings: same output and as many output events. Documents without a recording are left out."""
    names = casts.select(key, output_text().alias("a"), F.size(F.filter("events", lambda e: e["type"] == "o")).alias("n"))
    told = streams.select(key, F.array_join(F.transform(F.filter("stream", lambda e: e["type"] == "output"), lambda e: e["data"]), "").alias("b"), F.size(F.filter("stream", lambda e: e["type"] == "output")).alias("m"))
    return told.join(names, key).select(key, (F.col("a") == F.col("b")).alias("same_output"), (F.col("n") == F.col("m")).alias("same_count"), ((F.col("a") == F.col("b")) & (F.col("n") == F.col("m"))).alias("passed"))


def turn_quality(turns: Column | str = "turns") -> Column:
    """struct(turns, empty_actions, empty_observations)."""
    return F.struct(
        F.size(turns).alias("turns"),
        F.size(F.filter(turns, lambda t: tx.strip(F.coalesce(t["content"], F.lit(""))) == "")).alias("empty_actions"),
        F.size(F.filter(turns, lambda t: tx.strip(F.coalesce(t["observation"], F.lit(""))) == "")).alias("empty_observations"),
    )


def with_texts(casts: DataFrame, texts: DataFrame) -> DataFrame:
    """casts: path. texts: path, text. Adds truth: the text beside the recording (its path with .txt in place of every .cast), else
    that of its name in the folder txt beside the recording's folder, else null."""
    beside = F.replace("path", F.lit(".cast"), F.lit(".txt"))
    name = F.substring_index(beside, "/", -1)
    above = F.regexp_replace("path", r"/[^/]*/[^/]*$", "")
    sibling = F.concat(above, F.lit("/txt/"), name)
    known = texts.groupBy(F.col("path").alias("at")).agg(F.min("text").alias("found"))
    one = casts.withColumns({"beside": beside, "sibling": sibling})
    first = one.join(known.select(F.col("at").alias("beside"), F.col("found").alias("own")), "beside", "left")
    both = first.join(known.select(F.col("at").alias("sibling"), F.col("found").alias("other")), "sibling", "left")
    return both.withColumn("truth", F.coalesce("own", "other")).drop("beside", "sibling", "own", "other")


def report(extracted: DataFrame, texts: DataFrame, key: str = "stem") -> DataFrame:
    """One row per extraction: the screen's match with the text's, commands, quality. extracted: header, events, turns,
    raw_all_output. texts: key, text; a file without a text leaves the text's checks null."""
    j = final_screens(extracted).join(texts.select(key, F.col("text").alias("truth")), key, "left")
    shown = tx.normalize_screen(F.col("screen"))
    rebuilt = tx.normalize_screen(screen(F.col("raw_all_output"), F.col("header.width"), F.col("header.height")))
    truth = tx.normalize_screen(tx.clean_ansi("truth"))
    commands = F.filter(F.transform("turns", lambda t: tx.action_command(t["content"])), lambda x: x != "")
    return j.select(
        key,
        "version",
        sim.match_kind(shown, rebuilt).alias("screen_match"),
        (sim.line_jaccard(truth, shown) >= 0.8).alias("text_match"),
        F.when(F.col("truth").isNotNull(), command_match(commands, tx.txt_commands("truth"))).alias("commands"),
        turn_quality().alias("quality"),
    )
