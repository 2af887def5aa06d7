"""Sessions from plain text: lines, prompts, turns by gaps and islands, and patches to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.responses import first_match
from ..functions.text import strip

FALLBACK = r"^[\$\#\%>]\s*"


def lines(texts: DataFrame, key: str = "file_id", text: str = "text") -> DataFrame:
    """One row per line: key, line_no from 1, line."""
    return texts.select(key, F.posexplode(F.split(text, "\n", -1)).alias("k", "line")).select(key, (F.col("k") + 1).alias("line_no"), "line")


def context(rows: DataFrame, key: str = "file_id") -> DataFrame:
    """Adds prev_line and next_line, '' at the ends."""
    w = W.partitionBy(key).orderBy("line_no")
    return rows.withColumns({"prev_line": F.lag("line", 1, "").over(w), "next_line": F.lead("line", 1, "").over(w)})


def candidates(rows: DataFrame, patterns: DataFrame, key: str = "file_id") -> DataFrame:
    """Lines that a learned pattern matches at their start, with the first pattern's place and the prompt.

    patterns: key, patterns (array, in order). A file without any uses the fallback; patterns that do not compile
    are passed over."""
    joined = rows.join(patterns.select(key, "patterns"), key, "left")
    many = F.when(F.coalesce(F.size("patterns"), F.lit(0)) > 0, F.col("patterns")).otherwise(F.array(F.lit(FALLBACK)))
    hit = joined.withColumn("hit", first_match("line", many))
    return hit.where(F.col("hit.pattern").isNotNull()).select(*rows.columns, "hit.pattern", "hit.prompt")


def confirmed(found: DataFrame, verdicts: DataFrame, key: str = "file_id") -> DataFrame:
    """Keep confirmed candidates. verdicts: key, confirmed (line numbers), false_positives. If a file has neither,
    all its candidates count."""
    joined = found.join(verdicts.select(key, "confirmed", "false_positives"), key, "left")
    none = (F.coalesce(F.size("confirmed"), F.lit(0)) <= 0) & (F.coalesce(F.size("false_positives"), F.lit(0)) <= 0)
    return joined.where(none | F.coalesce(F.array_contains("confirmed", F.col("line_no")), F.lit(False))).select(*found.columns)


def to_turns(rows: DataFrame, prompts: DataFrame, key: str = "file_id") -> DataFrame:
    """Lines to turns: turn_id 0 is what comes before the first prompt. key, turn_id, prompt, raw_text."""
    marked = rows.join(prompts.select(key, "line_no", "prompt"), [key, "line_no"], "left")
    turn = F.sum(F.col("prompt").isNotNull().cast("int")).over(W.partitionBy(key).orderBy("line_no"))
    grouped = marked.withColumn("turn_id", turn).groupBy(key, "turn_id").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("l"), F.max("prompt").alias("prompt"))
    return grouped.select(key, "turn_id", "prompt", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("raw_text"))


def classified(turns: DataFrame, replies: DataFrame, key: str = "file_id") -> DataFrame:
    """replies: key, turn_id, action_lines, observation_lines. Adds action, observation, prefix_matched: where the
    turn's text begins with prompt and action, the rest is the observation; else the reply's lines that aren't blank.
    Without a reply the first line behind the prompt is the action. Of several replies on a turn the last counts: that of the
    greatest seq, if replies have such a column, else the last in their order."""
    order = F.col("seq") if "seq" in replies.columns else F.monotonically_increasing_id()
    ordered = replies.select(key, "turn_id", F.struct("action_lines", "observation_lines").alias("reply"), order.alias("seq"))
    last = ordered.groupBy(key, "turn_id").agg(F.max_by("reply", "seq").alias("reply")).select(key, "turn_id", "reply.*")
    j = turns.join(last, [key, "turn_id"], "left")
    prompt = F.coalesce("prompt", F.lit(""))
    first = F.substring_index("raw_text", "\n", 1)
    action = F.coalesce(F.array_join("action_lines", "\n"), strip(first.substr(F.length(prompt) + 1, F.length(first))))
    head = F.concat(prompt, action)
    matched = F.col("raw_text").startswith(head)
    rest = strip(F.col("raw_text").substr(F.length(head) + 1, F.length("raw_text")))
    told = F.array_join(F.filter(F.coalesce("observation_lines", F.array().cast("array<string>")), lambda x: strip(x) != ""), "\n")
    return j.select(*turns.columns, action.alias("action"), F.when(matched, rest).otherwise(told).alias("observation"), matched.alias("prefix_matched"))


def patched(turns: DataFrame, patches: DataFrame, missed: DataFrame, key: str = "file_id") -> DataFrame:
    """Corrections without mutation: every turn gets a place (turn, part), then numbers from 1.

    patches: key, turn_id, seq (the order of verdicts: the last on a turn counts), parts (array of struct(prompt,
    action, observation)), action, observation. Two parts and more replace a turn; else action and observation are
    overwritten, each where given. missed: key, position, prompt, action, observation; they come first."""
    last = patches.withColumn("n", F.row_number().over(W.partitionBy(key, "turn_id").orderBy(F.desc("seq")))).where("n = 1").select(key, "turn_id", "parts", F.col("action").alias("new_action"), F.col("observation").alias("new_observation"))
    j = turns.join(last, [key, "turn_id"], "left")
    own = F.array(F.struct("prompt", F.coalesce("new_action", "action").alias("action"), F.coalesce("new_observation", "observation").alias("observation")))
    parts = F.when(F.coalesce(F.size("parts"), F.lit(0)) >= 2, F.col("parts")).otherwise(own)
    old = j.select(key, F.lit(1).alias("group"), F.col("turn_id").cast("long").alias("place"), F.posexplode(parts).alias("part", "p")).select(key, "group", "place", "part", "p.*")
    first = missed.select(key, F.lit(0).alias("group"), F.col("position").cast("long").alias("place"), F.lit(0).alias("part"), "prompt", "action", "observation")
    number = F.row_number().over(W.partitionBy(key).orderBy("group", "place", "part"))
    return first.unionByName(old).withColumn("turn_id", number).select(key, "turn_id", "prompt", "action", "observation")


def merged_prompts(turns: DataFrame, key: str = "file_id") -> DataFrame:
    """Each next turn's prompt goes to the end of the observation before it. turns: key, turn_id, prompt, input, output."""
    following = F.lead("prompt").over(W.partitionBy(key).orderBy("turn_id"))
    output = F.concat_ws("\n", F.when(F.col("output") != "", F.col("output")), F.when(following != "", following))
    return turns.withColumn("output", output)


def merged_initial(initial: Column | str, first_prompt: Column | str) -> Column:
    """The first prompt goes to the end of the initial output."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (initial, first_prompt))
    return F.concat_ws("\n", F.when(a != "", a), F.when(b != "", b))
