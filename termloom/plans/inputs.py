"""The driver's tables as this library's inputs, with the same inputs in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user row with the assistant row right behind it: file_id, turn_id, action, observation."""
    rows = table(spark, sf_dir, "conversations")
    w = W.partitionBy("conv_id").orderBy("turn")
    following = rows.withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w)})
    pairs = following.where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    number = F.row_number().over(w).cast("long")
    return pairs.select(F.col("conv_id").alias("file_id"), number.alias("turn_id"), F.coalesce("text", F.lit("")).alias("action"), F.coalesce("next_text", F.lit("")).alias("observation"))


#: CTE body of conversation_turns().
TURNS_SQL = """
  SELECT conv_id AS file_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS turn_id,
         coalesce(text, '') AS action, coalesce(next_text, '') AS observation
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant'"""


def whole_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversation_turns() with actions made plain commands (`echo` and letters), observations in plain letters."""
    t = conversation_turns(spark, sf_dir)
    plain = [F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")) for c in ("action", "observation")]
    action = F.concat(F.lit("echo "), F.coalesce(F.nullif(plain[0], F.lit("")), F.lit("x")))
    return t.select("file_id", "turn_id", action.alias("action"), plain[1].alias("observation"))


#: The same in SQL.
WHOLE_SQL = f"""
  SELECT file_id, turn_id,
    'echo ' || coalesce(nullif(trim(regexp_replace(lower(action), '[^a-z0-9]+', ' ', 'g')), ''), 'x') AS action,
    trim(regexp_replace(lower(observation), '[^a-z0-9]+', ' ', 'g')) AS observation
  FROM ({TURNS_SQL})"""

PROMPT = "u@h:~$ "


#: Turns that are found in output alone: an action is no command if it looks like output, for its length or its few letters.
INFERRED_SQL = rf"""
  SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY turn_id) AS turn_id, action, observation FROM ({WHOLE_SQL})
  WHERE length(action) <= 200 AND NOT (length(action) > 15 AND length(regexp_replace(action, '[^\p{{L}}]', '', 'g')) < 0.15 * length(action))"""


def synthetic_casts(spark: SparkSession, sf_dir: str, version: int, made=whole_turns, typed: bool = True) -> DataFrame:
    """Recordings of whole_turns(), a file's text in each row: prompt, typed command (if typed, and not in version 1), echo,
    observation, prompt. A quarter of a second passes between events."""
    t = made(spark, sf_dir)

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\r"), F.lit("\\r")), F.lit("\n"), F.lit("\\n")), F.lit('"'))

    echo = F.concat("action", F.lit("\r\n"))
    shown = F.concat("observation", F.lit("\r\n" + PROMPT))
    parts = ([("i", F.concat("action", F.lit("\r")))] if typed and version != 1 else []) + [("o", echo), ("o", shown)]
    events = F.array(*[F.struct(F.lit(k).alias("k"), d.alias("d")) for k, d in parts])
    many = t.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("turn_id", events.alias("e")))).alias("all"))
    flat = F.concat(F.array(F.struct(F.lit("o").alias("k"), F.lit(PROMPT).alias("d"))), F.flatten(F.transform("all", lambda x: x["e"])))
    many = many.withColumn("flat", flat)
    if version == 1:
        frames = F.array_join(F.transform("flat", lambda e: F.concat(F.lit("[0.25,"), quoted(e["d"]), F.lit("]"))), ",")
        text = F.concat(F.lit('{"version":1,"width":80,"height":24,"duration":0,"stdout":['), frames, F.lit("]}"))
    else:
        head = '{"version":2,"width":80,"height":24,"env":{"SHELL":"/bin/sh"}}' if version == 2 else '{"version":3,"term":{"cols":80,"rows":24,"type":"xterm"}}\n# a comment'
        time = (lambda i: F.format_string("%.2f", 0.25 * (i + 1))) if version == 2 else (lambda i: F.lit("0.25"))
        lines = F.array_join(F.transform("flat", lambda e, i: F.concat(F.lit("["), time(i), F.lit(',"'), e["k"], F.lit('",'), quoted(e["d"]), F.lit("]"))), "\n")
        text = F.concat(F.lit(head + "\n"), lines, F.lit("\n"))
    name = F.concat(F.col("file_id").cast("string"), F.lit(".cast"))
    return many.select(F.concat(F.lit(f"/casts/v{version}/"), name).alias("path"), F.col("file_id").cast("string").alias("stem"), text.alias("text"))


def models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parsers' results per conversation: as it is, in lower case, and without the last turn for every third."""
    t = conversation_turns(spark, sf_dir)
    item = F.struct(F.col("turn_id").cast("int").alias("turn_id"), F.lit("$ ").alias("prompt"), F.col("action").alias("input"), F.col("observation").alias("output"))
    base = t.groupBy("file_id").agg(F.array_sort(F.collect_list(item)).alias("turns")).withColumn("initial_output", F.lit(""))
    lower = F.transform("turns", lambda x: F.struct(x["turn_id"].alias("turn_id"), x["prompt"].alias("prompt"), F.lower(x["input"]).alias("input"), F.lower(x["output"]).alias("output")))
    cut = F.when(F.col("file_id") % 3 == 0, F.slice("turns", 1, F.size("turns") - 1)).otherwise(F.col("turns"))
    out = None
    for name, turns in (("model_a", F.col("turns")), ("model_b", lower), ("model_c", cut)):
        one = base.select("file_id", F.lit(name).alias("model"), "initial_output", turns.alias("turns"))
        out = one if out is None else out.unionByName(one)
    return out
