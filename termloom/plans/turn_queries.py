"""Queries over turns made from `conversations`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import heuristics as h, similarity as sim, text as tx
from ..functions.terminal import fold_backspaces, screen
from ..operators import curate, evaluate, reports, segment, verify
from . import inputs as i

T = i.TURNS_SQL


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _any(c: str, patterns, flags: str = "") -> str:
    joined = "|".join(f"(?:{p})" for p in patterns)
    return f"regexp_matches({c}, {_lit(flags + joined)})"


STRIP = r"regexp_replace(regexp_replace({0}, '\A\s+', ''), '\s+\z', '')"
COMMANDS = ", ".join(_lit(c) for c in h.COMMANDS)
BARE = STRIP.format("action")
WORD = rf"regexp_extract(action, '^\s*(\S+)', 1)"
IS_COMMAND = f"({WORD} <> '' AND (regexp_extract({WORD}, '[^/]*$') IN ({COMMANDS}) OR starts_with({WORD}, './') OR starts_with({WORD}, '/') OR regexp_matches({BARE}, '^[A-Z_][A-Z0-9_]*=')))"
CONFIDENCE = f"""
  SELECT file_id, turn_id, valid,
    CASE WHEN size < 2 THEN greatest(10, s2 - 20) WHEN size > 150 THEN greatest(10, s2 - 15) ELSE s2 END / 100.0 AS confidence
  FROM (SELECT *, CASE WHEN {_any('action', h.SUSPICIOUS)} THEN greatest(10, s1 - 20) ELSE s1 END AS s2
    FROM (SELECT *, {IS_COMMAND} AS valid, length({BARE}) AS size, least(100, CASE WHEN {IS_COMMAND} THEN 70 ELSE 50 END + 10) AS s1 FROM ({T})))"""
IS_OUTPUT = f"""(length(action) < 2 OR {_any('action', h.OUTPUT)} OR {_any('action', h.OUTPUT_ANY_CASE, '(?i)')}
  OR (length(action) > 10 AND {_any(BARE, [h.DRAWING])}) OR {_any(BARE, [h.BORDERS])}
  OR {' OR '.join(f'starts_with({BARE}, {_lit(s)})' for s in h.OUTPUT_STARTS)}
  OR (length({BARE}) > 15 AND length(regexp_replace(action, '[^\\p{{L}}]', '', 'g')) < 0.15 * length(action)) OR length({BARE}) > 200)"""


def scored(spark, d):
    t = i.conversation_turns(spark, d)
    return t.select("file_id", "turn_id", h.is_command("action").alias("valid"), h.confidence("action", F.lit(i.PROMPT)).alias("confidence"))


def _grouped(spark, d):
    t = i.conversation_turns(spark, d)
    return t.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("turn_id", "action", "observation"))).alias("turns"))


def export_simplify(spark, d):
    kept = _grouped(spark, d).select("file_id", curate.simplified().alias("turns")).where("turns is not null")
    return kept.select("file_id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: F.concat(t["action"], F.lit(" => "), t["observation"])), "\n").alias("record"))


def _versions(spark, d):
    t = i.conversation_turns(spark, d)
    return t.groupBy("file_id").agg(F.count("*").alias("n_turns")).withColumn("version", (F.col("file_id") % 3 + 1).cast("int"))


VERSIONS = f"SELECT file_id, count(*) AS n_turns, CAST(file_id % 3 + 1 AS INTEGER) AS version FROM ({T}) GROUP BY file_id"


def turn_report(spark, d):
    t = i.conversation_turns(spark, d)
    kind = F.when(h.heredoc_delimiter("action").isNotNull(), "heredoc").when(h.interactive_program("action").isNotNull(), "interactive_program").otherwise("command")
    kept = t.withColumn("confidence", h.confidence("action", F.lit(i.PROMPT))).where("confidence >= 0.3").withColumn("type", kind)
    return reports.turn_analysis(kept)


def rule_filter(spark, d):
    r = _versions(spark, d).withColumn("similarity", F.when(F.col("file_id") % 7 != 0, 1 - (F.col("file_id") % 10) / F.lit(100.0)))
    return curate.rule_filter(r, min_turns=2).select("file_id", "n_turns", "similarity")


def rule_summary(spark, d):
    kept = rule_filter(spark, d).withColumn("perfect_match", F.col("similarity") == 1)
    return curate.rule_summary(kept).select("total", "total_turns", "perfect_matches", F.array_join("files", ",").alias("files"))


RULE = f"SELECT file_id, n_turns, similarity FROM (SELECT *, CASE WHEN file_id % 7 <> 0 THEN 1 - (file_id % 10) / 100.0 END::DOUBLE AS similarity FROM ({VERSIONS})) WHERE n_turns >= 2 AND coalesce(similarity, 0) > 0.95"


def _text_turns(spark, d, made):
    """A file's turns as text with prompts, and its lines."""
    t = made(spark, d)
    body = F.concat(F.lit(i.PROMPT), "action", F.lit("\n"), "observation")
    many = t.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("turn_id", body.alias("b")))).alias("p"))
    return many.select("file_id", F.concat(F.lit("start\n"), F.array_join(F.transform("p", lambda x: x["b"]), "\n")).alias("text"))


TEXTS = f"SELECT file_id, 'start' || chr(10) || string_agg('{i.PROMPT}' || action || chr(10) || observation, chr(10) ORDER BY turn_id) AS text FROM ({i.WHOLE_SQL}) GROUP BY file_id"
LINES = f"SELECT file_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS line_no FROM (SELECT file_id, string_split(text, chr(10)) AS l FROM ({TEXTS}))"


def line_segmentation(spark, d, made=i.whole_turns):
    rows = segment.lines(_text_turns(spark, d, made))
    patterns = rows.sparkSession.createDataFrame([(-1, ["x"])], "file_id long, patterns array<string>")
    learned = rows.select("file_id").distinct().select("file_id", F.array(F.lit("["), F.lit(r"\w+@\w+:\S*\$ ")).alias("patterns")).unionByName(patterns)
    found = segment.candidates(rows, learned)
    verdicts = rows.sparkSession.createDataFrame([], "file_id long, confirmed array<int>, false_positives array<int>")
    turns = segment.to_turns(rows, segment.confirmed(found, verdicts))
    return turns.select("file_id", F.col("turn_id").cast("long").alias("turn_id"), F.coalesce("prompt", F.lit("")).alias("prompt"), "raw_text")


def prompt_context(spark, d, made=i.whole_turns):
    rows = segment.context(segment.lines(_text_turns(spark, d, made)))
    return rows.where(F.col("line").startswith(i.PROMPT)).select("file_id", F.col("line_no").cast("long").alias("line_no"), "line", "prev_line", "next_line")


def merge_prompts(spark, d):
    t = i.conversation_turns(spark, d).select("file_id", "turn_id", F.concat(F.lit("p"), F.col("turn_id").cast("string"), F.lit("$ ")).alias("prompt"), F.col("action").alias("input"), F.col("observation").alias("output"))
    return segment.merged_prompts(t).select("file_id", "turn_id", "output")


def observation_recovery(spark, d, made=i.whole_turns):
    t = made(spark, d)
    turns = t.select("file_id", "turn_id", F.lit(i.PROMPT).alias("prompt"), F.concat(F.lit(i.PROMPT), "action", F.lit("\n"), "observation").alias("raw_text"))
    told = t.where("turn_id % 2 = 0").select("file_id", "turn_id", F.array(F.when(F.col("turn_id") % 4 == 0, F.lit("other")).otherwise(F.col("action"))).alias("action_lines"), F.array(F.lit("seen"), F.lit(" "), F.lit("too")).alias("observation_lines"))
    return segment.classified(turns, told).select("file_id", "turn_id", "action", "observation", "prefix_matched")


def patch_turns(spark, d):
    t = i.conversation_turns(spark, d).withColumn("prompt", F.lit("$ "))
    part = F.struct(F.lit("$ ").alias("prompt"), F.concat(F.lit("half "), "action").alias("action"), F.lit("").alias("observation"))
    empty = F.array().cast("array<struct<prompt:string,action:string,observation:string>>")
    base = t.select("file_id", "turn_id", F.when(F.col("turn_id") % 3 == 0, F.array(part, part)).otherwise(empty).alias("parts"), F.when(F.col("turn_id") % 2 == 0, F.lit("fixed")).alias("action"), F.lit(None).cast("string").alias("observation"))
    patches = base.withColumn("seq", F.lit(2)).unionByName(base.withColumns({"action": F.lit("first"), "seq": F.lit(1)}))
    missed = t.where("turn_id = 1").select("file_id", F.lit(1).alias("position"), "prompt", F.lit("missed").alias("action"), F.lit("out").alias("observation"))
    return segment.patched(t, patches, missed).select("file_id", F.col("turn_id").cast("long").alias("turn_id"), "action", "observation")


PATCHED = f"""
  SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY grp, place, part) AS turn_id, action, observation FROM (
    SELECT file_id, 0 AS grp, 1 AS place, 0 AS part, 'missed' AS action, 'out' AS observation FROM ({T}) WHERE turn_id = 1
    UNION ALL SELECT file_id, 1, turn_id, 0, CASE WHEN turn_id % 3 = 0 THEN 'half ' || action WHEN turn_id % 2 = 0 THEN 'fixed' ELSE action END, CASE WHEN turn_id % 3 = 0 THEN '' ELSE observation END FROM ({T})
    UNION ALL SELECT file_id, 1, turn_id, 1, 'half ' || action, '' FROM ({T}) WHERE turn_id % 3 = 0)"""


def match_ladder(spark, d):
    t = i.conversation_turns(spark, d)
    other = F.when(F.col("turn_id") % 4 == 0, F.col("action")).when(F.col("turn_id") % 4 == 1, F.substring("action", 1, 10)).when(F.col("turn_id") % 4 == 2, F.concat(F.lit("zz\n"), F.col("action"))).otherwise(F.col("observation"))
    return t.select("file_id", "turn_id", sim.match_kind(F.col("action"), other, 0.5).alias("kind"))


LADDER = f"""
  SELECT file_id, turn_id, CASE WHEN action = o THEN 'exact' WHEN starts_with(action, o) OR starts_with(o, action) THEN 'prefix'
    WHEN len(list_intersect(list_distinct(string_split(action, chr(10))), list_distinct(string_split(o, chr(10))))) / len(list_distinct(string_split(action, chr(10)) || string_split(o, chr(10)))) >= 0.5 THEN 'similar' ELSE 'mismatch' END AS kind
  FROM (SELECT *, CASE turn_id % 4 WHEN 0 THEN action WHEN 1 THEN substr(action, 1, 10) WHEN 2 THEN 'zz' || chr(10) || action ELSE observation END AS o FROM ({T}))"""


def char_quick_ratio(spark, d):
    t = i.conversation_turns(spark, d)
    return t.select("file_id", "turn_id", F.round(sim.quick_ratio("action", "observation"), 6).alias("ratio"))


QUICK = f"""
  WITH t AS ({T}), a AS (SELECT file_id, turn_id, c, count(*) AS n FROM (SELECT file_id, turn_id, unnest(string_split(action, '')) AS c FROM t) GROUP BY ALL),
  b AS (SELECT file_id, turn_id, c, count(*) AS n FROM (SELECT file_id, turn_id, unnest(string_split(observation, '')) AS c FROM t) GROUP BY ALL),
  s AS (SELECT file_id, turn_id, sum(least(a.n, b.n)) AS shared FROM a JOIN b USING (file_id, turn_id, c) GROUP BY ALL)
  SELECT file_id, turn_id, round(CASE WHEN length(action) + length(observation) = 0 THEN 1.0 ELSE 2.0 * coalesce(shared, 0) / (length(action) + length(observation)) END, 6)::DOUBLE AS ratio FROM t LEFT JOIN s USING (file_id, turn_id)"""


def command_match_ratio(spark, d, made=i.whole_turns):
    t = made(spark, d)
    a = t.where("turn_id % 2 = 1").select("file_id", F.col("action").alias("command"))
    b = t.select("file_id", F.concat("action", F.when(F.col("turn_id") % 3 == 0, " again").otherwise("")).alias("command"))
    return verify.command_match_rows(a, b).select("file_id", "total", "matched", F.round("ratio", 6).alias("ratio"))


MATCH = f"""
  WITH t AS ({i.WHOLE_SQL}), a AS (SELECT file_id, action AS o FROM t WHERE turn_id % 2 = 1), b AS (SELECT file_id, action || CASE WHEN turn_id % 3 = 0 THEN ' again' ELSE '' END AS c FROM t)
  SELECT file_id, count(*) AS total, count(*) FILTER (hit) AS matched, round(count(*) FILTER (hit) / count(*), 6) AS ratio
  FROM (SELECT b.file_id, EXISTS (SELECT 1 FROM a WHERE a.file_id = b.file_id AND (contains(b.c, a.o) OR contains(a.o, b.c))) AS hit FROM b) GROUP BY file_id"""


def ansi_clean(spark, d, made=i.whole_turns):
    t = made(spark, d)
    dirty = F.concat(F.lit("\x1b]0;title\x07\x1b[1;32m"), "action", F.lit("\x1b[0m\x1b(B\x1b=\x07\r\n\x1b[?25h\x1b]2;t\x1b\\"), "observation", F.lit("\x1b[K"))
    plain = F.concat(F.lit("\x1b[1m"), "action", F.lit("\x1b[0m\x1b7"))
    return t.select("file_id", "turn_id", tx.clean_output(dirty).alias("shown"), tx.clean_ansi(plain).alias("plain"), tx.clean_plain_command(F.concat(F.lit("me@box:~/x$ "), "action")).alias("command"))


def terminal_screen(spark, d):
    t = i.conversation_turns(spark, d)
    text = F.concat(F.lit("$ "), "action", F.lit("\r\n"), "observation", F.lit("\x1b[2;3Hmoved\x1b[K"))
    return t.select("file_id", "turn_id", screen(text).alias("screen"), fold_backspaces(F.concat("action", F.lit("\b\bxy\rz"))).alias("folded"))


def sequence_ratio(spark, d):
    t = i.conversation_turns(spark, d)
    return t.select("file_id", "turn_id", F.round(sim.guarded_ratio("action", "observation"), 6).alias("ratio"))


def reconstruct(spark, d):
    from ..operators.turns import session_text

    t = i.conversation_turns(spark, d)
    many = t.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("turn_id", F.col("action").alias("content"), "observation"))).alias("turns"))
    return many.select("file_id", session_text(F.lit("$"), "turns").alias("text"), session_text(F.lit("$"), "turns", 1).alias("text_v1"))


def prompt_json(spark, d, made=i.whole_turns):
    t = made(spark, d)
    many = t.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("turn_id", F.lit("command").alias("type"), F.col("action").alias("content"), "observation"))).alias("turns"))
    return many.select("file_id", curate.prompt_turns().alias("session"))


NAMED = (("vim", True), ("wget", True), ("yarn", True), ("yum", True), ("unzip", True), ("xargs", True), ("watch", True), ("wc", True), ("/usr/bin/xsel", True), ("./run", True), ("frobnicate", False), ("vimx", False))


def known_commands(spark, d):
    t = i.conversation_turns(spark, d)
    name = F.element_at(F.array(*[F.lit(n) for n, _ in NAMED]), (F.col("turn_id") % len(NAMED) + 1).cast("int"))
    return t.select("file_id", "turn_id", h.is_command(F.concat(name, F.lit(" "), "action")).alias("known"))


def screen_mode(spark, d):
    t = i.conversation_turns(spark, d)
    text = F.concat("action", F.when(F.col("turn_id") % 3 == 0, "\x1b[?1049h").when(F.col("turn_id") % 3 == 1, "\x1b[?47l").otherwise(""), "observation", F.when(F.col("turn_id") % 2 == 0, "\x1b[?1049l").otherwise(""))
    return t.select("file_id", "turn_id", h.enters_screen(text).alias("enters"), h.leaves_screen(text).alias("leaves"))


def screen_lines(spark, d):
    """Texts of many lines on a screen as wide as they need, with a last line that is partly written over."""
    t = i.conversation_turns(spark, d)
    plain = F.rtrim(F.regexp_replace("observation", r"[\x00-\x09\x0b-\x1f\x7f-\x9f]", " "))
    shown = F.concat(F.replace(plain, F.lit("\n"), F.lit("\r\n")), F.lit("\r\nabcdef\x1b[3DXY\x1b[K"))
    return t.select("file_id", "turn_id", screen(shown, 1_000_000, 1_000_000).alias("screen"), fold_backspaces(F.concat(F.lit("first\n"), "action", F.lit("four\b\bxy\rz"))).alias("folded"))


def turn_durations(spark, d):
    from ..operators.turns import extract_turns
    from ..sources import casts

    found = extract_turns(casts.with_events(casts.with_version(i.synthetic_casts(spark, d, 2))))
    each = found.select(F.col("stem").cast("long").alias("file_id"), F.explode("turns").alias("t"))
    return each.select("file_id", F.col("t.turn_id").cast("long").alias("turn_id"), F.col("t.duration_ms").alias("duration_ms"), F.round(F.col("t.timestamp"), 2).alias("began"))


def batch_summary(spark, d):
    v = _versions(spark, d).select("version", (F.col("file_id") % 5 != 0).alias("turn_success"), F.when(F.col("file_id") % 4 != 0, F.col("file_id") % 3 == 0).alias("stream_success"), "n_turns", (F.col("n_turns") * 3).alias("n_events"))
    return reports.batch_summary(v)


def run_summary(spark, d):
    v = _versions(spark, d).select(F.when(F.col("file_id") % 5 == 0, "failed").otherwise("done").alias("status"), (F.col("n_turns") / F.lit(4.0)).alias("seconds"))
    return reports.run_summary(v)


def version_manifest(spark, d):
    v = _versions(spark, d).select("version", F.concat(F.col("file_id").cast("string"), F.lit(".cast")).alias("name"))
    return reports.manifest(v).select("version", "n", F.array_join("names", ",").alias("names"))


def turn_content(spark, d):
    t = i.conversation_turns(spark, d)
    even = F.col("turn_id") % 2 == 0
    turn = F.struct(F.when(even, F.struct(F.col("action").alias("content"))).alias("input"), F.struct(F.lit("old").alias("content")).alias("action"), F.struct(F.lit("seen").alias("content")).alias("output"), F.struct(F.col("observation").alias("content")).alias("observation"))
    return t.select("file_id", "turn_id", evaluate.turn_content(turn, "input", "action").alias("typed"), evaluate.turn_content(turn, "output", "observation").alias("shown"))


def last_reply(spark, d):
    t = i.whole_turns(spark, d)
    turns = t.select("file_id", "turn_id", F.lit(i.PROMPT).alias("prompt"), F.concat(F.lit(i.PROMPT), "action", F.lit("\n"), "observation").alias("raw_text"))
    replies = t.select("file_id", "turn_id", F.explode(F.array(*[F.struct(F.lit(k).alias("seq"), F.array(F.lit(x)).alias("action_lines"), F.array(F.concat(F.lit(x), "action")).alias("observation_lines")) for k, x in ((2, "b"), (3, "c"), (1, "a"))])).alias("r")).select("file_id", "turn_id", "r.*")
    return segment.classified(turns, replies).select("file_id", "turn_id", "action", "observation")


QUERIES = {
    "turn_pairs": i.conversation_turns,
    "command_confidence": scored,
    "likely_output_flags": lambda s, d: i.conversation_turns(s, d).select("file_id", "turn_id", h.is_output("action").alias("is_output")),
    "confidence_filter": lambda s, d: scored(s, d).where("confidence >= 0.3").groupBy("valid").agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("mean")),
    "interactive_detect": lambda s, d: i.whole_turns(s, d).select("file_id", "turn_id", h.interactive_program(F.concat(F.when(F.col("turn_id") % 3 == 0, "/usr/bin/vim ").when(F.col("turn_id") % 3 == 1, "ssh ").otherwise(""), F.col("action"))).alias("program")),
    "heredoc_detect": lambda s, d: i.whole_turns(s, d).select("file_id", "turn_id", h.heredoc_delimiter(F.concat("action", F.lit(" <<"), F.when(F.col("turn_id") % 2 == 0, " 'EOF'\nbody\n").otherwise("-X y"))).alias("delimiter")),
    "export_simplify": export_simplify,
    "turn_report": turn_report,
    "report_by_version": lambda s, d: reports.by_version(_versions(s, d)),
    "rule_filter": rule_filter,
    "rule_summary": rule_summary,
    "line_segmentation": line_segmentation,
    "prompt_context": prompt_context,
    "merge_prompts": merge_prompts,
    "observation_recovery": observation_recovery,
    "patch_turns": patch_turns,
    "match_ladder": match_ladder,
    "char_quick_ratio": char_quick_ratio,
    "command_match_ratio": command_match_ratio,
    "ansi_clean": ansi_clean,
    "terminal_screen": terminal_screen,
    "sequence_ratio": sequence_ratio,
    "reconstruct": reconstruct,
    "prompt_json": prompt_json,
    "known_commands": known_commands,
    "confidence_v1": lambda s, d: i.conversation_turns(s, d).select("file_id", "turn_id", h.confidence("action", F.lit(i.PROMPT), 1).alias("confidence")),
    "screen_mode": screen_mode,
    "screen_lines": screen_lines,
    "turn_durations": turn_durations,
    "batch_summary": batch_summary,
    "run_summary": run_summary,
    "version_manifest": version_manifest,
    "action_commands": lambda s, d: i.whole_turns(s, d).select("file_id", "turn_id", tx.action_command(F.concat(F.when(F.col("turn_id") % 2 == 0, "~/a $ x % ").otherwise("me $ a $ "), F.col("action"))).alias("command")),
    "turn_content": turn_content,
    "last_reply": last_reply,
}

SESSION = f"string_agg(CASE WHEN (prev = '$' OR (prev <> '' AND NOT regexp_matches(prev, '[ \\n]\\z'))) THEN ' ' ELSE '' END || action || chr(10) || observation, '' ORDER BY turn_id)"
NAMED_SQL = " ".join(f"WHEN {k} THEN {str(known).lower()}" for k, (_, known) in enumerate(NAMED))
ORACLE_SQL = {
    "known_commands": f"SELECT file_id, turn_id, CASE turn_id % {len(NAMED)} {NAMED_SQL} END AS known FROM ({T})",
    "confidence_v1": f"""
      SELECT file_id, turn_id, (CASE WHEN size < 2 THEN greatest(10, s2 - 20) WHEN size > 150 THEN greatest(10, s2 - 15) ELSE s2 END / 100.0)::DOUBLE AS confidence
      FROM (SELECT *, CASE WHEN {_any('action', h.SUSPICIOUS)} THEN greatest(10, s1 - 20) ELSE s1 END AS s2
        FROM (SELECT *, length({BARE}) AS size, least(100, CASE WHEN {IS_COMMAND} THEN 80 ELSE 20 END + 15) AS s1 FROM ({T})))""",
    "screen_mode": f"SELECT file_id, turn_id, turn_id % 3 = 0 AS enters, turn_id % 3 <> 0 AND (turn_id % 3 = 1 OR turn_id % 2 = 0) AS leaves FROM ({T})",
    "screen_lines": rf"""
      SELECT file_id, turn_id, regexp_replace(rtrim(regexp_replace(observation, '[\x00-\x09\x0b-\x1f\x7f-\x9f]', ' ', 'g'), ' '), ' +\n', chr(10), 'g') || chr(10) || 'abcXY' AS screen,
        'first' || chr(10) || regexp_replace(action, '[^\n]*\z', '') || 'z' || substr(regexp_extract(action, '[^\n]*\z') || 'fo', 2) || 'xy' AS folded FROM ({T})""",
    "turn_durations": f"SELECT file_id, turn_id, 500.0::DOUBLE AS duration_ms, round(0.25 * (3 * turn_id - 1), 2)::DOUBLE AS began FROM ({i.WHOLE_SQL})",
    "batch_summary": f"SELECT version, count(*) AS files, count(*) FILTER (file_id % 5 <> 0) AS turn_success, count(*) FILTER (file_id % 4 <> 0 AND file_id % 3 = 0) AS stream_success, sum(n_turns)::BIGINT AS turns, sum(3 * n_turns)::BIGINT AS events FROM ({VERSIONS}) GROUP BY ROLLUP (version)",
    "run_summary": f"SELECT CASE WHEN file_id % 5 = 0 THEN 'failed' ELSE 'done' END AS status, count(*) AS n, round(avg(n_turns / 4), 3) AS avg_seconds FROM ({VERSIONS}) GROUP BY 1",
    "version_manifest": f"SELECT version, count(*) AS n, string_agg(file_id || '.cast', ',' ORDER BY file_id || '.cast') AS names FROM ({VERSIONS}) GROUP BY version",
    "action_commands": f"SELECT file_id, turn_id, action AS command FROM ({i.WHOLE_SQL})",
    "turn_content": f"SELECT file_id, turn_id, CASE WHEN turn_id % 2 = 0 THEN action ELSE 'old' END AS typed, 'seen' AS shown FROM ({T})",
    "last_reply": f"SELECT file_id, turn_id, 'c' AS action, 'c' || action AS observation FROM ({i.WHOLE_SQL})",
    "turn_pairs": T,
    "command_confidence": f"SELECT file_id, turn_id, valid, confidence::DOUBLE AS confidence FROM ({CONFIDENCE})",
    "likely_output_flags": f"SELECT file_id, turn_id, {IS_OUTPUT} AS is_output FROM ({T})",
    "confidence_filter": f"SELECT valid, count(*) AS n, round(avg(confidence::DOUBLE), 6) AS mean FROM ({CONFIDENCE}) WHERE confidence >= 0.3 GROUP BY valid",
    "interactive_detect": f"SELECT file_id, turn_id, CASE turn_id % 3 WHEN 0 THEN 'vim' WHEN 1 THEN 'ssh' END AS program FROM ({i.WHOLE_SQL})",
    "heredoc_detect": f"SELECT file_id, turn_id, CASE WHEN turn_id % 2 = 0 THEN 'EOF' END AS delimiter FROM ({i.WHOLE_SQL})",
    "export_simplify": f"""
      WITH t AS ({T}), n AS (SELECT *, max(turn_id) OVER (PARTITION BY file_id) AS last, bool_or(contains(observation, '^C')) OVER (PARTITION BY file_id) AS stopped FROM t)
      SELECT file_id, count(*) AS n_turns, string_agg(action || ' => ' || observation, chr(10) ORDER BY turn_id) AS record
      FROM n WHERE NOT stopped AND NOT (turn_id = last AND lower({BARE}) = 'exit') GROUP BY file_id HAVING count(*) > 1""",
    "turn_report": f"""
      SELECT file_id, count(*) AS n_turns, count(*) FILTER (trim(action, ' ') = '') AS empty_actions, count(*) FILTER (trim(observation, ' ') = '') AS empty_observations,
        count(*) FILTER (kind = 'heredoc') AS heredocs, count(*) FILTER (kind = 'interactive') AS interactive, count(*) FILTER (kind = 'command') AS commands,
        round(avg(length(observation)), 2) AS avg_observation
      FROM (SELECT t.*, CASE WHEN {_any('action', [h.HEREDOC])} THEN 'heredoc'
              WHEN regexp_extract({WORD}, '[^/]*$') IN ({', '.join(_lit(p) for p in h.INTERACTIVE[2])}) THEN 'interactive' ELSE 'command' END AS kind
            FROM ({T}) t JOIN ({CONFIDENCE}) c USING (file_id, turn_id) WHERE c.confidence >= 0.3) GROUP BY file_id""",
    "report_by_version": f"SELECT version, count(*) AS files, CAST(sum(n_turns) AS BIGINT) AS turns, round(avg(n_turns), 2) AS avg_turns FROM ({VERSIONS}) GROUP BY ROLLUP (version)",
    "rule_filter": RULE,
    "rule_summary": f"SELECT count(*) AS total, CAST(coalesce(sum(n_turns), 0) AS BIGINT) AS total_turns, count(*) FILTER (similarity = 1) AS perfect_matches, coalesce(string_agg(file_id::VARCHAR, ',' ORDER BY file_id), '') AS files FROM ({RULE})",
    "line_segmentation": f"""
      SELECT file_id, turn_id, max(CASE WHEN p THEN '{i.PROMPT}' ELSE '' END) AS prompt, string_agg(line, chr(10) ORDER BY line_no) AS raw_text
      FROM (SELECT *, CAST(sum(p::INT) OVER (PARTITION BY file_id ORDER BY line_no) AS BIGINT) AS turn_id FROM (SELECT *, starts_with(line, '{i.PROMPT}') AS p FROM ({LINES}))) GROUP BY file_id, turn_id""",
    "prompt_context": f"SELECT * FROM (SELECT file_id, line_no, line, lag(line, 1, '') OVER w AS prev_line, lead(line, 1, '') OVER w AS next_line FROM ({LINES}) WINDOW w AS (PARTITION BY file_id ORDER BY line_no)) WHERE starts_with(line, '{i.PROMPT}')",
    "merge_prompts": f"SELECT file_id, turn_id, coalesce(concat_ws(chr(10), nullif(observation, ''), 'p' || (lead(turn_id) OVER (PARTITION BY file_id ORDER BY turn_id)) || '$ '), '') AS output FROM ({T})",
    "observation_recovery": f"""
      SELECT file_id, turn_id, CASE WHEN turn_id % 4 = 0 THEN 'other' ELSE action END AS action,
        CASE WHEN turn_id % 4 = 0 THEN 'seen' || chr(10) || 'too' ELSE observation END AS observation, turn_id % 4 <> 0 AS prefix_matched FROM ({i.WHOLE_SQL})""",
    "patch_turns": PATCHED,
    "match_ladder": LADDER,
    "char_quick_ratio": QUICK,
    "command_match_ratio": MATCH,
    "ansi_clean": f"SELECT file_id, turn_id, action || chr(10) || observation AS shown, action AS plain, action AS command FROM ({i.WHOLE_SQL})",
    "reconstruct": f"""
      SELECT file_id, '$' || {SESSION} AS text, '$' || string_agg(action || chr(10) || observation, '' ORDER BY turn_id) AS text_v1
      FROM (SELECT *, lag(observation, 1, '$') OVER (PARTITION BY file_id ORDER BY turn_id) AS prev FROM ({T})) GROUP BY file_id""",
    "prompt_json": f"""
      SELECT file_id, '[' || string_agg('{{"action":{{"type":"command","content":"' || action || '"}},"observation":{{"content":"' || observation || '"}}}}', ',' ORDER BY turn_id) || ']' AS session FROM ({i.WHOLE_SQL}) GROUP BY file_id""",
}
