"""Queries over documents, labels, pages and events, and over synthetic recordings."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import similarity as sim, text as tx
from ..operators import crawl, curate, evaluate, reports, turns, verify
from ..sources import casts, files
from . import inputs as i
from .turn_queries import STRIP, T

# ---------------------------------------------------------------- documents and labels

WS = r"[ \t\r\x0b\f]+"


def _docs(spark, d):
    return i.table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _messy(c="text"):
    """Texts with blank runs and trailing blanks, which the table has not."""
    return F.replace(c, F.lit("\n"), F.lit("  \n\n\n\t"))


MESSY = "replace(coalesce(text, ''), chr(10), '  ' || repeat(chr(10), 3) || chr(9))"
RSTRIP = r"regexp_replace({0}, '[ \t\r\x0b\f]+(\n|\z)', '\1', 'g')"


def normalize_text(spark, d):
    return _docs(spark, d).select("doc_id", tx.normalize_screen(_messy()).alias("screen"), tx.normalize(_messy()).alias("v2"), tx.normalize_v1(_messy()).alias("v1"))


def collapse_blank_lines(spark, d):
    return _docs(spark, d).select("doc_id", tx.collapse_blank_lines(_messy()).alias("text"))


def line_jaccard(spark, d):
    docs = _docs(spark, d)
    return docs.select("doc_id", F.round(sim.line_jaccard("text", F.concat("text", F.lit("\nmore\nlines"))), 6).alias("jaccard"))


def _labelled(spark, d):
    return _docs(spark, d).join(i.table(spark, d, "labels"), "doc_id")


def boxed_result(spark, d):
    reply = F.concat("text", F.when(F.col("quality") == 1, r" \boxed{True}").when(F.col("toxic") == 1, " oxed{false}").otherwise(" none"), F.lit("."))
    return _labelled(spark, d).select("doc_id", tx.boxed(reply).alias("result"))


def json_fence(spark, d):
    """A document's text in JSON, in a fence that says so, in one that doesn't, or in none."""
    body = F.to_json(F.struct("doc_id", F.replace("text", F.lit("`"), F.lit("'")).alias("text")))
    reply = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nbye"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("```\n"), body, F.lit("\n```"))).otherwise(body)
    found = tx.json_fence(reply)
    return _docs(spark, d).select("doc_id", F.get_json_object(found, "$.doc_id").cast("long").alias("id"), F.get_json_object(found, "$.text").alias("text"))


#: Signs that would end a balanced piece early.
SIGNS = "{}[]"


def tolerant_json(spark, d):
    from ..functions.responses import extract_json

    body = F.to_json(F.struct("doc_id", F.translate("text", SIGNS, "    ").alias("text")))
    wrapped = F.concat(F.lit("say "), body.substr(F.lit(1), F.length(body) - 1), F.lit(", } end"))
    found = extract_json(F.when(F.col("doc_id") % 2 == 0, wrapped).otherwise(F.translate("text", SIGNS, "    ")))
    return _docs(spark, d).select("doc_id", F.get_json_object(found, "$.doc_id").cast("long").alias("id"), F.get_json_object(found, "$.text").alias("text"))


def verdicts(spark, d):
    docs, labels = _docs(spark, d), i.table(spark, d, "labels")
    return docs.join(labels, "doc_id", "left").select("doc_id", (F.col("quality") == 1).alias("result"), F.when(F.col("quality").isNull(), F.lit("no verdict")).alias("error"))


def three_valued(spark, d):
    langs = i.table(spark, d, "documents").select("doc_id", "lang")
    return reports.three_valued(verdicts(spark, d).join(langs, "doc_id"), "result", "lang")


def suitable_join(spark, d):
    sources = i.table(spark, d, "documents").where("doc_id % 5 <> 0").select("doc_id", "source")
    return curate.suitable_sources(verdicts(spark, d), sources, "doc_id").groupBy("missing").agg(F.count("*").alias("n"), F.countDistinct("source").alias("sources"))


def resume_remaining(spark, d):
    return curate.remaining(i.table(spark, d, "documents").select("doc_id", "source"), verdicts(spark, d).where("error is null"), "doc_id")


def token_gate(spark, d):
    within, large = curate.token_gate(_docs(spark, d), 300)
    return within.withColumn("too_large", F.lit(False)).unionByName(large.withColumn("too_large", F.lit(True))).groupBy("too_large").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))


def txt_commands(spark, d):
    """Each line of a document behind a prompt, with lines of output between them."""
    plain = F.regexp_replace("text", "[^A-Za-z\n ]", "")
    t = _docs(spark, d).select("doc_id", F.concat(F.lit("u@h $ ls -l\nx\n"), F.concat(F.lit("# "), F.replace(plain, F.lit("\n"), F.lit("\nout\n# "))), F.lit("\n$ \n")).alias("t"))
    return t.select("doc_id", F.array_join(tx.txt_commands("t"), "|").alias("commands"))


def natural_sort(spark, d):
    names = i.table(spark, d, "documents").select("source", F.concat(F.lit("File"), F.col("doc_id").cast("string"), F.lit("x"), F.col("n_chars").cast("string")).alias("name"))
    place = F.row_number().over(W.partitionBy("source").orderBy(tx.natural_key("name"), "name"))
    return names.select("source", "name", place.cast("long").alias("place"))


def stratified_sample(spark, d):
    named = i.table(spark, d, "documents").select(F.col("lang").alias("version"), F.col("doc_id").cast("string").alias("name"))
    return crawl.sampled(named, 20)


def chunk_ranges(spark, d):
    n = i.table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("total"))
    ranges = n.select("lang", F.posexplode(tx.chunk_ranges(F.col("total"), 10)).alias("k", "r"))
    return ranges.select("lang", F.col("k").cast("long").alias("k"), F.col("r.start").alias("first"), F.col("r.end").alias("stop"))


def path_existence(spark, d):
    docs = i.table(spark, d, "documents")
    records = docs.select(F.concat(F.lit("a/"), F.col("doc_id").cast("string")).alias("cast_path"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("b/"), F.col("doc_id").cast("string"))).alias("txt_path"))
    listing = docs.where("doc_id % 4 <> 0").select(F.concat(F.lit("a/"), F.col("doc_id").cast("string")).alias("path")).union(docs.where("doc_id % 2 = 0").select(F.concat(F.lit("b/"), F.col("doc_id").cast("string"))))
    return reports.path_existence(records, listing, ("cast_path", "txt_path"))


def missing_paths(spark, d):
    docs = i.table(spark, d, "documents")
    records = docs.select(F.concat(F.lit("a/"), F.col("doc_id").cast("string")).alias("cast_path"), F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("b/"), F.col("doc_id").cast("string"))).alias("txt_path"))
    listing = docs.where("doc_id % 4 <> 0").select(F.concat(F.lit("a/"), F.col("doc_id").cast("string")).alias("path"))
    return reports.missing_paths(records, listing, ("cast_path", "txt_path"))


def find_links(spark, d):
    pages = i.table(spark, d, "pages")
    return pages.select("page_id", tx.find_before(F.coalesce("html", F.lit("")), "</body>").alias("f")).select("page_id", "f.value", "f.place")


def all_between(spark, d):
    pages = i.table(spark, d, "pages")
    return pages.select("page_id", F.array_join(tx.all_between(F.coalesce("html", F.lit(""))), "|").alias("found"))


def file_ids(spark, d):
    pages = i.table(spark, d, "pages")
    return pages.select("page_id", tx.file_id(F.concat(F.lit("/x/y/"), F.regexp_replace("url", "[^a-z0-9]+", "-"), F.when(F.col("page_id") % 2 == 0, "_multi.json").otherwise(".json"))).alias("file_id"))


def page_dates(spark, d):
    pages = i.table(spark, d, "pages")
    return pages.select("page_id", tx.plain_time((F.col("page_id") * 86_400).cast("string")).alias("day"), tx.plain_date(F.lit("2024-01-02T03:04:05Z")).alias("iso"))


def retry_list(spark, d):
    pages = i.table(spark, d, "pages")
    v = F.when(F.col("page_id") % 4 == 0, "# comment").when(F.col("page_id") % 4 == 1, F.concat(F.lit('{"url": "'), "url", F.lit('", "error": 1}'))).when(F.col("page_id") % 4 == 2, "{bad").otherwise(F.col("url"))
    return files.retry_urls(pages.select(v.alias("value"))).groupBy("url").agg(F.count("*").alias("n"))


def config_lines(spark, d):
    pages = i.table(spark, d, "pages")
    v = F.concat(F.lit(" key"), F.col("page_id").cast("string"), F.lit(" = '"), F.col("page_id").cast("string"), F.lit("' # note"))
    return files.read_config(pages.select(F.when(F.col("page_id") % 5 == 0, "no setting").otherwise(v).alias("value")))


# ---------------------------------------------------------------- pages


def html_metadata(spark, d):
    pages = i.table(spark, d, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("html"))
    m = crawl.metadata(pages)
    return m.select("page_id", "title", F.size("links").cast("long").alias("n_links"), F.array_join("links", " ").alias("links"))


def strip_tags(spark, d):
    pages = i.table(spark, d, "pages")
    return pages.select("page_id", tx.remove_tags(F.coalesce("html", F.lit(""))).alias("text"))


def nearest_link(spark, d):
    pages = i.table(spark, d, "pages")
    return pages.select("page_id", tx.nearest_before(F.coalesce("html", F.lit("")), "</body>").alias("url"))


def upsert_urls(spark, d):
    pages = i.table(spark, d, "pages").select("url", "page_id")
    return crawl.upserted(pages.where("page_id % 3 <> 0"), pages.union(pages.where("page_id % 9 = 0")))


def fetched(spark, d):
    pages = i.table(spark, d, "pages")
    asked = pages.select("url").union(pages.select(F.concat("url", F.lit("/missing"))))
    return crawl.fetch(asked.distinct(), pages.where("page_id % 2 = 0").dropDuplicates(["url"])).groupBy("status").agg(F.count("*").alias("n"), F.count("error").alias("errors"))


# ---------------------------------------------------------------- events


def _events(spark, d):
    e = i.table(spark, d, "events")
    return e.withColumn("t", (F.unix_micros(F.col("ts").cast("timestamp")) - F.min(F.unix_micros(F.col("ts").cast("timestamp"))).over(W.partitionBy("user_id"))) / F.lit(1e6))


def event_type_counts(spark, d):
    e = i.table(spark, d, "events")
    return e.groupBy("user_id").agg(F.count("*").alias("total"), *[F.count_if(F.col("event_type") == k).alias(f"n_{k}") for k in ("click", "view", "purchase")])


def event_duration(spark, d):
    """Of each user: the last event in order, and the last less the first."""
    key = F.struct("ts", "event_id")
    g = _events(spark, d).groupBy("user_id").agg(F.max_by("t", key).alias("last"), F.min_by("t", key).alias("first"))
    return g.select("user_id", F.round("last", 2).alias("duration_v1"), F.round(F.col("last") - F.col("first"), 2).alias("duration_v2"))


def event_absolute_time(spark, d):
    """Gaps from times, then times from gaps."""
    e = _events(spark, d)
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    gaps = e.withColumn("gap", F.round(F.col("t") - F.lag("t", 1, 0.0).over(w), 6))
    total = F.sum("gap").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    return gaps.select("event_id", F.round(total * 1e6).cast("long").alias("t_us"))


def event_concat(spark, d):
    e = i.table(spark, d, "events")
    many = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("ts", "event_id", "event_type"))).alias("s"))
    return many.select("user_id", F.array_join(F.transform("s", lambda x: F.concat(x["event_type"], x["event_id"].cast("string"))), "").alias("output"))


def event_sessions(spark, d):
    """Sessions of a user with at most 30 minutes between events, in batch."""
    e = i.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    s = e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return s.select("user_id", F.unix_micros("w.start").alias("start_us"), "n")


# ---------------------------------------------------------------- recordings


def roundtrip(version: int, typed: bool = True):
    def query(spark, d, made=i.whole_turns):
        found = turns.extract_turns(casts.with_events(casts.with_version(i.synthetic_casts(spark, d, version, made, typed))))
        t = found.select(F.col("stem").cast("long").alias("file_id"), F.explode("turns").alias("x"))
        action, seen = F.col("x.content"), F.col("x.observation")
        # what is left of the echo and the next prompt
        cleaned = F.regexp_replace(tx.strip(F.regexp_replace(seen, F.lit("\\Q" + i.PROMPT.strip() + "\\E ?"), F.lit(""))), F.lit("\r"), F.lit(""))
        return t.select("file_id", F.col("x.turn_id").cast("long").alias("turn_id"), action.alias("action"), cleaned.alias("observation"))

    return query


def cast_versions(spark, d):
    odd = spark.createDataFrame([("", "e1"), ("\nx", "e2"), ("{bad", "e3"), ("[1]", "e4"), ('{"a":1}', "e5"), ('{"width":1,"height":2}\n[0.1,"o","x"]', "e6"), ('{"width":1,"height":2}\n{}', "e7"), ('{"version":7}', "e8")], "text string, stem string")
    all_ = odd
    for v in (1, 2, 3):
        all_ = all_.unionByName(i.synthetic_casts(spark, d, v).select("text", "stem"))
    return casts.with_version(all_).groupBy("version", "error").agg(F.count("*").alias("n"))


def cast_streams(spark, d):
    out = None
    for v in (1, 2, 3):
        s = casts.event_stream(casts.with_events(casts.with_version(i.synthetic_casts(spark, d, v))))
        one = s.groupBy("version").agg(F.count("*").alias("files"), F.sum("statistics.total_events").alias("total_events"), F.sum("statistics.input_events").alias("input_events"), F.sum("statistics.output_events").alias("output_events"), F.round(F.sum("statistics.duration"), 2).alias("duration"))
        out = one if out is None else out.unionByName(one)
    return out


def cast_report(spark, d):
    """The verifier over synthetic recordings and their final screens as texts."""
    found = turns.extract_turns(casts.with_events(casts.with_version(i.synthetic_casts(spark, d, 2))))
    texts = verify.final_screens(found).select("stem", F.col("screen").alias("text"))
    r = verify.report(found, texts)
    return r.groupBy("screen_match", "text_match").agg(F.count("*").alias("n"), F.sum("quality.empty_actions").alias("empty_actions"))


def cast_verification(spark, d):
    """Extractions put together again against the recording's own text."""
    found = turns.extract_turns(casts.with_events(casts.with_version(i.synthetic_casts(spark, d, 1))))
    truth = tx.clean_output("raw_all_output")
    v = found.select(verify.against_text("initial_output", "turns", truth, 1, sim.quick_ratio).alias("v"))
    return v.select("v.perfect_match", (F.col("v.similarity") > 0.9).alias("close")).groupBy("perfect_match", "close").agg(F.count("*").alias("n"))


def stream_check(spark, d):
    c = casts.with_events(casts.with_version(i.synthetic_casts(spark, d, 3)))
    m = verify.stream_matches(c, casts.event_stream(c))
    return m.groupBy("passed").agg(F.count("*").alias("n"))


def stream_output(spark, d):
    """What event streams of version 3 say that the terminal was sent, and when they end."""
    s = casts.event_stream(casts.with_events(casts.with_version(i.synthetic_casts(spark, d, 3))))
    said = F.array_join(F.transform(F.filter("stream", lambda e: e["type"] == "output"), lambda e: e["data"]), "")
    return s.select(F.col("stem").cast("long").alias("file_id"), said.alias("output"), F.try_element_at("stream", F.lit(-1))["t"].alias("ended"))


# ---------------------------------------------------------------- several parsers


def _judged(spark, d):
    """The winner is model_a, or model_c for every fifth conversation; every seventh was rejected, every eleventh failed."""
    t = i.models(spark, d).select("file_id").distinct()
    return t.select("file_id", (F.col("file_id") % 11 != 0).alias("success"), (F.col("file_id") % 7 != 0).alias("suitable"), F.when(F.col("file_id") % 13 == 0, "model_x").when(F.col("file_id") % 5 == 0, "model_c").otherwise("model_a").alias("winner"))


JUDGED = f"SELECT DISTINCT file_id, file_id % 11 <> 0 AS success, file_id % 7 <> 0 AS suitable, CASE WHEN file_id % 13 = 0 THEN 'model_x' WHEN file_id % 5 = 0 THEN 'model_c' ELSE 'model_a' END AS winner FROM ({T})"
MODELS = f"""
  SELECT file_id, 'model_a' AS model, turn_id, action, observation FROM ({T})
  UNION ALL SELECT file_id, 'model_b', turn_id, lower(action), lower(observation) FROM ({T})
  UNION ALL SELECT file_id, 'model_c', turn_id, action, observation FROM (SELECT *, max(turn_id) OVER (PARTITION BY file_id) AS last FROM ({T})) WHERE NOT (file_id % 3 = 0 AND turn_id = last)"""
COUNTS = f"""
  SELECT file_id, model, n_turns, count(*) OVER (PARTITION BY file_id) AS n_models, count(*) OVER (PARTITION BY file_id, n_turns) AS same_count
  FROM (SELECT f.file_id, f.model, coalesce(n, 0) AS n_turns FROM (SELECT file_id, m AS model FROM (SELECT DISTINCT file_id FROM ({T})), (SELECT unnest(['model_a', 'model_b', 'model_c']) AS m)) f
        LEFT JOIN (SELECT file_id, model, count(*) AS n FROM ({MODELS}) GROUP BY ALL) USING (file_id, model))"""
MAJORITY = f"SELECT c.file_id, winner, n_turns::BIGINT AS n_turns, same_count, n_models, same_count * 2 > n_models AS majority FROM ({COUNTS}) c JOIN ({JUDGED}) j USING (file_id) WHERE model = winner"
_JAC = "CASE WHEN {0} = '' AND {1} = '' THEN 1.0 WHEN {0} = '' OR {1} = '' THEN 0.0 ELSE len(list_intersect(list_distinct(string_split({0}, chr(10))), list_distinct(string_split({1}, chr(10))))) / len(list_distinct(string_split({0}, chr(10)) || string_split({1}, chr(10)))) END"
LIKENESS = f"""
  WITH c AS ({COUNTS}), m AS ({MODELS}), j AS ({JUDGED}),
  p AS (SELECT o.file_id, o.model, o.n_turns, j.winner FROM c o JOIN j USING (file_id) JOIN c w ON w.file_id = o.file_id AND w.model = j.winner AND w.n_turns = o.n_turns WHERE o.model <> j.winner)
  SELECT p.file_id, p.model, round(avg(CASE WHEN p.n_turns = 0 THEN 0.0 ELSE (({_JAC.format('a.action', 'b.action')}) + ({_JAC.format('a.observation', 'b.observation')})) / 2 END), 6) AS similarity
  FROM p LEFT JOIN m b ON b.file_id = p.file_id AND b.model = p.model LEFT JOIN m a ON a.file_id = p.file_id AND a.model = p.winner AND a.turn_id = b.turn_id GROUP BY ALL"""


def majority_turn_count(spark, d):
    m = evaluate.majority(i.models(spark, d), _judged(spark, d))
    return m.withColumn("n_turns", F.col("n_turns").cast("long"))


def similar_models(spark, d):
    return evaluate.model_similarity(i.models(spark, d), _judged(spark, d), sim.line_jaccard).withColumn("similarity", F.round("similarity", 6))


def evaluation_gate(spark, d):
    m, judged = i.models(spark, d), _judged(spark, d)
    originals = m.where("model = 'model_a' and file_id % 4 <> 0").select("file_id", evaluate.result_text("initial_output", "turns").alias("text"))
    return evaluate.gate(judged, m, originals, 0.3, ratio=sim.line_jaccard).select("file_id", F.coalesce("code", F.lit("success")).alias("code"))


GATE = f"""
  WITH mj AS ({MAJORITY}), l AS ({LIKENESS}), s AS (SELECT mj.file_id, 1 + count(*) FILTER (similarity >= 0.3) AS similar, any_value(n_models) AS n_models FROM mj LEFT JOIN l USING (file_id) GROUP BY mj.file_id)
  SELECT j.file_id, CASE WHEN NOT success THEN 'file_read_error' WHEN NOT suitable THEN 'judge_rejected' WHEN winner = 'model_x' THEN 'no_winner'
    WHEN NOT mj.majority THEN 'turn_count_minority' WHEN s.similar * 2 <= s.n_models THEN 'similar_models_minority' WHEN j.file_id % 4 = 0 THEN 'no_input_file' ELSE 'success' END AS code
  FROM ({JUDGED}) j LEFT JOIN (SELECT file_id, majority FROM mj) mj USING (file_id) LEFT JOIN s USING (file_id)"""


#: Signs that no text has: one at the start of each text, by which the ratio's blocks are found however often letters repeat, and others.
MARK, START, OTHER = "\u00a7\u2021", "\u00b6\u2021", "\u00a4\u2021"
TAIL = "\u00ac"


def evaluation_gate_ratio(spark, d):
    """All gates with the real ratio and its thresholds: model_b says what model_a says, model_c has nothing in common with them. Every
    seventeenth file comes again without any results; originals of every third file end in as much again of something else."""
    t = i.conversation_turns(spark, d)
    item = F.struct(F.col("turn_id").cast("int").alias("turn_id"), F.lit("$ ").alias("prompt"), F.concat(F.lit(MARK), "action").alias("input"), F.concat(F.lit(MARK), "observation").alias("output"))
    base = t.groupBy("file_id").agg(F.array_sort(F.collect_list(item)).alias("turns")).withColumn("initial_output", F.lit(START))
    other = F.transform("turns", lambda x: F.struct(x["turn_id"].alias("turn_id"), x["prompt"].alias("prompt"), F.lit(OTHER).alias("input"), F.lit(OTHER).alias("output")))
    cut = F.when(F.col("file_id") % 3 == 0, F.slice(other, 1, F.size("turns") - 1)).otherwise(other)
    both = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), x.alias("turns")) for m, x in (("model_a", F.col("turns")), ("model_b", F.col("turns")), ("model_c", cut))]))
    m = base.select("file_id", "initial_output", both.alias("r")).select("file_id", "initial_output", "r.*")
    judged = _judged(spark, d)
    again = judged.where("file_id % 17 = 0").select((-1 - F.col("file_id")).alias("file_id"), F.lit(True).alias("success"), F.lit(True).alias("suitable"), "winner")
    text = evaluate.result_text("initial_output", "turns")
    tail = F.when(F.col("file_id") % 3 == 1, F.concat(F.lit("\n"), F.repeat(F.lit(TAIL), F.length(text)))).otherwise("")
    originals = m.where("model = 'model_a' and file_id % 4 <> 0").select("file_id", F.concat(text, tail).alias("text"))
    return evaluate.gate(judged.unionByName(again), m, originals).select("file_id", F.coalesce("code", F.lit("success")).alias("code"), F.round("final_similarity", 6).alias("final_similarity"))


def outcome_counts(spark, d):
    o = evaluate.outcome_counts(evaluation_gate(spark, d).withColumn("code", F.nullif("code", F.lit("success"))))
    return o.withColumn("rate", F.round("rate", 6))


def fail_reasons(spark, d):
    r = evaluation_gate(spark, d).withColumn("fail_reason", F.when(F.col("code") != "success", F.concat("code", F.lit(": file "), F.col("file_id").cast("string"))))
    return evaluate.fail_reasons(r)


_GATE_TEXT = f"'{START}' || chr(10) || string_agg('$ {MARK}' || action || chr(10) || '{MARK}' || observation, chr(10) ORDER BY turn_id)"
_TAIL = f"CASE WHEN file_id % 3 = 1 THEN chr(10) || repeat('{TAIL}', length(text)) ELSE '' END"


def _collapsed(text: str) -> str:
    lines = rf"regexp_replace({text}, '[ \t\r\x0b\f]+(\n|\z)', '\1', 'g')"
    return STRIP.format(f"regexp_replace({lines}, '\\n{{3,}}', chr(10) || chr(10), 'g')")


GATE_RATIO = f"""
  WITH f AS (SELECT file_id, {_GATE_TEXT} AS text FROM ({T}) GROUP BY file_id),
  n AS (SELECT file_id, length({_collapsed('text')}) AS a, length({_collapsed(f"text || {_TAIL}")}) AS b FROM f),
  j AS (SELECT * FROM ({JUDGED}) UNION ALL SELECT -1 - file_id, true, true, winner FROM ({JUDGED}) WHERE file_id % 17 = 0),
  c AS (SELECT j.file_id, a, b, CASE WHEN NOT success THEN 'file_read_error' WHEN NOT suitable THEN 'judge_rejected' WHEN j.file_id < 0 THEN 'no_results' WHEN winner = 'model_x' THEN 'no_winner'
      WHEN winner = 'model_c' AND j.file_id % 3 = 0 THEN 'turn_count_minority' WHEN winner = 'model_c' THEN 'similar_models_minority' WHEN j.file_id % 4 = 0 THEN 'no_input_file' END AS early
    FROM j LEFT JOIN n USING (file_id))
  SELECT file_id, coalesce(early, CASE WHEN 2.0 * a / (a + b) < 0.85 THEN 'low_final_similarity' ELSE 'success' END) AS code, CASE WHEN early IS NULL THEN round(2.0 * a / (a + b), 6)::DOUBLE END AS final_similarity FROM c"""


def judge_routes(spark, d):
    reply = F.when(F.col("doc_id") % 5 == 0, None).otherwise(F.concat(F.lit('{"winner":"model_'), F.when(F.col("quality") == 1, "b").otherwise("z"), F.lit('","suitable_for_training":'), F.when(F.col("toxic") == 1, "false").otherwise("true"), F.lit(',"rejection_type":"'), F.when(F.col("doc_id") % 2 == 0, "toxic").otherwise(""), F.lit('"}')))
    j = i.table(spark, d, "labels").select("doc_id", evaluate.judge_defaults(reply).alias("j")).select("doc_id", "j.*", F.array(F.lit("model_a"), F.lit("model_b")).alias("labels"))
    return evaluate.routed(j).groupBy(F.coalesce("route", F.lit("none")).alias("route")).agg(F.count("*").alias("n"))


QUERIES = {
    "normalize_text": normalize_text, "collapse_blank_lines": collapse_blank_lines, "line_jaccard": line_jaccard, "boxed_result": boxed_result,
    "json_fence": json_fence, "tolerant_json": tolerant_json, "llm_verdict_counts": lambda s, d: curate.verdict_counts(verdicts(s, d)),
    "three_valued": three_valued, "suitable_join": suitable_join, "resume_remaining": resume_remaining, "token_gate": token_gate,
    "txt_commands": txt_commands, "natural_sort": natural_sort, "stratified_sample": stratified_sample, "chunk_ranges": chunk_ranges,
    "path_existence": path_existence, "retry_list": retry_list, "config_lines": config_lines, "html_metadata": html_metadata,
    "strip_tags": strip_tags, "nearest_link": nearest_link, "upsert_urls": upsert_urls, "fetched_pages": fetched,
    "event_type_counts": event_type_counts, "event_duration": event_duration, "event_absolute_time": event_absolute_time,
    "event_concat": event_concat, "event_sessions": event_sessions,
    "cast_roundtrip_v1": roundtrip(1), "cast_roundtrip_v2": roundtrip(2), "cast_roundtrip_v3": roundtrip(3), "cast_versions": cast_versions,
    "cast_streams": cast_streams, "cast_report": cast_report, "cast_verification": cast_verification, "stream_check": stream_check,
    "majority_turn_count": majority_turn_count, "similar_models": similar_models, "evaluation_gate": evaluation_gate,
    "outcome_counts": outcome_counts, "fail_reasons": fail_reasons, "judge_routes": judge_routes,
    "cast_inferred_v2": roundtrip(2, False), "cast_inferred_v3": roundtrip(3, False), "evaluation_gate_ratio": evaluation_gate_ratio,
    "stream_output": stream_output, "missing_paths": missing_paths, "find_links": find_links, "all_between": all_between, "file_ids": file_ids, "page_dates": page_dates,
}

VERDICTS = "SELECT d.doc_id, d.lang, d.source, CASE WHEN quality IS NULL THEN NULL ELSE quality = 1 END AS result FROM documents d LEFT JOIN labels USING (doc_id)"
COLLAPSED = STRIP.format(f"regexp_replace({RSTRIP.format(MESSY)}, '\\n{{3,}}', chr(10) || chr(10), 'g')")
US = "(epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) / 1e6"
FILES = f"SELECT file_id, count(*) AS n FROM ({i.WHOLE_SQL}) GROUP BY file_id"
ORACLE_SQL = {
    "normalize_text": f"SELECT doc_id, {STRIP.format(RSTRIP.format(MESSY))} AS screen, {STRIP.format(RSTRIP.format(MESSY))} AS v2, {STRIP.format(MESSY)} AS v1 FROM documents",
    "collapse_blank_lines": f"SELECT doc_id, {COLLAPSED} AS text FROM documents",
    "line_jaccard": "SELECT doc_id, round(len(list_intersect(list_distinct(l), list_distinct(m))) / len(list_distinct(l || m)), 6) AS jaccard FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l, string_split(coalesce(text, '') || chr(10) || 'more' || chr(10) || 'lines', chr(10)) AS m FROM documents)",
    "boxed_result": "SELECT doc_id, CASE WHEN quality = 1 THEN true WHEN toxic = 1 THEN false END AS result FROM labels JOIN documents USING (doc_id)",
    "json_fence": "SELECT doc_id, doc_id AS id, replace(coalesce(text, ''), '`', chr(39)) AS text FROM documents",
    "tolerant_json": f"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN doc_id END AS id, CASE WHEN doc_id % 2 = 0 THEN translate(coalesce(text, ''), '{SIGNS}', '    ') END AS text FROM documents",
    "llm_verdict_counts": f"SELECT count(*) AS total, count(*) FILTER (result) AS suitable, count(*) FILTER (NOT result) AS not_suitable, count(*) FILTER (result IS NULL) AS errors FROM ({VERDICTS})",
    "three_valued": f"SELECT lang, count(*) FILTER (result) AS passed, count(*) FILTER (NOT result) AS failed, count(*) FILTER (result IS NULL) AS not_applicable FROM ({VERDICTS}) GROUP BY ROLLUP (lang)",
    "suitable_join": f"SELECT doc_id % 5 = 0 AS missing, count(*) AS n, count(DISTINCT CASE WHEN doc_id % 5 <> 0 THEN source END) AS sources FROM ({VERDICTS}) WHERE result GROUP BY 1",
    "resume_remaining": "SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)",
    "token_gate": r"SELECT n > 300 AS too_large, count(*) AS n, CAST(sum(n) AS BIGINT) AS tokens FROM (SELECT len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> '')) AS n FROM documents) GROUP BY 1",
    # white space behind a prompt may hold a line's end: an empty line takes the next one for its command
    "txt_commands": r"""
      SELECT doc_id, array_to_string(['ls -l'] || list_filter(list_transform(l, lambda x, k: CASE WHEN trim(x, ' ') <> '' THEN trim(x, ' ') WHEN k < len(l) THEN 'out' ELSE '' END), lambda x: x <> ''), '|') AS commands
      FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '[^A-Za-z\n ]', '', 'g'), chr(10)) AS l FROM documents)""",
    "natural_sort": "SELECT source, 'File' || doc_id || 'x' || n_chars AS name, row_number() OVER (PARTITION BY source ORDER BY doc_id, n_chars) AS place FROM documents",
    "stratified_sample": "SELECT lang AS version, doc_id::VARCHAR AS name FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id::VARCHAR) <= 20",
    "chunk_ranges": "SELECT lang, k, k * 10 AS first, least(k * 10 + 10, total) AS stop FROM (SELECT lang, total, unnest(range(0, CASE WHEN total % 10 = 0 AND total <> 10 THEN total // 10 + 1 ELSE (total + 9) // 10 END)) AS k FROM (SELECT lang, count(*) AS total FROM documents GROUP BY lang))",
    "path_existence": """
      SELECT field, count(*) FILTER (here) AS existing, count(*) FILTER (NOT here) AS missing, round(100.0 * count(*) FILTER (here) / count(*), 2) AS percent
      FROM (SELECT 'cast_path' AS field, doc_id % 4 <> 0 AS here FROM documents UNION ALL SELECT 'txt_path', doc_id % 2 = 0 FROM documents WHERE doc_id % 3 <> 0) GROUP BY field""",
    "retry_list": "SELECT url, count(*) AS n FROM pages WHERE page_id % 2 = 1 GROUP BY url",
    "config_lines": "SELECT 'key' || page_id AS key, page_id::VARCHAR AS setting FROM pages WHERE page_id % 5 <> 0",
    "html_metadata": r"""
      SELECT page_id, regexp_replace(regexp_replace(regexp_extract(h, '(?s)<title>(.*?)<', 1), '\A\s+', ''), '\s+\z', '') AS title, len(l) AS n_links, array_to_string(l, ' ') AS links
      FROM (SELECT page_id, coalesce(html, '') AS h, regexp_extract_all(coalesce(html, ''), 'href="([^"]*)"', 1) AS l FROM pages)""",
    "strip_tags": """
      WITH RECURSIVE r AS (SELECT page_id, coalesce(html, '') AS t FROM pages
        UNION ALL SELECT page_id, regexp_replace(t, '<[^<>]*>', '', 'g') FROM r WHERE regexp_matches(t, '<[^<>]*>'))
      SELECT page_id, t AS text FROM r WHERE NOT regexp_matches(t, '<[^<>]*>')""",
    "nearest_link": """SELECT page_id, regexp_extract(coalesce(html, ''), '(?s)^.*href="([^"]*)".*?</body>', 1) AS url FROM pages""",
    "upsert_urls": "WITH old AS (SELECT url, page_id FROM pages WHERE page_id % 3 <> 0), batch AS (SELECT url, page_id FROM pages UNION ALL SELECT url, page_id FROM pages WHERE page_id % 9 = 0) FROM old UNION ALL SELECT url, page_id FROM batch ANTI JOIN old USING (url)",
    "fetched_pages": "WITH a AS (SELECT url FROM pages UNION SELECT url || '/missing' FROM pages), h AS (SELECT DISTINCT url, true AS here FROM pages WHERE page_id % 2 = 0 AND html IS NOT NULL) SELECT CAST(CASE WHEN here THEN 200 ELSE 0 END AS INTEGER) AS status, count(*) AS n, count(*) FILTER (here IS NULL) AS errors FROM a LEFT JOIN h USING (url) GROUP BY 1",
    "event_type_counts": "SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'click') AS n_click, count(*) FILTER (event_type = 'view') AS n_view, count(*) FILTER (event_type = 'purchase') AS n_purchase FROM events GROUP BY user_id",
    "event_duration": f"SELECT user_id, round(max(t), 2) AS duration_v1, round(max(t) - min(t), 2) AS duration_v2 FROM (SELECT user_id, {US} AS t FROM events) GROUP BY user_id",
    "event_absolute_time": "SELECT event_id, epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id) AS t_us FROM events",
    "event_concat": "SELECT user_id, string_agg(event_type || event_id, '' ORDER BY ts, event_id) AS output FROM events GROUP BY user_id",
    "event_sessions": """
      SELECT user_id, min(epoch_us(ts)) AS start_us, count(*) AS n FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM (
          SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, session""",
    "cast_roundtrip_v1": i.INFERRED_SQL, "cast_inferred_v2": i.INFERRED_SQL, "cast_inferred_v3": i.INFERRED_SQL, "cast_roundtrip_v2": i.WHOLE_SQL, "cast_roundtrip_v3": i.WHOLE_SQL,
    "cast_versions": f"""
      SELECT version::INTEGER AS version, error, sum(n)::BIGINT AS n FROM (
        SELECT 1 AS version, NULL AS error, count(*) AS n FROM ({FILES}) UNION ALL SELECT 2, NULL, count(*) + 1 FROM ({FILES}) UNION ALL SELECT 3, NULL, count(*) FROM ({FILES})
        UNION ALL VALUES (NULL, 'Empty file', 1), (NULL, 'Empty first line', 1), (NULL, 'Invalid JSON in first line', 1), (NULL, 'First line is not an object', 1), (NULL, 'Unknown format', 3)) GROUP BY version, error""",
    "cast_streams": f"""
      SELECT version::INTEGER AS version, count(*) AS files, sum(1 + n * (CASE version WHEN 1 THEN 2 ELSE 3 END))::BIGINT AS total_events, sum(CASE version WHEN 1 THEN 0 ELSE n END)::BIGINT AS input_events,
        sum(1 + n * 2)::BIGINT AS output_events, round(sum(0.25 * (CASE version WHEN 1 THEN 1 + n * 2 WHEN 2 THEN n * 3 ELSE 1 + n * 3 END)), 2)::DOUBLE AS duration
      FROM ({FILES}), (SELECT unnest([1, 2, 3]) AS version) GROUP BY version""",
    "stream_check": f"SELECT true AS passed, count(*) AS n FROM ({FILES})",
    "majority_turn_count": MAJORITY, "similar_models": LIKENESS, "evaluation_gate": GATE,
    "outcome_counts": f"SELECT code AS outcome, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS rate FROM ({GATE}) GROUP BY code",
    "fail_reasons": f"SELECT code AS reason, count(*) AS n FROM ({GATE}) WHERE code <> 'success' GROUP BY code",
    "evaluation_gate_ratio": GATE_RATIO,
    "stream_output": f"""
      SELECT file_id, '{i.PROMPT}' || string_agg(action || chr(13) || chr(10) || observation || chr(13) || chr(10) || '{i.PROMPT}', '' ORDER BY turn_id) AS output, (0.25 * (1 + 3 * count(*)))::DOUBLE AS ended
      FROM ({i.WHOLE_SQL}) GROUP BY file_id""",
    "missing_paths": """
      WITH p AS (SELECT 'cast_path' AS field, 'a/' || doc_id AS path, doc_id % 4 <> 0 AS here FROM documents UNION ALL SELECT 'txt_path', 'b/' || doc_id, false FROM documents WHERE doc_id % 3 <> 0)
      SELECT field, path FROM p WHERE NOT here QUALIFY row_number() OVER (PARTITION BY field ORDER BY path) <= 100""",
    "find_links": """
      WITH h AS (SELECT page_id, coalesce(html, '') AS h, instr(coalesce(html, ''), '</body>') AS p FROM pages), k AS (SELECT *, contains(substr(h, 1, greatest(p - 1, 0)), 'href="') AS known FROM h)
      SELECT page_id, CASE WHEN p > 0 AND known THEN regexp_extract(substr(h, 1, p - 1), '(?s)^.*href="([^"]*)', 1) ELSE '' END AS value, (CASE WHEN p = 0 THEN -1 WHEN NOT known THEN -2 ELSE p - 1 END)::BIGINT AS place FROM k""",
    "all_between": """SELECT page_id, array_to_string(regexp_extract_all(coalesce(html, ''), '(?s)">(.*?)<', 1), '|') AS found FROM pages""",
    "file_ids": "SELECT page_id, regexp_replace(url, '[^a-z0-9]+', '-', 'g') AS file_id FROM pages",
    "page_dates": "SELECT page_id, strftime(DATE '1970-01-01' + page_id::INTEGER, '%Y.%m.%d') AS day, '2024-01-0203:04:05' AS iso FROM pages",
    "judge_routes": """
      SELECT CASE WHEN doc_id % 5 = 0 THEN 'rejected/empty' WHEN toxic = 1 THEN CASE WHEN doc_id % 2 = 0 THEN 'rejected/toxic' ELSE 'rejected/empty' END WHEN quality = 1 THEN 'results' ELSE 'none' END AS route, count(*) AS n FROM labels GROUP BY 1""",
}
