"""Turn extraction on recordings written by hand, and the file sources."""

import json
import time

from pyspark.sql import functions as F

from termloom.functions import heuristics as h
from termloom.operators import segment, turns as t, verify
from termloom.sources import casts, files, sinks

KNOWN = frozenset(h.COMMANDS)


def typed(events, version=2):
    return t.extract(events, version, KNOWN)


def test_typed_session():
    r = typed([(0.0, "o", "$ "), (1.0, "i", "l"), (1.5, "i", "s\r"), (2.0, "o", "ls\r\na b\r\n$ "), (2.25, "m", "here"), (2.5, "r", "90x30"), (3.0, "x", "0")])
    (turn,) = r["turns"]
    assert r["initial_output"] == "$ " and r["raw_all_output"] == "$ ls\r\na b\r\n$ "
    assert (turn["turn_id"], turn["type"], turn["content"], turn["raw_input"], turn["timestamp"], turn["confidence"]) == (1, "command", "ls", "ls\r", 1.0, 1.0)
    assert (turn["observation"], turn["duration_ms"]) == ("a b\n$ ", 1000.0)
    assert turn["markers"] == [{"timestamp": 2.25, "data": "here"}] and turn["resizes"] == ["90x30"] and turn["exit_status"] is None


def test_version_3_notes_and_programs():
    r = typed([(1.0, "i", "ssh h\r"), (2.0, "m", "x"), (3.0, "x", "7")], 3)
    assert (r["turns"][0]["type"], r["turns"][0]["markers"], r["turns"][0]["exit_status"]) == ("command", None, "7")
    r = typed([(1.0, "i", "ssh h\r")])
    assert (r["turns"][0]["type"], r["turns"][0]["program"]) == ("interactive_program", "ssh")


def test_start_at_zero():
    assert typed([(0.0, "i", "a"), (4.0, "i", "\r")])["turns"][0]["timestamp"] == 4.0
    events = [(0.0, "i", "cat <<E\n"), (5.0, "i", "x\nE\n")]
    assert typed(events)["turns"][0]["timestamp"] == 0.0
    assert typed(events, 3)["turns"][0]["timestamp"] == 5.0


def test_heredoc():
    r = typed([(1.0, "i", "cat <<EOF\n"), (2.0, "i", "one\n"), (3.0, "i", "EOF\n"), (4.0, "o", "one\r\n"), (5.0, "i", "ls\r")])
    assert [(x["type"], x["content"]) for x in r["turns"]] == [("heredoc", "cat <<EOF\none\nEOF"), ("command", "ls")]
    assert r["turns"][0]["confidence"] is None and r["turns"][0]["observation"] == "one\n"
    # a delimiter that comes key by key never closes
    assert typed([(1.0, "i", "cat <<EOF\n"), (2.0, "i", "E"), (3.0, "i", "O"), (4.0, "i", "F"), (5.0, "i", "\r"), (6.0, "i", "ls\r")])["turns"] == []


def test_full_screen_keys():
    r = typed([(1.0, "i", "vim x\r"), (2.0, "o", "\x1b[?1049h"), (3.0, "i", ":"), (4.0, "i", "q\r"), (5.0, "o", "\x1b[?1049l$ ")])
    (turn,) = r["turns"]
    assert turn["keystrokes"] == [":", "q\r"] and turn["alternate_screen_used"] and turn["program"] == "vim"


def test_unfinished_input_and_blank_lines():
    r = typed([(1.0, "i", "\r"), (2.0, "i", "half")])
    assert [(x["content"], x["confidence"]) for x in r["turns"]] == [("", 0.5)]


def test_inferred():
    out = "hello\nme@box:~$ ls -l\nfile\nme@box:~$ make all\ndone\nme@box:~$ "
    r = t.extract([(0.5, "o", out)], 2, KNOWN)
    assert r["initial_output"] == "hello\nme@box:~$ "
    assert [(x["content"], x["observation"], x["confidence"]) for x in r["turns"]] == [("ls -l", "file\nme@box:~$ ", 0.8), ("make all", "done\nme@box:~$ ", 0.8)]
    assert r["turns"][0]["raw_output"] == "me@box:~$ ls -l\nfile\nme@box:~$ "
    one = t.extract([(0.5, "o", out)], 1, KNOWN)
    assert [(x["content"], x["observation"], x["confidence"]) for x in one["turns"]] == [("ls -l", "file\nme@box:~$", 0.95), ("make all", "done\nme@box:~$", 0.95)]


def test_inferred_losses():
    # a rejected match ends the observation before it, and what follows it is in no turn
    out = "$ ls\na\n> Welcome to x\nlost\n$ pwd\n/b\n"
    r = t.extract([(0.0, "o", out)], 2, KNOWN)
    assert [(x["content"], x["observation"]) for x in r["turns"]] == [("ls", "a\n> "), ("pwd", "/b\n")]
    assert t.extract([(0.0, "o", "no prompt")], 2, KNOWN) == {"initial_output": "no prompt", "raw_all_output": "no prompt", "turns": []}
    # percent behind a digit and > behind = are no prompts; an unknown word is no command in version 1
    assert t.extract([(0.0, "o", "50% done\n==> x y\n")], 2, KNOWN)["turns"] == []
    assert t.extract([(0.0, "o", "$ frobnicate\nx\n")], 1, KNOWN)["turns"] == []
    # an empty prompt line takes the next line for its command; a last line without an end is no turn
    assert [x["content"] for x in t.extract([(0.0, "o", "$ \nls\n$ pwd")], 2, KNOWN)["turns"]] == ["ls"]


V1 = json.dumps({"version": 1, "width": 90, "stdout": [[0.5, "a"], ["bad"], [0.25, "b"]]})
V2 = '{"version":2,"width":10,"height":5,"duration":9.5,"env":{"SHELL":"/bin/zsh"}}\n\n[0.5,"o","a\\u00e9"]\nnot json\n[1.5,"i","l"]\n[2]\n[3.5,"q","z"]\n{"version":2,"width":99}\n'
V3 = '{"version":3,"term":{"cols":70,"rows":20,"type":"xt"}}\n# note\n[0.5,"o","x"]\n[0.25,"x","0"]\n'


def test_sources(spark, tmp_path):
    for v, name, text in ((1, "a", V1), (2, "b", V2), (3, "c", V3), (2, "d", " \n")):
        (tmp_path / f"v{v}").mkdir(exist_ok=True)
        (tmp_path / f"v{v}" / f"{name}.cast").write_text(text)
    (tmp_path / "v1" / "bad.cast").write_bytes(b"\xff\xfe{")
    (tmp_path / "stray.cast").write_text(V1)
    got = {r.stem: r for r in casts.read_casts(spark, str(tmp_path)).collect()}
    assert set(got) == {"a", "b", "c", "d", "bad"}
    assert [tuple(e) for e in got["a"].events] == [(0.5, "o", "a"), (0.75, "o", "b")] and got["a"].header.width == 90
    assert [tuple(e) for e in got["b"].events] == [(0.5, "o", "aé"), (1.5, "i", "l"), (3.5, "q", "z")]
    assert (got["b"].header.width, got["b"].header.height) == (99, 24)  # the last header counts
    assert [tuple(e) for e in got["c"].events] == [(0.5, "o", "x"), (0.75, "x", "0")] and got["c"].header.term == "xt"
    assert (got["d"].version, got["d"].error, got["bad"].error) == (None, "Empty file", "Not UTF-8")
    s = {r.stem: r for r in casts.event_stream(casts.read_casts(spark, str(tmp_path)).where("version is not null")).collect()}
    assert [e.type for e in s["b"].stream] == ["output", "input", "q"] and s["b"].statistics.duration == 3.0
    assert (s["c"].statistics.duration, s["c"].statistics.exit_events, s["a"].statistics.duration) == (0.75, 1, 0.75)
    txt = tmp_path / "t"
    txt.mkdir()
    (txt / "x.txt").write_bytes(b"a\r\nb\rc\xff\n")
    assert [r.text for r in casts.read_texts(spark, str(txt), errors="ignore").collect()] == ["a\nb\nc\n"]
    assert [r.text for r in casts.read_texts(spark, str(txt)).collect()] == [None]


def test_extraction_and_reports(spark, tmp_path):
    session = '{"version":2,"width":40,"height":5}\n' + "\n".join(json.dumps(e) for e in ([0.1, "o", "$ "], [1.0, "i", "ls\r"], [1.1, "o", "ls\r\nfile\r\n$ "], [2.0, "i", "exit\r"], [2.1, "o", "exit\r\n"])) + "\n"
    df = spark.createDataFrame([("a", session), ("b", "")], "stem string, text string").withColumn("path", F.col("stem"))
    found = t.extract_turns(casts.with_events(casts.with_version(df)))
    rows = {r.stem: r for r in found.collect()}
    assert rows["b"].turns is None and [x.content for x in rows["a"].turns] == ["ls", "exit"]
    truth = spark.createDataFrame([("a", "$ ls\nfile\n$ exit\n")], "stem string, text string")
    r = verify.report(found.where("version = 2"), truth).first()
    assert (r.screen_match, r.text_match, r.commands.status, r.commands.total, tuple(r.quality)) == ("exact", True, "match", 2, (2, 0, 1))
    v = found.where("version = 2").select(verify.against_text("initial_output", "turns", F.lit("$ ls\nfile\n$ exit\n")).alias("v")).first().v
    assert v.perfect_match and v.similarity == 1.0
    docs = found.where("version = 2").drop("text", "header", "events")
    sinks.write_documents(docs, f"{tmp_path}/docs")
    assert spark.read.parquet(f"{tmp_path}/docs").first().version == 2
    sinks.append_results(spark.createDataFrame([("k1",), ("k1",)], "file_id string"), f"{tmp_path}/r")
    sinks.append_results(spark.createDataFrame([("k1",), ("k2",)], "file_id string"), f"{tmp_path}/r")
    assert sorted(r.file_id for r in spark.read.parquet(f"{tmp_path}/r").collect()) == ["k1", "k2"]


def test_many_events(spark):
    """Cost grows with a recording's length: 100,000 events and turns."""
    text = '{"version":3,"term":{"cols":80,"rows":24}}\n' + '[0.25,"o","x"]\n' * 100_000
    df = spark.createDataFrame([("a", text)], "stem string, text string").withColumn("path", F.col("stem"))
    began = time.time()
    last = casts.with_events(casts.with_version(df)).select(F.size("events").alias("n"), F.try_element_at("events", F.lit(-1))["t"].alias("t")).first()
    assert tuple(last) == (100_000, 25_000.0) and time.time() - began < 60
    turns = F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: F.struct(F.lit("ls").alias("content"), F.lit("a ").alias("observation")))
    assert spark.range(1).select(F.length(t.session_text(F.lit("$"), turns)).alias("n")).first().n == 1 + 1 + 100_000 * 5


def test_the_last_reply_counts(spark):
    turns = spark.createDataFrame([("f", 1, "$", "$ ls\na")], "file_id string, turn_id int, prompt string, raw_text string")
    replies = spark.createDataFrame([("f", 1, ["x"], ["1"], 1), ("f", 1, ["z"], ["3"], 3), ("f", 1, ["y"], ["2"], 2)], "file_id string, turn_id int, action_lines array<string>, observation_lines array<string>, seq int")
    assert [(r.action, r.observation) for r in segment.classified(turns, replies).collect()] == [("z", "3")]
    assert [r.action for r in segment.classified(turns, replies.drop("seq").coalesce(1)).collect()] == ["y"]


def test_segments(spark):
    texts = spark.createDataFrame([("f", "intro\n$ ls\na\n# top\nb"), ("g", "nothing")], "file_id string, text string")
    rows = segment.lines(texts)
    none = spark.createDataFrame([], "file_id string, patterns array<string>")
    found = segment.candidates(rows, none)
    verdict = spark.createDataFrame([("f", [2], [4])], "file_id string, confirmed array<int>, false_positives array<int>")
    assert [(r.line_no, r.prompt) for r in segment.confirmed(found, verdict).collect()] == [(2, "$ ")]
    everything = segment.confirmed(found, verdict.limit(0))
    got = {(r.file_id, r.turn_id): (r.prompt, r.raw_text) for r in segment.to_turns(rows, everything).collect()}
    assert got == {("f", 0): (None, "intro"), ("f", 1): ("$ ", "$ ls\na"), ("f", 2): ("# ", "# top\nb"), ("g", 0): (None, "nothing")}
    part = "array<struct<prompt:string,action:string,observation:string>>"
    turns = spark.createDataFrame([("f", 1, "$", "a", "x"), ("f", 2, "$", "b", "y")], "file_id string, turn_id int, prompt string, action string, observation string")
    patches = spark.createDataFrame([("f", 1, 1, None, "A", None), ("f", 2, 1, [("$", "b1", ""), ("$", "b2", "y")], None, None)], f"file_id string, turn_id int, seq int, parts {part}, action string, observation string")
    missed = spark.createDataFrame([("f", 1, "$", "m", "o")], "file_id string, position int, prompt string, action string, observation string")
    assert [(r.turn_id, r.action, r.observation) for r in segment.patched(turns, patches, missed).orderBy("turn_id").collect()] == [(1, "m", "o"), (2, "A", "x"), (3, "b1", ""), (4, "b2", "y")]
    assert spark.range(1).select(segment.merged_initial(F.lit("i"), F.lit("p")).alias("x")).first().x == "i\np"


def test_plain_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text('n,p,2024-01-02T03:04:05Z,"two\nlines ""q""",s,t,sh,title,u,"1,234"\n')
    r = files.read_metadata_csv(spark, str(tmp_path / "m.csv")).first()
    assert (r.author.name, r.date, r.views, r.description) == ("n", "2024-01-0203:04:05", 1234, 'two\nlines "q"')
    lines = spark.createDataFrame([("# c",), ("",), ('{"url": "a", "x": 1}',), ("{bad",), ("b",)], "value string")
    assert [x.url for x in files.retry_urls(lines).collect()] == ["a", "b"]
    conf = spark.createDataFrame([("a = 'x' # c",), ("no",), ("b=1=2",)], "value string")
    assert [tuple(x) for x in files.read_config(conf).collect()] == [("a", "x"), ("b", "1=2")]
    doc = {"winner": "model_a", "models": {"model_a": "m"}, "all_results": {"model_a": {"initial_output": "i", "turns": [{"turn_id": 1, "prompt": "$", "input": {"content": "ls"}, "output": {"content": "o"}}]}, "model_b": {"initial_output": ""}}}
    (tmp_path / "7_multi.json").write_text(json.dumps(doc))
    judged = files.read_judged(spark, str(tmp_path))
    assert [(x.file_id, x.success, x.suitable) for x in judged.collect()] == [("7", True, True)]
    assert sorted((x.model, len(x.turns)) for x in files.model_rows(judged).collect()) == [("model_a", 1), ("model_b", 0)]
