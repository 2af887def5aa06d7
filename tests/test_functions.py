"""Column functions against plain Python, and the terminal against screens drawn by hand."""

import difflib
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from termloom.functions import heuristics as h, responses, similarity as sim, text as tx
from termloom.functions.terminal import Screen, fold, fold_backspaces, screen
from termloom.operators import turns as t


def one(spark, values, fn):
    rows = [(k, v) for k, v in enumerate(values)]
    return [r[0] for r in spark.createDataFrame(rows, "k int, c string").orderBy("k").select(fn(F.col("c"))).collect()]


def test_display_order(spark):
    texts = ["\x1b]0;t\x07a", "\x1b]0;t\x1b\\b\x07c", "\x1b[1;31mred\x1b[0m", "\x1b(Bx\x1b)0y", "\x1b=k\x1b>", "\x1b7qA", "tab\tbs\bend\r\n", "a\x00\x7fb\x0bc", "", None]
    want = ["a", "c", "red", "xy", "k", "A", "tab\tbs\bend\n", "abc", "", None]
    assert one(spark, texts, tx.clean_output) == want
    assert [None if x is None else t.shown(x) for x in texts] == want


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab\x1b[]()m;0?\x07\\\r\n\t\b7="), max_size=25))
def test_shown_equals_the_plain_chain(text):
    want = text
    for p in t._DISPLAY:
        want = p.sub("", want)
    assert t.shown(text) == want.replace("\r\n", "\n")


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abc\b\r\n"), max_size=25))
def test_fold(text):
    lines = []
    for line in text.split("\n"):
        cells, at = [], 0
        for c in line:
            if c == "\r":
                at = 0
            elif c == "\b":
                at = max(at - 1, 0)
            else:
                cells[at : at + 1] = [c]
                at += 1
        lines.append("".join(cells))
    assert fold(text) == "\n".join(lines)


def test_fold_column(spark):
    assert one(spark, ["abc\b\bX", "abc\rZ", None, "plain"], fold_backspaces) == ["aXc", "Zbc", None, "plain"]


@pytest.mark.parametrize(
    "text,want",
    [
        ("one\r\ntwo", "one\ntwo"),
        ("abcdefghijkl", "abcdefghij\nkl"),
        ("a\tb", "a       b"),
        ("abc\b\bX", "aXc"),
        ("abc\rX\x1b[K", "X"),
        ("x\x1b[3;2Hy", "x\n\n y"),
        ("x\ny\x1b[Az", "xz\ny"),
        ("x\x1b[Bz", "x\n z"),
        ("x\x1b[3Cz\x1b[2Dw", "x  wz"),
        ("1\n2\n3\n4", "2\n3\n4"),
        ("old\x1b[2Jnew", "new"),
        ("\x1b]0;title\x07a\x1b]0;t\x1b\\b\x1b]open", "ab"),
        ("\x1b(Bx", "(Bx"),
        ("\x1b[", "["),
        ("\x1b[31mred\x1b[0m", "red"),
        ("\x1b[;5Hx\x1b[?25l", "    x"),
    ],
)
def test_screen(text, want):
    assert Screen(10, 3).feed(text).text() == want


def test_screen_column(spark):
    assert one(spark, ["a\x1b[2Db", None], lambda c: screen(c, 20, 5)) == ["b", None]
    assert len(Screen().feed("\n" * 12_000).lines) == Screen.MOST_LINES


def test_commands(spark):
    texts = ["[me@box ~]$ ls -l", "~/x (1.9) % make", "➜ git st", "~ pwd", "tool ? ❯ go", "plain cmd\r", "ab\bc", "\x1b[1mls\x1b[0m\n"]
    assert one(spark, texts, tx.clean_command) == ["ls -l", "make", "git st", "pwd", "go", "plain cmd", "ac", "ls"]
    assert [t.command_text(x) for x in texts] == ["ls -l", "make", "git st", "pwd", "go", "plain cmd", "ac", "ls"]


OUTPUTS = ["", "x", "50% [==>  ]", "12:00:01 up", "2024-01-01", "[Working]", "Welcome to x", "score: 3", "==========" * 2, "│ ─┌", ">>> x", "1 2 3 4 5 6 7 8 9 10", "y" * 201, "npm WARN x", "10 KB/s", "[Q] Quit"]
COMMANDS = ["ls -l", "git status", "./run.sh now", "make all", "A=1 b", "cd ..", "?? what", "docker ps"]


def test_output_and_commands(spark):
    assert one(spark, OUTPUTS, h.is_output) == [True] * 9 + [t.output_like("│ ─┌")] + [True] * 6
    assert one(spark, COMMANDS, h.is_output) == [False] * len(COMMANDS)
    known = frozenset(h.COMMANDS)
    for texts in (OUTPUTS, COMMANDS):
        assert one(spark, texts, h.is_output) == [t.output_like(x) for x in texts]
        assert one(spark, texts, h.is_command) == [t.command_like(x, known) for x in texts]
    assert one(spark, ["ls", "/usr/bin/git x", "foo", "./x", "A_1=2", "", None], h.is_command) == [True, True, False, True, True, False, False]


def test_confidence(spark):
    texts, known = COMMANDS + ["> x", "12: y", "Abc: z", "a          b", "x" * 160, "x", "12. " + "z" * 160], frozenset(h.COMMANDS)
    for version in (1, 2):
        for prompt in ("me@box:~$ ", "$ ", "", "x> "):
            got = one(spark, texts, lambda c: h.confidence(c, F.lit(prompt), version))
            assert got == [t.inferred_confidence(x, prompt, version, t.command_like(x, known)) for x in texts]
    assert one(spark, ["12. " + "z" * 160], lambda c: h.confidence(c)) == [0.15]
    assert one(spark, ["", "a"], h.typed_confidence) == [0.5, 1.0]


def test_screen_programs_and_heredocs(spark):
    assert one(spark, ["vim x", "/usr/bin/ssh h", "ls", ""], h.interactive_program) == ["vim", "ssh", None, None]
    assert one(spark, ["ssh h"], lambda c: h.interactive_program(c, 3)) == [None]
    assert one(spark, ["cat <<EOF\n", "cat << 'X'", "cat <<-EOF", "a << b c", "x <<<word\n"], h.heredoc_delimiter) == ["EOF", "X", None, None, "word"]
    assert one(spark, ["\x1b[?1049h", "\x1b[?47l", "\x1b[?47h\x1b[?47l"], h.leaves_screen) == [False, True, False]


def test_normalisation(spark):
    text = " \n a  \r\n\x1b[1mb\x1b[0m\t\n\n\n\nc \n \n"
    assert one(spark, [text], tx.normalize_v1) == ["a  \nb\t\n\n\n\nc"]
    assert one(spark, [text], tx.normalize) == ["a\nb\n\n\n\nc"]
    assert one(spark, ["a \n\n\n\nb\t\n"], tx.collapse_blank_lines) == ["a\n\nb"]
    assert one(spark, ["\n\n a \n\nb  \n\n"], tx.normalize_screen) == ["a\n\nb"]


def test_markup(spark):
    assert one(spark, ["<h2>T</h2>", "none", "<h2>open"], lambda c: tx.between(c, "<h2>")) == ["T", "", "ope"]
    assert one(spark, ["a<b<c>d>e", "<x>y</x>"], tx.remove_tags) == ["ae", "y"]
    assert one(spark, ['<a href="1"><a href="2">MARK<a href="3">'], lambda c: tx.nearest_before(c, "MARK")) == ["2"]
    assert one(spark, ["macOS • xterm • zsh", "Linux"], lambda c: F.to_json(tx.environment(c))) == ['{"system":"macOS","terminal":"xterm","shell":"zsh"}', '{"system":"Linux","terminal":"","shell":""}']
    assert one(spark, [r"\boxed{TRUE} oxed{false}", "oxed{false}", "x", None], tx.boxed) == [True, False, None, None]
    assert one(spark, ["a/b/12_multi.json", "x.json"], tx.file_id) == ["12", "x"]
    assert one(spark, ["~ % ls", "$ a $ b", "x"], tx.action_command) == ["ls", "b", "x"]
    assert one(spark, ["u@h:~$ ls -l  \nout\n# make\n$ "], lambda c: F.array_join(tx.txt_commands(c), "|")) == ["ls -l|make"]
    names = ["f10", "f9", "F1", "f9a"]
    assert sorted(names, key=dict(zip(names, one(spark, names, lambda c: F.array_join(tx.natural_key(c), "|")))).get) == ["F1", "f9", "f9a", "f10"]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("<>ab"), max_size=24))
def test_tags_at_any_depth(text):
    want = text
    while re.search("<[^<>]*>", want):
        want = re.sub("<[^<>]*>", "", want)
    assert tx._without_tags(text) == want


def test_deep_tags_and_long_numbers(spark):
    assert one(spark, ["<" * 9 + "x" + ">" * 9 + "y", None, "a<b", "<" * 6 + ">" * 3], tx.remove_tags) == ["y", None, "a<b", "<<<"]
    names = ["f" + "9" * 30, "f1" + "0" * 30, "f0" + "8" * 30, "f2"]
    assert sorted(names, key=dict(zip(names, one(spark, names, lambda c: F.array_join(tx.natural_key(c), "|")))).get) == ["f2", "f0" + "8" * 30, "f" + "9" * 30, "f1" + "0" * 30]
    texts = ['<a href="1"><a href="2">MARK', "MARK", "none", None]
    assert [tuple(r) if r else r for r in one(spark, texts, lambda c: tx.find_before(c, "MARK"))] == [("2", 24), ("", -2), ("", -1), ("", None)]
    assert one(spark, ["0", "86400.5", "x", None], tx.plain_time) == ["1970.01.01", "1970.01.02", None, None]


def test_known_commands(spark):
    texts = ["vim a.txt", "wget u", "yarn add", "yum install", "unzip x", "xargs -n1", "watch ls", "wc -l", "Rscript x", "vimx", "ls2"]
    assert one(spark, texts, h.is_command) == [True] * 9 + [False] * 2 and len(set(h.COMMANDS)) == len(h.COMMANDS) - 1


def test_chunk_ranges(spark):
    df = spark.createDataFrame([(10,), (20,), (25,), (3,)], "n long").select(F.to_json(tx.chunk_ranges(F.col("n"), 10)).alias("r"))
    got = [[tuple(map(int, p)) for p in re.findall(r'"start":(\d+),"end":(\d+)', r.r)] for r in df.collect()]
    assert got == [[(0, 10)], [(0, 10), (10, 20), (20, 20)], [(0, 10), (10, 20), (20, 25)], [(0, 3)]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from("abc d\n"), max_size=20), st.text(st.sampled_from("abc d\n"), max_size=20)), min_size=1, max_size=8))
def test_similarity(spark, pairs):
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string").orderBy("k")
    for r in df.select("a", "b", sim.sequence_ratio("a", "b").alias("s"), sim.quick_ratio("a", "b").alias("q"), sim.line_jaccard("a", "b").alias("j")).collect():
        m = difflib.SequenceMatcher(None, r.a, r.b)
        x, y = set(r.a.split("\n")), set(r.b.split("\n"))
        assert r.s == m.ratio() and abs(r.q - m.quick_ratio()) < 1e-12 and r.j == len(x & y) / len(x | y)


def test_match_kind(spark):
    df = spark.createDataFrame([("a", "a"), ("ab", "a"), ("", "x"), ("a\nb\nc", "b\na\nc"), ("x", "y")], "a string, b string")
    assert [r[0] for r in df.select(sim.match_kind("a", "b")).collect()] == ["exact", "prefix", "prefix", "similar", "mismatch"]


def test_replies():
    f = responses.tolerant_json
    assert f('x ```json\n{"a": 1}\n``` y') == '{"a": 1}'
    assert f("```\n[1, 2]\n```") == "[1, 2]"
    assert f('say {"a": {"b": 1}} now') == '{"a": {"b": 1}}'
    assert f("list [1, [2]] end") == "[1, [2]]"
    assert f('{"a": [1,], }') == '{"a": [1]}' or f('{"a": [1,], }') == "[1]"
    assert f("nothing") is None and f(None) is None
    assert responses.usable_pattern("(?<n>a)") == "(a)" and responses.usable_pattern("[") is None


def test_first_match(spark):
    df = spark.createDataFrame([("me@box$ ls", ["[", r"\w+@\w+\$ "]), ("none", ["x"]), (None, ["x"])], "line string, p array<string>")
    assert [(r[0].pattern, r[0].prompt) for r in df.select(responses.first_match("line", "p")).collect()] == [(1, "me@box$ "), (None, None), (None, None)]


def test_responders(spark):
    prompts = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, prompt string")
    known = spark.createDataFrame([("a", "yes")], "key string, response string")
    assert sorted(map(tuple, responses.respond(prompts, known).collect())) == [("a", "yes", None), ("b", None, "no recorded response")]

    def shout(batches):
        for pdf in batches:
            yield pdf.assign(response=pdf["prompt"] + "!", error=None)[["key", "response", "error"]]

    assert sorted(tuple(r) for r in responses.respond(prompts, shout).collect()) == [("a", "1!", None), ("b", "2!", None)]
    assert one(spark, ["a  b", ""], lambda c: responses.count_tokens(c)) == [2, 0]
    assert one(spark, ["abc", None], lambda c: responses.count_tokens(c, lambda: list)) == [3, None]
