import hashlib
import json

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from termloom.llm import chat

texts = st.lists(st.sampled_from(["<|turn|>", "<|end|>", "</s>", "[INST]", chat.MARK, "<", "a", "\n", "é", "|", "[", "/INST]", "s>", "<|body|>", "<<SYS>>"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|body|>"]) | texts, texts), max_size=5))
def test_round_trip(turns):
    out, spans = chat.render(turns)
    assert chat.parse(out) == turns
    assert [chat.unescape(out[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    for c in ("</s>", "[INST]", "<<SYS>>"):
        assert c not in out


def test_layouts():
    want = [("user", "q"), ("assistant", "a")]
    for record in (
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"turns": [{"role": "human", "text": "q"}, {"role": "bot", "text": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"instruction": "q", "output": "a"},
        {"instruction": "q", "input": "", "output": "a"},
        {"prompt": "q", "completion": "a"},
        {"question": "q", "response": "a", "system_prompt": None},
    ):
        assert chat.canonical(record) == want, record
    assert chat.canonical({"messages": [{"role": "gpt", "content": "a"}]}) == [("gpt", "a")]
    assert chat.canonical({"instruction": "q", "input": "c", "output": None}) == [("user", "q\n\nc"), ("assistant", "")]
    assert chat.canonical({"messages": [], "extra": 1}) is None and chat.canonical([]) is None and chat.canonical({"messages": []}) == []


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "system", None), (3, None, None, "x"), (None, 0, "user", "n"), (4, 0, "user", "t"), (4, 0, "user", "t"), (5, 0, "assistant", "[INST]" * 3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as id", "'x' as record")
    got = {r.conv_id: r for r in chat.digests(chat.format_records(chat.conversations(df))).collect()}
    assert len(got) == 6
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars, got[1].loss_sha256) == (2, sha("user\na\nassistant\nb\n"), 1, sha("b"))
    assert (got[2].turns_sha256, got[2].loss_sha256) == (sha("system\n\n"), sha(""))
    assert got[3].turns_sha256 == sha("\nx\n") and got[None].turns_sha256 == sha("user\nn\n") and got[4].n_turns == 2
    assert (got[5].loss_chars, got[5].loss_sha256) == (18000, sha("[INST]" * 3000))
    assert chat.digests(chat.format_records(chat.conversations(df.limit(0)))).count() == 0


@pytest.mark.parametrize("turns,chars", [(1, 10**6), (3, 10**6), (256, 5)])
def test_long_conversations_in_parts(spark, monkeypatch, turns, chars):
    monkeypatch.setattr(chat, "PART_TURNS", turns)
    monkeypatch.setattr(chat, "PART_CHARS", chars)
    rows = [(c, t, ("user", "assistant", "gpt")[t % 3], f"[INST] {c} {t}") for c in range(5) for t in range(4 * c + 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_records(chat.conversations(df))
    if turns == 1:
        assert formatted.count() == len(rows)
    for found in (chat.digests(formatted, in_order=True), chat.digests(formatted.orderBy(F.rand(1)))):
        got = {r.conv_id: r for r in found.collect()}
        for c in range(5):
            mine = [r for r in rows if r[0] == c]
            learned = "".join(x for _, _, role, x in mine if role == "assistant")
            want = (len(mine), sha("".join(f"{role}\n{x}\n" for _, _, role, x in mine)), len(learned), sha(learned))
            assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == want


def test_query_equals_its_sql_whatever_the_roles(spark, tmp_path):
    rows = [(1, 0, "human", "a"), (1, 1, "gpt", "b"), (2, 0, "assistant", None), (2, 1, "bot", "<|turn|>" + chat.MARK), (3, 0, "model", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"create view conversations as from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(f"select conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from ({chat.oracle_sql()})").fetchall()
    assert sorted(map(tuple, chat.query(spark, str(tmp_path)).collect())) == sorted(want)


def test_unknown_layouts_are_reported(spark):
    rows = [(1, json.dumps({"prompt": "q", "completion": "</s>"})), (2, "{bad"), (3, "[" * 100_000 + "]" * 100_000), (None, json.dumps({"x": 1})), (1, json.dumps({"prompt": "q", "completion": "</s>"}))]
    got = chat.format_records(spark.createDataFrame(rows, "id long, record string")).collect()
    assert sorted(str(r.layout) for r in got) == ["None", "None", "None", "prompt", "prompt"]
