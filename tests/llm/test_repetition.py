import collections
import re

from hypothesis import given, settings, strategies as st

from termloom.llm import repetition as r


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(w)
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    rep = {i + k for i in range(n - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    total = sum(map(len, w))
    dup = {}
    for k in r.LIMITS:
        grams = [tuple(w[i : i + k]) for i in range(n - k + 1)]
        times = collections.Counter(grams)
        inside = {i + j for i, g in enumerate(grams) if times[g] > 1 for j in range(k)}
        dup[k] = sum(len(w[i]) for i in inside) / total if total else 0.0
    return (n, total, sum(c in "#*$%&|<>" for x in w for c in x), len(lines) - len(set(lines)), len(rep)), dup


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é#", "c|", "\n", "\t", " ", " ", "dd"]), max_size=80))
def test_against_brute_force(parts):
    text = " ".join(parts)
    got, (counts, dup) = r.measure(text), brute(text)
    assert tuple(got[c] for c in r.COUNTS) == counts
    assert all(abs(got[f"dup_{k}"] - v) < 1e-12 for k, v in dup.items())


def test_colliding_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr(r, "roll", lambda ids, n, hashes: (ids[: len(ids) - n + 1] * r.np.uint64(0)))
    text = "a b c d e f g a b c x y a b c d e f g b c"
    got, (counts, dup) = r.measure(text), brute(text)
    assert tuple(got[c] for c in r.COUNTS) == counts and all(abs(got[f"dup_{k}"] - v) < 1e-12 for k, v in dup.items())


def test_rules(spark):
    clean = " ".join(f"w{i}" for i in range(300))
    junk = "the same line over and over again\n" * 60
    half = clean + " " + " ".join(f"w{i}" for i in range(200))
    rows = [(1, clean), (2, junk), (3, None), (4, ""), (5, "short text"), (6, half), (6, half), (None, clean), (7, "x " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_words", "true as kept")
    got = collections.defaultdict(list)
    for x in r.rules(docs).collect():
        got[x.doc_id].append(x)
    assert [got[i][0].base_failed for i in (1, 2, 3, 4, 5, 6, 7)] == [False, True, True, True, True, True, True]
    assert got[1][0].kept and got[None][0].kept and len(got[6]) == 2 and got[7][0].n_repeat_words == 200_000
    assert r.rules(docs.limit(0)).count() == 0
    third = clean + " " + " ".join(f"w{i}" for i in range(140))
    fifth = clean + " " + " ".join(f"w{i}" for i in range(80))  # 80 words twice, of 380: passes the base rule only
    tenth = clean + " " + " ".join(f"w{i}" for i in range(30))
    rows = [(1, third), (2, fifth), (3, tenth)]
    assert [(x.base_failed, x.kept) for x in r.rules(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()] == [(True, False), (False, False), (False, True)]
