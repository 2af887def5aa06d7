import random

import numpy as np
import pytest

from termloom.llm import common, near_dups as nd
from termloom.llm.graph import components

SCHEMA = "doc_id long, text string"


def brute(rows, k, percent):
    def words(t):
        return [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]

    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i]:
            least[find(i)] = min((x for x in (least.get(find(i)), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), c := least[find(i)] if sets[i] else d, d == c) for i, (d, _) in enumerate(rows)), key=str)


def corpus(seed=3, groups=12, copies=9):
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([12, 60, 150]))]
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 1009, " ".join(w)))
    return rows


@pytest.mark.parametrize("k,percent,block", [(3, 85, 512), (5, 80, 2)])
def test_against_brute_force(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = corpus() + [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "One two"), (2004, "one TWO"), (2005, "one"), (2006, "two one"), (None, "one two"), (2007, "é Ä b"), (2008, "é ä b")]
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as key", "2 as n_shingles", "'q' as component")
    got = nd.near_duplicates(docs, k, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, k, percent)


def test_a_bucket_no_head_joins(spark, monkeypatch):
    """A chain whose far ends aren't similar, in one bucket of many blocks."""
    monkeypatch.setattr(nd, "BLOCK", 3)
    monkeypatch.setattr(nd, "band_keys", lambda sketch, bands, rows: np.ones((len(sketch), bands), np.int64))
    rows = [(100 - i, " ".join(f"w{j}" for j in range(i, i + 40))) for i in range(25)] + [(500 + i, f"a{i} b c d") for i in range(9)]
    got = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 85)


@pytest.mark.parametrize("percent", [50, 70, 95, 100])
def test_other_limits(spark, percent):
    rows = corpus(seed=5, groups=8, copies=7)
    got = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA), 2, percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 2, percent)


def test_bands():
    assert nd.bands_rows(85) == (32, 6) and nd.bands_rows(80) == (38, 5)
    for percent in range(1, 100):
        bands, rows = nd.bands_rows(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 3e-7
    for percent in (0, 101):
        with pytest.raises(ValueError):
            nd.bands_rows(percent)


def test_long_sets_make_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(nd, "band_keys", lambda sketch, bands, rows: np.ones((len(sketch), bands), np.int64))
    rows = [(i, " ".join(f"w{j}" for j in range(i, i + 20 + 15 * (i % 7)))) for i in range(40)]
    got = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 3, 85)


def test_scratch_tables_go(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(nd, "materialise", lambda df, name: made.append(name) or common.materialise(df, name))
    made = []
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file://{tmp_path}")
    got = nd.near_duplicates(spark.createDataFrame(corpus(), SCHEMA), 3, 85)
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "termloom").iterdir()}
    assert got.count() and len(made) > 6 and not left & {"buckets", "shingle-sets", "links", "more-links"}


def test_empty(spark):
    assert nd.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketch_estimates():
    rng = np.random.default_rng(0)
    for size in (1, 3, 40, 700):
        a = np.unique(rng.integers(1, 1 << 60, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(0.8 * len(a))], rng.integers(1, 1 << 60, size - int(0.8 * size)).astype(np.uint64)]))
        s = nd.sketches([a, b, a], 192)
        assert (s != nd.FULL).all() and (s[0] == s[2]).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((s[0] == s[1]).mean() - true) < 0.2


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


def test_pipeline_keeps_one_row_of_each_group(spark):
    from corpus_pipeline import drop_near_duplicates

    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    # id 5 has two texts: one is a copy of id 1's, the other heads a group of its own
    rows = [(1, one), (5, one), (5, two), (9, two), (None, two), (None, three), (None, three), (None, three + " more"), (None, None), (None, None), (7, ""), (7, ""), (7, None), (8, " ")]
    kept = drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert sorted(((r.doc_id, r.text) for r in kept if r.text not in (three, three + " more")), key=str) == sorted([(1, one), (5, two), (None, None), (None, None), (7, ""), (7, None), (8, " ")], key=str)
    assert sum((r.text or "").startswith(three) for r in kept) == 1
