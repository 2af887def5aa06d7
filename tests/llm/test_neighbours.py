import numpy as np

from termloom.llm import neighbours as nn
from termloom.llm.common import table

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for n, (q, v) in enumerate(good):
        if q is not None and q % every == 0:
            d = [(float(np.sqrt(((w - v) ** 2).sum())), i) for m, (i, w) in enumerate(good) if m != n and len(w) == len(v)]
            out[q] = sorted(d, key=lambda x: (x[0], x[1] is None, x[1]))[:k]
    return out


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(nn, "BLOCK", 7)
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(4)]) for i in range(40)]
    rows += [(50, None), (60, []), (70, [0.0] * 4), (80, [1.0, None, 0.0, 0.0]), (90, [float("nan")] * 4), (100, [float("inf"), 0.0, 0.0, 0.0]), (110, [1.0, 2.0]), (111, [1.0, 2.5]), (None, [1.0, 2.25])]
    rows += [(200 + i, rows[10][1]) for i in range(1, 9)]
    got = {}
    for r in nn.search(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as uid", "2 as rank"), 10, 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    want = brute(rows, 10, 5)
    assert set(got) == set(want)
    hits = total = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(want[q]) + 1))
        hits += len({f[2] for f in found} & {w[1] for w in want[q]})
        total += len(want[q])
    assert hits >= 0.95 * total
    assert [v for _, _, v in got[110]] == [None, 111] and [v for _, _, v in got[10]] == [201, 202, 203, 204, 205]
    assert nn.search(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in table(spark, sf, "embeddings").collect()]
    want = brute(rows, 100, 10)
    got = {}
    for r in nn.query(spark, sf).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    assert set(got) == set(want) and all(len(g) == 10 for g in got.values())
    hits = 0
    for q, w in want.items():
        hits += len(set(got[q]) & {i for _, i in w})
        assert all(abs(got[q][i] - d) < 1e-12 for d, i in w if i in got[q])
    assert hits >= 0.9 * sum(map(len, want.values()))


def found(spark, rows, every=10, k=5):
    got = {}
    for r in nn.search(spark.createDataFrame(rows, SCHEMA), every, k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    return {q: [(s, v) for _, s, v in sorted(x, key=lambda y: y[0])] for q, x in got.items()}


def recall(got, want):
    return sum(len({v for _, v in got[q]} & {v for _, v in w}) for q, w in want.items()) / max(sum(map(len, want.values())), 1)


def test_recall_at_several_sizes_and_shapes(spark, monkeypatch):
    """Many blocks, several rounds of queries; clusters, and vectors without any structure."""
    monkeypatch.setattr(nn, "QUERY_BYTES", 4000)
    rng = np.random.default_rng(3)
    for n, clusters, block in ((300, 10, 64), (2500, 40, 500), (2500, 0, 500)):
        monkeypatch.setattr(nn, "BLOCK", block)
        centres = rng.standard_normal((max(clusters, 1), 24))
        v = rng.standard_normal((n, 24)) if not clusters else centres[rng.integers(0, clusters, n)] + rng.standard_normal((n, 24)) * 0.1
        rows = [(i, [float(np.float32(x)) for x in w]) for i, w in enumerate(v)]
        got, want = found(spark, rows, 50, 10), brute(rows, 50, 10)
        assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want) and recall(got, want) >= 0.9


def test_bounds_spare_far_blocks_exactly():
    rng = np.random.default_rng(4)
    block = nn.Block(rng.standard_normal((200, 8)) + 100)
    q = rng.standard_normal((3, 8))
    assert all(len(s) == 0 for s, _ in block.search(q, [-1] * 3, 5, np.full(3, 10.0)))
    assert all(len(s) == 200 for s, _ in block.search(q * 1e200, [-1] * 3, 200, np.full(3, np.inf)))


def test_very_large_and_very_small_numbers(spark):
    rows = [(i, [float(np.float32(10.0 ** (i - 20))), float(i % 3 - 1), 1.0]) for i in range(50)]
    got, want = found(spark, rows, 10, 50), brute(rows, 10, 50)
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items()}
    doubles = spark.createDataFrame([(0, [1e300, 1.0]), (1, [-1e300, 1.0]), (2, [1e300, 2.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in nn.search(doubles, 10, 5).orderBy("rank").collect()] == [(2, 1.0), (1, float("inf"))]
