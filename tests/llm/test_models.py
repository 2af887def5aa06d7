import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from termloom.llm import quality_model as q, toxicity as t

DOCS = "doc_id long, text string, score double, label string"


def held(i, modulus, k):
    return zlib.crc32(str(i).encode()) % modulus == k


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def words(rng, n):
    return [rng.choice(["tha", "rin", "blo", "ste", "que", "ond"]) + rng.choice(["er", "ing", "ly", "ou", "ent", "ation"]) for _ in range(n)]


@pytest.fixture(scope="module")
def toxic(spark):
    rng, rows, labels = random.Random(4), [], []
    for i in range(900):
        w, y = words(rng, rng.randrange(5, 120)), int(rng.random() < 0.25)
        for _ in range(rng.randrange(2, 6) * y):
            w.insert(rng.randrange(len(w)), rng.choice(["zorg" + rng.choice(["ul", "ax", "ender", "ik"]), "Vl1tch", "vlіtch"]))  # a stem with endings; a digit; a Cyrillic letter
        rows.append((i, " ".join(w), 1.0, "x"))
        labels.append((i, 1, y))
    rows += [(1000, None, None, None), (1001, "", 0.0, ""), (None, "x", 0.0, "")]
    labels += [(1000, None, None), (None, 1, 1), (5, 1, labels[5][2])]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {i: y for i, _, y in labels if i is not None}


def test_toxicity(toxic):
    docs, labels, y = toxic
    got = t.score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == held(r.doc_id, 3, 1) for r in got if r.doc_id is not None)
    pairs = [(r.score, y[r.doc_id]) for r in got if r.held_out and y.get(r.doc_id) is not None]
    assert auc(pairs) > 0.98 and sum((s >= 0.7) == bool(v) for s, v in pairs) > 0.95 * len(pairs)
    by = {r.doc_id: r.score for r in got}
    assert by[1000] == by[1001] < 0.1


def test_folding_and_exceptions():
    assert t.fold("Ｖlіtch, ID1OT!") == " vlitch  idiot  "
    assert t.fold("m0r0n $cum") == " moron scum "
    m = t.Matcher({" trash ": 2.0, " zorg": 3.0, " zorgul ": 4.0})
    assert m.measure("Trash can, trash; zorgul zorgs azorg") == (9.0, 6, 3)
    assert m.measure("trash") == (2.0, 1, 1) and m.measure(None) == (0.0, 0, 0) and m.measure("!?") == (0.0, 0, 0)
    assert t.Matcher({}, ()).measure("a b") == (0.0, 2, 0)
    assert m.measure("zorg " * 50_000)[2] == 50_000


def test_what_is_not_seen_does_not_hide_a_word():
    for text in ("id\u200biot", "id\u00adiot", "ïdíöt", "i\u0301diot", "ID\u2060IOT", "ｉｄiot"):
        assert t.fold(text) == " idiot ", text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["zorg", "zorgul", "Zorgulax", "za", "bad", "b4d", "badge", "good", "day", "bad day", "a!b", "é", "."]), max_size=20))
def test_matcher_against_brute_force(words):
    weights = {" zorg": 3.0, " zorgul": 4.0, " bad ": 2.0, " good ": 1.0, " bad day ": 0.0}
    text = " ".join(words)
    folded = t.fold(text).split()
    total = hits = 0
    for k, w in enumerate(folded):
        spared = w == "bad" and folded[k + 1 : k + 2] == ["day"] or w == "trash" and folded[k + 1 : k + 2] == ["can"]
        heaviest = max([v for e, v in weights.items() if v and (e == f" {w} " if e.endswith(" ") else w.startswith(e.strip()))], default=0)
        if heaviest and not spared:
            total, hits = total + heaviest, hits + 1
    assert t.Matcher(weights).measure(text) == (total, len(folded), hits)


def test_exceptions_are_learned_and_fits_repeat(spark):
    rng, rows, labels = random.Random(12), [], []
    for i in range(600):
        w, y = words(rng, 30), i % 3 == 0
        at = rng.randrange(len(w))
        w[at:at] = ["zorgul"] if y else ["zorgul", "garden"] if i % 27 == 1 else []
        rows.append((i, " ".join(w), None, "x"))
        labels.append((i, 1, int(y)))
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights, curve = t.fit(docs, marks)
    assert weights[" zorgul garden "] == 0 and t.Matcher(weights).measure("zorgul garden")[0] == 0 < t.Matcher(weights).measure("zorgul gardens")[0]
    again, curve2 = t.fit(docs.repartition(7, "text"), marks.repartition(3))
    assert again == weights and (curve == curve2).all()


def test_without_labels(spark, toxic):
    docs, labels, _ = toxic
    assert t.score(docs, labels.limit(0)).count() == docs.count()
    assert t.score(docs.limit(0), labels).count() == 0 == q.score(docs.limit(0), labels).count()
    assert q.score(docs, labels.limit(0)).count() == docs.count()


def test_quality(spark):
    rng, rows, labels = random.Random(6), [], []
    for i in range(700):
        w, y = words(rng, rng.randrange(8, 90)), int(rng.random() < 0.7)
        if not y:
            kind = rng.randrange(3)
            w = [x.upper() + "!!" for x in w] if kind == 0 else [w[0]] * len(w) if kind == 1 else [x + "%%%" for x in w]
        rows.append((i, " ".join(w), None, "x"))
        labels.append((i, y, 0))
    rows += [(1000, None, None, None), (1001, "", 0.0, ""), (None, "x", 0.0, ""), (1002, "word " * 100_000, 0.0, "")]
    y = {i: v for i, v, _ in labels}
    got = q.score(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    pairs = [(r.score, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]
    assert all(r.held_out == held(r.doc_id, 4, 2) for r in got if r.doc_id is not None)
    assert auc(pairs) > 0.97
    by = {r.doc_id: r.score for r in got}
    assert by[1000] == by[1001]


def test_scores_of_a_batch_are_those_of_its_texts():
    w = np.random.default_rng(0).standard_normal(1 << q.BUCKETS_LOG2).astype(np.float32)
    texts = ["", None, "a", "The  cat.\nThe cat. The cat.", " é ", "x" * 500, "one two"]
    together = q.logits(texts, w, 0.1)
    assert np.allclose(together, [q.logits([x], w, 0.1)[0] for x in texts], atol=1e-6)
    for x, z in zip(texts, together):
        ids, share = q.rows_of([x])[0]
        assert abs(float((w[ids] * share).sum()) + 0.1 - z) < 1e-3


def test_buckets_against_brute_force():
    texts = ["the cat the cat sat", "", "é x", "aaaa bb aaaa bb"]
    size, mask = q.BUCKETS_LOG2, (1 << 64) - 1
    for text, (ids, share) in zip(texts, q.rows_of(texts)):
        raw, want = text.encode() + b"\n", {}
        kinds = []
        for n in q.GRAMS:
            kind = []
            for at in range(len(raw) - n + 1):
                h = 0
                for k in range(n):
                    h = (h * 16777619 + raw[at + k]) & 0xFFFFFFFF if k else raw[at]
                kind.append((((h ^ (n * 0x9E3779B1 & 0xFFFFFFFF)) * 2654435761) & 0xFFFFFFFF) >> (32 - size))
            kinds.append(kind)
        hashes = []
        for w in raw.split():
            h = sum(c * pow(1099511628211, k, 1 << 64) for k, c in enumerate(w)) & mask
            h ^= h >> 29
            hashes.append(h * 0xBF58476D1CE4E5B9 & mask)
        kinds.append([h >> (64 - size) for h in hashes])
        pairs = list(zip(hashes, hashes[1:]))
        kinds.append([int(p in pairs[:k]) for k, p in enumerate(pairs)])
        for kind in kinds:
            for b in kind:
                want[b] = want.get(b, 0) + 1 / len(kind) / q.GROUPS
        assert dict(zip(ids.tolist(), share.tolist())) == pytest.approx(want, abs=1e-6)


def test_equal_texts_score_alike_and_fits_repeat(spark, toxic):
    w = np.random.default_rng(1).standard_normal(1 << q.BUCKETS_LOG2).astype(np.float32)
    text = "The cat sat. " * 50
    z = q.logits(["x " * 999, text, "", text, "é" * 77, text], w, 0.1)
    assert z[1] == z[3] == z[5] == q.logits([text], w, 0.1)[0]
    ids, share = q.rows_of([text])[0]
    kept = q.Kept()
    kept.add(*q.Kept.packed(ids, share)), kept.add(*q.Kept.packed(np.arange(1 << q.BUCKETS_LOG2), np.full(1 << q.BUCKETS_LOG2, 0.5)))
    assert (kept[0][0] == ids).all() and np.allclose(kept[0][1], share, rtol=1e-3, atol=1e-7) and (kept[1][1] == 0.5).all() and len(kept[1][0]) == 1 << q.BUCKETS_LOG2
    rng = random.Random(3)
    rows = [(i, " ".join(words(rng, 20)) + (" !!" * 20 if i % 2 else ""), None, "x") for i in range(120)]
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    one, two = q.fit(docs, marks), q.fit(docs.repartition(5, "text"), marks.repartition(3))
    assert (one[0] == two[0]).all() and one[1] == two[1]


def test_where_keeps_columns(spark, toxic):
    docs, labels, _ = toxic
    weights, curve = t.fit(docs, labels)
    kept = t.where(docs, weights, curve, lambda s: s < 0.7)
    assert kept.columns == docs.columns and 600 < kept.count() < 750
    model = (np.zeros(1 << q.BUCKETS_LOG2, np.float32), 1.0)
    assert q.where(docs, model, lambda s: s >= 0.7).count() == docs.count()


def test_quality_sample_is_not_cut_by_length(spark):
    rng, labelled = random.Random(8), "doc_id long, quality int, toxic int"
    rows = [(i, " ".join(words(rng, 60)) if i % 2 else "%%% !!! " * 60, None, "x") for i in range(80)]
    first = next(i for i in range(80, 200) if not held(i, 4, 2))
    huge = spark.range(1).select(F.lit(first).cast("long").alias("doc_id"), F.expr("repeat('word ', 6500000)").alias("text"), F.lit(None).cast("double").alias("score"), F.lit("x").alias("label"))
    docs = huge.union(spark.createDataFrame(rows, DOCS))  # over 32 million characters lie in front
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(first, 0, 0)], labelled)
    weights, bias = q.fit(docs, labels)
    z = q.logits([rows[1][1], rows[2][1]], weights, bias)
    assert weights.any() and z[0] > 1 and z[1] < -1


def test_quality_sample_must_have_both_classes(spark, toxic):
    docs, _, _ = toxic
    for labels in ([(i, 1, 0) for i in range(50)], [(5000, 1, 0), (5001, 0, 0)]):
        with pytest.raises(ValueError, match="sample"):
            q.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_pipeline_does_not_drop_all_for_want_of_labels(spark, toxic, tmp_path):
    import corpus_pipeline

    docs, labels, _ = toxic
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    with pytest.raises(ValueError, match="no labels"):
        corpus_pipeline.keep_quality(spark, docs, str(tmp_path))


def test_common_words_do_not_crowd_out_telling_ones(spark):
    rng, rows, labels = random.Random(9), [], []
    common = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(60)]  # in more of the toxic texts, but telling little
    for i in range(600):
        y = i % 2
        w = [c for c in common if rng.random() < (0.7 if y else 0.4)] + ["zorgul"] * (i % 14 == 1)
        rng.shuffle(w)
        rows.append((i, " ".join(w), None, "x"))
        labels.append((i, 1, y))
    weights, _ = t.fit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert any(term.startswith(" zorg") for term in weights)
