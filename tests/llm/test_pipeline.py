"""The pipeline on a small table with odd rows: each stage against what its operator says of single texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as c
from termloom.llm import quality_model as q, toxicity as t

from .test_models import words
from .test_near_dups import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
KEY = "q7Zt0Xk3mWvB9LrJ2hYdE5uN"


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    rng, rows, labels = random.Random(21), [], []
    for i in range(400):
        w, toxic, good = words(rng, rng.randrange(30, 90)), i % 5 == 0, i % 7 != 0
        if toxic:
            w[rng.randrange(10) : 0] = ["zorgul"] * 3
        if not good:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), "en", "s", 1))
        labels.append((i, int(good), int(toxic)))
    rows += [(1000 + i, rows[i][1] + " more", "en", "s", None) for i in range(1, 400, 9)]  # near copies
    rows += [(2, rows[3][1], "en", "s", 1), (2, rows[2][1], "en", "s", 1), (None, rows[4][1], None, None, None), (None, None, None, None, None), (3000, "", "en", "s", 0), (3001, None, "en", "s", 0)]
    rows += [(4000, " ".join(words(random.Random(5), 60)) + f" token={KEY}", "en", "s", 1)]
    at = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_and_run(spark, place):
    assert [name for name, _ in c.STAGES] == ["toxicity", "quality", "near_duplicates", "secrets", "packing"]
    docs, labels = (spark.read.parquet(f"{place}/{x}.parquet") for x in ("documents", "labels"))
    weights, curve = t.fit(docs, labels)
    matcher = t.Matcher(weights)

    def mild(text):
        total, n, _ = matcher.measure(text)
        return 1 / (1 + np.exp(-float((t.features(np.array([total]), np.array([n], float)) @ curve)[0]))) < 0.7

    first = c.drop_toxic(spark, docs, place)
    assert rows_of(first) == sorted((tuple(r) for r in docs.collect() if mild(r.text)), key=str) and first.count() < docs.count() - 50
    first = c.materialise(first, "test-first")
    model = q.fit(first, labels)
    second = c.keep_quality(spark, first, place)
    want = [tuple(r) for r in first.collect() if q.logits([r.text], *model)[0] >= np.log(0.7 / 0.3)]
    assert rows_of(second) == sorted(want, key=str) and 50 < len(want) < first.count()
    second = c.materialise(second, "test-second")
    third = c.materialise(c.drop_near_duplicates(spark, second, place), "test-third")
    rows, kept = [tuple(r) for r in second.collect()], [tuple(r) for r in third.collect()]
    groups = {}
    for (k, _, component, _), row in zip(sorted(brute([(k, r[1]) for k, r in enumerate(rows)], 5, 80)), rows):
        groups.setdefault(component if (row[1] or "").split() else ("blank", row[0], row[1]), []).append(row)
    for component, members in groups.items():
        assert sum(r in members for r in set(kept)) == 1, component
    assert len(kept) >= len(groups)
    fourth = c.materialise(c.redact_secrets(spark, third, place), "test-fourth")
    assert fourth.columns == docs.columns and fourth.count() == third.count()
    assert not fourth.where(F.col("text").contains(KEY)).count() and not fourth.where("n_chars <> coalesce(length(text), 0)").count()
    packed = c.pack(spark, fourth, place)
    assert packed.where("start = 0").count() == fourth.count() and packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 1024
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert rows_of(c.run(spark, place).select(*columns)) == rows_of(packed.select(*columns))


def test_without_rows(spark, place, tmp_path):
    for x in ("documents", "labels"):
        spark.read.parquet(f"{place}/{x}.parquet").limit(0).write.parquet(f"{tmp_path}/{x}.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0
