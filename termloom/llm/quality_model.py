"""Quality classifier: supervised subword embeddings.

A document is the average of the vectors of its words, byte n-grams and whether its word pairs repeat,
hashed into buckets; a softmax layer turns the average into class probabilities. Vectors and layer are learned together by stochastic gradient
descent in numpy, on a bounded number of labelled ids, in the order of a hash. Executors count the sample's buckets, which is
all that the driver sees, so that no text is too long for the sample. Once learned, a bucket's vector only ever meets
the layer's weights, so scoring folds the two into one number a bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import discard, in_split, materialise, parts, table
from .toxicity import sample

BUCKETS_LOG2, DIM = 16, 8
GRAMS = (3, 4, 5)
#: Kinds of features: each counts alike in a document's average, however many features it has.
GROUPS = len(GRAMS) + 2
#: Labelled ids that a model is fitted on, at most: the first in the order of a hash. A row takes 4 bytes of the driver's memory for each
#: of its buckets, and never more than 2 for each bucket there is (128 KB), however long its text.
SAMPLE_ROWS = 3_000
EPOCHS, RATE, BATCH = 8, 2.0, 32
#: Steps at least: a small sample is gone through more often.
STEPS = 750

M32 = np.uint32(2654435761)
PRIME = np.uint32(16777619)


def buckets(data: np.ndarray, starts: np.ndarray):
    """data: the texts' bytes, each followed by a newline; starts: of each text. Yields (buckets, which are
    real, first position of each text) for the n-grams of each length, then (buckets, None, firsts) for words
    and for pairs of words."""
    n, x = len(data), data.astype(np.uint32)
    ends = np.append(starts[1:], n)
    owner_end = np.repeat(ends, ends - starts)
    shift = np.uint32(32 - BUCKETS_LOG2)
    h = x.copy()
    for k in range(1, max(GRAMS)):
        m = max(n - k, 0)
        h[:m] *= PRIME
        h[:m] += x[n - m :]
        if k + 1 in GRAMS:
            size = k + 1
            got = ((h ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) * M32) >> shift
            yield got, np.arange(n) + size <= owner_end, starts
    space = data <= 32
    edge = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    stop = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    if len(edge) > len(stop):
        stop = np.append(stop, n)
    # hash of a word: the sum of byte * power[position in the word], by prefix sums of byte * power[position] and its inverse
    base, inverse = 1099511628211, pow(1099511628211, -1, 1 << 64)
    power, back = np.full(n + 1, base, np.uint64), np.full(n + 1, inverse, np.uint64)
    power[0] = back[0] = 1
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(back, out=back)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(data * power[:n], out=total[1:])
    words = (total[stop] - total[edge]) * back[edge]
    words ^= words >> np.uint64(29)
    words *= np.uint64(0xBF58476D1CE4E5B9)
    firsts = np.searchsorted(edge, starts)
    yield (words >> np.uint64(64 - BUCKETS_LOG2)).astype(np.uint32), None, firsts
    # pairs of words, by whether the text has had the pair before: bucket 1 or 0, whatever the words
    if len(words) > 1:
        owner = np.searchsorted(starts, edge, side="right").astype(np.uint64)
        within = owner[1:] == owner[:-1]
        pair = ((words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) ^ (owner[1:] * np.uint64(0xD6E8FEB86659FD93)))[within]
        order = np.argsort(pair, kind="stable")
        again = np.zeros(len(pair), np.uint32)
        again[order[1:][pair[order[1:]] == pair[order[:-1]]]] = 1
        yield again, None, np.searchsorted(owner[1:][within], np.arange(1, len(starts) + 1, dtype=np.uint64))


def joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw = [(t or "").encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes


def sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Of each text's values: a text's sum depends on nothing but its own."""
    if not len(values):
        return np.zeros(len(firsts))
    out = np.add.reduceat(values.astype(np.float64), np.minimum(firsts, len(values) - 1))
    out[np.diff(np.append(firsts, len(values))) == 0] = 0
    return out


def logits(texts: list[str | None], weights: np.ndarray, bias: float) -> np.ndarray:
    """Of label 1 against 0. A text without features has the bias alone."""
    data, starts = joined(texts)
    top = np.zeros(len(starts))
    for got, real, firsts in buckets(data, starts):
        v = weights[got]
        if real is not None:
            top += sums(np.where(real, v, 0), firsts) / np.maximum(sums(real, firsts), 1)
        else:
            top += sums(v, firsts) / np.maximum(np.diff(np.append(firsts, len(got))), 1)
    return top / GROUPS + bias


def rows_of(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's buckets in order, and their shares of its average."""
    out = []
    for text in texts:
        data, starts = joined([text])
        total = np.zeros(1 << BUCKETS_LOG2)
        for got, real, _ in buckets(data, starts):
            n = np.bincount(got[real] if real is not None else got, minlength=len(total))
            total += n / max(n.sum(), 1) / GROUPS
        ids = np.flatnonzero(total)
        out.append((ids.astype(np.int32), total[ids].astype(np.float32)))
    return out


class Kept:
    """rows_of() of many texts: shares as half-precision parts of the greatest, by bucket or, where most buckets have one, of all buckets."""

    def __init__(self):
        self.rows: list[tuple[bytes, bytes, float]] = []

    def __len__(self):
        return len(self.rows)

    @staticmethod
    def packed(ids: np.ndarray, share: np.ndarray) -> tuple[bytes, bytes, float]:
        most = float(share.max()) if len(share) else 1.0
        half = (share / most).astype(np.float16)
        if 2 * len(ids) < 1 << BUCKETS_LOG2:
            return ids.astype(np.uint16).tobytes(), half.tobytes(), most
        whole = np.zeros(1 << BUCKETS_LOG2, np.float16)
        whole[ids] = half
        return b"", whole.tobytes(), most

    def add(self, ids: bytes, share: bytes, most: float) -> None:
        self.rows.append((ids, share, most))

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        ids, share, most = self.rows[k]
        share = np.frombuffer(share, np.float16).astype(np.float32) * np.float32(most)
        return (np.frombuffer(ids, np.uint16).astype(np.int32) if ids else np.arange(len(share), dtype=np.int32)), share


def train(rows, labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent on the softmax's cross-entropy. rows: of rows_of(), by number. Returns what logits() needs: for each bucket
    its vector times the difference of the layer's two rows, and the difference of the two constants."""
    rng, size = np.random.default_rng(seed), 1 << BUCKETS_LOG2
    if len(rows) == 0:
        return np.zeros(size, np.float32), 0.0
    if labels.min() == labels.max():
        raise ValueError(f"the quality model's sample of {len(rows)} rows has no label but {labels.min()}")
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (size, DIM)).astype(np.float32)
    layer, constant = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    layer[0], layer[1] = -0.5, 0.5
    each, done = -(-len(rows) // BATCH), 0
    epochs = max(EPOCHS, -(-STEPS // each))
    steps = epochs * each
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            some = [rows[k] for k in batch]
            ids = np.concatenate([x[0] for x in some])
            share = np.concatenate([x[1] for x in some])
            owner = np.repeat(np.arange(len(batch)), [len(x[0]) for x in some])
            weighted = vectors[ids] * share[:, None]
            hidden = np.zeros((len(batch), DIM), np.float32)
            for d in range(DIM):
                hidden[:, d] = np.bincount(owner, weights=weighted[:, d], minlength=len(batch))
            z = hidden @ layer.T + constant
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            back = p @ layer
            layer -= rate / len(batch) * (p.T @ hidden)
            constant -= rate / len(batch) / 10 * p.sum(axis=0)
            step = rate * share[:, None] * back[owner]
            for d in range(DIM):
                vectors[:, d] -= np.bincount(ids, weights=step[:, d], minlength=size)
    return vectors @ (layer[1] - layer[0]), float(constant[1] - constant[0])


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Learned from labelled rows outside the held-out split, by numbers that don't depend on how tables are stored. Without labels or documents every score is 0.5;
    labels that none of the documents has, or of one class alone, are an error."""

    def featured(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids, share, most = Kept.packed(*rows_of([batch.column(2)[k].as_py()])[0])
                columns = [batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([ids], pa.binary()), pa.array([share], pa.binary()), pa.array([most])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", "ids", "share", "most"])

    kept, ys = Kept(), []
    found = sample(docs, labels, "quality", modulus, held, rows).select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text")
    found = materialise(found.mapInArrow(featured, "doc_id long, y int, ids binary, share binary, most double"), "quality-sample")
    for r in found.orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():  # the order decides the model, so it must not be the files'
        kept.add(r["ids"], r["share"], r["most"]), ys.append(r["y"])
    discard(found)
    if not ys and not docs.isEmpty() and not labels.isEmpty():
        raise ValueError("the quality model's sample is empty: no document outside the held-out split has a label")
    return train(kept, np.array(ys, int))


def where(docs: DataFrame, model: tuple[np.ndarray, float], keep) -> DataFrame:
    """The rows of docs, with all their columns, whose score passes keep (from an array of scores to booleans)."""
    shared, at_text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            for part in parts(batch, at_text, 300):
                z = logits(part.column(at_text).to_pylist(), weights, bias)
                yield part.filter(pa.array(keep(1 / (1 + np.exp(-np.clip(z, -30, 30))))))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, threshold: float = 0.7) -> DataFrame:
    """Fit on the labels, then per row of docs: doc_id, held_out, score, predicted. Null counts as an empty text,
    whose score comes from the constants alone. Rows that repeat are scored as often as they occur, and equal texts alike; a null
    id stays; other columns are not looked at, whatever their names; an empty table gives an empty one. A very long text is
    scored whole, in one task: it needs some 50 bytes of memory a byte."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(fit(docs, labels, modulus, held))  # 2 ** BUCKETS_LOG2 numbers

    def run(batches):
        weights, bias = shared.value
        for batch in batches:
            for part in parts(batch, 1, 300):
                z = logits(part.column(1).to_pylist(), weights, bias)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", in_split(F.col("doc_id"), modulus, held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
