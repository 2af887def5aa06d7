"""Near-duplicates by fast similarity sketching.

A document's set of word shingles is sketched in rounds: in each round every shingle is hashed to one of t
bins with a value that begins with the round's number, and a bin keeps the least value. A sketch is done when
every bin is filled (from round t on, one bin takes all shingles, so at most 2 t rounds are needed); its bins
agree with another set's with the two sets' similarity as probability, with the concentration of t independent
draws at the cost of a few passes over the set. Groups of bins (bands) are the candidate buckets.

Documents of equal sets form a class; the rest works on classes. In a bucket every member is held against the
bucket's head, on the full sets. What remains in pieces after that is finished exactly: such a bucket is dealt in
blocks of bounded bytes whose sets have like sizes, and each pair of blocks that holds more than one piece, and sizes near
enough to be linked, counts all its intersections as a product of zero-one matrices and returns a spanning forest
of the links, not the links. No bucket is too large for this and no candidate is left out.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import discard, materialise, parts, table
from .graph import components

#: Sets and bytes of sets in a block of a bucket (one set at least).
BLOCK, BLOCK_BYTES = 512, 16_000_000
#: The chance that a pair at the limit shares no band.
MISSED = 3e-7
U = np.uint64
FULL = U(0xFFFFFFFFFFFFFFFF)


def bands_rows(percent: int) -> tuple[int, int]:
    """Bands, and numbers in each: pairs of the given similarity share all numbers of a band in about a third of the bands, and
    no band with a chance of MISSED at most."""
    if not 1 <= percent <= 100:
        raise ValueError("percent lies between 1 and 100")
    if percent == 100:
        return 1, 8  # equal sets agree everywhere
    rows = max(1, round(math.log(0.35) / math.log(percent / 100)))
    return math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** rows)), rows


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Shingler:
    """Whole texts -> ascending distinct 64-bit hashes of their shingles of k words."""

    def __init__(self, k: int, limit: int = 300_000):
        self.k, self.limit, self.cache = k, limit, {}

    def word(self, w: bytes) -> int:
        import xxhash

        h = self.cache[w] = xxhash.xxh3_64_intdigest(w)
        return h

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.cache) > self.limit:
            self.cache.clear()
        get, out = self.cache.get, []
        for text in texts:
            # bytes: lower() is A-Z alone, split() is space and \x09-\x0d alone
            words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
            ids = np.array([get(w) or self.word(w) for w in words], U)
            if len(ids) < self.k:
                out.append(self._whole(words))
                continue
            h = ids[: len(ids) - self.k + 1].copy()
            for j in range(1, self.k):
                h *= U(0x9E3779B97F4A7C15)
                h += ids[j : len(ids) - self.k + 1 + j]
            out.append(np.unique(mix(h)))
        return out

    def _whole(self, words) -> np.ndarray:
        if not words:
            return np.zeros(0, U)
        return np.frombuffer(hashlib.blake2b(b" ".join(words), digest_size=8, person=b"short").digest(), U)


def sketches(sets: list[np.ndarray], t: int, seed: int = 1) -> np.ndarray:
    """One row of t numbers for each set, which must not be empty."""
    out = np.full((len(sets), t), FULL, U)
    flat = out.reshape(-1)
    values = np.concatenate(sets) if sets else np.zeros(0, U)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    salts = mix(np.arange(1, 2 * t + 1, dtype=U) * U(0xD1B54A32D192ED03) + U(seed))
    for r in range(2 * t):
        if not len(values):
            break
        h = mix(values ^ salts[r])
        bins = ((h >> U(32)) * U(t) >> U(32)).astype(np.int64) if r < t else np.full(len(h), r - t)
        np.minimum.at(flat, owner * t + bins, (U(r) << U(48)) | (h & U((1 << 48) - 1)))
        open_ = np.zeros(len(sets), bool)
        now = np.unique(owner)
        open_[now] = (out[now] == FULL).any(axis=1)
        if not open_[now].all():
            keep = open_[owner]
            values, owner = values[keep], owner[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(sketch), bands), np.int64)
    for b in range(bands):
        h = np.full(len(sketch), b + 1, U)
        for j in range(rows):
            h = mix(h * U(0x9E3779B97F4A7C15) + sketch[:, b * rows + j])
        keys[:, b] = h.view(np.int64)
    return keys


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set hash h1 and h2, band keys. A text without words has an empty set, nulls and no keys."""

    def run(batches):
        shingler = Shingler(k)
        for batch in batches:
            for part in parts(batch, 1, 400):
                sets = shingler.sets(part.column(1).to_pylist())
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(sketches(full, bands * rows), bands, rows).tolist())
                digests = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist() if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "h1", "h2", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        shingler = Shingler(k)
        for batch in batches:
            for part in parts(batch, 1, 400):
                sets = shingler.sets(part.column(1).to_pylist())
                digests = [np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist() for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["h1", "h2", "set"])

    return docs.select("doc_id", "text").mapInArrow(run, "h1 long, h2 long, set binary")


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """pairs: a, b, set_a, set_b. Keeps a, b of those similar enough."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_py(), U), np.frombuffer(y.as_py(), U)
                # sets whose sizes differ too much can't be similar enough
                if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def forest(sets: list[np.ndarray], piece: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Positions linked, enough to join all that links join; links within a piece aren't needed."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    ids, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = count[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    common = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, (lo, lo + 4096))
        x = np.zeros((n, 4096), np.float32)
        x[owner[a:b], column[a:b] - lo] = 1
        common += x @ x.T
    common = np.rint(common).astype(np.int64)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    linked &= piece[:, None] != piece[None, :]
    root = {p: p for p in piece.tolist()}

    def find(p):
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        p, q = find(int(piece[i])), find(int(piece[j]))
        if p != q:
            root[p] = q
            out.append((int(i), int(j)))
    return out


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Texts are linked where 100 * intersection >= percent * union of their shingle sets; component_id is the
    smallest doc_id that links reach, itself included. A text with fewer than k words has its words as one
    shingle; one without words (or null) has none, is linked with nothing and is kept. A row without doc_id is
    linked through its text, gets the smallest doc_id of its group, and is kept only if there is none.
    Of rows that repeat a doc_id with a text of one component, all are kept or none. Other columns are not looked at,
    whatever their names; an empty table gives an empty one. A very long text is one set, in one task."""
    bands, rows = bands_rows(percent)
    marked = materialise(signatures(docs, k, bands, rows), "signatures")
    full = marked.where(F.col("h1").isNotNull())
    classes = full.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    keyed = classes.select("cid", F.explode("bands").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("cid").alias("head"), F.count("*").alias("size")).where("size > 1")
    buckets = materialise(keyed.join(heads, "key"), "buckets")

    some = buckets.select("cid").distinct()
    wanted = classes.join(some, "cid", "left_semi").select("cid", "h1", "h2", "least")
    # a row without doc_id can stand for its class, too
    text_of = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.select(F.col("least").alias("least")).distinct(), F.col("doc_id").eqNullSafe(F.col("least")), "left_semi")
    found = shingle_sets(text_of, k).join(wanted.select("cid", "h1", "h2"), ["h1", "h2"]).dropDuplicates(["cid"])
    sets = materialise(found.select("cid", "set"), "shingle-sets")

    def with_sets(pairs):
        a, b = sets.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), sets.select(F.col("cid").alias("b"), F.col("set").alias("set_b"))
        return pairs.join(a, "a").join(b, "b")

    stars = buckets.where("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b")).distinct()
    links = materialise(verified(with_sets(stars), percent), "links")
    pieces = components(links, "pieces")

    # buckets still in pieces; of buckets with the same members one is enough
    left = buckets.where("size > 2").join(pieces.withColumnRenamed("node", "cid"), "cid", "left").withColumn("piece", F.coalesce("component", "cid"))
    kinds = left.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("cid").cast("decimal(20,0)")).alias("members"), F.min("piece").alias("lo"), F.max("piece").alias("hi"))
    kinds = kinds.where("lo < hi").groupBy("n", "members").agg(F.min("key").alias("key"))
    # in a bucket: the members of a large piece, and all others, by size (links need sizes within `percent` of each other), then
    # dealt by a hash into as many blocks as their bytes need; no task ever sees a bucket as a whole
    left = left.select("key", "cid", "piece").join(kinds.select("key"), "key").join(classes.select("cid", F.col("size").alias("n_set")), "cid")
    own = left.groupBy("key", "piece").agg((F.count("*") >= BLOCK).alias("large"))
    step = math.log(100 / percent) / 2 if percent < 100 else 1.0
    left = left.join(own, ["key", "piece"]).select("key", "cid", "piece", "n_set", F.when(F.col("large"), F.col("piece")).alias("of"), F.floor(F.log("n_set") / step).cast("int").alias("scale"))
    left = materialise(left, "left")
    deal = left.groupBy("key", "of", "scale").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(8 * F.sum("n_set") / BLOCK_BYTES)).cast("long").alias("parts"))
    same = [left["key"] == deal["key"], left["of"].eqNullSafe(deal["of"]), left["scale"] == deal["scale"]]
    left = left.join(deal, same).select(left["*"], F.pmod(F.xxhash64("cid"), F.col("parts")).alias("part"))
    left = materialise(left.select("key", "cid", "piece", F.xxhash64("of", "scale", "part").alias("block"), "n_set"), "left-blocks")
    blocks = left.groupBy("key", "block").agg(F.min("piece").alias("lo"), F.max("piece").alias("hi"), F.min("n_set").alias("small"), F.max("n_set").alias("big"), F.count("*").alias("n"))
    two = blocks.select("key", *[F.col(c).alias(c + "2") for c in ("block", "lo", "hi", "small", "big")])
    near = (100 * F.col("big") >= percent * F.col("small2")) & (100 * F.col("big2") >= percent * F.col("small"))
    apart = F.least("lo", "lo2") < F.greatest("hi", "hi2")
    dealt = blocks.join(two, "key").where((F.col("block") <= F.col("block2")) & apart & near & ((F.col("block") != F.col("block2")) | (F.col("n") > 1)))
    dealt = materialise(dealt.select("key", F.col("block").alias("i"), F.col("block2").alias("j")), "block-pairs")
    dealt = dealt.select("key", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        cids = pdf["cid"].to_numpy()
        pairs = forest([np.frombuffer(s, U) for s in pdf["set"]], pdf["piece"].to_numpy(), percent)
        return pd.DataFrame({"a": [cids[i] for i, _ in pairs], "b": [cids[j] for _, j in pairs]}, dtype="int64")

    tasks = left.select("key", "block", "cid", "piece").join(dealt, ["key", "block"]).join(sets, "cid")
    more = materialise(tasks.groupBy("key", "i", "j").applyInPandas(joined, "a long, b long"), "more-links")
    pieces_as_links = pieces.select(F.col("node").alias("a"), F.col("component").alias("b"))
    final = components(pieces_as_links.unionByName(more), "components")
    discard(buckets, sets, links, more)

    labelled = classes.select("cid", "h1", "h2", "least").join(final.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = labelled.join(smallest, "component").select("h1", "h2", "component_id")
    out = full.select("doc_id", "n_shingles", "h1", "h2").join(labelled, ["h1", "h2"]).select("doc_id", "n_shingles", "component_id")
    out = out.unionByName(marked.where(F.col("h1").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 85)
