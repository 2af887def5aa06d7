"""Approximate nearest neighbours by collision counting.

Vectors are dealt into blocks of like signs of a few projections. A block is indexed by m random projections, each a
sorted array. For a query the windows centred on its own projections grow together (virtual rehashing: any width is a
bucket width, nothing is rehashed); a vector's count is the number of windows it lies in. Whatever reaches the collision
threshold is verified on the original vectors. A query is done in a block once the windows are so wide, against the
distance of its k-th verified vector, that a nearer vector would have reached the threshold.

Queries first search the block that they lie in, which bounds the distance of their k-th neighbour. With that bound they go to
the other blocks, and there only to those that can hold anything nearer (by the block's centre and radius, exactly).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import discard, materialise, table

PROJECTIONS, THRESHOLD = 64, 0.6
#: A window's half width over a vector's distance at which the vector is in two of three windows.
REACH = 1.0
BLOCK = 16384
#: Bytes of queries that are on their way from the driver to the executors at a time.
QUERY_BYTES = 32_000_000
#: Signs of projections by which vectors are dealt into blocks.
SIGNS = 16


class Block:
    def __init__(self, vectors: np.ndarray, seed: int = 11):
        self.vectors = vectors.astype(np.float64)
        n, dim = self.vectors.shape
        # in units of the largest component, so that nothing overflows
        self.unit = float(np.abs(self.vectors).max()) if n else 1.0
        scaled = self.vectors / self.unit
        self.axes = np.random.default_rng(seed).standard_normal((dim, PROJECTIONS))
        spread = scaled @ self.axes
        self.order = np.argsort(spread, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(spread.T, self.order, axis=1)
        self.need = int(np.ceil(THRESHOLD * PROJECTIONS))
        self.rough, self.squares = scaled.astype(np.float32), (scaled**2).sum(axis=1)
        self.centre = scaled.mean(axis=0) if n else np.zeros(dim)
        self.radius = float(np.sqrt(((scaled - self.centre) ** 2).sum(axis=1).max())) if n else 0.0
        # where windows start: wide enough for a few vectors, were all projections alike
        step = max(1, min(n - 1, 16))
        self.first = float(np.median(self.sorted[:, step::step] - self.sorted[:, :-step:step])) if n > step else 1.0

    def exact(self, query: np.ndarray, which: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.sqrt(((self.vectors[which] - query) ** 2).sum(axis=1))

    def search(self, queries: np.ndarray, own: list[int], k: int, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query positions and distances of vectors verified, none beyond its bound. own: a position to leave out, or -1."""
        out, nothing = [], (np.zeros(0, np.int64), np.zeros(0))
        with np.errstate(over="ignore", invalid="ignore"):
            scaled, limits = queries / self.unit, bounds / self.unit
            fine = np.isfinite(scaled).all(axis=1) & (np.abs(scaled) < 1e15).all(axis=1)
            far = np.sqrt(((scaled - self.centre) ** 2).sum(axis=1)) - self.radius > limits * (1 + 1e-9) + 1e-9
        products = self.rough @ np.where(fine[:, None], scaled, 0).astype(np.float32).T
        for i, q in enumerate(queries):
            if fine[i] and far[i]:
                out.append(nothing)
                continue
            if not fine[i]:
                every = np.array([p for p in range(len(self.vectors)) if p != own[i]], np.int64)
                found = every, self.exact(q, every)
            else:
                size = float((scaled[i] ** 2).sum())
                rough = np.sqrt(np.maximum(self.squares + size - 2 * products[:, i].astype(np.float64), 0))
                slack = 1e-3 * np.sqrt(self.squares + size) + 1e-12
                found = self._windows(q, scaled[i], own[i], k, float(limits[i]), rough - slack)
            near = found[1] <= bounds[i]
            out.append((found[0][near], found[1][near]))
        return out

    def _windows(self, query, scaled, own: int, k: int, limit: float, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """least: what each vector's distance is at least. Only vectors that reach the threshold and may be near enough are measured."""
        centre = scaled @ self.axes
        n, counts, fresh = len(self.vectors), np.zeros(len(self.vectors), np.int64), np.ones(len(self.vectors), bool)
        if own >= 0:
            fresh[own] = False
        lo = np.array([np.searchsorted(s, c) for s, c in zip(self.sorted, centre)])
        hi, seen, dist, kth = lo.copy(), [], np.zeros(0), limit
        half = REACH * limit if np.isfinite(limit) else max(self.first, 1e-12)
        while True:
            added = []
            for j, c in enumerate(centre):
                s, o = self.sorted[j], self.order[j]
                a, b = min(int(np.searchsorted(s, c - half)), lo[j]), max(int(np.searchsorted(s, np.nextafter(c + half, np.inf))), hi[j])
                added += (o[a : lo[j]], o[hi[j] : b])
                lo[j], hi[j] = a, b
            counts += np.bincount(np.concatenate(added), minlength=n)
            new = np.flatnonzero((counts >= self.need) & fresh)
            if len(new):
                fresh[new] = False
                new = new[least[new] <= kth]
                seen.append(new)
                dist = np.concatenate([dist, self.exact(query, new)])
                if len(dist) >= k:
                    kth = min(limit, float(np.partition(dist, k - 1)[k - 1]) / self.unit)
            if not fresh.any() or (lo == 0).all() and (hi == n).all() or half >= REACH * kth:
                return np.concatenate([*seen, np.zeros(0, np.int64)]), dist
            half = min(half * 1.5, max(REACH * kth, half * 1.02))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows vec_id, v of vectors that are neither null, empty, zero, nor hold null or non-finite numbers."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(fine, F.lit(False)) & F.exists("v", lambda x: x != 0))


def _placed(batches):
    """Adds the number of dimensions and the cell: signs of projections, the same ones in every batch."""
    for batch in batches:
        sizes, flat = batch.column(2).value_lengths().to_numpy(), batch.column(2).flatten().to_numpy()
        starts, cell = np.cumsum(sizes) - sizes, np.zeros(batch.num_rows, np.int64)
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            v = flat[starts[at][:, None] + np.arange(dim)]
            signs = (v / np.abs(v).max(axis=1, keepdims=True)) @ np.random.default_rng(5).standard_normal((dim, SIGNS)) > 0
            cell[at] = signs @ (1 << np.arange(SIGNS)[::-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int32()), pa.array(cell)], names=["vec_id", "uid", "v", "dim", "cell"])


HITS = "q_uid long, query_id long, uid long, vec_id long, score double"


def _blocks(batches, size: int):
    """Of one partition's rows (vec_id, uid, v), blocks of vectors of the same length: names, uids, vectors."""
    held, n = [], 0

    def made():
        names = np.concatenate([np.array([np.iinfo(np.int64).max if x is None else x for x in b.column(0).to_pylist()], np.int64) for b in held])
        uids = np.concatenate([b.column(1).to_numpy() for b in held])
        sizes = np.concatenate([b.column(2).value_lengths().to_numpy() for b in held])
        flat = np.concatenate([b.column(2).flatten().to_numpy() for b in held])
        starts = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            yield names[at], uids[at], flat[starts[at][:, None] + np.arange(dim)]

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, size - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == size:
                yield from made()
                held, n = [], 0
    if held:
        yield from made()


def _hits(block: Block, names, uids, q_ids, q_uids, queries, bounds, k: int) -> pa.RecordBatch:
    place, columns = {int(u): i for i, u in enumerate(uids)}, ([], [], [], [], [])
    for at in range(0, len(queries), 64):
        some = slice(at, at + 64)
        found = block.search(queries[some], [place.get(int(u), -1) for u in q_uids[some]], k, bounds[some])
        for q_uid, q_id, (seen, dist) in zip(q_uids[some], q_ids[some], found):
            best = np.lexsort((names[seen], dist))[:k]
            if len(best):
                for column, x in zip(columns, (np.full(len(best), q_uid), np.full(len(best), q_id), uids[seen[best]], names[seen[best]], dist[best])):
                    column.append(x)
    q_uid, q_id, uid, name, score = (np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(columns, (np.int64,) * 4 + (float,)))
    unnamed = name == np.iinfo(np.int64).max
    arrays = [pa.array(q_uid, pa.int64()), pa.array(q_id, pa.int64()), pa.array(uid, pa.int64()), pa.array(name, pa.int64(), mask=unnamed), pa.array(score, pa.float64())]
    return pa.RecordBatch.from_arrays(arrays, names=["q_uid", "query_id", "uid", "vec_id", "score"])


def search(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Queries: usable rows whose vec_id is divisible by `every`; candidates: all usable rows but the query's own.
    Returns query_id, rank, vec_id, score (Euclidean distance): each query's k nearest found, or all candidates if
    fewer; ties to the smaller vec_id. Vectors meet only those of as many dimensions. Rows that repeat a vec_id
    are vectors (and queries) of their own; a row without vec_id is a candidate, not a query, and comes last among ties. A
    distance whose square is beyond double precision is infinite. Other columns are not looked at, whatever their names;
    an empty table gives an empty one."""
    spark, block_size = vectors.sparkSession, BLOCK
    rows = usable(vectors).withColumn("uid", F.monotonically_increasing_id()).select("vec_id", "uid", "v")
    rows = materialise(rows.mapInArrow(_placed, "vec_id long, uid long, v array<double>, dim int, cell long"), "vectors")
    asks = F.col("vec_id") % every == 0
    n, queries, widest = rows.agg(F.count("*"), F.count(F.when(asks, 1)), F.max("dim")).first()
    dealt = rows.repartitionByRange(max(1, -(-n // block_size)), "dim", "cell", "uid").select("vec_id", "uid", "v")
    dealt = materialise(dealt, "vector-blocks")
    discard(rows)

    def at_home(batches):
        for names, uids, v in _blocks(batches, block_size):
            mine = np.flatnonzero((names % every == 0) & (names != np.iinfo(np.int64).max))
            if len(mine):
                yield _hits(Block(v), names, uids, names[mine], uids[mine], v[mine].astype(np.float64), np.full(len(mine), np.inf), k)

    home = materialise(dealt.mapInArrow(at_home, HITS), "home-hits")
    bounds = home.groupBy(F.col("q_uid").alias("uid")).agg(F.when(F.count("*") >= k, F.max("score")).otherwise(float("inf")).alias("bound"))
    asked = dealt.where(asks).join(bounds, "uid", "left").select("uid", "vec_id", "v", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
    sent = max(1, -(-queries * 8 * (widest or 1) // QUERY_BYTES))
    asked = materialise(asked.withColumn("turn", F.pmod(F.xxhash64("uid"), F.lit(sent))), "queries")
    found = home
    for turn in range(sent):
        batch = asked.where(F.col("turn") == turn).toPandas()  # QUERY_BYTES, give or take the hash
        held = spark.sparkContext.broadcast((batch["vec_id"].to_numpy(np.int64), batch["uid"].to_numpy(np.int64), batch["bound"].to_numpy(float), [np.asarray(v, np.float64) for v in batch["v"]]))

        def elsewhere(batches, held=held):
            q_ids, q_uids, q_bounds, q_vectors = held.value
            dims = np.array([len(v) for v in q_vectors])
            for names, uids, v in _blocks(batches, block_size):
                these = np.flatnonzero(dims == v.shape[1])
                if len(these):
                    yield _hits(Block(v), names, uids, q_ids[these], q_uids[these], np.array([q_vectors[i] for i in these]), q_bounds[these], k)

        found = found.unionByName(materialise(dealt.mapInArrow(elsewhere, HITS), "hits"))
        held.destroy()
    each = found.groupBy("q_uid", "uid").agg(*[F.first(c).alias(c) for c in ("query_id", "vec_id", "score")])  # what was found at home and again
    rank = F.row_number().over(W.partitionBy("q_uid").orderBy("score", F.asc_nulls_last("vec_id")))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
