"""Packing documents into fixed-length sequences by cutting-stock column generation.

A document's ids are cut into full pieces of `capacity` ids and a rest. Piece lengths are rounded up to
a grid and counted; the counts (at most capacity/grid numbers, whatever the input's size) go to the
driver. There a linear program over patterns (which lengths share a sequence) is solved by a revised
simplex whose columns are priced by a knapsack dynamic program. Patterns are rounded down; what they
leave is packed first-fit. Every piece then gets a rank among those of its length, and rank ranges of
the patterns give its sequence. Ranks are found from counts of salted groups, so that a length that
holds most pieces is never in one task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import discard, materialise, partitions, parts, table
from .word_tokens import encoder, ranked

#: More simplex steps than this are not taken; the basis is feasible at every step.
MAX_PIVOTS = 4000


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 0, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens (and ids, binary little-endian).

    Null or empty text: one piece, the end id alone. Rows that repeat are packed as often as they occur; a null id is kept. A long
    text makes many pieces; other columns are not looked at, whatever their names. An empty table has no pieces."""
    by_ranks = ranked(path)

    def run(batches):
        ids_of = encoder(path, by_ranks)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for part in parts(batch, 1, 4000, 3_000_000):
                which, start, size, crc, total, ids = [], [], [], [], [], []
                for k, raw in enumerate(ids_of.encode(part.column(1))):
                    raw += end
                    n = len(raw) // 4
                    for s in range(0, n, capacity):
                        x = raw[4 * s : 4 * (s + capacity)]
                        which.append(k), start.append(s), size.append(len(x) // 4), crc.append(zlib.crc32(x)), total.append(n)
                        if with_ids:
                            ids.append(x)
                columns = [part.column(0).take(pa.array(which, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, size, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.array(ids, pa.binary())), names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def price(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of most value: an unbounded knapsack. sizes ascend."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    upto = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c], last[c] = best[c - 1], -2
        if k := upto[c]:
            gain = values[:k] + best[c - sizes[:k]]
            j = int(gain.argmax())
            if gain[j] > best[c]:
                best[c], last[c] = gain[j], j
    column, c = np.zeros(len(sizes)), room
    while c > 0 and last[c] != -1:
        if last[c] == -2:
            c -= 1
        else:
            column[last[c]] += 1
            c -= sizes[last[c]]
    return float(best[room]), column


def greedy(sizes: np.ndarray, demand: np.ndarray, room: int) -> np.ndarray:
    """Patterns of a first-fit-decreasing packing, as columns."""
    left, columns = demand.astype(np.int64), []
    while left.any():
        column, free = np.zeros(len(sizes), np.int64), room
        for i in np.flatnonzero(left)[::-1]:
            column[i] = min(left[i], free // sizes[i])
            free -= column[i] * sizes[i]
        columns.append(column)
        some = np.flatnonzero(column)
        left = left - (left[some] // column[some]).min() * column
    return np.array(columns, float).T


def solve(sizes: np.ndarray, demand: np.ndarray, room: int, max_pivots: int = MAX_PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used in the linear relaxation's optimum.

    The pool of columns starts from a first-fit packing; the knapsack makes a new column whenever no column
    of the pool pays. Surplus columns keep the prices from falling below zero."""
    m, per = len(sizes), room // sizes
    basis, inverse, cost = np.diag(per.astype(float)), np.diag(1.0 / per), np.ones(m)
    use, pool = demand / per, greedy(sizes, demand, room)
    for _ in range(max_pivots):
        duals = cost @ inverse
        gain, charge = duals @ pool, 1.0
        if gain.max() > 1 + 1e-7:
            column = pool[:, int(gain.argmax())]
        elif (low := int(duals.argmin())) >= 0 and duals[low] < -1e-7:
            column, charge = np.zeros(m), 0.0
            column[low] = -1
        else:
            value, column = price(np.maximum(duals, 0), sizes, room)
            if value <= 1 + 1e-7:
                break
            pool = np.column_stack([pool, column])
        step = inverse @ column
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        near = np.flatnonzero(ratio <= ratio.min() + 1e-9)
        out = int(near[step[near].argmax()])
        if not np.isfinite(ratio[out]):
            break
        use -= ratio[out] * step
        use[out] = ratio[out]
        np.maximum(use, 0, out=use)
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        basis[:, out], cost[out] = column, charge
    kept = cost > 0
    return basis[:, kept], use[kept]


def plan(counts: dict[int, int], room: int) -> list[tuple[int, int, int, int, int, int]]:
    """counts: pieces of each grid length. Returns rows (bin, lo, hi, sequence, mult, position): the pieces of
    that length ranked lo to hi - 1 go to the sequences from `sequence` on, mult to each."""
    sizes = np.array(sorted(k for k, n in counts.items() if n), int)
    if not len(sizes):
        return []
    demand = np.array([counts[int(s)] for s in sizes], float)
    patterns, use = solve(sizes, demand, room)
    left, chosen = demand.astype(np.int64), []
    for p in np.argsort(-use, kind="stable"):
        column = patterns[:, p].astype(np.int64)
        if (n := int(use[p] + 1e-6)) > 0 and column.any():
            chosen.append((n, column))
            left = left - n * column
    left = np.maximum(left, 0)
    bins: list[tuple[int, np.ndarray]] = []  # first fit decreasing over what rounding left, a few sequences for each pattern
    for i in range(len(sizes) - 1, -1, -1):
        n, fresh = int(left[i]), []
        for k, (room_left, column) in enumerate(bins):
            if not n:
                break
            if fit := min(n, room_left // int(sizes[i])):
                column[i] += fit
                bins[k] = (room_left - fit * int(sizes[i]), column)
                n -= fit
        while n:
            column = np.zeros(len(sizes), np.int64)
            column[i] = fit = min(n, room // int(sizes[i]))
            fresh.append((room - fit * int(sizes[i]), column))
            n -= fit
        bins += fresh
    chosen += [(1, column) for _, column in bins]
    rows, used, sequence = [], np.zeros(len(sizes), np.int64), 0
    for n, column in chosen:
        for position, i in enumerate(np.flatnonzero(column)[::-1]):
            lo, hi = int(used[i]), min(int(used[i] + n * column[i]), int(demand[i]))
            if lo < hi:
                rows.append((int(sizes[i]), lo, hi, sequence, int(column[i]), position))
            used[i] += n * column[i]
        sequence += n
    return rows


def pack(found: DataFrame, capacity: int = 1024, grid: int = 4) -> DataFrame:
    """pieces() -> the same rows with sequence_id and offset, gapless from 0 in each sequence. No piece is
    dropped; a sequence holds at most capacity ids. An empty table gives an empty table."""
    spark = found.sparkSession
    found = materialise(found, "pieces")
    salt = 8 * partitions(spark)
    keyed = found.withColumns({"bin": F.ceil(F.col("length") / grid).cast("int"), "salt": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salt)).cast("int")})
    groups = materialise(keyed.groupBy("bin", "salt").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["bin"]: r["n"] for r in groups.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    rows = plan(counts, -(-capacity // grid))
    plan_df = spark.createDataFrame(rows, "bin int, lo long, hi long, sequence long, mult long, position int")
    base = groups.select("bin", "salt", (F.sum("n").over(W.partitionBy("bin").orderBy("salt")) - F.col("n")).alias("base"))
    own = F.row_number().over(W.partitionBy("bin", "salt").orderBy("doc_id", "start", "ids_crc32"))
    ranked = keyed.withColumn("own", own).join(base, ["bin", "salt"]).withColumn("rank", F.col("base") + F.col("own") - 1).drop("base", "own", "salt")
    on = [ranked["bin"] == plan_df["bin"], ranked["rank"] >= plan_df["lo"], ranked["rank"] < plan_df["hi"]]
    # The plan has at most a few rows for each grid length, whatever the input's size.
    placed = ranked.join(F.broadcast(plan_df), on).withColumns(
        {"sequence_id": F.col("sequence") + F.expr("(rank - lo) div mult"), "slot": F.col("position") * F.lit(capacity + 1) + F.expr("(rank - lo) % mult")}
    )
    before = F.sum("length").over(W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("length")
    return placed.withColumn("offset", before).select(*found.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = 1024, with_ids: bool = False, path: str | None = None) -> DataFrame:
    import public_tokenizers

    return pack(pieces(docs, path or public_tokenizers.path("byte_bpe_50k.json"), capacity, with_ids=with_ids), capacity)


def assemble(packed: DataFrame, capacity: int = 1024, pad_id: int = 0) -> DataFrame:
    """Packed pieces with ids -> one row per sequence: sequence_id, ids (binary, little-endian), used. Padded to
    capacity unless the used length is a power of two."""
    joined = F.expr("array_join(transform(array_sort(collect_list(struct(offset, hex(ids)))), x -> x.col2), '')")
    out = packed.groupBy("sequence_id").agg(joined.alias("digits"), F.sum("length").alias("used"))
    pad = np.array([pad_id], "<u4").tobytes().hex()
    exact = F.expr("used & (used - 1)") == 0
    wide = F.concat("digits", F.expr(f"repeat('{pad}', cast({capacity} - used as int))"))
    return out.select("sequence_id", F.unhex(F.when(exact, F.col("digits")).otherwise(wide)).alias("ids"), "used")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
