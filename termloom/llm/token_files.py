"""Token ids in compressed files: an adaptive context-mixing range coder.

The ids of consecutive documents form one stream, cut into blocks of equal length. A block's model starts
afresh and knows nothing of other blocks, so that blocks can be decoded alone; each has a CRC-32. Within a
block an id is predicted by order 2 (what followed the last two ids), by order 1 (what followed the last
id) and by order 0 (adaptive counts of the ids' upper byte, with the lower byte's shares from the file's
header). The three are mixed with weights that follow how often each prediction held at its confidence
so far in the block, and the mixture's interval goes to a range coder.

Every step of the model works on the same position of all blocks of a file at once, as numpy vectors:
encoder and decoder run the same arithmetic on integers, so they agree exactly on any machine.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from .common import give_back, partitions, parts, scratch, table
from .word_tokens import encoder, ranked

MAGIC = b"TLMIX02\n"
SLOTS = 8  # bits of a block's table of predictions
MIX, HIGH, LOW = 10, 11, 10  # bits of the three intervals' totals
U = np.uint64


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """Rows of counts -> rows of integers that add up to total, at least 1 where the count isn't 0."""
    some = counts > 0
    spare = total - some.sum(axis=1, keepdims=True)
    out = some + counts * spare // np.maximum(counts.sum(axis=1, keepdims=True), 1)
    out[np.arange(len(out)), counts.argmax(axis=1)] += total - out.sum(axis=1)
    return out


#: Share of the interval, of 1024, that a prediction of each confidence gets: what it has to hold from its last hits.
TRUST2 = np.array([0, 120, 420, 700, 880], np.int64)
TRUST1 = np.array([0, 40, 200, 450, 700], np.int64)
HIT1, HIT2 = 64, 128
NONE = np.uint32(1 << 19)  # an empty slot: no confidence, and an id that no file holds


def intervals() -> tuple[np.ndarray, ...]:
    """Where an id's interval begins and its width, of 1024, by confidence of order 1 + 8 * confidence of order 2 + HIT1 + HIT2
    (order 2 goes first); and by both confidences alone the widths of order 2 and of both."""
    key = np.arange(256)
    f2 = np.where(key >> 3 & 7 < 5, TRUST2[np.minimum(key >> 3 & 7, 4)], 0)
    f1 = (1000 - f2) * TRUST1[np.minimum(key & 7, 4)] >> 10
    begin = np.where(key & HIT2, 0, np.where(key & HIT1, f2, f1 + f2))
    width = np.where(key & HIT2, f2, np.where(key & HIT1, f1, (1 << MIX) - f1 - f2))
    return begin.astype(U), width.astype(U), f2.astype(U), (f1 + f2).astype(U)


BEGIN, WIDTH, UPTO2, UPTO12 = intervals()


class Model:
    """The state of n blocks. prior: counts of the file's ids, 256 by 256. seen: positions by blocks, the ids up to the present step.

    A slot of a prediction table holds id * 8 + confidence (1 to 4); a hit raises the confidence, a
    miss puts the new id in its place. An order's weight in the mixture is its slot's confidence."""

    def __init__(self, n: int, prior: np.ndarray, seen: np.ndarray):
        self.n, self.seen, lanes = n, seen, np.arange(n, dtype=np.uint32)
        self.base, self.lane256 = lanes << np.uint32(SLOTS), np.arange(n) << 8
        self.t1, self.t2 = np.full(n << SLOTS, NONE), np.full(n << SLOTS, NONE)
        self.last, self.mixed = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        upper = prior.sum(axis=1)
        self.counts = np.tile(shares(upper[None, :], 512), (n, 1)).astype(np.int32)
        low = np.where(upper[:, None] > 0, prior, np.eye(1, 256, dtype=prior.dtype))
        low = shares(low, 1 << LOW)
        self.low = ((np.cumsum(low, axis=1) - low) << 16 | low).ravel().astype(np.uint32)
        self.low_of = np.repeat(np.tile(np.arange(256, dtype=np.uint32), 256), low.ravel())
        self.step = self.counted = 0
        self.refresh()

    def refresh(self) -> None:
        """Takes in the upper bytes seen since the last time. high, low: where an interval begins << 16 | its width."""
        if self.step > self.counted:
            where = (self.seen[self.counted : self.step] >> 8) + self.lane256
            self.counts += 8 * np.bincount(where.ravel(), minlength=self.n << 8).reshape(self.n, 256).astype(np.int32)
            self.counted = self.step
        high = shares(self.counts, 1 << HIGH)
        self.high = ((np.cumsum(high, axis=1) - high) << 16 | high).ravel().astype(np.uint32)
        self.high_of = np.repeat(np.tile(np.arange(256, dtype=np.uint8), self.n), high.ravel())

    def predict(self) -> np.ndarray:
        """Sets v1, v2; the confidences, order 1's without one where both predict the same id."""
        spread = self.last * np.uint32(40503)  # 32 bits, wrapping
        mask = np.uint32((1 << SLOTS) - 1)
        self.i1 = (self.base + (spread >> np.uint32(4) & mask)).astype(np.intp)
        self.i2 = (self.base + (spread + self.mixed >> np.uint32(5) & mask)).astype(np.intp)
        self.v1, self.v2 = self.t1.take(self.i1), self.t2.take(self.i2)
        c1 = (self.v1 & np.uint32(7)) * ((self.v1 ^ self.v2) > 7)
        return (c1 | (self.v2 & np.uint32(7)) << np.uint32(3)).astype(np.intp)

    def update(self, ids: np.ndarray, d1=None, d2=None) -> None:
        """ids: of this step in each block (uint32). d1, d2: the slots less an id's first entry (under 4: a hit)."""
        fresh = (ids << np.uint32(3)) + np.uint32(1)
        for t, i, v, d in ((self.t1, self.i1, self.v1, d1), (self.t2, self.i2, self.v2, d2)):
            d = v - fresh if d is None else d
            t[i] = fresh + np.minimum(d + np.uint32(1), np.uint32(3)) * (d < 4)
        self.mixed, self.last = self.last * np.uint32(30011), ids
        self.step += 1
        if self.step >= 64 and self.step & (self.step - 1) == 0 or self.step % 1024 == 0:
            self.refresh()


def encode_blocks(ids: np.ndarray, prior: np.ndarray) -> list[bytes]:
    """ids: blocks by positions. The code of each block. An id takes less than 27 bits, so two words of 16 for each do."""
    n, length = ids.shape
    columns = np.ascontiguousarray(ids.T.astype(np.uint32))
    model, room = Model(n, prior, columns), 2 * length + 16
    low, size, at = np.zeros(n, U), np.full(n, (1 << 48) - 1, U), np.arange(n) * room
    out = np.zeros(n * room, np.uint32)

    def emit(which) -> None:
        x, k = low[which], at[which]
        out[k] = x >> U(32)  # a carry may make it 17 bits
        low[which] = (x & U(0xFFFFFFFF)) << U(16)
        at[which] = k + 1

    for k in range(length):
        x = columns[k]
        key, fresh = model.predict(), (x << np.uint32(3)) + np.uint32(1)
        d1, d2 = model.v1 - fresh, model.v2 - fresh
        hit1, hit2 = d1 < 4, d2 < 4
        key += hit1 * HIT1 + hit2 * HIT2
        unit = size >> U(MIX)
        low += unit * BEGIN.take(key)
        size = unit * WIDTH.take(key)
        m = np.flatnonzero(key < HIT1)
        if len(m):
            xm = x.take(m)
            pair = model.high.take((m << 8) + (xm >> np.uint32(8)))
            unit = size.take(m) >> U(HIGH)
            add, unit = unit * (pair >> np.uint32(16)), unit * (pair & np.uint32(0xFFFF)) >> U(LOW)
            pair = model.low.take(xm)
            low[m] += add + unit * (pair >> np.uint32(16))
            size[m] = unit * (pair & np.uint32(0xFFFF))
        while len(small := np.flatnonzero(size < U(1 << 32))):
            emit(small)
            size[small] <<= U(16)
        model.update(x, d1, d2)
    for _ in range(3):
        emit(np.arange(n))
    used = at - np.arange(n) * room
    rows = np.ascontiguousarray(out.reshape(n, room)[:, : int(used.max())].T)
    for k in range(len(rows) - 1, 0, -1):
        rows[k - 1] += rows[k] >> 16
        rows[k] &= 0xFFFF
    rows = np.ascontiguousarray(rows.T.astype("<u2"))
    return [rows[i, : used[i]].tobytes() for i in range(n)]


def decode_blocks(codes: list[bytes], length: int, prior: np.ndarray) -> np.ndarray:
    n = len(codes)
    ids = np.empty((length, n), np.uint32)
    model = Model(n, prior, ids)
    sizes = np.array([len(c) // 2 for c in codes])
    room = int(sizes.max()) + 4
    words = np.zeros((n, room), np.uint16)
    for i, c in enumerate(codes):
        words[i, : sizes[i]] = np.frombuffer(c, "<u2")
    first = words[:, :3].astype(U)
    code, size, at = first[:, 0] << U(32) | first[:, 1] << U(16) | first[:, 2], np.full(n, (1 << 48) - 1, U), np.arange(n) * room + 3
    words = words.ravel()
    for k in range(length):
        key = model.predict()
        unit = size >> U(MIX)
        hit2, hit12 = code < unit * UPTO2.take(key), code < unit * UPTO12.take(key)
        x = np.where(hit2, model.v2, model.v1) >> np.uint32(3)
        key += (hit12 ^ hit2) * HIT1 + hit2 * HIT2
        code -= unit * BEGIN.take(key)
        size = unit * WIDTH.take(key)
        m = np.flatnonzero(~hit12)
        if len(m):
            c, unit = code.take(m), size.take(m) >> U(HIGH)
            v = np.minimum(c // unit, U((1 << HIGH) - 1)).astype(np.intp)
            upper = model.high_of.take((m << HIGH) + v).astype(np.intp)
            pair = model.high.take((m << 8) + upper)
            c -= unit * (pair >> np.uint32(16))
            unit = unit * (pair & np.uint32(0xFFFF)) >> U(LOW)
            v = np.minimum(c // unit, U((1 << LOW) - 1)).astype(np.intp)
            xm = model.low_of.take((upper << LOW) + v) + (upper << 8)
            pair = model.low.take(xm)
            x[m], code[m], size[m] = xm, c - unit * (pair >> np.uint32(16)), unit * (pair & np.uint32(0xFFFF))
        while len(small := np.flatnonzero(size < U(1 << 32))):
            where = at.take(small)
            code[small] = code.take(small) << U(16) | words.take(where)
            size[small] <<= U(16)
            at[small] = where + 1
        ids[k] = x
        model.update(x)
    return ids.T


def pack_file(doc_ids: list[int | None], raws: list[bytes], block: int | None = None) -> bytes:
    """Ids under 65,536 of whole documents, little-endian unsigned 32-bit, to a file's bytes.

    A file's parts: magic; header length and CRC; header (numbers of documents, ids, blocks, block length;
    then compressed: document ids, which are null, ids in each, the ids' shares, code lengths, code CRCs); codes."""
    ids = np.frombuffer(b"".join(raws), "<u4")
    total = len(ids)
    if total and int(ids.max()) >= 1 << 16:
        raise ValueError("ids of 65,536 and more don't fit this format")
    block = block or min(1024, max(256, 1 << max(total // 1024, 1).bit_length()))
    n = -(-total // block)
    padded = np.zeros(n * block, np.int64)
    padded[:total] = ids
    prior = np.bincount(padded, minlength=1 << 16).reshape(256, 256)
    prior = np.minimum(prior * 4095 // max(int(prior.max()), 1) + (prior > 0), 4096).astype(np.int64)
    codes = encode_blocks(padded.reshape(n, block), prior) if n else []
    parts = [
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(),
        np.array([len(r) // 4 for r in raws], "<u8").tobytes(),
        prior.astype("<u2").tobytes(),
        np.array([len(c) for c in codes], "<u4").tobytes(),
        np.array([zlib.crc32(c) for c in codes], "<u4").tobytes(),
    ]
    squeezed = [zlib.compress(p, 6) for p in parts]
    header = struct.pack("<4Q6Q", len(doc_ids), total, n, block, *map(len, squeezed)) + b"".join(squeezed)
    return b"".join([MAGIC, struct.pack("<QI", len(header), zlib.crc32(header)), header, *codes])


def unpack_file(data: bytes) -> tuple[list[int | None], list[bytes]]:
    """The document ids and ids that pack_file() was given. Raises ValueError where a checksum fails."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    size, crc = struct.unpack_from("<QI", data, 8)
    header = data[20 : 20 + size]
    if zlib.crc32(header) != crc:
        raise ValueError("the header's checksum fails")
    docs, total, n, block, *sizes = struct.unpack_from("<4Q6Q", header)
    at, parts = 80, []
    for s in sizes:
        parts.append(zlib.decompress(header[at : at + s]))
        at += s
    doc_ids, null, counts, prior, lengths, crcs = (np.frombuffer(p, t) for p, t in zip(parts, ("<i8", "u1", "<u8", "<u2", "<u4", "<u4")))
    at, codes = 20 + size, []
    for length, crc in zip(lengths.tolist(), crcs.tolist()):
        codes.append(data[at : at + length])
        if zlib.crc32(codes[-1]) != crc:
            raise ValueError(f"the checksum of block {len(codes) - 1} fails")
        at += length
    ids = decode_blocks(codes, block, prior.astype(np.int64).reshape(256, 256)).reshape(-1)[:total].astype(np.int64) if n else np.zeros(0, np.int64)
    raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts.astype(np.int64)) * 4
    starts = ends - counts.astype(np.int64) * 4
    return [None if z else int(d) for d, z in zip(doc_ids, null)], [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


FILE_SCHEMA = "part int, seq int, n_docs long, n_tokens long, data binary"


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, file_tokens: int = 4_000_000, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode texts (null: empty), append end_id, write the ids in ascending order of id_col (nulls first).

    `path` gets a Parquet dataset whose rows are files in this module's format, ordered by (part, seq): so the
    files of a task appear only when the task is committed, on whatever store Spark writes to. A file
    holds whole documents and about file_tokens ids at most (or one larger document). Rows of one id are ordered by
    their texts' hash, then by text (nulls first); such rows all go to one task, through which they stream. Other columns are
    not looked at, whatever their names; an empty table gives no file."""
    by_ranks = ranked(vocabulary)

    def run(batches):
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids_of, end = encoder(vocabulary, by_ranks), np.array([end_id], "<u4").tobytes()
        doc_ids, raws, held = [], [], 0

        def flush():
            nonlocal doc_ids, raws, held, seq
            data = pack_file(doc_ids, raws)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(raws)], pa.int64()), pa.array([held], pa.int64()), pa.array([data], pa.binary())], names=["part", "seq", "n_docs", "n_tokens", "data"])
            doc_ids, raws, held, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            for rows in parts(batch, 1, 4000, 8_000_000, tidy=False):
                for doc_id, raw in zip(rows.column(0).to_pylist(), ids_of.encode(rows.column(1))):
                    if held and held + len(raw) // 4 + 1 > file_tokens:
                        yield flush()
                    doc_ids.append(doc_id), raws.append(raw + end)
                    held += len(raw) // 4 + 1
        if raws:
            yield flush()
        give_back()

    spark = docs.sparkSession
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange(partitions(spark), "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of write()'s files: doc_id, start (ids before it), n_tokens, ids_crc32 (and ids)."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                doc_ids, raws = unpack_file(batch.column(2)[k].as_py())
                sizes = np.array([len(r) // 4 for r in raws], np.int64)
                one = np.ones(len(raws), np.int32)
                columns = [one * batch.column(0)[k].as_py(), one * batch.column(1)[k].as_py(), pa.array(doc_ids, pa.int64()), np.cumsum(sizes) - sizes, sizes, np.array([zlib.crc32(r) for r in raws], np.int64)]
                names = ["part", "seq", "doc_id", "own", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(raws, pa.binary())), names.append("ids")
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    found = files.select("part", "seq", "data").mapInArrow(run, "part int, seq int, doc_id long, own long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    sizes = files.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all"))  # a row for each task that wrote
    parts = parts.select("part", (F.sum("all").over(W.orderBy("part")) - F.col("all")).alias("parts_before"))
    sizes = sizes.select("part", "seq", (F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq")) - F.col("n_tokens")).alias("before"))
    base = sizes.join(parts, "part").select("part", "seq", (F.col("parts_before") + F.col("before")).alias("base"))
    return found.join(base, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch(spark, "token-files")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(spark, path)
