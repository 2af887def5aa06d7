"""Byte-level BPE by a rank file, over overlapping chunks.

A text longer than a chunk is cut into chunks that overlap. Each chunk is pre-tokenised and encoded in a
task of its own. A pre-token boundary that two neighbours share inside their overlap is where they
resynchronise: from there on the later chunk's pre-tokens are those of the whole text, and the earlier
chunk's are right up to there, for only what touches its last characters can feel the cut. Chunks that share no
boundary with their neighbours (a run of letters longer than the overlap) are joined and pre-tokenised once.
Decoding concatenates the ids' raw bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import partitions, parts, table
from .word_tokens import Kept, pieces as pieces_of

CHUNK, OVERLAP = 16384, 512
#: A space between other characters: no pre-token runs across its left side, wherever pre-tokenising began.
IN_STEP = re.compile(r"\S \S\S*\s")


class RankCodec:
    """Encodes each match of the pre-tokeniser's pattern separately; keeps the ids of short ones, a bounded number."""

    def __init__(self, path: str, limit: int = 300_000, longest: int = 32):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pretokens = regex.compile(public_tokenizers.PATTERN).findall
        # a match of the pattern, taken alone, is again one match
        self.single = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
        self.match = Kept(self._match, limit, longest).__getitem__
        self.piece = Kept(self._piece, limit, longest).__getitem__

    def _match(self, pretoken: str) -> bytes:
        return array("I", self.single(pretoken)).tobytes()

    def _piece(self, piece: str) -> bytes:
        return array("I", self.single(piece)).tobytes() if len(piece) < 1000 else b"".join(map(self.match, self.pretokens(piece)))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.piece, pieces_of(text)))

    def decode(self, raw: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, array("I", raw)))


@functools.lru_cache(2)
def codec_of(path: str) -> RankCodec:
    """One for each Python worker, with what it has kept."""
    return RankCodec(path)


#: What encode() can return, from the ids of a text as little-endian unsigned 32-bit numbers.
COLUMNS = {
    "n_tokens": ("long", lambda codec, raw: len(raw) // 4),
    "ids": ("binary", lambda codec, raw: raw),
    "decoded": ("binary", lambda codec, raw: codec.decode(raw)),
    "ids_sha256": ("string", lambda codec, raw: hashlib.sha256(",".join(map(str, array("I", raw))).encode()).hexdigest()),
    "decoded_sha256": ("string", lambda codec, raw: hashlib.sha256(codec.decode(raw)).hexdigest()),
}
ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def shared(current: tuple, following: tuple) -> int | None:
    """The first boundary in both of two neighbours. Of the earlier one's, those that the cut may have made don't count."""
    sure = current[2][current[2] <= current[2][-1] - 3]
    common = np.intersect1d(sure, np.concatenate([[following[0]], following[2]]))
    common = common[common >= following[0]]
    return int(common[0]) if len(common) else None


def stitch(codec: RankCodec, chunks: list[tuple[int, str | None, np.ndarray, np.ndarray, bytes]]) -> bytes:
    """chunks in order: (start, text, ends of its pre-tokens, ids in each, ids). Returns the whole text's ids. A chunk's
    text is looked at only where it shares no boundary with a neighbour."""
    out, at, first = [], 0, 0

    def upto(chunk, lo: int, hi: int) -> bytes:
        start, _, ends, counts, raw = chunk
        cum = np.concatenate([[0], np.cumsum(counts)])
        edges = np.concatenate([[start], ends])
        return raw[4 * cum[np.searchsorted(edges, lo)] : 4 * cum[np.searchsorted(edges, hi)]]

    while first < len(chunks):
        last, current = first, chunks[first]
        while last + 1 < len(chunks) and (cut := shared(current, chunks[last + 1])) is None:
            last += 1
            while last + 1 < len(chunks) and shared(chunks[last], chunks[last + 1]) is None:
                last += 1
            texts = [a[1][: b[0] - a[0]] for a, b in zip(chunks[first:last], chunks[first + 1 : last + 1])]
            text = ("".join(texts) + chunks[last][1])[at - chunks[first][0] :]
            current = (at, text, *measured(codec, at, text))
        if last + 1 == len(chunks):
            out.append(upto(current, at, int(current[2][-1])))
            break
        out.append(upto(current, at, cut))
        at, first = cut, last + 1
    return b"".join(out)


def measured(codec: RankCodec, start: int, text: str) -> tuple[np.ndarray, np.ndarray, bytes]:
    found = codec.pretokens(text)
    ids = list(map(codec.match, found))
    return start + np.cumsum([len(p) for p in found], dtype=np.int64), np.array([len(x) // 4 for x in ids], np.int64), b"".join(ids)


def encode(docs: DataFrame, path: str, columns: tuple[str, ...] = ("n_tokens", "ids"), chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id and the chosen COLUMNS. Null text counts as empty, which has no ids.
    Repeated rows are encoded as often as they occur; other columns of docs are not looked at, whatever their names; an
    empty table gives an empty one. A text longer than a chunk and an overlap is encoded in chunks by different tasks; its
    ids then meet in one task, where they become one row."""
    if not 0 < overlap <= chunk:
        raise ValueError("chunks must overlap, and by no more than their own length")
    spark = docs.sparkSession
    schema = "doc_id long, " + ", ".join(f"{c} {COLUMNS[c][0]}" for c in columns)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def finished(codec, ids: pa.Array, raws: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, *(pa.array([COLUMNS[c][1](codec, r) for r in raws], ARROW[COLUMNS[c][0]]) for c in columns)], names=["doc_id", *columns])

    def short(batches):
        codec = codec_of(path)
        for batch in batches:
            for part in parts(batch, 1, 500):
                yield finished(codec, part.column(0), [codec.encode(t) for t in part.column(1).to_pylist()])

    def pieces(batches):
        codec = codec_of(path)
        for batch in batches:
            for part in parts(batch, 4, 200):
                start, text = part.column(3).to_pylist(), part.column(4).to_pylist()
                found = [measured(codec, s, t) for s, t in zip(start, text)]
                lengths = [np.diff(ends, prepend=s).astype("<u4").tobytes() for s, (ends, _, _) in zip(start, found)]
                counts = [c.astype("<u4").tobytes() for _, c, _ in found]
                # where both overlaps surely hold a shared boundary, the text has done its work; the neighbours see the same overlaps
                last = part.column(5).to_pylist()
                kept = [None if (not s or IN_STEP.search(t, 0, overlap)) and (z or IN_STEP.search(t, len(t) - overlap)) else t for s, t, z in zip(start, text, last)]
                made = [pa.array(kept, pa.string()), *(pa.array(x, pa.binary()) for x in (lengths, counts, [i for _, _, i in found]))]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(4)), *made], names=["row", "doc_id", "k", "start", "text", "lengths", "counts", "ids"])

    def joined(pdf):
        import pandas as pd

        codec = codec_of(path)
        pdf = pdf.sort_values("k")
        chunks = [(int(s), t, int(s) + np.cumsum(np.frombuffer(e, "<u4"), dtype=np.int64), np.frombuffer(c, "<u4").astype(np.int64), bytes(i)) for s, t, e, c, i in zip(pdf["start"], pdf["text"], pdf["lengths"], pdf["counts"], pdf["ids"])]
        raw = stitch(codec, chunks)
        # a nullable integer column comes as objects or floats; the arrow conversion takes either
        return pd.DataFrame({"doc_id": pdf["doc_id"].iloc[:1].reset_index(drop=True)} | {c: [COLUMNS[c][1](codec, raw)] for c in columns})

    limit = chunk + overlap
    whole = texts.where(F.length("text") <= limit).mapInArrow(short, schema)
    cut = (
        texts.where(F.length("text") > limit)
        .withColumn("row", F.monotonically_increasing_id())
        # the last chunk is the first that reaches the end: each is longer than an overlap
        .select("row", "doc_id", "text", F.posexplode(F.expr(f"sequence(0L, cast(length(text) - {overlap} - 1 as bigint), {chunk}L)")).alias("k", "start"))
        .withColumn("last", F.col("start") + limit >= F.length("text"))
        .select("row", "doc_id", "k", "start", F.col("text").substr(F.col("start").cast("int") + 1, F.lit(limit)).alias("text"), "last")
        .repartition(partitions(spark), "row", "k")
        .mapInArrow(pieces, "row long, doc_id long, k int, start long, text string, lengths binary, counts binary, ids binary")
        .groupBy("row")
        .applyInPandas(joined, schema)
    )
    return whole.unionByName(cut)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), ("n_tokens", "ids_sha256", "decoded_sha256"))
