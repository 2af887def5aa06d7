import base64
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from termloom.llm import byte_bpe, packing
from termloom.llm.word_tokens import IdEncoder, ranked

ROWS = [(1, "The cat. Don't  stop\n\nhere "), (2, None), (3, ""), (4, "é漢字 <|endoftext|> \x00 ok"), (4, "é漢字 <|endoftext|> \x00 ok"), (5, "x" * 3000 + " " + "ab1 " * 900), (None, "no id"), (6, "  \n " * 500)]
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abéß漢ªŁ .,!?'1\n\n\t  \x1cs\x85\u3000\u0301"), max_size=40), max_size=6))
def test_id_encoder_equals_the_library(texts):
    e = test_id_encoder_equals_the_library.__dict__.setdefault("e", IdEncoder(P.path("byte_bpe_50k.json"), True))
    t = e.library
    assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_id_encoder_forgets_and_learns_again(plain):
    e = IdEncoder(P.path("byte_bpe_50k.json"), True, limit=5)
    texts = [None, "", " ", "a", "one two one", "two one two ", " led by a blank", "end\n", "three four five\tsix seven", "two  blanks", "x" * 5000 + " y", "\n" * 6000 + "z"]
    for _ in range(3):
        for batch in (texts, texts[::-1], ["one other"], []):
            assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(batch)] == [plain(t) for t in batch]


def test_packing(spark, plain):
    docs = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 as length", "'x' as bin")
    for capacity in (8, 1024):
        found = packing.pack_documents(docs, capacity, with_ids=True)
        rows = found.collect()
        by_doc, by_seq = {}, {}
        for r in rows:
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
            by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
            by_seq.setdefault(r.sequence_id, []).append(r)
        want = sorted((str(i), len(plain(t)) + 1) for i, t in ROWS)
        copies = {(i, len(plain(t)) + 1): sum(1 for row in ROWS if row == (i, t)) for i, t in ROWS}
        assert sorted((str(k[0]), k[1]) for k in by_doc for _ in range(copies[k])) == want
        for (i, n), parts in by_doc.items():
            text = next(t for j, t in ROWS if j == i and len(plain(t)) + 1 == n)
            seen = sorted({r.start: r.ids for r in parts}.items())
            assert np.frombuffer(b"".join(x for _, x in seen), "<u4").tolist() == plain(text) + [0]
            assert len(parts) == copies[i, n] * len(seen)
        for parts in by_seq.values():
            at = 0
            for r in sorted(parts, key=lambda r: r.offset):
                assert r.offset == at
                at += r.length
            assert at <= capacity
        full = packing.assemble(found, capacity).collect()
        assert all(len(r.ids) == 4 * (r.used if r.used & (r.used - 1) == 0 else capacity) for r in full) and len(full) == len(by_seq)
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_reaches_the_bound():
    rng = np.random.default_rng(5)
    sizes, n = np.unique(rng.integers(1, 257, 5000), return_counts=True)
    counts = dict(zip(sizes.tolist(), n.tolist()))
    rows = packing.plan(counts, 256)
    used = 1 + max(r[3] + (r[2] - r[1] - 1) // r[4] for r in rows)
    bound = sum(k * v for k, v in counts.items()) / 256
    assert bound <= used <= bound * 1.01 + 2
    for size, n in counts.items():
        ranges = sorted((r[1], r[2]) for r in rows if r[0] == size)
        assert ranges[0][0] == 0 and ranges[-1][1] == n and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_byte_bpe(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'y' as k", "2 as row")
    want = sorted((str(i), len(x := e.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ROWS)
    for chunk, overlap in ((64, 16), (7, 3), (100_000, 10)):
        rows = byte_bpe.encode(docs, path, ("n_tokens", "ids_sha256", "decoded_sha256"), chunk, overlap).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert byte_bpe.encode(spark.createDataFrame([], SCHEMA), path).count() == 0


def test_chunks_of_real_size_equal_tiktoken():
    """Texts that end inside an overlap or a run without boundaries, and runs that many chunks lie in."""
    path = P.path("byte_bpe_multi_50k.tiktoken")
    codec, size, overlap = byte_bpe.codec_of(path), byte_bpe.CHUNK, byte_bpe.OVERLAP
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def by_chunks(text):
        chunks = []
        for s in range(0, max(len(text) - overlap, 1), size):
            x = text[s : s + size + overlap]
            needed = s and not byte_bpe.IN_STEP.search(x, 0, overlap) or s + len(x) < len(text) and not byte_bpe.IN_STEP.search(x, len(x) - overlap)
            chunks.append((s, x if needed else None, *byte_bpe.measured(codec, s, x)))
        return byte_bpe.stitch(codec, chunks)

    texts = ["word " * 6540 + "a" * 300, "a" * 120_000, ("ab " * 9000) + "=" * 40_000 + " x" * 9000]
    for tail in ("a", "=", "\n", "1", " ", "'re", "x  "):
        for extra in (0, 1, 2, overlap // 2, overlap - 1, overlap, overlap + 1):
            texts.append(("word " * 7000)[: 2 * size - 100] + (tail * 2000)[: 100 + extra])
    for text in texts:
        assert np.frombuffer(by_chunks(text), "<u4").tolist() == e.encode_ordinary(text)


def test_long_texts_through_spark(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    texts = ["word " * 6540 + "a" * 300, "word " * 6540 + "\n" * 300, "é" * 50_000]
    got = byte_bpe.encode(spark.createDataFrame(list(enumerate(texts)), SCHEMA), path, ("n_tokens", "decoded_sha256")).collect()
    assert {r.doc_id: r.decoded_sha256 for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts)}


def test_which_files_ids_may_rank(tmp_path):
    assert ranked(P.path("byte_bpe_50k.json")) and not ranked(P.path("word_bpe_49k.json"))
    file = json.load(open(P.path("byte_bpe_50k.json")))
    swapped = dict(file, model=dict(file["model"], merges=[file["model"]["merges"][1], file["model"]["merges"][0], *file["model"]["merges"][2:]]))
    for k, other in enumerate((swapped, dict(file, normalizer={"type": "NFC"}))):
        (tmp_path / f"{k}.json").write_text(json.dumps(other))
        assert not ranked(str(tmp_path / f"{k}.json"))
    slow = IdEncoder(str(tmp_path / "1.json"), False)
    assert slow.encode(["a  b ", None]) == [np.array(slow.library.encode("a  b ", add_special_tokens=False).ids, "<u4").tobytes(), b""]
