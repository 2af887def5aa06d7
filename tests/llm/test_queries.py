"""The registered queries over a whole table against brute force."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from termloom.llm import registry
from termloom.llm.common import table

from .test_near_dups import brute as near_brute
from .test_repetition import brute as repetition_brute


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return {d: t.encode(x or "", add_special_tokens=False).ids for d, x in texts.items()}


def crc(found):
    return zlib.crc32(np.array(found, "<u4").tobytes())


def test_packing(spark, sf, ids):
    pieces, sequences = {}, {}
    for r in registry.QUERIES["op1_packing"](spark, sf).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for d, some in pieces.items():
        whole, at = [*ids[d], 0], 0
        for r in sorted(some, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(whole), crc(whole[at : at + r.length]))
            at += r.length
        assert at == len(whole)
    total = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
        total += at if at & (at - 1) == 0 else 1024
    assert total <= 1.02 * sum(len(x) + 1 for x in ids.values()) + 4096


def test_byte_bpe(spark, sf, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in registry.QUERIES["op3_byte_bpe"](spark, sf).collect()}
    assert set(got) == set(texts)
    for d, text in texts.items():
        x = e.encode_ordinary(text or "")
        assert got[d] == (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_repetition(spark, sf, texts):
    got = registry.QUERIES["op5_repetition"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        counts, dup = repetition_brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert all(abs(r[f"dup_{k}"] - v) < 1e-12 for k, v in dup.items() if counts[0])
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and not (r.base_failed and r.kept)


def test_token_files(spark, sf, ids):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in registry.QUERIES["op6_token_files"](spark, sf).collect()}
    at = 0
    for d in sorted(ids):
        whole = [*ids[d], 2]
        assert got.pop(d) == (at, len(whole), crc(whole))
        at += len(whole)
    assert not got


def test_near_dups(spark, sf, texts):
    got = sorted(map(tuple, registry.QUERIES["op8_near_dups"](spark, sf).collect()), key=str)
    assert got == near_brute(list(texts.items()), 3, 85)
