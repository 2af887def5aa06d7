import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from termloom.llm import token_files as f
from termloom.llm.common import scratch


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9) | st.integers(0, 65535), max_size=400), max_size=6), st.sampled_from([None, 1, 7, 64]))
def test_round_trip(docs, block):
    raws = [np.array(d, "<u4").tobytes() for d in docs]
    ids = [None if k == 1 else k - 3 for k in range(len(docs))]
    assert f.unpack_file(f.pack_file(ids, raws, block)) == (ids, raws)


def test_damage_is_seen():
    data = bytearray(f.pack_file([1], [np.arange(3000, dtype="<u4").tobytes()], 256))
    for at in (0, 30, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            f.unpack_file(bytes(bad))
    with pytest.raises(ValueError):
        f.pack_file([1], [np.array([1 << 16], "<u4").tobytes()])


def test_it_compresses():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.zipf(1.3, 60_000), 50_000)
    ids[30_000:] = np.tile(ids[:300], 100)
    data = f.pack_file([0], [ids.astype("<u4").tobytes()])
    assert len(data) < 60_000 * 2 * 0.6


def test_files(spark):
    rows = [(5, "five five five"), (-2, None), (3, "é three\n" * 4000), (3, "again"), (None, ""), (9, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "2 as seq")
    path = scratch(spark, "test-files")
    f.write(docs, path, P.path("byte_bpe_50k.json"), file_tokens=1000)
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    got = f.read(spark, path, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -2, 3, 3, 5, 9]
    at = 0
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert any(d == r.doc_id and t.encode(x or "", add_special_tokens=False).ids + [2] == ids for d, x in rows)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(r.ids))
        at += len(ids)
    path = scratch(spark, "test-files")
    f.write(docs.limit(0), path, P.path("byte_bpe_50k.json"))
    assert f.read(spark, path).count() == 0
