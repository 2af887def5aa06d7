"""Ids of a byte-level vocabulary file of the tokenizers library.

The file is read with that library. Where the vocabulary's own rules make both give the same ids (see
ranked()), texts are encoded by tiktoken from the same vocabulary in a quarter of the time; any other file is
encoded by the tokenizers library itself.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Runs of white space that a backtracking pattern may give up on.
LONG_RUN = re.compile(r"\s{5000}")
#: White space as the pre-tokeniser's pattern has it.
SPACE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: A run of white space and what follows it. A pre-token ends wherever a character that is no white space stands before
#: one that is, and what lies between two such places is pre-tokenised as in the whole text.
PIECES = re.compile(f"[{SPACE}]*[^{SPACE}]+")
#: A blank that doesn't begin its run of white space (no pre-token need end before it), or a longer run.
UNEVEN = f"[{SPACE}] |[{SPACE}]{{3}}"


def pieces(text: str) -> list[str]:
    bare = text.rstrip(SPACE)
    found = PIECES.findall(bare)
    if len(bare) < len(text):
        found.append(text[len(bare) :])
    return found


def byte_of() -> dict[str, int]:
    """The characters by which such a vocabulary shows bytes: printable ones themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


@functools.lru_cache(8)
def ranked(path: str) -> bool:
    """Whether ids may serve as ranks. So it is if texts are pre-tokenised by the byte-level pattern alone (no normaliser, no
    space put in front), merges are plain and their products' ids ascend, and the library encodes every token's own bytes
    as that token. Then, when a pair of neighbours is the one of least id, all merges of less rank inside its span are
    done, as they are when the token is encoded alone; so the pair is the one that the token's merge names, and
    both libraries merge the same pairs in the same order."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, before = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    level = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    if not plain or not level or file.get("normalizer"):
        return False
    vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    products = [vocab.get(a + b, -1) for a, b in merges]
    special = {t["content"] for t in file.get("added_tokens", ())}
    table = byte_of()
    tokens = [t for t in vocab if t not in special]
    if any(a >= b for a, b in zip(products, products[1:])) or not all(c in vocab for c in table) or any(c not in table for t in tokens for c in t):
        return False
    if set(tokens) != set(table) | {a + b for a, b in merges} or min(products, default=0) < max(vocab[c] for c in table):
        return False
    from tokenizers.models import BPE

    bare = BPE(vocab=vocab, merges=merges)  # without a pre-tokeniser, which would cut some tokens' texts
    return all([x.id for x in bare.tokenize(t)] == [vocab[t]] for t in tokens)


@functools.lru_cache(4)
def _ranks(path: str):
    import public_tokenizers
    import tiktoken

    tokenizer, table = _library(path), byte_of()
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    ranks = {bytes(map(table.__getitem__, t)): i for t, i in tokenizer.get_vocab().items() if t not in special}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = list(map(len, ranks))
    return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary, sizes


class Kept(dict):
    """The ids of short pieces, as many as `limit`."""

    def __init__(self, encode, limit: int, longest: int):
        self.encode, self.limit, self.longest = encode, limit, longest

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        found = self.encode(piece)
        if len(piece) <= self.longest:
            self[piece] = found
        return found


class Numbered:
    """Pieces behind a blank, numbered in the order of their first occurrence, and their ids in one array. Beyond `limit`
    pieces or `most` bytes all are forgotten before the next texts."""

    def __init__(self, ids, piece, byte_sizes: np.ndarray, limit: int, most: int = 32_000_000):
        self.ids, self.piece, self.byte_sizes, self.limit, self.most = ids, piece, byte_sizes, limit, most
        self.forget()

    def forget(self) -> None:
        self.keys, self.size, self.pool = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def numbers(self, found: pa.Array) -> np.ndarray:
        if len(self.keys) > self.limit or self.keys.nbytes > self.most:
            self.forget()
        which = pc.index_in(found, value_set=self.keys)
        if which.null_count:
            missing = pc.unique(found.filter(pc.is_null(which)))
            open_end = pc.match_substring_regex(missing, f"(^|[{SPACE}])\\z")
            for some, by_one in ((missing.filter(pc.invert(open_end)), False), (missing.filter(open_end), True)):
                if len(some):
                    self._learn(some, by_one)
            which = pc.index_in(found, value_set=self.keys)
        return which.to_numpy(zero_copy_only=False).astype(np.int64)

    def _learn(self, some: pa.Array, by_one: bool) -> None:
        """Encodes pieces; those that end in no white space as one text, whose ids are cut where the pieces end."""
        if by_one:
            parts = [np.frombuffer(self.piece(" " + x), "<u4") for x in some.to_pylist()]
            new, size = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        else:
            text = " " + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), " ")[0].as_py()
            new = np.array(self.ids(text), np.uint32)
            ends = np.cumsum(pc.binary_length(some).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            upto = np.searchsorted(np.cumsum(self.byte_sizes[new]), ends) + 1
            size = np.diff(upto, prepend=0)
        self.keys = pa.concat_arrays([self.keys, some])
        self.size, self.pool = np.concatenate([self.size, size]), np.concatenate([self.pool, new])


class IdEncoder:
    """texts -> bytes of little-endian unsigned 32-bit ids. A null text counts as empty; strings of special
    tokens in a text are ordinary text. by_ranks: what ranked() says of the file. Ids of short pieces are kept."""

    def __init__(self, path: str, by_ranks: bool, limit: int = 300_000, longest: int = 32):
        self.path, self.by_ranks = path, by_ranks
        self.ids, sizes = _ranks(path) if by_ranks else (self._by_library, None)
        self.get = Kept(self._piece, limit, longest).__getitem__
        self.numbered = Numbered(self.ids, self._piece, sizes, limit)

    @functools.cached_property
    def library(self):
        return _library(self.path)

    def _by_library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> bytes:
        if len(piece) > 5000 and LONG_RUN.search(piece):
            return array("I", self._by_library(piece)).tobytes()
        return array("I", self.ids(piece)).tobytes()

    def one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_ranks:
            return array("I", self._by_library(text)).tobytes()
        return b"".join(map(self.get, pieces(text)))

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """All texts at once: cut before blanks, new pieces encoded together, ids gathered by the pieces' numbers.
        Texts with an uneven run of white space are encoded one by one."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if not self.by_ranks or not len(texts):
            return list(map(self.one, texts.to_pylist()))
        texts = pc.fill_null(texts.cast(pa.string()), "")
        alone = pc.match_substring_regex(texts, UNEVEN)
        cut = pc.split_pattern(pc.if_else(alone, "", texts), " ")
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False), dtype=np.int64)
        first, found = np.concatenate([[0], ends[:-1]]), cut.flatten()
        heads = [self.get(x) if x else b"" for x in found.take(pa.array(first)).to_pylist()]
        which = self.numbered.numbers(found)
        behind = self.numbered
        size = np.concatenate([behind.size, np.fromiter(map(len, heads), np.int64, len(heads)) // 4])
        start, pool = np.cumsum(size) - size, np.concatenate([behind.pool, np.frombuffer(b"".join(heads), "<u4")])
        which[first] = np.arange(len(behind.size), len(size))
        sizes = size.take(which)
        upto = np.cumsum(sizes)
        shift = start.take(which)
        shift -= upto - sizes
        where = np.repeat(shift, sizes)
        where += np.arange(len(where))
        every = memoryview(pool.take(where)).cast("B")
        at = [0, *(4 * upto[ends - 1]).tolist()]
        out = [every[a:b].tobytes() for a, b in zip(at, at[1:])]
        for k in np.flatnonzero(alone.to_numpy(zero_copy_only=False)).tolist():
            out[k] = self.one(texts[k].as_py())
        return out


@functools.lru_cache(2)
def encoder(path: str, by_ranks: bool) -> IdEncoder:
    """One for each Python worker, with what it has kept."""
    return IdEncoder(path, by_ranks)
