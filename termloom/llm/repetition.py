"""Quality rules by repetition coverage.

Words become numbers; polynomial rolling hashes over several n-gram lengths find n-grams that occur more
than once in a text, and the share of the text's characters inside them, in all copies, (and inside lines that repeat an
earlier line) is held against a limit for each length. Wherever two hashes agree the words themselves are
compared; should they differ, n-grams of that length are told apart by their words alone. So coverage is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import parts, table

#: Greatest share of the characters of words that n-grams of a length which occur twice or more may hold, the first copy
#: included: below the base rule's half of all words, and less for longer n-grams.
LIMITS = {5: 0.45, 6: 0.42, 7: 0.39, 8: 0.36, 9: 0.33, 10: 0.30}
#: The same for all copies of the most frequent n-gram alone (it must occur at least three times to count).
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
#: Greatest shares of lines that equal an earlier line, and of the characters in them.
LINE_LIMITS = (0.50, 0.30)
SYMBOLS = b"#*$%&|<>"
MIX = np.uint64(0x9E3779B97F4A7C15)


def roll(ids: np.ndarray, n: int, hashes: dict[int, np.ndarray]) -> np.ndarray:
    """Hashes of the n-grams at each position, from those of n - 1: h * base + next, modulo 2 ** 64."""
    if n not in hashes:
        shorter = roll(ids, n - 1, hashes)
        hashes[n] = shorter[:-1] * MIX + (ids[n - 1 :] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return hashes[n]


def groups(ids: np.ndarray, n: int, hashes: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each position, the number of its n-gram's group and how often it occurs."""

    def grouped(h):
        order = np.argsort(h, kind="stable")
        fresh = np.concatenate([[True], h[order[1:]] != h[order[:-1]]])
        return order, fresh

    order, fresh = grouped(roll(ids, n, hashes))
    one, other = order[:-1][~fresh[1:]], order[1:][~fresh[1:]]
    if any((ids[one + k] != ids[other + k]).any() for k in range(n)):  # a collision: number them by their words
        exact = np.unique(np.lib.stride_tricks.sliding_window_view(ids, n), axis=0, return_inverse=True)[1].ravel()
        order, fresh = grouped(exact)
    edge = np.flatnonzero(fresh)
    sizes = np.diff(np.append(edge, len(order)))
    name, times = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
    name[order], times[order] = np.repeat(np.arange(len(edge)), sizes), np.repeat(sizes, sizes)
    return name, times


def covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of `total` words lie in an n-gram that starts at one of `at`."""
    delta = np.zeros(total + 1, np.int64)
    np.add.at(delta, at, 1)
    np.add.at(delta, at + n, -1)
    return np.cumsum(delta[:-1]) > 0


NONE = {"n_words": 0, "word_chars": 0, "n_symbols": 0, "n_dup_lines": 0, "n_repeat_words": 0, "dup_line_frac": 0.0, "dup_line_char_frac": 0.0, **{f"dup_{n}": 0.0 for n in LIMITS}, **{f"top_{n}": 0.0 for n in TOP_LIMITS}}


def measure(text: str | None) -> dict[str, float]:
    """The rules' figures of one text. A null text, or one without words, has zeros only (and its symbols: none)."""
    out = dict(NONE)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes.split() splits at space and \x09-\x0d alone
    n = len(words)
    if not n:
        return out
    out["n_words"] = n
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    ascii_only = len(raw) == len(text)
    sizes = np.array([len(w) for w in number] if ascii_only else [len(w.decode("utf-8", "surrogatepass")) for w in number], np.int64)
    chars = sizes[ids.astype(np.int64)]
    total = int(chars.sum())
    out["word_chars"] = total
    out["n_symbols"] = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = dup_lines = line_chars = dup_chars = 0
    for line in raw.split(b"\n"):
        if line.strip(b" \t\n\r\x0b\x0c"):
            lines += 1
            line_chars += len(line)
            if line in seen:
                dup_lines += 1
                dup_chars += len(line)
            seen.add(line)
    out["n_dup_lines"] = dup_lines
    out["dup_line_frac"], out["dup_line_char_frac"] = dup_lines / lines, dup_chars / line_chars
    hashes = {1: (ids + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)}
    for k in (3, 2, 4, *LIMITS):  # a longer n-gram that occurs twice holds three words that do
        if n < k or (k > 3 and not out["n_repeat_words"]):
            continue
        name, times = groups(ids, k, hashes)
        at = np.flatnonzero(times > 1)
        if k == 3 and len(at):
            out["n_repeat_words"] = int(covered(at, 3, n).sum())
        if k in TOP_LIMITS and (most := int(times.max())) >= 3:
            first = np.flatnonzero(times == most)
            out[f"top_{k}"] = int(chars[covered(first[name[first] == name[first[0]]], k, n)].sum()) / total
        if k in LIMITS:
            if not len(at):
                break  # nothing longer occurs twice
            out[f"dup_{k}"] = int(chars[covered(at, k, n)].sum()) / total
    return out


def verdict(x: dict[str, float]) -> bool:
    """False where a share exceeds its limit."""
    return (
        x["dup_line_frac"] <= LINE_LIMITS[0]
        and x["dup_line_char_frac"] <= LINE_LIMITS[1]
        and all(x[f"dup_{n}"] <= limit for n, limit in LIMITS.items())
        and all(x[f"top_{n}"] <= limit for n, limit in TOP_LIMITS.items())
    )


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = tuple(k for k in NONE if k not in COUNTS)


def rules(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """One row per row of docs: doc_id, counts, shares, base_failed and kept. A null or empty text has no words
    and fails the base rule. Repeated rows are judged as often as they occur; a null id stays; other columns are not looked
    at, whatever their names; an empty table gives an empty one. A very long text is measured whole, in one task: it
    needs some 150 bytes of memory a word. Of several most frequent n-grams the one that comes first counts."""
    names = [*COUNTS, *SHARES]
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{c} double" for c in SHARES) + ", base_failed boolean, kept boolean"

    def run(batches):
        for batch in batches:
            for part in parts(batch, 1, 1000):
                found = [measure(t) for t in part.column(1).to_pylist()]
                failed = [x["n_words"] < min_words or 100 * x["n_repeat_words"] > max_repeat_percent * x["n_words"] for x in found]
                kept = [not f and verdict(x) for f, x in zip(failed, found)]
                columns = [pa.array([x[c] for x in found], pa.int64() if c in COUNTS else pa.float64()) for c in names]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns, pa.array(failed), pa.array(kept)], names=["doc_id", *names, "base_failed", "kept"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(table(spark, sf_dir, "documents"))
