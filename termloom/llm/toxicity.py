"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, invisible characters, homoglyphs, digits and signs that stand for letters; anything else
becomes a space) and matched with one Aho-Corasick automaton whose entries start at a word's start: whole words, stems that
any ending may follow, and exception phrases whose extent cancels what they cover. Weights are log-odds
learned from labelled rows alone, as are exception phrases beyond the given ones; the sum of weights is set against the
text's length, and a logistic curve fitted on the same rows turns both into a score.
"""

from __future__ import annotations

import math
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import discard, in_split, materialise, parts, table

#: Fixed values. Phrases in which an entry is harmless.
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "clown fish", "circus clown", "pond scum", "soap scum", "loser bracket", "sore loser rule")
#: Fixed values. What stands for a letter: digits and signs, then Cyrillic and Greek letters of the same shape.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
HOMOGLYPHS = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ο": "o", "ι": "i", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "κ": "k", "ε": "e", "ı": "i", "ɑ": "a", "ɡ": "g", "ԁ": "d", "һ": "h", "ӏ": "l"}
#: Fixed values. What can't be seen: marks above and below letters, soft hyphens, joiners, marks of direction and the like.
UNSEEN = (*range(0x300, 0x370), 0xAD, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF)

#: Labelled rows that a model is fitted on, at most; the rest of the labelled rows isn't looked at.
SAMPLE_ROWS = 20_000
STEMS = range(4, 9)


def _tables() -> tuple[bytes, dict[int, str]]:
    wide = {c: " " for c in (*range(0x80, 0xC0), *range(0x2000, 0x2070), *range(0x3000, 0x3040)) if c not in (0xAA, 0xB5, 0xBA)}
    wide |= {ord(k): v for k, v in HOMOGLYPHS.items()} | dict.fromkeys(UNSEEN)
    plain = [" "] * 128
    for c in range(26):
        plain[65 + c] = plain[97 + c] = chr(97 + c)
    for k, v in SUBSTITUTES.items():
        if k.isalnum() or k in "@$":
            plain[ord(k)] = v
    return "".join(plain).encode(), wide | dict(enumerate(plain))


ASCII, WIDE = _tables()
ASCII = ASCII + bytes(range(128, 256))


def fold(text: str | None) -> str:
    """Letters of one case without accents, words apart by spaces, a space at both ends. `!` and `|` inside a word stand for i."""
    if not text:
        return " "
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    if "!" in text or "|" in text:
        import re

        text = re.sub(r"(?<=[^\W\d_])[!|](?=[^\W\d_])", "i", text)
    if text.isascii():
        return " " + text.encode().translate(ASCII).decode() + " "
    return " " + text.lower().translate(WIDE) + " "


def term_sets(text: str) -> set[str]:
    """A text's folded words as " word " and their stems as " stem"."""
    words = {w for w in fold(text).split() if len(w) > 2}
    found = {f" {w} " for w in words}
    for n in STEMS:
        found.update(" " + w[:n] for w in words if len(w) >= n)
    return found


def has_entry(word: str, weights: dict[str, float]) -> bool:
    return f" {word} " in weights or any(f" {word[:n]}" in weights for n in STEMS if len(word) >= n)


class Matcher:
    """weights: entries as term_sets() writes them; those of weight 0 are exception phrases, too."""

    def __init__(self, weights: dict[str, float], exceptions=EXCEPTIONS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for entry, weight in weights.items():
            self.automaton.add_word(entry, (len(entry.strip()), weight, not weight))
        for phrase in exceptions:
            self.automaton.add_word(f" {phrase} ", (len(phrase), 0.0, True))
        if len(self.automaton):
            self.automaton.make_automaton()

    def measure(self, text: str | None) -> tuple[float, int, int]:
        """The sum of weights (of entries with the same start the heaviest counts), the number of words, of words matched."""
        folded = fold(text)
        if "  " in folded:
            folded = " " + " ".join(folded.split()) + " "
        n = 0 if folded.isspace() else folded.count(" ") - 1
        if not len(self.automaton) or not n:
            return 0.0, n, 0
        heaviest: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight, exception) in self.automaton.iter(folded):
            start = end - size + (folded[end] != " ")
            if exception:
                spared.append((start, end))
            elif weight > heaviest.get(start, 0.0):
                heaviest[start] = weight
        hits = [w for s, w in heaviest.items() if not any(a <= s < b for a, b in spared)]
        return float(sum(hits)), n, len(hits)


def features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Per row: 1, the sum's logarithm, and that of the sum for each 100 words."""
    return np.column_stack([np.ones(len(total)), np.log1p(total), np.log1p(100 * total / np.maximum(words, 20))])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 40) -> np.ndarray:
    """Newton's method on the log-loss with a ridge on all but the constant."""
    w, keep = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    keep[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        d = np.linalg.solve(h, x.T @ (y - p) - keep * w)
        w += np.clip(d, -4, 4)
        if np.abs(d).max() < 1e-6:
            break
    return w


#: Where there are no labels of both kinds: constant, weight of the sum and of its rate.
DEFAULT_CURVE = np.array([-4.0, 1.5, 1.0])


#: A term's log odds, log-likelihood ratio and share of positive texts at least; texts labelled 1 that hold it at least.
ODDS, SURE, SHARE, SEEN = 2.5, 11, 0.7, 4


def eligible(terms: DataFrame, positives: int, negatives: int) -> DataFrame:
    """The terms that choose() can take: its tests of a single term, a rounding error wider."""
    pos, neg, rate = F.col("pos"), F.col("neg"), positives / max(positives + negatives, 1)
    odds = F.log((pos + 0.5) / (positives + 1)) - F.log((neg + 0.5) / (negatives + 1))
    sure = pos * F.log(pos / (pos + neg) / max(rate, 1e-9)) + F.when(neg > 0, neg * F.log(neg / (pos + neg) / max(1 - rate, 1e-9))).otherwise(0.0)
    return terms.where((pos >= SEEN) & (odds >= ODDS - 1e-6) & (sure >= SURE - 1e-6) & (pos >= SHARE * (pos + neg) - 1e-6))


def choose(rows: list[tuple[str, int, int]], positives: int, negatives: int) -> dict[str, float]:
    """rows: term, texts labelled 1 and 0 that hold it. A stem is taken only where shorter ones don't do."""
    rate, chosen = positives / max(positives + negatives, 1), {}
    for term, pos, neg in sorted(rows, key=lambda r: (len(r[0].rstrip()), len(r[0]), r[0])):
        odds = math.log((pos + 0.5) / (positives + 1)) - math.log((neg + 0.5) / (negatives + 1))
        sure = pos * math.log((pos / (pos + neg)) / max(rate, 1e-9)) + (neg * math.log((neg / (pos + neg)) / max(1 - rate, 1e-9)) if neg else 0)
        if odds < ODDS or sure < SURE or pos < SHARE * (pos + neg):
            continue
        stem = term.rstrip()
        if any(stem[:k] in chosen and stem[:k] != stem for k in range(5, len(stem) + 1)) or (term != stem and stem in chosen):
            continue
        chosen[term] = min(odds, 8.0)
    return chosen


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, rows: int) -> DataFrame:
    """doc_id, y (0 or 1) and text of at most `rows` labelled ids outside the held-out split, the first in the order of a
    hash of the id. An id is one row: of several labels the greatest counts, of several texts the least."""
    wanted = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~in_split(F.col("doc_id"), modulus, held))
    wanted = wanted.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id")  # at most `rows` pairs of numbers
    return found.groupBy("doc_id", "y").agg(F.min("text").alias("text"))


def _counted(batches, found):
    """Texts labelled 1 and 0 in which found(text) names a term."""
    counts: dict[str, list[int]] = {}

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array([c[y] for c in counts.values()], pa.int64()) for y in (1, 0))], names=["term", "pos", "neg"])

    for batch in batches:
        for text, y in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()):
            for term in found(text):
                counts.setdefault(term, [0, 0])[y] += 1
            if len(counts) > 1_000_000:
                yield rows()
                counts.clear()
    yield rows()


TERMS = "term string, pos long, neg long"


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def neighbours_of(text: str | None, weights: dict[str, float]) -> set[str]:
    """Each pair of words one of which is an entry."""
    words = fold(text).split()
    here = [has_entry(w, weights) for w in words]
    return {f" {a} {b} " for a, b, x, y in zip(words, words[1:], here, here[1:]) if x or y}


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, rows: int = SAMPLE_ROWS) -> tuple[dict[str, float], np.ndarray]:
    """Entries' weights (0: an exception phrase) and the logistic curve. Without labels of both kinds nothing is known: there are
    no entries, and every text gets the curve's lowest score."""
    taken = materialise(sample(docs, labels, "toxic", modulus, held, rows), "toxicity-sample")

    def sketched(batches):  # near copies of a text count once: they'd make each of its words look telling
        for batch in batches:
            keys = []
            for text in batch.column(2).to_pylist():
                w = (text or "").encode().lower().split()
                keys.append(min((zlib.crc32(b" ".join(w[k : k + 3])) for k in range(max(len(w) - 2, 1))), default=0))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.int64())], names=["doc_id", "y", "key"])

    first = taken.select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text").mapInArrow(sketched, "doc_id long, y int, key long").groupBy("key", "y").agg(F.min("doc_id").alias("doc_id"))
    apart = materialise(taken.join(F.broadcast(first.select("doc_id")), "doc_id", "left_semi"), "toxicity-apart")  # at most `rows` numbers
    sizes = dict(apart.groupBy("y").count().collect())
    positives, negatives = sizes.get(1, 0), sizes.get(0, 0)
    try:
        if not positives or not negatives:
            return {}, DEFAULT_CURVE
        terms = _summed(apart.select("y", "text").mapInArrow(lambda batches: _counted(batches, term_sets), TERMS))
        weights = choose([tuple(r) for r in eligible(terms, positives, negatives).collect()], positives, negatives)
        around = _summed(apart.select("y", "text").mapInArrow(lambda batches: _counted(batches, lambda text: neighbours_of(text, weights)), TERMS))
        harmless = around.where((F.col("neg") >= SEEN) & (F.col("pos") * 20 <= F.col("neg"))).select("term").collect()
        weights = weights | {r.term: 0.0 for r in harmless}
        found = measure(taken.select(F.col("y").cast("long").alias("doc_id"), "text"), weights).select("doc_id", "total", "n_words").toPandas()
        found = found.sort_values(["doc_id", "total", "n_words"])
        return weights, logistic(features(found["total"].to_numpy(float), found["n_words"].to_numpy(float)), found["doc_id"].to_numpy(float))
    finally:
        discard(taken, apart)


def measure(docs: DataFrame, weights: dict[str, float], curve: np.ndarray = DEFAULT_CURVE) -> DataFrame:
    """doc_id, total (sum of weights), n_words, n_hits, score of each row. A null or empty text has no words and
    gets the curve's lowest score. Rows that repeat are scored as often as they occur, and alike; a null id stays; other
    columns are not looked at, whatever their names; an empty table gives an empty one. A very long text is matched whole, in one pass."""

    def run(batches):
        matcher = Matcher(weights)
        for batch in batches:
            for part in parts(batch, 1, 1000):
                total, words, hits = zip(*map(matcher.measure, part.column(1).to_pylist()))
                x = features(np.array(total), np.array(words, float))
                score = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.float64()), pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array(score)], names=["doc_id", "total", "n_words", "n_hits", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, total double, n_words long, n_hits long, score double")


def where(docs: DataFrame, weights: dict[str, float], curve: np.ndarray, keep) -> DataFrame:
    """The rows of docs, with all their columns, whose score passes keep (from an array of scores to booleans)."""
    at_text = docs.columns.index("text")

    def run(batches):
        matcher = Matcher(weights)
        for batch in batches:
            for part in parts(batch, at_text, 1000):
                total, words, _ = zip(*map(matcher.measure, part.column(at_text).to_pylist()))
                x = features(np.array(total), np.array(words, float))
                yield part.filter(pa.array(keep(1 / (1 + np.exp(-np.clip(x @ curve, -30, 30))))))

    return docs.mapInArrow(run, docs.schema)


def score(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, threshold: float = 0.7) -> DataFrame:
    """Fit on the labels, then per row of docs: doc_id, held_out, score, predicted, total, n_words, n_hits."""
    weights, curve = fit(docs, labels, modulus, held)
    found = measure(docs, weights, curve)
    return found.select("doc_id", in_split(F.col("doc_id"), modulus, held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "total", "n_words", "n_hits")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
