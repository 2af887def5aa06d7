"""Secret scans with built-in DataFrame functions alone.

Three kinds of secret are regular expressions. A fourth is a test on what looks like an identifier, outside of what these
have found: two character Markov models, of random strings and of ordinary identifiers, trained from labelled samples,
are compared by their log-likelihood ratio. Positions come from what lies between the matches; nothing is shuffled.

Matches are folded in blocks, and pieces of a text are cut from blocks of it, so that cost grows with a text's length and
its number of matches, not with their product.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table

#: The base kinds in their order, their patterns, and how many characters make a secret (in group `of`).
BASE = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: What a text must hold for a kind to be looked for, in lower case; None: nothing.
HINTS = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",), "hex": None}
#: The kinds whose failing matches may as well not match: a shorter run ends where a longer one would, too.
AT_LEAST = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}

KIND = "markov"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
#: Nats a transition by which random must be likelier than ordinary.
MARGIN = 0.35

#: Words of ordinary identifiers.
WORDS = (
    "get set is has new old add del max min num row col key val map list item node file path name type size count index time date user group role page "
    "text line word char byte data base table query result value error message request response server client config option param default version update "
    "create delete insert select order limit offset start end first last next prev parent child root leaf left right top bottom width height color image "
    "button label input output stream buffer reader writer parser handler manager factory service controller model view event listener state store action "
    "reducer context provider session cache queue stack thread process worker task job batch test mock check verify validate format convert encode decode "
    "transaction account number customer product category description address street country payment invoice report summary total average"
).split()


def samples(n: int = 3000, seed: int = 20) -> list[tuple[str, int]]:
    """Labelled strings: 1 random, 0 ordinary. Made by rule: random ones over the sets that keys are written in,
    ordinary ones from WORDS in the usual ways of joining them, and runs of one character."""
    rng, out = random.Random(seed), []
    sets = (ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[:62] + "_-")
    for k in range(n):
        chars = sets[k % len(sets)]
        out.append(("".join(rng.choice(chars) for _ in range(rng.randrange(20, 65))), 1))
        words = [rng.choice(WORDS) for _ in range(rng.randrange(3, 8))]
        number = str(rng.randrange(1, 2000)) if rng.random() < 0.4 else ""
        style = k % 6
        if style == 0:
            name = words[0] + "".join(w.title() for w in words[1:])
        elif style == 5:
            name = "".join(words)
        else:
            name = ("_", "-", "/", "_")[style - 1].join(w.upper() if style == 4 else w for w in words)
        out.append((name + number, 0))
        if k % 8 == 0:
            out.append((ALPHABET[k // 8 % len(ALPHABET)] * rng.randrange(20, 65), 0))
    return out


def train(labelled: list[tuple[str, int]]) -> list[list[float]]:
    """Log-likelihood ratios of transitions, by the places of two characters in ALPHABET (add-half smoothing)."""
    n = len(ALPHABET)
    counts = [[[0.5] * n for _ in range(n)] for _ in range(2)]
    for text, label in labelled:
        at = [ALPHABET.find(c) for c in text]
        for a, b in zip(at, at[1:]):
            if a >= 0 and b >= 0:
                counts[label][a][b] += 1
    totals = [[sum(row) for row in c] for c in counts]
    return [[math.log(counts[1][a][b] / totals[1][a]) - math.log(counts[0][a][b] / totals[0][a]) for b in range(n)] for a in range(n)]


def coded(ratios: list[list[float]]) -> list[str]:
    """Ratios in twentieths between -2.5 and 2, as characters from `!` on."""
    return ["".join(chr(33 + round(20 * (min(2.0, max(-2.5, x)) + 2.5))) for x in row) for row in ratios]


def ratio(text: Column, rows: list[str]) -> Column:
    """Mean log-likelihood ratio of a string's transitions."""
    lines = F.array(*[F.lit(r) for r in rows])
    chars = F.split(text, "")

    def one(a, b):
        place = F.instr(F.lit(ALPHABET), a)
        return F.ascii(F.element_at(lines, place).substr(F.instr(F.lit(ALPHABET), b), F.lit(1)))

    pairs = F.zip_with(F.slice(chars, 1, F.length(text) - 1), F.slice(chars, 2, F.length(text) - 1), one)
    total = F.aggregate(pairs, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return (total / (F.length(text) - 1) - F.lit(33)) / F.lit(20.0) - F.lit(2.5)


SPANS = "array<struct<start:bigint,rank:int,stop:bigint,kind:string>>"
#: Matches folded at a time, and characters of a text's blocks.
FOLD, PIECE = 512, 1024


def _none() -> Column:
    return F.array().cast(SPANS)


def _once(value: Column, use) -> Column:
    """use(value), with value computed once, however often and in whatever lambda it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _folded(rows: Column, kind: str, step) -> Column:
    """What step collects from rows in order. step: (at, x) -> (the next `at`, an array of what it adds). The collected array
    is copied once for each block of rows, not for each row."""
    blocks = _once(rows, lambda r: F.transform(F.sequence(F.lit(0), F.greatest(F.size(r) - 1, F.lit(0)), F.lit(FOLD)), lambda at: F.slice(r, at + 1, FOLD)))

    def start(at):
        return F.struct(at.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    def one(acc, x):
        at, more = step(acc["at"], x)
        return F.struct(at.cast("long").alias("at"), F.concat(acc["out"], more).alias("out"))

    def block(acc, some):
        return F.aggregate(some, start(acc["at"]), one, lambda own: F.struct(own["at"].alias("at"), F.concat(acc["out"], own["out"]).alias("out")))

    return F.aggregate(blocks, start(F.lit(0).cast("long")), block, lambda acc: acc["out"])


def _found(kind: str, rank: int, text: Column, pattern: str, group: int, least: int, keep=None) -> Column:
    """The spans of a kind's matches in order. keep: a further test of the match."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(F.split(text, pattern, -1), matches, inner)  # fields 0, 1 and 2; what follows the last match has no match

    def step(at, x):
        match = x.getField("1")
        begin = at + F.length(x.getField("0"))
        stop = begin + F.length(match)
        good = match.isNotNull() & (F.length(x.getField("2")) >= least)
        if keep is not None:
            good = good & keep(match)
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"))
        return F.coalesce(stop, at), F.when(good, F.array(span)).otherwise(_none())

    return _folded(zipped, SPANS[6:-1], step)


def _replaced(text: Column, spans: Column, mark) -> Column:
    """text with each run of spans (in order; overlapping ones are one) replaced. mark: the number of its characters -> text."""

    def piece(blocks, a, b):
        first, last = (a / PIECE).cast("int"), (b / PIECE).cast("int")
        some = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        return F.when(b > a, some.substr((a - first * PIECE + 1).cast("int"), (b - a).cast("int"))).otherwise("")

    def step(blocks):
        def one(at, s):
            stop = F.greatest(at, s["stop"])
            fresh = F.array(piece(blocks, at, s["start"]), mark(stop - s["start"]))
            return stop, F.when(s["start"] >= at, fresh).when(stop > at, F.array(mark(stop - at, True))).otherwise(F.array().cast("array<string>"))

        return one

    ends = F.struct(F.length(text).cast("long").alias("start"), F.lit(0).alias("rank"), F.length(text).cast("long").alias("stop"), F.lit("").alias("kind"))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.array_join(_once(blocks, lambda b: _folded(F.concat(spans, F.array(ends)), "string", step(b))), "")


def spans(docs: DataFrame, labelled: list[tuple[str, int]] | None = None, margin: float = MARGIN, text_col: str = "text", names: tuple[str, str] = ("base_spans", "spans")) -> DataFrame:
    """docs with two columns added (they replace columns of these names): arrays of start, rank, stop (code points, end
    exclusive), kind, in the order of start and rank. The first holds the base spans, the second all spans.

    Spans of kind markov are candidates that the models call random. What base spans cover is no part of a candidate: a key
    that touches one is scored by what is left of it. A null or empty text has no spans. Nothing depends on other rows, so
    that repeated rows, any doc_id and an empty table are fine. A very long text is one row of one task."""
    rows = coded(train(labelled or samples()))
    text, low = F.col("scan text"), F.col("scan low")
    out = docs.withColumn("scan text", F.coalesce(text_col, F.lit("")))
    out = out.withColumn("scan low", F.lower("scan text"))
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        pattern, wanted = AT_LEAST.get(kind, pattern), F.lit(True)
        if HINTS[kind]:
            wanted = F.lit(False)
            for hint in HINTS[kind]:
                wanted = wanted | low.contains(hint)
        wanted = wanted & text.rlike(pattern)
        out = out.withColumn(f"scan {kind}", F.when(wanted, _found(kind, rank, text, pattern, group, least)).otherwise(_none()))
    out = out.withColumn("scan base", F.array_sort(F.concat(*[F.col(f"scan {k}") for k, *_ in BASE])))
    blank = _replaced(text, F.col("scan base"), lambda n, more=False: F.repeat(F.lit(" "), n.cast("int")))
    out = out.withColumn("scan rest", F.when(~text.rlike(CANDIDATE), F.lit("")).when(F.size("scan base") > 0, blank).otherwise(text))
    rest = F.col("scan rest")
    found = _found(KIND, len(BASE), rest, CANDIDATE, 0, 20, lambda m: ratio(m, rows) >= margin)
    out = out.withColumn("scan found", F.when(rest.rlike(CANDIDATE), found).otherwise(_none()))
    base, every = F.col("scan base"), F.array_sort(F.concat("scan base", "scan found"))
    return out.withColumns({names[0]: base, names[1]: every}).drop("scan text", "scan low", "scan base", "scan rest", "scan found", *[f"scan {k}" for k, *_ in BASE])


def joined(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(docs: DataFrame, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """docs with every span in the text replaced by the mark (spans that overlap by one); same columns. A null text stays null."""
    found = spans(docs, text_col=text_col, names=("secret base", "secret spans"))
    text = _replaced(F.col(text_col), F.col("secret spans"), lambda n, more=False: F.lit("") if more else F.when(n > 0, mark).otherwise(""))
    return found.withColumn(text_col, F.when(F.size("secret spans") > 0, text).otherwise(F.col(text_col))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k, *_ in BASE]
    return found.select("doc_id", *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"))
