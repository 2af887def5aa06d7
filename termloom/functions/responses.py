"""Model replies: JSON that may be wrapped in prose, learned patterns, token counts, and the responder interface."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

_FENCES = (re.compile(r"```json\s*(.*?)```", re.S), re.compile(r"```\s*(.*?)```", re.S))


def _balanced(text: str, opening: str, closing: str) -> str | None:
    """The first piece from an opening mark to the mark that closes it; marks inside strings count, too."""
    at = text.find(opening)
    if at < 0:
        return None
    depth = 0
    for m in re.compile(f"[{re.escape(opening + closing)}]").finditer(text, at):
        depth += 1 if m[0] == opening else -1
        if not depth:
            return text[at : m.end()]
    return None


def tolerant_json(reply: str | None) -> str | None:
    """The JSON in a reply, canonically written; null if nothing parses. Tried in turn: a json fence, any fence, the
    whole, the first balanced object, the first balanced list, the object again without trailing commas."""

    def candidates() -> Iterator[str | None]:
        for fence in _FENCES:
            yield m[1] if (m := fence.search(reply)) else None
        yield reply
        yield _balanced(reply, "{", "}")
        yield _balanced(reply, "[", "]")
        yield _balanced(re.sub(r",\s*([}\]])", r"\1", reply), "{", "}")

    for piece in candidates() if reply else ():
        if piece is None:
            continue
        try:
            return json.dumps(json.loads(piece.strip()), ensure_ascii=False)
        except ValueError:
            continue
    return None


@F.pandas_udf(T.StringType())
def extract_json(replies: pd.Series) -> pd.Series:
    return replies.map(tolerant_json)


def usable_pattern(pattern: str | None) -> str | None:
    """A learned pattern as Python compiles it (named groups of the form (?<name> become plain); null if it doesn't."""
    try:
        cleaned = re.sub(r"\(\?<[A-Za-z_]\w*>", "(", pattern)
        re.compile(cleaned)
        return cleaned
    except (re.error, TypeError):
        return None


@F.pandas_udf(T.StringType())
def sanitize_pattern(patterns: pd.Series) -> pd.Series:
    return patterns.map(usable_pattern)


@F.pandas_udf(T.StructType([T.StructField("pattern", T.IntegerType()), T.StructField("prompt", T.StringType())]))
def first_match(lines: pd.Series, patterns: pd.Series) -> pd.DataFrame:
    """The first of a list of patterns that matches at a line's start, and what it matches; nulls if none does."""
    compiled: dict[str, re.Pattern | None] = {}
    rows = []
    for line, many in zip(lines, patterns):
        found = (None, None)
        for k, p in enumerate(many if many is not None else ()):
            if p not in compiled:
                good = usable_pattern(p)
                compiled[p] = re.compile(good) if good is not None else None
            if line is not None and compiled[p] and (m := compiled[p].match(line)):
                found = (k, m[0])
                break
        rows.append(found)
    return pd.DataFrame(rows, columns=["pattern", "prompt"]).astype({"pattern": "Int32"})


def whitespace_tokens(c: Column | str) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda x: x != ""))


def count_tokens(c: Column | str, load: Callable[[], Callable[[str], list]] | None = None) -> Column:
    """Tokens of a text: by white space, or by the encoder that load() makes (once in each Python worker)."""
    if load is None:
        return whitespace_tokens(c)

    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else len(encode(t))).astype("Int32")

    return run(c)


#: A responder takes batches of (key, prompt) and yields (key, response, error).
Responder = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def respond(prompts: DataFrame, responder: Responder | DataFrame) -> DataFrame:
    """prompts: key, prompt. Asks a responder inside tasks, or looks up recorded responses (key, response): a key
    that was not recorded gets an error. Returns key, response, error."""
    if isinstance(responder, DataFrame):
        known = responder.select("key", "response")
        found = prompts.select("key").join(known, "key", "left")
        return found.select("key", "response", F.when(F.col("response").isNull(), F.lit("no recorded response")).alias("error"))
    return prompts.select("key", "prompt").mapInPandas(responder, "key string, response string, error string")
