"""Text functions as Column expressions: escape sequences, prompts, normalisation, markup.

Patterns carry (?d) so that only \\n ends a line, and (?U) where white space, digits and word characters are
Unicode's.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F

# Escape sequences in the order they are removed for display, each with what it is.
DISPLAY = (
    r"(?s)\x1b\].*?\x07",  # operating system command up to BEL
    r"(?s)\x1b\].*?\x1b\\",  # the same up to ST
    r"\x1b\[[\x30-\x3f]*[\x20-\x2f]*[\x40-\x7e]",  # control sequence
    r"(?d)\x1b\(.",  # G0 character set
    r"(?d)\x1b[)*+\-./].",  # other character sets
    r"\x1b[@-_]",  # two-character escape
    r"\x1b[=>]",  # keypad modes
    r"\x07",
    r"\x1b[^a-zA-Z]*[a-zA-Z]",  # whatever remains
    r"[\x00-\x07\x0b\x0c\x0e-\x1f\x7f]",  # controls but backspace, tab and line ends
)
# The verifier's weaker list.
PLAIN = (r"\x1b\[[0-9;]*[A-Za-z]", r"(?d)\x1b\][0-9]+;.*?\x07", r"\x1b\[\?[0-9;]*[hl]", r"\x1b[=>]", r"\x1b[78]", r"\x1bc")
# Prompts that leak into typed input, in the order they are removed.
LEAKED_PROMPTS = (
    r"^\[?[^\]\n]*[@:][^\]\n]*\]?\s*[\$#%>❯]\s*",
    r"^[\w\d~./-]*\s*\([^)]+\)\s*[%>❯]\s*",
    r"^[\w\d~./-]+\s+[\$#%>❯]\s*",
    r"^[➜\$#%>❯]\s+",
    r"^[^\n]*\?\s*[>❯]\s*",
    r"^\[[^\]]+:[^\]]+\]\s*(master|main|develop|\w+)\s*[±✓✗→]\s*",
    r"^~\s+",
)


def without(c: Column, patterns, flags: str = "") -> Column:
    return reduce(lambda x, p: F.regexp_replace(x, flags + p, ""), patterns, c)


def strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def rstrip_lines(c: Column) -> Column:
    return F.regexp_replace(c, r"(?Ud)[\s&&[^\n]]+(?=\n|\z)", "")


def clean_output(c: Column | str) -> Column:
    """Terminal output for display: no escape sequences and controls (backspace, tab and line ends stay)."""
    return F.replace(without(F.col(c) if isinstance(c, str) else c, DISPLAY), F.lit("\r\n"), F.lit("\n"))


def clean_ansi(c: Column | str) -> Column:
    return without(F.col(c) if isinstance(c, str) else c, PLAIN)


def clean_command(c: Column | str) -> Column:
    """Typed input without escapes, leaked prompts, line ends and outer white space. Input that holds a
    backspace or carriage return should go through fold_backspaces() after clean_output()."""
    from .terminal import fold_backspaces

    cleaned = fold_backspaces(clean_output(c))
    return strip(F.regexp_replace(without(cleaned, LEAKED_PROMPTS, "(?Ud)"), r"[\r\n]", ""))


def clean_plain_command(c: Column | str) -> Column:
    """clean_command() of text known to hold no backspace or carriage return: built-in functions alone."""
    return strip(F.replace(without(clean_output(c), LEAKED_PROMPTS, "(?Ud)"), F.lit("\n"), F.lit("")))


def normalize_v1(c: Column | str) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"\x1b\[[0-9;]*[a-zA-Z]", ""), r"\r", ""))


def normalize(c: Column | str) -> Column:
    """normalize_v1() with each line's end stripped, too."""
    return strip(rstrip_lines(F.regexp_replace(F.regexp_replace(c, r"\x1b\[[0-9;]*[a-zA-Z]", ""), r"\r", "")))


def normalize_screen(c: Column | str) -> Column:
    """Lines without trailing white space; no blank lines at both ends."""
    return F.regexp_replace(rstrip_lines(strip(c)), r"\A\n+|\n+\z", "")


def collapse_blank_lines(c: Column | str) -> Column:
    """Lines without trailing white space, runs of blank lines as one, stripped."""
    return strip(F.regexp_replace(rstrip_lines(F.col(c) if isinstance(c, str) else c), r"\n{3,}", "\n\n"))


def between(c: Column | str, start: str, suffix: str = "<") -> Column:
    """What lies between a marker and the next suffix; '' where there is no marker. With no suffix behind the
    marker: the rest but its last character."""
    c = F.col(c) if isinstance(c, str) else c
    at = F.locate(start, c)
    rest = c.substr(at + len(start), F.length(c))
    end = F.locate(suffix, rest)
    return F.when(at == 0, "").when(end > 0, rest.substr(F.lit(1), end - 1)).otherwise(rest.substr(F.lit(1), F.greatest(F.length(rest) - 1, F.lit(0))))


def all_between(c: Column | str, start: str = '">', end: str = "<") -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)" + re.escape(start) + "(.*?)" + re.escape(end)), F.lit(1))


def nearest_before(c: Column | str, marker: str, prefix: str = 'href="', suffix: str = '"') -> Column:
    """The last value between prefix and suffix that begins before a marker; '' if there is none."""
    return F.regexp_extract(c, "(?s)^.*" + re.escape(prefix) + "([^" + re.escape(suffix) + "]*)" + re.escape(suffix) + ".*?" + re.escape(marker), 1)


def find_before(c: Column | str, marker: str, prefix: str = 'href="', suffix: str = '"') -> Column:
    """struct(value, place): nearest_before() and where the marker is (from 0); place is -1 where there is no marker, and -2
    where no prefix stands before it. Both leave the value empty."""
    c = F.col(c) if isinstance(c, str) else c
    at = F.locate(marker, c)
    head = c.substr(F.lit(1), F.greatest(at - 1, F.lit(0)))
    known = F.locate(prefix, head) > 0
    place = F.when(at == 0, -1).when(~known, -2).otherwise(at - 1)
    tail = F.substring_index(head, prefix, -1)
    return F.struct(F.when(place >= 0, F.substring_index(tail, suffix, 1)).otherwise("").alias("value"), place.cast("long").alias("place"))


def _without_tags(text: str) -> str:
    """Innermost <...> removed until nothing changes, in one pass: a `>` takes away all from the nearest open `<`."""
    out: list[str] = []
    opened: list[int] = []
    for piece in re.findall(r"[<>]|[^<>]+", text):
        if piece == "<":
            opened.append(len(out))
            out.append(piece)
        elif piece == ">" and opened:
            del out[opened.pop() :]
        else:
            out.append(piece)
    return "".join(out)


def remove_tags(c: Column | str) -> Column:
    """Innermost <...> removed until nothing changes: by built-in functions up to a nesting of four, beyond it by a UDF that gets
    those texts alone."""

    @F.pandas_udf("string")
    def deep(texts: pd.Series) -> pd.Series:
        return texts.map(_without_tags, na_action="ignore")

    shallow = reduce(lambda x, _: F.regexp_replace(x, r"<[^<>]*>", ""), range(4), F.col(c) if isinstance(c, str) else c)
    return F.coalesce(deep(F.when(shallow.rlike(r"<[^<>]*>"), shallow)), shallow)


def html_fields(html: Column | str) -> Column:
    """struct(title, heading, links, views): what the crawler reads from a page."""
    html = F.col(html) if isinstance(html, str) else html
    return F.struct(
        strip(between(html, "<title>")).alias("title"),
        strip(remove_tags(F.regexp_extract(html, r"(?is)<h[12][^>]*>(.*?)</h[12]>", 1))).alias("heading"),
        F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1)).alias("links"),
        F.regexp_replace(F.regexp_extract(html, r"([0-9][0-9,. ]*) views", 1), "[^0-9]", "").try_cast("long").alias("views"),
    )


def environment(c: Column | str) -> Column:
    """'system • terminal • shell' as a struct; missing parts are ''."""
    parts = F.split(c, "•", -1)
    return F.struct(*[F.coalesce(strip(F.get(parts, F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(("system", "terminal", "shell"))])


def plain_date(c: Column | str) -> Column:
    """An ISO time with its T and Z taken out."""
    return F.regexp_replace(c, "[TZ]", "")


def plain_time(seconds: Column | str, style: str = "yyyy.MM.dd") -> Column:
    """Seconds since 1970 as a date or time; null where they are no number."""
    return F.date_format(F.timestamp_seconds((F.col(seconds) if isinstance(seconds, str) else seconds).try_cast("double")), style)


def boxed(c: Column | str) -> Column:
    r"""true or false from \boxed{...}, else from oxed{...}; null if neither is there."""
    first = F.regexp_extract(c, r"(?i)\\boxed\{(true|false)\}", 1)
    second = F.regexp_extract(c, r"(?i)oxed\{(true|false)\}", 1)
    found = F.when(first != "", first).otherwise(second)
    return F.when(found != "", F.lower(found) == "true")


def json_fence(c: Column | str) -> Column:
    """What a ```json fence holds, else what the first fence holds, else the text, stripped."""
    labelled = F.regexp_extract(c, r"(?s)```json\s*(.*?)```", 1)
    plain = F.regexp_extract(c, r"(?s)```\s*(.*?)```", 1)
    return strip(F.when(labelled != "", labelled).when(plain != "", plain).otherwise(c))


def txt_commands(c: Column | str) -> Column:
    """Commands behind prompt characters, line by line."""
    found = F.regexp_extract_all(clean_ansi(c), F.lit(r"(?md)[\$#>%]\s+(.+?)(?:\s*$)"), F.lit(1))
    return F.filter(F.transform(found, strip), lambda x: (x != "") & ~x.rlike(r"^[\$#>%]+$"))


def action_command(c: Column | str) -> Column:
    """The text behind the last %, else behind the last $."""
    c = F.col(c) if isinstance(c, str) else c
    return strip(F.when(c.contains("%"), F.substring_index(c, "%", -1)).otherwise(F.substring_index(c, "$", -1)))


def file_id(path: Column | str) -> Column:
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    return F.regexp_replace(name, "_multi$", "")


def natural_key(c: Column | str) -> Column:
    """An array that sorts as people sort: runs of digits by value (their length, then their digits), the rest in lower case."""
    parts = F.regexp_extract_all(c, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), _by_value(F.regexp_replace(p, "^0+(?=.)", ""))).otherwise(F.lower(p)))


def _by_value(digits: Column) -> Column:
    return F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)


def chunk_ranges(total: Column, size: int) -> Column:
    """Ranges [start, end) of `size`; a total that is a proper multiple of size has one empty range more."""
    last = F.when((total % size == 0) & (total != size), total).otherwise(F.greatest(total - 1, F.lit(0)) - F.pmod(F.greatest(total - 1, F.lit(0)), F.lit(size)))
    return F.transform(F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(size).cast("long")), lambda s: F.struct(s.alias("start"), F.least(s + size, total).alias("end")))
