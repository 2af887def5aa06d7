"""Per-string state machines: the overwrite buffer and the terminal screen, as Arrow-batched UDFs."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F

_EDITS = re.compile("[\r\b]")
_RUNS = re.compile("[^\r\b]+|\r|\b")


def fold(text: str) -> str:
    """Backspace moves left, carriage return to the line's start; what is written there overwrites."""
    if not _EDITS.search(text):
        return text
    return "\n".join(_fold_line(line) if _EDITS.search(line) else line for line in text.split("\n"))


def _fold_line(line: str) -> str:
    shown, at = "", 0
    for run in _RUNS.findall(line):
        if run == "\r":
            at = 0
        elif run == "\b":
            at = max(at - 1, 0)
        else:
            shown = shown[:at] + run + shown[at + len(run) :]
            at += len(run)
    return shown


def fold_backspaces(c: Column | str) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(fold, na_action="ignore")

    return run(c)


class Screen:
    """Lines, a cursor and the top of the viewport; as much of a VT terminal as recordings are checked with."""

    MOST_LINES = 10_000

    def __init__(self, width: int = 80, height: int = 24):
        self.width, self.height, self.most = width, height, max(width, 200)
        self.lines: list[str] = [""]
        self.x = self.y = self.top = 0

    def _reach(self, y: int) -> None:
        if y >= len(self.lines):
            self.lines += [""] * (min(y + 1, self.MOST_LINES) - len(self.lines))

    def _down(self) -> None:
        self.y += 1
        self.x = 0
        self.top += self.y >= self.top + self.height
        self._reach(self.y)

    def put(self, text: str) -> None:
        """Printable text without line ends, wrapped at the width."""
        while text:
            if self.x >= self.width:
                self._down()
            piece, text = text[: self.width - self.x], text[self.width - self.x :]
            self._reach(self.y) if self.y >= 0 else None
            if 0 <= self.y < len(self.lines):
                line = self.lines[self.y].ljust(self.x)
                self.lines[self.y] = line[: self.x] + piece + line[self.x + len(piece) :]
            self.x += len(piece)

    def control(self, final: str, params: str) -> None:
        n = int(params) if params.isdecimal() else None
        if final in "Hf":
            row, col = ([int(p) if p.isdecimal() else 1 for p in params.split(";")] + [1, 1])[:2]
            self.y, self.x = self.top + row - 1, max(col - 1, 0)
        elif final == "J" and n in (2, 3):
            self.top = self.y = len(self.lines)
            self.x = 0
        elif final == "K" and 0 <= self.y < len(self.lines):
            self.lines[self.y] = self.lines[self.y][: self.x]
        elif final == "A":
            self.y = max(self.top, self.y - (1 if n is None else n))
        elif final == "B":
            self.y += 1 if n is None else n
            self._reach(self.y)
        elif final == "C":
            self.x = min(self.x + (1 if n is None else n), self.most - 1)
        elif final == "D":
            self.x = max(self.x - (1 if n is None else n), 0)

    # a control sequence, an operating system command (perhaps without an end), or one character or run of them
    PARTS = re.compile("(?s)\x1b\\[(?P<params>[^@-~]*)(?P<final>[@-~])|\x1b\\].*?(?:\x07|\x1b\\\\|\\Z)|(?P<run>[^\x00-\x1f]+)|(?P<one>.)")

    def feed(self, text: str) -> "Screen":
        for m in self.PARTS.finditer(text):
            if m["run"]:
                self.put(m["run"])
            elif m["final"]:
                self.control(m["final"], m["params"])
            elif m["one"] == "\n":
                self._down()
            elif m["one"] == "\r":
                self.x = 0
            elif m["one"] == "\b":
                self.x = max(self.x - 1, 0)
            elif m["one"] == "\t":
                for _ in range(8 - self.x % 8):
                    self.put(" ")
        return self

    def text(self) -> str:
        return "\n".join(line.rstrip() for line in self.lines[self.top :])


def screen(c: Column | str, width: Column | int = 80, height: Column | int = 24) -> Column:
    """The final viewport after a terminal has shown the text."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else Screen(int(a), int(b)).feed(t).text() for t, a, b in zip(texts, w, h)])

    size = [x if isinstance(x, Column) else F.lit(x) for x in (width, height)]
    return run(c, *[F.coalesce(s.cast("int"), F.lit(d)) for s, d in zip(size, (80, 24))])
