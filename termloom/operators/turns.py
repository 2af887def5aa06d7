"""Turns of a recording: (action, observation) pairs, from typed input or inferred from output.

A recording is one row, so a row-wise UDF over its event array needs no shuffle. The plain-Python parts work on
lists of (t, type, data) and can be used from a streaming operator, too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import heuristics as h, text as tx
from ..functions.terminal import fold

TURN = (
    "struct<turn_id:int,timestamp:double,type:string,raw_input:string,content:string,confidence:double,program:string,keystrokes:array<string>,"
    "raw_output:string,observation:string,duration_ms:double,alternate_screen_used:boolean,resizes:array<string>,exit_status:string,"
    "markers:array<struct<timestamp:double,data:string>>>"
)
RESULT = f"struct<initial_output:string,raw_all_output:string,turns:array<{TURN}>>"

# Prompt, command and line ends in output, by the recording's version.
PROMPTS = {
    1: re.compile(r"(^.*?(?:(?<!\d)%|[\$#&>❯➜λ»])\s+)([^\r\n]+)([\r\n]+)", re.M),
    2: re.compile(r"(^.*?(?:(?<!\d)%|(?<![\=\-])>|[\$#&❯➜λ»])\s+)([^\r\n]+)([\r\n]+)", re.M),
}
_HEREDOC = re.compile(h.HEREDOC)
_ENTER, _EXIT = re.compile(h.ALT_ENTER), re.compile(h.ALT_EXIT)
_DISPLAY = [re.compile(p.replace("(?d)", "")) for p in tx.DISPLAY]
_LEAKED = [re.compile(p) for p in tx.LEAKED_PROMPTS]
_OUTPUT = re.compile("|".join(f"(?:{p})" for p in h.OUTPUT))
_OUTPUT_ANY = re.compile("|".join(f"(?:{p})" for p in h.OUTPUT_ANY_CASE), re.I)
_DRAWING, _BORDERS = re.compile(h.DRAWING), re.compile(h.BORDERS)
_SUSPICIOUS = re.compile("|".join(f"(?:{p})" for p in h.SUSPICIOUS))
_STRONG, _WEAK = re.compile(h.STRONG_PROMPT), re.compile(h.WEAK_PROMPT)
_ASSIGNED = re.compile(r"[A-Z_][A-Z0-9_]*=")


def shown(text: str) -> str:
    """clean_output() for Python strings."""
    if "\x1b" in text or "\x07" in text or not text.isprintable():
        for p in _DISPLAY:
            text = p.sub("", text)
    return text.replace("\r\n", "\n")


def command_text(raw: str) -> str:
    text = fold(shown(raw))
    for p in _LEAKED:
        text = p.sub("", text)
    return text.replace("\r", "").replace("\n", "").strip()


def output_like(text: str) -> bool:
    bare = text.strip()
    if len(text) < 2 or _OUTPUT.search(text) or _OUTPUT_ANY.search(text):
        return True
    if (len(text) > 10 and _DRAWING.match(bare)) or _BORDERS.match(bare) or bare.startswith(h.OUTPUT_STARTS):
        return True
    return len(bare) > 200 or (len(bare) > 15 and sum(map(str.isalpha, text)) < 0.15 * len(text))


def command_like(text: str, commands: frozenset[str]) -> bool:
    word = next(iter(text.split()), "")
    return bool(word) and (word.rsplit("/", 1)[-1] in commands or word.startswith(("./", "/")) or bool(_ASSIGNED.match(text.strip())))


def inferred_confidence(command: str, prompt: str, version: int, valid: bool) -> float:
    known, strong = (30, 15) if version == 1 else (20, 10)
    score = 50 + known if valid else 50 - known if version == 1 else 50
    score = min(100, score + (strong if _STRONG.search(prompt) else 5 if _WEAK.search(prompt) else 0))
    if _SUSPICIOUS.search(command):
        score = max(10, score - 20)
    size = len(command.strip())
    if size < 2 or size > 150:
        score = max(10, score - (20 if size < 2 else 15))
    return score / 100


def program_of(text: str, version: int) -> str | None:
    name = next(iter(text.split()), "").rsplit("/", 1)[-1]
    return name if name in h.INTERACTIVE[3 if version == 3 else 2] else None


@dataclass
class Turn:
    """Optional members are None where they don't apply."""

    timestamp: float | None
    type: str
    raw_input: str
    content: str
    confidence: float | None = None
    program: str | None = None
    keystrokes: list[str] | None = None
    output: list[str] = field(default_factory=list)
    duration_ms: float = 0.0
    alternate_screen_used: bool | None = None
    resizes: list[str] | None = None
    exit_status: str | None = None
    markers: list[dict] | None = None

    def row(self, turn_id: int) -> dict:
        raw = "".join(self.output)
        lines = fold(shown(raw)).split("\n")
        if self.content and lines[0].strip().startswith(self.content[:20]):
            del lines[0]  # the echo of what was typed
        row = {k: v for k, v in vars(self).items() if k != "output"}
        return {"turn_id": turn_id, **row, "raw_output": raw, "observation": "\n".join(lines)}


class TypedSession:
    """Reads events one by one; take() gives the turns that are complete, finish() the last."""

    def __init__(self, version: int = 2):
        self.version = version
        self.before: list[str] = []
        self.typing = self.full_screen = False
        self.begun: float | None = None
        self.typed: list[str] = []
        self.keys: list[str] = []
        self.heredoc: str | None = None
        self.body: list[str] = []
        self.turns: list[Turn] = []

    def event(self, t: float, kind: str, data: str) -> None:
        if kind == "i":
            self.typing = True
            self._input(t, data)
        elif kind == "o":
            self._output(t, data)
        elif self.turns:
            self._note(self.turns[-1], t, kind, data)

    def _input(self, t: float, data: str) -> None:
        if self.begun is None:
            self.begun = t
        if self.heredoc:
            self.body.append(data)
            if self.heredoc + "\n" in data or data.strip() == self.heredoc:
                raw = "".join(self.body)
                # version 3 takes a start of 0.0 for none
                started = self.begun or t if self.version == 3 else self.begun
                self._open(Turn(started, "heredoc", raw, shown(raw).strip()))
                self.heredoc, self.body, self.typed = None, [], []
        elif self.full_screen:
            self.keys.append(data)
        else:
            self.typed.append(data)
            if "\n" in data or "\r" in data:
                self._enter(t)

    def _enter(self, t: float) -> None:
        raw = "".join(self.typed)
        self.typed = []
        if m := _HEREDOC.search(raw):
            self.heredoc, self.body = m[1] or m[2], [raw]
            return
        program, content = program_of(raw, self.version), command_text(raw)
        self._open(Turn(self.begun or t, "interactive_program" if program else "command", raw, content, 1.0 if content.strip() else 0.5, program))

    def _open(self, turn: Turn) -> None:
        self.turns.append(turn)
        self.begun = None

    def _output(self, t: float, data: str) -> None:
        if not self.typing:
            self.before.append(data)
            return
        last = self.turns[-1] if self.turns else None
        if _ENTER.search(data):
            self.full_screen = True
        elif _EXIT.search(data):
            self.full_screen = False
            if last and self.keys:
                last.keystrokes, last.alternate_screen_used = self.keys, True
            self.keys = []
        if last:
            last.output.append(data)
            last.duration_ms = round((t - (last.timestamp or 0.0)) * 1000, 2)

    def _note(self, turn: Turn, t: float, kind: str, data: str) -> None:
        if kind == "r":
            turn.resizes = (turn.resizes or []) + [data]
        elif kind == "m" and self.version == 2:
            turn.markers = (turn.markers or []) + [{"timestamp": t, "data": data}]
        elif kind == "x" and self.version == 3:
            turn.exit_status = data

    def take(self) -> list[dict]:
        return [turn.row(k + 1) for k, turn in enumerate(self.turns)]


def from_output(raw: str, version: int, commands: frozenset[str]) -> tuple[str, list[dict]]:
    """Turns inferred from prompts in output. What lies between a rejected match and the next is in no turn."""
    text = fold(shown(raw))
    found = list(PROMPTS[1 if version == 1 else 2].finditer(text))
    if not found:
        return text, []
    ends = [m.end(1) for m in found[1:]] + [len(text)]
    rows = []
    for m, end in zip(found, ends):
        command = m[2].strip()
        content = command_text(command) if command else ""
        if not command or output_like(content):
            continue
        valid = command_like(content, commands)
        score = inferred_confidence(content, m[1], version, valid)
        if score < 0.3 or (version == 1 and not valid):
            continue
        seen = text[m.end() : end]
        observation = fold(shown(seen))
        turn = Turn(0.0, "command", command + "\n", content, score)
        rows.append(turn.row(len(rows) + 1) | {"raw_output": m[1] + command + "\n" + seen, "observation": observation.strip() if version == 1 else observation})
    return text[: found[0].end(1)], rows


def extract(events: list[tuple[float, str, str]], version: int, commands: frozenset[str]) -> dict:
    """initial_output, raw_all_output and turns of one recording."""
    raw = "".join(d for _, k, d in events if k == "o")
    if version != 1 and any(k == "i" for _, k, _ in events):
        session = TypedSession(version)
        for e in events:
            session.event(*e)
        return {"initial_output": "".join(session.before), "raw_all_output": raw, "turns": session.take()}
    before, rows = from_output(raw, version, commands)
    return {"initial_output": before, "raw_all_output": raw, "turns": rows}


def extract_turns(casts: DataFrame, commands=h.COMMANDS) -> DataFrame:
    """casts: version and events (arrays of t, type, data). Adds the columns initial_output, raw_all_output, turns.
    A row without events or version gets nulls."""
    known = frozenset(commands)

    @F.pandas_udf(RESULT)
    def run(versions: pd.Series, events: pd.Series) -> pd.DataFrame:
        rows = []
        for v, es in zip(versions, events):
            if es is None or pd.isna(v):
                rows.append({"initial_output": None, "raw_all_output": None, "turns": None})
            else:
                rows.append(extract([(e["t"], e["type"], e["data"] or "") for e in es], int(v), known))
        return pd.DataFrame(rows, columns=["initial_output", "raw_all_output", "turns"])

    return casts.withColumn("extracted", run("version", "events")).select("*", "extracted.*").drop("extracted")


def session_text(initial: Column | str, turns: Column | str, version: int = 2) -> Column:
    """The session put together again: actions with a line end, observations; from version 2 on, a space before an
    action unless the part before it is empty or ends in a space or line end."""
    initial, turns = (F.col(c) if isinstance(c, str) else c for c in (initial, turns))
    first = F.coalesce(initial, F.lit(""))
    parts = F.transform(turns, lambda t: F.coalesce(t["observation"], F.lit("")))
    before = F.slice(F.concat(F.array(first), parts), 1, F.size(turns))

    def put(t, part):
        space = F.when((part != "") & ~part.rlike(r"[ \n]\z"), " ").otherwise("") if version != 1 else F.lit("")
        return F.concat(space, F.coalesce(t["content"], F.lit("")), F.lit("\n"), F.coalesce(t["observation"], F.lit("")))

    return F.concat(first, F.array_join(F.zip_with(turns, before, put), ""))
