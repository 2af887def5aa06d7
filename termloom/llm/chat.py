"""Chat formatting by schema fingerprints.

A record's layout is known by a fingerprint: a hash of its sorted nested field paths with their kinds of value.
Each fingerprint names a declarative mapping (where the turns are, and which fields hold role and text), so
that prompt, instruction and message layouts become the same canonical turns. A template then marks turns
and escapes its control strings inside texts, reversibly, and the loss mask covers assistant texts alone.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table


def paths(value, at: str = "$") -> set[str]:
    """Nested field paths with kinds; list items share one path."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in paths(v, f"{at}.{k}")} | {f"{at}:object"}
    if isinstance(value, list):
        return {p for v in value for p in paths(v, f"{at}[]")} | {f"{at}:list"}
    # a null says nothing of the kind; texts and numbers do
    return {f"{at}:null" if value is None else f"{at}:{'text' if isinstance(value, str) else 'scalar'}"}


def fingerprint(names: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """turns: the list's field, with the fields of role and text in its items; or parts: fields of the record
    itself, each with its role. `optional` fields may be missing."""

    name: str
    turns: str | None = None
    role: str = "role"
    text: str = "content"
    parts: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = ()
    context: str | None = None  # a field whose text follows the one before it in parts, after an empty line
    roles: tuple[tuple[str, str], ...] = ()  # this layout's names of roles, where they are others

    def shapes(self) -> list[set[str]]:
        """The path sets that this mapping takes."""
        if self.turns:
            base = {"$:object", f"$.{self.turns}:list"}
            item = base | {f"$.{self.turns}[]:object", f"$.{self.turns}[].{self.role}:text", f"$.{self.turns}[].{self.text}:text"}
            empty = item | {f"$.{self.turns}[].{self.text}:null"}
            only = (item - {f"$.{self.turns}[].{self.text}:text"}) | {f"$.{self.turns}[].{self.text}:null"}
            return [base, item, empty, only]
        fields = [f for f, _ in self.parts] + ([self.context] if self.context else [])
        out = [{"$:object"}]
        for f in fields:
            kinds = [{f"$.{f}:text"}, {f"$.{f}:null"}] + ([set()] if f in self.optional else [])
            out = [o | k for o in out for k in kinds]
        return out

    def read(self, record: dict) -> list[tuple[str, str]]:
        if self.turns:
            names = dict(self.roles)
            return [(names.get(t[self.role].lower(), t[self.role]), t[self.text] or "") for t in record[self.turns]]
        out = []
        for field, role in self.parts:
            if field in record and (record[field] or field not in self.optional):
                text = record[field] or ""
                if self.context and role == "user" and record.get(self.context):
                    text += "\n\n" + record[self.context]
                out.append((role, text))
        return out


#: Fixed values. Names that other layouts give the roles; in `messages` a role is what it says.
ROLES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"), ("prompter", "user"))
MAPPINGS = (
    Mapping("messages", turns="messages"),
    Mapping("turns", turns="turns", text="text", roles=ROLES),
    Mapping("conversations", turns="conversations", role="from", text="value", roles=ROLES),
    Mapping("instruction", parts=(("system", "system"), ("instruction", "user"), ("output", "assistant")), optional=("system", "input"), context="input"),
    Mapping("prompt", parts=(("system", "system"), ("prompt", "user"), ("completion", "assistant")), optional=("system",)),
    Mapping("response", parts=(("system_prompt", "system"), ("question", "user"), ("response", "assistant")), optional=("system_prompt",)),
)
KNOWN = {fingerprint(s): m for m in reversed(MAPPINGS) for s in m.shapes()}


def canonical(record) -> list[tuple[str, str]] | None:
    """(role, text) of each turn; None where the layout's fingerprint isn't known."""
    mapping = KNOWN.get(fingerprint(paths(record)))
    return mapping.read(record) if mapping else None


#: The template. A control string inside a role or text has the mark put behind its first character; so has
#: every mark that already stands there, so that taking one mark away restores the text.
START, BODY, END, MARK = "<|turn|>", "<|body|>", "<|end|>", "\u2063"
CONTROL = ("<|turn|>", "<|body|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_SPLIT = re.compile("|".join(re.escape(c[0]) + MARK + "*" + re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True)))
_JOIN = re.compile("|".join(re.escape(c[0]) + MARK + "+" + re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True)))


def escape(text: str) -> str:
    return _SPLIT.sub(lambda m: m[0][0] + MARK + m[0][1:], text)


def unescape(text: str) -> str:
    return _JOIN.sub(lambda m: m[0][0] + m[0][2:], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and the loss mask's spans (code points, end exclusive)."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = START + escape(role) + BODY, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += (head, body, END)
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """render()'s turns, from its text alone."""
    out = []
    for piece in formatted.split(START)[1:]:
        role, _, rest = piece.partition(BODY)
        if not rest.endswith(END):
            raise ValueError("a turn has no end")
        out.append((unescape(role), unescape(rest[: -len(END)])))
    return out


SCHEMA = "id long, layout string, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>"


def understood(record: str | None) -> tuple[str | None, list[tuple[str, str]]]:
    """The layout's name and the turns of a record in JSON; None and none where it can't be read."""
    try:
        value = json.loads(record) if record else None
        mapping = KNOWN.get(fingerprint(paths(value)))
    except (ValueError, RecursionError):
        return None, []
    return (mapping.name, mapping.read(value)) if mapping else (None, [])


def format_records(records: DataFrame) -> DataFrame:
    """records: id, record (JSON), and perhaps part. One row each: SCHEMA's columns (and part). A record that is no JSON, is
    nested too deeply to read, or whose layout isn't known, has a null layout and nothing else; so has a null or empty one.
    Repeated rows are formatted as often as they occur, a null id stays, other columns are left out, whatever their
    names, and an empty table gives an empty one. A record is one row, however long its texts."""
    parted = "part" in records.columns

    def run(batches):
        for pdf in batches:
            rows = []
            for i, text in zip(pdf["id"], pdf["record"]):
                layout, turns = understood(text)
                if layout is None:
                    rows.append((i, None, None, None, None, None))
                    continue
                formatted, spans = render(turns)
                rows.append((i, layout, len(turns), formatted, [a for a, _ in spans], [b for _, b in spans]))
            out = pd.DataFrame(rows, columns=["id", "layout", "n_turns", "formatted", "loss_starts", "loss_ends"]).astype({"id": "Int64", "n_turns": "Int64"})
            yield out.assign(part=pdf["part"].to_numpy()) if parted else out

    return records.select(F.col("id").cast("long").alias("id"), "record", *["part"] * parted).mapInPandas(run, SCHEMA + ", part long" * parted)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """What the formatted texts and masks say, read back: DIGESTS. Rows of no known layout say nothing: they are left out.

    With a column part, a conversation is the rows of one id in the order of part; they are read one after the other, since
    a hash of all turns needs them so, and only the hash is held. in_order: each partition's rows are so ordered already."""
    known = formatted.where(F.col("layout").isNotNull())
    parted = "part" in formatted.columns
    if parted and not in_order:
        known = known.repartition("id").sortWithinPartitions("id", "part")

    def run(batches):
        open_, done = None, []
        for pdf in batches:
            for k, (i, text, starts, ends) in enumerate(zip(pdf["id"], pdf["formatted"], pdf["loss_starts"], pdf["loss_ends"])):
                i = None if pd.isna(i) else int(i)
                if open_ is None or not parted or i != open_.id:
                    if open_ is not None:
                        done.append(open_.row())
                    open_ = Reader(i)
                open_.read(text, starts, ends)
            if done:
                yield _digest_rows(done)
                done = []
        if open_ is not None:
            yield _digest_rows([open_.row()])

    return known.select("id", "formatted", "loss_starts", "loss_ends").mapInPandas(run, DIGESTS)


class Reader:
    """Reads a conversation's formatted text, piece by piece."""

    def __init__(self, conv_id: int | None):
        self.id, self.turns, self.loss, self.size = conv_id, 0, 0, 0
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, starts, ends) -> None:
        for role, said in parse(text):
            self.turns += 1
            self.said.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
        for a, b in zip(starts, ends):
            piece = unescape(text[a:b])
            self.loss += len(piece)
            self.learned.update(piece.encode("utf-8", "surrogatepass"))
        self.size += len(text)

    def row(self) -> tuple:
        return self.id, self.turns, self.said.hexdigest(), self.loss, self.learned.hexdigest(), self.size


def _digest_rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})


#: Turns of one record at most, and characters from which on no further turn is added to it.
PART_TURNS, PART_CHARS = 256, 1_000_000


def conversations(turns: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text -> records in the messages layout: id, part, record. Turns are in order (ties by role and
    text; a null turn comes first; null text or role: empty). A conversation is one record or several parts in order, so that
    none, however long, is ever in memory as a whole; its rows go to one task and stream through it. Rows without conv_id
    are one conversation. Each partition's records are in the order of id and part."""

    def run(batches):
        now, part, messages, size, rows = None, 0, [], 0, []
        for pdf in batches:
            for i, role, text in zip(pdf["conv_id"], pdf["role"], pdf["text"]):
                i = None if pd.isna(i) else int(i)
                if messages and (i != now or len(messages) >= PART_TURNS or size >= PART_CHARS):
                    rows.append((now, part, json.dumps({"messages": messages}, ensure_ascii=False)))
                    part, messages, size = part + 1 if i == now else 0, [], 0
                now = i
                messages.append({"role": role, "content": text})
                size += len(text)
            if rows:
                yield pd.DataFrame(rows, columns=["id", "part", "record"]).astype({"id": "Int64"})
                rows = []
        if messages:
            yield pd.DataFrame([(now, part, json.dumps({"messages": messages}, ensure_ascii=False))], columns=["id", "part", "record"]).astype({"id": "Int64"})

    named = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = named.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInPandas(run, "id long, part long, record string")


def _literal(text: str) -> str:
    return text.replace("'", "''")


def oracle_sql() -> str:
    """The query in SQL. A control string costs one more character in the formatted text."""
    pattern = "|".join(re.escape(c[0]) + r"\x{2063}*" + re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True))
    frame = len(START + BODY + END)
    return f"""
    WITH c AS (
      SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum({frame} + length(role) + length(text) + len(regexp_extract_all(text, '{_literal(pattern)}'))) AS BIGINT) AS formatted_chars
    FROM c GROUP BY conv_id"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(format_records(conversations(turns.unionByName(more))), in_order=True)
