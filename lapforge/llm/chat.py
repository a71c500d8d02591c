r"""Chat formatting with typed content parts.

A turn is text, or an array of parts: text, image, audio, document. A visitor
flattens the parts in order: texts that follow each other are joined and escaped, the others become numbered
placeholders; what they refer to is recorded with the number of tokens that the
placeholder will expand to. A turn reads ``<|role|>body</s>``.

Escaping: a backslash becomes two; a control string gets one after its first
character, so that no control string is left in a body. Reading back drops one
backslash before every character. Output has one row a turn, whose texts in order
of ``turn_no`` are the conversation, so that no row holds a whole conversation.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.llm.common import ready

#: Strings that mean something to a chat template.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|")
END = "</s>"
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PLACEHOLDER = re.compile(r"<\|(?:image|audio|document):\d+\|>")
PATCH, AUDIO_RATE, PAGE_TOKENS = 14, 25, 256

PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
OUTPUT = (
    "conv_id {kind}, turn_no long, role string, formatted string, loss_start long, loss_end long, "
    "attachments array<struct<number:int,kind:string,ref:string,position:long,tokens:long>>, expanded_tokens long"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _header(role: str) -> str:
    return "<|" + re.sub(r"([^\w ])", r"\\\1", role) + "|>"


@dataclass
class Visitor:
    """Collects the body of one turn; ``at`` is where the body begins in the turn."""

    at: int
    body: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    text: str = ""

    def visit(self, part: dict) -> None:
        kind = part.get("kind") or "text"
        if kind == "text":
            self.text += part.get("text") or ""
        elif kind == "image":
            self._attach(part, math.ceil((part.get("width") or 0) / PATCH) * math.ceil((part.get("height") or 0) / PATCH))
        elif kind == "audio":
            self._attach(part, math.ceil((part.get("seconds") or 0) * AUDIO_RATE))
        elif kind == "document":
            self._attach(part, (part.get("pages") or 0) * PAGE_TOKENS)
        else:
            raise ValueError(f"unknown kind of part: {kind}")

    def flush(self) -> None:
        """Escape the texts since the last attachment as one, as two of them can form a control string where they meet."""
        self._add(escape(self.text))
        self.text = ""

    def _attach(self, part: dict, tokens: int) -> None:
        self.flush()
        number = len(self.attachments)
        self.attachments.append({"number": number, "kind": part["kind"], "ref": part.get("ref"), "position": self.at, "tokens": max(1, tokens)})
        self._add(f"<|{part['kind']}:{number}|>")

    def _add(self, text: str) -> None:
        self.body.append(text)
        self.at += len(text)


def format_turn(role: str | None, text: str | None, parts: list[dict] | None) -> dict:
    role = role or ""
    head = _header(role)
    visitor = Visitor(len(head))
    for part in parts if parts is not None else [{"kind": "text", "text": text}]:
        if part is not None:
            visitor.visit(part)
    visitor.flush()
    body = "".join(visitor.body)
    learn = role == "assistant"
    return {
        "role": role,
        "formatted": head + body + END,
        "loss_start": len(head) if learn else None,
        "loss_end": len(head) + len(body) if learn else None,
        "attachments": visitor.attachments,
        "expanded_tokens": sum(a["tokens"] for a in visitor.attachments),
    }


def format_turns(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, and optionally ``parts`` (array of ``PART``) -> one formatted row a turn.

    Turns of a conversation are ordered by turn, role, text (nulls first); rows
    that agree in all are kept, each as a turn. Null texts and null parts are
    empty, null roles the empty role, a null conv_id one conversation. The loss
    mask covers bodies of assistant turns, as positions in the turn.
    """
    ready(rows.sparkSession)
    if "parts" not in rows.columns:
        rows = rows.withColumn("parts", F.lit(None).cast(f"array<{PART}>"))
    kind = dict(rows.dtypes)["conv_id"]
    picked = rows.select("conv_id", "turn", "role", "text", F.col("parts").cast(f"array<{PART}>").alias("parts"))
    dealt = picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    attachment = pa.list_(pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("position", pa.int64()), ("tokens", pa.int64())]))
    types = {"role": pa.string(), "formatted": pa.string(), "loss_start": pa.int64(), "loss_end": pa.int64(), "attachments": attachment, "expanded_tokens": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, number = object(), 0
        for batch in batches:
            convs = batch.column(0).to_pylist()
            numbers = []
            for c in convs:
                number = number + 1 if c == now else 0
                now = c
                numbers.append(number)
            done = [format_turn(r, t, p) for r, t, p in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)]
            cols = [pa.array([d[n] for d in done], t) for n, t in types.items()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers, pa.int64()), *cols], names=["conv_id", "turn_no", *types])

    return dealt.mapInArrow(run, OUTPUT.format(kind=kind))


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn; placeholders are left out of the text."""
    if not formatted.startswith("<|") or not formatted.endswith(END):
        raise ValueError("not a turn")
    close = formatted.index("|>")
    return unescape(formatted[2:close]), unescape(_PLACEHOLDER.sub("", formatted[close + 2 : -len(END)]))


class _Digest:
    def __init__(self, conv: object) -> None:
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int | None, end: int | None) -> None:
        role, text = parse_turn(formatted)
        self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.turns += 1
        self.chars += len(formatted)
        if start is not None:
            said = unescape(_PLACEHOLDER.sub("", formatted[start:end]))
            self.loss.update(said.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(said)

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of every conversation, from the formatted turns alone, streamed in order."""
    kind = dict(turns.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [f.split()[0] for f in schema.split(", ")]
    dealt = turns.select("conv_id", "turn_no", "formatted", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "turn_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for batch in batches:
            done = []
            for conv, _, formatted, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(formatted, start, end)
            yield _rows(done, batch.schema.field(0).type)
        if now is not None:
            yield _rows([now.row()], batch.schema.field(0).type)

    def _rows(done: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        types = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(types)], names=names)

    return dealt.mapInArrow(run, schema)


def query(conversations: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = conversations.select("conv_id", "turn", "role", "text")
    probe = conversations.sparkSession.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(rows.unionByName(probe)))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
e AS (SELECT conv_id, turn, role AS r, text AS t, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
f AS (SELECT *, length(regexp_replace(role, '([^\w ])', '\\\1', 'g')) + 4 + length(replace(text, '\', '\\')) + len(regexp_extract_all(text, '<s>|</s>|\[INST\]|\[/INST\]|<\|')) + 4 AS chars FROM e)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
