"""Conversations as training texts: rendered by a compiled template, and read back.

Turns are dealt by conversation and sorted, and a task streams them through the template, one
turn at a time, so a conversation with very many turns needs no more memory than its longest
turn and one part of its output. The formatted text of a conversation comes in parts of about
``PART_CHARS`` signs; nearly all have one.

Control strings inside a role or text get a backslash before them, backslashes are doubled,
so what the template writes is told from what a speaker said, and reading back gives the
exact turns.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm import templates

# Marks of the start and the end of a turn, and the template that writes them.
START, STOP = "<turn>", "</turn>"
TEMPLATE = (
    "{% for message in messages %}<turn>{{ message.role | guard_line }}\n"
    "{% if message.role == 'assistant' %}{% generation %}{{ message.text | guard }}{% endgeneration %}"
    "{% else %}{{ message.text | guard }}{% endif %}</turn>\n{% endfor %}"
)
# Signs after which a part of a long conversation ends, and signs of one Arrow batch.
PART_CHARS, BATCH_CHARS = 1_000_000, 4_000_000

_FORMATTED = "part int, at long, text string, spans array<struct<start: long, stop: long>>"
_READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def guards(controls: Iterable[str]) -> dict[str, tuple[int, Callable]]:
    """The filters ``guard`` and ``guard_line`` (line breaks too) for these control strings."""
    plain = "|".join(map(re.escape, controls))
    inside, line = re.compile(rf"\\|{plain}"), re.compile(rf"\\|\n|{plain}")
    return {
        "guard": (0, lambda v: inside.sub(lambda m: "\\" + m[0], templates.shown(v))),
        "guard_line": (0, lambda v: line.sub(lambda m: "\\" + m[0], templates.shown(v))),
    }


def unguarded(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


class _Once:
    """Rows that a template may loop over once."""

    def __init__(self, rows: Iterable):
        self.rows = rows

    def __iter__(self) -> Iterator:
        if self.rows is None:
            raise templates.TemplateError("a template reads the messages once")
        rows, self.rows = self.rows, None
        return iter(rows)


def _parts(pieces: Iterator) -> Iterator[tuple[int, int, str, list[dict]]]:
    """Parts of a rendered conversation, none of which ends inside a generation block."""
    part = at = size = 0
    texts, spans, begun = [], [], None
    for piece in pieces:
        if piece is templates.BEGIN:
            begun = size
        elif piece is templates.END:
            spans.append({"start": begun, "stop": size})
            begun = None
        else:
            texts.append(piece)
            size += len(piece)
        if size >= PART_CHARS and begun is None:
            yield part, at, "".join(texts), spans
            part, at, size, texts, spans = part + 1, at + size, 0, [], []
    if texts or not part:
        yield part, at, "".join(texts), spans


def formatted(conversations: DataFrame, template: str = TEMPLATE, controls: tuple[str, ...] = (START, STOP)) -> DataFrame:
    """``conv_id``, ``part`` (0, 1, ...), ``at`` (signs of the parts before), ``text`` and
    ``spans`` (what a model has to produce, as places in this part's text).

    Turns are in the order of ``turn``, null first, equal ones in that of role and text; null
    roles and texts are empty; repeated rows are turns of their own; rows without ``conv_id``
    are one conversation; other columns are ignored. The template sees ``messages``, each with
    ``role`` and ``text``, and may loop over them once. An empty table gives no rows. The parts
    of a conversation are neighbours in one partition, in order.
    """
    kind = dict(conversations.dtypes)["conv_id"]
    templates.compiled(template, guards(controls))  # a fault of the template shows on the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = templates.compiled(template, guards(controls))
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        out, size = [], 0
        for conv, told in groupby(rows, key=lambda r: r[0]):
            messages = _Once({"role": role, "text": text} for _, role, text in told)
            for part in _parts(render({"messages": messages})):
                out.append((conv, *part))
                size += len(part[2])
                if size >= BATCH_CHARS:
                    yield _batch(out, f"conv_id {kind}, {_FORMATTED}", types)
                    out, size = [], 0
        if out:
            yield _batch(out, f"conv_id {kind}, {_FORMATTED}", types)

    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    types = [_arrow(kind), pa.int32(), pa.int64(), pa.string(), span]
    role, text = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.select("conv_id", "turn", role, text)
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, {_FORMATTED}")


def _arrow(kind: str) -> pa.DataType:
    known = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    if kind not in known:
        raise TypeError(f"conv_id of type {kind}: cast it to a string or a whole number")
    return known[kind]


def _batch(rows: list[tuple], schema: str, types: list[pa.DataType]) -> pa.RecordBatch:
    names = [f.split(" ")[0] for f in re.sub(r"<.*>", "", schema).split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


# A whole turn of the default template at the head of a text; a role ends at its first bare line break.
_TURN = re.compile(rf"{START}((?:[^\\\n]|\\.)*+)\n((?:[^\\<]++|\\.|<(?!/turn>))*+){STOP}\n", re.S)


class _Reader:
    """Turns and loss text of one conversation, read from its parts in order."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.rest = ""

    def read(self, text: str, spans: list[dict]) -> None:
        self.chars += len(text)
        for span in spans:
            told = unguarded(text[span["start"] : span["stop"]])
            self.loss.update(told.encode())
            self.loss_chars += len(told)
        self.rest += text
        at = 0
        while m := _TURN.match(self.rest, at):
            self.turns.update(f"{unguarded(m[1])}\n{unguarded(m[2])}\n".encode())
            self.n_turns += 1
            at = m.end()
        self.rest = self.rest[at:]

    def row(self) -> tuple[int, str, int, str, int]:
        if self.rest:
            raise ValueError("a formatted conversation does not end with a whole turn")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame) -> DataFrame:
    """What the rows of ``formatted`` (of the default template, in their order) say: ``conv_id``,
    ``n_turns``, ``turns_sha256`` (role, line break, text, line break of each turn),
    ``loss_chars`` and ``loss_sha256`` (all text inside spans), ``formatted_chars``."""
    kind = dict(formatted.dtypes)["conv_id"]
    types = [_arrow(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        out = []
        for conv, parts in groupby(rows, key=lambda r: r[0]):
            reader = _Reader()
            for _, text, spans in parts:
                reader.read(text, spans)
            out.append((conv, *reader.row()))
            if len(out) >= 10_000:
                yield _batch(out, f"conv_id {kind}, {_READ}", types)
                out = []
        if out:
            yield _batch(out, f"conv_id {kind}, {_READ}", types)

    return formatted.select("conv_id", "text", "spans").mapInArrow(run, f"conv_id {kind}, {_READ}")


def oracle(conversations: str) -> str:
    """SQL of ``read_back`` over ``formatted``; conversations: a relation with the turns."""

    def guarded(column: str) -> str:
        return f"replace(replace(replace({column}, '\\', '\\\\'), '{START}', '\\{START}'), '{STOP}', '\\{STOP}')"

    return f"""
    WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {conversations}),
    said AS (
        SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS told,
            length(replace({guarded("role")}, chr(10), '\\' || chr(10))) + length({guarded("text")}) + {len(START + STOP) + 2} AS chars
        FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(sum(length(told)) AS BIGINT) AS loss_chars,
        sha256(string_agg(told, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
        CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM said GROUP BY conv_id
    """


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
