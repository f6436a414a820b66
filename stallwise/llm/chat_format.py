r"""Chat formatting with schema fingerprints.

Records come in many layouts: prompt and answer, instruction and input, message
lists, one row per turn. A record's fingerprint is a hash of its nested field paths
(positions in lists count as one). A registry maps fingerprints to declarative
mappings, lists of (role, path) that say where turns are; a record whose layout is
not registered is reported, never guessed.

The template writes a turn as ``### role: text</turn>\n``. Control strings in texts
are escaped, reversibly: a backslash becomes ``\\``, ``###`` becomes ``\h`` and
``</turn>`` becomes ``\e``; in roles a colon becomes ``\c`` as well. So no text can
open or close a turn, and ``parse`` returns exactly what was written. The loss mask
covers the escaped texts of the trained roles.

Scale: formatting is per turn, map-side. The output has one row per turn with its
place in the conversation, so a conversation with a third of all turns is never one
value; readers stream turns in order. One shuffle brings turns into conversations.

Defined results: null texts and roles are empty; turns are ordered by their number,
null first, then by role and text; repeated rows are repeated turns; turns with a
null conversation form one conversation with a null id; a record that is null, not
an object, or of an unknown layout is in ``unknown_layouts``; empty tables give
empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\e", ":": "\\c"}
UNESCAPE = {"\\": "\\", "h": "###", "e": "</turn>", "c": ":"}
IN_TEXT = re.compile(r"\\|###|</turn>")
IN_ROLE = re.compile(r"\\|###|</turn>|:")
ESCAPED = re.compile(r"\\([\\hec])")
OPEN, BETWEEN, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: str, pattern: re.Pattern = IN_TEXT) -> str:
    return pattern.sub(lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: UNESCAPE[m[1]], text)


def field_paths(value, path: str = "") -> set[str]:
    """Nested field paths of a parsed record; list positions are ``[]``."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in field_paths(v, f"{path}.{json.dumps(k)}")} or {path + "{}"}
    if isinstance(value, list):
        return {p for v in value for p in field_paths(v, path + "[]")} or {path + "[]"}
    return {path}


def fingerprint(record) -> str:
    return hashlib.sha256("\n".join(sorted(field_paths(record))).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout are.

    ``turns`` are (role, path) in order. A path is field names joined by dots; one
    that ends in ``[]`` names a list of messages, and then ``role`` and ``text`` are
    the fields of a message. A role that starts with ``@`` is read from that field.
    ``order`` names the field that holds the turn's number in one-row-per-turn layouts.
    """

    turns: tuple[tuple[str, str], ...]
    role: str = "role"
    text: str = "content"
    order: str | None = None
    # Role names of the layout, where they are not the canonical ones.
    roles: tuple[tuple[str, str], ...] = ()


def _at(record, path: str):
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def turns_of(record: dict, mapping: Mapping) -> list[tuple[int | None, str, str]]:
    """Canonical (number, role, text) of a record."""
    rename, out = dict(mapping.roles), []
    number = _at(record, mapping.order) if mapping.order else None
    for role, path in mapping.turns:
        if path.endswith("[]"):
            for message in _at(record, path[:-2]) or []:
                said, text = _at(message, mapping.role), _at(message, mapping.text)
                out.append((rename.get(said, said), text))
        else:
            said = _at(record, role[1:]) if role.startswith("@") else role
            out.append((rename.get(said, said), _at(record, path)))
    place = (lambda i: number) if mapping.order else (lambda i: i)
    return [(place(i), role or "", text or "") for i, (role, text) in enumerate(out)]


def example(layout: dict | list) -> str:
    """Fingerprint of an example record: how registries are written."""
    return fingerprint(layout)


_MESSAGE = {"role": "", "content": ""}
_SHARE = (("human", "user"), ("gpt", "assistant"))
#: Layouts known out of the box, by the fingerprint of an example.
REGISTRY: dict[str, Mapping] = {
    example({"prompt": "", "completion": ""}): Mapping((("user", "prompt"), ("assistant", "completion"))),
    example({"prompt": "", "response": ""}): Mapping((("user", "prompt"), ("assistant", "response"))),
    example({"question": "", "answer": ""}): Mapping((("user", "question"), ("assistant", "answer"))),
    example({"system": "", "prompt": "", "response": ""}): Mapping((("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    example({"instruction": "", "output": ""}): Mapping((("user", "instruction"), ("assistant", "output"))),
    example({"instruction": "", "input": "", "output": ""}): Mapping((("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    example({"messages": [_MESSAGE]}): Mapping((("", "messages[]"),)),
    example({"data": {"messages": [_MESSAGE]}}): Mapping((("", "data.messages[]"),)),
    example({"system": "", "messages": [_MESSAGE]}): Mapping((("system", "system"), ("", "messages[]"))),
    example({"conversations": [{"from": "", "value": ""}]}): Mapping((("", "conversations[]"),), "from", "value", None, _SHARE),
    example({"turn": 0, "role": "", "text": ""}): Mapping((("@role", "text"),), order="turn"),
}


def _parsed(text: str | None):
    try:
        return json.loads(text) if text is not None else None
    except ValueError:
        return None


def _canonical(batches: Iterator[pd.DataFrame], registry: dict[str, Mapping]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for conv, text in zip(batch["conv"], batch["record"]):
            record = _parsed(text)
            print_ = fingerprint(record) if isinstance(record, dict) else None
            mapping = registry.get(print_)
            if mapping is None:
                rows.append((conv, None, None, None, print_, False))
            else:
                rows += [(conv, n, role, said, print_, True) for n, role, said in turns_of(record, mapping)]
        yield pd.DataFrame(rows, columns=["conv", "turn", "role", "text", "fingerprint", "known"]).astype({"conv": object, "turn": object})


def canonical_turns(records: DataFrame, id: str, record: str, registry: dict[str, Mapping] | None = None) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text``, ``fingerprint``, ``known`` from records as JSON text.

    A record of an unknown layout gives one row with ``known`` false.
    """
    table = records.select(F.col(id).cast("string").alias("conv"), F.col(record).alias("record"))
    kind = records.schema[id].dataType
    own = REGISTRY if registry is None else registry
    found = table.mapInPandas(
        lambda batches: _canonical(batches, own),
        "conv string, turn long, role string, text string, fingerprint string, known boolean",
    )
    return found.withColumn("conv", F.col("conv").cast(kind))


def unknown_layouts(turns: DataFrame) -> DataFrame:
    """Fingerprints without a mapping, with their number of records."""
    return turns.where("NOT known").groupBy("fingerprint").agg(F.expr("count(1) AS records"))


def _segments(batches: Iterator[pa.RecordBatch], trained: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """Formatted turns: the segment, and where its loss begins and ends (-1: none)."""
    for batch in batches:
        segments, begins, ends = [], [], []
        for role, text in zip(batch["role"].to_pylist(), batch["text"].to_pylist()):
            head = OPEN + escape(role, IN_ROLE) + BETWEEN
            body = escape(text)
            segments.append(head + body + CLOSE)
            begins.append(len(head) if role in trained else -1)
            ends.append(len(head) + len(body) if role in trained else -1)
        columns = [batch["conv"], batch["place"], pa.array(segments, pa.string()), pa.array(begins, pa.int32()), pa.array(ends, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "place", "segment", "loss_begin", "loss_end"])


def formatted(turns: DataFrame, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn: ``conv``, ``place`` from 0, ``segment``, ``loss_begin``, ``loss_end``.

    The segments of a conversation in order are its training text; the loss span
    counts code points inside the segment.
    """
    known = turns.where("known").selectExpr("conv", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text")
    place = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text")) - 1
    ordered = known.withColumn("place", place.cast("long"))
    kind = turns.schema["conv"].dataType.simpleString()
    roles = frozenset(trained)
    return ordered.select("conv", "place", "role", "text").mapInArrow(
        lambda batches: _segments(batches, roles),
        f"conv {kind}, place long, segment string, loss_begin int, loss_end int",
    )


def parse(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    role, _, rest = segment.removeprefix(OPEN).partition(":")
    return unescape(role), unescape(rest[1 : -len(CLOSE)])


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, begin: int, end: int) -> None:
        role, text = parse(segment)
        self.turns += 1
        self.chars += len(segment)
        self.said.update(f"{role}\n{text}\n".encode())
        if begin >= 0:
            trained = unescape(segment[begin:end])
            self.loss_chars += len(trained)
            self.loss.update(trained.encode())

    def row(self) -> tuple:
        return self.conv, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Conversations are consecutive; one is held at a time, as running digests."""
    now: _Digest | None = None
    for batch in batches:
        done = []
        for conv, segment, begin, end in zip(*(batch[n].to_pylist() for n in ("conv", "segment", "loss_begin", "loss_end"))):
            if now is None or now.conv != conv:
                done += [now.row()] if now else []
                now = _Digest(conv)
            now.add(segment, begin, end)
        if done:
            yield _rows(done, schema)
    if now:
        yield _rows([now.row()], schema)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, read from formatted turns: counts and digests of all and of trained text."""
    kind = segments.schema["conv"].dataType.simpleString()
    ddl = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    arrow = to_arrow_schema(T.StructType.fromDDL(ddl))
    ordered = segments.repartition("conv").sortWithinPartitions("conv", "place")
    return ordered.select("conv", "segment", "loss_begin", "loss_end").mapInArrow(lambda batches: _digests(batches, arrow), ddl)
