"""Conversations as training texts, by a compiled template, and what a reader finds in them.

Turns are range-partitioned by conversation and turn and streamed in that order, so a
conversation that holds a large part of all rows is rendered by many tasks. A
task knows its neighbours except for its first and last row: these go on as they
are, two a task, and are rendered once the ends of all tasks lie side by side.
Texts come out in segments of whole turns, each with its loss mask.

The reader streams segments in order and holds one at a time. A digest of a
whole conversation is sequential by nature, so its segments pass one task there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millwright.workspace import stage

from .templates import Compiled, Controls, Turn, Written

# The control strings and the template of this layout.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ANS]", "[/ANS]", "[TURN]", "[AS]", "[/TURN]")
TEMPLATE = """
{%- for turn in turns -%}
  {% if loop.first %}{{ bos }}{% endif %}
  {%- if turn.role == 'user' -%}
    [INST]{{ turn.text | escape }}[/INST]
  {%- elif turn.role == 'assistant' -%}
    [ANS]{% generation %}{{ turn.text | escape }}{% endgeneration %}[/ANS]
  {%- else -%}
    [TURN]{{ turn.role | escape }}[AS]{{ turn.text | escape }}[/TURN]
  {%- endif -%}
  {% if loop.last %}{{ eos }}{% endif %}
{%- endfor -%}
"""
TOKENS = {"bos": "<s>", "eos": "</s>"}

SEGMENT_CHARS = 1 << 18  # a segment ends after the turn that reaches this
ROWS = 4096  # rows of an output batch

_SEGMENT = "part int, segment int, turns int, text string, loss array<struct<start:bigint,stop:bigint>>"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_SEGMENT_FIELDS = [("part", pa.int32()), ("segment", pa.int32()), ("turns", pa.int32()), ("text", pa.string()), ("loss", _LOSS)]
_END = "role string, first boolean, last boolean"
_END_FIELDS = [("role", pa.string()), ("first", pa.bool_()), ("last", pa.bool_())]
_READ = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_READ_FIELDS = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
_TURN = re.compile(r"\[INST\](.*?)\[/INST\]|\[ANS\](.*?)\[/ANS\]|\[TURN\](.*?)\[AS\](.*?)\[/TURN\]", re.DOTALL)


def default_template() -> Compiled:
    return Compiled(TEMPLATE, Controls(CONTROLS), TOKENS)


class _Rows:
    """Output rows held until they make a batch."""

    def __init__(self, conv_type: pa.DataType, fields: list[tuple[str, pa.DataType]]) -> None:
        self.schema, self.rows, self.size = pa.schema([("conv_id", conv_type), *fields]), [], 0

    def add(self, row: tuple, size: int) -> None:
        self.rows.append(row)
        self.size += size

    def full(self) -> bool:
        return len(self.rows) >= ROWS or self.size >= 16 * SEGMENT_CHARS

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(self.schema)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def _stream(first: pa.RecordBatch, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in chain([first], batches):
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _loss(out: Written) -> list[dict[str, int]]:
    return [{"start": a, "stop": z} for a, z in out.generated]


def _rendered(ordered: DataFrame, template: Compiled) -> DataFrame:
    """Segments, and as they are the first and the last row of each task, whose neighbours are not known there.

    Such a row has its role and its text, and in `first` and `last` what the task knows of it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is None:
            return
        part = TaskContext.get().partitionId()
        done = _Rows(batch.column(0).type, _SEGMENT_FIELDS + _END_FIELDS)
        rows = _stream(batch, batches)
        before, here = None, next(rows, None)
        number, turns, out = 0, 0, Written()
        while here is not None:
            after = next(rows, None)
            conv, role, text = here
            first = None if before is None else before[0] != conv
            last = None if after is None else after[0] != conv
            if turns and (first or last is None or out.size >= SEGMENT_CHARS):
                done.add((before[0], part, number, turns, "".join(out.pieces), _loss(out), None, None, None), out.size)
                number, turns, out = number + 1, 0, Written()
            if first is None or last is None:
                done.add((conv, part, number, 1, text, None, role, first, last), len(text))
                number += 1
            else:
                template.render(Turn(role, text, first, last), out)
                turns += 1
            if done.full():
                yield done.batch()
            before, here = here, after
        yield done.batch()

    kind = ordered.schema["conv_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"conv_id {kind}, {_SEGMENT}, {_END}")


def _rendered_ends(ends: DataFrame, template: Compiled) -> DataFrame:
    """The ends of all tasks, at most two rows each, as segments of one turn.

    Side by side they show whether a conversation goes on in the next task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = _Rows(batch.column(0).type, _SEGMENT_FIELDS)
            for conv, part, segment, role, text, first, last in _stream(batch, iter(())):
                out = Written()
                template.render(Turn(role, text, first, last), out)
                done.add((conv, part, segment, 1, "".join(out.pieces), _loss(out)), out.size)
            yield done.batch()

    kind = ends.schema["conv_id"].dataType.simpleString()
    by_place = W.orderBy("part", "segment")

    def differs(other: Column) -> Column:
        return other.isNull() | ~other["conv_id"].eqNullSafe(F.col("conv_id"))

    id_struct = F.struct("conv_id")
    flags = ends.select(
        F.col("part").alias("own_part"), F.col("segment").alias("own_segment"),
        F.coalesce("first", differs(F.lag(id_struct).over(by_place))).alias("opens"),
        F.coalesce("last", differs(F.lead(id_struct).over(by_place))).alias("closes"),
    )
    known = ends.join(flags, (F.col("part") == F.col("own_part")) & (F.col("segment") == F.col("own_segment")))
    rows = known.select("conv_id", "part", "segment", "role", "text", "opens", "closes")
    return rows.mapInArrow(run, f"conv_id {kind}, {_SEGMENT}")


def format_conversations(conversations: DataFrame, template: Compiled | None = None) -> DataFrame:
    """conv_id, part, segment, turns, text, loss: the rendered conversations in segments of whole turns.

    By (part, segment) the segments of a conversation follow each other; `loss` has the
    stretches of a segment's text that a model is to generate, in code points.
    Turns go by `turn`, then role, then a hash of the text where that repeats; null turns come
    first, null roles and texts are empty, and a null conv_id is an id like any
    other. Rows alike are turns of their own. A very long turn is a segment of
    its own or ends one. An empty table gives no rows. Other columns are not read.
    """
    spark, template = conversations.sparkSession, template or default_template()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # The salt splits rows that are alike, between which any order will do; texts are
    # compared by hash first, so that long ones do not end up among the range bounds.
    order = ["conv_id", "turn", "role", F.xxhash64("text")]
    ordered = rows.repartitionByRange(parts, *order, F.rand(1)).sortWithinPartitions(*order, "text")
    rendered = stage(_rendered(ordered.select("conv_id", "role", "text"), template))
    is_end = F.col("role").isNotNull()
    segments = rendered.filter(~is_end).drop("role", "first", "last")
    return segments.unionByName(_rendered_ends(rendered.filter(is_end), template))


class _Reader:
    """Digests of one conversation, a segment at a time."""

    def __init__(self, controls: Controls) -> None:
        self.controls = controls
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, stretches: list[dict[str, int]], turns: int) -> None:
        before = self.turns
        for m in _TURN.finditer(text):
            user, assistant, role, other = m.groups()
            role, body = ("user", user) if user is not None else ("assistant", assistant) if assistant is not None else (role, other)
            self.all.update(f"{self.controls.unescape(role)}\n{self.controls.unescape(body)}\n".encode())
            self.turns += 1
        if self.turns - before != turns:
            raise ValueError(f"{turns} turns were written, {self.turns - before} are found")
        for stretch in stretches:
            learned = self.controls.unescape(text[stretch["start"] : stretch["stop"]])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(segments: DataFrame, controls: Controls | None = None) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars: what the default layout's texts say.

    Turns are found by their control strings and loss texts by the mask; both are
    unescaped. Segments of a conversation are streamed in order.
    """
    controls = controls or Controls(CONTROLS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = next(batches, None)
        if batch is None:
            return
        done, reader, current = _Rows(batch.column(0).type, _READ_FIELDS), None, None
        for conv, text, stretches, turns in _stream(batch, batches):
            if reader is None or conv != current:
                if reader is not None:
                    done.add((current, *reader.row()), 0)
                reader, current = _Reader(controls), conv
            reader.read(text, stretches, turns)
            if done.full():
                yield done.batch()
        if reader is not None:
            done.add((current, *reader.row()), 0)
        yield done.batch()

    kind = segments.schema["conv_id"].dataType.simpleString()
    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")
    return ordered.select("conv_id", "text", "loss", "turns").mapInArrow(run, f"conv_id {kind}, {_READ}")
