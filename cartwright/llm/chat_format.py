"""Conversations as text for training, with the spans that count for the loss.

A turn becomes ``### role: text </turn>`` and a line end. Where a control string (``###``,
``</turn>``) stands inside a role or a text, a backslash goes behind its first byte, and a
backslash is doubled; in roles a colon before a blank is parted in the same way. So a control
string in the output is always the template's own, and ``read_back`` gives back every role and
text as it was.

The rows of the table are dealt by ranges of conversation and turn, so a conversation of any
number of rows is spread over tasks. A task takes its rows in slices and lays out each slice as one buffer:
lengths of all segments, offsets by running sums, and for each byte the place where it goes; the
strings of the result are stretches of that buffer. A conversation of more than ``part_bytes``, or one that runs from
one task into the next, comes in several parts. ``part`` orders them, and their texts end to end
are the conversation; ``split`` marks rows that may not be the only part.

Defined cases: null text and null role are empty; null turns come first, equal turns by role and
text; rows with a null conversation id are one conversation; repeated rows are turns of their
own; no rows give no rows. Only the named columns are read, so other columns cannot clash. Texts of any length
are laid out whole, in pieces of ``PIECE`` bytes as far as memory for places goes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm import text as t


@dataclass(frozen=True)
class Template:
    """Strings around role and text. Those of ``control`` stand nowhere else in the output."""

    head: str = "### "
    colon: str = ": "
    tail: str = " </turn>\n"
    control: tuple[str, ...] = ("###", "</turn>")
    trained: str = "assistant"


PART_BYTES, PART_ROWS = 1 << 20, 1 << 16
PIECE = 1 << 20
_BACKSLASH = 0x5C


def _marks(data: np.ndarray, bounds: np.ndarray, strings: tuple[str, ...], plain: bool) -> np.ndarray:
    """The bytes that get a backslash in front: the second byte of each of the strings inside a row,
    and (``plain``) each backslash."""
    out = data == _BACKSLASH if plain else np.zeros(len(data), bool)
    for text in strings:
        key = text.encode()
        at = np.flatnonzero(data[: len(data) - len(key) + 1] == key[0]) if len(data) >= len(key) else np.zeros(0, np.int64)
        for i, byte in enumerate(key[1:], 1):
            at = at[data[at + i] == byte]
        end = bounds[np.searchsorted(bounds, at, side="right")]
        out[at[at + len(key) <= end] + 1] = True
    return out


def _place(out: np.ndarray, data: np.ndarray, bounds: np.ndarray, marks: np.ndarray, begin: np.ndarray) -> None:
    """Copy rows to where they begin, with a backslash before each marked byte."""
    extra = 0
    # The marks of earlier rows are in ``begin`` already.
    shift = begin - bounds[:-1] - _row_marks(marks, bounds)[0]
    for a in range(0, len(data), PIECE):
        b = min(a + PIECE, len(data))
        low, high = np.searchsorted(bounds, a, side="right") - 1, np.searchsorted(bounds, b, side="left")
        held = np.minimum(bounds[low + 1 : high + 1], b) - np.maximum(bounds[low:high], a)
        more = np.cumsum(marks[a:b]) + extra
        to = np.arange(a, b) + np.repeat(shift[low:high], held) + more
        out[to] = data[a:b]
        out[to[marks[a:b]] - 1] = _BACKSLASH
        extra = int(more[-1])


def _row_marks(marks: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marks before each row, marks in it)."""
    places = np.flatnonzero(marks)
    before = np.searchsorted(places, bounds)
    return before[:-1], np.diff(before)


def _fixed(out: np.ndarray, text: str, begin: np.ndarray) -> None:
    key = np.frombuffer(text.encode(), np.uint8)
    out[begin[:, None] + np.arange(len(key))] = key


def lay_out(role: pa.Array, text: pa.Array, template: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all turns end to end, n + 1 bounds, begin and end of each escaped text)."""
    roles, r_bounds = t.flat(role)
    texts, t_bounds = t.flat(text)
    r_marks = _marks(roles, r_bounds, (*template.control, template.colon), True)
    t_marks = _marks(texts, t_bounds, template.control, True)
    n = len(role)
    widths = [
        np.full(n, len(template.head.encode())),
        np.diff(r_bounds) + _row_marks(r_marks, r_bounds)[1],
        np.full(n, len(template.colon.encode())),
        np.diff(t_bounds) + _row_marks(t_marks, t_bounds)[1],
        np.full(n, len(template.tail.encode())),
    ]
    ends = np.cumsum(np.stack(widths, axis=1).ravel()).reshape(n, 5)
    begins = ends - np.stack(widths, axis=1)
    out = np.empty(int(ends[-1, -1]) if n else 0, np.uint8)
    for place, fixed in ((0, template.head), (2, template.colon), (4, template.tail)):
        _fixed(out, fixed, begins[:, place])
    _place(out, roles, r_bounds, r_marks, begins[:, 1])
    _place(out, texts, t_bounds, t_marks, begins[:, 3])
    return out, np.append(begins[:, 0], len(out)), begins[:, 3], ends[:, 3]


FORMATTED = "part long, split boolean, text string, n_turns long, loss_begin array<long>, loss_end array<long>"


def format_conversations(
    rows: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: Template = Template(),
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(id, part, split, text, n_turns, loss_begin, loss_end): the spans are byte offsets in the
    part's text of what turns of the trained role say."""
    read = rows.select(
        F.col(f"`{id}`").alias("id"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    # Ranges are told apart by a prefix of the order, so equal turns of one conversation spread as well.
    dealt = read.repartitionByRange("id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = TaskContext.get().partitionId() << 32, None
        for piece, whole in _conversations(batches, part_bytes):
            ids = piece.column("id")
            data, bounds, begin, end = lay_out(piece.column("role"), piece.column("text"), template)
            first = np.flatnonzero(_changed(ids))
            cut = np.append(first, piece.num_rows)
            trained = pc.equal(piece.column("role"), template.trained).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(trained)
            of = np.searchsorted(first, at, side="right") - 1
            base = bounds[first]
            to = np.searchsorted(at, cut)
            texts = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds[cut].astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
            spans = [pa.ListArray.from_arrays(pa.array(to, pa.int32()), pa.array(x[at] - base[of])) for x in (begin, end)]
            split = np.zeros(len(first), bool)
            # The first and the last conversation of a task may go on in another one.
            split[0] |= last is None or not whole[0]
            split[-1] |= not whole[1]
            columns = [ids.take(pa.array(first)), pa.array(number + np.arange(len(first))), pa.array(split), texts]
            last, number = True, number + len(first)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(cut)), *spans], ["id", *(x.split()[0] for x in FORMATTED.split(", "))])

    schema = f"id {read.schema['id'].dataType.simpleString()}, {FORMATTED}"
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", id)


def _changed(ids: pa.Array) -> np.ndarray:
    """Where a conversation begins; nulls are equal."""
    if len(ids) < 2:
        return np.ones(len(ids), bool)
    same = pc.fill_null(pc.equal(ids[1:], ids[:-1]), False)
    both = pc.and_(pc.is_null(ids[1:]), pc.is_null(ids[:-1]))
    return np.append(True, ~pc.or_(same, both).to_numpy(zero_copy_only=False))


def _conversations(batches: Iterator[pa.RecordBatch], part_bytes: int) -> Iterator[tuple[pa.RecordBatch, tuple[bool, bool]]]:
    """Runs of rows that end where a conversation ends, and whether the first and the last
    conversation of the run are whole in it as far as this task goes. Only a conversation larger
    than a part is cut, between two rows."""
    held: pa.RecordBatch | None = None
    continued = False
    for part in t.slices(batches, "text", part_bytes):
        rows = part if held is None else pa.Table.from_batches([held, part]).combine_chunks().to_batches()[0]
        start = int(np.flatnonzero(_changed(rows.column("id")))[-1])
        if start:
            yield rows.slice(0, start), (not continued, True)
            continued, held = False, rows.slice(start)
        else:
            held = rows
        if held.num_rows >= PART_ROWS or pc.sum(pc.binary_length(held.column("text"))).as_py() >= part_bytes:
            yield held, (not continued, False)
            continued, held = True, None
    if held is not None:
        yield held, (False, False)


def _bare(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows without their escapes: of each run of backslashes, every other one from the first."""
    at = np.flatnonzero(data == _BACKSLASH)
    gone = np.zeros(len(data), bool)
    if len(at):
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        new = np.append(True, np.diff(at) != 1) | edge[at]
        begin = at[np.flatnonzero(new)][np.cumsum(new) - 1]
        gone[at[(at - begin) % 2 == 0]] = True
    lost = np.searchsorted(np.flatnonzero(gone), bounds)
    return data[~gone], bounds - lost


def _parted(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of some spans end to end, n + 1 bounds)."""
    size = end - begin
    bounds = np.concatenate([[0], np.cumsum(size)])
    return data[np.arange(bounds[-1]) + np.repeat(begin - bounds[:-1], size)], bounds


def _places(data: np.ndarray, text: str) -> np.ndarray:
    key = text.encode()
    at = np.flatnonzero(data[: max(len(data) - len(key) + 1, 0)] == key[0])
    for i, byte in enumerate(key[1:], 1):
        at = at[data[at + i] == byte]
    return at


def turns(column: pa.Array, template: Template = Template()) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(roles, texts, n + 1 bounds of the turns of each row) of formatted texts."""
    data, bounds = t.flat(column)
    tail, head, colon = template.tail.encode(), template.head.encode(), template.colon.encode()
    end = _places(data, template.tail)
    begin = np.append(0, end + len(tail))[:-1] if len(end) else end
    colons = _places(data, template.colon)
    role_end = colons[np.searchsorted(colons, begin + len(head))] if len(end) else end
    found = []
    for a, b in ((begin + len(head), role_end), (role_end + len(colon), end)):
        body, cut = _bare(*_parted(data, a, b))
        found.append(pa.LargeStringArray.from_buffers(len(a), pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(body)))
    return found[0], found[1], np.searchsorted(begin, bounds)


_SPANS = ("loss_begin", "loss_end")
_DIGESTS = {
    "n_turns": (pa.int64(), "long"),
    "turns_sha256": (pa.string(), "string"),
    "loss_chars": (pa.int64(), "long"),
    "loss_sha256": (pa.string(), "string"),
    "formatted_chars": (pa.int64(), "long"),
}
_RAW = {"part": pa.int64(), "text": pa.string(), **{c: pa.list_(pa.int64()) for c in _SPANS}}
_NAMES = ["id", *_RAW, *_DIGESTS]


def read_back(parts: DataFrame, id: str = "conv_id", template: Template = Template()) -> DataFrame:
    """Per conversation, from the formatted texts alone: n_turns, turns_sha256 (role, line end, text,
    line end of every turn), loss_chars and loss_sha256 (the texts under the loss spans),
    formatted_chars. Whole conversations are read where they are; only those in several parts are
    brought together, in order, and read as a stream."""

    def where_they_are(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in t.slices(iter([batch]), "text"):
                split = some.column("split")
                yield _raw(some.filter(split))
                whole = some.filter(pc.invert(split))
                said = _Said(whole, template)
                yield _done(whole.column("id"), [said.feed(_Reading(), i) for i in range(whole.num_rows)])

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, reading = None, None
        for batch in batches:
            done = pc.is_valid(batch.column("n_turns"))
            yield batch.filter(done)
            for some in t.slices(iter([batch.filter(pc.invert(done))]), "text"):
                said = _Said(some, template)
                for i in range(some.num_rows):
                    here = some.column("id")[i : i + 1]
                    if reading is None or here[0] != ids[0]:
                        if reading is not None:
                            yield _done(ids, [reading])
                        ids, reading = here, _Reading()
                    said.feed(reading, i)
        if reading is not None:
            yield _done(ids, [reading])

    read = parts.select(F.col(f"`{id}`").alias("id"), "part", "split", "text", *_SPANS)
    schema = read.drop("split").schema
    for name, (_, kind) in _DIGESTS.items():
        schema = schema.add(name, kind)
    together = read.mapInArrow(where_they_are, schema).repartition("id").sortWithinPartitions("id", "part")
    return together.mapInArrow(in_order, schema).select(F.col("id").alias(id), *_DIGESTS)


def _raw(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Parts as they are, without digests."""
    none = [pa.nulls(rows.num_rows, kind) for kind, _ in _DIGESTS.values()]
    return pa.RecordBatch.from_arrays([rows.column("id"), *(rows.column(c) for c in _RAW), *none], _NAMES)


def _done(ids: pa.Array, found: list["_Reading"]) -> pa.RecordBatch:
    """Digests without the texts."""
    none = [pa.nulls(len(found), kind) for kind in _RAW.values()]
    values = zip(*(x.row() for x in found)) if found else [()] * len(_DIGESTS)
    return pa.RecordBatch.from_arrays([ids, *none, *(pa.array(v, kind) for v, (kind, _) in zip(values, _DIGESTS.values()))], _NAMES)


class _Reading:
    """Digests of one conversation, fed part by part."""

    def __init__(self):
        self.n, self.chars, self.formatted = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self) -> tuple:
        return self.n, self.all.hexdigest(), self.chars, self.loss.hexdigest(), self.formatted


class _Said:
    """What the rows of a slice hold: turns as (role, line end, text, line end), and the texts under the spans."""

    def __init__(self, part: pa.RecordBatch, template: Template):
        roles, texts, self.cut = turns(part.column("text"), template)
        lines = pc.binary_join_element_wise(roles, texts, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string()))
        self.turns, self.turn_bounds = t.flat(lines)
        data, bounds = t.flat(part.column("text"))
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.formatted = chars[bounds[1:]] - chars[bounds[:-1]]
        begins, ends = (part.column(c) for c in _SPANS)
        count = pc.fill_null(pc.list_value_length(begins), 0).to_numpy(zero_copy_only=False)
        base = np.repeat(bounds[:-1], count)
        a, b = (x.flatten().to_numpy(zero_copy_only=False) + base for x in (begins, ends))
        self.loss, inside = _bare(*_parted(data, a, b))
        self.loss_bounds = inside[np.concatenate([[0], np.cumsum(count)])]
        self.loss_chars = np.concatenate([[0], np.cumsum((self.loss & 0xC0) != 0x80)])

    def feed(self, one: _Reading, i: int) -> _Reading:
        a, b = self.turn_bounds[self.cut[i]], self.turn_bounds[self.cut[i + 1]]
        one.n += int(self.cut[i + 1] - self.cut[i])
        one.all.update(self.turns[a:b].data)
        a, b = self.loss_bounds[i], self.loss_bounds[i + 1]
        one.loss.update(self.loss[a:b].data)
        one.chars += int(self.loss_chars[b] - self.loss_chars[a])
        one.formatted += int(self.formatted[i])
        return one
