"""Whole texts as byte arrays: words, hashes and windows of many documents at once.

A slice of an Arrow batch is one array of UTF-8 bytes with the bounds of its rows. Words, word
hashes and n-grams are computed for all rows of the slice together; no row is cut. Null counts
as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

SLICE_BYTES = 1 << 21

# The two kinds of words in the contracts, as tables over the byte values. Bytes
# of characters outside ASCII are word bytes in both.
ALNUM = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
VISIBLE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)

UPPER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_LETTERS = UPPER_LETTERS.lower()
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Carried:
    """A text column and, packed into one column, all others: no name of a table can clash with
    the names used in between."""

    def __init__(self, docs: DataFrame, text: str, replaced: tuple[str, ...], keep_text: bool = False, **more: str):
        self.rest = [c for c in docs.columns if c not in replaced and (keep_text or c != text)]
        packed = F.struct(*[docs[f"`{c}`"] for c in self.rest]) if self.rest else F.lit(None).cast("boolean")
        named = [docs[f"`{c}`"].alias(name) for name, c in more.items()]
        self.frame = docs.select(docs[f"`{text}`"].alias("text"), packed.alias("rest"), *named)

    def run(self, function, added: dict[str, str], frame: DataFrame | None = None) -> DataFrame:
        """Apply a function on Arrow batches that gives back ``rest`` and the added columns."""
        frame = self.frame if frame is None else frame
        schema = StructType().add("rest", frame.schema["rest"].dataType)
        for place, kind in enumerate(added.values()):
            schema = schema.add(f"added{place}", DataType.fromDDL(kind))
        out = frame.mapInArrow(function, schema)
        return out.select(
            *[out["rest"].getField(c).alias(c) for c in self.rest],
            *[out[f"added{place}"].alias(name) for place, name in enumerate(added)],
        )


def added(rest: pa.Array, *columns: pa.Array) -> pa.RecordBatch:
    """A batch in the form that ``Carried.run`` expects."""
    return pa.RecordBatch.from_arrays([rest, *columns], ["rest", *[f"added{i}" for i in range(len(columns))]])


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of whole rows with about ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(size, dtype=np.int64) // limit
        at = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1, [batch.num_rows]])
        for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
            yield batch.slice(start, end - start)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all rows end to end, n + 1 row bounds)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end of every word; index of the first word of each row, n + 1 values)."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = inside[1:] != inside[:-1]
    cut |= edge
    starts = np.flatnonzero(cut[:-1] & inside)
    ends = np.flatnonzero(cut[1:] & inside) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of every line, in order; an empty row is one empty line."""
    newline = np.flatnonzero(data == 0x0A)
    begin = np.concatenate([bounds[:-1], newline + 1])
    row = np.concatenate([np.arange(len(bounds) - 1), np.searchsorted(bounds, newline, side="right") - 1])
    order = np.lexsort((begin, row))
    begin, row = begin[order], row[order]
    end = np.empty(len(begin), np.int64)
    end[:-1] = np.where(row[1:] == row[:-1], begin[1:] - 1, bounds[1:][row[:-1]])
    if len(end):
        end[-1] = bounds[-1]
    return row, begin, end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def eight_bytes(data: np.ndarray) -> np.ndarray:
    """The 64-bit little-endian value that begins at each byte; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    view, left = eight_bytes(data), ends - starts
    out = mix(left.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    at, active = starts, np.arange(len(starts))
    while len(active):
        part = view[at] & _KEEP[np.minimum(left, 8)]
        out[active] = mix(out[active] ^ part) + part
        more = left > 8
        at, left, active = at[more] + 8, left[more] - 8, active[more]
    return out


def grams(values: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n consecutive values (len - n + 1 of them)."""
    count = max(len(values) - n + 1, 0)
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out = mix(out + values[i : i + count])
    return out


def same_row(first: np.ndarray, n: int) -> np.ndarray:
    """For each run of n words that begins at a word: does it end in the same row?"""
    total = int(first[-1])
    ok = np.ones(max(total - n + 1, 0), bool)
    for back in range(1, n):
        at = first[1:] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    # Rows shorter than n mark positions of earlier rows as well, which also end too late.
    return ok


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values of each row (first: n + 1 bounds)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
