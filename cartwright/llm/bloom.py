"""Bloom filters of 64-bit hashes, built by tasks and merged block by block.

A filter has a fixed number of bits, which bounds what reaches the driver and what is sent to
the workers. A filter that is too small for its keys only lets more keys through: every caller
confirms what passes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwright.llm.text import mix

BLOCK_BITS = 1 << 16
SETTLE = 1 << 20


def positions(hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """(probes, n) bit positions; bits is a power of two, 2^32 at most."""
    h = mix(hashes.astype(np.uint64))
    step = mix(h + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(probes)]).astype(np.int64)


def _packed(at: np.ndarray) -> bytes:
    """A block of bits: 16-bit positions while they are few, else all bits."""
    if len(at) * 16 < BLOCK_BITS:
        return b"s" + at.astype(np.uint16).tobytes()
    marks = np.zeros(BLOCK_BITS, bool)
    marks[at] = True
    return b"d" + np.packbits(marks).tobytes()


def _unpacked(block: bytes) -> np.ndarray:
    if block[:1] == b"d":
        return np.unpackbits(np.frombuffer(block, np.uint8, offset=1)).astype(bool)
    marks = np.zeros(BLOCK_BITS, bool)
    marks[np.frombuffer(block, np.uint16, offset=1)] = True
    return marks


def _first_column(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def _task_blocks(bits: int, probes: int, twice: bool, hashes_of: Callable = _first_column) -> Callable:
    """The blocks of one task's filters. The bits are held as sorted positions, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        fresh: list[np.ndarray] = []

        def settle() -> None:
            nonlocal seen, again
            at = np.sort(np.concatenate([seen, *fresh]))
            more = at[1:][at[1:] == at[:-1]] if twice else again
            again = np.union1d(again, more)
            seen = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
            fresh.clear()

        for batch in batches:
            for hashes in hashes_of(batch):
                fresh.append(positions(hashes, bits, probes).astype(np.uint32).ravel())
                if sum(map(len, fresh)) > max(SETTLE, len(seen) // 2):
                    settle()
        settle()
        block, at = np.unique(seen >> np.uint32(16), return_index=True)
        ends = np.concatenate([at[1:], [len(seen)]])
        low, high = np.searchsorted(again >> np.uint32(16), block), np.searchsorted(again >> np.uint32(16), block, side="right")
        for some in range(0, len(block), 256):
            part = range(some, min(some + 256, len(block)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block[part.start : part.stop].astype(np.int32)),
                    pa.array([_packed(seen[at[i] : ends[i]] & np.uint32(BLOCK_BITS - 1)) for i in part], pa.binary()),
                    pa.array([_packed(again[low[i] : high[i]] & np.uint32(BLOCK_BITS - 1)) for i in part], pa.binary()),
                ],
                ["block", "seen", "again"],
            )

    return run


def _merged_blocks(twice: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows come sorted by block; one block is held at a time."""
        now, seen, again = None, None, None

        def out() -> pa.RecordBatch:
            marks = np.packbits(again if twice else seen).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([marks], pa.binary())], ["block", "marks"])

        for batch in batches:
            for block, s, a in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    if now is not None:
                        yield out()
                    now, seen, again = block, np.zeros(BLOCK_BITS, bool), np.zeros(BLOCK_BITS, bool)
                s, a = _unpacked(s), _unpacked(a)
                again |= a | (seen & s)
                seen |= s
        if now is not None:
            yield out()

    return run


def build(rows: DataFrame, bits: int, probes: int, twice: bool = False, hashes_of: Callable = _first_column) -> np.ndarray:
    """The filter (packed bits) of the hashes that ``hashes_of`` finds in Arrow batches of ``rows``;
    without it, ``rows`` is one long column of hashes, null-free.

    ``twice``: the second of two filters, whose bits were hit by two rows at least: each task
    keeps one filter for hashes seen once and one for those seen again, and merging two tasks
    moves what both have seen into the second. A bit counts as hit twice if two different keys
    share it, so the filter may hold too much, never too little.
    """
    blocks = (
        rows.mapInArrow(_task_blocks(bits, probes, twice, hashes_of), "block int, seen binary, again binary")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_merged_blocks(twice), "block int, marks binary")
    )
    packed = np.zeros(bits // 8, np.uint8)
    size = BLOCK_BITS // 8
    table = blocks.toArrow()
    marks = None
    for block, marks in zip(table.column("block").to_pylist(), table.column("marks")):
        packed[block * size : (block + 1) * size] = np.frombuffer(marks.as_buffer(), np.uint8)
    del table, marks
    pa.default_memory_pool().release_unused()
    return packed


def holds(packed: np.ndarray, hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """For each hash: are all its bits set?"""
    ok = np.ones(len(hashes), bool)
    for at in positions(hashes, bits, probes):
        ok &= (packed[at >> 3] >> (7 - (at & 7))) & 1 == 1
    return ok
