"""Counting terms by sorting pointers to word starts.

Pointers to the first byte of every term of a slice are sorted where the text lies, in the Arrow
buffer, by a multikey quicksort whose characters are eight bytes wide. All segments that are
still open take part in the same numpy step: each picks a pivot, its pointers are told apart
into less, equal and greater by running counts, and the equal ones go one character deeper or,
when the term ends there, form a finished run. The steps keep the order of equal pointers, so a
run lists its documents in their order.
"""

from __future__ import annotations

import numpy as np

from cartwright.llm.text import LOWER

# Bytes that make up terms, letters and everything outside ASCII.
LETTERS = np.array([b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])

_SHIFT = np.array([64 - 8 * n for n in range(1, 9)], np.uint64)


class Pointers:
    """The starts and ends of terms in a buffer of lower-cased bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.data = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
        self.starts, self.ends = starts, ends
        self._eight = np.ndarray((len(data) + 1,), ">u8", self.data, strides=(1,))

    def characters(self, which: np.ndarray, depth: np.ndarray | int) -> np.ndarray:
        """The eight-byte character at a depth, zeros after the end of the term. Terms hold no zero
        byte, so a character whose last byte is zero is the last one."""
        at = self.starts[which] + 8 * depth
        left = np.minimum(self.ends[which] - at, 8)
        cut = _SHIFT[np.maximum(left, 1) - 1]
        return np.where(left > 0, self._eight[at].astype(np.uint64) >> cut << cut, np.uint64(0))

    def spelled(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes end to end, n + 1 bounds) of the terms of some pointers."""
        size = self.ends[which] - self.starts[which]
        bounds = np.concatenate([[0], np.cumsum(size)])
        return self.data[np.arange(bounds[-1]) + np.repeat(self.starts[which] - bounds[:-1], size)], bounds


def _pivots(key: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The middle one of three keys of each segment."""
    a, b, c = key[first], key[first + size // 2], key[first + size - 1]
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def sorted_runs(pointers: Pointers) -> tuple[np.ndarray, np.ndarray]:
    """(pointers in the order of their terms, start of each run of equal terms)."""
    n = len(pointers.starts)
    order, begins = np.empty(n, np.int32), [np.zeros(0, np.int32)]
    which = np.arange(n, dtype=np.int32)
    key = pointers.characters(which, 0)
    # Open segments: where each belongs in the result, its size and its depth.
    place, size, depth = (np.array([x] if n else [], np.int32) for x in (0, n, 0))
    while len(size):
        first = np.cumsum(size, dtype=np.int32) - size
        pivot = _pivots(key, first, size)
        wide = np.repeat(pivot, size)
        less, same = key < wide, key == wide
        n_less, n_same = np.add.reduceat(less, first, dtype=np.int32), np.add.reduceat(same, first, dtype=np.int32)
        run_less, run_same = np.cumsum(less, dtype=np.int32), np.cumsum(same, dtype=np.int32)
        before_less, before_same = run_less[first] - less[first], run_same[first] - same[first]
        rank = np.arange(len(key), dtype=np.int32)
        to = np.where(
            less,
            run_less + np.repeat(first - 1 - before_less, size),
            np.where(
                same,
                run_same + np.repeat(first + n_less - 1 - before_same, size),
                # What is neither has moved by all that was less or equal so far.
                rank - (run_less + run_same) + np.repeat(before_less + before_same + n_less + n_same, size),
            ),
        )
        new_which, new_key = np.empty_like(which), np.empty_like(key)
        new_which[to], new_key[to] = which, key
        # Three parts of each segment, in order; only equal ones that go on change their depth.
        sizes = np.stack([n_less, n_same, size - n_less - n_same], axis=1)
        starts = np.stack([first, first + n_less, first + n_less + n_same], axis=1)
        places = starts + (place - first)[:, None]
        depths = np.repeat(depth[:, None], 3, axis=1)
        ended = (pivot & np.uint64(0xFF)) == 0
        depths[:, 1] += ~ended
        done = sizes == 1
        done[:, 1] |= ended
        done &= sizes > 0
        deeper = np.zeros_like(done)
        deeper[:, 1] = ~ended
        go = (sizes > 1) & ~done
        at, count = starts[done], sizes[done]
        spot = np.arange(count.sum(), dtype=np.int32) + np.repeat(at - (np.cumsum(count, dtype=np.int32) - count), count)
        order[spot + np.repeat(places[done] - at, count)] = new_which[spot]
        begins.append(places[done])
        at, size = starts[go], sizes[go]
        spot = np.arange(size.sum(), dtype=np.int32) + np.repeat(at - (np.cumsum(size, dtype=np.int32) - size), size)
        which, key, place, depth = new_which[spot], new_key[spot], places[go], depths[go]
        again = np.repeat(deeper[go], size)
        if again.any():
            key[again] = pointers.characters(which[again], np.repeat(depth, size)[again])
    return order, np.sort(np.concatenate(begins))


def cells(pointers: Pointers, group: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pointer, group, documents, occurrences) of each term in each group; ``group`` and ``row``
    of every pointer, ascending by group and then by row."""
    order, begins = sorted_runs(pointers)
    if not len(order):
        return order, order, order, order
    g, r = group[order], row[order]
    new = np.zeros(len(order), bool)
    new[begins] = True
    new[1:] |= g[1:] != g[:-1]
    fresh = new.copy()
    fresh[1:] |= r[1:] != r[:-1]
    at = np.flatnonzero(new)
    return order[at], g[at], np.add.reduceat(fresh, at, dtype=np.int64), np.diff(np.append(at, len(order)))
