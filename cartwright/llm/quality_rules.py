"""Quality rules as a short-circuit cascade.

The base counts of a text are computed for every row. The rules of the verdict run after them,
one after another, each on the rows that all earlier rules kept. A sample gives each rule's cost
per row and the share of rows it rejects; the rules run in the order of rejection per cost. The
order changes the work, never the verdict: a text is kept if no rule rejects it.

Defined cases: a null or empty text has no words, so its counts are 0 and it fails the base rule.
Repeated rows get equal results. All columns of the input are kept but for those of the same
names as the counts, which are replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm import text as t

# The base rule and the symbols that count.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

SAMPLE_ROWS = 2000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass
class Slice:
    """The rows of a slice and what the base counts have found out about them."""

    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    counts: dict[str, np.ndarray]

    def words_of(self, rows: np.ndarray) -> np.ndarray:
        """Indexes of the words of the rows, and the bounds of the rows among them."""
        n = (self.first[1:] - self.first[:-1])[rows]
        edges = np.concatenate([[0], np.cumsum(n)])
        return np.repeat(self.first[:-1][rows] - edges[:-1], n) + np.arange(edges[-1]), edges


def _mean_word(s: Slice, rows: np.ndarray) -> np.ndarray:
    """Words are 2 to 16 characters long on average."""
    n, chars = s.counts["n_words"][rows], s.counts["word_chars"][rows]
    return (chars < 2 * n) | (chars > 16 * n)


def _symbols(s: Slice, rows: np.ndarray) -> np.ndarray:
    """More than three symbols in ten words."""
    return 10 * s.counts["n_symbols"][rows] > 3 * s.counts["n_words"][rows]


def _dup_lines(s: Slice, rows: np.ndarray) -> np.ndarray:
    """More than one word in ten stands for a repeated line, of at least six repeated lines."""
    dup = s.counts["n_dup_lines"][rows]
    return (dup >= 6) & (10 * dup > s.counts["n_words"][rows])


def _capitals(s: Slice, rows: np.ndarray) -> np.ndarray:
    """More than half of the bytes of words are capitals A-Z."""
    at, edges = s.words_of(rows)
    capital = np.concatenate([[0], np.cumsum((s.data >= 0x41) & (s.data <= 0x5A))])
    found = t.row_sums(capital[s.ends[at]] - capital[s.starts[at]], edges)
    return 2 * found > t.row_sums(s.ends[at] - s.starts[at], edges)


def _word_run(s: Slice, rows: np.ndarray) -> np.ndarray:
    """More than a third of the words repeat the word before them."""
    at, edges = s.words_of(rows)
    h = t.hashes(s.data, s.starts[at], s.ends[at])
    same = np.concatenate([[False], h[1:] == h[:-1]]) if len(h) else np.zeros(0, bool)
    same[edges[:-1][edges[:-1] < len(same)]] = False
    return 3 * t.row_sums(same, edges) > np.diff(edges)


RULES: dict[str, Callable[[Slice, np.ndarray], np.ndarray]] = {
    "mean_word": _mean_word,
    "symbols": _symbols,
    "dup_lines": _dup_lines,
    "capitals": _capitals,
    "word_run": _word_run,
}


def _dup_line_counts(data: np.ndarray, bounds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    row, begin, end = t.lines(data, bounds)
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, row = begin[worded], end[worded], row[worded]
    key = t.mix(t.hashes(data, begin, end) + row.astype(np.uint64))
    order = np.lexsort((begin, key))
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return np.bincount(row[again], minlength=len(bounds) - 1)


def _repeat_words(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row: words inside a 3-word window that the row has twice or more."""
    row = t.rows_of(first).astype(np.uint64)
    ok = np.flatnonzero(t.same_row(first, 3))
    key = t.mix(t.grams(h, 3)[ok] + row[ok])
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order[1:]] == key[order[:-1]]
    at = ok[order[same[:-1] | same[1:]]]
    inside = np.zeros(len(h), bool)
    for i in range(3):
        inside[at + i] = True
    return t.row_sums(inside, first)


def measure(column: pa.Array) -> Slice:
    """The base counts of a slice."""
    data, bounds = t.flat(column)
    starts, ends, first = t.words(data, bounds, t.VISIBLE)
    h = t.hashes(data, starts, ends)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    table = np.zeros(256, bool)
    table[list(SYMBOLS)] = True
    counts = {
        "n_words": np.diff(first),
        "word_chars": t.row_sums(chars[ends] - chars[starts], first),
        "n_symbols": t.row_sums(table[data], bounds),
        "n_dup_lines": _dup_line_counts(data, bounds, starts),
        "n_repeat_words": _repeat_words(h, first),
    }
    return Slice(data, bounds, starts, ends, first, counts)


def base_failed(s: Slice) -> np.ndarray:
    n = s.counts["n_words"]
    return (n < MIN_WORDS) | (100 * s.counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


def rule_order(docs: DataFrame, text: str, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """The rules by rejection per cost, measured on a random sample of about ``sample_rows`` rows.

    Costs are processor seconds, so the order may differ from run to run where rules are close;
    verdicts do not.
    """
    rows = docs.count()
    picked = docs.select(F.col(text).alias("text")).sample(fraction=min(1.0, sample_rows / max(rows, 1)), seed=7)

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            s = measure(part.column("text"))
            rows = np.flatnonzero(~base_failed(s))
            for name, rule in RULES.items():
                began = time.process_time_ns()
                rejected = int(rule(s, rows).sum())
                spent = time.process_time_ns() - began
                yield pa.RecordBatch.from_pydict({"rule": [name], "n": [len(rows)], "rejected": [rejected], "ns": [spent]})

    seen = picked.mapInArrow(tried, "rule string, n long, rejected long, ns long")
    totals = seen.groupBy("rule").agg(F.sum("rejected").alias("rejected"), F.sum("ns").alias("ns")).collect()
    worth = {r["rule"]: r["rejected"] / max(r["ns"], 1) for r in totals}
    return sorted(RULES, key=lambda name: -worth.get(name, 0.0))


def judge(docs: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """``docs`` without the text, with the counts, ``base_failed``, ``kept`` and ``rejected_by``."""
    order = rule_order(docs, text) if order is None else order
    names = {**dict.fromkeys(COUNTS, "long"), "base_failed": "boolean", "kept": "boolean", "rejected_by": "string"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            s = measure(part.column("text"))
            failed = base_failed(s)
            by = np.full(part.num_rows, None, object)
            left = np.flatnonzero(~failed)
            for name in order:
                bad = RULES[name](s, left)
                by[left[bad]] = name
                left = left[~bad]
            kept = np.zeros(part.num_rows, bool)
            kept[left] = True
            counts = [pa.array(s.counts[c], pa.int64()) for c in COUNTS]
            yield t.added(part.column("rest"), *counts, pa.array(failed), pa.array(kept), pa.array(by.tolist(), pa.string()))

    return t.Carried(docs, text, tuple(names)).run(run, names)
