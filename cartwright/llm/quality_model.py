"""A factorisation machine that scores the quality of texts.

The features of a text are its hashed words (logarithm of the count, scaled to length one) and
statistics of its structure, which stand beside the words as features of their own. The score adds
a weight per feature and the inner products of the factors of every two features. With the
identity sum_(i<j) <v_i, v_j> x_i x_j = (|sum v_i x_i|^2 - sum |v_i x_i|^2) / 2 this takes time
linear in the number of features of the text.

The model is fitted in one task on at most ``sample_rows`` labelled rows, those of least hash of
their id, by full-batch gradient steps (Adam) in a fixed order, so equal tables give equal models. Scoring reads
every text as a whole and uses nothing but the text.

Defined cases: null and empty texts have no words; their statistics are zero and they get the score
of that. Labels that are null are left out; where an id has several labels, the lowest holds.
Without labelled rows the score is 0.5 for all. Rows that repeat get equal scores.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cartwright.llm import quality_rules
from cartwright.llm import text as t

SAMPLE_ROWS = 4000
BLOCK_ROWS = 500
DIMENSIONS = 1 << 15
FACTORS = 8
STEPS = 60
RATE = 0.05
PENALTY = 3e-4
THRESHOLD = 0.7
SEED = 7

STATISTICS = (
    "log_words", "log_bytes", "mean_word", "capitals", "digits", "symbols", "marks", "other_bytes",
    "bare_words", "distinct_words", "repeat_words", "word_runs", "dup_lines", "words_per_line",
)


def statistics(s: quality_rules.Slice, h: np.ndarray) -> np.ndarray:
    """(rows, statistics) of a slice, shares where a total is at hand."""
    data, bounds, first = s.data, s.bounds, s.first
    words, size = np.diff(first), np.diff(bounds)
    n, m = np.maximum(words, 1), np.maximum(size, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return t.row_sums(mask, bounds) / m

    capital = (data >= 0x41) & (data <= 0x5A)
    digit = (data >= 0x30) & (data <= 0x39)
    mark = (data > 0x20) & (data < 0x7F) & ~t.ALNUM[data]
    letters = np.concatenate([[0], np.cumsum(t.ALNUM[data])])
    bare = letters[s.ends] == letters[s.starts]
    run = np.zeros(len(h), bool)
    if len(h):
        run[1:] = h[1:] == h[:-1]
        run[first[:-1][first[:-1] < len(h)]] = False
    row = t.rows_of(first).astype(np.uint64)
    # Distinct words per row: count each (row, word) once, at its first word in sorted order.
    order = np.lexsort((h, row))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    distinct = np.bincount(row[order][new].astype(np.int64), minlength=len(words))
    lines = t.row_sums(data == 0x0A, bounds) + 1
    return np.stack(
        [
            np.log1p(words), np.log1p(size), s.counts["word_chars"] / n, share(capital), share(digit),
            s.counts["n_symbols"] / n, share(mark), share(data >= 0x80),
            t.row_sums(bare, first) / n, distinct / n, s.counts["n_repeat_words"] / n, t.row_sums(run, first) / n,
            s.counts["n_dup_lines"] / lines, np.log1p(words / lines),
        ],
        axis=1,
    ).astype(np.float64)


def features(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, feature numbers, values) of hashed words per row, and the statistics."""
    s = quality_rules.measure(column)
    lower = t.LOWER[s.data]
    h = t.hashes(lower, s.starts, s.ends)
    row = t.rows_of(s.first)
    key = np.sort(row * dimensions + (h % np.uint64(dimensions)).astype(np.int64))
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate([at, [len(key)]]))
    value, number = np.log1p(count), key[at] % dimensions
    edges = np.searchsorted(key[at] // dimensions, np.arange(len(s.first)))
    square = np.concatenate([[0], np.cumsum(value**2)])
    length = np.sqrt(np.maximum(square[edges[1:]] - square[edges[:-1]], 1e-12))
    return edges, number, value / np.repeat(length, np.diff(edges)), statistics(s, h)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    dimensions: int

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, head=[self.bias, self.dimensions], weights=self.weights, factors=self.factors, mean=self.mean, scale=self.scale)
        return out.getvalue()

    @classmethod
    def loads(cls, body: bytes) -> Machine:
        x = np.load(io.BytesIO(body))
        return cls(float(x["head"][0]), x["weights"], x["factors"], x["mean"], x["scale"], int(x["head"][1]))

    def margin(self, edges: np.ndarray, number: np.ndarray, value: np.ndarray, stats: np.ndarray) -> np.ndarray:
        return _margin(self.bias, self.weights, self.factors, *_joined(edges, number, value, (stats - self.mean) / self.scale, self.dimensions))[0]

    def score(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(*features(column, self.dimensions)), -500, 500)))


def _joined(edges, number, value, stats, dimensions):
    """Words and statistics of every row in one list of features."""
    rows, extra = stats.shape
    n = np.diff(edges) + extra
    out = np.concatenate([[0], np.cumsum(n)])
    numbers, values = np.empty(out[-1], np.int64), np.empty(out[-1])
    at = np.arange(len(number)) + np.repeat(np.arange(rows) * extra, np.diff(edges))
    numbers[at], values[at] = number, value
    tail = (out[1:, None] - extra + np.arange(extra)).ravel()
    numbers[tail], values[tail] = np.tile(dimensions + np.arange(extra), rows), np.clip(stats, -4, 4).ravel()
    return out, numbers, values


def _margin(bias, weights, factors, edges, number, value):
    """The scores before the logistic function, and the sums of factors they need."""
    part = factors[number] * value[:, None]
    summed = np.add.reduceat(part, edges[:-1], axis=0)
    linear = np.add.reduceat(weights[number] * value, edges[:-1])
    squares = np.add.reduceat((part**2).sum(axis=1), edges[:-1])
    return bias + linear + 0.5 * ((summed**2).sum(axis=1) - squares), part, summed


def train(edges, number, value, stats, label, dimensions: int = DIMENSIONS, factors: int = FACTORS, steps: int = STEPS) -> Machine:
    """Fit by logistic loss, each class with half of the weight."""
    mean, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    edges, number, value = _joined(edges, number, value, (stats - mean) / scale, dimensions)
    value = value.astype(np.float32)
    total = dimensions + stats.shape[1]
    # Only features that occur get weights; the others keep zero.
    used, place = np.unique(number, return_inverse=True)
    place = place.astype(np.int32)
    random = np.random.default_rng(SEED)
    w, v = np.zeros(len(used), np.float32), random.normal(0, 0.05, (len(used), factors)).astype(np.float32)
    positive = max(label.mean(), 1e-6)
    share = np.where(label == 1, 0.5 / positive, 0.5 / max(1 - positive, 1e-6)) / len(label)
    bias, state = 0.0, [[0.0, 0.0], [np.zeros_like(w), np.zeros_like(w)], [np.zeros_like(v), np.zeros_like(v)]]
    for step in range(1, steps + 1):
        g_bias, g_w, g_v = 0.0, PENALTY * w, PENALTY * v
        # The gradient of all rows, added up over blocks of rows to bound the memory.
        for low in range(0, len(label), BLOCK_ROWS):
            high = min(low + BLOCK_ROWS, len(label))
            block = slice(edges[low], edges[high])
            at, x, own = place[block], value[block], edges[low : high + 1] - edges[low]
            margin, part, summed = _margin(bias, w, v, own, at, x)
            error = share[low:high] * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label[low:high])
            row = np.repeat(np.arange(high - low), np.diff(own))
            pull = (error[row] * x).astype(np.float32)
            toward = summed[row] - part
            g_bias += error.sum()
            g_w = g_w + np.bincount(at, pull, len(used))
            g_v = g_v + np.stack([np.bincount(at, pull * toward[:, f], len(used)) for f in range(factors)], axis=1)
        moved = []
        for gradient, memory in zip((g_bias, g_w, g_v), state):
            memory[0] = 0.9 * memory[0] + 0.1 * gradient
            memory[1] = 0.99 * memory[1] + 0.01 * gradient**2
            moved.append(RATE * (memory[0] / (1 - 0.9**step)) / (np.sqrt(memory[1] / (1 - 0.99**step)) + 1e-8))
        bias, w, v = bias - moved[0], (w - moved[1]).astype(np.float32), (v - moved[2]).astype(np.float32)
    weights, all_factors = np.zeros(total), np.zeros((total, factors))
    weights[used], all_factors[used] = w, v
    return Machine(float(bias), weights, all_factors, mean, scale, dimensions)


def held_out(id: str):
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(4)) == 2


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    dimensions: int = DIMENSIONS,
) -> Machine:
    """The model of the rows that are not held out."""
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id))
    known = known.groupBy(F.col(id).alias("_id")).agg(F.min(label).cast("double").alias("_label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    texts = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "_text"):
            edges, number, value, stats = features(part.column("_text"), dimensions)
            offsets = pa.array(edges, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_id"),
                    part.column("_label"),
                    pa.ListArray.from_arrays(offsets, pa.array(number.astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(value.astype(np.float32))),
                    pa.array(list(stats), pa.list_(pa.float64())),
                ],
                ["id", "label", "number", "value", "stats"],
            )

    schema = texts.select(F.col("_id").alias("id")).schema
    for name, kind in (("label", "double"), ("number", "array<int>"), ("value", "array<float>"), ("stats", "array<double>")):
        schema = schema.add(name, DataType.fromDDL(kind))
    # The sample is bounded, so one task can hold its features; the driver gets the model only.
    rows = texts.select("_id", "_label", "_text").mapInArrow(run, schema)
    fitted = rows.repartition(1).mapInArrow(_fit_task(dimensions), "model binary").first()
    return untrained(dimensions) if fitted is None else Machine.loads(bytes(fitted[0]))


def untrained(dimensions: int) -> Machine:
    size, extra = dimensions + len(STATISTICS), len(STATISTICS)
    return Machine(0.0, np.zeros(size), np.zeros((size, 1)), np.zeros(extra), np.ones(extra), dimensions)


def _fit_task(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([("id", "ascending")])
        columns = {c: rows.column(c).combine_chunks() for c in ("number", "value", "stats")}
        edges = np.concatenate([[0], np.cumsum([len(x) for x in columns["number"]])])
        machine = train(
            edges,
            columns["number"].flatten().to_numpy().astype(np.int64),
            columns["value"].flatten().to_numpy(),
            columns["stats"].flatten().to_numpy().reshape(rows.num_rows, -1),
            rows.column("label").to_numpy(),
            dimensions,
        )
        yield pa.RecordBatch.from_arrays([pa.array([machine.dumps()], pa.binary())], ["model"])

    return run


def score(docs: DataFrame, machine: Machine, text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), without the text unless it is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            found = shared.value.score(part.column("text"))
            yield t.added(part.column("rest"), pa.array(found, pa.float64()))

    return t.Carried(docs, text, ("score",), keep_text).run(run, {"score": "double"})
