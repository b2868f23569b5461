"""Codes of vectors: every part of a vector becomes the number of its nearest codebook entry.

Components become integers, floor(``SCALE`` * x). ``fit`` writes the vectors as blocks that carry
their trees (``dual_tree``): per part, the points in tree order with boxes and sums of all nodes.
The blocks are read once per round; tasks send counts and sums of entries, which Spark adds up,
so the driver gets one number for each component of an entry. ``encode`` works on the rows
themselves and keeps all other columns.

Defined cases: vectors that are null, empty, hold null or non-finite components, or differ in
length from the usable vector of the least id are dropped. The first entries come from the rows
of least id (null ids last, equal ids by their components), repeated rows included; fewer than
``entries`` rows give fewer entries, no rows an empty codebook and no rows. Ties go to the lower
entry. A length that the number of parts does not divide raises ValueError. Components of a size
whose squares leave 64 bits are compared as Python's whole numbers; errors beyond 64 bits are
given as the largest long. Other columns may have any name but those of the results, which
replace them.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.lineage import build_side, stage
from cartwright.llm import dual_tree
from cartwright.llm import text as t

# Fixed values of the codes.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6

BLOCK_ROWS = 4096
MOST_LONG = (1 << 63) - 1
LIMB = 1 << 32


@dataclass
class Codebooks:
    """The entries of each part, as lists of whole numbers."""

    books: list[list[list[int]]]
    width: int

    def sha256(self) -> str:
        """Hex digest of all components in decimals, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(x) for book in self.books for entry in book for x in entry).encode()).hexdigest()


def usable(vector: Column) -> Column:
    """Is there a vector with finite components only?"""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def _whole(x: float) -> int:
    top, bottom = x.as_integer_ratio()
    return SCALE * top // bottom


def _limit(width: int) -> int:
    """Components up to this size have squared distances well within 64 bits."""
    return 1 << (29 - (max(width, 1) - 1).bit_length() // 2 - 1)


def _small(values: np.ndarray, limit: int) -> bool:
    return not values.size or float(np.abs(values).max()) * SCALE < limit - 1


def _vectors(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that are usable, their components as doubles)."""
    flat = column.flatten().cast(pa.float64())
    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False)
    held = np.maximum(size, 0)
    row = np.repeat(np.arange(len(size)), held)
    ok = size == length
    ok[row[~np.isfinite(values)]] = False
    return np.flatnonzero(ok), values[ok[row]].reshape(-1, length)


def _integers(values: np.ndarray, small: bool) -> np.ndarray:
    if small:
        return np.floor(values * SCALE).astype(np.int64)
    return np.array([[_whole(x) for x in row] for row in values.tolist()], object).reshape(values.shape)


class _Books:
    """Codebooks as arrays, with a tree each where 64 bits are enough."""

    def __init__(self, books: list[list[list[int]]], width: int):
        limit = _limit(width)
        self.small = all(abs(x) < limit for book in books for entry in book for x in entry)
        self.plain = books
        self.trees = [dual_tree.Entries(np.array(book, np.int64)) for book in books] if self.small else []

    def exact(self, points: np.ndarray, part: int) -> np.ndarray:
        """The nearest entry of each point, compared as Python's whole numbers."""
        far = [[sum((int(a) - b) ** 2 for a, b in zip(x, entry)) for entry in self.plain[part]] for x in points.tolist()]
        return np.array([row.index(min(row)) for row in far], np.int64)


def _packed_tree(points: np.ndarray) -> dict:
    tree = dual_tree.Tree(points, dual_tree.POINT_LEAF)
    narrow = np.int16 if np.abs(points).max(initial=0) < 1 << 15 else np.int32
    stack = lambda levels, kind: np.concatenate(levels).astype(kind).tobytes()
    packed = (tree.points.astype(narrow).tobytes(), stack(tree.low, narrow), stack(tree.high, narrow), stack(tree.sums, np.int64))
    return dict(zip(("points", "low", "high", "sums"), packed)) | {"narrow": narrow is np.int16}


def _read_tree(packed: dict, n: int, width: int) -> dual_tree.Tree:
    kind = np.int16 if packed["narrow"] else np.int32
    wide = lambda name, k=kind: np.frombuffer(packed[name], k).reshape(-1, width).astype(np.int64)
    tree = dual_tree.Tree.__new__(dual_tree.Tree)
    points, low, high, sums = wide("points"), wide("low"), wide("high"), wide("sums", np.int64)
    tree.points, tree.order = points, None
    tree.depth = len(low).bit_length() - 1
    cut = [(1 << level) - 1 for level in range(tree.depth + 2)]
    tree.low, tree.high, tree.sums = ([x[a:b] for a, b in zip(cut[:-1], cut[1:])] for x in (low, high, sums))
    return tree


_TREE = "struct<points: binary, low: binary, high: binary, sums: binary, narrow: boolean>"
_TREE_TYPE = pa.struct([*[(c, pa.binary()) for c in ("points", "low", "high", "sums")], ("narrow", pa.bool_())])


def _blocks(length: int, parts: int) -> object:
    """Blocks of vectors as trees; blocks with very large components as decimals."""
    width = length // parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def out() -> pa.RecordBatch:
            values = np.concatenate(held)
            trees, decimals = None, None
            if _small(values, _limit(width)):
                points = _integers(values, True)
                trees = [_packed_tree(points[:, p * width : (p + 1) * width]) for p in range(parts)]
            else:
                decimals = json.dumps(_integers(values, False).tolist())
            columns = [pa.array([len(values)], pa.int32()), pa.array([trees], pa.list_(_TREE_TYPE)), pa.array([decimals], pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["n", "trees", "decimals"])

        for batch in batches:
            _, values = _vectors(batch.column(0), length)
            for begin in range(0, len(values), BLOCK_ROWS):
                held.append(values[begin : begin + BLOCK_ROWS])
                n += len(held[-1])
                if n >= BLOCK_ROWS:
                    yield out()
                    held, n = [], 0
        if n:
            yield out()

    return run


def _sums(books: _Books, width: int) -> object:
    """Counts (place -1) and sums of each entry over the blocks of a task. A sum is cut into limbs,
    sum = low + LIMB * high, whose totals stay within 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}

        def add(part: int, count: np.ndarray, sums: np.ndarray) -> None:
            for entry in np.flatnonzero(count).tolist():
                for place, value in enumerate([count[entry], *sums[entry].tolist()], -1):
                    key = part, entry, place
                    total[key] = total.get(key, 0) + int(value)

        for batch in batches:
            for n, trees, decimals in zip(*(batch.column(c) for c in range(3))):
                n, trees = n.as_py(), trees.as_py()
                exact = None if decimals.as_py() is None else np.array(json.loads(decimals.as_py()), object)
                for part in range(len(books.plain)):
                    if trees is not None and books.small:
                        _, count, sums = dual_tree.assign(_read_tree(trees[part], n, width), books.trees[part])
                    else:
                        points = _read_tree(trees[part], n, width).points if trees is not None else exact[:, part * width : (part + 1) * width]
                        found, k = books.exact(points, part), len(books.plain[part])
                        count = np.bincount(found, minlength=k)
                        sums = np.array([[sum(map(int, points[found == e, i])) for i in range(width)] for e in range(k)], object)
                    add(part, count, sums)
        rows = []
        for (part, entry, place), value in total.items():
            limb = 0
            while True:
                rest, low = divmod(value, LIMB)
                if rest in (0, -1):
                    rows.append((part, entry, place, limb, value))
                    break
                rows.append((part, entry, place, limb, low))
                value, limb = rest, limb + 1
        columns = [pa.array(c, pa.int64() if i == 4 else pa.int32()) for i, c in enumerate(zip(*rows))] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "place", "limb", "value"])

    return run


def fit(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks of all vectors after some rounds of Lloyd's algorithm."""
    column = F.col(f"`{vector}`")
    rows = vectors.select(F.col(f"`{id}`").alias("id"), column.cast("array<double>").alias("vector")).where(usable(column))
    by_id = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = rows.orderBy(*by_id).limit(entries).collect()
    if not first:
        return Codebooks([[] for _ in range(parts)], 0)
    length = len(first[0]["vector"])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    if any(len(r["vector"]) != length for r in first):
        first = rows.where(F.size("vector") == length).orderBy(*by_id).limit(entries).collect()
    width = length // parts
    whole = [[_whole(x) for x in r["vector"]] for r in first]
    books = [[row[p * width : (p + 1) * width] for row in whole] for p in range(parts)]
    blocks = stage(rows.select("vector").mapInArrow(_blocks(length, parts), f"n int, trees array<{_TREE}>, decimals string"), "vector-blocks")
    for _ in range(rounds):
        sums = blocks.mapInArrow(_sums(_Books(books, width), width), "part int, entry int, place int, limb int, value long")
        total: dict[tuple[int, int, int], int] = {}
        for r in sums.groupBy("part", "entry", "place", "limb").agg(F.sum("value").alias("value")).collect():
            key = r["part"], r["entry"], r["place"]
            total[key] = total.get(key, 0) + (r["value"] << (32 * r["limb"]))
        books = [
            [
                [total[p, e, i] // total[p, e, -1] for i in range(width)] if (p, e, -1) in total else entry
                for e, entry in enumerate(book)
            ]
            for p, book in enumerate(books)
        ]
    return Codebooks(books, width)


def encode(vectors: DataFrame, codebooks: Codebooks, vector: str = "embedding") -> DataFrame:
    """The usable rows with all columns, ``code`` (two hex digits per part) and ``error`` (squared
    distance to the entries, in units of 1 / ``SCALE``)."""
    carried = t.Carried(vectors.where(usable(F.col(f"`{vector}`"))), vector, ("code", "error"), keep_text=True)
    frame = carried.frame.withColumn("text", F.col("text").cast("array<double>"))
    books, width, parts = codebooks.books, codebooks.width, len(codebooks.books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = _Books(books, width) if width else None
        for batch in batches:
            for begin in range(0, batch.num_rows if ready else 0, BLOCK_ROWS):
                part_of = batch.slice(begin, BLOCK_ROWS)
                at, values = _vectors(part_of.column("text"), width * parts)
                if not len(at):
                    continue
                small = ready.small and _small(values, _limit(width))
                points = _integers(values, small)
                error, code = np.zeros(len(at), np.int64 if small else object), np.zeros((len(at), parts), np.uint8)
                for p in range(parts):
                    here = points[:, p * width : (p + 1) * width]
                    if small:
                        tree = dual_tree.Tree(here, dual_tree.POINT_LEAF)
                        found = np.empty(len(at), np.int64)
                        found[tree.order] = dual_tree.assign(tree, ready.trees[p])[0]
                        apart = here - ready.trees[p].entries[found]
                    else:
                        found = ready.exact(here, p)
                        apart = here - np.array([books[p][e] for e in found.tolist()], object)
                    error += (apart * apart).sum(axis=1)
                    code[:, p] = found
                digits = code.tobytes().hex()
                codes = [digits[i : i + 2 * parts] for i in range(0, len(digits), 2 * parts)]
                errors = [min(int(x), MOST_LONG) for x in error.tolist()]
                yield t.added(part_of.column("rest").take(pa.array(at)), pa.array(codes, pa.string()), pa.array(errors, pa.int64()))

    return carried.run(run, {"code": "string", "error": "long"}, frame)


def group_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the errors of all rows of its label together; nulls are one label."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long")
    sums = stage(coded.groupBy(F.col(f"`{label}`").alias("_of_label")).agg(total.alias("label_error")), "label-errors")
    rows = coded.drop("label_error")
    return rows.join(build_side(sums), rows[f"`{label}`"].eqNullSafe(sums["_of_label"]), "left").drop(sums["_of_label"])
