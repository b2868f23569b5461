"""SimHash near-duplicates: fingerprints at most four bits apart are linked, links join groups.

A fingerprint is embedded as the counts of set bits in its segments. The Manhattan distance of
two embeddings is at most the Hamming distance of the fingerprints. The embedding is laid out on
grids: its coordinates are cut into ``groups`` runs, and for every choice of ``groups - distance``
runs there is a grid whose cells are the values of those coordinates. Fingerprints within the
distance differ in at most ``distance`` runs, so they share a cell in one grid at least. Inside a
cell the Manhattan distance is tested first and the fingerprints are compared exactly after that.

A cell does not give out its pairs but the links of a spanning forest (each fingerprint to the
least of its part of the cell), which keeps every connection and is linear in the rows of the
cell. A cell of more than ``cell_rows`` fingerprints is cut into blocks, and every two blocks
meet in a task of their own. The links of all cells are merged into components by rounds of
joins; nothing but counts reaches the driver.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero and link
with each other. Rows of equal fingerprint are one vertex, however many they are; ids may repeat.
A row without an id takes part with its fingerprint, but cannot name a component that has ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.lineage import stage
from cartwright.llm import text as t

SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4
SEGMENT_BITS = 2
GROUPS = 7
CELL_ROWS = 20_000


def fingerprint_slice(column: pa.Array, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The 64-bit fingerprints of a string column."""
    data, bounds = t.flat(column)
    data = t.LOWER[data]
    starts, ends, first = t.words(data, bounds, t.VISIBLE)
    n = len(starts)
    # The words of a row with one space between them: keep the byte after each word but the row's last.
    more = np.ones(n, bool)
    more[first[1:][np.diff(first) > 0] - 1] = False
    keep = np.zeros(len(data) + 1, np.int8)
    np.add.at(keep, starts, 1)
    np.add.at(keep, ends, -1)
    kept = np.cumsum(keep[:-1]).astype(bool)
    space = ends[more]
    kept[space] = True
    data = data.copy()
    data[space] = 0x20
    place = np.cumsum(kept)
    begin, end, body = place[starts] - 1, place[ends - 1], data[kept].tobytes()
    count = np.diff(first)
    take = np.minimum(count, shingle)
    n_shingles = np.where(count > 0, count - take + 1, 0)
    edges = np.concatenate([[0], np.cumsum(n_shingles)])
    head = np.repeat(first[:-1] - edges[:-1], n_shingles) + np.arange(edges[-1])
    tail = head + np.repeat(take, n_shingles) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(body[a:b], SEED) for a, b in zip(begin[head].tolist(), end[tail].tolist())], np.uint64)
    out = np.zeros(len(bounds) - 1, np.uint64)
    filled = np.flatnonzero(n_shingles)
    if len(filled):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, edges[:-1][filled], axis=0, dtype=np.int32)
        marks = 2 * ones > n_shingles[filled][:, None]
        out[filled] = np.packbits(marks, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp): the fingerprint as a signed long with the same bits."""
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = source.select("id").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            fp = fingerprint_slice(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fp.view(np.int64))], ["id", "fp"])

    return source.mapInArrow(run, schema)


def embedding(fp: np.ndarray, segment_bits: int = SEGMENT_BITS) -> np.ndarray:
    """(n, segments) counts of set bits."""
    masks = [np.uint64(((1 << segment_bits) - 1) << at) for at in range(0, 64, segment_bits)]
    return np.stack([np.bitwise_count(fp & m) for m in masks], axis=1).astype(np.int8)


def cells(fps: DataFrame, distance: int, segment_bits: int, groups: int) -> DataFrame:
    """(cell, fp): every fingerprint in its cell of every grid. A cell is a hash of the grid's
    number and the coordinates, so cells may merge by chance, which costs a comparison."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            runs = np.array_split(embedding(fp, segment_bits).astype(np.uint64), groups, axis=1)
            values = [np.zeros(len(fp), np.uint64) for _ in runs]
            for g, coordinates in enumerate(runs):
                for column in coordinates.T:
                    values[g] = values[g] * np.uint64(segment_bits + 1) + column
            for number, chosen in enumerate(combinations(range(groups), groups - distance)):
                cell = t.mix(np.full(len(fp), number + 1, np.uint64))
                for g in chosen:
                    cell = t.mix(cell + values[g])
                yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(fp.view(np.int64))], ["cell", "fp"])

    return fps.mapInArrow(run, "cell long, fp long")


def _forest(key: np.ndarray, fp: np.ndarray, side: np.ndarray, distance: int, segment_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(vertex, root) of the rows that have links; rows come sorted by key, pairs only form in a key."""
    root = np.arange(len(fp))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    points = embedding(fp, segment_bits) if len(fp) else None
    end = np.searchsorted(key, key, side="right")
    active, step = np.flatnonzero(end - np.arange(len(key)) > 1), 1
    while len(active):
        a, b = active, active + step
        near = root[a] != root[b]
        near &= (side[a] == 0) | (side[a] != side[b])
        a, b = a[near], b[near]
        if len(a):
            close = np.abs(points[a] - points[b]).sum(axis=1) <= distance
            a, b = a[close], b[close]
            linked = np.bitwise_count(fp[a] ^ fp[b]) <= distance
            for i, j in zip(a[linked].tolist(), b[linked].tolist()):
                x, y = top(i), top(j)
                if x != y:
                    root[max(x, y)] = min(x, y)
            if linked.any():
                root = root[root]
        step += 1
        active = active[end[active] - active > step]
    while (root[root] != root).any():
        root = root[root]
    moved = np.flatnonzero(root != np.arange(len(root)))
    return moved, root[moved]


def _links_of_cells(distance: int, segment_bits: int, cell_rows: int | None):
    """Rows come sorted by cell; whole cells are handled, several small ones at a time. A cell
    of more than ``cell_rows`` rows is passed on row by row instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(cell: np.ndarray, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
            return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(a), other], ["cell", "fp", "root"])

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        hot = None

        def work(cell: np.ndarray, fp: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
            moved, root = _forest(cell, fp.view(np.uint64), side, distance, segment_bits)
            other = fp[moved] != fp[root]
            moved, root = moved[other], root[other]
            return emit(cell[moved], fp[moved], fp[root])

        for batch in batches:
            cell, fp, side = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if hot is not None:
                n = int(np.searchsorted(cell, hot, side="right"))
                if n:
                    yield emit(cell[:n], fp[:n], None)
                cell, fp, side = cell[n:], fp[n:], side[n:]
            if not len(cell):
                continue
            hot = None
            held.append((cell, fp, side))
            cell, fp, side = (np.concatenate(x) for x in zip(*held))
            last = int(np.searchsorted(cell, cell[-1]))
            if last:
                yield from _in_parts(cell[:last], fp[:last], side[:last], cell_rows, work, emit)
            held = [(cell[last:], fp[last:], side[last:])]
            if cell_rows is not None and len(cell) - last > cell_rows:
                yield emit(cell[last:], fp[last:], None)
                hot, held = cell[-1], []
        if held:
            yield from _in_parts(*held[0], cell_rows, work, emit)

    return run


def _in_parts(cell: np.ndarray, fp: np.ndarray, side: np.ndarray, cell_rows: int | None, work, emit):
    if cell_rows is not None:
        _, at, n = np.unique(cell, return_inverse=True, return_counts=True)
        large = n[at] > cell_rows
        if large.any():
            yield emit(cell[large], fp[large], None)
            cell, fp, side = cell[~large], fp[~large], side[~large]
    yield work(cell, fp, side)


def links(
    fps: DataFrame,
    distance: int = DISTANCE,
    segment_bits: int = SEGMENT_BITS,
    groups: int = GROUPS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(a, b): links that connect what is within the distance, from distinct fingerprints ``fp``."""
    schema = "cell long, fp long, root long"
    dealt = cells(fps, distance, segment_bits, groups).withColumn("side", F.lit(0).cast("byte"))
    found = dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(_links_of_cells(distance, segment_bits, cell_rows), schema)
    found = stage(found, "simhash-cells")
    straight = found.where("root is not null").select(F.col("fp").alias("a"), F.col("root").alias("b"))
    large = found.where("root is null").select("cell", "fp")
    # Large cells: blocks of about cell_rows / 2 rows; every two blocks, and each alone, form a cell.
    blocks = large.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) * 2 / F.lit(cell_rows)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int")
    met = (
        large.join(blocks, "cell")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
            "fp",
            F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).cast("byte").alias("side"),
        )
        .repartition("cell")
        .sortWithinPartitions("cell")
        .mapInArrow(_links_of_cells(distance, segment_bits, None), schema)
        .select(F.col("fp").alias("a"), F.col("root").alias("b"))
    )
    return straight.unionByName(met).distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): the least node of each component, for the nodes of ``edges`` (a, b).

    Every round hooks each node and its neighbours to the least of them, first upwards, then
    downwards, until nothing moves. The minimum is taken before the shuffle, so a node with very
    many neighbours costs what its rows cost.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _sum(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # Large star: neighbours above a node go to the least around it.
        up = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = up.where("a <> b").distinct()
        # Small star: neighbours below a node, and the node itself, go to the least of them.
        small = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(small, "a")
        after = down.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        after = stage(after.where("a <> b").distinct(), "edges")
        sums = _sum(after)
        same, now, before = sums == before, after, sums
        if same:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _sum(edges: DataFrame) -> tuple:
    """Counts and checksums of a set of edges."""
    parts = F.xxhash64("a", "b").cast("decimal(38,0)"), F.xxhash64("b", "a", F.lit(1)).cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), *[F.sum(p) for p in parts]).first())


def near_duplicates(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    distance: int = DISTANCE,
    segment_bits: int = SEGMENT_BITS,
    groups: int = GROUPS,
    cell_rows: int = CELL_ROWS,
    more: DataFrame | None = None,
) -> DataFrame:
    """(id, fingerprint, component_id): the smallest id that links lead to. ``more`` (a, b) holds
    further links of ids; ids are a key then."""
    marked = stage(fingerprints(docs, id, text), "simhash")
    vertices = stage(marked.groupBy("fp").agg(F.min("id").alias("first")), "simhash-vertices")
    linked = links(vertices.select("fp"), distance, segment_bits, groups, cell_rows)
    if more is not None:
        one, two = (marked.select(F.col("id").alias(c), F.col("fp").alias(f"{c}_fp")) for c in "ab")
        more = more.join(one, "a").join(two, "b").select(F.col("a_fp").alias("a"), F.col("b_fp").alias("b"))
        linked = linked.unionByName(more)
    joined = components(linked)
    rooted = vertices.join(joined, vertices["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        F.col("id").alias(id), hex16("fp").alias("fingerprint"), "component_id"
    )


def hex16(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
