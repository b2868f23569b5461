"""Pairs of rows whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Each row gets ``BANDS`` keys, each made of ``BAND_ROWS`` minima over its shingles; two rows share a
key with probability J ** BAND_ROWS, so a pair at 0.8 shares one of the twenty with 0.9996. Rows
of equal shingles are one while keys are dealt. All rows that share a key meet, in two steps, and
are compared exactly, on their whole sets:

1. Each row meets up to four leaders of the key, its least ids in four orders, which are found by
   minima that are taken before the shuffle. That joins most large groups, with candidates linear in
   the rows; all pairs of a key of up to three rows are among them.
2. Where the rows of a key are not yet one component, every two rows of different components are
   compared: a task gets the sets of the key's rows and gives the links that join components, not
   pairs. Keys of the same rows count once. A key of more than ``CELL_SHINGLES`` shingles is cut into
   blocks, and every two blocks meet in a task of their own.

The links connect all similar pairs that share a key; pairs within a component need not be given.
Only the rows that met anyone have their sets made: a Bloom filter of their ids lets them through
where the texts are read.

Defined cases: words are runs of visible bytes, in lower case. A row of fewer than five words has
one shingle, all its words; a row without words is in no pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.lineage import stage
from cartwright.llm import bloom, simhash
from cartwright.llm import text as t

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 20
BAND_ROWS = 5
CELL_SHINGLES = 1 << 20
FILTER_BITS, PROBES = 1 << 25, 4

_SEEDS = t.mix(np.arange(1, 2 * BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, -1)
# The least id after an exclusive or with one of these: the least, the greatest and two others.
_ORDERS = (0, -1, 0x5555555555555555, 0x3333333333333333)


def shingles(column: pa.Array, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, row by row; n + 1 row bounds)"""
    data, bounds = t.flat(column)
    data = t.LOWER[data]
    starts, ends, first = t.words(data, bounds, t.VISIBLE)
    h = t.hashes(data, starts, ends)
    at = np.flatnonzero(t.same_row(first, n))
    row, values = np.searchsorted(first, at, side="right") - 1, t.grams(h, n)[at]
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    whole = count[short].astype(np.uint64)
    for i in range(n - 1):
        more = count[short] > i
        whole[more] = t.mix(whole[more] + h[first[short[more]] + i])
    row, values = np.concatenate([row, short]), np.concatenate([values, whole])
    order = np.argsort(row, kind="stable")
    return values[order], np.searchsorted(row[order], np.arange(len(count) + 1))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row with words: number and two sums of its shingles, and its keys."""
    for part in t.slices(batches, "text"):
        values, edges = shingles(part.column("text"))
        filled = np.flatnonzero(np.diff(edges))
        if not len(filled):
            continue
        at = edges[:-1][filled]
        keys = np.empty((len(filled), BANDS), np.uint64)
        for band in range(BANDS):
            key = np.full(len(filled), band + 1, np.uint64)
            for i in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
                key = t.mix(key + np.minimum.reduceat((values ^ _SEEDS[0, i]) * (_SEEDS[1, i] | np.uint64(1)), at))
            keys[:, band] = key
        sums = [np.add.reduceat(t.mix(values ^ _SEEDS[i, 0]), at).view(np.int64) for i in range(2)]
        bounds = pa.array(np.arange(len(filled) + 1) * BANDS, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id").take(pa.array(filled)),
                pa.array(np.diff(edges)[filled], pa.int64()),
                *[pa.array(s) for s in sums],
                pa.ListArray.from_arrays(bounds, pa.array(keys.ravel().view(np.int64))),
            ],
            ["id", "n", "d1", "d2", "keys"],
        )


def _sets(marks) -> Callable:
    """The distinct shingles of each row whose id is in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            ids = part.column("id").to_numpy(zero_copy_only=False).view(np.uint64)
            part = part.filter(pa.array(bloom.holds(marks.value, ids, FILTER_BITS, PROBES)))
            if not part.num_rows:
                continue
            values, edges = shingles(part.column("text"))
            cuts = zip(edges[:-1].tolist(), edges[1:].tolist())
            found = [np.unique(values[a:b]).view(np.int64) for a, b in cuts]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.list_(pa.int64()))], ["id", "shingles"])
        pa.default_memory_pool().release_unused()

    return run


def _joining(id: np.ndarray, part: np.ndarray, side: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links of similar rows that join the parts of a cell; rows of one block of two (side 1, side 2) do not meet."""
    size = np.array([len(x) for x in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    left = np.ones(len(sets), bool)
    while left.any():  # a row with too few shingles that others have as well is similar to none
        held = np.bincount(place[np.repeat(left, size)], minlength=place.max() + 1) > 1
        shared = np.add.reduceat(held[place], np.concatenate([[0], np.cumsum(size)[:-1]]))
        fewer = left & (shared >= similarity * size - 1e-6)
        settled, left = left.sum() - fewer.sum() <= 0.05 * left.sum(), fewer
        if settled:
            break
    order = np.flatnonzero(left)
    order = order[np.argsort(size[order], kind="stable")]
    starts = (np.cumsum(size) - size)[order]
    size, side, root = size[order], side[order], np.unique(part[order], return_inverse=True)[1]
    last = np.searchsorted(size, size / similarity + 1e-6, side="right")
    mark, links = np.zeros(len(place), bool), []
    for i in range(len(order)):
        j = np.arange(i + 1, last[i])
        j = j[(root[j] != root[i]) & ((side[j] == 0) | (side[j] != side[i]))]
        if not len(j):
            continue
        own = place[starts[i] : starts[i] + size[i]]
        mark[own] = True
        edges = np.cumsum(size[j]) - size[j]
        at = np.arange(size[j].sum()) + np.repeat(starts[j] - edges, size[j])
        both = np.add.reduceat(mark[place[at]], edges, dtype=np.int64)
        mark[own] = False
        for k in j[both / (size[i] + size[j] - both) >= similarity].tolist():
            if root[k] != root[i]:
                root[root == root[k]] = root[i]
                links.append((int(id[order[i]]), int(id[order[k]])))
    return links


def _meetings(similarity: float) -> Callable:
    """Rows come sorted by cell; one cell is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            id, part, side = (rows.column(c).to_numpy() for c in ("id", "part", "side"))
            values = rows.column("shingles").combine_chunks()
            flat, bounds = values.flatten().to_numpy(), np.concatenate([[0], np.cumsum(values.value_lengths().to_numpy())])
            links = _joining(id, part, side, [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])], similarity)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            cell = batch.column("cell").to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b == a:
                    continue
                if held and cell[a] != now:
                    yield out()
                    held = []
                now = cell[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield out()
            held = []
        pa.default_memory_pool().release_unused()

    return run


def _rest(crowd: DataFrame, found: DataFrame, sets: DataFrame, similarity: float, cell_shingles: int) -> DataFrame:
    """(a, b): links between rows of a key that ``found`` has not joined; ``crowd`` has the rows of keys of more than three."""
    joined = simhash.components(found)
    parts = crowd.join(joined.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n", F.coalesce("root", "id").alias("part"))
    parts = stage(parts, "near-parts")
    same = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"same{i}") for i in range(2)]
    keys = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), *same, F.min("part").alias("least"), F.max("part").alias("most")
    )
    open_keys = keys.where("least < most").groupBy("rows", "same0", "same1").agg(F.min("key").alias("key"), F.first("n").alias("n"))
    blocks = F.when(F.col("n") <= cell_shingles, 1).otherwise(F.ceil(F.col("n") * 2 / F.lit(cell_shingles))).cast("int")
    rest = parts.drop("n").join(open_keys.select("key", blocks.alias("blocks")), "key")
    mine = F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int")
    cells = (
        rest.withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
            "id",
            "part",
            F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).cast("byte").alias("side"),
        )
    )
    cells = stage(cells, "near-cells").join(sets, "id")
    met = cells.repartition("cell").sortWithinPartitions("cell").select("cell", "id", "part", "side", "shingles")
    return stage(met.mapInArrow(_meetings(similarity), "a long, b long"), "near-rest")


def similar(
    docs: DataFrame, id: str, text: str = "text", similarity: float = SIMILARITY, cell_shingles: int = CELL_SHINGLES
) -> DataFrame:
    """(a, b): links of similar rows that connect all similar pairs; ``id`` is a whole number, another in every row."""
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    signed = stage(source.mapInArrow(_signatures, "id long, n long, d1 long, d2 long, keys array<long>"), "near-signatures")
    equal = ["n", "d1", "d2"]
    firsts = stage(signed.groupBy(*equal).agg(F.min("id").alias("first")), "near-firsts")
    copies = signed.select("id", *equal).join(firsts, equal).where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    dealt = signed.join(firsts.select(F.col("first").alias("id")), "id", "left_semi").select("id", "n", F.explode("keys").alias("key"))
    dealt = stage(dealt, "near-keys")
    least = [F.min(F.col("id").bitwiseXOR(F.lit(x).cast("long"))).bitwiseXOR(F.lit(x).cast("long")) for x in _ORDERS]
    leaders = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.array_distinct(F.array(*least)).alias("leaders")).where("rows > 1")
    crowd = stage(dealt.join(stage(leaders, "near-leaders"), "key"), "near-crowd")
    met = crowd.select("id", F.explode("leaders").alias("leader")).where("id <> leader")
    pairs = stage(met.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct(), "near-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    marks = docs.sparkSession.sparkContext.broadcast(bloom.build(wanted, FILTER_BITS, PROBES))
    sets = stage(source.mapInArrow(_sets(marks), "id long, shingles array<long>"), "near-sets")
    one, two = (sets.select(F.col("id").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "ab")
    shared = pairs.join(one, "a").join(two, "b").select(
        "a", "b", F.size(F.array_intersect("a_set", "b_set")).alias("both"), (F.size("a_set") + F.size("b_set")).alias("sum")
    )
    found = stage(shared.where(F.col("both") / (F.col("sum") - F.col("both")) >= similarity).select("a", "b"), "near-found")
    return copies.unionByName(found).unionByName(_rest(crowd.where("rows > 3"), found, sets, similarity, cell_shingles))
