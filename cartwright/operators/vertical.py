"""Transactions turned on their side: for each item of a group, the places of its transactions.

A block holds up to ``BLOCK`` transactions of one group. Per item it has the 16-bit places of its
transactions or, where that is shorter, one bit for each place. How often a set of items occurs
in a block is the number of bits left when the bitmaps of its items meet, so sets are counted
without touching transactions again, and the counts of blocks add up. Only blocks and sets
are sent over the network, a block once per list of sets that is to be counted in it.

The functions that run in tasks travel with the job; workers need numpy and pyarrow.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 8192
EXPANDED = 512
PORTION = 64
OPEN_PAIRS = 1 << 22

BLOCKS = "grp long, n int, items array<long>, sizes array<int>, body binary"


def blocks(transactions: DataFrame, group: str, items: str, id: str, size: str) -> DataFrame:
    """``BLOCKS`` of all transactions; ``items`` holds each item once, ``size`` is the number of
    transactions of the group. A group of any size is cut into ranges of a hash of the id, which
    are dealt over the tasks."""
    # Ranges of about half a block, so that uneven hashes seldom make two blocks of one.
    part = F.pmod(F.xxhash64(id), F.ceil(F.col(size) / (BLOCK // 2)))
    rows = transactions.select(F.col(group).alias("grp"), part.alias("part"), F.col(items).alias("items"))
    return rows.repartition(_tasks(rows), "grp", "part").sortWithinPartitions("grp", "part").mapInArrow(_built, BLOCKS)


def _tasks(df: DataFrame) -> int:
    """All shuffle partitions: the rows are few for the work they make, so they are not to be merged."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, held, n = None, [], 0

    def out() -> pa.RecordBatch:
        place = np.repeat(np.arange(n), np.concatenate([s for s, _ in held]))
        names, index = np.unique(np.concatenate([v for _, v in held]), return_inverse=True)
        place = place[np.argsort(index, kind="stable")]
        sizes = np.bincount(index, minlength=len(names))
        body = b"".join(_packed(part, n) for part in np.split(place, np.cumsum(sizes)[:-1])) if len(names) else b""
        columns = [[key[0]], [n], [names.tolist()], [sizes.tolist()], [body]]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["grp", "n", "items", "sizes", "body"])

    for batch in batches:
        group, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("grp", "part"))
        lists = batch.column("items")
        size, values = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
        first = np.concatenate([[0], np.cumsum(size)])
        cut = np.flatnonzero((group[1:] != group[:-1]) | (part[1:] != part[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(group)]):
            while a < b:
                if held and (key != (group[a], part[a]) or n == BLOCK):
                    yield out()
                    held, n = [], 0
                key, end = (group[a], part[a]), min(b, a + BLOCK - n)
                held.append((size[a:end], values[first[a] : first[end]]))
                n, a = n + end - a, end
    if held:
        yield out()


def _packed(places: np.ndarray, n: int) -> bytes:
    if 16 * len(places) <= n:
        return places.astype("<u2").tobytes()
    marks = np.zeros(n, bool)
    marks[places] = True
    return np.packbits(marks, bitorder="little").tobytes()


class _Block:
    """A block as it is read: where the bits of each item lie."""

    def __init__(self, n: int, items: np.ndarray, sizes: np.ndarray, body: bytes):
        self.n, self.items, self.sizes, self.body = n, items, sizes, body
        self.listed = 16 * sizes <= n
        width = np.where(self.listed, 2 * sizes, (n + 7) // 8)
        self.at = np.concatenate([[0], np.cumsum(width)])

    def places(self, i: int) -> np.ndarray:
        part = self.body[self.at[i] : self.at[i + 1]]
        if self.listed[i]:
            return np.frombuffer(part, "<u2")
        return np.flatnonzero(np.unpackbits(np.frombuffer(part, np.uint8), count=self.n, bitorder="little"))

    def bitmaps(self, which: np.ndarray) -> np.ndarray:
        """(items, words): 64 places to a word."""
        words = (self.n + 63) // 64
        out = np.zeros((len(which), words * 8), np.uint8)
        for begin in range(0, len(which), EXPANDED):
            some = which[begin : begin + EXPANDED]
            marks = np.zeros((len(some), self.n), bool)
            for row, i in enumerate(some.tolist()):
                marks[row, self.places(i)] = True
            packed = np.packbits(marks, axis=1, bitorder="little")
            out[begin : begin + len(some), : packed.shape[1]] = packed
        return out.view(np.uint64)

    def index(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each value among the items, is it one of them)."""
        at = np.minimum(np.searchsorted(self.items, values), max(len(self.items) - 1, 0))
        return at, self.items[at] == values if len(self.items) else np.zeros(values.shape, bool)


def _read(batch: pa.RecordBatch) -> Iterator[_Block]:
    lists = [(batch.column(c).value_lengths().to_numpy(), batch.column(c).flatten().to_numpy()) for c in ("items", "sizes")]
    at = [np.concatenate([[0], np.cumsum(size)]) for size, _ in lists]
    for i, (n, body) in enumerate(zip(batch.column("n").to_pylist(), batch.column("body"))):
        items, sizes = (values[a[i] : a[i + 1]] for a, (_, values) in zip(at, lists))
        yield _Block(n, items, sizes.astype(np.int64), body.as_py())


def count_singles(all_blocks: DataFrame) -> DataFrame:
    """(grp, set, cnt) of every item."""
    pairs = all_blocks.select("grp", F.explode(F.arrays_zip("items", "sizes")).alias("x"))
    return pairs.select("grp", F.array("x.items").alias("set"), F.col("x.sizes").cast("long").alias("cnt"))


def count_pairs(with_alive: DataFrame) -> DataFrame:
    """(grp, set, cnt) of the pairs of items that occur together; the blocks carry, in ``alive``, the
    sorted items worth looking at."""
    return with_alive.mapInArrow(_pair_counts, "grp long, set array<long>, cnt long")


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        groups, alive = batch.column("grp").to_pylist(), batch.column("alive")
        for i, block in enumerate(_read(batch)):
            keep = np.flatnonzero(np.isin(block.items, np.asarray(alive[i].values.to_numpy())))
            found = _pairs(block, keep)
            if len(found[0]):
                a, b = block.items[keep[found[0]]], block.items[keep[found[1]]]
                sets = pa.ListArray.from_arrays(np.arange(0, 2 * len(a) + 1, 2, dtype=np.int32), np.stack([a, b], axis=1).ravel())
                yield pa.RecordBatch.from_arrays([pa.array([groups[i]] * len(a), pa.int64()), sets, pa.array(found[2])], ["grp", "set", "cnt"])


def _pairs(block: _Block, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, transactions) of the pairs of kept items, smaller one first."""
    if len(keep) < 2:
        return keep[:0], keep[:0], keep[:0]
    places = [block.places(i) for i in keep.tolist()]
    item = np.repeat(np.arange(len(keep)), [len(p) for p in places])
    place = np.concatenate(places)
    order = np.argsort(place, kind="stable")
    place, item = place[order], item[order]
    keys, counts, fresh, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def settle() -> None:
        nonlocal keys, counts
        found, n = np.unique(np.concatenate(fresh), return_counts=True)
        both, index = np.unique(np.concatenate([keys, found]), return_inverse=True)
        counts = np.bincount(index, np.concatenate([counts, n]), len(both)).astype(np.int64)
        keys = both
        fresh.clear()

    step, left = 1, np.arange(len(place) - 1)
    while len(left):
        left = left[place[left] == place[left + step]]
        fresh.append(item[left] * len(keep) + item[left + step])
        size += len(left)
        if size >= OPEN_PAIRS:
            settle()
            size = 0
        step += 1
        left = left[left + step < len(place)]
    if fresh:
        settle()
    return keys // len(keep), keys % len(keep), counts


def count_sets(owned: DataFrame, lists: DataFrame) -> DataFrame:
    """(owner, piece, pos, cnt): how often the sets of each list occur in the blocks of its owner.

    ``owned`` has the columns of a block and ``owner``, a row for each owner of the block. ``lists``
    has owner, piece and ``sets``, sets of one size in order. The blocks of an owner are dealt
    out in portions of about ``PORTION``; a task gets a list once for each portion, ahead of its blocks, and adds
    the counts up before they are shuffled.
    """
    portions = owned.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / PORTION).alias("portions"))
    keyed = lists.join(portions, "owner").withColumn("portion", F.explode(F.expr("sequence(0, portions - 1)")))
    empty = [F.lit(None).cast(owned.schema[c].dataType).alias(c) for c in ("n", "items", "sizes", "body")]
    heads = keyed.select("owner", "piece", "portion", "sets", *empty)
    dealt = owned.join(portions, "owner").withColumn("portion", F.expr("pmod(xxhash64(grp, body), portions)"))
    dealt = dealt.join(lists.select("owner", "piece"), "owner")
    bodies = dealt.select("owner", "piece", "portion", F.lit(None).cast(lists.schema["sets"].dataType).alias("sets"), "n", "items", "sizes", "body")
    rows = heads.unionByName(bodies).repartition(_tasks(lists), "owner", "piece", "portion")
    rows = rows.sortWithinPartitions("owner", "piece", "portion", F.col("sets").isNull())
    parts = rows.mapInArrow(_set_counts, "owner long, piece long, counts array<long>")
    found = parts.select("owner", "piece", F.posexplode("counts").alias("pos", "cnt")).where("cnt > 0")
    return found.groupBy("owner", "piece", "pos").agg(F.sum("cnt").alias("cnt"))


def _set_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, sets, counts = None, None, None

    def out() -> pa.RecordBatch:
        columns = [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([counts], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["owner", "piece", "counts"])

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("owner", "piece"))))
        lists = batch.column("sets")
        head = lists.is_valid().to_numpy(zero_copy_only=False)
        blocks_of = _read(batch.filter(pa.array(~head)))
        for i, is_head in enumerate(head.tolist()):
            if not is_head:
                counts += _occurrences(next(blocks_of), sets)
                continue
            if key != keys[i]:
                if key is not None:
                    yield out()
                values = lists[i].values
                sets = values.flatten().to_numpy().reshape(len(values), -1)
                key, counts = keys[i], np.zeros(len(sets), np.int64)
    if key is not None:
        yield out()


def _occurrences(block: _Block, sets: np.ndarray) -> np.ndarray:
    """Transactions of the block that hold each set (one set per row, all of one size)."""
    at, known = block.index(sets)
    here = np.flatnonzero(known.all(axis=1))
    out = np.zeros(len(sets), np.int64)
    if not len(here):
        return out
    which, index = np.unique(at[here], return_inverse=True)
    index = index.reshape(len(here), -1)
    bits = block.bitmaps(which)
    # The sets are in order, so those with the same items but the last stand together.
    head = index[:, :-1]
    new = np.append(True, (head[1:] != head[:-1]).any(axis=1))
    heads = head[new]
    met = bits[heads[:, 0]]
    for c in range(1, heads.shape[1]):
        met &= bits[heads[:, c]]
    of = np.cumsum(new) - 1
    for begin in range(0, len(here), EXPANDED):
        some = slice(begin, begin + EXPANDED)
        out[here[some]] = np.bitwise_count(met[of[some]] & bits[index[some, -1]]).sum(axis=1, dtype=np.int64)
    return out
