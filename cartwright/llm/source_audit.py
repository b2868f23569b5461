"""How far the sources of a language differ in the terms they use.

Tasks count terms by sorting pointers to word starts (``term_runs``) and give back one row per
language, source and term of a slice; everything else is joins and aggregates of those counts.
Shares are whole numbers (``SCALE`` + 1 at most), so results are exact and do not depend on how rows are split.

Sources are compared in blocks: the sources of a language are numbered and cut into blocks of
``BLOCK``, and for each pair of blocks the terms are dealt over ``SLICES`` tasks. A task reads its
terms in order, fills small dense matrices (terms x sources of a block) and adds up absolute
differences, so pairs of sources are never emitted per term. Terms that no source of two blocks
has are not rows at all: what they add is the same for each and comes from their number.

Defined cases: null text, language or source count as ''. A row is a document, also when its id
repeats or is null. Languages without a kept term give pairs of value 0 and no terms; a language
with one source gives no pairs; no rows give no rows. Only the three named columns are read, so
other columns cannot clash. A text of any length is counted whole; a slice holds at least one
whole text, at about 60 bytes of memory per term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.lineage import build_side, stage
from cartwright.llm import term_runs
from cartwright.llm import text as t

# Fixed values of the audit.
LEAST_DOCUMENTS, SCALE, SMOOTH, TOP_TERMS = 30, 1_000_000_000, 5, 50

SLICE_BYTES = 1 << 24
BLOCK, SLICES, CHUNK_TERMS = 128, 256, 4096

COUNTED = "lang string, source string, term string, docs long, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each slice; a row without a term stands for each group that occurs."""
    for part in t.slices(_gathered(batches), "text", SLICE_BYTES):
        pairs = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist()))
        names = {x: i for i, x in enumerate(dict.fromkeys(pairs))}
        code = np.array([names[x] for x in pairs], np.int32)
        by_group = np.argsort(code, kind="stable")
        data, bounds = t.flat(part.column("text").take(pa.array(by_group)))
        starts, ends, first = t.words(data, bounds, term_runs.LETTERS)
        row = t.rows_of(first).astype(np.int32)
        pointers = term_runs.Pointers(data, starts, ends)
        at, group, docs, n = term_runs.cells(pointers, code[by_group][row], row)
        spelled, to = pointers.spelled(at)
        terms = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(spelled)).cast(pa.string())
        langs, sources = (pa.array([x[i] for x in names], pa.string()) for i in (0, 1))
        none = pa.array([0] * len(names), pa.int64())
        columns = [langs, sources, pa.nulls(len(names), pa.string()), none, none]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "docs", "n"])
        for some in range(0, len(at), 1 << 16):
            here = slice(some, some + (1 << 16))
            groups = pa.array(group[here])
            columns = [langs.take(groups), sources.take(groups), terms[here], pa.array(docs[here]), pa.array(n[here].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "docs", "n"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined up to the size of a slice, so that a slice counts as many texts as it may."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SLICE_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _share(count: Column, total: str = "total", kept: str = "kept") -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * kept)), in decimals, so that it is exact at any size."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTH).cast("decimal(20,0)")
    return F.call_function("div", top, (F.col(total) + SMOOTH * F.col(kept)).cast("decimal(20,0)")) + 1


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, docs, n): documents and occurrences of every term of every source; the
    null term stands for the source itself."""
    read = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = read.mapInArrow(_count, COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least_docs: int = LEAST_DOCUMENTS, top: int = TOP_TERMS
) -> DataFrame:
    """(lang, source, part, item, value, rank): each source against the others of its language
    (part ``pair``) and the ``top`` terms it uses more than its language does (part ``term``)."""
    counts = stage(term_counts(docs, lang, source, text), "term-counts")
    kept = stage(
        counts.where("term is not null")
        .groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= least_docs)
        .select("lang", "term", "lang_n"),
        "kept-terms",
    )
    cells = stage(counts.where("term is not null").drop("docs").join(build_side(kept), ["lang", "term"]), "term-cells")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stage(groups.na.fill(0, ["total", "kept", "lang_total"]).withColumn("place", place), "term-sources")
    shares = cells.join(build_side(groups), ["lang", "source"]).withColumn("p", _share(F.col("n")))
    return _terms(shares, top).unionByName(_pairs(shares, groups))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    """The terms of each source that lie furthest above their language."""
    over = shares.withColumn("value", F.col("p") - _share(F.col("lang_n"), "lang_total")).where("value > 0")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    ranked = over.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source against each other one."""
    block = F.expr(f"place div {BLOCK}").cast("int")
    absent = F.when(F.col("kept") > 0, _share(F.lit(0))).otherwise(0)
    blocks = build_side(stage(groups.groupBy("lang").agg((F.max(block) + 1).alias("blocks")), "source-blocks"))

    def dealt(rows: DataFrame) -> DataFrame:
        """A row for each pair of blocks that its block is part of."""
        met = rows.withColumn("block", block).join(blocks, "lang").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        return met.select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))

    columns = ["lang", "low", "high", "slice", "term", "place", "p"]
    found = dealt(shares).withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(SLICES)).cast("int")).select(columns)
    heads = dealt(groups.withColumn("p", absent)).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    rows = found.unionByName(heads.withColumn("term", F.lit(None).cast("string")).select(columns))
    sorted_rows = rows.repartition("lang", "low", "high", "slice").sortWithinPartitions("lang", "low", "high", "slice", "term", "place")
    parts = sorted_rows.mapInArrow(_differences, "lang string, a int, b int, value long, terms long")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    named = groups.select("lang", "kept", F.col("place"), "source", absent.alias("p"))
    one, two = named.select("lang", "kept", F.col("place").alias("a"), "source", F.col("p").alias("pa")), named.select(
        "lang", F.col("place").alias("b"), F.col("source").alias("item"), F.col("p").alias("pb")
    )
    pairs = sums.join(one, ["lang", "a"]).join(two, ["lang", "b"])
    value = F.col("value") + (F.col("kept") - F.col("terms")) * F.abs(F.col("pa") - F.col("pb"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn("rank", rank)


class _Block:
    """Sums over the terms read so far for one pair of blocks and one slice of terms."""

    def __init__(self, key: tuple):
        self.key, self.value, self.terms = key, None, 0
        self.absent = np.zeros((2, BLOCK), np.int64)
        self.count = [0, 0]

    def add(self, known: np.ndarray, place: np.ndarray, p: np.ndarray, term: np.ndarray) -> None:
        """Rows in order; ``known`` tells terms from heads, ``term`` numbers the terms from 0."""
        _, low, high, _ = self.key
        sides = [low] if low == high else [low, high]
        for side, block in enumerate(sides):
            here = (place // BLOCK == block) & ~known
            self.absent[side, place[here] % BLOCK] = p[here]
            self.count[side] = max(self.count[side], int(place[here].max()) % BLOCK + 1 if here.any() else 0)
        if self.value is None:
            self.value = np.zeros((BLOCK, BLOCK), np.int64)
        place, p, term = place[known], p[known], term[known]
        for begin in range(0, int(term[-1]) + 1 if len(term) else 0, CHUNK_TERMS):
            these = slice(*np.searchsorted(term, [begin, begin + CHUNK_TERMS]))
            n = int(term[these][-1]) - begin + 1
            wide = []
            for side, block in enumerate(sides):
                filled = np.repeat(self.absent[side : side + 1, : self.count[side]], n, axis=0)
                here = place[these] // BLOCK == block
                filled[term[these][here] - begin, place[these][here] % BLOCK] = p[these][here]
                wide.append(filled)
            for i in range(wide[0].shape[1]):
                self.value[i, : wide[-1].shape[1]] += np.abs(wide[-1] - wide[0][:, i : i + 1]).sum(axis=0)
            self.terms += n

    def result(self) -> pa.RecordBatch:
        lang, low, high, _ = self.key
        width = self.count[0], self.count[0 if low == high else 1]
        a, b = (x.ravel() for x in np.indices(width))
        value = self.value[: width[0], : width[1]].ravel()
        a, b = a + low * BLOCK, b + high * BLOCK
        if low == high:
            a, b, value = a[a != b], b[a != b], value[a != b]
        else:
            a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
        columns = [pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(value)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(a), self.terms, np.int64))], ["lang", "a", "b", "value", "terms"])


def _changes(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before; nulls are equal."""
    if len(column) < 2:
        return np.ones(len(column), bool)
    same = pc.equal(column[1:], column[:-1])
    both = pc.and_(pc.is_null(column[1:]), pc.is_null(column[:-1]))
    return np.concatenate([[True], ~pc.if_else(both, True, pc.fill_null(same, False)).to_numpy(zero_copy_only=False)])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences, from rows sorted by slice and term. The rows of the last term
    of a batch wait for the next batch, as a term's rows count together."""
    block, held = None, None
    for batch in _then_none(batches):
        if batch is not None:
            held = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()
            held = held[0] if held else batch
            if not held.num_rows:
                held = None
                continue
        if held is None:
            continue
        cut = np.zeros(held.num_rows, bool)
        for name in ("lang", "low", "high", "slice"):
            cut |= _changes(held.column(name))
        fresh = cut | _changes(held.column("term"))
        end = held.num_rows if batch is None else int(np.flatnonzero(fresh)[-1])
        place, p = (held.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("place", "p"))
        known = ~pc.is_null(held.column("term")).to_numpy(zero_copy_only=False)
        bounds = np.append(np.flatnonzero(cut[:end]), end)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            key = tuple(held.column(c)[a].as_py() for c in ("lang", "low", "high", "slice"))
            if block is None or block.key != key:
                if block is not None:
                    yield block.result()
                block = _Block(key)
            number = np.cumsum(fresh[a:b] & known[a:b]) - 1
            block.add(known[a:b], place[a:b], p[a:b], number)
        held = held.slice(end)
        if not held.num_rows:
            held = None
    if block is not None:
        yield block.result()


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None
