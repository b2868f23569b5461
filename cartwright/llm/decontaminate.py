"""Benchmark passages in documents, by winnowing.

A benchmark item is cut into windows of ``length`` consecutive words; a shorter item is one
window. Texts are turned into hashes of k consecutive words, and of every run of w hashes the
least is kept. With windows of k + w - 1 words, a span shared by a document and an item keeps the
same hash on both sides, so every occurrence of a window has a kept hash at the window's own place.
Windows of each length (``length`` and what shorter items have) are winnowed by their own k
and w, so a short item changes nothing for the others. Kept hashes of documents pass a Bloom filter of the items' hashes (a fixed
number of bits, so its size is bounded) and carry the words around them; joined with the items on
the hash, a hit is extended to the whole window by comparing words.

Windows with the same words are one window. Hits are sets of (document, window, place); an item
is looked up from its windows at the end, so a passage that stands in many items costs one hit.

Defined cases: null and empty texts have no words and are never hit; an item without words has no
window. Every row has its own result, whatever its id is: null ids and ids on several texts are kept
apart by the number of the row. Without items nothing is hit. Only the named columns are read, so other
columns cannot clash. Texts of any length are read whole, as one slice at least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cartwright.lineage import stage
from cartwright.llm import bloom
from cartwright.llm import text as t

WINDOW_WORDS = 10
GRAM_WORDS = 5
FILTER_BITS = 1 << 23
PROBES = 3


def item_windows(items: DataFrame, id: str, text: str, length: int = WINDOW_WORDS) -> DataFrame:
    """(item, words): the windows of every item."""
    lower = F.translate(F.col(text), t.UPPER_LETTERS, t.LOWER_LETTERS)
    words = F.regexp_extract_all(lower, F.lit(f"({t.ALNUM_WORD})"), F.lit(1))
    found = items.select(F.col(id).alias("item"), words.alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - length, F.lit(0))
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, length))
    return found.select("item", F.explode(F.array_distinct(windows)).alias("words"))


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """The least of each run of w values."""
    out = h[: max(len(h) - w + 1, 0)]
    for i in range(1, w):
        out = np.minimum(out, h[i : i + len(out)])
    return out


def gram_words(n: int) -> int:
    """k of the windows of n words; w is n - k + 1, so that a window has one kept hash of its own."""
    return min(GRAM_WORDS, n)


def _of_class(g: np.ndarray, n: int) -> np.ndarray:
    """Hashes of windows of different lengths are kept apart."""
    return t.mix(g + np.uint64(n))


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words, fp, place) of windows: the last of the least hashes of k words, and where it stands."""
    for batch in batches:
        words = batch.column(0).to_pylist()
        joined = pa.array([" ".join(w) for w in words], pa.string())
        data, bounds = t.flat(joined)
        starts, ends, first = t.words(data, bounds, t.ALNUM)
        h = t.hashes(data, starts, ends)
        fp, place = [], []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            g = t.grams(h[a:b], gram_words(b - a))
            at = len(g) - 1 - int(np.argmin(g[::-1]))
            fp.append(int(_of_class(g[at : at + 1], b - a).view(np.int64)[0]))
            place.append(at)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp, pa.int64()), pa.array(place, pa.int32())], ["words", "fp", "place"])


def kept_places(h: np.ndarray, first: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash) of the winnowed k-grams of the rows."""
    g = t.grams(h, k)
    ok = t.same_row(first, k)
    least = _least(g, w)
    whole = np.flatnonzero(t.same_row(first, k + w - 1))
    chosen = np.zeros(len(g), bool)
    for i in range(w):
        at = whole + i
        chosen[at[g[at] == least[whole]]] = True
    at = np.flatnonzero(chosen & ok)
    return at, g[at]


def _marked_rows(rest: list[str], lengths: list[int], marks: np.ndarray):
    """Per row: words, and the kept hashes of every length of windows that pass the filter, with the
    words a window can have on both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "_text"):
            data, bounds = t.flat(part.column("_text"))
            data = t.LOWER[data]
            starts, ends, first = t.words(data, bounds, t.ALNUM)
            h = t.hashes(data, starts, ends)
            found = []
            for n in lengths:
                k = gram_words(n)
                at, g = kept_places(h, first, k, n - k + 1)
                g = _of_class(g, n)
                passed = bloom.holds(marks, g, FILTER_BITS, PROBES)
                at, g = at[passed], g[passed]
                row = np.searchsorted(first, at, side="right") - 1
                found.append((row, at, g, np.maximum(at - (n - k), first[row]), np.minimum(at + n, first[row + 1])))
            row, at, g, low, high = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(row, kind="stable")
            row, at, g, low, high = (c[order] for c in (row, at, g, low, high))
            body = data.tobytes()
            a, b = starts.tolist(), ends.tolist()
            around = [[body[a[i] : b[i]].decode() for i in range(x, y)] for x, y in zip(low.tolist(), high.tolist())]
            hits = [
                {"fp": f, "place": p, "before": n, "around": c}
                for f, p, n, c in zip(g.view(np.int64).tolist(), (at - first[row]).tolist(), (at - low).tolist(), around)
            ]
            edges = np.searchsorted(row, np.arange(part.num_rows + 1)).tolist()
            of_rows = [hits[x:y] for x, y in zip(edges[:-1], edges[1:])]
            kind = pa.list_(pa.struct([("fp", pa.int64()), ("place", pa.int64()), ("before", pa.int32()), ("around", pa.list_(pa.string()))]))
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in rest], pa.array(np.diff(first), pa.int64()), pa.array(of_rows, kind)],
                [*rest, "n_words", "_hits"],
            )

    return run


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = WINDOW_WORDS,
) -> DataFrame:
    """(id, n_words, n_hit, items): words in occurrences of windows, and the items these are of."""
    windows = stage(item_windows(items, item_id, item_text, length), "bench-windows")
    lengths = sorted(r[0] for r in windows.select(F.size("words")).distinct().collect()) or [length]
    distinct = windows.select("words").distinct().mapInArrow(_window_hashes, "words array<string>, fp long, place int")
    distinct = stage(distinct, "bench-hashes")
    marks = bloom.build(distinct.select("fp").distinct(), FILTER_BITS, PROBES)
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("_text"))
    schema = source.select("id").schema.add("n_words", "long")
    hit = DataType.fromDDL("array<struct<fp:long,place:long,before:int,around:array<string>>>")
    marked = source.mapInArrow(_marked_rows(["id"], lengths, marks), schema.add("_hits", hit))
    # Results are of rows, not of ids, which may be null or shared; the number of a row is fixed by writing it.
    marked = stage(marked.withColumn("row", F.monotonically_increasing_id()), "bench-marked")
    hits = marked.select("row", F.explode("_hits").alias("h")).select("row", "h.*")
    begin = F.col("before") - F.col("at")
    spans = (
        hits.join(distinct.select("fp", "words", F.col("place").alias("at")), "fp")
        .where((begin >= 0) & (F.slice("around", F.greatest(begin, F.lit(0)) + 1, F.size("words")) == F.col("words")))
        .select("row", (F.col("place") - F.col("at")).alias("start"), "words")
        .distinct()
    )
    spans = stage(spans, "bench-hits")
    # A span of n words from start: the union of the spans of a row, in order of their starts.
    nothing = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    sorted_spans = F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.size("words")).alias("stop"))))
    union = F.aggregate(
        sorted_spans,
        nothing,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["stop"]).alias("end"),
            (acc["n"] + F.greatest(s["stop"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"),
        ),
    )
    covered = spans.groupBy("row").agg(union["n"].alias("n_hit"))
    # Windows meet their items once per document.
    of_items = spans.select("row", "words").distinct().join(windows, "words").select("row", "item").distinct()
    of_items = of_items.groupBy("row").agg(F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("items"))
    out = marked.select("row", "id", "n_words").join(covered, "row", "left").join(of_items, "row", "left")
    return out.select(
        F.col("id").alias(id),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
