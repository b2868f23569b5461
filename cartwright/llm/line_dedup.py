"""Lines that stand in several documents stay in the document of least id only.

A line's key is the line without white space at its ends, in lower case. Every task marks the
hashes of its documents' keys in two Bloom filters, one for keys seen once and one for keys seen
again; merged over the tasks, the second holds every key of two documents. Only lines that pass
it are shuffled. There the keys themselves are compared: a key of one document only is let go, the
others name the least document that holds them, and every other document drops their lines.

The filter has ``filter_bits`` bits at any input size. With many more keys than bits it lets more
single lines through to the comparison; the result is the same.

Defined cases: a null or empty text is one empty line. Keys shorter than ``least_chars`` code
points stay. All lines of a key within its first document stay. Rows that repeat an id are one
document: each keeps or drops by the same keys, and line numbers go by id and text, as the rows may
have different texts. Rows without an id are no document; they keep all their lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.lineage import stage
from cartwright.llm import bloom
from cartwright.llm import text as t

LEAST_CHARS = 10
FILTER_BITS = 1 << 28
PROBES = 2


def keyed_lines(column: pa.Array, least_chars: int):
    """(lower-case bytes, row, number in the row, key start, key end, hash) of the lines with a long enough key."""
    data, bounds = t.flat(column)
    data = t.LOWER[data]
    row, begin, end = t.lines(data, bounds)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    starts, ends, _ = t.words(data, bounds, t.VISIBLE)
    first, last = np.searchsorted(starts, begin), np.searchsorted(starts, end) - 1
    at = np.flatnonzero(last >= first)
    row, place, begin, end = row[at], place[at], starts[first[at]], ends[last[at]]
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = chars[end] - chars[begin] >= least_chars
    row, place, begin, end = row[long], place[long], begin[long], end[long]
    return data, row, place, begin, end, t.hashes(data, begin, end)


def digest(text: str) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.octet_length(text))


def drop_places(docs: DataFrame, id: str, text: str, least_chars: int = LEAST_CHARS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(id, digest, places): the numbers of the lines that each text of a document drops."""
    texts = docs.where(F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(text).alias("text"), digest(text).alias("digest"))

    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        """The hashes of the keys, each once per document."""
        for part in t.slices(iter([batch]), "text"):
            _, row, _, _, _, h = keyed_lines(part.column("text"), least_chars)
            _, at = np.unique(t.mix(h + t.mix(row.astype(np.uint64))), return_index=True)
            yield h[at]

    marks = bloom.build(texts, filter_bits, PROBES, twice=True, hashes_of=hashes_of)
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            data, row, place, begin, end, h = keyed_lines(part.column("text"), least_chars)
            at = np.flatnonzero(bloom.holds(shared.value, h, filter_bits, PROBES))
            body = data.tobytes()
            keys = [body[a:b].decode() for a, b in zip(begin[at].tolist(), end[at].tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(row[at])),
                    part.column("digest").take(pa.array(row[at])),
                    pa.array(keys, pa.string()),
                    pa.array(place[at], pa.int32()),
                ],
                ["id", "digest", "key", "place"],
            )

    schema = texts.select("id", "digest").schema.add("key", "string").add("place", "integer")
    suspects = stage(texts.mapInArrow(suspected, schema), "suspect-lines")
    firsts = suspects.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    gone = suspects.join(firsts.select("key", "first"), "key").where("id > first")
    return gone.groupBy("id", "digest").agg(F.collect_set("place").alias("places"))


def dedup_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """``docs`` with the text that is left, ``n_lines`` (before) and ``n_dropped``."""
    places = drop_places(docs, id, text, least_chars, filter_bits)
    carried = t.Carried(docs, text, (text, "n_lines", "n_dropped"), id=id)
    joined = carried.frame.withColumn("digest", digest("text")).join(places, ["id", "digest"], "left").select("text", "rest", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text"):
            kept, n, dropped = [], [], []
            for body, gone in zip(part.column("text").to_pylist(), part.column("places").to_pylist()):
                lines = (body or "").split("\n")
                out = set(gone or ())
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in out) if out else body)
                n.append(len(lines))
                dropped.append(len(out))
            yield t.added(part.column("rest"), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()))

    return carried.run(run, {text: "string", "n_lines": "long", "n_dropped": "long"}, joined)
