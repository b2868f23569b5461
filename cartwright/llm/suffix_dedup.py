"""Long repeated passages: bytes covered by a string of ``length`` bytes of an earlier document go.

Sorting all suffixes of a corpus would shuffle each of its bytes many times, so the places to sort
are found first. Every window of ``length`` bytes names an anchor, the k bytes in it of least hash.
Equal windows have equal anchors at equal offsets. So a window can only repeat if its anchor does:

1. Tasks send the hashes of the anchors, 5 bytes each, to the task of the hash. Hashes that come
   from two documents are sent back to their documents. Equal documents are left to the first.
2. Documents send the surroundings of those anchors to the task of the hash, where the windows of
   equal anchor and offset are told apart: a library sort (``np.lexsort``) by anchor and the first
   16 bytes, in place of multikey quicksort, as it runs on whole arrays and only equality counts,
   and blind tries for the groups that share them. A trie node knows only the place of the first byte in which its
   strings differ and the branches of that byte; the tries of all groups grow level by level
   together. Strings that end in one leaf are equal; the least document of a leaf keeps it.
3. Documents get the spans to cut out and cut them.

Each step sends a few bytes per anchor (one in 14 bytes); texts are shuffled once, by id. Tasks hold
a bounded number of anchors; an anchor that stands in very many documents is held as rows of about a
hundred bytes in one task, once per distinct document.

Defined cases: null and empty texts have no bytes. Rows that repeat an id are one document: their
texts do not repeat each other, and each is cut by what earlier documents have of it. Rows without an id are returned as they are. A document equal to an
earlier one loses all bytes if it has ``length`` bytes, else none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.lineage import stage
from cartwright.llm import text as t

LENGTH = 50
GRAM = 24
SHALLOW = 16

# How many anchors one task of the first and of the second step is meant to hold.
HASHES_PER_TASK = 1 << 22
CONTEXTS_PER_TASK = 1 << 17
SLICE_BYTES = 1 << 22
# Begin and end of a span, and the mark of the text it is in.
SPAN_BYTES = 24

_PLACE_BITS = np.uint64(30)
_SPREAD = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def anchors(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, k: int = GRAM):
    """(place, hash, first window start, last window start) of the anchors of all rows, in order."""
    starts = len(data) - length + 1
    if starts <= 0:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing.astype(np.uint64), nothing, nothing
    view = t.eight_bytes(data)
    n = len(data) - k + 1
    h = view[:n] * _SPREAD[0]
    at = 8
    while at < k:
        step = min(at, k - 8)
        h = (h ^ (h >> np.uint64(29))) * _SPREAD[1] + view[step : step + n] * _SPREAD[2]
        at += 8
    h = t.mix(h)
    # Least by (hash, place): the leftmost of equal hashes, so the choice depends on the window only.
    least = (h >> _PLACE_BITS << _PLACE_BITS) | np.arange(n, dtype=np.uint64)
    width, run = length - k + 1, 1
    while run * 2 <= width:
        least = np.minimum(least[:-run], least[run:])
        run *= 2
    if run < width:
        least = np.minimum(least[: len(least) - (width - run)], least[width - run :])
    place = (least & np.uint64((1 << 30) - 1)).astype(np.int64)
    ok = np.zeros(starts + 1, bool)
    inside = np.diff(bounds) >= length
    mark = np.zeros(len(data) + 2, np.int32)
    np.add.at(mark, bounds[:-1][inside], 1)
    np.add.at(mark, bounds[1:][inside] - length + 1, -1)
    ok = np.flatnonzero(np.cumsum(mark[:starts]) > 0)
    place = place[ok]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (ok[1:] != ok[:-1] + 1)])) if len(ok) else ok
    first, last = ok[new], ok[np.concatenate([new[1:] - 1, [len(ok) - 1]])] if len(ok) else ok
    return place[new], h[place[new]], first, last


def _codes(h: np.ndarray, tasks: int) -> tuple[np.ndarray, np.ndarray]:
    """(task, 40 bits) of hashes."""
    g = t.mix(h + np.uint64(1))
    return (g % np.uint64(tasks)).astype(np.int64), g >> np.uint64(24)


def _five(codes: np.ndarray) -> bytes:
    return np.ascontiguousarray(codes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(body: bytes) -> np.ndarray:
    raw = np.zeros((len(body) // 5, 8), np.uint8)
    raw[:, :5] = np.frombuffer(body, np.uint8).reshape(-1, 5)
    return raw.view("<u8").ravel()


def _five_joined(bodies: list[bytes]) -> np.ndarray:
    """The codes of several messages, without a copy of them end to end."""
    out = np.zeros(sum(map(len, bodies)) // 5, np.uint64)
    wide, at = out.view(np.uint8).reshape(-1, 8), 0
    for body in bodies:
        wide[at : at + len(body) // 5, :5] = np.frombuffer(body, np.uint8).reshape(-1, 5)
        at += len(body) // 5
    return out


def _small(values: np.ndarray) -> bytes:
    """Sorted whole numbers, as differences, packed."""
    body = np.diff(values, prepend=0).astype("<i8").tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(body, "zstd").to_pybytes()


def _from_small(body: bytes) -> np.ndarray:
    n = int.from_bytes(body[:8], "little")
    return np.cumsum(np.frombuffer(pa.decompress(body[8:], n * 8, "zstd"), "<i8"))


def _cuts(keys: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal sorted keys."""
    if not len(keys):
        return []
    at = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).tolist()
    return list(zip(at[:-1], at[1:]))


def _send_hashes(tasks: int, length: int):
    """(task, hashes, documents): the anchors of each document, each hash once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text", SLICE_BYTES):
            data, bounds = t.flat(part.column("text"))
            place, h, _, _ = anchors(data, bounds, length)
            if not len(place):
                continue
            row = np.searchsorted(bounds, place, side="right") - 1
            id = part.column("id").to_numpy(zero_copy_only=False)[row]
            task, code = _codes(h, tasks)
            order = np.lexsort((code, id, task))
            task, id, code = task[order], id[order], code[order]
            new = np.ones(len(id), bool)
            new[1:] = (task[1:] != task[:-1]) | (id[1:] != id[:-1]) | (code[1:] != code[:-1])
            task, id, code = task[new], id[new], code[new]
            cuts = _cuts(task)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(task[a]) for a, _ in cuts], pa.int32()),
                    pa.array([_five(code[a:b]) for a, b in cuts], pa.binary()),
                    pa.array([_small(id[a:b]) for a, b in cuts], pa.binary()),
                ],
                ["task", "codes", "ids"],
            )

    return run


def _by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of one task number after another; the rows come sorted by it."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != now:
                if held:
                    yield now, held
                now, held = row[0], []
            held.append(row[1:])
    if held:
        yield now, held


def _repeated_hashes(buckets: int):
    """The hashes of a task that come from two documents at least, packed for their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_task(batches):
            code = _five_joined([c for c, _ in rows])
            order = np.argsort(code)
            code = code[order]
            id = np.concatenate([_from_small(i) for _, i in rows])
            rows.clear()
            id = id[order]
            del order
            new = np.ones(len(code), bool)
            np.not_equal(code[1:], code[:-1], out=new[1:])
            at = np.flatnonzero(new)
            several = np.minimum.reduceat(id, at) != np.maximum.reduceat(id, at)
            keep = several[np.cumsum(new, dtype=np.int32) - 1]
            del new, at, several
            code, id = code[keep], id[keep]
            raw = np.frombuffer(_five(code), np.uint8).reshape(-1, 5)
            del keep, code
            yield from _packed(id, raw, buckets)
            del id, raw
            pa.default_memory_pool().release_unused()

    return run


PACKED = "bucket int, ids binary, counts binary, body binary"


def _packed(id: np.ndarray, items: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Items (rows of bytes) of documents, one row for all documents of a bucket."""
    bucket = (t.mix(id.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((id, bucket))
    id = id[order]
    bucket = bucket[order]
    items = items[order]
    del order
    for start, end in _cuts(bucket):
        runs = _cuts(id[start:end])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(bucket[start])], pa.int32()),
                pa.array([_small(id[start:end][[x for x, _ in runs]])], pa.binary()),
                pa.array([np.array([y - x for x, y in runs], np.int32).tobytes()], pa.binary()),
                pa.array([items[start:end].tobytes()], pa.binary()),
            ],
            ["bucket", "ids", "counts", "body"],
        )


def _of_documents(width: int):
    """(id, found, n): one row per document with all its items; the rows come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_task(batches):
            id = np.concatenate([np.repeat(_from_small(i), np.frombuffer(n, np.int32)) for i, n, _ in rows])
            items = np.concatenate([np.frombuffer(body, np.uint8) for _, _, body in rows]).reshape(-1, width)
            rows.clear()
            order = np.argsort(id, kind="stable")
            id, items = id[order], items[order]
            cuts = _cuts(id)
            for some in range(0, len(cuts), 10_000):
                part = cuts[some : some + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(id[x]) for x, _ in part], pa.int64()),
                        pa.array([items[x:y].tobytes() for x, y in part], pa.binary()),
                        pa.array([y - x for x, y in part], pa.int64()),
                    ],
                    ["id", "found", "n"],
                )

    return run


def _by_document(packed: DataFrame, buckets: int, width: int) -> DataFrame:
    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(_of_documents(width), "id long, found binary, n long")


def _send_contexts(hash_tasks: int, tasks: int, length: int, k: int = GRAM):
    """(task, body): anchors whose hash came back, with the bytes of their windows."""
    before = length - k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text", SLICE_BYTES):
            data, bounds = t.flat(part.column("text"))
            place, h, first, last = anchors(data, bounds, length)
            row = np.searchsorted(bounds, place, side="right") - 1
            home, code = _codes(h, hash_tasks)
            wanted = part.column("found").to_pylist()
            back = np.concatenate([_from_five(x) for x in wanted]) if wanted else np.zeros(0, np.uint64)
            owner = np.repeat(np.arange(part.num_rows), [len(x) // 5 for x in wanted]).astype(np.uint64)
            keep = np.isin(t.mix(row.astype(np.uint64) + t.mix(code)), t.mix(owner + t.mix(back)))
            place, h, first, last, row = place[keep], h[keep], first[keep], last[keep], row[keep]
            if not len(place):
                continue
            id = part.column("id").to_numpy(zero_copy_only=False)[row]
            body = data.tobytes()
            mark = np.array([text_mark(body[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], np.uint64)[row]
            task = (t.mix(h ^ _SPREAD[0]) % np.uint64(tasks)).astype(np.int64)
            padded = np.concatenate([np.zeros(before, np.uint8), data, np.zeros(length, np.uint8)])
            around = np.lib.stride_tricks.sliding_window_view(padded, before + length)
            order = np.argsort(task, kind="stable")
            for a, b in _cuts(task[order]):
                o = order[a:b]
                body = b"".join(
                    [
                        h[o].tobytes(),
                        id[o].astype(np.int64).tobytes(),
                        (place[o] - bounds[row[o]]).astype(np.int64).tobytes(),
                        mark[o].tobytes(),
                        (place[o] - last[o]).astype(np.uint8).tobytes(),
                        (place[o] - first[o]).astype(np.uint8).tobytes(),
                        around[place[o]].tobytes(),
                    ]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(task[o[0]])], pa.int32()),
                        pa.array([b - a], pa.int64()),
                        pa.array([pa.compress(body, "zstd").to_pybytes()], pa.binary()),
                    ],
                    ["task", "n", "body"],
                )

    return run


def _tries(strings: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The leaf of each string in the blind trie of its group (rows sorted by group)."""
    leaf = np.zeros(len(strings), np.int64)
    next_leaf = 0
    index = np.arange(len(strings))
    while len(index):
        at = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.concatenate([at, [len(index)]]))
        head = np.repeat(at, size)
        body = strings[index]
        differs = body != body[head]
        place = np.where(differs.any(axis=1), differs.argmax(axis=1), strings.shape[1])
        branch = np.minimum.reduceat(place, at)
        done = branch == strings.shape[1]
        ended = np.repeat(done, size)
        leaf[index[ended]] = next_leaf + np.repeat(np.arange(len(at)), size)[ended]
        next_leaf += len(at)
        branch = np.repeat(branch, size)
        index, group, branch, body = index[~ended], np.repeat(np.arange(len(at)), size)[~ended], branch[~ended], body[~ended]
        group = group * 256 + body[np.arange(len(index)), branch]
        order = np.argsort(group, kind="stable")
        index, group = index[order], group[order]
    return leaf


def equal_strings(strings: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A number for each row, equal for rows of equal key and string; -1 for rows without an equal.

    Deep-shallow: rows are sorted by key and the first ``SHALLOW`` bytes, eight at a time; groups
    that still have several rows are told apart by blind tries.
    """
    words = np.ascontiguousarray(strings[:, :SHALLOW]).view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], key))
    same = np.ones(max(len(order) - 1, 0), bool)
    for column in (key, *words.T):
        same &= column[order[1:]] == column[order[:-1]]
    group = np.concatenate([[0], np.cumsum(~same)]) if len(order) else order
    several = np.bincount(group)[group] > 1 if len(order) else order
    out = np.full(len(order), -1)
    deep = order[several]
    out[deep] = _tries(strings[deep], group[several])
    return out


def _spans(buckets: int, length: int, k: int = GRAM):
    """Parts of documents covered by windows of an earlier document, packed for their documents."""
    before = length - k
    wide = before + length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_task(batches):
            parts: list[list[np.ndarray]] = [[] for _ in range(7)]
            for n, packed in rows:
                body = pa.decompress(packed, n * (34 + wide), "zstd")
                at = 0
                for i, (kind, size) in enumerate((("<u8", 8), ("<i8", 8), ("<i8", 8), ("<u8", 8), ("u1", 1), ("u1", 1), ("u1", wide))):
                    parts[i].append(np.frombuffer(body, kind, n * size // np.dtype(kind).itemsize, at))
                    at += n * size
            rows.clear()
            h, id, place, mark, low, high, around = (np.concatenate(p) for p in parts)
            around = around.reshape(-1, wide)
            begin, end = np.full(len(h), -1), np.full(len(h), -1)
            for back in range(before, -1, -1):
                at = np.flatnonzero((low <= back) & (back <= high))
                if not len(at):
                    continue
                leaf = equal_strings(around[at, before - back : before - back + length], h[at])
                at, leaf = at[leaf >= 0], leaf[leaf >= 0]
                if not len(at):
                    continue
                first = np.full(leaf.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(first, leaf, id[at])
                late = at[first[leaf] < id[at]]
                fresh = late[begin[late] < 0]
                begin[fresh] = place[fresh] - back
                end[late] = place[late] - back + length
            found = np.flatnonzero(begin >= 0)
            pairs = np.stack([begin[found], end[found], mark[found].view(np.int64)], axis=1).astype("<i8")
            yield from _packed(id[found], pairs.view(np.uint8).reshape(-1, SPAN_BYTES), buckets)

    return run


def text_mark(body: bytes) -> int:
    """Tells the texts of one id apart."""
    return xxhash.xxh3_64_intdigest(body)


def cut(body: bytes, spans: bytes | None, copies: list[str] | None, length: int) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, number of runs removed); ``copies`` are the digests of the texts
    of this id that an earlier document has whole, ``spans`` are of all texts of the id."""
    if copies and hashlib.sha256(body).hexdigest() in copies:
        return (b"", len(body), 1) if len(body) >= length else (body, 0, 0)
    if not spans:
        return body, 0, 0
    pairs = np.frombuffer(spans, "<i8").reshape(-1, 3)
    pairs = pairs[pairs[:, 2].view(np.uint64) == np.uint64(text_mark(body))]
    if not len(pairs):
        return body, 0, 0
    mark = np.zeros(len(body) + 1, np.int64)
    np.add.at(mark, pairs[:, 0], 1)
    np.add.at(mark, pairs[:, 1], -1)
    gone = np.cumsum(mark[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(body, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def dedup_passages(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary, kept_sha256); ids are whole numbers."""
    if length < GRAM + 8:
        raise ValueError(f"strings of less than {GRAM + 8} bytes are not supported")
    source = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    named, nameless = source.where("id is not null"), source.where("id is null")
    # Documents equal to an earlier one: only their ids and digests are shuffled.
    digests = stage(named.select("id", F.sha2("text", 256).alias("digest"), F.octet_length("text").alias("n")), "passage-digests")
    firsts = digests.groupBy("digest").agg(F.min("id").alias("first"))
    texts = digests.join(firsts, "digest").select("id", "digest", (F.col("id") > F.col("first")).alias("copy")).distinct()
    # An id may have several texts: those that are copies go whole, the others are looked through.
    of_ids = texts.groupBy("id").agg(F.collect_list(F.when(F.col("copy"), F.col("digest"))).alias("copies"), F.min("copy").alias("all"))
    copies = stage(of_ids.where(F.size("copies") > 0), "passage-copies")
    total = digests.agg(F.sum("n")).first()[0] or 0
    anchors_expected = 2 * total // (length - GRAM + 2) + 1
    hash_tasks = int(anchors_expected // HASHES_PER_TASK) + 1
    hashes = named.mapInArrow(_send_hashes(hash_tasks, length), "task int, codes binary, ids binary")
    back = hashes.repartition(hash_tasks, "task").sortWithinPartitions("task").mapInArrow(_repeated_hashes(hash_tasks), PACKED)
    wanted = stage(_by_document(back, hash_tasks, 5), "passage-hashes").join(copies.where("all"), "id", "left_anti")
    repeated = wanted.agg(F.sum("n")).first()[0] or 0
    tasks = int(repeated // CONTEXTS_PER_TASK) + 1
    contexts = named.join(wanted.select("id", "found").hint("shuffle_hash"), "id").mapInArrow(
        _send_contexts(hash_tasks, tasks, length), "task int, n long, body binary"
    )
    spans = contexts.repartition(tasks, "task").sortWithinPartitions("task").mapInArrow(_spans(hash_tasks, length), PACKED)
    gone = _by_document(spans, hash_tasks, SPAN_BYTES).select("id", F.col("found").alias("spans"))
    gone = gone.join(copies.select("id", "copies"), "id", "full")
    cuts = named.join(gone.hint("shuffle_hash"), "id", "left")
    cuts = cuts.unionByName(nameless, allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in t.slices(batches, "text", SLICE_BYTES):
            left = []
            for body, spans, whole in zip(*(part.column(c).to_pylist() for c in ("text", "spans", "copies"))):
                body = body.encode()
                kept, removed, runs = cut(body, spans, whole, length)
                left.append((len(body), removed, runs, kept, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*left))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
    return cuts.select("id", "text", "spans", "copies").mapInArrow(run, schema).withColumnRenamed("id", id)
