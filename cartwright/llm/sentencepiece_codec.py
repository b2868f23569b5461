"""SentencePiece ids of texts by matching a whole batch against its own suffix array.

The chunks of a batch (a run of blanks and the characters up to the next blank; no piece reaches
over the start of a chunk) are laid end to end, each distinct chunk once, and their suffixes are
sorted as deep as the longest piece. Two binary searches per piece find all places where it occurs.
Every place is an edge from the piece's first byte to its end. The edges, sorted by position, are
relaxed: a position knows the last piece of the encoding of the text up to it, and an edge extends
the encoding that ends at its start if the two pieces may stand side by side.

Merging by rank has this property: pieces form the encoding of a text exactly if every two
neighbours do for their own text. So an edge is taken if the two pieces, encoded together, stay as
they are; that is found out once per pair by undoing their merges. At each position one edge at
most holds, which makes the relaxed path the encoding itself, not an approximation of it.

A character without a piece is an edge of its own and comes out as its bytes. The result equals the
library's for models of this kind: merges by rank, byte fallback, no normalisation, and a blank put
in front. Models of another kind are refused.

Defined cases: a null text has no ids (null), an empty one an empty list. White space other than
blanks, characters outside the vocabulary and very long words are kept; decoding gives the text
back byte for byte, but that the mark itself reads as a blank. A null among ids reads as the
unknown piece. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cartwright.llm import text as t

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# The mark that stands for a blank, and the kinds of pieces in a model.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

CHUNK = re.compile(f"{MARK}+[^{MARK}]*")

SLICE_BYTES = 1 << 22
BLOCK_BYTES = 1 << 17
KNOWN_CHUNKS = 1 << 18
PAIR_SLOTS = 1 << 20
NONE, BEGIN = -2, -3


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[bytes]
    kinds: list[int]
    ranks: list[int]  # when a piece is merged; -1: a character, there from the start
    parts: list[tuple[int, int]]  # the two pieces of its last merge


def load(path: str = MODEL) -> Vocabulary:
    """Read the model on the driver; tasks get the vocabulary with the job."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = [p.type for p in model.pieces]
    pieces = [p.piece for p in model.pieces]
    shape = model.trainer_spec.model_type == 2 and model.trainer_spec.byte_fallback
    plain = model.normalizer_spec.add_dummy_prefix and not model.normalizer_spec.remove_extra_whitespaces
    plain = plain and not model.normalizer_spec.precompiled_charsmap
    inner = any(MARK in p.lstrip(MARK) for p, kind in zip(pieces, kinds) if kind == NORMAL)
    if not shape or not plain or inner or USER in kinds or UNUSED in kinds:
        raise ValueError("only models with merges by rank, byte fallback and no normalisation are supported")
    encoded = [p.encode() for p in pieces]
    ids = {p: i for i, (p, kind) in enumerate(zip(encoded, kinds)) if kind == NORMAL}
    order = {i: rank for rank, i in enumerate(sorted(ids.values(), key=lambda i: (-model.pieces[i].score, i)))}
    ranks, parts = [-1] * len(pieces), [(-1, -1)] * len(pieces)
    for i in ids.values():
        if len(pieces[i]) > 1:
            ranks[i], parts[i] = order[i], _last_merge(pieces[i], ids, order)
    return Vocabulary(encoded, kinds, ranks, parts)


def _last_merge(piece: str, ids: dict[bytes, int], order: dict[int, int]) -> tuple[int, int]:
    """The two pieces left when the characters of a piece are merged by rank, leftmost first."""
    parts = [c.encode() for c in piece]
    while len(parts) > 2:
        found = [(order[ids[a + b]], at) for at, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ids]
        if not found:
            raise ValueError(f"the piece {piece!r} can't be reached by merges")
        _, at = min(found)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return tuple(ids.get(p, -1) for p in parts)


class Encoder:
    """The vocabulary of one task, and what it has learned about pairs of pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.pieces = vocabulary.pieces
        self.ranks, self.parts = vocabulary.ranks, vocabulary.parts
        self.ids = {p: i for i, (p, kind) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if kind == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, (p, kind) in enumerate(zip(vocabulary.pieces, vocabulary.kinds)) if kind == BYTE}
        self.surface = list(self.pieces)
        for byte, i in self.bytes.items():
            self.surface[i] = bytes([byte])
        self.longest = max(map(len, self.ids))
        self.byte_ids = np.array([self.bytes.get(b, -1) for b in range(256)])
        self.pairs: dict[int, bool] = {}
        self.met, self.met_ok = np.full(PAIR_SLOTS, -1), np.zeros(PAIR_SLOTS, bool)
        self.forget()
        names = sorted(self.ids)
        self.sorted_ids = np.array([self.ids[n] for n in names], np.int64)
        self.lengths = np.array([len(n) for n in names], np.int64)
        self.sought = np.array([_raised(n) for n in names], f"S{self.longest}")
        self.after = np.array([_next(_raised(n)) for n in names], f"S{self.longest}")

    def forget(self) -> None:
        """Start without known chunks."""
        self.numbers: dict[str, int] = {}
        self.flat, self.width = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def learn(self, chunks: list[str]) -> None:
        """Encode the chunks and keep their ids, in blocks of bounded size."""
        block: list[bytes] = []
        size, found = 0, []
        for chunk in map(str.encode, chunks):
            if block and size + len(chunk) > BLOCK_BYTES:
                found.append(self.encode_chunks(block))
                block, size = [], 0
            block.append(chunk)
            size += len(chunk) + 1
        if block:
            found.append(self.encode_chunks(block))
        self.flat = np.concatenate([self.flat, *[f for f, _ in found]])
        self.width = np.concatenate([self.width, *[w for _, w in found]])

    def stands(self, left: int, right: int) -> bool:
        """Do the two pieces stay as they are when their text is encoded as one?

        Their merges are undone from the latest to the first. At each time the pieces at the
        border must not merge with each other before the merge that was undone last.
        """
        key, limit = left << 32 | right, 1 << 40
        known = self.pairs.get(key)
        while known is None:
            across = self.ids.get(self.pieces[left] + self.pieces[right])
            a, b = self.ranks[left], self.ranks[right]
            if across is not None and self.ranks[across] < limit:
                known = False
            elif a < 0 and b < 0:
                known = True
            elif a > b:
                limit, left = a, self.parts[left][1]
            else:
                limit, right = b + 1, self.parts[right][0]
            if left < 0 or right < 0:
                known = True
        self.pairs[key] = known
        return known

    def edges(self, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every occurrence of a piece, by start; body has zeros between chunks."""
        # The suffix array: places in the order of the bytes that follow, as deep as a piece is long.
        padded = np.concatenate([body, np.zeros(self.longest, np.uint8)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[: len(body)]
        suffixes = np.ascontiguousarray(windows).view(f"S{self.longest}").ravel()
        order = np.argsort(suffixes, kind="stable")
        ranked = suffixes[order]
        low, high = np.searchsorted(ranked, self.sought), np.searchsorted(ranked, self.after)
        n = high - low
        which = np.repeat(np.arange(len(n)), n)
        start = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]]
        by = np.argsort(start, kind="stable")
        start, which = start[by], which[by]
        return start, start + self.lengths[which], self.sorted_ids[which]

    def encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the chunks end to end, number of ids of each); chunks have marks for blanks."""
        body = np.frombuffer(b"\x00".join(chunks) + b"\x00", np.uint8)
        raised = np.where(body == 0, 0, body + 1).astype(np.uint8)
        zero = np.flatnonzero(body == 0)
        # A chunk may hold zero bytes of its own; they are one-byte characters without a piece.
        size = np.array([len(c) for c in chunks])
        stop = np.cumsum(size + 1) - 1
        begin = stop - size
        inner = np.setdiff1d(zero, stop)
        raised[inner] = 1
        start, end, piece = self.edges(raised)
        # Every character is an edge too, if it is no piece; its id is -1.
        heads = np.flatnonzero(((body & 0xC0) != 0x80) & (raised != 0))
        lead = body[heads]
        width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        single = np.zeros(len(body), bool)
        reach = np.zeros(len(body), np.int64)
        reach[heads] = width
        single[start[end - start == reach[start]]] = True
        lone = heads[~single[heads]]
        start = np.concatenate([start, lone])
        end = np.concatenate([end, lone + width[~single[heads]]])
        piece = np.concatenate([piece, np.full(len(lone), -1)])
        # Relax by position within the chunk, all chunks of the block together.
        last = np.full(len(body) + 1, NONE)
        came = np.zeros(len(body) + 1, np.int64)
        last[begin] = BEGIN
        depth = start - np.repeat(begin, size + 1)[start]
        by = np.argsort(depth, kind="stable")
        steps = np.searchsorted(depth[by], np.arange(int(depth.max(initial=-1)) + 2))
        for low, high in zip(steps[:-1].tolist(), steps[1:].tolist()):
            e = by[low:high]
            e = e[last[start[e]] != NONE]
            e = e[self.side_by_side(last[start[e]], piece[e])]
            last[end[e]], came[end[e]] = piece[e], start[e]
        return self.paths(body, begin, stop, last, came)

    def side_by_side(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``stands`` for many pairs, through a table of the pairs met so far."""
        ok = np.ones(len(left), bool)
        both = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[both] << 32 | right[both]
        slot = (t.mix(key.astype(np.uint64)) & np.uint64(len(self.met) - 1)).astype(np.int64)
        new = np.flatnonzero(self.met[slot] != key)
        if len(new):
            fresh, back = np.unique(key[new], return_inverse=True)
            answer = np.array([self.stands(k >> 32, k & 0xFFFFFFFF) for k in fresh.tolist()], bool)[back]
            self.met[slot[new]] = -1
            ok[both] = self.met_ok[slot]
            ok[both[new]] = answer
            self.met[slot[new]], self.met_ok[slot[new]] = key[new], answer
        else:
            ok[both] = self.met_ok[slot]
        return ok

    def paths(self, body, begin, stop, last, came) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks end to end, number of ids of each chunk), read from the ends back."""
        chunk, at = np.arange(len(begin)), stop
        seen = []
        while len(chunk):
            if (last[at] == NONE).any():
                raise AssertionError("a position without an encoding")
            seen.append((chunk, last[at], came[at], at))
            at = came[at]
            more = at > begin[chunk]
            chunk, at = chunk[more], at[more]
        chunk, piece, start, end = (np.concatenate(x) for x in zip(*seen))
        by = np.lexsort((start, chunk))
        chunk, piece, start, end = chunk[by], piece[by], start[by], end[by]
        n = np.where(piece >= 0, 1, end - start)
        place = np.repeat(np.arange(len(n)), n)
        ids, within = piece[place], np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        lone = ids < 0
        ids[lone] = self.byte_ids[body[start[place[lone]] + within[lone]]]
        return ids.astype(np.int32), np.bincount(chunk, n, len(begin)).astype(np.int64)

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def _raised(piece: bytes) -> bytes:
    """Bytes moved up by one, so that zero is free to end a chunk."""
    return bytes(b + 1 for b in piece)


def _next(raised: bytes) -> bytes:
    """The least string after all strings that begin with this one (no byte is 255)."""
    return raised[:-1] + bytes([raised[-1] + 1])


def chunks_of(text: str) -> list[str]:
    """Blanks and the characters up to the next blank, with marks for blanks and one in front.

    The mark itself, where a text has it, reads as a blank, as it does in the library.
    """
    return CHUNK.findall(MARK + text.replace(" ", MARK))


def encode_texts(encoder: Encoder, texts: list[str | None]) -> pa.ListArray:
    """Ids of the texts; chunks that this task has met before are not encoded again."""
    if len(encoder.numbers) > KNOWN_CHUNKS:
        encoder.forget()
    numbers, before = encoder.numbers, len(encoder.numbers)
    places, counts = [], []
    for text in texts:
        found = chunks_of(text) if text else []
        places += [numbers.setdefault(c, len(numbers)) for c in found]
        counts.append(len(found))
    encoder.learn(list(islice(numbers, before, None)))
    width, flat = encoder.width, encoder.flat
    place = np.array(places, np.int64)
    n = width[place]
    at = np.cumsum(n) - n
    values = flat[np.repeat((np.cumsum(width) - width)[place] - at, n) + np.arange(n.sum())]
    total = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
    nulls = np.array([x is None for x in texts] + [False])
    return pa.ListArray.from_arrays(pa.array(total.astype(np.int32), mask=nulls), pa.array(values, pa.int32()))


def _shared(spark, path: str):
    return spark.sparkContext.broadcast(load(path))


def encode(
    docs: DataFrame, text: str = "text", out: str = "ids", path: str = MODEL, keep_text: bool = True, check: str | None = None
) -> DataFrame:
    """``docs`` with the ids of the text (array of int); without the text if it is not kept.

    ``check`` names a boolean column: do the ids decode to the text? The task that has made them
    decodes them, so neither is sent twice.
    """
    shared = _shared(docs.sparkSession, path)
    names = {out: "array<int>", **({check: "boolean"} if check else {})}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for part in t.slices(batches, "text", SLICE_BYTES):
            texts = part.column("text").to_pylist()
            ids = encode_texts(encoder, texts)
            columns = [ids]
            if check:
                columns.append(pa.array([a == b for a, b in zip(texts, decode_lists(encoder, ids))], pa.bool_()))
            yield t.added(part.column("rest"), *columns)

    return t.Carried(docs, text, tuple(names), keep_text).run(run, names)


def decode_lists(encoder: Encoder, lists: pa.ListArray) -> Iterator[str | None]:
    """The text of each list of ids, one list at a time."""
    values, offsets = pc.fill_null(lists.values, 0).to_numpy(), lists.offsets.to_pylist()
    for a, b, known in zip(offsets[:-1], offsets[1:], lists.is_valid().to_pylist()):
        yield encoder.decode(values[a:b].tolist()) if known else None


def decode(rows: DataFrame, ids: str = "ids", out: str = "text", path: str = MODEL) -> DataFrame:
    """``rows`` with the text of the ids."""
    shared = _shared(rows.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            texts = list(decode_lists(encoder, batch.column("text")))
            yield t.added(batch.column("rest"), pa.array(texts, pa.string()))

    return t.Carried(rows, ids, (out,), True).run(run, {out: "string"})
