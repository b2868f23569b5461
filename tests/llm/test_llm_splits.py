"""Paths that only large groups take: cut cells, several tasks, full filters, deep sorting."""

import random

import brute
import numpy as np
import pytest

from cartwright.llm import bloom, line_dedup, simhash, suffix_dedup
from cartwright.llm import text as t


def near_fingerprints(n, seed=5):
    """A dense group of distinct fingerprints a few bits apart, and random ones."""
    rng = random.Random(seed)
    base = rng.getrandbits(64)
    dense = {base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 5))) for _ in range(n)}
    return sorted(x & (2**64 - 1) for x in dense | {rng.getrandbits(64) for _ in range(n)})


@pytest.mark.parametrize("cell_rows", [4, 20_000])
def test_links_of_dense_groups(spark, cell_rows):
    fps = near_fingerprints(60)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), cell_rows=cell_rows).collect()
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 4]
    plain = lambda x: x & (2**64 - 1)
    assert all((plain(a) ^ plain(b)).bit_count() <= 64 for a, b in links)
    assert brute.components([(plain(a), plain(b)) for a, b in links]) == brute.components(pairs)
    # A forest per cell, not all pairs.
    assert len(links) <= 35 * len(fps)


@pytest.mark.parametrize("distance,groups,segment_bits", [(2, 5, 4), (4, 6, 2), (0, 3, 8)])
def test_links_with_other_grids(spark, distance, groups, segment_bits):
    fps = near_fingerprints(40, 9)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), distance, segment_bits, groups).collect()
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= distance]
    plain = lambda x: x & (2**64 - 1)
    assert brute.components([(plain(a), plain(b)) for a, b in links]) == brute.components(pairs)


def test_counts_of_segments_bound_the_distance():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 2**63, 500, dtype=np.uint64) for _ in range(2))
    for bits in (1, 2, 4, 8):
        low = np.abs(simhash.embedding(a, bits) - simhash.embedding(b, bits)).sum(axis=1)
        assert (low <= np.bitwise_count(a ^ b)).all()


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 700)]
    pairs = chain + star + [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(150)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute.components([(a, b) for a, b in pairs if a != b])
    assert all(got.get(x, x) == root for x, root in want.items())


def repeating_texts():
    rng = random.Random(11)
    prose = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    passages = [prose(n) for n in (50, 51, 60, 75, 120, 400)]
    out = []
    for i in range(40):
        parts = [prose(rng.randrange(0, 90)) + rng.choice(passages + [""]) for _ in range(rng.randrange(0, 6))]
        out.append((i, "".join(parts)))
    out += [(50, "ab" * 100), (51, "ba" * 60), (52, "a" * 49), (53, "a" * 49), (54, "a" * 500), (55, "a" * 50), (56, passages[0][:49])]
    return out


def test_passages_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HASHES_PER_TASK", 40)
    monkeypatch.setattr(suffix_dedup, "CONTEXTS_PER_TASK", 30)
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 900)
    rows = repeating_texts()
    want = {i: (n, gone, spans, kept) for i, (n, gone, spans, kept) in brute.suffix_dedup(rows).items()}
    made = suffix_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in made.collect()}
    assert got == want


def test_deep_shallow_groups_are_the_equal_strings():
    rng = random.Random(6)
    head = bytes(rng.randrange(256) for _ in range(50))
    rows = [head[: rng.randrange(10, 50)].ljust(50, bytes([rng.randrange(3)])) for _ in range(400)]
    rows += [bytes(rng.randrange(2) for _ in range(50)) for _ in range(50)]
    key = [rng.randrange(3) for _ in rows]
    got = suffix_dedup.equal_strings(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 50), np.array(key, np.uint64))
    groups = {}
    for i, (k, row) in enumerate(zip(key, rows)):
        groups.setdefault((k, row), []).append(i)
    by_leaf = {}
    for i, leaf in enumerate(got.tolist()):
        by_leaf.setdefault(leaf if leaf >= 0 else ("alone", i), []).append(i)
    assert sorted(by_leaf.values()) == sorted(groups.values())


def test_equal_windows_have_equal_anchors():
    rng = random.Random(7)
    shared = bytes(rng.randrange(97, 103) for _ in range(50))
    for trial in range(30):
        texts = [bytes(rng.randrange(97, 103) for _ in range(rng.randrange(0, 60))) + shared + bytes(rng.randrange(97, 103) for _ in range(rng.randrange(0, 60))) for _ in range(2)]
        found = []
        for body in texts:
            at = body.index(shared)
            place, h, first, last = suffix_dedup.anchors(np.frombuffer(body, np.uint8), np.array([0, len(body)]))
            mine = np.flatnonzero((first <= at) & (at <= last))
            assert len(mine) == 1
            found.append((int(h[mine[0]]), int(place[mine[0]]) - at))
        assert found[0] == found[1]


def test_a_full_filter_changes_nothing(spark):
    rows = [(i, f"line number {i % 40} of many\nown line of document {i}\nshort") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, filter_bits=1 << 16).collect()}
    assert left == {i: kept for i, (_, _, kept) in brute.line_dedup(rows).items()}
    marks = np.full((1 << 16) // 8, 255, np.uint8)
    assert bloom.holds(marks, np.arange(100, dtype=np.uint64), 1 << 16, 2).all()


def test_runs_within_a_row():
    rng = random.Random(8)
    for _ in range(50):
        counts = [rng.randrange(0, 5) for _ in range(rng.randrange(1, 8))]
        first = np.concatenate([[0], np.cumsum(counts)])
        row = [r for r, c in enumerate(counts) for _ in range(c)]
        for n in (1, 2, 3, 6):
            assert t.same_row(first, n).tolist() == [row[i] == row[i + n - 1] for i in range(len(row) - n + 1)]
