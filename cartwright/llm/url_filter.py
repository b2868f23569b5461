"""Block and allow rules for URLs, looked up in a cascade of Bloom filters.

The keys of a URL are the pairs of a host it belongs to (its own and every parent) and a prefix of
its path with the length of some rule's path, and the words of its host and path. A cascade holds
which keys are listed: the first filter encodes the listed keys, the second the keys of the whole
table that pass the first without being listed, the third the listed keys that pass the second,
and so on until nothing passes wrongly. A key of the table is listed if the first level that it
does not pass is an even one (counted from 1). The answer is exact for every key the cascade was
built over, and it needs the filters only: no join with the list.

The longest rule wins, of rules of one length the one with the longer host. Without a rule, a
listed word in host or path blocks, and all else is allowed.

Defined cases: a null URL, or one without ``://``, has an empty host and path, meets no rule and
is allowed. Repeated rows get equal results. Columns of the input with the names of the results
are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.lineage import stage
from cartwright.llm import bloom
from cartwright.llm import text as t

# The rules (host/path) of the contract.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

# Words that block a URL which no rule covers.
WORDS = ("adult", "casino", "escort", "gambling", "pills", "poker", "porn", "sex", "viagra", "xxx")

BITS_PER_KEY = 16
PROBES = 4
LEVELS = 40

_WORD = re.compile(r"[^a-z0-9\u0080-\U0010ffff]+")
_LOWER = str.maketrans(t.UPPER_LETTERS, t.LOWER_LETTERS)


def split_url(url: str | None) -> tuple[str, str]:
    """(host in lower case, path)"""
    if url is None:
        return "", ""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:end], rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return host.translate(_LOWER), path[:stop]


def keys_of(host: str, path: str, lengths: tuple[int, ...]) -> tuple[list[str], list[str]]:
    """(rule keys, word keys). A rule key reads like the rule: host, then the path's prefix."""
    labels = host.split(".") if host else []
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    prefixes = [path[:n] for n in lengths if n <= len(path)]
    words = sorted({w for w in _WORD.split(f"{host}{path}".translate(_LOWER)) if w})
    return [h + p for h in hosts for p in prefixes], ["word:" + w for w in words]


def rule_lengths(rules: dict[str, str]) -> tuple[int, ...]:
    """The lengths of the rules' paths, the slash included."""
    return tuple(sorted({len(rule) - rule.index("/") for rule in rules}))


def key_hashes(keys: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(k.encode(), 0) for k in keys], np.uint64)


class Cascade:
    """The filters, first to last, and their numbers of bits."""

    def __init__(self, levels: list[tuple[np.ndarray, int]]):
        self.levels = levels

    def lists(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), bool)
        alive = np.arange(len(hashes))
        for depth, (marks, bits) in enumerate(self.levels):
            passed = bloom.holds(marks, hashes[alive] ^ np.uint64(depth), bits, PROBES)
            # Stopped at an odd level of the count from 1: not listed; at an even one: listed.
            found[alive[~passed]] = depth % 2 == 1
            alive = alive[passed]
        # What passes all: as the last filter says.
        found[alive] = len(self.levels) % 2 == 1
        return found


def _bits(keys: int) -> int:
    return max(1 << 16, 1 << int(np.ceil(np.log2(max(keys, 1) * BITS_PER_KEY))))


def build(universe: DataFrame, listed: DataFrame) -> Cascade:
    """The cascade of the ``listed`` hashes over the hashes of ``universe`` (one long column h each).

    The second level holds the few keys of the table that pass the first by chance, so it has
    about a thousandth of the table's distinct keys, and every later level is smaller again.
    """
    inside = stage(listed.distinct(), "cascade-listed")
    outside = universe.join(inside, "h", "left_anti")
    levels: list[tuple[np.ndarray, int]] = []
    mine, other = inside, outside
    for depth in range(LEVELS):
        count = mine.count()
        if not count:
            break
        bits = _bits(count)
        shifted = mine.select(F.col("h").bitwiseXOR(F.lit(depth).cast("long")).alias("h"))
        marks = bloom.build(shifted, bits, PROBES)
        levels.append((marks, bits))
        passed = stage(other.mapInArrow(_passing(marks, bits, depth), "h long").distinct(), "cascade-passed")
        mine, other = passed, mine
    else:
        raise RuntimeError(f"the cascade did not end in {LEVELS} levels")
    return Cascade(levels)


def _passing(marks: np.ndarray, bits: int, depth: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(h[bloom.holds(marks, h ^ np.uint64(depth), bits, PROBES)].view(np.int64))], ["h"])

    return run


def _universe(lengths: tuple[int, ...]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: set[str] = set()
            for url in batch.column(0).to_pylist():
                for part in keys_of(*split_url(url), lengths):
                    keys.update(part)
            yield pa.RecordBatch.from_arrays([pa.array(np.sort(key_hashes(list(keys))).view(np.int64))], ["h"])

    return run


def judge(pages: DataFrame, url: str = "url", rules: dict[str, str] = RULES, words: tuple[str, ...] = WORDS) -> DataFrame:
    """``pages`` with host, path, rule, verdict and, where a word decided, ``word``.

    The rules and words are written by hand and small; what grows with the pages stays in Spark.
    """
    spark = pages.sparkSession
    lengths = rule_lengths(rules)
    universe = pages.select(F.col(url).alias("url")).mapInArrow(_universe(lengths), "h long").distinct()
    listed = key_hashes([*rules, *["word:" + w for w in words]])
    cascade = build(stage(universe, "cascade-keys"), spark.createDataFrame([(int(h),) for h in listed.view(np.int64)], "h long"))
    names = dict.fromkeys(("host", "path", "rule", "verdict", "word"), "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split_url(u) for u in batch.column("text").to_pylist()]
            keys = [keys_of(h, p, lengths) for h, p in parts]
            flat = [k for rule_keys, word_keys in keys for k in (*rule_keys, *word_keys)]
            hit = iter(cascade.lists(key_hashes(flat)).tolist())
            out: list[tuple] = []
            for (host, path), (rule_keys, word_keys) in zip(parts, keys):
                fits = [k for k in rule_keys if next(hit)]
                bad = [k[5:] for k in word_keys if next(hit)]
                rule = max(fits, key=lambda k: (len(k), k.index("/")), default=None)
                verdict = rules[rule] if rule else "block" if bad else "allow"
                out.append((host, path, rule, verdict, bad[0] if bad and not rule else None))
            columns = list(zip(*out)) or [()] * len(names)
            yield t.added(batch.column("rest"), *[pa.array(c, pa.string()) for c in columns])

    return t.Carried(pages, url, (*names, url)).run(run, names)
