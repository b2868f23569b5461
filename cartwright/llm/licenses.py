"""Licence notices and identifier tags in texts.

One Aho-Corasick automaton over the words of a text finds the notice phrases and the tag that
announces a licence expression. The expression after a tag is read up to the end of its line and
evaluated by a shunting-yard parser: ``a OR b`` is as free as the freer one, ``a AND b`` as the
stricter one, ``a WITH e`` frees a copyleft licence by one exception.

Defined cases: null and empty texts have no words, no labels and score 0. A tag without a
readable expression adds the label ``unreadable`` and the score of an unknown licence. Repeated
rows get equal results. Columns of the input with the names of the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwright.llm import text as t

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# More notices, and how free the text under each label is (1: no condition, 0: no permission).
NOTICES = {
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc",
    "cc by nc nd": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc0": "cc0",
    "public domain": "public-domain",
    "the unlicense": "unlicense",
    "all rights reserved": "reserved",
}
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0, "0bsd": 1.0,
    "mit": 0.9, "bsd": 0.9, "isc": 0.9, "bsl": 0.9, "apache": 0.9, "zlib": 0.9, "cc-by": 0.8,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nd": 0.2, "cc-by-nc": 0.2, "reserved": 0.0,
}
UNKNOWN = 0.25
WITH_EXCEPTION = 0.2

TAG = ("spdx", "license", "identifier")
TOKEN = re.compile(rb"[()]|[A-Za-z0-9.+-]+")
RANK = {"or": 1, "and": 2, "with": 3}


def freedom(name: str) -> float:
    """The value of an identifier: that of the longest label it begins with."""
    fits = [label for label in FREEDOM if name == label or name.startswith(label + "-")]
    return FREEDOM[max(fits, key=len)] if fits else UNKNOWN


def evaluate(expression: bytes) -> tuple[float, list[str]] | None:
    """(value, identifiers) of a licence expression; None if it can't be read.

    Shunting-yard: operands go to one stack, operators wait on another until one that binds no
    tighter, or a closing bracket, comes. Text after a complete expression is left alone.
    """
    values: list[float] = []
    waiting: list[str] = []
    names: list[str] = []
    expects_name, exception = True, False

    def apply() -> None:
        b, a, op = values.pop(), values.pop(), waiting.pop()
        values.append(max(a, b) if op == "or" else min(a, b) if op == "and" else min(a + b, 1.0))

    for token in TOKEN.findall(expression):
        word = token.decode("ascii").lower()
        if expects_name:
            if word == "(" and not exception:
                waiting.append(word)
            elif word in RANK or word in "()":
                return None
            else:
                values.append(WITH_EXCEPTION if exception else freedom(word.rstrip("+")))
                if not exception:
                    names.append(word)
                expects_name, exception = False, False
        elif word == ")":
            while waiting and waiting[-1] != "(":
                apply()
            if not waiting:
                break
            waiting.pop()
        elif word in RANK:
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[word]:
                apply()
            waiting.append(word)
            expects_name, exception = True, word == "with"
        else:
            break
    if expects_name:
        return None
    while waiting:
        if waiting[-1] == "(":
            return None
        apply()
    return values[0], names


def automaton(notices: dict[str, str]):
    """Phrases between blanks; the value is (label or None for the tag, words, base or not)."""
    found = ahocorasick.Automaton()
    for phrase, label in {**notices, **BASE}.items():
        found.add_word(f" {phrase} ", (label, len(phrase.split()), phrase in BASE))
    found.add_word(f" {' '.join(TAG)} ", (None, len(TAG), False))
    found.make_automaton()
    return found


def scan(docs: DataFrame, text: str = "text", notices: dict[str, str] = NOTICES) -> DataFrame:
    """``docs`` without the text, with the counts, places, labels and the score of each row.

    ``score``: how free the text is under all that it carries, the least value of its notices and
    expressions; 0 without any.
    """
    names = {
        "n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long",
        "base_labels": "string", "labels": "string", "score": "double",
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(notices)
        for part in t.slices(batches, "text"):
            raw, bounds = t.flat(part.column("text"))
            data = t.LOWER[raw]
            starts, ends, first = t.words(data, bounds, t.ALNUM)
            # Every word after a blank; a row ends with a blank and a byte that is in no phrase.
            extra = np.zeros(len(starts), np.int64)
            at_row = first[1:][np.diff(first) > 0] - 1
            extra[at_row] = 2
            size = ends - starts + 1
            place = np.concatenate([[0], np.cumsum(size + extra)])
            body = np.full(place[-1], 0x20, np.uint8)
            body[place[1:][at_row] - 1] = 0x0A
            inside = t.ALNUM[data]
            body[np.repeat(place[:-1] + 1 - starts, ends - starts) + np.flatnonzero(inside)] = data[inside]
            n = part.num_rows
            base = [[] for _ in range(n)]
            values = [[] for _ in range(n)]
            base_labels, labels = [set() for _ in range(n)], [set() for _ in range(n)]
            # A match ends at the blank after its last word; of the matches from one word, the longest
            # names the licence, and base phrases count always.
            matches = [(int(np.searchsorted(place, end)), *found) for end, found in machine.iter(body.tobytes().decode("latin-1"))]
            longest: dict[int, int] = {}
            for after, _, count, _ in matches:
                longest[after - count] = max(count, longest.get(after - count, 0))
            for after, label, count, is_base in matches:
                word = after - count
                if not is_base and longest[word] > count:
                    continue
                row = int(np.searchsorted(first, word, side="right")) - 1
                if label is None:
                    begin = int(ends[after - 1])
                    line = raw[begin : bounds[row + 1]].tobytes().split(b"\n", 1)[0]
                    read = evaluate(line)
                    labels[row] |= {"unreadable"} if read is None else set(read[1])
                    values[row].append(UNKNOWN if read is None else read[0])
                    continue
                labels[row].add(label)
                values[row].append(freedom(label))
                if is_base:
                    base[row].append(word - int(first[row]))
                    base_labels[row].add(label)
            columns = [pa.array(np.diff(first), pa.int64()), pa.array([len(b) for b in base], pa.int64())]
            columns += [pa.array([f(b) if b else None for b in base], pa.int64()) for f in (min, max)]
            columns += [pa.array([",".join(sorted(x)) for x in found], pa.string()) for found in (base_labels, labels)]
            yield t.added(part.column("rest"), *columns, pa.array([min(v) if v else 0.0 for v in values], pa.float64()))

    return t.Carried(docs, text, tuple(names)).run(run, names)
