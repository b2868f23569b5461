"""Plain Python versions of the contracts: one document, or all pairs, at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOWER))


def decontaminate(docs, items, length=10):
    """docs, items: lists of (id, text). {id: (n_words, n_hit, items)}"""
    windows = {}
    for item, text in items:
        w = words(text)
        if w:
            for i in range(max(len(w) - length, 0) + 1):
                windows.setdefault(tuple(w[i : i + length]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out[doc] = (len(w), len(hit), sorted(map(str, found)))
    return out


def quality(text):
    w = VISIBLE.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if VISIBLE.search(line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, inside = Counter(runs), set()
    for i, run in enumerate(runs):
        if count[run] > 1:
            inside.update((i, i + 1, i + 2))
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside), failed


def fingerprint(text):
    w = words(text, VISIBLE)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(len(w) - 3, 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(pairs):
    """{x: least of its component} from a list of links."""
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(root)}


def simhash(docs, distance=4):
    """{id: (fingerprint in hex, component)}"""
    fp = {doc: fingerprint(text) for doc, text in docs}
    ids = sorted(fp)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i:] if (fp[a] ^ fp[b]).bit_count() <= distance]
    root = components(pairs)
    return {doc: (f"{fp[doc]:016x}", root[doc]) for doc in ids}


def line_dedup(docs, least=10):
    """{id: (n_lines, n_dropped, kept text)}"""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(doc)
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or doc == min(holders[key(x)])]
        out[doc] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def licenses(text):
    """(n_words, n_base, first, last, base labels)"""
    w, places, labels = words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def url_rule(url):
    host, path = split_url(url)
    fits = []
    for rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append(rule)
    return max(fits, key=len, default=None)


def suffix_dedup(docs, n=50):
    """{id: (n_bytes, n_removed, n_spans, kept bytes)}"""
    first = {}
    for doc, text in docs:
        body = (text or "").encode()
        for i in range(len(body) - n + 1):
            s = body[i : i + n]
            first[s] = min(first.get(s, doc), doc)
    out = {}
    for doc, text in docs:
        body = (text or "").encode()
        gone, spans, until = bytearray(len(body)), 0, -1
        for i in range(len(body) - n + 1):
            if first[body[i : i + n]] < doc:
                spans += i > until
                gone[max(i, until) : i + n] = b"\x01" * (i + n - max(i, until))
                until = i + n
        out[doc] = (len(body), sum(gone), spans, bytes(b for b, g in zip(body, gone) if not g))
    return out


def crc(text):
    return zlib.crc32(text.encode())


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audit(docs, least=30, top=50):
    """docs: (lang, source, text). Rows (lang, source, part, item, value, rank)."""
    used, docs_with = {}, {}
    for lang, source, text in docs:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(LOWER))
        used.setdefault((lang, source), Counter()).update(terms)
        docs_with.setdefault(lang, Counter()).update(set(terms))
    out = []
    for lang, with_term in docs_with.items():
        kept = [x for x in with_term if with_term[x] >= least]

        def shares(counts, kept=kept):
            total = sum(counts[x] for x in kept)
            return {x: 1 + 1_000_000_000 * (counts[x] + 5) // (total + 5 * len(kept)) for x in kept}

        sources = [s for x, s in used if x == lang]
        p = {s: shares(used[lang, s]) for s in sources}
        q = shares(sum((used[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(abs(p[s][x] - p[o][x]) for x in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((q[x] - p[s][x], x.encode(), x) for x in kept if used[lang, s][x] and p[s][x] > q[x])
            for part, found in (("pair", pairs), ("term", terms[:top])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return out


def conversations(rows):
    """rows: (conv_id, turn, role, text). {id: (n_turns, digest, loss characters, their digest)}"""
    found = {}
    for c, turn, role, text in rows:
        found.setdefault(c, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    out = {}
    for c, said in found.items():
        said.sort()
        loss = b"".join(x for _, _, r, x in said if r == b"assistant")
        out[c] = len(said), sha(b"".join(r + b"\n" + x + b"\n" for _, _, r, x in said)), len(loss.decode()), sha(loss)
    return out


def vector_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (id, vector) of whole numbers, in the order of their ids. (codes, errors, books)"""
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in rows]
    books = [[cut[i][p] for i in range(min(entries, len(rows)))] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda x, book: min((far(x, e), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for v in cut:
                own.setdefault(best(v[p], books[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(own[i]) for c in zip(*own[i])] if i in own else e for i, e in enumerate(books[p])]
    found = [[best(v[p], books[p]) for p in range(parts)] for v in cut]
    return ["".join(f"{i:02x}" for _, i in f) for f in found], [sum(d for d, _ in f) for f in found], books
