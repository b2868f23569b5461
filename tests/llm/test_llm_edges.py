"""Every operator on nulls, empty and very long texts, ties, repeated rows, no rows and clashing names."""

import random

import brute
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cartwright.llm import decontaminate, licenses, line_dedup, quality_model, quality_rules, sentencepiece_codec, shards, simhash, suffix_dedup, url_filter

WORDS = "the of and thorn water über señal run 12 Licence x1 été a".split()
PASSAGE = "It was the best of times, it was the worst of times, it was the age of wisdom and of folly."
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"


def texts():
    """(id, text): distinct ids, with copies, shared lines and passages among them."""
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))
    out = [None, "", " \t\n ", "x", "Hello, World", prose(60), prose(3000), "a" * 70_000, "word " * 200, "\x00\x01 odd \x7f bytes"]
    base = prose(120)
    out += [base, base, base, base.replace("the", "The"), base + " one more", f"{PASSAGE}\n{prose(70)}", f"{prose(50)}\n {PASSAGE} \nend"]
    out += [f"{ITEM} {prose(9)}", f"so {' '.join(ITEM.split()[1:11])} it is", "short item here now", f"A short, item... {ITEM.upper()}"]
    out += ["line one of ten\nline one of ten\n\nLINE ONE OF TEN ", "\n\n\n", "MIT License and the Apache  license", "漢字" * 40, "漢字" * 40 + "x"]
    out += ["Café GENERAL public-license\nSPDX-License-Identifier: (MIT OR GPL-2.0-only) AND BSD-3-Clause", prose(500) + PASSAGE + PASSAGE]
    return [(7 * i % 31, text) for i, text in enumerate(out)]


def frame(spark, rows, extra=()):
    """A table of the documents' columns, with further columns of any name."""
    data = [Row(doc_id=i, text=x, lang=None, source="s", n_chars=None, **{c: "keep" for c in extra}) for i, x in rows]
    kinds = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", `{c}` string" for c in extra)
    return spark.createDataFrame(data, kinds)


CLASHING = (
    "id", "rest", "fp", "h", "key", "place", "places", "words", "n_words", "n_lines", "score", "ids", "host", "kept",
    "spans", "shard", "slot", "added0", "_text", "grp", "size", "n_hit", "items", "labels", "component_id", "class", "row",
)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, texts(), CLASHING).repartition(3).cache()


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, "short item"), (3, None), (10, ""), (4, ITEM), (5, "! ?")]
    return spark.createDataFrame(rows, "item_id long, text string")


def by_id(df):
    rows = df.collect()
    found = {r["doc_id"]: r for r in rows}
    assert len(found) == len(rows)
    return found


def test_decontaminate(spark, docs, items):
    want = brute.decontaminate(texts(), [(r.item_id, r.text) for r in items.collect()])
    got = {i: (r.n_words, r.n_hit, r["items"]) for i, r in by_id(decontaminate.decontaminate(docs, items)).items()}
    assert got == want
    assert sum(hit > 0 for _, hit, _ in want.values()) >= 4


def test_decontaminate_long_items_only(spark, docs, items):
    long_items = items.where("item_id in (1, 4)")
    want = brute.decontaminate(texts(), [(1, ITEM), (4, ITEM)])
    assert {i: (r.n_words, r.n_hit, r["items"]) for i, r in by_id(decontaminate.decontaminate(docs, long_items)).items()} == want


def test_decontaminate_without_items(spark, docs, items):
    got = by_id(decontaminate.decontaminate(docs, items.where("false")))
    assert {(r.n_hit, tuple(r["items"])) for r in got.values()} == {(0, ())}


def test_shards(spark, docs):
    rows = by_id(shards.assign(docs, shards=5))
    size = {i: len((x or "").encode()) + 8 for i, x in texts()}
    assert {i: r["size"] for i, r in rows.items()} == size
    assert {i: r.text_crc32 for i, r in rows.items()} == {i: None if x is None else brute.crc(x) for i, x in texts()}
    for s in {r["shard"] for r in rows.values()}:
        assert sorted(r["slot"] for r in rows.values() if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows.values())))
    where = {}
    for i, x in texts():
        where.setdefault(x, set()).add(rows[i]["shard"])
    assert all(len(s) == 1 for s in where.values())


@pytest.mark.parametrize("n", [3, 24])
def test_schedule_is_as_even_as_one_by_one(n):
    """Classes of many groups are dealt as the heap would deal the groups one at a time."""
    rng = random.Random(n)
    classes = [(size, rng.randrange(1, 60)) for size in rng.sample(range(9, 1000), 80)]
    loads = [0] * n
    for name, s, low, high in shards.schedule([(size, count, size * count) for size, count in classes], n):
        loads[s] += (high - low) * name
    one = [0] * n
    for size, count in sorted(classes, reverse=True):
        for _ in range(count):
            one[one.index(min(one))] += size
    assert sorted(loads) == sorted(one)


def test_quality_rules(spark, docs):
    rows = by_id(quality_rules.judge(docs))
    for i, x in texts():
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(x), i
        assert not (r.base_failed and r.kept)
    assert rows[texts()[0][0]]["lang"] is None and rows[0]["_text"] == "keep"


def test_quality_rules_order_does_not_change_the_verdict(spark, docs):
    orders = [list(quality_rules.RULES), list(quality_rules.RULES)[::-1]]
    a, b = ({i: r.kept for i, r in by_id(quality_rules.judge(docs, order=o)).items()} for o in orders)
    assert a == b


def test_simhash(spark, docs):
    want = brute.simhash(texts())
    assert {i: (r.fingerprint, r.component_id) for i, r in by_id(simhash.near_duplicates(docs)).items()} == want


def test_line_dedup(spark, docs):
    left = line_dedup.dedup_lines(docs, filter_bits=1 << 16)
    assert left.columns.count("n_lines") == 1 and "_text" in left.columns
    for i, (n, dropped, kept) in brute.line_dedup(texts()).items():
        r = by_id(left)[i] if i == 0 else None
    rows = by_id(left)
    for i, (n, dropped, kept) in brute.line_dedup(texts()).items():
        r = rows[i]
        assert (r.n_lines, r.n_dropped, r.text or "") == (n, dropped, kept)


def test_sentencepiece_equals_the_library_and_decodes(spark, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    coded = sentencepiece_codec.encode(docs)
    rows = by_id(sentencepiece_codec.decode(coded, out="back"))
    for i, x in texts():
        assert rows[i]["ids"] == (None if x is None else library.encode(x))
        assert rows[i]["back"] == x


def test_licenses(spark, docs):
    rows = by_id(licenses.scan(docs))
    for i, x in texts():
        r = rows[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(x), i
        assert set(filter(None, r.base_labels.split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    tagged = next(r for r in rows.values() if "bsd-3-clause" in r["labels"])
    assert tagged["labels"] == "bsd-3-clause,gpl,gpl-2.0-only,mit"


@pytest.mark.parametrize(
    "text, want",
    [
        (b": MIT", (0.9, ["mit"])),
        (b" MIT OR GPL-2.0 AND BSD-3-Clause", (0.9, ["mit", "gpl-2.0", "bsd-3-clause"])),
        (b" (MIT OR GPL-2.0) AND AGPL-3.0+", (0.3, ["mit", "gpl-2.0", "agpl-3.0+"])),
        (b" GPL-2.0 WITH Classpath-exception-2.0 OR Odd", (0.6, ["gpl-2.0", "odd"])),
        (b" MIT) and more", (0.9, ["mit"])),
        (b" (MIT", None),
        (b" MIT AND", None),
        (b" OR MIT", None),
        (b"", None),
    ],
)
def test_license_expressions(text, want):
    got = licenses.evaluate(text)
    assert got == want if want is None else (got[0] == pytest.approx(want[0]) and got[1] == want[1])


def test_suffix_dedup(spark, docs):
    want = {i: (n, gone, spans, brute.sha(kept)) for i, (n, gone, spans, kept) in brute.suffix_dedup(texts()).items()}
    got = {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in by_id(suffix_dedup.dedup_passages(docs)).items()}
    assert got == want
    assert sum(gone for _, gone, _, _ in want.values()) > 500


URLS = [
    None, "", "no scheme/net/", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/en", "https://example.net/en/",
    "http://net/", "http://net", "http://x.org/fr/1", "http://x.org/fr", "http://org/fr/", "ftp://example.com/de/#a", "http://planet/",
    "http://example.com/de?x=/de/", "http://cheap-pills.example.com/", "http://a.b/casino/x", "http://a.b://c", "HTTP://é.net/ü", "http://a..net/",
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, rest string")
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert len(rows) == 2 * len(URLS)
    for i, r in rows.items():
        url = URLS[i % len(URLS)]
        rule = brute.url_rule(url)
        assert (r.host, r.path, r["rule"]) == (*brute.split_url(url), rule), url
        words = rule is None and any(w in (url or "") for w in ("pills", "casino"))
        assert r.verdict == (brute.RULES[rule] if rule else "block" if words else "allow"), url


def test_cascade_is_exact_over_its_keys(spark):
    keys = spark.range(0, 60_000).select(F.xxhash64("id").alias("h"))
    cascade = url_filter.build(keys, keys.where("h % 7 = 0"))
    assert len(cascade.levels) >= 2
    h = keys.toPandas()["h"].to_numpy()
    assert (cascade.lists(h.view("u8")) == (h % 7 == 0)).all()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(len(x or "") > 150), 0) for i, x in texts()] + [(0, 0, 1), (1, None, None), (None, 1, 0), (999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_model_edges(spark, docs, labels):
    machine = quality_model.fit(docs, labels)
    a = {i: r["score"] for i, r in by_id(quality_model.score(docs, machine)).items()}
    assert len(a) == len(texts()) and all(0 <= s <= 1 for s in a.values())
    again = quality_model.fit(docs.repartition(7), labels)
    b = {i: r["score"] for i, r in by_id(quality_model.score(docs, again)).items()}
    assert a == b
    assert set(quality_model.score(docs, machine, keep_text=True).columns) == set(docs.columns)


def test_quality_model_without_labels(spark, docs, labels):
    machine = quality_model.fit(docs, labels.where("false"))
    assert {r["score"] for r in quality_model.score(docs, machine).collect()} == {0.5}


def test_sum_of_squares_identity():
    import numpy as np

    rng = np.random.default_rng(1)
    v, w, x = rng.normal(size=(9, 4)), rng.normal(size=9), rng.normal(size=9)
    edges, number = np.array([0, 5, 9]), np.arange(9)
    got, _, _ = quality_model._margin(0.3, w, v, edges, number, x)
    for row, (a, b) in enumerate(((0, 5), (5, 9))):
        pairs = sum(v[i] @ v[j] * x[i] * x[j] for i in range(a, b) for j in range(i + 1, b))
        assert got[row] == pytest.approx(0.3 + w[a:b] @ x[a:b] + pairs)


def test_repeated_rows_of_an_id(spark):
    rows = [(1, PASSAGE), (1, PASSAGE), (2, PASSAGE), (2, PASSAGE), (None, PASSAGE), (3, "another text of a few words")]
    df = frame(spark, rows)
    left = [(r.doc_id, r.n_dropped) for r in line_dedup.dedup_lines(df).collect()]
    assert sorted(left, key=str) == sorted([(1, 0), (1, 0), (2, 1), (2, 1), (None, 0), (3, 0)], key=str)
    cut = [(r.doc_id, r.n_removed) for r in suffix_dedup.dedup_passages(df).collect()]
    n = len(PASSAGE)
    assert sorted(cut, key=str) == sorted([(1, 0), (1, 0), (2, n), (2, n), (None, 0), (3, 0)], key=str)
    groups = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(groups, key=str) == sorted([(1, 1), (1, 1), (2, 1), (2, 1), (None, 1), (3, 3)], key=str)
    dealt = shards.assign(df, shards=2).collect()
    assert len(dealt) == 6
    assert len({r["shard"] for r in dealt if r["size"] == n + 8}) == 1
    assert len({(r["shard"], r["slot"]) for r in dealt}) == 6


def test_empty_tables(spark, items, labels):
    none = frame(spark, [(1, "x")]).where("false")
    for made in (
        decontaminate.decontaminate(none, items),
        shards.assign(none),
        quality_rules.judge(none),
        simhash.near_duplicates(none),
        line_dedup.dedup_lines(none, filter_bits=1 << 16),
        sentencepiece_codec.decode(sentencepiece_codec.encode(none)),
        licenses.scan(none),
        quality_model.score(none, quality_model.fit(none, labels)),
        suffix_dedup.dedup_passages(none),
        url_filter.judge(none.withColumnRenamed("text", "url")),
    ):
        assert made.collect() == []
