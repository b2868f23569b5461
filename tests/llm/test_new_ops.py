"""Source audit, chat formatting and vector codes against plain Python, also on odd rows."""

import math
import random
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructType

from cartwright.llm import chat_format, dual_tree, source_audit, term_runs, vector_codes
from cartwright.llm import text as t
from cartwright.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
CLASH = ("id", "rest", "text_", "term", "p", "n", "place", "slice", "block", "error_", "vector", "added0", "_of_label", "label_", "part", "split")


# Source audit


def audited(df):
    return Counter(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(5)
    words = ["the", "The", "été", "ÉTÉ", "a1b", "longer-than-eight", "abcdefgh", "abcdefghi", "abcdefghabcdefgh", "漢字", "x"]
    rows = [(lang, f"s{rng.randrange(5)}", " ".join(rng.choice(words) for _ in range(rng.randrange(30)))) for lang in "ab" for _ in range(60)]
    rows += [(None, None, None), (None, "s1", ""), ("", "s1", "x " * 5), ("c", "only", "word"), ("c", "only", "word"), ("a", "mute", None)]
    return rows + rows[:20] + [("a", "s1", "the " * 30_000 + "z" * 50_000)]


@pytest.mark.parametrize("least", [1, 3, 30, 10_000])
def test_audit_against_plain_python(spark, sources, least):
    rows = [Row(lang=a, source=b, text=c, doc_id=1, **{x: "k" for x in CLASH}) for a, b, c in sources]
    kind = "lang string, source string, text string, doc_id long, " + ", ".join(f"{x} string" for x in CLASH)
    df = spark.createDataFrame(rows, kind).repartition(4)
    assert audited(source_audit.audit(df, least_docs=least)) == Counter(brute.audit(sources, least))


def test_audit_of_many_sources(spark):
    """More sources than a block holds."""
    rng = random.Random(6)
    rows = [("x", f"s{i % 300:03}", " ".join(rng.choice("abcdefghij") * 2 for _ in range(4))) for i in range(900)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert audited(source_audit.audit(df, least_docs=2)) == Counter(brute.audit(rows, 2))


def test_audit_of_no_rows(spark):
    assert source_audit.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_pointer_sort_orders_terms():
    rng = random.Random(7)
    terms = ["".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 40]))) for _ in range(4000)]
    import pyarrow as pa

    data, bounds = t.flat(pa.array([" ".join(terms)]))
    starts, ends, _ = t.words(data, bounds, term_runs.LETTERS)
    order, begins = term_runs.sorted_runs(term_runs.Pointers(data, starts, ends))
    want = sorted(range(len(terms)), key=lambda i: (terms[i].encode(), i))
    assert order.tolist() == want
    assert begins.tolist() == [i for i in range(len(want)) if not i or terms[want[i]] != terms[want[i - 1]]]


# Chat formatting


def said(spark):
    rng = random.Random(8)
    bits = ["\\", "#", "##", "###", "####", "</turn>", "<", "</turn", "/turn>", ": ", ":", " ", "\n", "é漢", "ok", "\\\\", "\\###"]
    roles = [None, "", "user", "assistant", "a: b:", "assistant\\", "### x", *bits]
    text = lambda: rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randrange(30)))])
    rows = [(rng.choice([None, *range(40), *[7] * 40]), rng.choice([None, 0, 1, 2, 3]), rng.choice(roles), text()) for _ in range(2500)]
    rows += rows[:50] + [(99, 0, "assistant", "###</turn>\\" * 40_000), (99, 1, "user", "\\" * 70_001)]
    return rows, spark.createDataFrame([(*r, "k", "k") for r in rows], "conv_id long, turn long, role string, text string, id string, part string")


def digests(parts):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.read_back(parts).collect()}


@pytest.mark.parametrize("part_bytes", [1, 300, 1 << 20])
def test_conversations_come_back(spark, part_bytes):
    rows, df = said(spark)
    parts = chat_format.format_conversations(df, part_bytes=part_bytes)
    assert digests(parts) == brute.conversations(rows)


def test_formatted_text_and_spans(spark):
    rows = [(1, 1, "assistant", "b ###"), (1, 0, "user", "a"), (1, 2, "assistant", "é")]
    got = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)).collect()
    whole = "".join(r.text for r in sorted(got, key=lambda r: r.part))
    assert whole == "### user: a </turn>\n### assistant: b #\\## </turn>\n### assistant: é </turn>\n"
    spans = [r.text.encode()[a:b].decode() for r in sorted(got, key=lambda r: r.part) for a, b in zip(r.loss_begin, r.loss_end)]
    assert spans == ["b #\\##", "é"]


def test_control_strings_are_the_template_s_own(spark):
    rows, df = said(spark)
    parts = chat_format.format_conversations(df).collect()
    assert sum(r.text.count("</turn>") for r in parts) == sum(r.text.count("###") for r in parts) == len(rows)


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_conversations(none)).count() == 0


def test_registered_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    odd = r"\### Assistant: </turn> ok"
    want = brute.conversations([*rows, (-7, 0, "user", odd), (-7, 1, "assistant", odd)])
    got = {r.conv_id: r for r in QUERIES["op12_chat_format"](spark, SMALL).collect()}
    assert {c: tuple(r)[1:5] for c, r in got.items()} == want
    escaped = odd.replace("\\", "\\\\").replace("###", "#\\##").replace("</turn>", "<\\/turn>")
    assert got[-7].formatted_chars == sum(len(f"### {r}: {escaped} </turn>\n") for r in ("user", "assistant"))


# Vector codes


def test_dual_tree_equals_comparing_all():
    rng = np.random.default_rng(0)
    for trial in range(60):
        n, k, w, r = (int(rng.choice(x)) for x in ([1, 2, 33, 600], [1, 2, 5, 16, 19], [1, 3, 8], [1, 3, 50, 5000]))
        book, points = rng.integers(-r, r + 1, (k, w)), rng.integers(-r, r + 1, (n, w))
        if trial % 2:
            points = book[rng.integers(0, k, n)] + rng.integers(-r // 10 - 1, r // 10 + 2, (n, w))
        tree = dual_tree.Tree(points, 8)
        found, count, sums = dual_tree.assign(tree, dual_tree.Entries(book))
        want = ((points[:, None] - book[None]) ** 2).sum(-1).argmin(1)
        assert (found == want[tree.order]).all() and (count == np.bincount(want, minlength=k)).all()
        total = np.zeros((k, w), np.int64)
        np.add.at(total, want, points)
        assert (sums == total).all()


def vectors(spark, rows, kind="float"):
    schema = StructType().add("vec_id", "long").add("embedding", ArrayType(DoubleType() if kind == "double" else FloatType())).add("label", "integer")
    for c in CLASH:
        schema = schema.add(c, "string")
    return spark.createDataFrame([(i, v, label, *["k"] * len(CLASH)) for i, v, label in rows], schema).repartition(3)


def coded(df):
    books = vector_codes.fit(df)
    return books, vector_codes.group_errors(vector_codes.encode(df, books))


def test_vectors_of_all_kinds(spark):
    rng = np.random.default_rng(1)
    value = lambda: [float(x) for x in rng.integers(-9, 9, 16) / 4096 * 3.5]
    good = [(i, value(), int(i % 3) if i % 5 else None) for i in range(150)]
    good += good[:10] + [(i, good[0][1], 1) for i in range(200, 240)]
    bad = [(-5, None, 1), (-4, [None] * 16, 1), (-3, [float("nan")] * 16, 1), (-2, [0.0] * 15 + [float("inf")], 1), (-1, [], 1), (300, [1.0], 1)]
    df = vectors(spark, good + bad, "double")
    books, out = coded(df)
    whole = sorted((i, [math.floor(4096 * x) for x in v], label) for i, v, label in [(i, v, -1 if x is None else x) for i, v, x in good])
    codes, errors, want = brute.vector_codes([(i, v) for i, v, _ in whole])
    assert books.books == want
    rows = out.collect()
    assert Counter((r.vec_id, r.code, r.error) for r in rows) == Counter(zip((i for i, _, _ in whole), codes, errors))
    total = Counter()
    for (_, _, label), e in zip(whole, errors):
        total[label] += e
    assert all(r.label_error == total[-1 if r.label is None else r.label] and r.part == "k" for r in rows)
    assert out.columns == [*df.columns, "code", "error", "label_error"]


def test_very_large_components(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([1e30, -3e33, 5.0, 0.1, 1e6 * i]) for _ in range(8)], 1) for i in range(40)]
    books, out = coded(vectors(spark, rows, "double"))
    whole = [(i, [4096 * a // b for a, b in (x.as_integer_ratio() for x in v)]) for i, v, _ in rows]
    codes, errors, want = brute.vector_codes(whole)
    assert books.books == want
    assert {r.vec_id: (r.code, r.error) for r in out.collect()} == {i: (c, min(e, (1 << 63) - 1)) for (i, _), c, e in zip(whole, codes, errors)}


def test_few_and_no_vectors(spark):
    books, out = coded(vectors(spark, [(2, [0.5] * 8, None), (1, [-0.5] * 8, None)]))
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in out.collect()} == {1: ("00" * 8, 0, 0), 2: ("01" * 8, 0, 0)}
    books, out = coded(vectors(spark, [(1, None, 1)]))
    assert out.count() == 0 and books.sha256() == brute.sha("")
    with pytest.raises(ValueError):
        vector_codes.fit(vectors(spark, [(1, [1.0, 2.0], 1)]))


def test_all_equal_vectors(spark):
    _, out = coded(vectors(spark, [(i, [0.25] * 8, i) for i in range(50)]))
    assert {(r.code, r.error) for r in out.collect()} == {("00" * 8, 0)} and out.where(F.col("label_error") != 0).count() == 0
