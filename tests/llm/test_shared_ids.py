"""Rows that share an id but not the text."""

import random

import brute
from test_pipeline_ids import frame

from cartwright.llm import decontaminate, line_dedup, suffix_dedup

SHARED = "a line that several documents hold"


def test_lines_of_an_id_with_two_texts(spark):
    rows = [(1, SHARED), (2, f"{SHARED}\nonly in the long text of two"), (2, "only in the other text of two"), (2, f"more of two here\n{SHARED}"), (None, SHARED)]
    got = sorted(((r.doc_id, r.text, r.n_dropped) for r in line_dedup.dedup_lines(frame(spark, rows)).collect()), key=str)
    want = [(1, SHARED, 0), (2, "only in the long text of two", 1), (2, "only in the other text of two", 0), (2, "more of two here", 1), (None, SHARED, 0)]
    assert got == sorted(want, key=str)


def test_decontamination_judges_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = spark.createDataFrame([(None, item), (5, f"so {item}"), (5, "clean text"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, "x"), (3, "clean text here")], "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.decontaminate(docs, items).collect()), key=str)
    assert got == sorted([(None, 11, 11, ["1"]), (5, 12, 11, ["1"]), (5, 2, 0, []), (None, 0, 0, [])], key=str)


def test_a_short_item_changes_nothing_for_the_others(spark):
    rng = random.Random(9)
    words = [f"w{rng.randrange(400)}" for _ in range(4000)]
    long = " ".join(words[100:130])
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[90:112])), (3, "w1 w2 w3")], "doc_id long, text string")
    rows = [(1, long), (2, "w1"), (3, "w2 w3"), (4, " ".join(words[2000:2007]))]
    items = spark.createDataFrame(rows, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == brute.decontaminate([(r.doc_id, r.text) for r in docs.collect()], rows)


def test_passages_of_an_id_with_several_texts(spark):
    rng = random.Random(11)
    some = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, own, other = some(120), some(80), some(90)
    rows = [(1, passage), (2, own + passage + own), (2, "short"), (3, passage), (3, other), (3, passage[:60] + other), (4, other)]
    got = sorted((r.doc_id, bytes(r.kept).decode(), r.n_removed, r.n_spans) for r in suffix_dedup.dedup_passages(frame(spark, rows)).collect())
    want = [(1, passage, 0, 0), (2, own + own, 120, 1), (2, "short", 0, 0), (3, "", 120, 1), (3, other, 0, 0), (3, other, 60, 1), (4, "", 90, 1)]
    assert got == sorted(want)
