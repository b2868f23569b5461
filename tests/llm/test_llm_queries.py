"""The registered queries and the pipeline on the smallest tables, against SQL and plain Python."""

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from cartwright.llm import quality_model, quality_rules, sentencepiece_codec
from cartwright.llm.queries import ORACLES, QUERIES
from tools.check import rows_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return duck.sql("SELECT doc_id, text FROM documents ORDER BY 1").fetchall()


def rows(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SMALL).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, got) == rows_of(rel.columns, rel.fetchall())


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert [n for n in range(1, 14) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []


def test_shards(spark, texts):
    got = rows(spark, "op2_shards")
    loads = [0] * 24
    for i, x in texts:
        r = got[i]
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(x.encode()) + 8, brute.crc(x), "bytes", None)
        loads[r["shard"]] += r["size"]
    largest = max(sum(len(x.encode()) + 8 for _, x in texts if x == y) for _, y in texts)
    assert max(loads) <= max(largest, 1.1 * sum(loads) / 24)
    for s in range(24):
        assert sorted(r.slot for r in got.values() if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got.values())))


def test_simhash(spark, texts):
    assert {i: (r.fingerprint, r.component_id) for i, r in rows(spark, "op4_simhash").items()} == brute.simhash(texts)


def test_sentencepiece(spark, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    for i, r in rows(spark, "op6_sentencepiece").items():
        assert r["ids"] == library.encode(dict(texts)[i]) and r.n_tokens == len(r["ids"]) and r.round_trip


def test_licenses(spark, texts):
    got = rows(spark, "op7_licenses")
    for i, x in texts:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(x)


def test_quality_model_on_held_out_rows(spark):
    path = "/root/testdata/sf0.01"
    got = QUERIES["op8_quality_model"](spark, path)
    marks = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality")
    held = got.where("held_out").join(marks, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{path}/documents.parquet").count()
    right = sum(r.predicted == r.quality for r in held)
    assert right >= 0.95 * len(held) and all(r.predicted == 1 for r in held if r.quality == 1)


def test_rules_keep_clean_documents(spark):
    path = "/root/testdata/sf0.01"
    marks = spark.read.parquet(f"{path}/labels.parquet").where("quality = 1").select("doc_id")
    lost = QUERIES["op3_quality_rules"](spark, path).join(marks, "doc_id").where("not kept and not base_failed")
    assert lost.count() == 0


def test_rule_order_covers_all_rules(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(quality_rules.rule_order(docs, "text", 50)) == sorted(quality_rules.RULES)


def test_pipeline_stages_against_plain_python(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    out = {}
    for name, apply in corpus_pipeline.STAGES:
        docs = apply(spark, docs, SMALL)
        out[name] = docs = docs.cache()
        if name != "sentencepiece":
            assert docs.columns == names
    text = lambda stage: {r.doc_id: r.text for r in out[stage].collect()}
    a = text("quality_classifier")
    machine = quality_model.fit(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = quality_model.score(spark.read.parquet(f"{SMALL}/documents.parquet"), machine).collect()
    assert set(a) == {r.doc_id for r in scores if r["score"] >= 0.7} and all(dict(texts)[i] == x for i, x in a.items())
    b = text("line_dedup")
    assert b == {i: kept for i, (_, _, kept) in brute.line_dedup(sorted(a.items())).items()}
    assert {r.doc_id: r.n_chars for r in out["line_dedup"].collect()} == {i: len(x) for i, x in b.items()}
    c = text("simhash_near_dedup")
    groups = brute.simhash(sorted(b.items()))
    assert c == {i: x for i, x in b.items() if groups[i][1] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    d = text("decontamination")
    found = brute.decontaminate(sorted(c.items()), items)
    assert d == {i: x for i, x in c.items() if not found[i][1]}
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    assert {r.doc_id: r["ids"] for r in out["sentencepiece"].collect()} == {i: library.encode(x) for i, x in d.items()}


def test_pipeline_on_no_rows_and_more_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumns({"rest": F.lit("r"), "id": F.lit(1), "score": F.lit("s")})
    nothing = docs.where("false")
    for name, apply in corpus_pipeline.STAGES:
        some, nothing = apply(spark, docs.limit(40), SMALL), apply(spark, nothing, SMALL)
        assert nothing.count() == 0
        if name != "sentencepiece":
            assert some.columns == nothing.columns == docs.columns
