"""The pipeline's stages on rows whose ids are null or shared."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def prose(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def frame(spark, rows):
    data = [Row(doc_id=i, text=x, lang="en", source="s", n_chars=len(x or "")) for i, x in rows]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_each_group_keeps_one_row_whatever_its_ids_are(spark):
    rng = random.Random(2)
    a, b, c, d, e = (" ".join(prose(rng, 80)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (7, b), (5, c), (5, d), (5, d), (9, c), (4, e), (None, None), (None, "")]
    kept = stage("simhash_near_dedup")(spark, frame(spark, rows), SMALL).collect()
    got = sorted(((r.doc_id, r.text or "") for r in kept), key=str)
    assert got == sorted([(None, a), (7, b), (5, c), (5, d), (4, e), (None, "")], key=str)


@pytest.mark.parametrize("id", [None, 5])
def test_contaminated_rows_go_and_their_namesakes_stay(spark, id):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").where(F.col("text").isNotNull()).first().text
    clean = " ".join(prose(random.Random(3), 60))
    kept = stage("decontamination")(spark, frame(spark, [(id, f"so {item} it is"), (id, clean)]), SMALL)
    assert [(r.doc_id, r.text) for r in kept.collect()] == [(id, clean)]
