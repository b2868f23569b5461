import pytest
from pyspark.sql import functions as F

from cartwright.plans import catalog
from cartwright.sources import name_index

NAMES = ["Small Ring", "string of rings", "RINGRINGRING", "ri", "g", "", None, "Bolt \U0001f529\U0001f529 bolt", "Äpfel äpfel", "aaaa", "a ring%_\\"]


@pytest.fixture(scope="module")
def products(spark):
    rows = [(1 + i * 40_000, name, 7) for i, name in enumerate(NAMES)] + [(None, "ring", 7), (1, "Small Ring", 8)]
    many = spark.range(5000, 9000).select("id", F.concat(F.lit("gear "), F.col("id").cast("string")), F.lit(1))
    return spark.createDataFrame(rows, "product_id long, product_name string, text int").union(many)


@pytest.fixture(scope="module")
def index(products, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("names") / "index")
    name_index.build(products, path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


TEXTS = ["RING", "ringring", "ri", "g", "G", "\U0001f529", "\U0001f529 B", "ÄPF", "aaa", "aaaaa", "%_\\", "gear 71", "none of them", "olt"]


def test_the_rows_of_the_plain_search(spark, products, index):
    known = products.where("product_id IS NOT NULL")
    for text in TEXTS:
        assert rows(name_index.search(products, index, text)) == rows(catalog.search(known, text)), text
    assert rows(name_index.search(products, index, "")) == rows(products)


def test_many_texts(spark, products, index):
    texts = spark.createDataFrame([(t, "x") for t in [*TEXTS, "RING", "", None]], "text string, product_name string")
    want = [
        (text, r.product_id, r.product_name)
        for text in TEXTS
        for r in catalog.search(products.where("product_id IS NOT NULL"), text).collect()
    ]
    assert rows(name_index.search_many(texts, products, index)) == sorted(want, key=repr)
    assert name_index.search_many(texts.limit(0), products, index).isEmpty()


def test_only_the_lists_of_the_text_are_read(spark, index):
    plan = name_index.candidates(spark, index, "ring")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(gram, [ing,rin])]" in plan
    plan = name_index.candidates(spark, index, "ri")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(gram,ri)" in plan


def test_lists_are_no_longer_than_a_block(spark, index):
    lists = spark.read.parquet(f"{index}/postings")
    assert lists.groupBy("gram").agg(F.countDistinct("block").alias("b")).where("gram = 'rin'").first().b > 1
    assert lists.where("exists(ids, i -> shiftright(i, 16) <> block)").isEmpty()


def test_no_products(spark, products, tmp_path):
    path = str(tmp_path / "none")
    name_index.build(products.limit(0), path)
    assert name_index.search(products, path, "ring").isEmpty() and name_index.search(products, path, "ri").isEmpty()
