import json

import pytest
from pyspark.sql import functions as F

from cartwright import lineage
from cartwright.plans import prep, segments
from cartwright.sources import tables
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_with_padded_header_and_pruning(spark, tmp_path):
    path = write(tmp_path / "orders.csv", " order_id ,user_id, order_dow\n1,7,3\n2,,6\n")
    df = tables.read_csv(spark, path, "orders")
    assert df.dtypes == [("order_id", "bigint"), ("user_id", "bigint"), ("order_dow", "int")]
    assert df.where(F.col("order_id") == 2).first().user_id is None
    pruned = tables.read_csv(spark, path, "orders", ["user_id"])
    assert "ReadSchema: struct<user_id:bigint>" in pruned._jdf.queryExecution().toString()


def test_files_of_a_folder_must_have_one_header(spark, tmp_path):
    (tmp_path / "orders").mkdir()
    write(tmp_path / "orders" / "a.csv", "order_id,user_id\n1,7\n")
    write(tmp_path / "orders" / "b.csv", "order_id,user_id\n2,8\n")
    assert sorted(map(tuple, tables.read_csv(spark, str(tmp_path / "orders"), "orders").collect())) == [(1, 7), (2, 8)]
    write(tmp_path / "orders" / "c.csv", "user_id,order_id\n9,3\n")
    with pytest.raises(Exception, match="header"):
        tables.read_csv(spark, str(tmp_path / "orders"), "orders").collect()


def test_load_raw_unions_lines(spark, tmp_path):
    write(tmp_path / "aisles.csv", "aisle_id,aisle\n1,a\n")
    write(tmp_path / "departments.csv", "department_id,department\n1,d\n")
    write(tmp_path / "products.csv", "product_id,product_name,aisle_id,department_id\n5,x,1,1\n")
    write(tmp_path / "orders.csv", "order_id,user_id,order_number,order_dow,order_hour_of_day,days_since_prior_order\n1,7,1,0,9,\n2,7,2,3,9,4.0\n")
    write(tmp_path / "order_products__prior.csv", "order_id,product_id,add_to_cart_order,reordered\n1,5,1,0\n")
    write(tmp_path / "order_products__train.csv", "order_id,product_id,add_to_cart_order,reordered\n2,5,1,1\n")
    raw = tables.load_raw(spark, str(tmp_path))
    assert raw["order_products"].count() == 2
    wide = prep.merge_sales(raw["order_products"], raw["orders"], raw["products"], raw["aisles"], raw["departments"])
    assert {r.department for r in wide.collect()} == {"d"}


def test_optional_table(spark, tmp_path):
    assert tables.read_optional(spark, str(tmp_path / "none.csv"), "assignments") is None
    path = write(tmp_path / "a.csv", "user_id,cluster\n1,3\n")
    assert tables.read_optional(spark, path, "assignments").first().cluster == 3


def test_log_appends_and_json_keeps_names(spark, tmp_path):
    stats = spark.createDataFrame([("GLOBAL", 5)], "context string, num_rules int")
    for _ in range(2):
        tables.append_log(stats, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log/json")).count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "log/csv")).columns == ["context", "num_rules", "timestamp"]
    runs = tmp_path / "runs"
    runs.mkdir()
    for n in (10, 100):
        write(runs / f"run{n}.json", json.dumps({"num_users_evaluated": n, "precision": 0.1}, indent=2))
    got = {r.source_file: r.num_users_evaluated for r in tables.read_json_files(spark, str(runs)).collect()}
    assert got == {"run10.json": 10, "run100.json": 100}
    tables.write_json(stats, str(tmp_path / "one"))
    assert spark.read.json(str(tmp_path / "one")).first().num_rules == 5


def test_tables_and_models_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], "a"), (2, [3], "b")], "order_id long, products array<long>, kind string")
    tables.write_table(df, str(tmp_path / "t"), partition_by=["kind"])
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(map(tuple, back.select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
    tables.write_table(df.select("order_id", "kind"), str(tmp_path / "c"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    model = Pipeline(stages=[VectorAssembler(inputCols=["order_id"], outputCol="v")]).fit(df)
    tables.save_model(model, str(tmp_path / "m"))
    assert tables.load_model(str(tmp_path / "m")).transform(df).first().v[0] == 1.0


def test_stage_uses_the_shared_folder_or_spark_storage(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "folder", lambda s: None)
    staged = lineage.stage(spark.range(5), "probe")
    assert staged.count() == 5 and staged.storageLevel.useDisk
    monkeypatch.setattr(lineage, "folder", lambda s: str(tmp_path))
    staged = lineage.stage(spark.range(5), "probe")
    assert staged.count() == 5
    assert str(tmp_path) in staged.inputFiles()[0]
    assert "broadcast" in lineage.build_side(staged)._jdf.queryExecution().toString().lower()
    assert "merge" in lineage.build_side(staged, 3)._jdf.queryExecution().toString().lower()


def test_optional_segments_table(spark):
    users = spark.createDataFrame([(1,)], "user_id long")
    assert prep.attach_optional(users, None, "x", 4).first().x == 4
    assert segments.frequencies(users, "user_id").first().num_users == 1
