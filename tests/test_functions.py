"""Column expressions on hand-made edge cases."""

import hashlib

from pyspark.sql import functions as F

from cartwright.functions import baskets as bk
from cartwright.functions import context as ctx
from cartwright.functions import scoring


def column(spark, values, kind, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("x"))).collect()]


def test_time_bucket_edges(spark):
    got = column(spark, [0, 5, 6, 11, 12, 17, 18, 23, 24, None], "int", ctx.time_bucket)
    assert got == ["night", "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", None, None]


def test_weekend_and_size(spark):
    assert column(spark, [0, 1, 5, 6], "int", ctx.is_weekend) == [1, 0, 0, 1]
    assert column(spark, [2, 4, 5, 14, 15, 25], "int", ctx.basket_size_category) == [
        "small", "small", "medium", "medium", "large", "large",
    ]


def test_fixed_lifecycle_edges(spark):
    got = column(spark, [0, 1, 3, 4, 10, 11, 50, 51], "int", ctx.fixed_lifecycle)
    assert got == [None, "new", "new", "regular", "regular", "loyal", "loyal", "vip"]


def test_context_key_null_and_empty(spark):
    df = spark.createDataFrame([("night", None, True)], "time_bucket string, behavior_cluster int, is_weekend boolean")
    row = df.select(
        ctx.context_key(["time_bucket", "behavior_cluster"]).alias("a"), ctx.context_key([]).alias("b")
    ).first()
    assert (row.a, row.b) == ("time_bucket=night|behavior_cluster=unknown", "GLOBAL")


def test_infer_level(spark):
    keys = [
        "GLOBAL",
        "time_bucket=a|is_weekend=0",
        "is_weekend=0|behavior_cluster=1|time_bucket=a",
        "time_bucket=a|is_weekend=0|behavior_cluster=1|preference_cluster=2",
        "time_bucket=a|is_weekend=0|behavior_cluster=1|preference_cluster=2|lifecycle_stage=new",
        "lifecycle_stage=new",
    ]
    assert column(spark, keys, "string", ctx.infer_level) == ["L5", "L4", "L3", "L2", "L1", "L5"]


def test_level_mask(spark):
    df = spark.createDataFrame([("L1",), ("L4",), ("L4",)], "l string")
    row = df.agg(F.bit_or(ctx.level_bit(F.col("l"))).alias("m")).select(ctx.levels_of(F.col("m"))).first()
    assert row[0] == ["L1", "L4"]


def test_parse_basket(spark):
    texts = ["[]", "[1, 2]", "[ 3 ,4]", "[9,10,9]"]
    assert column(spark, texts, "string", bk.parse_text_basket) == [[], ["1", "2"], ["3", "4"], ["9", "10", "9"]]
    assert column(spark, texts, "string", bk.parse_json_basket)[1:] == [[1, 2], [3, 4], [9, 10, 9]]


def test_normal_basket_is_numeric_and_whole(spark):
    got = column(spark, [[10, 9, 10], list(range(25, 0, -1))], "array<bigint>", bk.normal_basket)
    assert got == [[9, 10], list(range(1, 26))]


def test_rule_score_caps_lift_and_id_is_stable(spark):
    df = spark.createDataFrame([(0.5, 9.9, 0.01), (0.5, 12.0, 0.01)], "c double, l double, s double")
    got = [r[0] for r in df.select(scoring.rule_score(F.col("c"), F.col("l"), F.col("s"))).collect()]
    assert [round(g, 10) for g in got] == [round(0.3 + 0.396 + 0.0036, 10), round(0.3 + 0.4 + 0.0036, 10)]
    row = spark.createDataFrame([([9, 10], 3)], "a array<bigint>, c bigint").select(scoring.rule_id(F.col("a"), F.col("c"))).first()
    assert row[0] == hashlib.md5(b"10|9->3").hexdigest()
