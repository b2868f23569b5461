import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwright.plans import analysis, evaluate as E
from cartwright.plans import segments

RECS = "user_id int, rank int, item_id int"
TRUTH = "user_id int, product_id int"


def test_user_metrics(spark):
    recs = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (1, 3, 7), (2, 1, 5), (2, 2, 5), (3, 1, 9)], RECS)
    truth = spark.createDataFrame([(1, 6), (1, 7), (1, 8), (2, 5)], TRUTH)
    got = {r.user_id: r for r in E.user_metrics(recs, truth, 2).collect()}
    assert (got[1].hits, got[1].precision, got[1].recall) == (1, 0.5, pytest.approx(1 / 3))
    assert got[1].f1 == pytest.approx(0.4) and got[1].hit_rate == 1.0
    # A repeated recommendation counts once; a user without truth has recall 0.
    assert (got[2].precision, got[2].recall) == (0.5, 1.0)
    assert (got[3].precision, got[3].recall, got[3].f1, got[3].hit_rate) == (0.0, 0.0, 0.0, 0.0)
    assert {r.precision for r in E.user_metrics(recs, truth, 0).collect()} == {0.0}


def test_coverage_and_sources(spark):
    users = spark.createDataFrame([(1,), (2,), (4,), (5,)], "user_id int")
    recs = spark.createDataFrame([(1, 1, 5), (2, 1, 6)], RECS)
    catalog = spark.createDataFrame([(i,) for i in range(8)], "product_id int")
    assert tuple(E.coverage(users, recs, catalog).first()) == (0.5, 0.25)
    meta = spark.createDataFrame(
        [(1, 5, False), (2, 2, True), (3, 0, True), (4, 0, True)], "request_id int, rule_candidates int, fallback_used boolean"
    )
    got = {r.source: r for r in E.source_mix(E.request_source(meta)).collect()}
    assert got["fallback"].share == 0.5 and got["rules"].rule_hit_rate == 0.5


def test_first_users_and_stability(spark):
    metrics = spark.createDataFrame(
        [(i, i / 10, 0.5, 0.5, 1.0) for i in range(1, 5)], "user_id int, precision double, recall double, f1 double, hit_rate double"
    )
    first = E.summarize(metrics, E.evaluation_users(metrics, 2)).first()
    assert first.num_users_evaluated == 2 and first.precision == pytest.approx(0.15)
    runs = E.summarize(metrics, E.evaluation_users(metrics, 2)).unionByName(E.summarize(metrics))
    got = {r.num_users_evaluated: r for r in E.metric_stability(runs).collect()}
    assert got[2].precision_change is None and got[4].precision_change == pytest.approx(0.25 / 0.15 - 1)
    assert got[4].is_final and not got[2].is_final


def test_quality_matches_definitions(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 1, size=(40, 2)) for c in (0, 4, 9)])
    k = np.repeat([0, 1, 2], 40)
    df = spark.createDataFrame([(int(c), float(a), float(b)) for c, (a, b) in zip(k, x)], "cluster int, a double, b double")
    got = segments.cluster_quality(df, ["a", "b"]).first()
    m = np.array([x[k == c].mean(0) for c in range(3)])
    within = ((x - m[k]) ** 2).sum()
    between = 40 * ((m - x.mean(0)) ** 2).sum()
    assert got.inertia == pytest.approx(within)
    assert got.calinski_harabasz == pytest.approx((between / 2) / (within / 117))
    s = np.array([np.sqrt(((x[k == c] - m[c]) ** 2).sum(1)).mean() for c in range(3)])
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(-1))
    worst = [max((s[i] + s[j]) / d[i, j] for j in range(3) if j != i) for i in range(3)]
    assert got.davies_bouldin == pytest.approx(np.mean(worst))
    sq = ((x[:, None] - x[None]) ** 2).sum(-1)
    sil = []
    for i in range(120):
        a = sq[i, k == k[i]].sum() / 39
        b = min(sq[i, k == c].mean() for c in range(3) if c != k[i])
        sil.append((b - a) / max(a, b))
    assert got.silhouette == pytest.approx(np.mean(sil))


def test_select_k(spark):
    rows = [(2, 100.0, 0.5), (3, 90.0, 0.4), (4, 50.0, 0.50), (5, 45.0, 0.47), (6, 42.0, 0.465), (7, 41.0, 0.9)]
    df = spark.createDataFrame(rows, "k long, inertia double, silhouette double")
    assert tuple(segments.select_k(df).first()) == (4, 6)


def test_kmeans_finds_separate_groups(spark):
    df = spark.range(300).select(F.col("id"), (F.col("id") % 3 * 10.0).alias("a"), (F.rand(1) * 0.1).alias("b"))
    vectors = segments.as_vectors(df, ["a", "b"])
    model = segments.fit_kmeans(vectors, 3, 42, 3)
    labelled = segments.assign_cluster(vectors, ["a", "b"], segments.model_centroids(model))
    groups = labelled.groupBy("a").agg(F.countDistinct("cluster").alias("c"), F.first("cluster").alias("k")).collect()
    assert [g.c for g in groups] == [1, 1, 1] and len({g.k for g in groups}) == 3
    points, centers = segments.cluster_pca(labelled)
    assert points.count() == 300 and centers.first().variance_pc1 > 0.99


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (10.0,), (None,)], "x double")
    got = {r.bin: (r.low, r.high, r.count_) for r in analysis.histogram(df, "x", 5).withColumnRenamed("count", "count_").collect()}
    assert got == {0: (0.0, 2.0, 2), 2: (4.0, 6.0, 1), 4: (8.0, 10.0, 1)}
    flat = analysis.histogram(df.where("x = 5"), "x", 5).collect()
    assert [(r.bin, r["count"]) for r in flat] == [(0, 1)]
    log = analysis.histogram(df, "x", 2, log=True).collect()
    assert sum(r["count"] for r in log) == 3


def test_describe_clips(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (99.0,)], "x double")
    row = analysis.describe(df, ["x"], {"x": 50.0}).first()
    assert (row["max"], row.q50, row["count"]) == (50.0, 2.0, 3)
