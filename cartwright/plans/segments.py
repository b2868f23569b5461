"""Lifecycle rules, vectorizers, K-Means, assignment and cluster summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.config import BEHAVIOR_FEATURES, LOG_FEATURES
from cartwright.functions import labels
from cartwright.functions.scoring import from_units, round_half_up, to_units
from cartwright.lineage import stage
from cartwright.operators.quantiles import exact_quantiles, quantile_struct, unpivot
from cartwright.operators.ranking import top_n
from cartwright.plans.prep import attach_optional, require_columns

# Name -> (feature, probability) of the lifecycle thresholds.
LIFECYCLE_THRESHOLDS = {
    "orders_q40": ("total_orders", 0.4),
    "orders_q70": ("total_orders", 0.7),
    "orders_q90": ("total_orders", 0.9),
    "days_q50": ("active_days", 0.5),
    "days_q80": ("active_days", 0.8),
    "span_q70": ("active_span", 0.7),
}


# ---- lifecycle ------------------------------------------------------------------------


def lifecycle_thresholds(features: DataFrame) -> DataFrame:
    """(feature, q, quantile) for the thresholds of the lifecycle rules."""
    wanted = set(LIFECYCLE_THRESHOLDS.values())
    columns = sorted({c for c, _ in wanted})
    table = exact_quantiles(unpivot(features, columns), sorted({p for _, p in wanted}))
    used = F.lit(False)
    for c, p in sorted(wanted):
        used = used | ((F.col("feature") == c) & (F.col("q") == p))
    return table.where(used)


def lifecycle_stage(features: DataFrame, thresholds: Column | None = None) -> DataFrame:
    """vip, loyal, regular or new by the quantiles of all users (or given thresholds)."""
    require_columns(features, ["user_id", "total_orders", "active_days", "active_span"])
    cuts = thresholds if thresholds is not None else quantile_struct(features, LIFECYCLE_THRESHOLDS)
    t = F.col("_cuts")
    orders, days, span = F.col("total_orders"), F.col("active_days"), F.col("active_span")
    label = (
        F.when((orders >= t["orders_q90"]) & (span >= t["span_q70"]), "vip")
        .when((orders >= t["orders_q70"]) & (days >= t["days_q80"]), "loyal")
        .when(orders >= t["orders_q40"], "regular")
        .otherwise("new")
    )
    return features.withColumn("_cuts", cuts).select("user_id", label.alias("lifecycle_stage"))


def frequencies(df: DataFrame, column: str, name: str = "num_users") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def user_segments(
    users: DataFrame,
    behavior: DataFrame | None,
    preference: DataFrame | None,
    lifecycle: DataFrame | None,
    defaults: dict,
) -> DataFrame:
    """(user_id, behavior_cluster, preference_cluster, lifecycle_stage) with stage defaults.

    Assignment tables may name their label ``cluster``.
    """
    out = users.select("user_id")
    named = (("behavior_cluster", behavior), ("preference_cluster", preference), ("lifecycle_stage", lifecycle))
    for column, table in named:
        if table is not None and column not in table.columns:
            table = table.withColumnRenamed("cluster", column)
        out = attach_optional(out, table, column, defaults[column])
    return out


# ---- vectorizers ----------------------------------------------------------------------


def behavior_bounds(features: DataFrame, columns: Sequence[str] = BEHAVIOR_FEATURES) -> DataFrame:
    """The fit-time model of the behavior vectorizer: one row per feature, written once.

    Clip bounds are the 1 % and 99 % quantiles; mean and population deviation are those of the
    clipped (and, for counts, logged) values.
    """
    long = unpivot(features, columns)
    clip = exact_quantiles(long, [0.01, 0.99]).groupBy("feature").agg(
        F.max(F.when(F.col("q") == 0.01, F.col("quantile"))).alias("low"),
        F.max(F.when(F.col("q") == 0.99, F.col("quantile"))).alias("high"),
    )
    # One row per feature name, so the hint is safe.
    clipped = long.join(F.broadcast(clip), "feature").withColumn("x", _clip_log())
    moments = clipped.groupBy("feature").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    return stage(clip.join(moments, "feature"), "behavior-model")


def _clip_log() -> Column:
    x = F.least(F.greatest(F.col("value"), F.col("low")), F.col("high"))
    return F.when(F.col("feature").isin(*LOG_FEATURES), F.log1p(x)).otherwise(x)


def behavior_vectorize(
    features: DataFrame, model: DataFrame, columns: Sequence[str] = BEHAVIOR_FEATURES
) -> DataFrame:
    """user_id and the z-scored columns, with the bounds and moments of ``model``."""
    stats = model.agg(
        *[
            F.max(F.when(F.col("feature") == c, F.struct("low", "high", "mean", "std"))).alias(c)
            for c in columns
        ]
    ).select(F.struct(*columns).alias("m")).scalar()
    out = []
    for c in columns:
        m = F.col("_m")[c]
        x = F.least(F.greatest(F.col(c).cast("double"), m["low"]), m["high"])
        x = F.log1p(x) if c in LOG_FEATURES else x
        # A constant feature is centred only.
        spread = F.when(m["std"] == 0, F.lit(1.0)).otherwise(m["std"])
        out.append(((x - m["mean"]) / spread).alias(c))
    return features.withColumn("_m", stats).select("user_id", *out)


def department_names(departments: DataFrame) -> list[str]:
    """The names of the department dimension, in order: the columns of a pivot."""
    return [r[0] for r in departments.select("department").where("department is not null").distinct().orderBy("department").collect()]


def preference_pivot(preference: DataFrame, departments: Sequence[str]) -> DataFrame:
    """One row per user, one column per department, mean score, 0 where there is none."""
    wide = preference.groupBy("user_id").pivot("department", list(departments)).agg(F.avg("preference_score"))
    return wide.fillna(0.0, subset=list(departments))


def l1_normalize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    norm = F.lit(0.0)
    for c in columns:
        norm = norm + F.abs(F.col(c))
    return df.withColumn("_norm", norm).select(
        *[c for c in df.columns if c not in columns],
        *[F.when(F.col("_norm") == 0, F.col(c)).otherwise(F.col(c) / F.col("_norm")).alias(c) for c in columns],
    )


# ---- K-Means --------------------------------------------------------------------------


def as_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def fit_kmeans(vectors: DataFrame, k: int = 5, seed: int = 42, restarts: int = 10) -> KMeansModel:
    """The best of several seeded fits by training cost."""
    vectors = vectors.select("features").persist()
    try:
        fits = [KMeans(k=k, seed=seed + i).fit(vectors) for i in range(restarts)]
        return min(fits, key=lambda m: m.summary.trainingCost)
    finally:
        vectors.unpersist()


def centroid_column(centroids: DataFrame, columns: Sequence[str]) -> Column:
    """The k centroids (cluster, columns...) as one array of (cluster, point)."""
    point = F.array(*[F.col(c).cast("double") for c in columns])
    row = F.struct(F.col("cluster").cast("int").alias("cluster"), point.alias("point"))
    return centroids.agg(F.array_sort(F.collect_list(row)).alias("c")).scalar()


def model_centroids(model: KMeansModel) -> Column:
    rows = [
        F.struct(F.lit(i).alias("cluster"), F.array(*[F.lit(float(v)) for v in center]).alias("point"))
        for i, center in enumerate(model.clusterCenters())
    ]
    return F.array(*rows)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d)


def assign_cluster(
    df: DataFrame,
    columns: Sequence[str],
    centroids: Column,
    cold: Column | None = None,
    default_cluster: int = 0,
) -> DataFrame:
    """Nearest centroid per row (the lowest id on a tie); cold rows get the default cluster."""
    point = F.array(*[F.col(c).cast("double") for c in columns])
    ranked = F.array_min(
        F.transform("_c", lambda c: F.struct(squared_distance(c["point"], F.col("_p")).alias("d"), c["cluster"].alias("k")))
    )
    label = ranked["k"]
    if cold is not None:
        label = F.when(cold, F.lit(default_cluster)).otherwise(label)
    return df.withColumns({"_p": point, "_c": centroids}).withColumn("cluster", label).drop("_p", "_c")


def is_cold() -> Column:
    return (F.col("total_products") == 0) & (F.col("unique_products") == 0)


# ---- summaries and quality ------------------------------------------------------------


def cluster_summary(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Rounded means and user counts per cluster."""
    means = [round_half_up(F.avg(c), digits).alias(c) for c in columns]
    return df.groupBy("cluster").agg(*means, F.count(F.lit(1)).alias("num_users"))


def scale_summary(summary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min-max scale the columns over the clusters; a constant column becomes 0."""
    # The summary has one row per cluster; its ends come from a scalar subquery.
    ends = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns]
    both = summary.agg(*ends).select(F.struct(*columns).alias("e")).scalar()
    e = F.col("_e")
    scaled = [
        F.when(e[c]["hi"] == e[c]["lo"], F.lit(0.0))
        .otherwise((F.col(c) - e[c]["lo"]) / (e[c]["hi"] - e[c]["lo"]))
        .alias(c)
        for c in columns
    ]
    return summary.withColumn("_e", both).select("cluster", *scaled)


def label_behavior(summary: DataFrame) -> DataFrame:
    """Name each behavior cluster from its mean orders and reorder ratio."""
    n, r = F.col("total_orders"), F.col("reorder_ratio")

    def text(i: int) -> Column:
        return (
            F.when((n < 7) & (r < 0.3), labels.OCCASIONAL[i])
            .when((n > 35) & (r > 0.7), labels.LOYAL[i])
            .when((n > 15) & (r > 0.4), labels.CORE[i])
            .when((n >= 7) & (r < 0.4), labels.ORDINARY[i])
            .otherwise(labels.POTENTIAL[i])
        )

    return summary.withColumns({"main_trait": text(0), "description": text(1)})


def label_preference(scores: DataFrame, top: int = 3) -> DataFrame:
    """The leading departments of each preference cluster as text.

    ``scores`` is (cluster, department, score), one row per pair.
    """
    best = top_n(scores, ["cluster"], [F.col("score").desc(), F.col("department")], top)
    names = F.array_sort(F.collect_list(F.struct("rank", "department")))["department"]
    return best.groupBy("cluster").agg(F.array_join(names, ", ").alias("top_categories"))


def behavior_department_score(
    lines: DataFrame, products: DataFrame, assignments: DataFrame, orders: DataFrame | None = None
) -> DataFrame:
    """Share of each department within the purchases of a behavior cluster."""
    bought = lines if "user_id" in lines.columns else lines.join(orders.select("order_id", "user_id"), "order_id")
    counts = (
        bought.select("user_id", "product_id")
        .join(assignments.select("user_id", "cluster"), "user_id")
        .groupBy("cluster", "product_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .join(products.select("product_id", "department_id"), "product_id")
        .groupBy("cluster", "department_id")
        .agg(F.sum("cnt").alias("cnt"))
    )
    total = F.sum("cnt").over(Window.partitionBy("cluster"))
    return counts.select("cluster", "department_id", (F.col("cnt") / total).alias("score"))


def preference_department_score(preference: DataFrame, assignments: DataFrame) -> DataFrame:
    """Mean preference score by cluster and department, the same in every run."""
    mean = from_units(F.sum(to_units(F.col("preference_score")))) / F.count(F.lit(1))
    return (
        preference.join(assignments.select("user_id", "cluster"), "user_id")
        .groupBy("cluster", "department")
        .agg(mean.alias("score"))
    )


def cluster_quality(df: DataFrame, columns: Sequence[str], assigned: str = "cluster") -> DataFrame:
    """inertia, squared silhouette, Calinski-Harabasz and Davies-Bouldin in linear time.

    All of them follow from per-cluster counts, means and sums of squares, which are k rows;
    the k x k comparisons are made inside one array. The silhouette is the squared Euclidean
    form: its mean distance to a cluster is |x|^2 - 2 x.m + mean|y|^2.
    """
    point = F.array(*[F.col(c).cast("double") for c in columns])
    rows = df.select(F.col(assigned).cast("int").alias("k"), point.alias("p"))
    norm = F.aggregate("p", F.lit(0.0), lambda s, x: s + x * x)
    means = [F.avg(F.col("p")[i]).alias(f"m{i}") for i in range(len(columns))]
    per = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.avg(norm).alias("sq"), *means)
    center = F.array(*[F.col(f"m{i}") for i in range(len(columns))])
    cell = F.struct("k", "n", "sq", center.alias("m"))
    clusters = per.agg(F.array_sort(F.collect_list(cell)).alias("c"))
    cs = clusters.scalar()

    rows = rows.withColumn("_cs", cs)
    own = F.filter("_cs", lambda c: c["k"] == F.col("k"))[0]
    d2 = squared_distance(F.col("p"), F.col("own.m"))
    to = lambda c: F.col("x2") - 2 * F.aggregate(
        F.zip_with(F.col("p"), c["m"], lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v
    ) + c["sq"]
    others = F.array_min(F.transform(F.filter("_cs", lambda c: c["k"] != F.col("k")), to))
    n = F.col("own.n")
    a = F.when(n > 1, to(F.col("own")) * n / (n - 1))
    scored = rows.withColumn("own", own).withColumn("x2", norm).select(
        "k", d2.alias("d2"), F.sqrt(d2).alias("d"), a.alias("a"), others.alias("b")
    )
    sil = F.when(F.col("a").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    by_cluster = scored.groupBy("k").agg(
        F.sum("d2").alias("ss"), F.avg("d").alias("s"), F.sum(sil).alias("sil"), F.count(F.lit(1)).alias("n")
    )
    # k rows are left.
    folded = by_cluster.agg(
        F.sum("ss").alias("inertia"),
        F.sum("n").alias("total"),
        F.sum("sil").alias("sil"),
        F.count(F.lit(1)).alias("k"),
        F.array_sort(F.collect_list(F.struct("k", "s"))).alias("spread"),
    ).withColumn("c", cs)
    mean_all = F.transform(
        F.sequence(F.lit(0), F.lit(len(columns) - 1)),
        lambda i: F.aggregate("c", F.lit(0.0), lambda s, c: s + c["n"] * F.get(c["m"], i)) / F.col("total"),
    )
    between = F.aggregate(
        "c", F.lit(0.0), lambda s, c: s + c["n"] * squared_distance(c["m"], F.col("mean_all"))
    )
    both = F.zip_with("c", "spread", lambda c, s: F.struct(c["k"].alias("k"), c["m"].alias("m"), s["s"].alias("s")))
    worst = F.transform(
        "cells",
        lambda i: F.array_max(
            F.transform(
                F.filter("cells", lambda j: j["k"] != i["k"]),
                lambda j: (i["s"] + j["s"]) / F.sqrt(squared_distance(i["m"], j["m"])),
            )
        ),
    )
    ready = folded.withColumn("mean_all", mean_all).withColumn("cells", both)
    return ready.select(
        F.col("k").cast("bigint").alias("k"),
        "inertia",
        (F.col("sil") / F.col("total")).alias("silhouette"),
        ((between / (F.col("k") - 1)) / (F.col("inertia") / (F.col("total") - F.col("k")))).alias("calinski_harabasz"),
        (F.aggregate(worst, F.lit(0.0), lambda s, x: s + x) / F.col("k")).alias("davies_bouldin"),
    )


def find_k(vectors: DataFrame, columns: Sequence[str], ks: Sequence[int], seed: int = 42, restarts: int = 3) -> DataFrame:
    """The four quality measures for each k: one distributed fit per k, not per row."""
    out = None
    for k in ks:
        model = fit_kmeans(vectors, k, seed, restarts)
        labelled = assign_cluster(vectors, columns, model_centroids(model))
        row = cluster_quality(labelled, columns)
        out = row if out is None else out.unionByName(row)
    return out


def select_k(metrics: DataFrame, min_k: int = 3, window: int = 2, tolerance: float = 0.92) -> DataFrame:
    """Elbow at the largest change of inertia, then the largest k of near-best silhouette.

    ``metrics`` has one row per tried k and is written once, as three steps read it.
    """
    metrics = stage(metrics, "k-metrics")
    step = Window.partitionBy(F.lit(0)).orderBy("k")
    delta = F.abs(F.col("inertia") - F.lag("inertia").over(step))
    steps = metrics.where(F.col("k") >= min_k).withColumn("delta_inertia", delta)
    # Of equal changes the smallest k is the elbow.
    elbow = steps.where(F.col("delta_inertia").isNotNull()).agg(
        F.max_by("k", F.struct("delta_inertia", -F.col("k"))).alias("e")
    ).scalar()
    near = steps.where((F.col("k") >= elbow) & (F.col("k") <= elbow + window))
    best = near.agg(F.max("silhouette").alias("s")).scalar()
    chosen = near.where(F.col("silhouette") >= best * tolerance)
    return chosen.agg(F.max("k").alias("k")).select(elbow.alias("elbow_k"), F.col("k").alias("selected_k"))


def cluster_pca(vectors: DataFrame, k: int = 2) -> tuple[DataFrame, DataFrame]:
    """(rows with pc1, pc2; centroids per cluster with the explained variance)."""
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(vectors)
    share = [float(v) for v in model.explainedVariance]
    pc = vector_to_array(F.col("pc"))
    points = model.transform(vectors).select("cluster", pc[0].alias("pc1"), pc[1].alias("pc2"))
    centers = points.groupBy("cluster").agg(F.avg("pc1").alias("pc1"), F.avg("pc2").alias("pc2"))
    return points, centers.withColumns({"variance_pc1": F.lit(share[0]), "variance_pc2": F.lit(share[1])})
