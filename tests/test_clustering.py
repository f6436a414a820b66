import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stallwise.operators import clustering, kmeans, metrics, summary


def cloud(spark, n=240, seed=5):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 6, (4, 3))
    labels = rng.integers(0, 4, n)
    points = centers[labels] + rng.normal(0, 1.5, (n, 3))
    df = spark.createDataFrame(
        [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(points, labels))],
        "id long, features array<double>, cluster int",
    )
    return points, labels, df


def brute_silhouette(points, labels, power):
    difference = np.linalg.norm(points[:, None, :] - points[None, :, :], axis=2) ** power
    out = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            out.append(0.0)
            continue
        a = difference[i][mine].sum() / (mine.sum() - 1)
        b = min(difference[i][labels == c].mean() for c in set(labels) if c != own)
        out.append((b - a) / max(a, b))
    return out


@pytest.mark.parametrize("block_rows", [20, 1000])
def test_euclidean_silhouette_equals_brute_force(spark, block_rows):
    points, labels, df = cloud(spark)
    found = metrics.silhouette_euclidean(df, "id", block_rows).orderBy("id").collect()
    assert [r["sil_sample"] for r in found] == pytest.approx(brute_silhouette(points, labels, 1), abs=1e-9)


def test_squared_silhouette_equals_brute_force_and_evaluator(spark):
    points, labels, df = cloud(spark)
    found = [r["sil_sample"] for r in metrics.silhouette_squared(df).orderBy("id").collect()]
    assert found == pytest.approx(brute_silhouette(points, labels, 2), abs=1e-9)
    vectors = df.select("cluster", array_to_vector("features").alias("v"))
    score = ClusteringEvaluator(featuresCol="v", predictionCol="cluster").evaluate(vectors)
    assert np.mean(found) == pytest.approx(score, abs=1e-9)
    assert all(-1 <= s <= 1 for s in found)


def test_a_cluster_of_one_scores_zero(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 0), (3, [9.0], 1)], "id long, features array<double>, cluster int")
    for scored in (metrics.silhouette_squared(df), metrics.silhouette_euclidean(df, "id")):
        assert scored.where("id = 3").first()["sil_sample"] == 0.0


def test_davies_bouldin_and_calinski_harabasz_equal_brute_force(spark):
    points, labels, df = cloud(spark)
    ids = sorted(set(labels))
    centers = np.array([points[labels == c].mean(0) for c in ids])
    scatter = np.array([np.linalg.norm(points[labels == c] - centers[i], axis=1).mean() for i, c in enumerate(ids)])
    worst = [
        max((scatter[i] + scatter[j]) / np.linalg.norm(centers[i] - centers[j]) for j in range(len(ids)) if j != i)
        for i in range(len(ids))
    ]
    assert metrics.davies_bouldin(df).first()[0] == pytest.approx(np.mean(worst))
    sizes = np.array([(labels == c).sum() for c in ids])
    between = (sizes * ((centers - points.mean(0)) ** 2).sum(1)).sum()
    within = sum(((points[labels == c] - centers[i]) ** 2).sum() for i, c in enumerate(ids))
    expected = between * (len(points) - len(ids)) / (within * (len(ids) - 1))
    assert metrics.calinski_harabasz(df).first()[0] == pytest.approx(expected)


def test_degenerate_clusterings(spark):
    df = spark.createDataFrame([(1, [2.0], 0), (2, [2.0], 0), (3, [2.0], 1)], "id long, features array<double>, cluster int")
    assert metrics.davies_bouldin(df).first()[0] == 0.0
    assert metrics.calinski_harabasz(df).first()[0] == 1.0
    assert [r["sil_sample"] for r in metrics.silhouette_squared(df).collect()] == [0.0, 0.0, 0.0]


def test_labellings_are_scored_together_as_alone(spark):
    _, _, df = cloud(spark)
    other = df.withColumn("cluster", (F.col("id") % 3).cast("int"))
    both = df.withColumn("k", F.lit(1)).unionByName(other.withColumn("k", F.lit(2)))
    together = {r["k"]: r["s"] for r in metrics.silhouette_squared(both, ["k"]).groupBy("k").agg(F.avg("sil_sample").alias("s")).collect()}
    geometry = metrics.cluster_geometry(both, ["k"])
    bouldin = {r["k"]: r["davies_bouldin"] for r in metrics.davies_bouldin_of(geometry, ["k"]).collect()}
    for k, alone in ((1, df), (2, other)):
        assert together[k] == pytest.approx(metrics.silhouette_squared(alone).agg(F.avg("sil_sample")).first()[0])
        assert bouldin[k] == pytest.approx(metrics.davies_bouldin(alone).first()[0])


@pytest.fixture(scope="module")
def shops(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(150):
        group = 0 if i < 90 else 1 if i < 130 else 2
        rows.append((f"s{i:03d}", float(rng.normal(10 * group, 0.5)), float(rng.normal(-5 * group, 0.5)), "c", "green"))
    return spark.createDataFrame(rows, "seller_nickname string, x double, y double, main_category string, seller_reputation_main string")


def test_evaluation_has_one_row_per_k_with_metrics_in_range(shops):
    rows = clustering.evaluate_kmeans_range(shops, [2, 3, 4], ["x", "y"], n_init=2).collect()
    assert [r["k"] for r in rows] == [2, 3, 4]
    for r in rows:
        assert -1 <= r["silhouette_sq"] <= 1 and r["davies_bouldin"] >= 0 and r["calinski_harabasz"] > 0
        assert r["inertia"] > 0 and 100 / r["k"] - 1e-9 <= r["cluster_max_pct"] <= 100
    assert max(rows, key=lambda r: r["silhouette_sq"])["k"] == 3


@pytest.mark.parametrize("distance", ["squared", "euclidean"])
def test_final_fit_numbers_clusters_by_size_and_scores_others(shops, distance):
    fitted = clustering.fit_segments(shops, 3, ["x", "y"], n_init=2, distance=distance)
    sizes = [r["sellers"] for r in summary.cluster_sizes(fitted.sellers).collect()]
    assert sizes == [90, 40, 20]
    assert fitted.sellers.columns == [*shops.columns, "cluster", "sil_sample"]
    assert fitted.metrics.first()[clustering.silhouette_name(distance)] > 0.8
    again = clustering.score_sellers(fitted, shops)
    same = again.join(fitted.sellers.select("seller_nickname", F.col("cluster").alias("c")), "seller_nickname")
    assert same.where("cluster <> c").count() == 0


def test_summary_and_profile_of_clusters(spark):
    rows = [("a", 0, "x", None, 1.0, 0.5), ("b", 0, "y", None, 3.0, -0.5), ("c", 1, None, None, 5.0, 0.1)]
    df = spark.createDataFrame(
        rows, "seller_nickname string, cluster int, main_category string, seller_reputation_main string, median_price double, sil_sample double"
    )
    found = [r.asDict() for r in summary.cluster_summary(df, ["median_price"]).collect()]
    assert [(r["cluster"], r["sellers"], r["main_category"], r["reputation"], r["avg_median_price"]) for r in found] == [
        (0, 2, "x", None, 2.0), (1, 1, None, None, 5.0),
    ]
    assert sum(r["seller_share_pct"] for r in found) == pytest.approx(100)
    profile = {r["cluster"]: r.asDict() for r in summary.cluster_profile(df).collect()}
    assert profile[0]["sil"] == 0.0 and profile[1]["pct"] == pytest.approx(100 / 3)
    placed = {r["cluster"]: r["pct_well_placed"] for r in summary.silhouette_by_cluster(df).collect()}
    assert placed == {0: 50.0, 1: 100.0}
    unscored = summary.silhouette_by_cluster(df.drop("sil_sample")).collect()
    assert all(r["sil_mean"] == 0.0 and r["pct_well_placed"] == 0.0 for r in unscored)
    assert summary.mean_cluster_silhouette(df).first()[0] == pytest.approx(0.05)


def test_principal_components_are_uncorrelated(spark):
    rng = np.random.default_rng(1)
    rows = [(f"s{i}", float(a), float(a + b), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (200, 2)))]
    df = spark.createDataFrame(rows, "seller_nickname string, x double, y double, z double")
    found = clustering.pca_features(df, ["x", "y", "z"]).agg(F.corr("pc1", "pc2")).first()[0]
    assert found == pytest.approx(0, abs=1e-9)


def lloyd(points, centers, tolerance=1e-4, max_iter=300):
    """Plain k-means from given centers: (centers, steps, cost)."""
    for step in range(1, max_iter + 1):
        near = ((points[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        new = np.array([points[near == i].mean(0) if (near == i).any() else c for i, c in enumerate(centers)])
        moved, centers = ((new - centers) ** 2).sum(1) > tolerance**2, new
        if not moved.any():
            break
    return centers, step, ((points[:, None] - centers[None]) ** 2).sum(2).min(1).sum()


def test_all_fits_together_equal_plain_ones(spark):
    points, _, df = cloud(spark)
    chosen, weights = kmeans.candidates(df.select("features"), 7)
    assert weights.sum() == len(points) and len(chosen) <= 2 * kmeans.ROUNDS * kmeans.PER_ROUND
    moving = []
    fits = kmeans.fit_all(df.repartition(5), [2, 4, 5], seed=7, n_init=4, watch=moving.append)
    longest = 0
    for k, fit in fits.items():
        plain = [lloyd(points, kmeans.start(chosen, weights, k, 7 + a)) for a in range(4)]
        longest = max(longest, *[p[1] for p in plain])
        best = min(range(4), key=lambda a: (round(plain[a][2], 6), a))
        assert fit.inertia == pytest.approx(plain[best][2]) and fit.steps == plain[best][1]
        assert np.array(fit.centers) == pytest.approx(plain[best][0])
        near = {r["id"]: r["c"] for r in df.select("id", fit.nearest(F.col("features")).alias("c")).collect()}
        distances = ((points[:, None] - np.array(fit.centers)[None]) ** 2).sum(2)
        assert [near[i] for i in range(len(points))] == distances.argmin(1).tolist()
    # One scan a step for all fits, as many as the slowest of them needs.
    assert len(moving) == longest and moving[0] == 12


def test_candidates_do_not_depend_on_partitions(spark):
    _, _, df = cloud(spark)
    one, _ = kmeans.candidates(df.select("features").coalesce(1), 3)
    many, _ = kmeans.candidates(df.select("features").repartition(7), 3)
    assert one.tolist() == many.tolist()


def test_fewer_different_points_than_centers(spark):
    df = spark.createDataFrame([([1.0, 2.0],)] * 5 + [([3.0, 2.0],)] * 2, "features array<double>")
    fit = kmeans.fit_all(df, [4], n_init=2)[4]
    assert sorted(fit.centers) == [[1.0, 2.0], [3.0, 2.0]] and fit.inertia == 0.0
    assert len(kmeans.fit_all(df.where("features[0] = 1"), [1], n_init=1)[1].centers) == 1
    with pytest.raises(ValueError):
        kmeans.fit_all(df.where("false"), [2])


def test_fits_that_run_out_of_steps_are_reported(spark):
    _, _, df = cloud(spark)
    with pytest.warns(UserWarning, match="not converged"):
        kmeans.fit_all(df, [6], n_init=1, max_iter=1)


def test_nearest_centers_of_many_fits():
    """A row per center; ties go to a fit's first center, and values that are no numbers do not stop it."""
    rng = np.random.default_rng(1)
    points = rng.integers(0, 3, (500, 2)).astype(float)
    fits = [rng.integers(0, 3, (k, 2)).astype(float) for k in (1, 2, 5, 5)]
    bounds = np.cumsum([0, *[len(f) for f in fits]])
    hit, costs = kmeans._nearest(points, np.concatenate(fits), bounds)
    for fit, a, b, cost in zip(fits, bounds, bounds[1:], costs):
        distance = ((points[:, None, :] - fit[None]) ** 2).sum(2)
        assert (hit[a:b].argmax(0) == distance.argmin(1)).all() and (hit[a:b].sum(0) == 1).all()
        assert cost == pytest.approx(distance.min(1).sum())
    hit, _ = kmeans._nearest(np.array([[np.nan, 1.0]]), fits[2], np.array([0, 5]))
    assert hit.T.tolist() == [[1.0, 0.0, 0.0, 0.0, 0.0]]


def test_robust_scaler_searches_once(spark, monkeypatch):
    """Quartiles are those of the filled values; only features with nulls are searched a second time."""
    from stallwise.operators import scaling

    rows = [(float(i * i % 37), None if i % 4 == 0 else float(i % 11), float("nan") if i == 3 else float(i)) for i in range(41)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    searched, search = [], scaling.column_quantiles
    monkeypatch.setattr(scaling, "column_quantiles", lambda d, columns, probs: searched.append(list(columns)) or search(d, columns, probs))
    fitted = scaling.fit_scaler(df, ["a", "b", "c"])
    assert searched == [["a", "b", "c"], ["b"]]
    for i, name in enumerate("abc"):
        known = np.array([r[i] for r in rows if r[i] is not None and not np.isnan(r[i])])
        filled = np.concatenate([known, np.full(sum(r[i] is None for r in rows), np.median(known))])
        assert fitted.fill[name] == np.median(known) and fitted.center[name] == np.median(filled)
        assert fitted.scale[name] == pytest.approx(np.quantile(filled, 0.75) - np.quantile(filled, 0.25))
