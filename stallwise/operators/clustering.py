"""Segmenting sellers with k-means."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise import schema as S
from stallwise.operators.kmeans import Centers, fit_all
from stallwise.operators.metrics import (
    calinski_harabasz_of,
    cluster_geometry,
    cluster_max_pct,
    davies_bouldin_of,
    silhouette_euclidean,
    silhouette_squared,
)
from stallwise.operators.scaling import FittedScaler, fit_fills, fit_scaler, model_features, with_points
from stallwise.operators.summary import canonical_clusters
from stallwise.sources.staging import stage


@dataclass(frozen=True)
class Segmentation:
    """A fitted segmentation and its result."""

    sellers: DataFrame
    metrics: DataFrame
    scaler: FittedScaler
    model: Centers
    clusters: DataFrame
    features: list[str]


def staged_points(
    sellers: DataFrame, features: Sequence[str], scaler: str, keep: Sequence[str] = (S.SELLER,)
) -> tuple[DataFrame, FittedScaler]:
    """(staged points, fitted scaler); points are sorted by seller within hash partitions."""
    fitted = fit_scaler(sellers, features, scaler)
    points = with_points(sellers, fitted).select(*keep, "features")
    return stage(points.repartition(S.SELLER).sortWithinPartitions(S.SELLER), "points"), fitted


def silhouette_name(distance: str) -> str:
    """Column name of a mean silhouette: the plain name is the Euclidean one."""
    return {"euclidean": "silhouette", "squared": "silhouette_sq"}[distance]


def labels(model: Centers, points: DataFrame, name: str = "cluster") -> DataFrame:
    """Add the number of the nearest center to every point."""
    return points.withColumn(name, model.nearest(F.col("features")))


def evaluate_kmeans_range(
    sellers: DataFrame,
    k_values: Iterable[int] = range(2, 9),
    features: Sequence[str] | None = None,
    scaler: str = "robust",
    seed: int = 42,
    n_init: int = 20,
    distance: str = "squared",
) -> DataFrame:
    """One row per k: inertia, silhouette, Davies-Bouldin, Calinski-Harabasz, largest share.

    All k are fitted together and scored together. ``distance`` selects the silhouette:
    ``squared`` (column ``silhouette_sq``) grows linearly with the sellers, ``euclidean``
    (column ``silhouette``) quadratically.
    """
    selected = model_features(sellers, features)
    points, _ = staged_points(sellers, selected, scaler)
    models = fit_all(points, k_values, seed, n_init)
    labelled = points
    for k, model in models.items():
        labelled = labels(model, labelled, f"_k{k}")
    runs = F.array(*[F.struct(F.lit(k).cast("int").alias("k"), F.col(f"_k{k}").alias("cluster")) for k in models])
    # Scored several times below: written once, with the labels of every k beside the point.
    labelled = stage(labelled.select(S.SELLER, "features", runs.alias("runs")), "labels")
    runs_of = labelled.select(S.SELLER, "features", F.inline("runs"))

    geometry = stage(cluster_geometry(runs_of, ["k"]), "geometry")
    inertia = points.sparkSession.createDataFrame(
        [(k, m.inertia) for k, m in models.items()], "k int, inertia double"
    )
    if distance == "euclidean":
        parts = [silhouette_euclidean(runs_of.where(F.col("k") == k), S.SELLER) for k in models]
        scored = parts[0]
        for part in parts[1:]:
            scored = scored.unionByName(part)
    else:
        scored = silhouette_squared(runs_of, ["k"])
    return (
        inertia.join(scored.groupBy("k").agg(F.avg("sil_sample").alias(silhouette_name(distance))), "k")
        .join(davies_bouldin_of(geometry, ["k"]), "k")
        .join(calinski_harabasz_of(geometry, ["k"]), "k")
        .join(cluster_max_pct(runs_of, ["k"]), "k")
        .select("k", "inertia", silhouette_name(distance), "davies_bouldin", "calinski_harabasz", "cluster_max_pct")
        .orderBy("k")
    )


def scaler_comparison(sellers: DataFrame, k: int = 5, seed: int = 42, n_init: int = 20) -> DataFrame:
    """The quality of one k under each scaler, labelled by scaler."""
    compared = [
        evaluate_kmeans_range(sellers, [k], scaler=name, seed=seed, n_init=n_init).withColumn("scaler", F.lit(name))
        for name in ("standard", "robust")
    ]
    return compared[0].unionByName(compared[1]).select(
        "scaler", silhouette_name("squared"), "davies_bouldin", "calinski_harabasz", "cluster_max_pct"
    )


def _metrics(scored: DataFrame, distance: str) -> DataFrame:
    geometry = stage(cluster_geometry(scored), "geometry")
    return scored.agg(F.avg("sil_sample").alias(silhouette_name(distance))).select(
        silhouette_name(distance),
        davies_bouldin_of(geometry).scalar().alias("davies_bouldin"),
        calinski_harabasz_of(geometry).scalar().alias("calinski_harabasz"),
    )


def fit_segments(
    sellers: DataFrame,
    k: int = 5,
    features: Sequence[str] | None = None,
    scaler: str = "robust",
    seed: int = 42,
    n_init: int = 20,
    distance: str = "squared",
) -> Segmentation:
    """Final k-means: sellers with ``cluster`` and ``sil_sample``, metrics, and what scoring needs.

    Clusters are numbered from the largest down, so the same segments get the
    same numbers whatever the seed.
    """
    selected = model_features(sellers, features)
    points, fitted = staged_points(sellers, selected, scaler, sellers.columns)
    model = fit_all(points, [k], seed, n_init)[k]
    labelled = labels(model, points, "_raw_cluster")
    clusters = stage(canonical_clusters(labelled, "_raw_cluster", selected[0]), "clusters")
    labelled = renumbered(labelled, clusters)
    scored = silhouette_euclidean(labelled, S.SELLER) if distance == "euclidean" else silhouette_squared(labelled)
    scored = stage(scored, "segments")
    return Segmentation(scored.drop("features"), _metrics(scored, distance), fitted, model, clusters, selected)


def renumbered(labelled: DataFrame, clusters: DataFrame) -> DataFrame:
    """Replace the model's cluster ids by the canonical ones (at most k rows)."""
    return labelled.join(F.broadcast(clusters), "_raw_cluster").drop("_raw_cluster")


def score_sellers(fitted: Segmentation, sellers: DataFrame) -> DataFrame:
    """Assign other sellers to the clusters of a fitted segmentation."""
    points = with_points(sellers, fitted.scaler)
    return renumbered(labels(fitted.model, points, "_raw_cluster"), fitted.clusters).drop("features")


def pca_features(sellers: DataFrame, columns: Sequence[str], components: int = 2) -> DataFrame:
    """Principal components of (correlated) columns, as ``pc1`` ..., for every row.

    Missing values are filled with the column's median. The sign of a component is
    that of its largest loading. The fit holds one small matrix of columns by columns.
    """
    fills = fit_fills(sellers, columns)
    filled = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(fills[c])) for c in columns])
    vectors = sellers.withColumn("vector", array_to_vector(filled))
    model = PCA(k=components, inputCol="vector", outputCol="components").fit(vectors)
    parts = vector_to_array("components")
    found = model.transform(vectors)
    loadings = model.pc.toArray()
    sign = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(components)]
    return found.withColumns({f"pc{i + 1}": parts[i] * sign[i] for i in range(components)}).drop("vector", "components")
