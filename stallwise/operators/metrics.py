"""Quality of a clustering, given points (``features`` array) and a ``cluster`` label.

Every function takes ``by``: columns that tell several labellings of the same
points apart, so that one pass scores them all. Cluster statistics are small
(clusters times dimensions) and travel as arrays; no pair of rows is formed
except by ``silhouette_euclidean``, whose definition needs all distances.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def cluster_sums(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per cluster: rows ``n``, sum of points ``s`` and sum of squared norms ``q``."""
    summary = Summarizer.metrics("count", "sum", "normL2").summary(array_to_vector(F.col("features")))
    found = points.groupBy(*by, "cluster").agg(summary.alias("_s"))
    norms = vector_to_array("_s.normL2")
    return found.select(
        *by,
        "cluster",
        F.col("_s.count").alias("n"),
        vector_to_array("_s.sum").alias("s"),
        _dot(norms, norms).alias("q"),
    )


def _with_list(points: DataFrame, clusters: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Give every row the list of its labelling's clusters, one entry per cluster."""
    fields = [c for c in clusters.columns if c not in by]
    listed = F.collect_list(F.struct(*fields)).alias(name)
    if not by:
        return points.withColumn(name, clusters.agg(listed).scalar())
    lists = clusters.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(listed)
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_by_{c}") for c in by])
    return points.join(F.broadcast(lists), same).drop(*[f"_by_{c}" for c in by])


def _coefficient(own: Column, nearest: Column, own_size: Column) -> Column:
    """(b - a) / max(a, b); zero for a cluster of one and for coinciding points."""
    larger = F.greatest(own, nearest)
    return F.when((own_size == 1) | (larger == 0), F.lit(0.0)).otherwise((nearest - own) / larger)


def silhouette_squared(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``sil_sample``, the silhouette under squared Euclidean distance.

    The mean squared distance of x to a cluster is |x - c|^2 + within / n, with its
    centroid c and its sum of squares around it: nothing cancels, far from the
    origin either. Cost grows with rows times clusters, and every row meets the
    list of all clusters of its labelling: made for a bounded number of clusters.
    """
    rows = _with_list(points, cluster_geometry(points, by), by, "_clusters")
    totals = F.transform(
        "_clusters",
        lambda c: F.struct(
            c["cluster"].alias("cluster"),
            c["n"].alias("n"),
            (c["n"] * _squared_distance(F.col("features"), c["centroid"]) + c["within"]).alias("d"),
        ),
    )
    own = F.filter("_totals", lambda t: t["cluster"] == F.col("cluster"))[0]
    others = F.filter("_totals", lambda t: t["cluster"] != F.col("cluster"))
    a = F.try_divide(own["d"], (own["n"] - 1).cast("double"))
    b = F.array_min(F.transform(others, lambda t: t["d"] / t["n"]))
    return rows.withColumn("_totals", totals).withColumn("sil_sample", _coefficient(a, b, own["n"])).drop("_clusters", "_totals")


# Rows of a block, blocks made of fewer rows for the sake of more tasks, and distances of a task held at once.
BLOCK_ROWS, SPREAD_BLOCKS, SMALL_BLOCK = 32_768, 6, 2000
HELD_DISTANCES = 4_000_000


def _blocks(rows: int) -> int:
    """As few blocks as fit tasks, for every row goes to all of them; small tables get some more."""
    return max(1, -(-rows // BLOCK_ROWS), min(SPREAD_BLOCKS, -(-rows // SMALL_BLOCK)))


def silhouette_euclidean(points: DataFrame, id_column: str, block_rows: int | None = None) -> DataFrame:
    """Add ``sil_sample``, the silhouette under Euclidean distance.

    The definition needs the distance of every row to every other, so cost grows
    with the square of the rows: use ``silhouette_squared`` for large tables.
    Rows are hashed into blocks, of about ``block_rows`` if given. Each pair of blocks is
    one task that yields distance sums per row and cluster from a strip of distances
    at a time; no distance leaves its task, and memory stays the same for any number of rows.
    Rows move once per block: in proportion to the rows up to ``SPREAD_BLOCKS`` full
    blocks, from there on with rows times blocks. ``id_column`` must be unique.
    """
    rows = points.count()
    blocks = max(1, -(-rows // block_rows)) if block_rows else _blocks(rows)
    block = F.pmod(F.xxhash64(id_column), F.lit(blocks)).cast("int")
    numbered = points.select(F.col(id_column).alias("id"), "features", F.col("cluster").cast("long"), block.alias("block"))
    left = numbered.select("*", F.col("block").alias("a"), F.explode(F.sequence(F.col("block"), F.lit(blocks - 1))).alias("b"))
    other = numbered.toDF(*numbered.columns)
    right = other.select("*", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("a"), F.col("block").alias("b"))
    id_type = numbered.schema["id"].dataType.simpleString()
    sums = (
        left.groupBy("a", "b")
        .cogroup(right.groupBy("a", "b"))
        .applyInPandas(_block_distance_sums, f"id {id_type}, other long, total double")
        .groupBy("id", "other")
        .agg(F.sum("total").alias("total"))
    )
    sizes = points.groupBy(F.col("cluster").cast("long").alias("_label")).agg(F.count(F.lit(1)).alias("n"))
    own = F.col("other") == F.col("_own")
    means = (
        sums.join(F.broadcast(sizes), F.col("other") == F.col("_label"))
        .join(numbered.select(F.col("id").alias("_id"), F.col("cluster").alias("_own")), F.col("id") == F.col("_id"))
        .groupBy("id")
        .agg(
            F.max(F.when(own, F.col("n"))).alias("_n"),
            F.max(F.when(own, F.try_divide(F.col("total"), F.col("n") - 1))).alias("_a"),
            F.min(F.when(~own, F.col("total") / F.col("n"))).alias("_b"),
        )
        .select(F.col("id").alias("_id"), _coefficient(F.col("_a"), F.col("_b"), F.col("_n")).alias("sil_sample"))
    )
    return points.join(means, F.col(id_column) == F.col("_id")).drop("_id")


def _block_distance_sums(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Sums of distances between the rows of two blocks, per row and other side's cluster."""
    empty = pd.DataFrame({"id": left["id"][:0], "other": pd.Series([], dtype="int64"), "total": pd.Series([], dtype="float64")})
    if left.empty or right.empty:
        return empty
    x, y = np.stack(left["features"]), np.stack(right["features"])
    # Distances do not change when both sides move; near the origin the product form is exact
    # but for close pairs, which are taken directly.
    center = x.mean(0)
    x, y = x - center, y - center
    same_block = left["block"].iloc[0] == right["block"].iloc[0]
    ids, other_ids = left["id"].to_numpy(), right["id"].to_numpy()
    labels, member = _membership(left)
    other_labels, other_member = _membership(right)
    towards, back = [], np.zeros((len(y), len(labels)))
    size = max(1, HELD_DISTANCES // len(y))
    for start in range(0, len(x), size):
        strip = slice(start, start + size)
        distance = _distances(x[strip], y)
        if same_block:
            distance[ids[strip][:, None] == other_ids[None, :]] = 0.0
        else:
            back += distance.T @ member[strip]
        towards.append(distance @ other_member)
    parts = [_sums_per_cluster(ids, other_labels, np.concatenate(towards))]
    if not same_block:
        parts.append(_sums_per_cluster(other_ids, labels, back))
    return pd.concat(parts, ignore_index=True)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    norms = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :]
    squared = norms - 2.0 * x @ y.T
    a, b = np.nonzero(squared <= 1e-6 * norms)
    for at in range(0, len(a), 100_000):
        i, j = a[at : at + 100_000], b[at : at + 100_000]
        squared[i, j] = ((x[i] - y[j]) ** 2).sum(1)
    return np.sqrt(np.maximum(squared, 0.0))


def _membership(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The clusters of a block, and which of them each row is in."""
    labels, position = np.unique(rows["cluster"].to_numpy(), return_inverse=True)
    member = np.zeros((len(rows), len(labels)))
    member[np.arange(len(rows)), position] = 1.0
    return labels, member


def _sums_per_cluster(ids: np.ndarray, labels: np.ndarray, totals: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"id": np.repeat(ids, len(labels)), "other": np.tile(labels, len(ids)), "total": totals.ravel()})


def cluster_geometry(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per cluster: rows ``n``, ``centroid``, mean distance to it and sum of squared distances."""
    sums = cluster_sums(points, by)
    centroids = sums.select(*by, "cluster", F.transform("s", lambda v: v / F.col("n")).alias("centroid"))
    rows = _with_list(points, centroids, by, "_centroids")
    mine = F.filter("_centroids", lambda c: c["cluster"] == F.col("cluster"))[0]["centroid"]
    return (
        rows.withColumn("centroid", mine)
        .withColumn("_d2", _squared_distance(F.col("features"), F.col("centroid")))
        .groupBy(*by, "cluster")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.first("centroid").alias("centroid"),
            F.avg(F.sqrt("_d2")).alias("mean_distance"),
            F.sum("_d2").alias("within"),
        )
    )


def davies_bouldin_of(geometry: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean over clusters of the worst (scatter_i + scatter_j) / centroid distance."""
    listed = geometry.groupBy(*by).agg(F.collect_list(F.struct("cluster", "centroid", "mean_distance")).alias("_c"))

    def ratio(i: Column, j: Column) -> Column:
        apart = F.sqrt(_squared_distance(i["centroid"], j["centroid"]))
        return F.when(apart > 0, (i["mean_distance"] + j["mean_distance"]) / apart).otherwise(F.lit(0.0))

    def worst(i: Column) -> Column:
        others = F.filter("_c", lambda j: j["cluster"] != i["cluster"])
        return F.array_max(F.transform(others, lambda j: ratio(i, j)))

    total = F.aggregate(F.transform("_c", worst), F.lit(0.0), lambda s, x: s + x)
    return listed.select(*by, (total / F.size("_c")).alias("davies_bouldin"))


def calinski_harabasz_of(geometry: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Between-cluster over within-cluster variance."""
    listed = geometry.groupBy(*by).agg(
        F.collect_list(F.struct("n", "centroid")).alias("_c"),
        F.sum("n").alias("_rows"),
        F.sum("within").alias("_within"),
        F.count(F.lit(1)).alias("_k"),
    )
    zero = F.transform(F.col("_c")[0]["centroid"], lambda v: F.lit(0.0))
    weighted = F.aggregate(
        "_c", zero, lambda s, c: F.zip_with(s, c["centroid"], lambda a, v: a + v * c["n"])
    )
    between = F.aggregate(
        "_c", F.lit(0.0), lambda s, c: s + c["n"] * _squared_distance(c["centroid"], F.col("_mean"))
    )
    ratio = F.col("_between") * (F.col("_rows") - F.col("_k")) / (F.col("_within") * (F.col("_k") - 1))
    return (
        listed.withColumn("_mean", F.transform(weighted, lambda v: v / F.col("_rows")))
        .withColumn("_between", between)
        .select(*by, F.when(F.col("_within") == 0, F.lit(1.0)).otherwise(ratio).alias("calinski_harabasz"))
    )


def davies_bouldin(points: DataFrame) -> DataFrame:
    return davies_bouldin_of(cluster_geometry(points))


def calinski_harabasz(points: DataFrame) -> DataFrame:
    return calinski_harabasz_of(cluster_geometry(points))


def cluster_max_pct(labelled: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of the largest cluster, in percent."""
    sizes = labelled.groupBy(*by, "cluster").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(*by).agg((F.max("n") * 100.0 / F.sum("n")).alias("cluster_max_pct"))
