"""The whole flow: listings to segments, as named DataFrames and, if asked, files."""

from __future__ import annotations

import inspect
import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from stallwise import schema as S
from stallwise.operators.audit import outlier_summary, quality_audit
from stallwise.operators.cleaning import (
    cleaning_funnel,
    clean_listings,
    split_critical_errors,
)
from stallwise.operators.clustering import evaluate_kmeans_range, fit_segments
from stallwise.operators.features import feature_checks, log_features, seller_features
from stallwise.operators.profile import dataset_overview
from stallwise.operators.summary import (
    cluster_payload_json,
    cluster_profile,
    cluster_summary,
    mean_cluster_silhouette,
    segment_names,
    segment_table,
    silhouette_by_cluster,
)
from stallwise.sources import sinks
from stallwise.sources.staging import stage


def seller_table(items: DataFrame) -> DataFrame:
    """Cleaned listings as seller features with logarithms."""
    return log_features(seller_features(clean_listings(items)))


def segment_listings(
    items: DataFrame,
    site: str = "MX",
    source: str = "",
    k: int = 5,
    k_values: Iterable[int] = range(2, 9),
    n_init: int = 20,
    distance: str = "squared",
    max_price: float = S.MAX_PRICE,
    segments: Sequence[tuple] = (),
) -> dict[str, DataFrame]:
    """Every result of the flow by name.

    The seller table, the smallest product that everything after it reads
    repeatedly, is staged once; everything before it stays lazy. ``segments`` names
    clusters as in ``segment_table``; clusters it leaves out have no name.
    """
    spark = items.sparkSession
    _, rejected = split_critical_errors(items)
    sellers = stage(log_features(seller_features(clean_listings(items, max_price))), "sellers")
    fitted = fit_segments(sellers, k, n_init=n_init, distance=distance)
    named = segment_table(spark, list(segments))
    summary = cluster_summary(fitted.sellers, fitted.features)
    names = {number: name for number, name, *_ in segments if number < k}
    return {
        "dataset_overview": dataset_overview(items),
        "quality_audit": quality_audit(items),
        "outlier_summary": outlier_summary(items),
        "cleaning_funnel": cleaning_funnel(items, max_price),
        "rejected_items": rejected,
        "seller_features": sellers,
        "feature_checks": feature_checks(sellers),
        "kmeans_evaluation": evaluate_kmeans_range(sellers, k_values, n_init=n_init, distance=distance),
        "seller_clusters": fitted.sellers,
        "cluster_metrics": fitted.metrics,
        "cluster_summary": summary,
        "cluster_profile": cluster_profile(fitted.sellers),
        "silhouette_by_cluster": silhouette_by_cluster(fitted.sellers),
        "mean_cluster_silhouette": mean_cluster_silhouette(fitted.sellers),
        "segment_names": segment_names(fitted.sellers, named),
        "cluster_payload_json": cluster_payload_json(summary, named),
        "run_metadata": sinks.run_metadata(fitted.metrics, items, fitted.sellers, site, source, k, names),
    }


def write_results(results: dict[str, DataFrame], output_dir: str) -> None:
    """Write the artefacts of a run: small ones as CSV, seller-sized ones as Parquet."""
    for name in ("quality_audit", "kmeans_evaluation", "cluster_profile", "silhouette_by_cluster"):
        sinks.write_report(results[name], f"{output_dir}/{name}")
    for name in ("seller_features", "seller_clusters", "cluster_summary"):
        sinks.write_table(results[name], f"{output_dir}/{name}")
    sinks.write_rejected(results["rejected_items"], f"{output_dir}/rejected_items")
    sinks.write_metadata(results["run_metadata"], f"{output_dir}/{sinks.METADATA_DIR}")


def run_identity(items: DataFrame, options: dict) -> str:
    """What decides the results of a run: its listings and all its options, defaults included."""
    bound = inspect.signature(segment_listings).bind(items, **options)
    bound.apply_defaults()
    named = {k: v if isinstance(v, (str, int, float)) else list(v) for k, v in bound.arguments.items() if k != "items"}
    return json.dumps({"items": sinks.dataset_fingerprint(items), **named}, sort_keys=True, default=str)


def load_or_run(items: DataFrame, output_dir: str, **options) -> dict[str, DataFrame]:
    """The saved segments of the same run, or else those of a new run, which replaces what is saved.

    The same run had equal listings, in any order, and equal options. A run that was
    broken off while writing has no identity and is run again.
    """
    spark = items.sparkSession
    identity = run_identity(items, options)
    if sinks.read_identity(spark, output_dir) == identity:
        saved = sinks.load_outputs(spark, output_dir)
        if saved is not None:
            return saved
    sinks.write_identity(spark, output_dir, "")
    write_results(segment_listings(items, **options), output_dir)
    sinks.write_identity(spark, output_dir, identity)
    return sinks.load_outputs(spark, output_dir)
