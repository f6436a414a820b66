"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise import schema as S
from stallwise.functions import columns as C
from stallwise.operators import (
    audit,
    cleaning,
    clustering,
    daily,
    distributions,
    features,
    kmeans,
    mart,
    metrics,
    profile,
    scaling,
    summary,
)
from stallwise.plans import segmentation
from stallwise.plans.segmentation import seller_table
from stallwise.sources import listings, sinks
from stallwise.sources.order_tables import items, items_with_repeats, text_items
from stallwise.sources.staging import new_path, stage, stage_once
from stallwise.streaming import daily_job

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAILY_FROM = "1998-06-15 06:30:00"
# The bands of ``labelled``, named by the rule that makes them.
BANDS = [(0, 30), (30, 36), (36, 42), (42, 50), (50, None)]
SEGMENTS = [
    (i, f"Band {i} — {low} listings or more" + (f", below {high}" if high else ""), str(i + 1), "not rated", "none planned")
    for i, (low, high) in enumerate(BANDS)
]
CHANNELS = ["pct_fbm", "pct_xd", "pct_flex", "pct_ds"]
CORRELATED = [f"log_{c}" for c in S.LOG_COLUMNS]


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six digits, so that sums taken in another order still agree.

    The small offset keeps decimal halves, which averages of amounts often are,
    off the rounding boundary.
    """
    return df.withColumns(
        {f.name: F.round(F.col(f.name) + 2e-7, 6) for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    )


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: comparable(build(spark, sf_dir))
    return build


# --- Inputs shared by the queries ---------------------------------------------


def in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    usable, _ = cleaning.split_critical_errors(items(spark, sf_dir))
    return cleaning.split_price_above(usable)[0]


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seller table, written once per application: many queries start from it."""
    return stage_once(spark, f"sellers of {sf_dir}", lambda: seller_table(items(spark, sf_dir)))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sellers under a fixed rule in place of a model: bands of the number of items."""
    n = F.col("items_count")
    band = F.when(n < 30, 0).when(n < 36, 1).when(n < 42, 2).when(n < 50, 3).otherwise(4)
    return sellers(spark, sf_dir).withColumn("cluster", band.cast("int"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled sellers with the silhouette of their scaled features."""
    table = labelled(spark, sf_dir)
    points = scaling.with_points(table, scaling.fit_scaler(table, S.MODEL_FEATURES))
    return metrics.silhouette_squared(points).drop("features")


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled points: the embeddings with their labels as clusters."""
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features"), F.col("label").alias("cluster")
    )


# --- Sources -------------------------------------------------------------------


@query
def scan_items(spark, sf_dir):
    """Through a CSV file: written as text, read back with types."""
    path = new_path(spark, "csv")
    text_items(spark, sf_dir).write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return listings.read_listings_csv(spark, path)


@query
def normalize_nulls(spark, sf_dir):
    return listings.normalize_nulls(text_items(spark, sf_dir))


@query
def coerce_types(spark, sf_dir):
    return listings.coerce_types(text_items(spark, sf_dir))


@query
def run_metadata(spark, sf_dir):
    table = items(spark, sf_dir)
    fitted = clustering.fit_segments(sellers(spark, sf_dir))
    names = {number: name for number, name, *_ in SEGMENTS}
    return sinks.run_metadata(fitted.metrics, table, fitted.sellers, "MX", sf_dir, 5, names)


# --- Predicates and cleaning -----------------------------------------------------


@query
def category_mismatch(spark, sf_dir):
    return items(spark, sf_dir).where(C.differs(F.col("categoria"), F.col("category_id")))


@query
def blank_title(spark, sf_dir):
    return items(spark, sf_dir).where(C.is_blank(F.col("titulo")))


@query
def clean_items(spark, sf_dir):
    return cleaning.split_critical_errors(items(spark, sf_dir))[0]


@query
def rejected_items(spark, sf_dir):
    return cleaning.split_critical_errors(items(spark, sf_dir))[1]


@query
def price_quantile_outliers(spark, sf_dir):
    return cleaning.split_price_above_quantile(items(spark, sf_dir), 0.99)[1]


@query
def price_abs_outliers(spark, sf_dir):
    return cleaning.split_price_above(cleaning.split_critical_errors(items(spark, sf_dir))[0])[1]


@query
def price_in_range(spark, sf_dir):
    return in_range(spark, sf_dir)


@query
def impute_price(spark, sf_dir):
    return cleaning.impute_price(in_range(spark, sf_dir))


@query
def dedup_items(spark, sf_dir):
    return cleaning.deduplicate(items_with_repeats(spark, sf_dir))


@query
def cleaning_funnel(spark, sf_dir):
    return cleaning.cleaning_funnel(items(spark, sf_dir))


# --- Profile and audit -----------------------------------------------------------


@query
def dataset_overview(spark, sf_dir):
    return profile.dataset_overview(items_with_repeats(spark, sf_dir))


@query
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(items_with_repeats(spark, sf_dir))


@query
def column_profile(spark, sf_dir):
    found = profile.column_profile(items(spark, sf_dir))
    return found.withColumn("sample_values", F.array_join("sample_values", " | "))


@query
def numeric_profile(spark, sf_dir):
    return profile.numeric_profile(items(spark, sf_dir))


@query
def categorical_profile(spark, sf_dir):
    return profile.categorical_profile(items(spark, sf_dir))


@query
def top_missing_columns(spark, sf_dir):
    return profile.top_missing_columns(items(spark, sf_dir))


@query
def top_categories(spark, sf_dir):
    return profile.top_values(items(spark, sf_dir))


@query
def channel_mix(spark, sf_dir):
    return profile.channel_mix(items(spark, sf_dir))


@query
def grain_rows(spark, sf_dir):
    return profile.grain_rows(items(spark, sf_dir))


@query
def grain_urls(spark, sf_dir):
    return profile.grain_urls(items(spark, sf_dir))


@query
def grain_days(spark, sf_dir):
    return profile.grain_days(items(spark, sf_dir))


@query
def group_size_describe(spark, sf_dir):
    return profile.group_size_describe(items(spark, sf_dir))


@query
def seller_preview(spark, sf_dir):
    return profile.seller_preview(items(spark, sf_dir))


@query
def quality_audit(spark, sf_dir):
    return audit.quality_audit(items_with_repeats(spark, sf_dir))


@query
def critical_checks(spark, sf_dir):
    return audit.critical_checks(audit.quality_audit(items(spark, sf_dir)))


@query
def outlier_summary(spark, sf_dir):
    return audit.outlier_summary(items(spark, sf_dir))


@query
def threshold_sweep(spark, sf_dir):
    return audit.threshold_sweep(items(spark, sf_dir))


@query
def price_histogram(spark, sf_dir):
    return distributions.histogram(in_range(spark, sf_dir))


@query
def price_log_histogram(spark, sf_dir):
    return distributions.log_histogram(items(spark, sf_dir))


# --- Features ----------------------------------------------------------------------


@query
def item_features(spark, sf_dir):
    return features.item_features(items(spark, sf_dir))


@query
def reputation_score(spark, sf_dir):
    return items(spark, sf_dir).select(
        "seller_nickname", "url", "seller_reputation", C.reputation_score(F.col("seller_reputation")).alias("score")
    )


@query
def seller_features(spark, sf_dir):
    return features.seller_features(cleaning.clean_listings(items(spark, sf_dir)))


@query
def main_category(spark, sf_dir):
    return features.main_category(items(spark, sf_dir))


@query
def logistics_mix(spark, sf_dir):
    return features.logistics_mix(items(spark, sf_dir))


@query
def log_features(spark, sf_dir):
    return seller_table(items(spark, sf_dir)).select(S.SELLER, *[f"log_{c}" for c in S.LOG_COLUMNS])


@query
def winsorized_features(spark, sf_dir):
    return features.winsorized_features(sellers(spark, sf_dir)).select(S.SELLER, *S.WINSOR_COLUMNS)


@query
def dominant_channel(spark, sf_dir):
    return features.dominant_channel(features.logistics_mix(items(spark, sf_dir))).select(S.SELLER, "dominant_channel")


@query
def feature_checks(spark, sf_dir):
    return features.feature_checks(seller_table(items(spark, sf_dir)))


@query
def long_tail_share(spark, sf_dir):
    sizes = profile.rows_per_seller(items(spark, sf_dir)).withColumnRenamed("n", "items_count")
    return features.long_tail_share(sizes, at_most=30)


@query
def feature_correlation(spark, sf_dir):
    return features.feature_correlation(seller_table(items(spark, sf_dir)), CORRELATED)


@query
def margin_alerts(spark, sf_dir):
    """With a lower limit than the usual 40 %: discounts in these tables stay under 10 %."""
    return mart.margin_alerts(features.seller_features(items(spark, sf_dir)), above=0.08).select(S.SELLER, "avg_discount_pct")


# --- Scaling -------------------------------------------------------------------------


@query
def impute_features(spark, sf_dir):
    days = stage(daily.seller_daily_features(items(spark, sf_dir)), "days")
    filled = scaling.impute_features(days, ["avg_price", "median_price"])
    return filled.select(S.DAY, S.SELLER, "avg_price", "median_price")


@query
def robust_scaled(spark, sf_dir):
    return scaling.scaled_features(sellers(spark, sf_dir), S.MODEL_FEATURES, "robust").select(S.SELLER, *S.MODEL_FEATURES)


@query
def standard_scaled(spark, sf_dir):
    return scaling.scaled_features(sellers(spark, sf_dir), S.MODEL_FEATURES, "standard").select(S.SELLER, *S.MODEL_FEATURES)


# --- Clustering and its quality --------------------------------------------------------


@query
def silhouette_sq_samples(spark, sf_dir):
    return metrics.silhouette_squared(embedded(spark, sf_dir)).select("vec_id", "cluster", "sil_sample")


@query
def silhouette_sq(spark, sf_dir):
    return metrics.silhouette_squared(embedded(spark, sf_dir)).agg(F.avg("sil_sample").alias("silhouette"))


@query
def silhouette_samples(spark, sf_dir):
    return metrics.silhouette_euclidean(embedded(spark, sf_dir), "vec_id").select("vec_id", "cluster", "sil_sample")


@query
def davies_bouldin(spark, sf_dir):
    return metrics.davies_bouldin(embedded(spark, sf_dir))


@query
def calinski_harabasz(spark, sf_dir):
    return metrics.calinski_harabasz(embedded(spark, sf_dir))


@query
def cluster_max_pct(spark, sf_dir):
    return metrics.cluster_max_pct(embedded(spark, sf_dir))


@query
def kmeans_evaluation(spark, sf_dir):
    return clustering.evaluate_kmeans_range(sellers(spark, sf_dir))


@query
def kmeans_facts(spark, sf_dir):
    """What holds of any fit: all sellers labelled with the nearest center, costs as stated."""
    points, _ = clustering.staged_points(sellers(spark, sf_dir), S.MODEL_FEATURES, "robust")
    parts = []
    for k, model in kmeans.fit_all(points, range(2, 9)).items():
        centers = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.centers])
        distances = F.transform(centers, lambda c: F.aggregate(F.zip_with(c, "features", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda x, y: x + y))
        rows = clustering.labels(model, points).withColumn("distances", distances)
        own = F.col("distances")[F.col("cluster")]
        parts.append(rows.agg(
            F.lit(k).alias("k"), F.count(F.lit(1)).alias("sellers"), F.countDistinct("cluster").alias("clusters"),
            F.every(own <= F.array_min("distances") + 1e-9).alias("nearest"),
            (F.abs(F.sum(own) - model.inertia) <= 1e-6 * model.inertia).alias("inertia_holds"),
        ))
    return reduce(DataFrame.unionByName, parts)


@query
def segment_listings(spark, sf_dir):
    """The whole flow: every result by name with its rows, written and read back where it is an artefact."""
    results = segmentation.segment_listings(items(spark, sf_dir), k_values=[2, 3], n_init=3)
    out = new_path(spark, "flow")
    segmentation.write_results(results, out)
    tables = {name: spark.read.parquet(f"{out}/{name}") for name in ("seller_features", "seller_clusters", "cluster_summary", "rejected_items")}
    reports = {name: spark.read.option("header", True).csv(f"{out}/{name}") for name in ("quality_audit", "kmeans_evaluation", "cluster_profile", "silhouette_by_cluster")}
    read = {**results, **tables, **reports, "run_metadata": spark.read.json(f"{out}/{sinks.METADATA_DIR}")}
    return reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("result"), F.count(F.lit(1)).alias("rows")) for name, df in read.items()])


@query
def scaler_comparison(spark, sf_dir):
    return clustering.scaler_comparison(sellers(spark, sf_dir))


@query
def kmeans_labels(spark, sf_dir):
    return clustering.fit_segments(sellers(spark, sf_dir)).sellers.select(S.SELLER, "cluster")


@query
def seller_clusters(spark, sf_dir):
    return clustering.fit_segments(sellers(spark, sf_dir)).sellers


@query
def score_new_sellers(spark, sf_dir):
    """Segments fitted on clean listings, applied to sellers as they come."""
    fitted = clustering.fit_segments(sellers(spark, sf_dir))
    others = features.log_features(features.seller_features(items(spark, sf_dir)))
    return clustering.score_sellers(fitted, others).select(S.SELLER, "cluster")


@query
def pca_features(spark, sf_dir):
    return clustering.pca_features(sellers(spark, sf_dir), CHANNELS).select(S.SELLER, "pc1", "pc2")


# --- Describing clusters -----------------------------------------------------------------


@query
def cluster_summary(spark, sf_dir):
    return summary.cluster_summary(labelled(spark, sf_dir))


@query
def cluster_profile(spark, sf_dir):
    return summary.cluster_profile(stage(scored(spark, sf_dir), "scored"))


@query
def silhouette_by_cluster(spark, sf_dir):
    return summary.silhouette_by_cluster(scored(spark, sf_dir))


@query
def mean_cluster_silhouette(spark, sf_dir):
    return summary.mean_cluster_silhouette(scored(spark, sf_dir))


@query
def cluster_sizes(spark, sf_dir):
    return summary.cluster_sizes(labelled(spark, sf_dir))


@query
def cluster_minmax(spark, sf_dir):
    return summary.cluster_minmax(labelled(spark, sf_dir))


@query
def bubble_sizes(spark, sf_dir):
    return summary.bubble_sizes(labelled(spark, sf_dir))


@query
def segment_names(spark, sf_dir):
    return summary.segment_names(labelled(spark, sf_dir), summary.segment_table(spark, SEGMENTS))


@query
def cluster_payload_json(spark, sf_dir):
    table = summary.cluster_summary(labelled(spark, sf_dir))
    return summary.cluster_payload_json(table, summary.segment_table(spark, SEGMENTS))


@query
def seller_strategy_mart(spark, sf_dir):
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    facts = mart.seller_facts(orders, "o_custkey", "o_totalprice", F.col("o_orderstatus") == "F")
    visits = mart.visit_facts(events, "user_id", F.col("event_type") == "view", F.col("event_type") == "purchase")
    facts = facts.join(names, F.col("_seller") == F.col("c_custkey")).drop("_seller", "c_custkey")
    visits = visits.join(names, F.col("_visited") == F.col("c_custkey")).drop("_visited", "c_custkey")
    return mart.seller_strategy_mart(
        labelled(spark, sf_dir).select(S.SELLER, "cluster"),
        facts.withColumnRenamed("c_name", "_seller"),
        visits.withColumnRenamed("c_name", "_visited"),
        summary.segment_table(spark, SEGMENTS),
    )


# --- Daily features ------------------------------------------------------------------------


@query
def seller_daily_features(spark, sf_dir):
    return daily.seller_daily_features(items(spark, sf_dir))


@query
def daily_features_since(spark, sf_dir):
    return daily.seller_daily_features(items(spark, sf_dir), DAILY_FROM)


@query
def daily_features_refreshed(spark, sf_dir):
    """Written for all history, then refreshed from a mark on: nothing may change."""
    raw_path, path = new_path(spark, "raw"), new_path(spark, "daily")
    sinks.write_raw_listings(items(spark, sf_dir), raw_path)
    raw = spark.read.parquet(raw_path)
    daily_job.refresh_daily_features(raw, path, unit="month")
    daily_job.refresh_daily_features(raw, path, DAILY_FROM, unit="month")
    return daily_job.read_daily_features(spark, path)


@query
def daily_features_streamed(spark, sf_dir):
    """Raw files arrive in two parts; the stream is run after each."""
    raw_path, path, checkpoint = (new_path(spark, n) for n in ("raw", "daily", "progress"))
    table = items(spark, sf_dir)
    late = F.col(S.CHANNEL) == "XD"
    for part in (table.where(~F.coalesce(late, F.lit(False))), table.where(late)):
        sinks.write_raw_listings(part, raw_path, mode="append")
        daily_job.stream_daily_features(spark, raw_path, path, checkpoint, unit="month").awaitTermination()
    return daily_job.read_daily_features(spark, path)


@query
def approx_median_price(spark, sf_dir):
    return daily.approx_median_price(items(spark, sf_dir))


@query
def rolling_30d(spark, sf_dir):
    return daily.rolling_features(items(spark, sf_dir), 30)


@query
def rolling_90d(spark, sf_dir):
    return daily.rolling_features(items(spark, sf_dir), 90)


@query
def trend_30d(spark, sf_dir):
    return daily.items_trend(items(spark, sf_dir), 30)


@query
def cluster_migration(spark, sf_dir):
    """Monthly clusters by a fixed rule: one item, two, or more."""
    months = daily.monthly_items(items(spark, sf_dir))
    n = F.col("items_count")
    band = F.when(n == 1, 0).when(n == 2, 1).otherwise(2).cast("int")
    return daily.cluster_migration(months.select(S.SELLER, "month", band.alias("cluster")))


@query
def clusters_carried_over(spark, sf_dir):
    """Two snapshots, clustered by numbers of listings and numbered the other way round; moves once numbers are carried on."""
    listings = items(spark, sf_dir).where(F.col(S.SELLER).isNotNull())
    band = F.least(F.floor(F.col("n") / 20), F.lit(3))

    def snapshot(rows, cluster):
        return rows.groupBy(S.SELLER).agg(F.count(F.lit(1)).alias("n")).select(S.SELLER, cluster.cast("long").alias("cluster"))

    before = stage(snapshot(listings.where(F.col(S.DAY) < F.to_date(F.lit(DAILY_FROM))), band), "before")
    after = stage(snapshot(listings, 3 - band), "after")
    carried = daily.carry_clusters(before, after)
    both = before.withColumn("month", F.lit(1)).unionByName(carried.withColumn("month", F.lit(2)))
    return daily.cluster_migration(both)
