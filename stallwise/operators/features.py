"""Item features, seller features and their transformations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schema as S
from stallwise.functions.columns import (
    capped,
    discount_pct,
    has_discount,
    holds,
    is_new,
    log1p_from_zero,
    on_channel,
    percent,
    reputation_score,
    share,
)
from stallwise.functions.counts import distinct_per_key, most_frequent, value_counts
from stallwise.functions.quantiles import by_group_size, quantile_aggregates, quantile_row, spread_with_quantiles, with_row


def item_features(df: DataFrame) -> DataFrame:
    """Listings with discount, reputation, channel and condition features."""
    return df.withColumns(
        {
            "has_regular_price": F.col(S.REGULAR_PRICE).isNotNull(),
            "has_discount": has_discount(),
            "discount_pct": discount_pct(),
            "seller_reputation_score": reputation_score(F.col(S.REPUTATION)),
            "is_fbm": on_channel("FBM"),
            "is_xd": on_channel("XD"),
            "is_flex": on_channel("FLEX"),
            "is_ds": on_channel("DS"),
            "is_new": is_new(),
        }
    )


SELLER_FEATURES = [
    S.SELLER, "items_count", "unique_urls", "total_stock", "avg_stock", "median_stock", "max_stock",
    "avg_price", "median_price", "min_price", "max_price", "price_std",
    "pct_items_with_regular_price", "pct_items_with_discount", "avg_discount_pct",
    "categories_count", "main_category", "pct_fbm", "pct_xd", "pct_flex", "pct_ds", "pct_new",
    "pct_refurbished", "seller_reputation_main", "seller_reputation_score", "has_reputation",
]


def seller_dimensions(df: DataFrame) -> DataFrame:
    """Main category, number of categories, main reputation and median reputation score per seller.

    Everything follows from rows per (seller, value); the score takes only as
    many values as there are reputation levels, so its median stays small.
    """
    counts = value_counts(df, {"category": F.col(S.CATEGORY_NAME), "reputation": F.col(S.REPUTATION)}, [S.SELLER])
    category, reputation = F.col("column") == "category", F.col("column") == "reputation"
    score = F.when(reputation, reputation_score(F.col("value")))
    return counts.groupBy(S.SELLER).agg(
        F.count_if(category & F.col("value").isNotNull()).alias("categories_count"),
        most_frequent(category, F.col("value"), F.col("records")).alias("main_category"),
        most_frequent(reputation, F.col("value"), F.col("records")).alias("seller_reputation_main"),
        F.percentile(score, F.lit(0.5), F.col("records")).alias("_score"),
    )


def _figures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("items_count"),
        F.coalesce(F.sum(S.STOCK), F.lit(0)).alias("total_stock"),
        F.avg(S.STOCK).alias("avg_stock"),
        F.max(S.STOCK).alias("max_stock"),
        F.avg(S.PRICE).alias("avg_price"),
        F.min(S.PRICE).alias("min_price"),
        F.max(S.PRICE).alias("max_price"),
        F.coalesce(F.stddev_samp(S.PRICE), F.lit(0.0)).alias("price_std"),
        share(F.col(S.REGULAR_PRICE).isNotNull()).alias("pct_items_with_regular_price"),
        share(has_discount()).alias("pct_items_with_discount"),
        F.coalesce(F.avg(discount_pct()), F.lit(0.0)).alias("avg_discount_pct"),
        share(on_channel("FBM")).alias("pct_fbm"),
        share(on_channel("XD")).alias("pct_xd"),
        share(on_channel("FLEX")).alias("pct_flex"),
        share(on_channel("DS")).alias("pct_ds"),
        share(is_new()).alias("pct_new"),
        F.coalesce(F.avg(F.col("is_refurbished").cast("double")), F.lit(0.0)).alias("pct_refurbished"),
    ]


MEDIANS = {"median_stock": (S.STOCK, 0.5), "median_price": (S.PRICE, 0.5)}


def _gathered_sellers(rows: DataFrame) -> DataFrame:
    """Figures of sellers whose rows fit a task, all in one grouping."""
    category, reputation = F.col(S.CATEGORY_NAME).cast("string"), F.col(S.REPUTATION).cast("string")
    return rows.groupBy(S.SELLER).agg(
        *_figures(),
        *quantile_aggregates(MEDIANS),
        F.size(F.collect_set(S.URL)).cast("long").alias("unique_urls"),
        F.size(F.collect_set(category)).cast("long").alias("categories_count"),
        # Ties go to the smallest value.
        F.mode(category, True).alias("main_category"),
        F.mode(reputation, True).alias("seller_reputation_main"),
        F.percentile(reputation_score(reputation), F.lit(0.5)).alias("_score"),
    )


def _spread_sellers(rows: DataFrame) -> DataFrame:
    """The same for sellers of any size: figures and medians, distinct urls, and dimension values.

    Each grouping reads its own columns and spreads or pre-aggregates a seller with a
    large part of the rows; all end hash-partitioned by seller.
    """
    figures = spread_with_quantiles(rows, [S.SELLER], _figures(), MEDIANS)
    urls = distinct_per_key(rows, S.SELLER, S.URL, "unique_urls")
    return figures.join(urls, S.SELLER).join(seller_dimensions(rows), S.SELLER)


def seller_features(df: DataFrame) -> DataFrame:
    """One row per known seller: 24 aggregates and ``has_reputation``."""
    known = df.where(F.col(S.SELLER).isNotNull())
    found = by_group_size(known, [S.SELLER], _gathered_sellers, _spread_sellers)
    return found.withColumns(
        {
            "has_reputation": F.col("_score").isNotNull().cast("int"),
            "seller_reputation_score": F.coalesce("_score", F.lit(S.UNKNOWN_REPUTATION_SCORE)),
        }
    ).select(*SELLER_FEATURES)


def main_category(df: DataFrame) -> DataFrame:
    """The most frequent category per seller, ties to the smallest name."""
    known = df.where(F.col(S.SELLER).isNotNull())
    counts = known.groupBy(S.SELLER, S.CATEGORY_NAME).agg(F.count(F.lit(1)).alias("records"))
    return counts.groupBy(S.SELLER).agg(
        most_frequent(F.lit(True), F.col(S.CATEGORY_NAME), F.col("records")).alias("main_category")
    )


def logistics_mix(df: DataFrame) -> DataFrame:
    """Share of each channel per seller; listings without a channel count as none of them."""
    return (
        df.where(F.col(S.SELLER).isNotNull())
        .groupBy(S.SELLER)
        .agg(*[share(on_channel(c.upper())).alias(f"pct_{c}") for c in ("fbm", "xd", "flex", "ds")])
    )


def log_features(sellers: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Add a ``log_`` copy, log(1 + x) from zero up, of each given column that exists."""
    present = [c for c in (columns or S.LOG_COLUMNS) if c in sellers.columns]
    return sellers.withColumns({f"log_{c}": log1p_from_zero(F.col(c)) for c in present})


def winsorized_features(
    sellers: DataFrame, columns: Sequence[str] | None = None, quantile: float = 0.95
) -> DataFrame:
    """Cap each given column that exists at its quantile."""
    present = [c for c in (columns or S.WINSOR_COLUMNS) if c in sellers.columns]
    capping = with_row(sellers, "_cap", quantile_row(sellers, {c: (c, quantile) for c in present}))
    return capping.withColumns({c: capped(F.col(c).cast("double"), F.col(f"_cap.{c}")) for c in present}).drop("_cap")


def feature_checks(sellers: DataFrame) -> DataFrame:
    """Sanity of a seller table: expected columns are there and the score starts at one."""
    present = [F.struct(F.lit(c).alias("check"), F.lit(c in sellers.columns).alias("passed")) for c in ("pct_ds", "has_reputation", "log_avg_price")]
    score = F.struct(F.lit("seller_reputation_score_from_1").alias("check"), holds(F.col("_lowest") >= 1).alias("passed"))
    return sellers.agg(F.min("seller_reputation_score").alias("_lowest")).select(F.inline(F.array(*present, score)))


def long_tail_share(sellers: DataFrame, at_most: int = 3) -> DataFrame:
    """Sellers with few items: number, all sellers, and percentage."""
    return sellers.agg(
        F.count_if(F.col("items_count") <= at_most).alias("small_sellers"), F.count(F.lit(1)).alias("sellers")
    ).select("*", percent(F.col("small_sellers"), F.col("sellers")).alias("pct"))


def feature_correlation(sellers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair of columns, all pairs of columns in one scan."""
    pairs = list(combinations(columns, 2))
    found = sellers.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    lines = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"_{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return found.select(F.inline(F.array(*lines)))


def dominant_channel(sellers: DataFrame) -> DataFrame:
    """Add the channel with the largest share among FBM, XD and DS; ties to the earlier one."""
    fbm, xd, ds = F.col("pct_fbm"), F.col("pct_xd"), F.col("pct_ds")
    return sellers.withColumn(
        "dominant_channel",
        F.when((fbm >= xd) & (fbm >= ds), F.lit("FBM")).when(xd >= ds, F.lit("XD")).otherwise(F.lit("DS")),
    )
