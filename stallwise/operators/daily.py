"""Features per seller and day, and what follows from them over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwise import schema as S
from stallwise.functions.columns import discount_pct, on_channel, share
from stallwise.functions.quantiles import aggregate_with_quantiles

DAILY_COLUMNS = [
    S.DAY, S.SELLER, "items_count", "avg_price", "median_price", "categories_count",
    "pct_fbm", "pct_xd", "pct_ds", "pct_flex", "avg_discount_pct",
]


def since(df: DataFrame, day: str | None) -> DataFrame:
    """Rows from a day on (a date or a timestamp text, cut to its day); all without one."""
    return df if day is None else df.where(F.col(S.DAY) >= F.to_date(F.lit(day)))


def seller_daily_features(df: DataFrame, from_day: str | None = None) -> DataFrame:
    """Features per (day, seller). Listings without a seller form their own group."""
    return aggregate_with_quantiles(
        since(df, from_day),
        [S.DAY, S.SELLER],
        [
            F.count(F.lit(1)).alias("items_count"),
            F.avg(S.PRICE).alias("avg_price"),
            *[share(on_channel(c.upper())).alias(f"pct_{c}") for c in ("fbm", "xd", "ds", "flex")],
            F.coalesce(F.avg(discount_pct()), F.lit(0.0)).alias("avg_discount_pct"),
        ],
        {"median_price": (S.PRICE, 0.5)},
        {"categories_count": S.CATEGORY_ID},
    ).select(*DAILY_COLUMNS)


def approx_median_price(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Approximate median price per (day, seller) from mergeable summaries of fixed size."""
    return df.groupBy(S.DAY, S.SELLER).agg(
        F.count(F.lit(1)).alias("items_count"),
        F.percentile_approx(S.PRICE, 0.5, accuracy).alias("approx_median_price"),
    )


def _per_day(df: DataFrame) -> DataFrame:
    """Mergeable figures per seller and day; a seller's window then holds days, not listings."""
    return (
        df.where(F.col(S.SELLER).isNotNull() & F.col(S.DAY).isNotNull())
        .groupBy(S.SELLER, S.DAY)
        .agg(
            F.count(F.lit(1)).alias("_items"),
            F.sum(S.PRICE).alias("_price_sum"),
            F.count(S.PRICE).alias("_prices"),
            F.coalesce(F.sum(S.STOCK), F.lit(0)).alias("_stock"),
        )
    )


def _days_back(first: int, last: int):
    order = Window.partitionBy(S.SELLER).orderBy(F.unix_date(S.DAY))
    return order.rangeBetween(-first, -last)


def rolling_features(df: DataFrame, days: int) -> DataFrame:
    """Per seller and active day: items, active days, mean price and stock over the last ``days`` days."""
    window = _days_back(days - 1, 0)
    return _per_day(df).select(
        S.SELLER,
        S.DAY,
        F.sum("_items").over(window).alias(f"items_{days}d"),
        F.count(F.lit(1)).over(window).alias(f"active_days_{days}d"),
        F.try_divide(F.sum("_price_sum").over(window), F.sum("_prices").over(window)).alias(f"avg_price_{days}d"),
        F.sum("_stock").over(window).alias(f"stock_{days}d"),
    )


def items_trend(df: DataFrame, days: int = 30) -> DataFrame:
    """Per seller and active day: items of the last ``days`` days minus those of the ``days`` before."""
    recent = F.sum("_items").over(_days_back(days - 1, 0))
    earlier = F.coalesce(F.sum("_items").over(_days_back(2 * days - 1, days)), F.lit(0))
    return _per_day(df).select(S.SELLER, S.DAY, (recent - earlier).alias(f"trend_items_count_{days}d"))


def monthly_items(df: DataFrame) -> DataFrame:
    """Items per seller and month."""
    return (
        df.where(F.col(S.SELLER).isNotNull() & F.col(S.DAY).isNotNull())
        .groupBy(S.SELLER, F.date_trunc("month", S.DAY).cast("date").alias("month"))
        .agg(F.count(F.lit(1)).alias("items_count"))
    )


def cluster_history(assignments: DataFrame, period: str = "month") -> DataFrame:
    """Add each seller's previous cluster to assignments (seller, period, cluster)."""
    before = Window.partitionBy(S.SELLER).orderBy(period)
    return assignments.withColumn("previous_cluster", F.lag("cluster").over(before))


def cluster_migration(assignments: DataFrame, period: str = "month") -> DataFrame:
    """Moves between clusters: from, to, and how often; staying counts as a move to itself."""
    return (
        cluster_history(assignments, period)
        .where(F.col("previous_cluster").isNotNull())
        .groupBy("previous_cluster", "cluster")
        .agg(F.count(F.lit(1)).alias("moves"))
    )


def carried_numbers(before: DataFrame, after: DataFrame, key: str = S.SELLER) -> DataFrame:
    """``cluster`` of ``after``, the number it goes on under, and how many keys it shares with that cluster of ``before``.

    A cluster goes on as the one of ``before`` with which it shares most keys, if that
    one shares most with it too; ties go to the smallest number. Other clusters are new:
    they get the numbers after the largest of ``before``, in their order, and share null.
    Both tables have ``key`` and a whole-numbered ``cluster``; rows without either do not count.
    """
    last = before.agg(F.coalesce(F.max("cluster"), F.lit(-1)).alias("last")).scalar()
    shared = (
        before.select(key, F.col("cluster").alias("previous")).where(F.col("previous").isNotNull())
        .join(after.select(key, "cluster").where(F.col("cluster").isNotNull()), key)
        .groupBy("previous", "cluster").agg(F.count(F.lit(1)).alias("shared"))
    )
    # One row per pair of clusters from here on.
    forth = F.row_number().over(Window.partitionBy("previous").orderBy(F.desc("shared"), "cluster"))
    back = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("shared"), "previous"))
    mutual = shared.withColumn("_forth", forth).withColumn("_back", back).where("_forth = 1 AND _back = 1")
    known = after.select("cluster").where(F.col("cluster").isNotNull()).distinct()
    found = known.join(F.broadcast(mutual.select("cluster", "previous", "shared")), "cluster", "left")
    place = F.row_number().over(Window.partitionBy(F.col("previous").isNull()).orderBy("cluster"))
    return found.select("cluster", F.coalesce("previous", last + place).cast("long").alias("number"), "shared")


def carry_clusters(before: DataFrame, after: DataFrame, key: str = S.SELLER) -> DataFrame:
    """``after`` with its clusters numbered as in ``before``, so that a move between snapshots is no renumbering."""
    numbers = carried_numbers(before, after, key).select(F.col("cluster").alias("_cluster"), F.col("number").alias("_number"))
    # One row per cluster.
    joined = after.join(F.broadcast(numbers), F.col("cluster") == F.col("_cluster"), "left")
    return joined.withColumn("cluster", F.col("_number")).drop("_cluster", "_number")
