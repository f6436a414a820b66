"""Joining segments with business facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schema as S


def seller_facts(orders: DataFrame, seller: str, amount: str, cancelled: Column) -> DataFrame:
    """Order value, orders and cancelled share per seller, reduced before any join."""
    return (
        orders.where(F.col(seller).isNotNull())
        .groupBy(F.col(seller).alias("_seller"))
        .agg(
            F.sum(amount).alias("gmv"),
            F.count(F.lit(1)).alias("orders"),
            F.avg(cancelled.cast("double")).alias("cancel_rate"),
        )
    )


def visit_facts(events: DataFrame, seller: str, visited: Column, converted: Column) -> DataFrame:
    """Visits, conversions and their ratio per seller, reduced before any join."""
    return (
        events.where(F.col(seller).isNotNull())
        .groupBy(F.col(seller).alias("_visited"))
        .agg(F.count_if(visited).alias("visits"), F.count_if(converted).alias("conversions"))
        .select("_visited", F.try_divide("conversions", "visits").alias("conversion_rate"))
    )


def seller_strategy_mart(assignments: DataFrame, facts: DataFrame, visits: DataFrame, segments: DataFrame) -> DataFrame:
    """Cluster, facts, segment, priority and action per seller; sellers without facts stay.

    Every side has one row per seller, so the joins have no hot keys.
    """
    return (
        assignments.join(facts, F.col(S.SELLER) == F.col("_seller"), "left")
        .join(visits, F.col(S.SELLER) == F.col("_visited"), "left")
        .join(F.broadcast(segments), "cluster", "left")
        .select(
            S.SELLER, "cluster", "gmv", "orders", "cancel_rate", "conversion_rate",
            "segment_name", "priority", "recommended_action",
        )
    )


def margin_alerts(sellers: DataFrame, above: float = 0.4) -> DataFrame:
    """Sellers whose mean discount exceeds a limit."""
    return sellers.where(F.col("avg_discount_pct") > above)
