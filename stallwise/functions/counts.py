"""Distinct counts and modes in two steps, so that one hot key is shared by many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_per_key(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Distinct non-null values of ``column`` per key, zero included.

    The first step groups on (key, value) and spreads a hot key over its values;
    the second adds up partial counts.
    """
    return df.select(key, column).distinct().groupBy(key).agg(F.count(column).alias(name))


def value_counts(df: DataFrame, columns: dict[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Rows per (keys, ``column``, ``value``) for text columns, in one pass."""
    cells = [F.struct(F.lit(n).alias("column"), c.cast("string").alias("value")) for n, c in columns.items()]
    return df.select(*keys, F.inline(F.array(*cells))).groupBy(*keys, "column", "value").agg(
        F.count(F.lit(1)).alias("records")
    )


def most_frequent(condition: Column, value: Column, records: Column) -> Column:
    """Aggregate over value counts: the mode, nulls ignored, ties to the smallest value."""
    best = F.min(F.when(condition & value.isNotNull(), F.struct((-records).alias("n"), value.alias("v"))))
    return best["v"]


def size_summary(sizes: DataFrame, column: str, probs: Sequence[float]) -> DataFrame:
    """One row about group sizes: n, mean, std, min, max, quantiles and single-row groups.

    Sizes are first counted by size: sizes that add up to N rows have at most
    sqrt(2N) different values, so the exact percentile over them is small.
    """
    by_size = sizes.groupBy(F.col(column).alias("_size")).agg(F.count(F.lit(1)).alias("_groups"))
    size, groups = F.col("_size").cast("double"), F.col("_groups")
    total = F.sum(groups)
    mean = F.sum(size * groups) / total
    spread = F.sum(size * size * groups) - F.sum(size * groups) * F.sum(size * groups) / total
    return by_size.agg(
        F.coalesce(total, F.lit(0)).alias("groups"),
        F.try_divide(F.sum(size * groups), total).alias("mean"),
        F.when(total > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (total - 1))).alias("std"),
        F.min("_size").alias("min"),
        F.max("_size").alias("max"),
        F.percentile(F.col("_size"), F.array(*[F.lit(float(p)) for p in probs]), F.col("_groups")).alias("quantiles"),
        F.coalesce(F.sum(F.when(F.col("_size") == 1, groups)), F.lit(0)).alias("singles"),
    )
