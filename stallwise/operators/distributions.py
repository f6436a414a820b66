"""Histograms: the numbers behind distribution charts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schema as S
from stallwise.functions.quantiles import with_row


def _histogram(values: DataFrame, bins: int, edge: Callable[[Column], Column]) -> DataFrame:
    """Rows per equal-width bin of ``x``; the last bin includes the maximum."""
    span = values.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    low, width = F.col("_span.low"), (F.col("_span.high") - F.col("_span.low")) / bins
    position = F.coalesce(F.try_divide(F.col("x") - low, width), F.lit(0.0))
    number = F.least(F.floor(position), F.lit(bins - 1)).cast("int")
    counts = with_row(values, "_span", span).groupBy(number.alias("_bin")).agg(F.count(F.lit(1)).alias("_records"))
    every = with_row(values.sparkSession.range(bins), "_span", span).select(F.col("id").cast("int").alias("bin"), "_span")
    return (
        every.join(F.broadcast(counts), F.col("bin") == F.col("_bin"), "left")
        .select(
            "bin",
            edge(low + F.col("bin") * width).alias("low"),
            edge(low + (F.col("bin") + 1) * width).alias("high"),
            F.coalesce("_records", F.lit(0)).alias("records"),
        )
        .orderBy("bin")
    )


def histogram(df: DataFrame, column: str = S.PRICE, bins: int = 50) -> DataFrame:
    """Equal-width histogram of the known values of a column."""
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    return _histogram(values, bins, lambda x: x)


def log_histogram(df: DataFrame, column: str = S.PRICE, bins: int = 50, floor: float = 0.01) -> DataFrame:
    """Histogram with bins of equal width in log10; values below ``floor`` count as it."""
    value: Column = F.col(column).cast("double")
    raised = F.when(value < floor, F.lit(floor)).otherwise(value)
    values = df.where(F.col(column).isNotNull()).select(F.log10(raised).alias("x"))
    return _histogram(values, bins, lambda x: F.pow(F.lit(10.0), x))
