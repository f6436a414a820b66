"""Describing a listing table: overview, columns, numbers, frequent values, grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise import schema as S
from stallwise.functions.columns import percent
from stallwise.functions.counts import distinct_per_key, size_summary, value_counts
from stallwise.functions.quantiles import column_quantiles, group_quantiles, unpivoted
from stallwise.operators.duplicates import duplicated_rows


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame, max_columns: int | None = None) -> list[str]:
    """Text and boolean columns, all of them unless a number is asked for."""
    kinds = (T.StringType, T.BooleanType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)][:max_columns]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows and exact duplicates (second and later copies, nulls equal)."""
    return df.agg(F.expr("count(1) AS rows")).select("rows", duplicated_rows(df).scalar().alias("duplicated_rows"))


def dataset_overview(df: DataFrame) -> DataFrame:
    """One row: size, exact duplicates, day range and distinct keys.

    Distinct counts move the different values of their columns, duplicates the
    rows that may have a copy; whole rows are not shuffled otherwise.
    """
    facts = [F.expr("count(1) AS rows"), F.lit(len(df.columns)).cast("bigint").alias("columns")]
    if S.DAY in df.columns:
        facts += [
            F.min(S.DAY).alias("min_tim_day"),
            F.max(S.DAY).alias("max_tim_day"),
            F.count_distinct(S.DAY).alias("distinct_tim_days"),
        ]
    for column, name in (
        (S.SELLER, "distinct_sellers"),
        (S.URL, "distinct_urls"),
        (S.CATEGORY_ID, "distinct_category_ids"),
        (S.CATEGORY_NAME, "distinct_category_names"),
    ):
        if column in df.columns:
            facts.append(F.count_distinct(column).alias(name))
    found = df.agg(*facts).withColumn("duplicated_rows", duplicated_rows(df).scalar())
    return found.select("rows", "columns", "duplicated_rows", *found.columns[2:-1])


def column_profile(df: DataFrame, samples: int = 5, exact: bool = True) -> DataFrame:
    """One row per column: type, nulls, distinct values and the smallest distinct values.

    All columns are profiled in one pass in long form, numbers and booleans as
    numbers: only texts, and types without a number, move as texts. Numbers are in
    numeric order, other values in the order of their texts; 0.0 and -0.0 are one
    value, and so are all NaN. ``exact=False`` estimates
    the distinct counts in a second, cheap pass and gives no sample values.
    """
    dtypes = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    if not exact:
        sketch = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[
                F.struct(
                    F.count_if(F.col(c).isNull()).alias("nulls"),
                    F.approx_count_distinct(c).alias("distinct"),
                ).alias(f"_{i}")
                for i, c in enumerate(df.columns)
            ],
        )
        cells = [
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}.nulls").alias("_nulls"), F.col(f"_{i}.distinct").alias("_distinct"))
            for i, c in enumerate(df.columns)
        ]
        found = sketch.select("_rows", F.inline(F.array(*cells)))
        return found.select("column", F.element_at(dtypes, F.col("column")).alias("dtype"), *_null_and_distinct())

    cells = [F.struct(F.lit(i).alias("_column"), *_typed(f)) for i, f in enumerate(df.schema)]
    key = ["_whole", "_real", "_text"]
    values = (
        df.select(F.inline(F.array(*cells)))
        .groupBy("_column", *key)
        .agg(F.count(F.lit(1)).alias("_records"))
        .withColumn("_null", F.expr("_whole IS NULL AND _real IS NULL AND _text IS NULL"))
    )
    totals = values.groupBy("_column").agg(
        F.sum("_records").alias("_rows"),
        F.sum(F.when(F.col("_null"), F.col("_records")).otherwise(0)).alias("_nulls"),
        F.count_if(~F.col("_null")).alias("_distinct"),
    )
    # Nulls go last rather than away before, and the counts stay, so that both
    # branches share one scan and shuffle. Each task passes on ``samples`` values a column.
    in_order = Window.partitionBy("_column").orderBy("_null", *key)
    smallest = (
        values.withColumn("_rank", F.row_number().over(in_order))
        .where((F.col("_rank") <= samples) & ~F.col("_null"))
        .groupBy(F.col("_column").alias("_of"))
        .agg(F.array_sort(F.collect_list(F.struct("_rank", _shown(df.schema).alias("_shown")))).alias("_samples"))
    )
    joined = totals.join(F.broadcast(smallest), F.col("_column") == F.col("_of"), "left")
    names = F.array(*[F.lit(c) for c in df.columns])
    kinds = F.array(*[F.lit(f.dataType.simpleString()) for f in df.schema])
    return joined.select(
        F.get(names, F.col("_column")).alias("column"),
        F.get(kinds, F.col("_column")).alias("dtype"),
        *_null_and_distinct(),
        F.coalesce(F.transform("_samples", lambda s: s["_shown"]), F.array().cast("array<string>")).alias("sample_values"),
    )


_WHOLE = (T.IntegralType, T.BooleanType)
_REAL = (T.FractionalType,)


def _typed(field: T.StructField) -> list[Column]:
    """A cell as a whole number, a double or a text; decimals are ordered as doubles and told apart as texts."""
    value, kind = F.col(f"`{field.name}`"), field.dataType
    whole, real = isinstance(kind, _WHOLE), isinstance(kind, _REAL)
    text = not whole and (not real or isinstance(kind, T.DecimalType))
    return [
        (value if whole else F.lit(None)).cast("long").alias("_whole"),
        (value if real else F.lit(None)).cast("double").alias("_real"),
        (value if text else F.lit(None)).cast("string").alias("_text"),
    ]


def _shown(columns: T.StructType) -> Column:
    """The text of a typed cell, as its column's type is written."""
    shown = F.col("_text")
    for i, f in enumerate(columns):
        if isinstance(f.dataType, _WHOLE):
            shown = F.when(F.col("_column") == i, F.col("_whole").cast(f.dataType).cast("string")).otherwise(shown)
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            shown = F.when(F.col("_column") == i, F.col("_real").cast(f.dataType).cast("string")).otherwise(shown)
    return shown


def _null_and_distinct() -> list[Column]:
    return [
        F.col("_nulls").alias("null_count"),
        percent(F.col("_nulls"), F.col("_rows")).alias("null_pct"),
        F.col("_distinct").alias("unique_count"),
        percent(F.col("_distinct"), F.col("_rows")).alias("unique_pct"),
    ]


def top_missing_columns(df: DataFrame, n: int = 15) -> DataFrame:
    """The columns with the largest share of nulls, from one scan without a shuffle of rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("null_count")) for i, c in enumerate(df.columns)]
    return (
        counts.select("_rows", F.inline(F.array(*cells)))
        .select("column", "null_count", percent(F.col("null_count"), F.col("_rows")).alias("null_pct"))
        .orderBy(F.desc("null_pct"), "column")
        .limit(n)
    )


PROFILE_PROBS = {"p1": 0.01, "p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def numeric_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, standard deviation, range and exact percentiles per numeric column."""
    columns = list(columns or numeric_columns(df))
    if not columns:
        raise ValueError("no numeric columns to profile")
    moments = (
        unpivoted(df, columns)
        .groupBy("column")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    spread = (
        column_quantiles(df, columns, list(PROFILE_PROBS.values()))
        .groupBy(F.col("column").alias("_column"))
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in PROFILE_PROBS.items()])
    )
    return moments.join(F.broadcast(spread), F.col("column") == F.col("_column"), "left").select(
        "column", "count", "mean", "std", "min", *PROFILE_PROBS, "max"
    )


def categorical_profile(df: DataFrame, max_columns: int | None = None, top_n: int = 10) -> DataFrame:
    """Most frequent values per text or boolean column; null is shown as ``<NULL>``.

    The limit per column is applied before the values meet in one task.
    """
    columns = categorical_columns(df, max_columns)
    counts = value_counts(df, {c: F.coalesce(F.col(c).cast("string"), F.lit("<NULL>")) for c in columns})
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("records"), "value"))
    rows = as_total(df)
    return (
        counts.withColumn("_rank", rank)
        .where(F.col("_rank") <= top_n)
        .select("column", "value", "records", percent(F.col("records"), rows).alias("pct"))
    )


def as_total(df: DataFrame) -> Column:
    """The number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).alias("_rows")).scalar()


def top_values(df: DataFrame, column: str = S.CATEGORY_NAME, n: int = 15) -> DataFrame:
    """The ``n`` most frequent non-null values of a column."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), column)
        .limit(n)
    )


def channel_mix(df: DataFrame, column: str = S.CHANNEL, missing: str = "Otro") -> DataFrame:
    """Listings per channel with their share; null counts as ``missing``."""
    return (
        df.groupBy(F.coalesce(F.col(column), F.lit(missing)).alias("channel"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select("channel", "records", percent(F.col("records"), as_total(df)).alias("pct"))
    )


def _known_sellers(df: DataFrame) -> DataFrame:
    return df.where(F.col(S.SELLER).isNotNull())


def rows_per_seller(df: DataFrame) -> DataFrame:
    return _known_sellers(df).groupBy(S.SELLER).agg(F.count(F.lit(1)).alias("n"))


def grain_rows(df: DataFrame) -> DataFrame:
    """Rows per seller: mean, median, max and sellers with a single row."""
    return size_summary(rows_per_seller(df), "n", [0.5]).select(
        F.col("mean").alias("avg_rows_per_seller"),
        F.col("quantiles")[0].alias("median_rows_per_seller"),
        F.col("max").alias("max_rows_per_seller"),
        F.col("singles").alias("sellers_with_one_row"),
    )


def grain_urls(df: DataFrame) -> DataFrame:
    """Distinct urls per seller: mean, median and max."""
    return size_summary(distinct_per_key(_known_sellers(df), S.SELLER, S.URL, "n"), "n", [0.5]).select(
        F.col("mean").alias("avg_unique_urls_per_seller"),
        F.col("quantiles")[0].alias("median_unique_urls_per_seller"),
        F.col("max").alias("max_unique_urls_per_seller"),
    )


def grain_days(df: DataFrame) -> DataFrame:
    """Distinct days per seller: mean and max."""
    return size_summary(distinct_per_key(_known_sellers(df), S.SELLER, S.DAY, "n"), "n", [0.5]).select(
        F.col("mean").alias("avg_days_per_seller"), F.col("max").alias("max_days_per_seller")
    )


def group_size_describe(df: DataFrame) -> DataFrame:
    """Count, mean, spread and quartiles of the rows per seller."""
    return size_summary(rows_per_seller(df), "n", [0.25, 0.5, 0.75]).select(
        F.col("groups").alias("count"),
        "mean",
        "std",
        F.col("min").cast("double").alias("min"),
        F.col("quantiles")[0].alias("p25"),
        F.col("quantiles")[1].alias("p50"),
        F.col("quantiles")[2].alias("p75"),
        F.col("max").cast("double").alias("max"),
    )


def seller_preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` sellers with most rows, with their catalogue in figures.

    The top is found from counts alone; the costly figures are then computed for
    those ``n`` sellers only, each of which may be very large.
    """
    top = F.broadcast(
        rows_per_seller(df).orderBy(F.desc("n"), S.SELLER).limit(n).select(F.col(S.SELLER).alias("_top"))
    )
    rows = df.join(top, F.col(S.SELLER) == F.col("_top"), "left_semi")
    figures = rows.groupBy(S.SELLER).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(S.URL).alias("unique_urls"),
        F.count_distinct(S.CATEGORY_NAME).alias("categories"),
        F.avg(S.PRICE).alias("avg_price"),
        F.coalesce(F.sum(S.STOCK), F.lit(0)).alias("total_stock"),
    )
    medians = F.broadcast(
        group_quantiles(rows, [S.SELLER], S.PRICE, [0.5]).select(
            F.col(S.SELLER).alias("_seller"), F.col("value").alias("median_price")
        )
    )
    return (
        figures.join(medians, F.col(S.SELLER) == F.col("_seller"), "left")
        .select(S.SELLER, "rows", "unique_urls", "categories", "avg_price", "median_price", "total_stock")
        .orderBy(F.desc("rows"), S.SELLER)
    )
