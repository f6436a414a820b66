"""Splitting off unusable rows and filling missing prices.

Order matters: critical errors, then absolute price outliers, then imputation,
so that loading errors never reach the medians.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schema as S
from stallwise.functions.columns import holds
from stallwise.functions.quantiles import FEW, quantile_row, quantiles_by_key
from stallwise.operators.duplicates import without_duplicates
from stallwise.sources.staging import stage


# Per column: what makes a listing unusable, the opposite, and the reason given.
# Stated both ways so that filters reach the file scan as they are.
CRITICAL_RULES = {
    S.SELLER: (f"{S.SELLER} IS NULL", f"{S.SELLER} IS NOT NULL", S.REJECT_NO_SELLER),
    S.URL: (f"{S.URL} IS NULL", f"{S.URL} IS NOT NULL", S.REJECT_NO_URL),
    S.PRICE: (f"{S.PRICE} <= 0", f"({S.PRICE} IS NULL OR {S.PRICE} > 0)", S.REJECT_BAD_PRICE),
    S.STOCK: (f"{S.STOCK} < 0", f"({S.STOCK} IS NULL OR {S.STOCK} >= 0)", S.REJECT_BAD_STOCK),
}


def _rules(df: DataFrame) -> list[tuple[str, str, str]]:
    return [rule for column, rule in CRITICAL_RULES.items() if column in df.columns]


def usable(df: DataFrame) -> Column:
    """Whether a listing breaks no critical rule. Missing prices and stocks break none."""
    return F.expr(" AND ".join([good for _, good, _ in _rules(df)]) or "true")


def reject_reason(df: DataFrame) -> Column:
    """The broken rules joined by `` | ``; empty if there are none."""
    return F.concat_ws(" | ", *[F.when(F.expr(bad), F.lit(reason)) for bad, _, reason in _rules(df)])


def split_critical_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows with ``error_reason``); together they are the input."""
    broken = F.expr(" OR ".join([bad for bad, _, _ in _rules(df)]) or "false")
    return df.where(usable(df)), df.where(broken).withColumn("error_reason", reject_reason(df))


def _split_above(df: DataFrame, limit: Column) -> tuple[DataFrame, DataFrame]:
    price = F.col(S.PRICE)
    return df.where(price.isNull() | (price <= limit)), df.where(price > limit)


def split_price_above(df: DataFrame, threshold: float = S.MAX_PRICE) -> tuple[DataFrame, DataFrame]:
    """(rows in range, rows priced above an absolute threshold); unknown prices are in range."""
    if S.PRICE not in df.columns:
        return df, df.limit(0)
    return _split_above(df, F.lit(float(threshold)))


def split_price_above_quantile(df: DataFrame, upper_quantile: float = 0.99) -> tuple[DataFrame, DataFrame]:
    """(rows in range, rows priced above a quantile of the prices)."""
    if S.PRICE not in df.columns:
        return df, df.limit(0)
    return _split_above(df, quantile_row(df, {"limit": (S.PRICE, upper_quantile)}).scalar())


def category_medians(df: DataFrame, category: str = S.CATEGORY_ID) -> DataFrame:
    """Median price per known category: ``category``, ``median``. Categories are counted first, up to ``FEW``."""
    known = df.where(F.col(category).isNotNull())
    few = known.select(category).distinct().limit(FEW + 1).count() <= FEW
    return quantiles_by_key(known, [category], {"median": (S.PRICE, 0.5)}, few)


def impute_price(df: DataFrame, category: str = S.CATEGORY_ID) -> DataFrame:
    """Fill missing prices with the category's median, else with the overall median.

    Only rows without a price meet the medians; all others pass as they are read. So
    what is joined, and shuffled if the medians are many, are the missing prices. The
    medians are written when this is called, so that later work does not find them anew.
    """
    if S.PRICE not in df.columns or category not in df.columns:
        return df
    known, missing = df.where(F.col(S.PRICE).isNotNull()), df.where(F.col(S.PRICE).isNull())
    medians = category_medians(known, category).withColumn("is_overall", F.lit(False))
    overall = quantile_row(known, {"median": (S.PRICE, 0.5)}).select(F.lit(None).cast("string").alias(category), "median", F.lit(True).alias("is_overall"))
    medians = stage(medians.unionByName(overall), "medians")
    lookup = medians.where("NOT is_overall").select(F.col(category).alias("_category"), F.col("median").alias("_median"))
    filled = (
        missing.join(lookup, F.col(category) == F.col("_category"), "left")
        .withColumn(S.PRICE, F.coalesce("_median", medians.where("is_overall").select("median").scalar()))
        .select(*df.columns)
    )
    return known.unionByName(filled)


def clean_listings(df: DataFrame, max_price: float = S.MAX_PRICE) -> DataFrame:
    """The canonical cleaning chain: usable rows in price range, prices imputed."""
    kept, _ = split_critical_errors(df)
    in_range, _ = split_price_above(kept, max_price)
    return impute_price(in_range)


def deduplicate(df: DataFrame) -> DataFrame:
    """Drop exact repeats. Advised by the audit, never applied on its own."""
    return without_duplicates(df)


def cleaning_funnel(df: DataFrame, max_price: float = S.MAX_PRICE) -> DataFrame:
    """Rows, missing prices and highest price after every cleaning step, from two scans."""
    fine = usable(df)
    in_range = fine & ~holds(F.col(S.PRICE) > float(max_price))
    steps = [("original", F.lit(True)), ("without_critical_errors", fine), ("in_price_range", in_range)]
    counted = df.agg(
        *[
            F.struct(
                F.lit(i).alias("step"),
                F.lit(name).alias("stage"),
                F.count_if(kept).alias("rows"),
                F.count_if(kept & F.col(S.PRICE).isNull()).alias("null_prices"),
                F.max(F.when(kept, F.col(S.PRICE))).alias("max_price"),
            ).alias(f"_{i}")
            for i, (name, kept) in enumerate(steps, 1)
        ]
    )
    before = counted.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(1, len(steps) + 1)])))
    after = clean_listings(df, max_price).agg(
        F.lit(len(steps) + 1).alias("step"),
        F.lit("prices_imputed").alias("stage"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(S.PRICE).isNull()).alias("null_prices"),
        F.max(S.PRICE).alias("max_price"),
    )
    return before.unionByName(after)
