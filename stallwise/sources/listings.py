"""Reading listing snapshots and giving them their types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise import schema as S


# Decimal numbers: no type suffixes, no hexadecimal digits.
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def read_listings_csv(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """Read a headed CSV snapshot as typed listings.

    Columns are matched by the file's own header, so a file with fewer, more or
    reordered columns is read as it is; nothing is inferred from the data.
    ``columns`` names them beforehand and saves the look at the header. Large files
    are read by many tasks; ``multi_line=True`` is for files with line breaks inside
    quoted texts and makes each file one task. A row with more or fewer fields
    than the header is an error, whatever columns are asked for.
    """
    names = list(columns) if columns else _csv_header(spark, path)
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        # Rows are looked at whole, whatever columns are asked for.
        .option("columnPruning", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    return coerce_types(normalize_nulls(raw))


def _csv_header(spark: SparkSession, path: str) -> list[str]:
    try:
        return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path).columns
    except AnalysisException as missing:
        raise ValueError(f"no listings at {path}") from missing


def read_listings_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        return drop_nan(spark.read.parquet(path))
    except AnalysisException as missing:
        raise ValueError(f"no listings at {path}") from missing


def normalize_nulls(df: DataFrame) -> DataFrame:
    """Turn the usual missing-value texts of string columns into null."""
    return df.withColumns(
        {
            f.name: F.when(~F.col(f.name).isin(S.NA_TOKENS), F.col(f.name))
            for f in df.schema
            if isinstance(f.dataType, T.StringType)
        }
    )


def drop_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into null: the library knows one kind of missing value."""
    fractions = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in fractions})


def number(column: str) -> Column:
    """The column as a double; text that is no finite decimal number, and NaN, become null."""
    text = F.trim(F.col(column).cast("string"))
    value = F.when(text.rlike(DECIMAL), text.try_cast("double"))
    return F.when(F.abs(value) < float("inf"), value)


def flag(column: str) -> Column:
    """Text or number as a boolean; anything else becomes null."""
    text = F.lower(F.col(column).cast("string"))
    return F.when(text.isin(S.TRUE_TOKENS), True).when(text.isin(S.FALSE_TOKENS), False)


def coerce_types(df: DataFrame) -> DataFrame:
    """Give the known listing columns their types; bad values become null."""
    typed = {}
    if S.DAY in df.columns:
        typed[S.DAY] = F.try_to_timestamp(F.col(S.DAY).cast("string")).cast("date")
    for column in (S.PRICE, S.REGULAR_PRICE):
        if column in df.columns:
            typed[column] = number(column)
    if S.STOCK in df.columns:
        # A fraction of an item is no stock: null, not cut to a whole number.
        stock = number(S.STOCK)
        typed[S.STOCK] = F.when(stock == F.floor(stock), stock.try_cast("bigint"))
    if "is_refurbished" in df.columns:
        typed["is_refurbished"] = flag("is_refurbished")
    return df.withColumns(typed)
