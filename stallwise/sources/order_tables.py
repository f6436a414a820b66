"""Listings derived from order tables (lineitem, orders, customer, part).

Every order line becomes a listing. The tables have no missing or bad values, so
the expressions turn some lines into such: all lines are kept. The same text
runs on other SQL engines, which lets results be compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.sources.staging import stage_once

ITEM_EXPRESSIONS = {
    "tim_day": "CAST(l_shipdate AS DATE)",
    "seller_nickname": "CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE c_name END",
    "titulo": "CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN '   ' ELSE p_name END",
    "seller_reputation": """CASE (o_custkey + CASE WHEN l_linenumber > 5 THEN 1 ELSE 0 END) % 11
        WHEN 0 THEN 'red' WHEN 1 THEN 'orange' WHEN 2 THEN 'yellow' WHEN 3 THEN 'newbie'
        WHEN 4 THEN 'light_green' WHEN 5 THEN 'green' WHEN 6 THEN 'green_silver'
        WHEN 7 THEN 'green_gold' WHEN 8 THEN 'green_platinum' WHEN 9 THEN 'unmapped_level' END""",
    "stock": "CASE WHEN l_orderkey % 307 = 0 THEN CAST(-1 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END",
    "logistic_type": """CASE o_orderpriority WHEN '1-URGENT' THEN 'FBM' WHEN '2-HIGH' THEN 'XD'
        WHEN '3-MEDIUM' THEN 'DS' WHEN '4-NOT SPECIFIED' THEN 'FLEX' END""",
    "condition": "CASE l_returnflag WHEN 'A' THEN 'new' WHEN 'R' THEN 'used' ELSE 'not_specified' END",
    "is_refurbished": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_linestatus = 'O' AND l_linenumber = 7 END",
    "price": """CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_orderkey % 401 = 0 THEN 0e0
        WHEN l_orderkey % 997 = 0 THEN l_extendedprice * 1e3 ELSE l_extendedprice END""",
    "regular_price": """CASE WHEN l_discount > 65e-3 THEN l_extendedprice * (1e0 + l_discount)
        WHEN l_discount > 55e-3 THEN l_extendedprice * 9e-1 END""",
    "categoria": "p_brand",
    "url": """CASE WHEN l_orderkey % 503 = 0 THEN NULL ELSE 'https://shop.example/' ||
        CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(20)) || '-' ||
        CAST(l_partkey AS VARCHAR(20)) || '-' || CAST(l_suppkey AS VARCHAR(20)) END""",
    "category_id": "CASE WHEN l_partkey % 67 = 0 THEN NULL WHEN l_partkey % 101 = 0 THEN p_type ELSE p_brand END",
    "category_name": "p_type",
}

# Listings that appear a second time where repeated rows are wanted.
REPEATED = "l_orderkey % 601 = 0"

# Column order of a listing table.
ITEM_COLUMNS = [
    "tim_day", "seller_nickname", "titulo", "seller_reputation", "stock", "logistic_type", "condition",
    "is_refurbished", "price", "regular_price", "categoria", "url", "category_id", "category_name",
]


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four tables joined; sizes decide the join strategies, nothing is hinted.

    Customers meet the orders first, so that order lines, the widest and longest
    table, move for two keys only.
    """
    table = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("lineitem", "orders", "customer", "part")}
    orders = table["orders"].join(table["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return (
        table["lineitem"]
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table["part"], F.col("l_partkey") == F.col("p_partkey"))
    )


def _as_items(joined: DataFrame) -> DataFrame:
    return joined.select(*[F.expr(ITEM_EXPRESSIONS[c]).alias(c) for c in ITEM_COLUMNS])


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a listing: a raw table, written once per application."""
    return stage_once(spark, f"items of {sf_dir}", lambda: _as_items(_joined(spark, sf_dir)))


def items_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings, some of them twice: written once per application, as looking for copies reads them several times."""
    again = F.when(F.expr(REPEATED), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return stage_once(
        spark, f"items with repeats of {sf_dir}", lambda: _as_items(_joined(spark, sf_dir).withColumn("_copy", F.explode(again)))
    )


# The listings as text, as a CSV file would hold them: missing values appear as
# various tokens and some numbers, days and flags cannot be read.
TEXT_EXPRESSIONS = {
    "tim_day": "CASE WHEN l_orderkey % 17 = 0 THEN 'some day' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR(20)) END",
    "seller_nickname": "CASE WHEN l_orderkey % 211 = 0 THEN 'N/A' ELSE c_name END",
    "titulo": "CASE WHEN l_partkey % 97 = 0 THEN '' WHEN l_partkey % 89 = 0 THEN 'a \"quoted\", title' ELSE p_name END",
    "seller_reputation": "CASE WHEN o_custkey % 11 = 0 THEN 'NULL' ELSE 'green' END",
    "stock": """CASE WHEN l_partkey % 59 = 0 THEN 'plenty' WHEN l_partkey % 61 = 0 THEN 'NaN'
        ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(20)) END""",
    "logistic_type": "CASE o_orderpriority WHEN '1-URGENT' THEN 'FBM' WHEN '2-HIGH' THEN 'XD' ELSE '<NA>' END",
    "condition": "CASE l_returnflag WHEN 'A' THEN 'new' WHEN 'R' THEN 'used' ELSE 'not_specified' END",
    "is_refurbished": """CASE WHEN l_partkey % 41 = 0 THEN 'perhaps' WHEN l_partkey % 5 = 0 THEN 'True'
        WHEN l_partkey % 5 = 1 THEN 'false' WHEN l_partkey % 5 = 2 THEN '1' WHEN l_partkey % 5 = 3 THEN '0' ELSE 'None' END""",
    "price": """CASE WHEN l_partkey % 53 = 0 THEN 'n/a' WHEN l_partkey % 47 = 0 THEN '12,5'
        ELSE CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS VARCHAR(20)) || 'e-2' END""",
    "regular_price": "CASE WHEN l_discount > 65e-3 THEN CAST(l_partkey AS VARCHAR(20)) ELSE 'nan' END",
    "categoria": "p_brand",
    "url": "CASE WHEN l_orderkey % 503 = 0 THEN '#N/A' ELSE 'https://shop.example/' || CAST(l_orderkey AS VARCHAR(20)) END",
    "category_id": "p_brand",
    "category_name": "p_type",
}


def text_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as an unread listing: all columns are text."""
    return _joined(spark, sf_dir).select(*[F.expr(TEXT_EXPRESSIONS[c]).alias(c) for c in ITEM_COLUMNS])
