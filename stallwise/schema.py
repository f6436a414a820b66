"""Column names, schemas and the constants that results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

DAY = "tim_day"
SELLER = "seller_nickname"
TITLE = "titulo"
URL = "url"
PRICE = "price"
REGULAR_PRICE = "regular_price"
STOCK = "stock"
CATEGORY_ID = "category_id"
CATEGORY_NAME = "category_name"
REPUTATION = "seller_reputation"
CHANNEL = "logistic_type"

LISTING_SCHEMA = T.StructType(
    [
        T.StructField(DAY, T.DateType()),
        T.StructField(SELLER, T.StringType()),
        T.StructField(TITLE, T.StringType()),
        T.StructField(REPUTATION, T.StringType()),
        T.StructField(STOCK, T.LongType()),
        T.StructField(CHANNEL, T.StringType()),
        T.StructField("condition", T.StringType()),
        T.StructField("is_refurbished", T.BooleanType()),
        T.StructField(PRICE, T.DoubleType()),
        T.StructField(REGULAR_PRICE, T.DoubleType()),
        T.StructField("categoria", T.StringType()),
        T.StructField(URL, T.StringType()),
        T.StructField(CATEGORY_ID, T.StringType()),
        T.StructField(CATEGORY_NAME, T.StringType()),
    ]
)

NUMERIC_COLUMNS = [STOCK, PRICE, REGULAR_PRICE]

# --- Fixed values: results depend on them, so they are stated as given. -------

# Texts a CSV reader treats as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

TRUE_TOKENS = ["true", "1", "1.0"]
FALSE_TOKENS = ["false", "0", "0.0"]

# A price above this is a loading error.
MAX_PRICE = 1_000_000.0

# Seller reputation levels, worst to best.
REPUTATION_SCORES = {
    "red": 1,
    "orange": 2,
    "yellow": 3,
    "newbie": 4,
    "light_green": 5,
    "green": 6,
    "green_silver": 7,
    "green_gold": 8,
    "green_platinum": 9,
}
UNKNOWN_REPUTATION_SCORE = 4.0

# Features that receive a log1p copy.
LOG_COLUMNS = [
    "items_count", "unique_urls", "total_stock", "avg_stock", "median_stock",
    "avg_price", "median_price", "max_price",
]

# Features capped by winsorising.
WINSOR_COLUMNS = [
    "avg_price", "median_price", "max_price", "price_std", "items_count",
    "unique_urls", "total_stock", "avg_stock", "median_stock", "max_stock",
]

# Features the segmentation model sees.
MODEL_FEATURES = [
    "log_items_count", "log_total_stock", "log_avg_stock", "log_median_stock",
    "log_avg_price", "log_median_price", "pct_items_with_discount",
    "avg_discount_pct", "categories_count", "pct_fbm", "pct_xd", "pct_flex",
    "pct_ds", "pct_new", "pct_refurbished", "seller_reputation_score",
    "has_reputation",
]

# Columns averaged in a cluster profile.
PROFILE_COLUMNS = [
    "median_price", "items_count", "pct_fbm", "pct_xd", "pct_ds",
    "seller_reputation_score", "pct_items_with_discount", "categories_count",
]

REJECT_NO_SELLER = "seller_nickname_nulo"
REJECT_NO_URL = "url_nula"
REJECT_BAD_PRICE = "price_invalido"
REJECT_BAD_STOCK = "stock_negativo"

# --- End of fixed values. -----------------------------------------------------
