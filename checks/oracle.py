"""The queries in SQL, over views of the same tables."""

from __future__ import annotations

from itertools import combinations

from stallwise import schema as S
from stallwise.operators.audit import DEFAULT_CHECKS
from stallwise.operators.features import SELLER_FEATURES
from stallwise.operators.profile import PROFILE_PROBS
from checks.queries import SEGMENTS
from stallwise.sources.order_tables import ITEM_COLUMNS, ITEM_EXPRESSIONS, REPEATED, TEXT_EXPRESSIONS

ORACLE: dict[str, str] = {}

FROM = (
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey"
)
LOGS = [f"log_{c}" for c in S.LOG_COLUMNS]
NUMBERS = ["price", "regular_price"]


def rounded(column: str) -> str:
    return f"round({column} + 2e-7, 6)"


def columns(names: list[str], doubles: list[str] | tuple[str, ...] = ()) -> str:
    return ", ".join(f"{rounded(n)} AS {n}" if n in doubles else n for n in names)


def expressions(table: dict[str, str]) -> str:
    return ", ".join(f"{table[c]} AS {c}" for c in ITEM_COLUMNS)


# --- Common table expressions ---------------------------------------------------

ITEMS = f"items AS (SELECT {expressions(ITEM_EXPRESSIONS)} {FROM})"
REPEATS = (
    f"repeats AS (SELECT {expressions(ITEM_EXPRESSIONS)} {FROM} UNION ALL "
    f"SELECT {expressions(ITEM_EXPRESSIONS)} {FROM} WHERE {REPEATED})"
)
TEXTS = f"texts AS (SELECT {expressions(TEXT_EXPRESSIONS)} {FROM})"

REASONS = {
    "seller_nickname IS NULL": S.REJECT_NO_SELLER,
    "url IS NULL": S.REJECT_NO_URL,
    "price <= 0": S.REJECT_BAD_PRICE,
    "stock < 0": S.REJECT_BAD_STOCK,
}
REASON = "concat_ws(' | ', " + ", ".join(f"CASE WHEN {c} THEN '{r}' END" for c, r in REASONS.items()) + ")"
TAGGED = f"tagged AS (SELECT *, {REASON} AS error_reason FROM items)"
USABLE = f"usable AS (SELECT {', '.join(ITEM_COLUMNS)} FROM tagged WHERE error_reason = '')"
IN_RANGE = "in_range AS (SELECT * FROM usable WHERE price IS NULL OR price <= 1e6)"
IMPUTED = """medians AS (SELECT category_id AS c, median(price) AS m FROM in_range WHERE category_id IS NOT NULL GROUP BY 1),
imputed AS (SELECT i.* REPLACE (coalesce(price, m, (SELECT median(price) FROM in_range)) AS price)
  FROM in_range i LEFT JOIN medians ON category_id = c)"""
CLEAN = ", ".join([ITEMS, TAGGED, USABLE, IN_RANGE, IMPUTED])

SCORE = "CASE seller_reputation " + " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in S.REPUTATION_SCORES.items()) + " END"
DISCOUNTED = "coalesce(regular_price > price, false)"
DISCOUNT = f"CASE WHEN {DISCOUNTED} THEN (regular_price - price) / regular_price END"


def share(condition: str) -> str:
    return f"avg(CASE WHEN {condition} THEN 1e0 ELSE 0e0 END)"


def mode(table: str, key: str, column: str, name: str) -> str:
    """CTE with the most frequent value per key, ties to the smallest."""
    return f"""{name} AS (SELECT {key} AS k_{name}, {column} AS {name} FROM (
  SELECT {key}, {column}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {column}) AS r
  FROM {table} WHERE {column} IS NOT NULL GROUP BY {key}, {column}) WHERE r = 1)"""


def seller_ctes(table: str) -> str:
    return f"""{mode(table, 'seller_nickname', 'category_name', 'main_category')},
{mode(table, 'seller_nickname', 'seller_reputation', 'seller_reputation_main')},
scored_items AS (SELECT *, {SCORE} AS score, {DISCOUNT} AS discount FROM {table} WHERE seller_nickname IS NOT NULL),
figures AS (SELECT seller_nickname, count(*) AS items_count, count(DISTINCT url) AS unique_urls,
  CAST(coalesce(sum(stock), 0) AS BIGINT) AS total_stock, avg(stock) AS avg_stock, median(stock) AS median_stock,
  max(stock) AS max_stock, avg(price) AS avg_price, median(price) AS median_price, min(price) AS min_price,
  max(price) AS max_price, coalesce(stddev_samp(price), 0e0) AS price_std,
  {share('regular_price IS NOT NULL')} AS pct_items_with_regular_price,
  {share(DISCOUNTED)} AS pct_items_with_discount, coalesce(avg(discount), 0e0) AS avg_discount_pct,
  count(DISTINCT category_name) AS categories_count,
  {share("logistic_type = 'FBM'")} AS pct_fbm, {share("logistic_type = 'XD'")} AS pct_xd,
  {share("logistic_type = 'FLEX'")} AS pct_flex, {share("logistic_type = 'DS'")} AS pct_ds,
  {share("condition = 'new'")} AS pct_new,
  coalesce(avg(CASE WHEN is_refurbished THEN 1e0 WHEN NOT is_refurbished THEN 0e0 END), 0e0) AS pct_refurbished,
  median(score) AS raw_score FROM scored_items GROUP BY seller_nickname),
features AS (SELECT figures.* EXCLUDE (raw_score), main_category, seller_reputation_main,
  coalesce(raw_score, 4e0) AS seller_reputation_score,
  CASE WHEN raw_score IS NULL THEN 0 ELSE 1 END AS has_reputation
  FROM figures LEFT JOIN main_category ON seller_nickname = k_main_category
  LEFT JOIN seller_reputation_main ON seller_nickname = k_seller_reputation_main)"""


SELLER_DOUBLES = [
    c for c in SELLER_FEATURES
    if c not in ("seller_nickname", "items_count", "unique_urls", "total_stock", "max_stock", "categories_count",
                 "main_category", "seller_reputation_main", "has_reputation")
]
SELLERS = (
    f"{CLEAN}, {seller_ctes('imputed')}, sellers AS (SELECT *, "
    + ", ".join(f"ln(1 + greatest({c}, 0)) AS log_{c}" for c in S.LOG_COLUMNS)
    + " FROM features)"
)
LABELLED = f"""{SELLERS}, labelled AS (SELECT *, CAST(CASE WHEN items_count < 30 THEN 0 WHEN items_count < 36 THEN 1
  WHEN items_count < 42 THEN 2 WHEN items_count < 50 THEN 3 ELSE 4 END AS INTEGER) AS cluster FROM sellers)"""


def add(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = f"WITH {ctes} {body}"


# --- Sources ------------------------------------------------------------------------

TOKENS = ", ".join(f"'{t}'" for t in S.NA_TOKENS)
BARE = f"bare AS (SELECT {', '.join(f'CASE WHEN {c} NOT IN ({TOKENS}) THEN {c} END AS {c}' for c in ITEM_COLUMNS)} FROM texts)"


def number(column: str) -> str:
    return f"CASE WHEN NOT isnan(TRY_CAST({column} AS DOUBLE)) THEN TRY_CAST({column} AS DOUBLE) END"


COERCED = {
    "tim_day": "TRY_CAST(tim_day AS DATE)",
    "stock": f"CAST({number('stock')} AS BIGINT)",
    "price": number("price"),
    "regular_price": number("regular_price"),
    "is_refurbished": "CASE WHEN lower(is_refurbished) IN ('true', '1', '1.0') THEN true "
    "WHEN lower(is_refurbished) IN ('false', '0', '0.0') THEN false END",
}


def coerced(table: str) -> str:
    return f"typed AS (SELECT {', '.join(f'{COERCED.get(c, c)} AS {c}' for c in ITEM_COLUMNS)} FROM {table})"


add("normalize_nulls", f"{TEXTS}, {BARE}", "SELECT * FROM bare")
add("coerce_types", f"{TEXTS}, {coerced('texts')}", f"SELECT {columns(ITEM_COLUMNS, NUMBERS)} FROM typed")
add("scan_items", f"{TEXTS}, {BARE}, {coerced('bare')}", f"SELECT {columns(ITEM_COLUMNS, NUMBERS)} FROM typed")

# --- Predicates and cleaning -----------------------------------------------------------

ALL = columns(ITEM_COLUMNS, NUMBERS)
add("category_mismatch", ITEMS, f"SELECT {ALL} FROM items WHERE coalesce(categoria <> category_id, true)")
add("blank_title", ITEMS, f"SELECT {ALL} FROM items WHERE titulo IS NULL OR trim(titulo) = ''")
add("clean_items", f"{ITEMS}, {TAGGED}, {USABLE}", f"SELECT {ALL} FROM usable")
add("rejected_items", f"{ITEMS}, {TAGGED}", f"SELECT {ALL}, error_reason FROM tagged WHERE error_reason <> ''")
add(
    "price_quantile_outliers", ITEMS,
    f"SELECT {ALL} FROM items WHERE price > (SELECT quantile_cont(price, 99e-2) FROM items)",
)
add("price_abs_outliers", f"{ITEMS}, {TAGGED}, {USABLE}", f"SELECT {ALL} FROM usable WHERE price > 1e6")
add("price_in_range", f"{ITEMS}, {TAGGED}, {USABLE}, {IN_RANGE}", f"SELECT {ALL} FROM in_range")
add("impute_price", CLEAN, f"SELECT {ALL} FROM imputed")
add("dedup_items", REPEATS, f"SELECT DISTINCT {ALL} FROM repeats")


def funnel(step: int, stage: str, table: str) -> str:
    return (
        f"SELECT {step} AS step, '{stage}' AS stage, count(*) AS rows, "
        f"count(*) FILTER (WHERE price IS NULL) AS null_prices, {rounded('max(price)')} AS max_price FROM {table}"
    )


add(
    "cleaning_funnel", CLEAN,
    " UNION ALL ".join(
        funnel(i, stage, table)
        for i, (stage, table) in enumerate(
            [("original", "items"), ("without_critical_errors", "usable"), ("in_price_range", "in_range"), ("prices_imputed", "imputed")], 1
        )
    ),
)

# --- Profile and audit --------------------------------------------------------------------

COPIES = f"copies AS (SELECT {', '.join(ITEM_COLUMNS)}, count(*) AS n FROM repeats GROUP BY ALL)"
add(
    "duplicate_rows", f"{REPEATS}, {COPIES}",
    "SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicated_rows FROM copies",
)
add(
    "dataset_overview", f"{REPEATS}, {COPIES}",
    f"""SELECT count(*) AS rows, CAST({len(ITEM_COLUMNS)} AS BIGINT) AS columns,
  (SELECT CAST(sum(n - 1) AS BIGINT) FROM copies) AS duplicated_rows,
  min(tim_day) AS min_tim_day, max(tim_day) AS max_tim_day, count(DISTINCT tim_day) AS distinct_tim_days,
  count(DISTINCT seller_nickname) AS distinct_sellers, count(DISTINCT url) AS distinct_urls,
  count(DISTINCT category_id) AS distinct_category_ids, count(DISTINCT category_name) AS distinct_category_names
  FROM repeats""",
)

SQL_TYPES = {f.name: f.dataType.simpleString() for f in S.LISTING_SCHEMA}


def column_line(column: str) -> str:
    order = column if column in S.NUMERIC_COLUMNS else "NULL"
    return f"""SELECT '{column}' AS "column", '{SQL_TYPES[column]}' AS dtype,
  count(*) FILTER (WHERE {column} IS NULL) AS null_count,
  {rounded(f"count(*) FILTER (WHERE {column} IS NULL) * 100e0 / count(*)")} AS null_pct,
  count(DISTINCT {column}) AS unique_count, {rounded(f"count(DISTINCT {column}) * 100e0 / count(*)")} AS unique_pct,
  (SELECT string_agg(t, ' | ' ORDER BY o, t) FROM (SELECT DISTINCT CAST({column} AS VARCHAR) AS t, {order} AS o
    FROM items WHERE {column} IS NOT NULL ORDER BY o, t LIMIT 5)) AS sample_values FROM items"""


add("column_profile", ITEMS, " UNION ALL ".join(column_line(c) for c in ITEM_COLUMNS))


def numeric_line(column: str) -> str:
    percentiles = ", ".join(f"{rounded(f'quantile_cont({column}, {p})')} AS {n}" for n, p in PROFILE_PROBS.items())
    return f"""SELECT '{column}' AS "column", count({column}) AS count, {rounded(f"avg({column})")} AS mean,
  {rounded(f"stddev_samp({column})")} AS std, {rounded(f"CAST(min({column}) AS DOUBLE)")} AS min, {percentiles},
  {rounded(f"CAST(max({column}) AS DOUBLE)")} AS max FROM items"""


add("numeric_profile", ITEMS, " UNION ALL ".join(numeric_line(c) for c in S.NUMERIC_COLUMNS))

TEXT_COLUMNS = [c for c in ITEM_COLUMNS if SQL_TYPES[c] in ("string", "boolean")]
LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", coalesce(CAST({c} AS VARCHAR), '<NULL>') AS value FROM items" for c in TEXT_COLUMNS
) + ")"
add(
    "categorical_profile", f"{ITEMS}, {LONG}",
    f"""SELECT "column", value, records, {rounded("records * 100e0 / (SELECT count(*) FROM items)")} AS pct FROM (
  SELECT "column", value, count(*) AS records, row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) AS r
  FROM long GROUP BY "column", value) WHERE r <= 10""",
)
add(
    "top_missing_columns", ITEMS,
    f"SELECT \"column\", null_count, {rounded('null_pct')} AS null_pct FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"count(*) FILTER (WHERE {c} IS NULL) * 100e0 / count(*) AS null_pct FROM items"
        for c in ITEM_COLUMNS
    )
    + ') t ORDER BY t.null_pct DESC, "column" LIMIT 15',
)
add(
    "top_categories", ITEMS,
    "SELECT category_name, count(*) AS records FROM items WHERE category_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
)
add(
    "channel_mix", ITEMS,
    f"""SELECT coalesce(logistic_type, 'Otro') AS channel, count(*) AS records,
  {rounded("count(*) * 100e0 / (SELECT count(*) FROM items)")} AS pct FROM items GROUP BY 1""",
)

PER_SELLER = """per_seller AS (SELECT seller_nickname, count(*) AS n, count(DISTINCT url) AS urls,
  count(DISTINCT tim_day) AS days FROM items WHERE seller_nickname IS NOT NULL GROUP BY 1)"""
add(
    "grain_rows", f"{ITEMS}, {PER_SELLER}",
    f"""SELECT {rounded("avg(n)")} AS avg_rows_per_seller, {rounded("median(n)")} AS median_rows_per_seller,
  max(n) AS max_rows_per_seller, count(*) FILTER (WHERE n = 1) AS sellers_with_one_row FROM per_seller""",
)
add(
    "grain_urls", f"{ITEMS}, {PER_SELLER}",
    f"""SELECT {rounded("avg(urls)")} AS avg_unique_urls_per_seller, {rounded("median(urls)")} AS median_unique_urls_per_seller,
  max(urls) AS max_unique_urls_per_seller FROM per_seller""",
)
add(
    "grain_days", f"{ITEMS}, {PER_SELLER}",
    f"SELECT {rounded('avg(days)')} AS avg_days_per_seller, max(days) AS max_days_per_seller FROM per_seller",
)
add(
    "group_size_describe", f"{ITEMS}, {PER_SELLER}",
    f"""SELECT count(*) AS count, {rounded("avg(n)")} AS mean, {rounded("stddev_samp(n)")} AS std,
  {rounded("CAST(min(n) AS DOUBLE)")} AS min, {rounded("quantile_cont(n, 25e-2)")} AS p25,
  {rounded("quantile_cont(n, 5e-1)")} AS p50, {rounded("quantile_cont(n, 75e-2)")} AS p75,
  {rounded("CAST(max(n) AS DOUBLE)")} AS max FROM per_seller""",
)
add(
    "seller_preview", ITEMS,
    f"""SELECT seller_nickname, count(*) AS rows, count(DISTINCT url) AS unique_urls,
  count(DISTINCT category_name) AS categories, {rounded("avg(price)")} AS avg_price,
  {rounded("median(price)")} AS median_price, CAST(coalesce(sum(stock), 0) AS BIGINT) AS total_stock
  FROM items WHERE seller_nickname IS NOT NULL GROUP BY 1 ORDER BY rows DESC, seller_nickname LIMIT 20""",
)

CHECK_SQL = [
    None, "seller_nickname IS NULL", "url IS NULL", "seller_reputation IS NULL", "price IS NULL", "price <= 0",
    "regular_price IS NULL", "regular_price < price", "stock < 0", "titulo IS NULL OR trim(titulo) = ''",
    "condition = 'not_specified'", "coalesce(categoria <> category_id, true)",
]


def audit_sql(table: str) -> str:
    lines = []
    for check, condition in zip(DEFAULT_CHECKS, CHECK_SQL, strict=True):
        affected = f"count(*) FILTER (WHERE {condition})"
        if condition is None:
            affected = f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))"
        lines.append(
            f"SELECT '{check.problem}' AS problem, {affected} AS affected_rows, "
            f"{rounded(f'({affected}) * 100e0 / count(*)')} AS pct, '{check.issue_type}' AS issue_type, "
            f"'{check.treatment}' AS suggested_treatment FROM {table}"
        )
    return " UNION ALL ".join(lines)


add("quality_audit", REPEATS, audit_sql("repeats"))
add("critical_checks", ITEMS, f"SELECT * FROM ({audit_sql('items')}) WHERE issue_type = 'error'")


def outlier_line(column: str) -> str:
    cut = f"(SELECT quantile_cont({column}, 99e-2) FROM items)"
    above = f"count(*) FILTER (WHERE {column} > {cut})"
    return f"""SELECT '{column}' AS "column", {rounded(cut)} AS threshold, {above} AS records_above_threshold,
  {rounded(f"{above} * 100e0 / count(*)")} AS pct_above_threshold, {rounded(f"CAST(max({column}) AS DOUBLE)")} AS max FROM items"""


add("outlier_summary", ITEMS, " UNION ALL ".join(outlier_line(c) for c in S.NUMERIC_COLUMNS))
add(
    "threshold_sweep", ITEMS,
    " UNION ALL ".join(
        f"""SELECT {rounded(f"{p}e0")} AS quantile, {rounded("cut")} AS threshold,
  (SELECT count(*) FROM items WHERE price > cut) AS rows_removed FROM (SELECT quantile_cont(price, {p}) AS cut FROM items)"""
        for p in (0.99, 0.999, 0.9999)
    ),
)


def histogram_sql(values: str, edge: str) -> str:
    low, high = edge.format("lo + bin * w"), edge.format("lo + (bin + 1) * w")
    return f"""SELECT bin, {rounded(low)} AS low, {rounded(high)} AS high, coalesce(n, 0) AS records
  FROM (SELECT CAST(unnest(range(50)) AS INTEGER) AS bin) CROSS JOIN
  (SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM ({values}))
  LEFT JOIN (SELECT CAST(least(floor((x - lo) / w), 49) AS INTEGER) AS b, count(*) AS n FROM ({values}) CROSS JOIN
    (SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w FROM ({values})) GROUP BY 1) ON bin = b"""


add(
    "price_histogram", f"{ITEMS}, {TAGGED}, {USABLE}, {IN_RANGE}",
    histogram_sql("SELECT price AS x FROM in_range WHERE price IS NOT NULL", "{}"),
)
add(
    "price_log_histogram", ITEMS,
    histogram_sql("SELECT log10(greatest(price, 1e-2)) AS x FROM items WHERE price IS NOT NULL", "pow(1e1, {})"),
)

# --- Features ---------------------------------------------------------------------------------

add(
    "item_features", ITEMS,
    f"""SELECT {ALL}, regular_price IS NOT NULL AS has_regular_price, {DISCOUNTED} AS has_discount,
  {rounded(DISCOUNT)} AS discount_pct, {rounded(SCORE)} AS seller_reputation_score,
  {', '.join(f"coalesce(logistic_type = '{c.upper()}', false) AS is_{c}" for c in ('fbm', 'xd', 'flex', 'ds'))},
  coalesce(condition = 'new', false) AS is_new FROM items""",
)
add("reputation_score", ITEMS, f"SELECT seller_nickname, url, seller_reputation, {rounded(SCORE)} AS score FROM items")
add("seller_features", f"{CLEAN}, {seller_ctes('imputed')}", f"SELECT {columns(SELLER_FEATURES, SELLER_DOUBLES)} FROM features")
add(
    "main_category", f"{ITEMS}, {mode('items', 'seller_nickname', 'category_name', 'main_category')}",
    "SELECT k_main_category AS seller_nickname, main_category FROM main_category WHERE k_main_category IS NOT NULL",
)
MIX = "mix AS (SELECT seller_nickname, " + ", ".join(
    f"""{share(f"logistic_type = '{c.upper()}'")} AS pct_{c}""" for c in ("fbm", "xd", "flex", "ds")
) + " FROM items WHERE seller_nickname IS NOT NULL GROUP BY 1)"
SHARES = ["pct_fbm", "pct_xd", "pct_flex", "pct_ds"]
add("logistics_mix", f"{ITEMS}, {MIX}", f"SELECT {columns(['seller_nickname', *SHARES], SHARES)} FROM mix")
add(
    "dominant_channel", f"{ITEMS}, {MIX}",
    """SELECT seller_nickname, CASE WHEN pct_fbm >= pct_xd AND pct_fbm >= pct_ds THEN 'FBM'
  WHEN pct_xd >= pct_ds THEN 'XD' ELSE 'DS' END AS dominant_channel FROM mix""",
)
add("log_features", SELLERS, f"SELECT {columns(['seller_nickname', *LOGS], LOGS)} FROM sellers")
add(
    "winsorized_features", SELLERS,
    "SELECT seller_nickname, "
    + ", ".join(f"{rounded(f'CAST(CASE WHEN {c} > cap_{c} THEN cap_{c} ELSE {c} END AS DOUBLE)')} AS {c}" for c in S.WINSOR_COLUMNS)
    + " FROM sellers CROSS JOIN (SELECT "
    + ", ".join(f"quantile_cont({c}, 95e-2) AS cap_{c}" for c in S.WINSOR_COLUMNS)
    + " FROM sellers)",
)
add(
    "feature_checks", SELLERS,
    """SELECT 'pct_ds' AS "check", true AS passed UNION ALL SELECT 'has_reputation', true
  UNION ALL SELECT 'log_avg_price', true
  UNION ALL SELECT 'seller_reputation_score_from_1', min(seller_reputation_score) >= 1 FROM sellers""",
)
add(
    "long_tail_share", f"{ITEMS}, {PER_SELLER}",
    f"""SELECT count(*) FILTER (WHERE n <= 30) AS small_sellers, count(*) AS sellers,
  {rounded("count(*) FILTER (WHERE n <= 30) * 100e0 / count(*)")} AS pct FROM per_seller""",
)
add(
    "feature_correlation", SELLERS,
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {rounded(f'corr({a}, {b})')} AS correlation FROM sellers"
        for a, b in combinations(LOGS, 2)
    ),
)
add(
    "margin_alerts", f"{ITEMS}, {seller_ctes('items')}",
    f"SELECT seller_nickname, {rounded('avg_discount_pct')} AS avg_discount_pct FROM features WHERE avg_discount_pct > 8e-2",
)

# --- Daily features ---------------------------------------------------------------------------

DAYS = f"""days AS (SELECT tim_day, seller_nickname, count(*) AS items_count, avg(price) AS avg_price,
  median(price) AS median_price, count(DISTINCT category_id) AS categories_count,
  {', '.join(f'''{share(f"logistic_type = '{c.upper()}'")} AS pct_{c}''' for c in ('fbm', 'xd', 'ds', 'flex'))},
  coalesce(avg({DISCOUNT}), 0e0) AS avg_discount_pct FROM items GROUP BY 1, 2)"""
DAY_COLUMNS = ["tim_day", "seller_nickname", "items_count", "avg_price", "median_price", "categories_count",
               "pct_fbm", "pct_xd", "pct_ds", "pct_flex", "avg_discount_pct"]
DAY_DOUBLES = [c for c in DAY_COLUMNS if c.startswith(("avg", "median", "pct"))]
EVERY_DAY = f"SELECT {columns(DAY_COLUMNS, DAY_DOUBLES)} FROM days"
for name in ("seller_daily_features", "daily_features_refreshed", "daily_features_streamed"):
    add(name, f"{ITEMS}, {DAYS}", EVERY_DAY)
add("daily_features_since", f"{ITEMS}, {DAYS}", f"{EVERY_DAY} WHERE tim_day >= DATE '1998-06-15'")

# A summary of few values holds them all: the median is then the lower one of the middle.
add(
    "approx_median_price", ITEMS,
    f"""SELECT tim_day, seller_nickname, count(*) AS items_count, {rounded("quantile_disc(price, 5e-1)")} AS approx_median_price
  FROM items GROUP BY 1, 2""",
)

PER_DAY = """per_day AS (SELECT seller_nickname, tim_day, count(*) AS items, sum(price) AS price_sum, count(price) AS prices,
  coalesce(sum(stock), 0) AS stock FROM items WHERE seller_nickname IS NOT NULL AND tim_day IS NOT NULL GROUP BY 1, 2)"""


def back(expression: str, first: int, last: int) -> str:
    return (
        f"{expression} OVER (PARTITION BY seller_nickname ORDER BY tim_day "
        f"RANGE BETWEEN INTERVAL {first} DAY PRECEDING AND INTERVAL {last} DAY PRECEDING)"
    )


for n in (30, 90):
    price = f"{back('sum(price_sum)', n - 1, 0)} / nullif({back('sum(prices)', n - 1, 0)}, 0)"
    add(
        f"rolling_{n}d", f"{ITEMS}, {PER_DAY}",
        f"""SELECT seller_nickname, tim_day, CAST({back('sum(items)', n - 1, 0)} AS BIGINT) AS items_{n}d,
  {back('count(*)', n - 1, 0)} AS active_days_{n}d, {rounded(price)} AS avg_price_{n}d,
  CAST({back('sum(stock)', n - 1, 0)} AS BIGINT) AS stock_{n}d FROM per_day""",
    )
add(
    "trend_30d", f"{ITEMS}, {PER_DAY}",
    f"""SELECT seller_nickname, tim_day, CAST({back('sum(items)', 29, 0)} - coalesce({back('sum(items)', 59, 30)}, 0) AS BIGINT)
  AS trend_items_count_30d FROM per_day""",
)
add(
    "cluster_migration", ITEMS,
    """SELECT previous_cluster, cluster, count(*) AS moves FROM (
  SELECT cluster, lag(cluster) OVER (PARTITION BY seller_nickname ORDER BY month) AS previous_cluster FROM (
    SELECT seller_nickname, date_trunc('month', tim_day) AS month,
      CAST(CASE WHEN count(*) = 1 THEN 0 WHEN count(*) = 2 THEN 1 ELSE 2 END AS INTEGER) AS cluster
    FROM items WHERE seller_nickname IS NOT NULL AND tim_day IS NOT NULL GROUP BY 1, 2))
  WHERE previous_cluster IS NOT NULL GROUP BY 1, 2""",
)
add(
    "clusters_carried_over", f"""{ITEMS}, old AS (SELECT seller_nickname, least(count(*) // 20, 3) AS cluster FROM items
    WHERE seller_nickname IS NOT NULL AND tim_day < DATE '1998-06-15' GROUP BY 1),
  new AS (SELECT seller_nickname, 3 - least(count(*) // 20, 3) AS cluster FROM items
    WHERE seller_nickname IS NOT NULL GROUP BY 1),
  shared AS (SELECT old.cluster AS previous, new.cluster, count(*) AS n FROM old JOIN new USING (seller_nickname) GROUP BY 1, 2),
  best AS (SELECT *, row_number() OVER (PARTITION BY previous ORDER BY n DESC, cluster) AS forth,
    row_number() OVER (PARTITION BY cluster ORDER BY n DESC, previous) AS back FROM shared),
  known AS (SELECT cluster, previous FROM (SELECT DISTINCT cluster FROM new) LEFT JOIN
    (SELECT cluster, previous FROM best WHERE forth = 1 AND back = 1) USING (cluster)),
  numbers AS (SELECT cluster, coalesce(previous, (SELECT coalesce(max(cluster), -1) FROM old)
    + row_number() OVER (PARTITION BY previous IS NULL ORDER BY cluster)) AS number FROM known)""",
    """SELECT old.cluster AS previous_cluster, number AS cluster, count(*) AS moves
  FROM old JOIN new USING (seller_nickname) JOIN numbers ON numbers.cluster = new.cluster GROUP BY 1, 2""",
)

# --- Scaling ------------------------------------------------------------------------------------

add(
    "impute_features", f"{ITEMS}, {DAYS}",
    f"""SELECT tim_day, seller_nickname, {rounded("coalesce(avg_price, (SELECT median(avg_price) FROM days))")} AS avg_price,
  {rounded("coalesce(median_price, (SELECT median(median_price) FROM days))")} AS median_price FROM days""",
)
FILLED = "filled AS (SELECT s.seller_nickname, " + ", ".join(
    f"CAST(coalesce({f}, (SELECT median({f}) FROM labelled)) AS DOUBLE) AS {f}" for f in S.MODEL_FEATURES
) + ", s.cluster FROM labelled s)"


def scaled_cte(center: str, spread: str) -> str:
    fitted = ", ".join(f"{center.format(f)} AS c_{f}, {spread.format(f)} AS s_{f}" for f in S.MODEL_FEATURES)
    parts = ", ".join(f"({f} - c_{f}) / CASE WHEN s_{f} < 2.220446049250313e-15 THEN 1e0 ELSE s_{f} END AS {f}" for f in S.MODEL_FEATURES)
    return f"{FILLED}, scaled AS (SELECT seller_nickname, cluster, {parts} FROM filled CROSS JOIN (SELECT {fitted} FROM filled))"


ROBUST = scaled_cte("median({})", "(quantile_cont({0}, 75e-2) - quantile_cont({0}, 25e-2))")
STANDARD = scaled_cte("avg({})", "stddev_pop({})")
SCALED = columns(["seller_nickname", *S.MODEL_FEATURES], S.MODEL_FEATURES)
add("robust_scaled", f"{LABELLED}, {ROBUST}", f"SELECT {SCALED} FROM scaled")
add("standard_scaled", f"{LABELLED}, {STANDARD}", f"SELECT {SCALED} FROM scaled")

# --- Quality of a clustering ----------------------------------------------------------------------

COORDINATES = """coords AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS i
  FROM embeddings)"""
SUMS = f"""{COORDINATES},
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1),
sums AS (SELECT label, i, sum(x) AS s FROM coords GROUP BY 1, 2),
squares AS (SELECT label, sum(x * x) AS q FROM coords GROUP BY 1),
norms AS (SELECT vec_id, sum(x * x) AS xx FROM coords GROUP BY 1),
dots AS (SELECT vec_id, coords.label AS own, sums.label AS other, sum(x * s) AS xs
  FROM coords JOIN sums USING (i) GROUP BY 1, 2, 3)"""
COEFFICIENT = "CASE WHEN own_n = 1 OR greatest(a, b) = 0 THEN 0e0 ELSE (b - a) / greatest(a, b) END"
SILHOUETTE = f"""{SUMS},
parts AS (SELECT vec_id, own, other, n, n * xx + q - 2 * xs AS d FROM dots JOIN norms USING (vec_id)
  JOIN sizes ON other = sizes.label JOIN squares ON other = squares.label),
sil AS (SELECT vec_id, own AS cluster, {COEFFICIENT} AS sil_sample FROM (
  SELECT vec_id, own, max(CASE WHEN own = other THEN n END) AS own_n,
    max(CASE WHEN own = other AND n > 1 THEN d / (n - 1) END) AS a, min(CASE WHEN own <> other THEN d / n END) AS b
  FROM parts GROUP BY 1, 2))"""
SIL = f"SELECT vec_id, cluster, {rounded('sil_sample')} AS sil_sample FROM sil"
add(
    "kmeans_facts", SELLERS,
    "SELECT CAST(k AS INTEGER) AS k, (SELECT count(*) FROM sellers) AS sellers, k AS clusters, true AS nearest, true AS inertia_holds FROM range(2, 9) r(k)",
)
add(
    "segment_listings", SELLERS,
    """SELECT result, rows FROM (VALUES ('dataset_overview', 1), ('quality_audit', 12), ('outlier_summary', 3), ('cleaning_funnel', 4),
    ('feature_checks', 4), ('kmeans_evaluation', 2), ('cluster_metrics', 1), ('cluster_summary', 5), ('cluster_profile', 5),
    ('silhouette_by_cluster', 5), ('mean_cluster_silhouette', 1), ('segment_names', 5), ('cluster_payload_json', 5),
    ('run_metadata', 1)) r(result, rows)
  UNION ALL SELECT 'rejected_items', count(*) FROM items
    WHERE seller_nickname IS NULL OR url IS NULL OR price <= 0 OR stock < 0
  UNION ALL SELECT unnest(['seller_features', 'seller_clusters']), count(*) FROM sellers""",
)
add("silhouette_sq_samples", SILHOUETTE, SIL)
add("silhouette_sq", SILHOUETTE, f"SELECT {rounded('avg(sil_sample)')} AS silhouette FROM sil")
add(
    "silhouette_samples",
    f"""wide AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1),
totals AS (SELECT x.vec_id, x.label AS own, y.label AS other, sum(list_distance(x.e, y.e)) AS d FROM wide x, wide y GROUP BY 1, 2, 3),
sil AS (SELECT vec_id, own AS cluster, {COEFFICIENT} AS sil_sample FROM (
  SELECT vec_id, own, max(CASE WHEN own = other THEN n END) AS own_n,
    max(CASE WHEN own = other AND n > 1 THEN d / (n - 1) END) AS a, min(CASE WHEN own <> other THEN d / n END) AS b
  FROM totals JOIN sizes ON other = label GROUP BY 1, 2))""",
    SIL,
)
GEOMETRY = f"""{COORDINATES},
centers AS (SELECT label, i, avg(x) AS c FROM coords GROUP BY 1, 2),
gaps AS (SELECT vec_id, label, sum((x - c) * (x - c)) AS d2 FROM coords JOIN centers USING (label, i) GROUP BY 1, 2),
spread AS (SELECT label, count(*) AS n, avg(sqrt(d2)) AS s, sum(d2) AS w FROM gaps GROUP BY 1)"""
add(
    "davies_bouldin", GEOMETRY,
    f"""SELECT {rounded("avg(worst)")} AS davies_bouldin FROM (
  SELECT a.label, max(CASE WHEN apart > 0 THEN (a.s + b.s) / apart ELSE 0 END) AS worst FROM (
    SELECT x.label AS one, y.label AS two, sqrt(sum((x.c - y.c) * (x.c - y.c))) AS apart
    FROM centers x JOIN centers y ON x.i = y.i AND x.label <> y.label GROUP BY 1, 2)
  JOIN spread a ON one = a.label JOIN spread b ON two = b.label GROUP BY 1)""",
)
add(
    "calinski_harabasz", f"{GEOMETRY}, middle AS (SELECT i, avg(x) AS m FROM coords GROUP BY 1)",
    f"""SELECT {rounded("between_sum * (n - k) / (w * (k - 1))")} AS calinski_harabasz FROM
  (SELECT sum(n * (c - m) * (c - m)) AS between_sum FROM centers JOIN middle USING (i) JOIN spread USING (label)),
  (SELECT sum(n) AS n, count(*) AS k, sum(w) AS w FROM spread)""",
)
add(
    "cluster_max_pct", "sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)",
    f"SELECT {rounded('max(n) * 100e0 / sum(n)')} AS cluster_max_pct FROM sizes",
)

# --- Describing clusters --------------------------------------------------------------------------

MEANS = [f"avg_{f}" for f in S.MODEL_FEATURES]
add(
    "cluster_summary",
    f"{LABELLED}, {mode('labelled', 'cluster', 'main_category', 'category')}, {mode('labelled', 'cluster', 'seller_reputation_main', 'reputation')}",
    f"""SELECT labelled.cluster, count(DISTINCT seller_nickname) AS sellers, any_value(category) AS main_category,
  any_value(reputation) AS reputation, {', '.join(f"{rounded(f'avg({f})')} AS avg_{f}" for f in S.MODEL_FEATURES)},
  {rounded("count(DISTINCT seller_nickname) * 100e0 / (SELECT count(DISTINCT seller_nickname) FROM labelled)")} AS seller_share_pct
  FROM labelled LEFT JOIN category ON labelled.cluster = k_category LEFT JOIN reputation ON labelled.cluster = k_reputation GROUP BY 1""",
)
XX = " + ".join(f"{f} * {f}" for f in S.MODEL_FEATURES)
XS = " + ".join(f"{f} * sum_{f}" for f in S.MODEL_FEATURES)
SCORED = f"""{LABELLED}, {ROBUST},
totals AS (SELECT cluster AS other, count(*) AS n, sum({XX}) AS q, {', '.join(f'sum({f}) AS sum_{f}' for f in S.MODEL_FEATURES)}
  FROM scaled GROUP BY 1),
parts AS (SELECT seller_nickname AS seller, cluster AS own, other, n, n * ({XX}) + q - 2 * ({XS}) AS d FROM scaled CROSS JOIN totals),
sil AS (SELECT seller, {COEFFICIENT} AS sil_sample FROM (
  SELECT seller, own, max(CASE WHEN own = other THEN n END) AS own_n,
    max(CASE WHEN own = other AND n > 1 THEN d / (n - 1) END) AS a, min(CASE WHEN own <> other THEN d / n END) AS b
  FROM parts GROUP BY 1, 2)),
scored AS (SELECT labelled.*, sil_sample FROM labelled JOIN sil ON seller_nickname = seller)"""
add(
    "cluster_profile", SCORED,
    f"""SELECT cluster, {', '.join(f"{rounded(f'avg({c})')} AS {c}" for c in S.PROFILE_COLUMNS)}, count(*) AS sellers,
  {rounded("avg(sil_sample)")} AS sil, {rounded("count(*) * 100e0 / (SELECT count(*) FROM scored)")} AS pct FROM scored GROUP BY 1""",
)
add(
    "silhouette_by_cluster", SCORED,
    f"""SELECT cluster, {rounded("avg(sil_sample)")} AS sil_mean,
  {rounded(share("sil_sample > 0") + " * 100")} AS pct_well_placed FROM scored GROUP BY 1""",
)
add(
    "mean_cluster_silhouette", SCORED,
    f"SELECT {rounded('avg(s)')} AS mean_cluster_silhouette FROM (SELECT avg(sil_sample) AS s FROM scored GROUP BY cluster)",
)
add("cluster_sizes", LABELLED, "SELECT cluster, count(*) AS sellers FROM labelled GROUP BY 1")
add(
    "cluster_minmax",
    f"{LABELLED}, means AS (SELECT cluster, {', '.join(f'avg({c}) AS {c}' for c in S.PROFILE_COLUMNS)} FROM labelled GROUP BY 1)",
    "SELECT cluster, "
    + ", ".join(
        f"{rounded(f'({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9)')} AS {c}" for c in S.PROFILE_COLUMNS
    )
    + " FROM means",
)
add(
    "bubble_sizes", LABELLED,
    f"""SELECT cluster, n AS sellers, {rounded("pow(n / CAST(min(n) OVER () AS DOUBLE), 4e-1) * 120")} AS bubble_size
  FROM (SELECT cluster, count(*) AS n FROM labelled GROUP BY 1)""",
)
SEGMENT_ROWS = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in row) + ")" for row in SEGMENTS)
SEGMENT_TABLE = f"segments(c, segment_name, priority, churn_risk, recommended_action) AS (VALUES {SEGMENT_ROWS})"


def payload_mean(feature: str, name: str, digits: int) -> str:
    return f"{name} := " + (f"round(avg({feature}), {digits})" if feature in S.MODEL_FEATURES else "CAST(0 AS DOUBLE)")


PAYLOAD = ", ".join(
    [
        "cluster_id := cluster", "hint := coalesce(any_value(segment_name), '')", "sellers := count(DISTINCT seller_nickname)",
        "share_pct := round(count(DISTINCT seller_nickname) * 100e0 / (SELECT count(DISTINCT seller_nickname) FROM labelled), 2)",
        payload_mean("log_median_price", "avg_log_median_price", 3),
        payload_mean("pct_fbm", "avg_pct_fbm", 3),
        payload_mean("pct_ds", "avg_pct_ds", 3),
        payload_mean("seller_reputation_score", "avg_reputation", 2),
        payload_mean("pct_items_with_discount", "avg_pct_discount", 3),
    ]
)
add(
    "cluster_payload_json", f"{LABELLED}, {SEGMENT_TABLE}",
    f"""SELECT cluster, CAST(to_json(struct_pack({PAYLOAD})) AS VARCHAR) AS payload
  FROM labelled LEFT JOIN segments ON c = cluster GROUP BY cluster""",
)
add(
    "segment_names", f"{LABELLED}, {SEGMENT_TABLE}",
    """SELECT cluster, count(*) AS sellers, segment_name, priority, churn_risk, recommended_action,
  trim(split_part(segment_name, '—', 1)) AS short_name FROM labelled LEFT JOIN segments ON cluster = c GROUP BY ALL""",
)
add(
    "seller_strategy_mart",
    f"""{LABELLED}, {SEGMENT_TABLE},
facts AS (SELECT o_custkey, sum(o_totalprice) AS gmv, count(*) AS orders, {share("o_orderstatus = 'F'")} AS cancel_rate
  FROM orders GROUP BY 1),
visits AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') * 1e0
  / nullif(count(*) FILTER (WHERE event_type = 'view'), 0) AS conversion_rate FROM events GROUP BY 1)""",
    f"""SELECT seller_nickname, cluster, {rounded("gmv")} AS gmv, facts.orders AS orders, {rounded("cancel_rate")} AS cancel_rate,
  {rounded("conversion_rate")} AS conversion_rate, segment_name, priority, recommended_action
  FROM labelled LEFT JOIN customer ON seller_nickname = c_name LEFT JOIN facts ON c_custkey = o_custkey
  LEFT JOIN visits ON c_custkey = user_id LEFT JOIN segments ON cluster = c""",
)
