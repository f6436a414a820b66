import statistics

import pytest
from pyspark.sql import functions as F

from stallwise.functions.columns import differs, is_blank, log1p_from_zero
from stallwise.operators import audit, cleaning


def test_only_critical_rows_are_rejected_with_all_reasons(listings):
    df = listings(
        {"url": "ok"},
        {"url": "null price and stock are fine", "price": None, "stock": None},
        {"seller_nickname": None, "url": None, "price": 0.0, "stock": -1},
        {"url": "free", "price": -5.0},
        {"url": "stock", "stock": -2},
    )
    clean, rejected = cleaning.split_critical_errors(df)
    assert {r["url"] for r in clean.collect()} == {"ok", "null price and stock are fine"}
    assert {r["error_reason"] for r in rejected.collect()} == {
        "seller_nickname_nulo | url_nula | price_invalido | stock_negativo", "price_invalido", "stock_negativo",
    }
    assert clean.count() + rejected.count() == df.count()


def test_missing_columns_skip_their_rules(listings):
    clean, rejected = cleaning.split_critical_errors(listings({"stock": -1}, {}).drop("stock"))
    assert clean.count() == 2 and rejected.count() == 0


def test_unknown_prices_are_never_outliers(listings):
    df = listings({"price": None}, {"price": 1e6}, {"price": 1e6 + 1})
    kept, above = cleaning.split_price_above(df)
    assert sorted((r["price"] for r in kept.collect()), key=lambda p: p or 0) == [None, 1e6]
    assert [r["price"] for r in above.collect()] == [1e6 + 1]
    kept, above = cleaning.split_price_above_quantile(df, 0.5)
    assert (kept.count(), above.count()) == (2, 1)


def test_imputation_uses_category_then_table_and_keeps_known_prices(listings):
    df = listings(
        {"category_id": "a", "price": 1.0}, {"category_id": "a", "price": 3.0}, {"category_id": "a", "price": None},
        {"category_id": "empty", "price": None}, {"category_id": None, "price": None}, {"category_id": None, "price": 100.0},
    )
    found = sorted(((r["category_id"] or "-", r["price"]) for r in cleaning.impute_price(df).collect()))
    assert found == [("-", 3.0), ("-", 100.0), ("a", 1.0), ("a", 2.0), ("a", 3.0), ("empty", 3.0)]


def test_imputation_after_cleaning_spreads_no_outlier(listings):
    df = listings(*[{"category_id": "a", "price": p, "url": str(i)} for i, p in enumerate([10.0, 4e9, 5e9, None])])
    assert max(r["price"] for r in cleaning.clean_listings(df).collect()) == 10.0


def test_imputation_keeps_known_prices(listings):
    prices = [float(p) for p in (9, 2, 7, 7, 1, 30, 12, 4)]
    df = listings(*[{"category_id": "hot", "price": p} for p in prices], {"category_id": "hot", "price": None})
    filled = [r["price"] for r in cleaning.impute_price(df).collect()]
    assert sorted(filled) == sorted([*prices, statistics.median(prices)])


def test_audit_counts_and_order(listings):
    row = {"titulo": "x", "price": 5.0, "regular_price": 4.0, "categoria": None, "category_id": None}
    df = listings(row, row, row, {"titulo": " \t ", "price": None, "stock": -1, "categoria": "a", "category_id": "a"})
    found = audit.quality_audit(df).collect()
    by_problem = {r["problem"]: r["affected_rows"] for r in found}
    assert by_problem["Filas duplicadas exactas"] == 2
    assert by_problem["titulo vacio"] == 1
    assert by_problem["categoria distinta de category_id"] == 3
    assert by_problem["regular_price menor que price"] == 3
    assert by_problem["stock negativo"] == by_problem["price nulo"] == 1
    keys = [(-r["affected_rows"], r["problem"]) for r in found]
    assert keys == sorted(keys) and len(found) == 12
    assert {r["issue_type"] for r in audit.critical_checks(audit.quality_audit(df)).collect()} == {"error"}


def test_audit_takes_own_checks_and_skips_missing_columns(listings):
    own = audit.Check("cheap", ("price",), lambda: F.col("price") < 1, "error", "look")
    found = audit.quality_audit(listings({"price": 0.5}, {"price": 2.0}).drop("titulo"), [*audit.DEFAULT_CHECKS, own])
    counts = {r["problem"]: r["affected_rows"] for r in found.collect()}
    assert counts["cheap"] == 1 and "titulo vacio" not in counts


def test_audit_of_an_empty_table(listings):
    found = audit.quality_audit(listings({}).limit(0)).collect()
    assert len(found) == 12 and all(r["affected_rows"] == 0 and r["pct"] == 0 for r in found)


def test_null_rules(spark):
    row = spark.sql("select cast(null as string) a, cast(null as string) b, cast(null as double) x, -3d y, ' ' t")
    found = row.select(
        differs(F.col("a"), F.col("b")).alias("differs"), is_blank(F.col("t")).alias("blank"),
        log1p_from_zero(F.col("x")).alias("log_null"), log1p_from_zero(F.col("y")).alias("log_negative"),
    ).first()
    assert found["differs"] and found["blank"] and found["log_null"] is None and found["log_negative"] == 0.0


def test_outlier_summary_is_strict(listings):
    df = listings(*[{"price": float(p)} for p in range(1, 102)])
    line = {r["column"]: r for r in audit.outlier_summary(df).collect()}["price"]
    assert line["threshold"] == pytest.approx(100.0) and line["records_above_threshold"] == 1 and line["max"] == 101.0


def test_funnel_adds_up(listings):
    df = listings({"url": None}, {"price": 2e6}, {"price": None, "category_id": "a"}, {"category_id": "a"})
    rows = {r["stage"]: r["rows"] for r in cleaning.cleaning_funnel(df).collect()}
    assert rows == {"original": 4, "without_critical_errors": 3, "in_price_range": 2, "prices_imputed": 2}
