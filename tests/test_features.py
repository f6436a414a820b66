import math

import pytest
from pyspark.sql import functions as F

from stallwise import schema as S
from stallwise.operators import features, scaling
from stallwise.plans.segmentation import seller_table


def by_seller(df):
    return {r["seller_nickname"]: r.asDict() for r in df.collect()}


@pytest.fixture()
def shop(listings):
    return listings(
        {"seller_nickname": "one", "url": "1", "stock": None, "price": 10.0, "is_refurbished": None},
        {"seller_nickname": "two", "url": "2", "price": 8.0, "regular_price": 10.0, "logistic_type": "FBM",
         "category_name": "b", "seller_reputation": "green", "is_refurbished": True},
        {"seller_nickname": "two", "url": "2", "price": 10.0, "regular_price": 9.0, "category_name": "a",
         "seller_reputation": "red", "is_refurbished": None, "condition": None},
        {"seller_nickname": "two", "url": "3", "price": None, "regular_price": 9.0, "logistic_type": "XD",
         "seller_reputation": "no such level"},
        {"seller_nickname": None, "url": "4"},
    )


def test_seller_features_follow_the_null_rules(shop):
    found = by_seller(features.seller_features(shop))
    assert set(found) == {"one", "two"}
    one, two = found["one"], found["two"]
    assert (one["total_stock"], one["avg_stock"], one["price_std"]) == (0, None, 0.0)
    assert (one["pct_refurbished"], one["avg_discount_pct"], one["main_category"]) == (0.0, 0.0, None)
    assert (one["has_reputation"], one["seller_reputation_score"]) == (0, 4.0)
    assert (two["items_count"], two["unique_urls"], two["categories_count"]) == (3, 2, 2)
    assert two["main_category"] == "a" and two["seller_reputation_main"] == "green"
    assert (two["has_reputation"], two["seller_reputation_score"]) == (1, 3.5)
    assert two["pct_refurbished"] == 1.0
    assert two["pct_items_with_discount"] == pytest.approx(1 / 3) and two["avg_discount_pct"] == pytest.approx(0.2)
    assert two["pct_fbm"] == pytest.approx(1 / 3) and two["pct_new"] == pytest.approx(2 / 3)
    assert two["price_std"] == pytest.approx(math.sqrt(2)) and two["median_price"] == 9.0
    assert list(one) == features.SELLER_FEATURES


def test_log_features_of_null_and_negative(spark):
    df = spark.createDataFrame([(None, -4.0), (3.0, 0.0)], "avg_price double, avg_stock double")
    rows = features.log_features(df).select("log_avg_price", "log_avg_stock").collect()
    assert [tuple(r) for r in rows] == [(None, 0.0), (pytest.approx(math.log(4)), 0.0)]
    assert "log_max_price" not in features.log_features(df).columns


def test_winsorizing_keeps_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "avg_price double")
    found = [r[0] for r in features.winsorized_features(df).collect()]
    assert max(v for v in found if v is not None) == 95.0 and found.count(None) == 1


def test_robust_scaling_divides_zero_spread_by_one(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 9.0), (10.0, 5.0)], "a double, b double")
    rows = scaling.scaled_features(df, ["a", "b"]).collect()
    # a after filling: 1 2 2.5 3 10, median 2.5, quartiles 2 and 3; b: median 5, no spread
    assert [tuple(r) for r in rows] == [(-1.5, 0.0), (-0.5, 0.0), (0.5, 0.0), (0.0, 4.0), (7.5, 0.0)]


def test_standard_scaling_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    assert [r[0] for r in scaling.scaled_features(df, ["a"], "standard").collect()] == [-1.0, 1.0]


def test_scaler_survives_a_table(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 9.0), (5.0, 4.0)], "a double, b double")
    fitted = scaling.fit_scaler(df, ["a", "b"])
    assert scaling.FittedScaler.from_table(fitted.table(spark)) == fitted


def test_unusable_input_is_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(ValueError, match="scaler"):
        scaling.fit_scaler(df, ["a"], "other")
    with pytest.raises(ValueError, match="feature"):
        scaling.model_features(df)
    with pytest.raises(ValueError, match="b"):
        scaling.fit_scaler(df, ["a", "b"])


def test_default_features_and_checks(shop):
    table = seller_table(shop)
    assert scaling.model_features(table) == S.MODEL_FEATURES and len(S.MODEL_FEATURES) == 17
    assert all(r["passed"] for r in features.feature_checks(table).collect())
    assert table.where(" or ".join(f"isnan({c})" for c, t in table.dtypes if t == "double")).count() == 0
    shares = features.logistics_mix(shop).select((F.col("pct_fbm") + F.col("pct_xd") + F.col("pct_flex") + F.col("pct_ds")).alias("s"))
    assert all(0 <= r["s"] <= 1 for r in shares.collect())


def test_dominant_channel_ties_go_to_the_earlier(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.0), (0.0, 0.4, 0.4), (0.1, 0.2, 0.7)], "pct_fbm double, pct_xd double, pct_ds double")
    assert [r["dominant_channel"] for r in features.dominant_channel(df).collect()] == ["FBM", "XD", "DS"]
