"""Groups that fit a task are aggregated there; the results are those of the way for large groups."""

import re

import pytest
from pyspark.sql import functions as F

from stallwise.functions import quantiles as Q
from stallwise.operators import cleaning, daily, features, metrics
from stallwise.sources import order_tables


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def some_listings(listings):
    rows = [
        {
            "seller_nickname": None if i % 31 == 0 else f"s{i % 7 if i % 3 else 0}",
            "tim_day": None,
            "url": None if i % 11 == 0 else f"u{i % 23}",
            "category_name": None if i % 13 == 0 else f"c{i % 4}",
            "category_id": None if i % 13 == 0 else f"c{i % 5}",
            "seller_reputation": ["red", "green", None, "unmapped_level", "orange"][i % 5],
            "price": [None, float("nan"), -0.0, 0.0, 5.0, 0.1 + i][i % 6],
            "regular_price": [None, 7.0, 30.0][i % 3],
            "stock": None if i % 4 == 0 else i % 9,
            "logistic_type": ["FBM", "XD", None][i % 3],
        }
        for i in range(200)
    ]
    return listings(*rows, {"seller_nickname": "empty", "price": None, "stock": None, "url": None, "category_name": None})


@pytest.mark.parametrize("limit", [0, 30, 10**9])
@pytest.mark.parametrize("build", [features.seller_features, daily.seller_daily_features])
def test_small_and_large_groups_alike(some_listings, monkeypatch, build, limit):
    monkeypatch.setattr(Q, "GATHERED_ROWS", 0)
    spread = build(some_listings)
    expected = _rows(spread)
    monkeypatch.setattr(Q, "GATHERED_ROWS", limit)
    found = build(some_listings)
    assert found.schema == spread.schema
    assert re.sub(r"nan", "n", repr(_rounded(_rows(found)))) == re.sub(r"nan", "n", repr(_rounded(expected)))


def _rounded(rows):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in rows]


def test_rows_of_small_groups_move_once(spark):
    df = spark.range(1000).selectExpr("id % 300 AS k", "id * 0.5 AS x", "id % 7 AS c")
    out = Q.aggregate_with_quantiles(df, ["k"], [F.count(F.lit(1)).alias("n")], {"m": ("x", 0.5)}, {"cs": "c"})
    assert out.where("cs >= 3 AND n >= 3 AND m IS NOT NULL").count() == 300
    collected = out._jdf.queryExecution()
    out.collect()
    plan = collected.executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan


def test_wanted_cells_of_few_groups_are_broadcast(spark):
    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS a", "id * 0.5 AS b")
    plan = Q.column_quantiles(df, ["a", "b"], [0.5])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


@pytest.mark.parametrize("few", [1, 100])
def test_medians_of_few_and_many_categories(listings, monkeypatch, few):
    monkeypatch.setattr(cleaning, "FEW", few)
    df = listings(*[{"category_id": f"c{i % 3}", "price": float(i)} for i in range(9)], {"category_id": None})
    assert _rows(cleaning.category_medians(df)) == [("c0", 3.0), ("c1", 4.0), ("c2", 5.0)]


def test_customers_meet_orders_first(spark, tmp_path):
    spark.range(3).selectExpr("id AS c_custkey", "'n' || id AS c_name").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(6).selectExpr("id AS o_orderkey", "id % 3 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(4).selectExpr("id AS p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(12).selectExpr("id % 6 AS l_orderkey", "id % 4 AS l_partkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    joined = order_tables._joined(spark, str(tmp_path))
    plan = joined._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in plan if "Join Inner" in line]
    assert "c_custkey" in joins[-1] and len(joins) == 3
    assert joined.count() == 12


def test_silhouette_blocks_grow_no_faster_than_rows():
    assert [metrics._blocks(n) for n in (0, 100, 20_000, 190_000, 720_000)] == [1, 1, 6, 6, 22]


def test_silhouette_in_strips(spark, monkeypatch):
    rows = [(i, [float(i % 17), float(i * i % 13)], i % 3) for i in range(90)]
    points = spark.createDataFrame(rows, "id long, features array<double>, cluster int")
    whole = {r["id"]: r["sil_sample"] for r in metrics.silhouette_euclidean(points, "id", 1000).collect()}
    pairs = metrics._block_distance_sums
    monkeypatch.setattr(metrics, "HELD_DISTANCES", 7)
    frame = points.withColumn("block", F.lit(0)).toPandas()
    strips = pairs(frame, frame)
    monkeypatch.setattr(metrics, "HELD_DISTANCES", 10**6)
    at_once = pairs(frame, frame)
    assert strips["total"].tolist() == pytest.approx(at_once["total"].tolist(), abs=1e-9)
    cut = {r["id"]: r["sil_sample"] for r in metrics.silhouette_euclidean(points, "id", 10).collect()}
    assert cut == pytest.approx(whole, abs=1e-9)


def test_small_groups_keep_numbers_only(spark):
    """No group holds its values: the states are numbers, rows are sorted and move once."""
    df = spark.range(1000).selectExpr("id % 300 AS k", "id * 0.5 AS x", "id % 7 AS c")
    out = Q.aggregate_with_quantiles(df, ["k"], [F.count(F.lit(1)).alias("n")], {"m": ("x", 0.5), "q": ("x", 0.25)}, {"cs": "c"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    small = plan.split("REPARTITION_BY_COL")[0]
    assert "percentile(" not in plan and "collect_set(" not in plan and "ObjectHashAggregate" not in small


def test_ranked_aggregates_of_odd_values(spark):
    rows = [("a", None), ("a", float("nan")), ("a", -0.0), ("a", 0.0), ("a", 3.0), ("b", None), ("b", float("nan")),
            (None, float("inf")), (None, 1.0), ("c", float("-inf")), ("c", -1.0), ("c", -1.0), ("c", 2.5)]
    df = spark.createDataFrame(rows, "k string, x double")
    wanted = {"low": ("x", 0.1), "mid": ("x", 0.5), "top": ("x", 1.0)}
    ranked, aggregates = Q.ranked_aggregates(df, ["k"], wanted, {"xs": "x"})
    expected = df.groupBy("k").agg(F.size(F.collect_set("x")).cast("long").alias("xs"), *Q.quantile_aggregates(wanted))
    assert _rows(ranked.groupBy("k").agg(*aggregates)) == _rows(expected)
