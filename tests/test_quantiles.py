import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.functions import quantiles as Q
from stallwise.operators.daily import seller_daily_features
from stallwise.operators.features import seller_features

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 0.9999, 1.0]


@pytest.mark.parametrize(
    "values",
    [
        [1.0],
        [1.0, 2.0],
        [5.0] * 7 + [5.0000001],
        list(np.random.default_rng(1).lognormal(8, 3, 2001)),
        list(np.random.default_rng(2).normal(0, 50, 1000)),
        [0.0, -0.0, 1e-9, -1e-9, 1e12, -1e12],
        [round(x, 2) for x in np.random.default_rng(3).uniform(99.99, 100.01, 500)],
    ],
)
def test_selection_equals_numpy(spark, values):
    df = spark.createDataFrame([("c", float(v)) for v in values] + [("c", None), ("c", float("nan"))], "k string, v double")
    found = {r["prob"]: r["value"] for r in Q.group_quantiles(df, ["k"], "v", PROBS).collect()}
    assert set(found) == set(PROBS)
    for p in PROBS:
        assert found[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_group_without_values_gives_no_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, v double")
    assert [r["k"] for r in Q.group_quantiles(df, ["k"], "v", [0.5]).collect()] == ["a"]


def test_groups_with_aggregates(spark):
    rng = np.random.default_rng(4)
    rows = [("hot", float(v), int(v)) for v in rng.lognormal(5, 2, 900)]
    rows += [(None, float(v), None) for v in rng.normal(0, 9, 300)]
    rows += [(f"k{i % 50}", float(v), 1) for i, v in enumerate(rng.normal(3, 1, 400))] + [("none", None, None)]
    df = spark.createDataFrame(rows, "k string, x double, y long")
    wanted = {"med_x": ("x", 0.5), "p9_x": ("x", 0.9), "med_y": ("y", 0.5)}
    out = Q.aggregate_with_quantiles(df, ["k"], [F.count(F.lit(1)).alias("n"), F.avg("x").alias("m")], wanted)
    assert out.columns == ["k", "n", "m", "med_x", "p9_x", "med_y"]
    found = {r["k"]: r for r in out.collect()}
    assert found.keys() == {k for k, _, _ in rows}
    for key, row in found.items():
        x = [a for k, a, _ in rows if k == key and a is not None]
        y = [b for k, _, b in rows if k == key and b is not None]
        assert row["n"] == sum(k == key for k, _, _ in rows)
        for name, values, p in (("med_x", x, 0.5), ("p9_x", x, 0.9), ("med_y", y, 0.5)):
            assert row[name] == (pytest.approx(np.quantile(values, p), rel=1e-12) if values else None)


def test_equal_to_percentile_to_the_last_bit(spark):
    """With NaN, nulls, negative zeros and infinities, whatever the size of the group."""
    rng, nan = np.random.default_rng(5), float("nan")
    rows = [("nan", v) for v in [*rng.lognormal(5, 2, 300).tolist(), *[nan] * 200, *[None] * 50]]
    rows += [("plain", v) for v in rng.normal(0, 9, 5000).tolist()] + [("one", 3.0)]
    rows += [("zeros", -0.0)] * 150 + [("none", nan)] * 150
    rows += [("ends", v) for v in [float("inf")] * 70 + [float("-inf")] * 70 + [1.0] * 10]
    rows += [("close", 1 + i * 2**-52) for i in range(3000)] + [("tiny", i * 5e-324) for i in range(-500, 500)]
    df = spark.createDataFrame(rows, "k string, x double")
    found = {(r["k"], r["prob"]): r["value"].hex() for r in Q.group_quantiles(df, ["k"], "x", PROBS).collect()}
    probs = ", ".join(f"{p!r}D" for p in PROBS)
    plain = df.where("x IS NOT NULL AND NOT isnan(x)").groupBy("k").agg(F.expr(f"percentile(x + 0.0D, array({probs})) AS q"))
    assert found == {(r["k"], p): q.hex() for r in plain.collect() for p, q in zip(PROBS, r["q"])}


def test_keys_order_all_doubles(spark):
    rng = np.random.default_rng(6)
    values = [0.0, 5e-324, 1e-310, float("inf"), 1.7976931348623157e308, *np.exp(rng.uniform(-700, 700, 500))]
    for k in range(-1074, 1024):
        values += [2.0**k, float(np.nextafter(2.0**k, 0)), float(np.nextafter(2.0**k, np.inf))]
    rows = [(float(v),) for v in values] + [(-float(v),) for v in values if v]
    for row in Q.with_order_key(spark.createDataFrame(rows, "v double"), "v", "k").collect():
        (bits,) = struct.unpack("<q", struct.pack("<d", abs(row.v)))
        assert row.k == (-bits if row.v < 0 else bits)


def test_many_values_in_a_narrow_range(spark):
    df = spark.range(200_000).select(F.lit("c").alias("k"), (F.col("id") * F.lit(1e-10)).alias("v"))
    found = {r["prob"]: r["value"] for r in Q.group_quantiles(df, ["k"], "v", PROBS).collect()}
    values = np.arange(200_000) * 1e-10
    assert found == {p: pytest.approx(np.quantile(values, p), rel=1e-12) for p in PROBS}


def test_one_group_of_ten_million_rows(spark):
    df = spark.range(10_000_000).select(F.lit("c").alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("v"))
    found = {r["prob"]: r["value"] for r in Q.group_quantiles(df, ["k"], "v", [0.25, 0.5]).collect()}
    for p, value in found.items():
        below = df.agg(F.count_if(F.col("v") < value), F.count_if(F.col("v") <= value)).first()
        assert below[0] <= p * 9_999_999 + 1 and below[1] >= p * 9_999_999


def test_no_job_before_the_action(spark, listings):
    items = listings({"price": 1.0}, {"price": None})
    spark.sparkContext.setJobGroup("lazy", "nothing runs")
    seller_features(items)
    seller_daily_features(items)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_pair_join_and_no_single_group_sort_of_rows_in_the_plan(spark):
    df = spark.range(100).select(F.lit("c").alias("k"), F.col("id").cast("double").alias("v"))
    plan = Q.group_quantiles(df, ["k"], "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
