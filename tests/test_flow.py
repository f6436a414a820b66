import datetime as dt
import functools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stallwise import schema as S
from stallwise.operators import daily, distributions, features, profile
from stallwise.plans import segmentation
from stallwise.sources import listings as source
from stallwise.sources import sinks
from stallwise.streaming import daily_job

D = dt.date


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_is_typed_and_never_fails(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "tim_day,seller_nickname,titulo,stock,price,regular_price,is_refurbished,extra\n"
        '2024-08-01,ann,"two\nlines, ""quoted""",3,10.5,N/A,True,x\n'
        "not a day,NA,  ,many,1e3,nan,0,\n"
        ",null,t,2.0,,12,perhaps,y\n",
        encoding="utf-8",
    )
    df = source.read_listings_csv(spark, str(path), multi_line=True)
    found = [tuple(r) for r in df.collect()]
    assert found == [
        (D(2024, 8, 1), "ann", 'two\nlines, "quoted"', 3, 10.5, None, True, "x"),
        (None, None, "  ", None, 1000.0, None, False, None),
        (None, None, "t", 2, None, 12.0, None, "y"),
    ]
    assert dict(df.dtypes)["stock"] == "bigint" and dict(df.dtypes)["price"] == "double"
    with pytest.raises(ValueError):
        source.read_listings_csv(spark, str(tmp_path / "missing.csv"))


def test_nan_becomes_null_in_parquet(spark, tmp_path):
    spark.createDataFrame([(1.0,), (float("nan"),)], "price double").write.parquet(str(tmp_path / "p"))
    assert source.read_listings_parquet(spark, str(tmp_path / "p")).where("price is null").count() == 1


def test_profiles_of_a_small_table(listings):
    df = listings(
        {"price": 1.0, "logistic_type": "XD"}, {"price": 1.0, "logistic_type": "XD"}, {"price": 4.0}, {"price": None, "url": None},
    )
    overview = profile.dataset_overview(df).first()
    assert (overview["rows"], overview["duplicated_rows"], overview["columns"], overview["distinct_urls"]) == (4, 1, 14, 1)
    columns = {r["column"]: r for r in profile.column_profile(df).collect()}
    assert columns["price"]["sample_values"] == ["1.0", "4.0"] and columns["price"]["null_pct"] == 25.0
    assert columns["category_id"]["sample_values"] == [] and columns["category_id"]["null_count"] == 4
    rough = {r["column"]: r["unique_count"] for r in profile.column_profile(df, exact=False).collect()}
    assert rough["price"] == 2 and rough["category_id"] == 0
    numbers = {r["column"]: r for r in profile.numeric_profile(df).collect()}
    assert numbers["price"]["count"] == 3 and numbers["price"]["p50"] == 1.0 and numbers["regular_price"]["count"] == 0
    values = {(r["column"], r["value"]): r["records"] for r in profile.categorical_profile(df).collect()}
    assert values[("logistic_type", "<NULL>")] == 2 and values[("logistic_type", "XD")] == 2
    assert {r["channel"]: r["pct"] for r in profile.channel_mix(df).collect()} == {"XD": 50.0, "Otro": 50.0}
    assert sum(r["records"] for r in distributions.histogram(df).collect()) == 3


def test_frequent_values_are_limited_before_they_meet(listings):
    plan = profile.categorical_profile(listings({}))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_group_sizes(listings):
    df = listings(*[{"seller_nickname": s, "url": u} for s, u in [("a", "1"), ("a", "1"), ("a", None), ("b", "2"), (None, "3")]])
    assert tuple(profile.grain_rows(df).first()) == (2.0, 2.0, 3, 1)
    assert tuple(profile.grain_urls(df).first()) == (1.0, 1.0, 1)
    described = profile.group_size_describe(df).first()
    assert (described["count"], described["std"], described["p25"]) == (2, pytest.approx(2**0.5), 1.5)


def days(listings, *spec):
    return listings(
        *[
            {"tim_day": D(2024, 8, d), "seller_nickname": s, "price": p, "url": f"{i}", "category_id": "c", "logistic_type": "XD"}
            for i, (d, s, p) in enumerate(spec)
        ]
    )


def test_daily_features_keep_unknown_sellers(listings):
    found = rows(daily.seller_daily_features(days(listings, (1, "a", 2.0), (1, "a", 4.0), (2, None, 9.0))).select("tim_day", "seller_nickname", "items_count", "median_price"))
    assert (D(2024, 8, 1), "a", 2, 3.0) in found and (D(2024, 8, 2), None, 1, 9.0) in found
    later = daily.seller_daily_features(days(listings, (1, "a", 2.0), (2, "a", 9.0)), "2024-08-02 23:59:00")
    assert [r["tim_day"] for r in later.collect()] == [D(2024, 8, 2)]


def test_windows_look_back_whole_days(listings):
    df = days(listings, (1, "a", 2.0), (2, "a", 4.0), (4, "a", 9.0), (4, "b", 1.0))
    found = rows(daily.rolling_features(df, 3).select("seller_nickname", "tim_day", "items_3d", "avg_price_3d"))
    assert found == [("a", D(2024, 8, 1), 1, 2.0), ("a", D(2024, 8, 2), 2, 3.0), ("a", D(2024, 8, 4), 2, 6.5), ("b", D(2024, 8, 4), 1, 1.0)]
    trend = rows(daily.items_trend(df, 2).where("seller_nickname = 'a'").select("tim_day", "trend_items_count_2d"))
    assert trend == [(D(2024, 8, 1), 1), (D(2024, 8, 2), 2), (D(2024, 8, 4), -1)]


@pytest.mark.parametrize("unit", ["day", "month"])
def test_refresh_is_idempotent_and_drops_vanished_days(spark, listings, tmp_path, unit):
    path = str(tmp_path / "daily")
    raw = days(listings, (1, "a", 2.0), (2, "a", 4.0), (3, "b", 6.0))
    for mark in (None, None, "2024-08-02"):
        daily_job.refresh_daily_features(raw, path, mark, unit)
        assert rows(daily_job.read_daily_features(spark, path)) == rows(daily.seller_daily_features(raw))
    shorter = raw.where("tim_day <> DATE '2024-08-03'")
    daily_job.refresh_daily_features(shorter, path, "2024-08-02", unit)
    assert rows(daily_job.read_daily_features(spark, path)) == rows(daily.seller_daily_features(shorter))


def test_readers_see_a_run_whole_or_not_at_all(spark, listings, tmp_path, monkeypatch):
    path = str(tmp_path / "daily")
    first = days(listings, (1, "a", 2.0), (2, "a", 4.0), (3, "b", 6.0))
    daily_job.refresh_daily_features(first, path)
    before = rows(daily_job.read_daily_features(spark, path))
    reader = daily_job.read_daily_features(spark, path)
    later = days(listings, (2, "a", 5.0), (4, "c", 1.0))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as failing:
        # All data of the run is written, nothing is published.
        failing.setattr(daily_job, "_publish", lost)
        with pytest.raises(RuntimeError, match="lost"):
            daily_job.refresh_daily_features(later, path, "2024-08-02")
    assert rows(daily_job.read_daily_features(spark, path)) == before
    daily_job.refresh_daily_features(later, path, "2024-08-02")
    now = rows(daily.seller_daily_features(first.where("tim_day = DATE '2024-08-01'").unionByName(later)))
    assert rows(daily_job.read_daily_features(spark, path)) == now
    # A reader that started before, and the version it read, are as they were.
    assert rows(reader) == before and rows(daily_job.read_daily_features(spark, path, version=1)) == before
    daily_job.remove_versions(spark, path)
    assert rows(daily_job.read_daily_features(spark, path)) == now
    with pytest.raises(ValueError, match="by day"):
        daily_job.refresh_daily_features(first, path, unit="month")
    with pytest.raises(ValueError, match="no version"):
        daily_job.read_daily_features(spark, path, version=9)
    daily_job.refresh_daily_features(first.where("false"), path)
    assert rows(daily_job.read_daily_features(spark, path)) == []
    assert rows(daily_job.read_daily_features(spark, str(tmp_path / "none"))) == []


def test_stream_recomputes_days_with_late_rows(spark, listings, tmp_path):
    raw_path, path, progress = (str(tmp_path / n) for n in ("raw", "daily", "progress"))
    first, late = days(listings, (1, "a", 2.0), (2, "a", 4.0)), days(listings, (1, "a", 10.0), (1, "b", 1.0))
    for part in (first, late):
        sinks.write_raw_listings(part, raw_path, mode="append")
        daily_job.stream_daily_features(spark, raw_path, path, progress).awaitTermination()
    expected = rows(daily.seller_daily_features(first.unionByName(late)))
    assert rows(daily_job.read_daily_features(spark, path)) == expected
    daily_job.stream_daily_features(spark, raw_path, path, progress).awaitTermination()
    assert rows(daily_job.read_daily_features(spark, path)) == expected


def test_raw_table_is_partitioned_by_month(spark, listings, tmp_path):
    df = listings({"tim_day": D(2024, 7, 31)}, {"tim_day": D(2024, 8, 1)}, {"tim_day": D(2024, 8, 9)})
    sinks.write_raw_listings(df, str(tmp_path / "raw"))
    assert {p.name for p in (tmp_path / "raw").glob("month=*")} == {"month=2024-07-01", "month=2024-08-01"}
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 3


def test_snapshots_are_replaced_by_date(spark, tmp_path):
    path = str(tmp_path / "versions")
    for date, n in (("2024-08-01", 3), ("2024-08-02", 4), ("2024-08-01", 5)):
        sinks.write_snapshot(spark.range(n), path, date)
    assert rows(spark.read.parquet(path).groupBy("snapshot_date").count()) == [(D(2024, 8, 1), 5), (D(2024, 8, 2), 4)]


def test_cluster_moves_are_counted(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("a", 3, 1), ("b", 1, 2)], "seller_nickname string, month int, cluster int")
    assert rows(daily.cluster_migration(df)) == [(0, 1, 1), (1, 1, 1)]


def test_clusters_go_on_under_their_numbers(spark):
    members = {0: "abcdef", 1: "ghij", 2: "klm"}
    before = spark.createDataFrame([(s, c) for c, names in members.items() for s in names] + [("z", None), (None, 1)], "seller_nickname string, cluster int")
    renumbered = before.selectExpr("seller_nickname", "2 - cluster AS cluster", "'x' AS previous")
    carried = daily.carry_clusters(before, renumbered)
    assert carried.columns == ["seller_nickname", "cluster", "previous"]
    assert {tuple(r) for r in carried.select("seller_nickname", "cluster").collect()} == {tuple(r) for r in before.collect()}
    # Of halves the smaller number goes on; a cluster of strangers is new, as is one whose best goes elsewhere.
    after = spark.createDataFrame([(s, 5) for s in "abcg"] + [(s, 3) for s in "def"] + [("k", 7), ("q", 9), ("r", 9)], "seller_nickname string, cluster int")
    assert rows(daily.carried_numbers(before, after).na.fill(0)) == [(3, 0, 3), (5, 3, 0), (7, 2, 1), (9, 4, 0)]
    assert rows(daily.carried_numbers(before.where("false"), after).select("cluster", "number")) == [(3, 0), (5, 1), (7, 2), (9, 3)]
    assert daily.carry_clusters(before, after.where("false")).count() == 0


def test_whole_flow_writes_and_reloads(spark, tmp_path, monkeypatch):
    from stallwise.sources.order_tables import items

    table = items(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "out")
    assert sinks.load_outputs(spark, out) is None
    saved = segmentation.load_or_run(table, out, k=3, k_values=[2, 3], n_init=1)
    metadata = saved[sinks.METADATA_DIR].first()
    assert (metadata["n_items_orig"], metadata["n_sellers"], metadata["n_clusters"]) == (6000, 150, 3)
    assert saved[sinks.SEGMENTS_DIR].count() == 150 and saved[sinks.SUMMARY_DIR].count() == 3
    assert spark.read.parquet(f"{out}/rejected_items").count() == 79
    audit = spark.read.option("header", True).csv(f"{out}/quality_audit")
    assert audit.count() == 12 and spark.read.option("header", True).csv(f"{out}/kmeans_evaluation").count() == 2
    monkeypatch.setattr(segmentation, "segment_listings", functools.wraps(segmentation.segment_listings)(lambda *a, **o: pytest.fail("run anew")))
    again = segmentation.load_or_run(table.repartition(3), out, k=3, k_values=range(2, 4), n_init=1)
    assert again[sinks.SEGMENTS_DIR].count() == 150
    monkeypatch.undo()
    other = segmentation.load_or_run(table, out, k=4, k_values=[2, 3], n_init=1)
    assert other[sinks.METADATA_DIR].first()["n_clusters"] == 4 and other[sinks.SUMMARY_DIR].count() == 4


def test_fingerprints_tell_tables_apart(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    same = df.orderBy(F.desc("x")).repartition(2)
    others = [df.limit(2), df.unionByName(df), df.dropDuplicates(), df.withColumnRenamed("x", "z"), df.withColumn("y", F.lit("a")), df.select("x", F.lit(None).cast("string").alias("y"))]
    prints = [sinks.dataset_fingerprint(d) for d in (df, *others)]
    assert sinks.dataset_fingerprint(same) == prints[0] and len(set(prints)) == len(prints)


def test_rejected_rows_are_written_only_if_any(spark, listings, tmp_path):
    assert not sinks.write_rejected(listings({}).limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_item_features(listings):
    df = features.item_features(listings({"price": 8.0, "regular_price": 10.0, "logistic_type": "DS"}, {"price": None, "regular_price": 1.0}))
    first, second = df.orderBy(F.col("price").isNull()).collect()
    assert first["has_discount"] and first["discount_pct"] == pytest.approx(0.2) and first["is_ds"] and not first["is_xd"]
    assert second["has_regular_price"] and not second["has_discount"] and second["discount_pct"] is None
    assert set(S.REPUTATION_SCORES.values()) == set(range(1, 10))


def test_column_profile_of_all_kinds(spark):
    """Numbers keep their order and their text, whatever their type; equal numbers are one value."""
    rows = [
        (2**53 + 1, 0.1, 0.0, Decimal("10.50"), True, "b", D(2024, 2, 1), None),
        (2**53, 1e10, -0.0, Decimal("9.25"), None, "", D(2023, 12, 31), None),
        (-5, float("nan"), float("nan"), Decimal("9.25"), False, "b", None, None),
        (None, None, float("inf"), None, False, None, D(2024, 2, 1), None),
    ]
    table = spark.createDataFrame(
        rows, "`a.b` long, f float, d double, m decimal(10,2), t boolean, s string, y date, nothing array<int>"
    )
    found = {r["column"]: r for r in profile.column_profile(table).collect()}
    assert {c: r["sample_values"] for c, r in found.items()} == {
        "a.b": ["-5", "9007199254740992", "9007199254740993"],
        "f": ["0.1", "1.0E10", "NaN"],
        "d": ["0.0", "Infinity", "NaN"],
        "m": ["9.25", "10.50"],
        "t": ["false", "true"],
        "s": ["", "b"],
        "y": ["2023-12-31", "2024-02-01"],
        "nothing": [],
    }
    assert {c: (r["null_count"], r["unique_count"]) for c, r in found.items()} == {
        "a.b": (1, 3), "f": (1, 3), "d": (0, 3), "m": (1, 2), "t": (1, 2), "s": (1, 2), "y": (1, 2), "nothing": (4, 0),
    }
    assert [r["sample_values"] for r in profile.column_profile(table.select("f"), samples=1).collect()] == [["0.1"]]
    assert profile.column_profile(table.where("false")).count() == 0


def test_column_profile_moves_numbers_as_numbers(spark):
    """No number is written as text before values are shuffled, and tasks pass on few values each."""
    table = spark.range(10).selectExpr("id", "CAST(id AS DOUBLE) AS x")
    plan = profile.column_profile(table)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("hashpartitioning(_column"):]
    assert "WindowGroupLimit" in plan and "as string" not in below
