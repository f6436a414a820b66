"""Numbers, surplus fields, silhouettes far from the origin, named segments."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.operators import clustering, metrics, profile
from stallwise.sources import listings


@pytest.mark.parametrize(
    ("text", "expected"),
    [("12", 12.0), ("12f", None), ("12d", None), ("0x1p3", None), ("1e2", 100.0), ("-.5", -0.5), ("1.", 1.0), ("inf", None), ("1e400", None), ("NaN", None), ("1,5", None), (" 7 ", 7.0)],
)
def test_decimal_numbers_only(spark, text, expected):
    assert spark.createDataFrame([(text,)], "x string").select(listings.number("x")).first()[0] == expected


def test_fractional_stock_is_null_not_cut(spark):
    rows = spark.createDataFrame([("12.7",), ("-0.5",), ("-3",), ("4.0",)], "stock string")
    assert [r.stock for r in listings.coerce_types(rows).collect()] == [None, None, -3, 4]


def test_rows_with_surplus_fields_are_refused(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("seller_nickname,price,stock\ns1,5,3\ns2,5,3,extra\n")
    with pytest.raises(Exception, match="MALFORMED"):
        listings.read_listings_csv(spark, str(path)).collect()


def test_large_files_are_split(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text("seller_nickname,price,stock\n" + "some seller,5,3\n" * 50_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        found = listings.read_listings_csv(spark, str(path))
        assert found.rdd.getNumPartitions() > 1 and found.count() == 50_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def brute_silhouette(x, labels, squared):
    far = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    far = far if squared else np.sqrt(far)
    out = []
    for i, label in enumerate(labels):
        own = labels == label
        a = far[i, own].sum() / (own.sum() - 1)
        b = min(far[i, labels == other].mean() for other in set(labels) - {label})
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("offset", [0.0, 1e6, 3e6])
def test_silhouettes_far_from_the_origin(spark, offset):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 1, (6, 3)), rng.normal(5, 1, (7, 3)), rng.normal(-6, 0.1, (4, 3))]) + offset
    labels = np.array([0] * 6 + [1] * 7 + [2] * 4)
    rows = [(str(i), [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(x, labels))]
    points = spark.createDataFrame(rows, "id string, features array<double>, cluster int")
    for squared, found in ((True, metrics.silhouette_squared(points)), (False, metrics.silhouette_euclidean(points, "id", 5))):
        mine = {r.id: r.sil_sample for r in found.collect()}
        expected = brute_silhouette(x, labels, squared)
        assert np.allclose([mine[str(i)] for i in range(len(x))], expected, atol=1e-6)


def test_all_text_columns_are_profiled(spark):
    wide = spark.range(1).select(*[F.lit("x").alias(f"c{i}") for i in range(25)])
    assert len(profile.categorical_columns(wide)) == 25 and len(profile.categorical_columns(wide, 20)) == 20


def test_pca_keeps_rows_with_nulls(spark):
    rows = [(str(i), float(i), float(2 * i + (i % 3)), None if i == 2 else 1.0 * (i % 4)) for i in range(12)]
    found = clustering.pca_features(spark.createDataFrame(rows, "seller_nickname string, a double, b double, c double"), ["a", "b", "c"])
    assert found.where("pc1 IS NOT NULL AND pc2 IS NOT NULL").count() == 12


@pytest.mark.parametrize("bad", ["s2,6,4,extra", "s3,7"])
def test_bad_rows_fail_whatever_is_asked_for(spark, tmp_path, bad):
    path = tmp_path / "items.csv"
    path.write_text(f"seller_nickname,price,stock\ns1,5,3\n{bad}\n")
    found = listings.read_listings_csv(spark, str(path))
    for ask in (found.count, found.select("price").collect, found.groupBy("seller_nickname").count().collect, found.collect):
        with pytest.raises(Exception, match="(?i)malformed"):
            ask()
