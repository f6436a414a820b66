"""Exact duplicates by suspect digests."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stallwise.operators import cleaning, duplicates, profile

ROWS = [
    ("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), (None, None, None), (None, None, None), (None, None, None),
    ("z", "z", 0.0), ("z", "z", -0.0), ("n", "n", float("nan")), ("n", "n", float("nan")), ("", None, 1.0), (None, "", 1.0),
    *[("hot", "row", 5.0)] * 40, *[(str(i), "single", float(i)) for i in range(60)],
]


def table(spark):
    return spark.createDataFrame(ROWS, "left string, right string, x double").repartition(4)


def plain(rows):
    """Rows with equal zeros and NaN, counted."""
    return Counter((a, b, "nan" if x is not None and x != x else x if x is None else x + 0.0) for a, b, x in rows)


@pytest.mark.parametrize("collide", [False, True])
def test_duplicates_equal_brute_force(spark, monkeypatch, collide):
    """With a digest that all rows share, too: suspects are compared as they are."""
    if collide:
        monkeypatch.setattr(duplicates, "row_digest", lambda df: [F.lit(1), F.lit(2)])
    df, expected = table(spark), plain(ROWS)
    row = profile.duplicate_rows(df).first()
    assert (row.rows, row.duplicated_rows) == (len(ROWS), len(ROWS) - len(expected))
    kept = cleaning.deduplicate(df)
    assert kept.columns == df.columns and plain(map(tuple, kept.collect())) == Counter(expected.keys())


def test_only_suspects_are_grouped_whole(spark):
    df = spark.range(1000).selectExpr("id % 990 AS a", "CAST(id % 990 AS STRING) AS b", "id % 990 AS c")
    assert duplicates.suspects(df).count() == 10
    assert duplicates.duplicated_rows(df).first()[0] == 10
    # Which value is null belongs to the digest, which hashes skip otherwise.
    both = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert duplicates.suspects(both).count() == 0


def test_no_rows(spark):
    df = table(spark).where("false")
    assert tuple(profile.duplicate_rows(df).first()) == (0, 0)
    assert cleaning.deduplicate(df).count() == 0
