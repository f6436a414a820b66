import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
# Python workers inherit it, wherever the tests are started.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def listings(spark):
    """Build a listing table from dicts; unnamed columns are null or harmless."""
    from stallwise.schema import LISTING_SCHEMA

    def build(*rows):
        harmless = {"seller_nickname": "s", "url": "u", "titulo": "t", "condition": "new", "price": 10.0, "stock": 1}
        names = [f.name for f in LISTING_SCHEMA]
        data = [tuple({**harmless, **row}.get(n) for n in names) for row in rows]
        return spark.createDataFrame(data, LISTING_SCHEMA)

    return build
