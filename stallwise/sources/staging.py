"""Tables written to the shared folder, so that later work starts from files.

A staged table cuts lineage without depending on executor disks, keeps columnar
pruning, and gives the optimizer a real size: a join with a staged table becomes
a broadcast join only if its files are below the broadcast threshold.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stallwise-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once and continue from the written table; in the session's compression unless one is named."""
    spark = df.sparkSession
    path = new_path(spark, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: dict[tuple[str, str], DataFrame] = {}


def stage_once(spark: SparkSession, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The staged table ``key`` of this application, built and written on first use."""
    known = (spark.sparkContext.applicationId, key)
    if known not in _WRITTEN:
        _WRITTEN[known] = stage(build(), "table", "zstd")
    return _WRITTEN[known]
