"""Keeping the daily seller features up to date, in batches or as a stream.

The feature table is partitioned by period, a day or a month. A run recomputes
whole periods from the raw listings and replaces them, so running it again
changes nothing.

A run writes its periods into a folder of its own (``data/<run>``) and publishes
them last, by one file that appears in ``versions`` at once: which run holds each
period of the new version. Readers take the newest version, so they see the table as
it was before a run or after it, never between, and as before if the run fails.
Periods that vanished are simply not in the new version. One writer at a time is
expected; if two publish the same version, that of the later run id stands, whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stallwise import schema as S
from stallwise.operators.daily import DAILY_COLUMNS, seller_daily_features

UNITS = ("day", "month")


def _period(unit: str) -> Column:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    return F.date_trunc(unit, F.col(S.DAY)).cast("date")


VERSIONS = "version long, run string, unit string, period date, held_by string"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _published(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, str | None, dict[date, str]]:
    """A version's number, unit and the run that holds each period; (0, None, {}) where nothing is published.

    One row per period comes to the driver, as many as the table has folders.
    """
    try:
        known = spark.read.schema(VERSIONS).parquet(f"{path}/versions")
    except AnalysisException as error:
        if not _missing(error):
            raise
        known = spark.createDataFrame([], VERSIONS)
    if version is not None:
        known = known.where(F.col("version") == version)
    newest = known.agg(F.max(F.struct("version", "run")).alias("at")).first()["at"]
    if newest is None:
        if version is not None:
            raise ValueError(f"{path} has no version {version}")
        return 0, None, {}
    rows = known.where((F.col("version") == newest["version"]) & (F.col("run") == newest["run"])).collect()
    return newest["version"], rows[0]["unit"], {r["period"]: r["held_by"] for r in rows if r["period"] is not None}


def _publish(spark: SparkSession, path: str, version: int, run: str, unit: str, held: dict[date, str]) -> None:
    """Make a version visible: one file, moved into place when it is complete. A table without periods has a row without one."""
    rows = [(version, run, unit, p, r) for p, r in sorted(held.items())] or [(version, run, unit, None, None)]
    spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(f"{path}/versions")


def _replace_periods(spark: SparkSession, features: DataFrame, path: str, unit: str, replaced: Callable[[date], bool]) -> None:
    """Publish a version with the periods of ``features`` in place of all ``replaced`` ones; others stay as they are."""
    version, known_unit, held = _published(spark, path)
    if known_unit not in (None, unit):
        raise ValueError(f"{path} is kept by {known_unit}, not by {unit}")
    run = uuid.uuid4().hex
    written = features.withColumn("period", _period(unit))
    written.hint("rebalance", F.col("period")).write.partitionBy("period").parquet(f"{path}/data/{run}")
    found = spark.read.schema(written.schema).parquet(f"{path}/data/{run}").select("period").distinct().collect()
    kept = {p: r for p, r in held.items() if not replaced(p)}
    _publish(spark, path, version + 1, run, unit, kept | {row["period"]: run for row in found})


def read_daily_features(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest published features, or those of an earlier version."""
    held = _published(spark, path, version)[2]
    schema = seller_daily_features(spark.createDataFrame([], S.LISTING_SCHEMA)).schema
    if not held:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/{run}/period={period.isoformat()}" for period, run in sorted(held.items())]
    return spark.read.schema(schema).parquet(*folders).select(*DAILY_COLUMNS)


def refresh_daily_features(raw: DataFrame, path: str, from_day: str | None = None, unit: str = "day") -> None:
    """Recompute the periods from ``from_day`` on (all history without one) and replace them.

    ``unit`` is the size of a partition and of what is recomputed: days suit long
    tables with much data per day, months suit sparse ones. Periods that are in
    the table but no longer in the raw listings are not in the new version, as deleting
    the range before inserting would do. Until the new version is published, readers
    get the one before.
    """
    spark = raw.sparkSession
    dated = raw.where(F.col(S.DAY).isNotNull())
    first = date.min
    if from_day is not None:
        mark = F.date_trunc(unit, F.to_date(F.lit(from_day))).cast("date")
        dated = dated.where(F.col(S.DAY) >= mark)
        first = spark.range(1).select(mark).first()[0]
    _replace_periods(spark, seller_daily_features(dated), path, unit, lambda period: period >= first)


def remove_versions(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete the data that none of the newest ``keep`` versions holds. Readers of older versions lose them."""
    newest = _published(spark, path)[0]
    if not newest:
        return
    used = {run for v in range(max(1, newest - keep + 1), newest + 1) for run in _published(spark, path, v)[2].values()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(folder):
        if entry.getPath().getName() not in used:
            files.delete(entry.getPath(), True)


def _periods_of(batch: DataFrame, unit: str) -> list[date]:
    """The periods in ``batch``: one entry per partition of the table."""
    periods = batch.select(_period(unit).alias("period")).where(F.col("period").isNotNull())
    return [row["period"] for row in periods.distinct().collect()]


def _in_periods(raw: DataFrame, listed: list[date], unit: str) -> DataFrame:
    """Raw rows of the listed periods; the list prunes files."""
    if "month" in raw.columns:
        raw = raw.where(F.col("month").isin(sorted({p.replace(day=1) for p in listed})))
    return raw.where(_period(unit).isin(listed))


def stream_daily_features(
    spark: SparkSession,
    raw_path: str,
    features_path: str,
    checkpoint: str,
    schema: T.StructType = S.LISTING_SCHEMA,
    unit: str = "day",
) -> StreamingQuery:
    """Process the raw files that arrived since the last run, then stop.

    Each batch only tells which periods changed; those are recomputed from all
    raw listings and replaced. Late rows thus correct their period, replays are
    harmless, and no state has to be kept for exact medians and distinct counts.
    """
    arriving = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(raw_path)

    def replace(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        listed = _periods_of(batch, unit)
        if listed:
            raw = _in_periods(session.read.parquet(raw_path), listed, unit)
            _replace_periods(session, seller_daily_features(raw), features_path, unit, set(listed).__contains__)

    return (
        arriving.select(S.DAY)
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
