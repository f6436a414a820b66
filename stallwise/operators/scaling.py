"""Median imputation and scaling of model features.

Fitting computes three numbers per feature on the cluster and keeps them, as any
model keeps its parameters; applying is plain arithmetic on the columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import schema as S
from stallwise.functions.quantiles import column_quantiles, unpivoted

# Spreads below this count as zero, and zero spreads divide by one.
ZERO_SPREAD = 10 * 2.220446049250313e-16


def model_features(sellers: DataFrame, requested: Sequence[str] | None = None) -> list[str]:
    """The requested features (by default the model's) that the table has."""
    features = [c for c in (requested or S.MODEL_FEATURES) if c in sellers.columns]
    if not features:
        raise ValueError("no usable feature columns")
    return features


def _by_feature(found: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, ...]]:
    """One short row per feature as a dict; a feature without values is an error."""
    rows = {row[0]: tuple(row[1:]) for row in found.collect()}
    empty = [f for f in features if f not in rows or rows[f][0] is None]
    if empty:
        raise ValueError(f"features without any value: {empty}")
    return rows


def fit_fills(sellers: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Median per feature."""
    found = column_quantiles(sellers, features, [0.5]).select("column", "value")
    return {f: median for f, (median,) in _by_feature(found, features).items()}


def impute_features(sellers: DataFrame, features: Sequence[str], fills: dict[str, float] | None = None) -> DataFrame:
    """Fill missing feature values with the feature's median."""
    fills = fit_fills(sellers, features) if fills is None else fills
    return sellers.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(fills[f])) for f in features})


def _quartiles(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, ...]]:
    """Median and interquartile range per feature, nulls left out."""
    at = {p: F.max(F.when(F.col("prob") == p, F.col("value"))) for p in (0.25, 0.5, 0.75)}
    found = column_quantiles(df, features, list(at)).groupBy("column")
    return _by_feature(found.agg(at[0.5].alias("center"), (at[0.75] - at[0.25]).alias("spread")), features)


Fit = tuple[dict[str, float], dict[str, tuple[float, ...]]]


def _robust(sellers: DataFrame, features: Sequence[str]) -> Fit:
    """Medians and quartiles come from one search; only features with nulls are searched again, filled."""
    found = _quartiles(sellers, features)
    fills = {f: median for f, (median, _) in found.items()}
    nulls = sellers.agg(*[F.count_if(F.col(f).cast("double").isNull()).alias(f) for f in features]).first()
    filled = [f for f in features if nulls[f]]
    if filled:
        found |= _quartiles(impute_features(sellers, filled, fills), filled)
    return fills, found


def _standard(sellers: DataFrame, features: Sequence[str]) -> Fit:
    fills = fit_fills(sellers, features)
    found = unpivoted(impute_features(sellers, features, fills), features).groupBy("column").agg(
        F.avg("value").alias("center"), F.stddev_pop("value").alias("spread")
    )
    return fills, _by_feature(found, features)


# Per name: fills, and center and spread of the filled values.
SCALERS: dict[str, Callable[[DataFrame, Sequence[str]], Fit]] = {"robust": _robust, "standard": _standard}


@dataclass(frozen=True)
class FittedScaler:
    """Fill, center and scale per feature."""

    features: list[str]
    fill: dict[str, float]
    center: dict[str, float]
    scale: dict[str, float]

    def scaled(self, feature: str) -> Column:
        value = F.coalesce(F.col(feature).cast("double"), F.lit(self.fill[feature]))
        return (value - F.lit(self.center[feature])) / F.lit(self.scale[feature])

    def table(self, spark: SparkSession) -> DataFrame:
        """The parameters as a table, to be written and read back."""
        rows = [(f, self.fill[f], self.center[f], self.scale[f]) for f in self.features]
        return spark.createDataFrame(rows, "feature string, fill double, center double, scale double")

    @staticmethod
    def from_table(table: DataFrame) -> FittedScaler:
        rows = table.select("feature", "fill", "center", "scale").collect()
        return FittedScaler([r[0] for r in rows], *({r[0]: r[i] for r in rows} for i in (1, 2, 3)))


def fit_scaler(sellers: DataFrame, features: Sequence[str], scaler: str = "robust") -> FittedScaler:
    """Fit by name: ``robust`` uses median and interquartile range, ``standard`` mean
    and population standard deviation, both of the values after filling."""
    if scaler not in SCALERS:
        raise ValueError(f"scaler must be one of {sorted(SCALERS)}, not {scaler!r}")
    fills, found = SCALERS[scaler](sellers, features)
    return FittedScaler(
        list(features),
        fills,
        {f: found[f][0] for f in features},
        {f: found[f][1] if found[f][1] >= ZERO_SPREAD else 1.0 for f in features},
    )


def apply_scaler(sellers: DataFrame, fitted: FittedScaler) -> DataFrame:
    """Replace the features by their filled and scaled values."""
    return sellers.withColumns({f: fitted.scaled(f) for f in fitted.features})


def scaled_features(sellers: DataFrame, features: Sequence[str], scaler: str = "robust") -> DataFrame:
    return apply_scaler(sellers, fit_scaler(sellers, features, scaler))


def with_points(sellers: DataFrame, fitted: FittedScaler) -> DataFrame:
    """Add ``features``: the scaled values of a row as one array."""
    return sellers.withColumn("features", F.array(*[fitted.scaled(f) for f in fitted.features]))
