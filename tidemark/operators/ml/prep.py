"""Feature preparation for ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_div


def minmax_scale(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(x - min) / (max - min) per feature; a constant column scales to 0.

    Returns (scaled frame, scaler) where the scaler is a one-row frame of
    ``<f>_min`` / ``<f>_max`` (one aggregate pass). MLlib's MinMaxScaler maps
    constant columns to 0.5, hence this expression form.
    """
    feats = list(features)
    scaler = df.agg(*[F.min(c).alias(f"{c}_min") for c in feats], *[F.max(c).alias(f"{c}_max") for c in feats])
    return apply_minmax(df, scaler, feats), scaler


def apply_minmax(df: DataFrame, scaler: DataFrame, features: Sequence[str]) -> DataFrame:
    """Apply a fitted min-max scaler.

    The one-row scaler is attached as ONE scalar subquery (a struct of all
    bounds), evaluated once and shipped as a literal: no join, no rescan
    per feature.
    """
    stats = scaler.select(F.struct(*[F.col(c) for c in scaler.columns]).alias("s")).scalar()
    return df.select(*[
        F.coalesce(safe_div(F.col(c) - stats[f"{c}_min"], stats[f"{c}_max"] - stats[f"{c}_min"]),
                   F.lit(0.0)).alias(c) if c in features else F.col(c)
        for c in df.columns])


def zero_count(features: Sequence[str]) -> Column:
    """E10 ZeroCount: number of zero features in the row."""
    return sum((F.col(c) == F.lit(0)).cast("int") for c in features)


def binarize(features: Sequence[str], threshold: float = 0.0) -> list[Column]:
    """E10 Binarizer: 1.0 where x > threshold."""
    return [(F.col(c) > F.lit(threshold)).cast("double").alias(c) for c in features]


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """The ML edge: a vector column for MLlib (double features)."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="skip").transform(df)


PREPROCESSORS = ("Binarizer", "MaxAbsScaler", "MinMaxScaler", "Normalizer", "PCA", "PolynomialFeatures", "RobustScaler",
                 "StandardScaler", "OneHotEncoder", "ZeroCount")


def preprocessor(name: str, input_col: str = "features", output_col: str = "scaled"):
    """Search-space preprocessors as MLlib stages (by name)."""
    from pyspark.ml import feature as MF

    from tidemark.operators.ml import stages as ST

    table: Mapping[str, Callable[[], object]] = {
        "Binarizer": lambda: MF.Binarizer(threshold=0.0, inputCol=input_col, outputCol=output_col),
        "MaxAbsScaler": lambda: MF.MaxAbsScaler(inputCol=input_col, outputCol=output_col),
        "MinMaxScaler": lambda: MF.MinMaxScaler(inputCol=input_col, outputCol=output_col),
        "Normalizer": lambda: MF.Normalizer(p=2.0, inputCol=input_col, outputCol=output_col),
        "PCA": lambda: MF.PCA(k=2, inputCol=input_col, outputCol=output_col),
        "PolynomialFeatures": lambda: MF.PolynomialExpansion(degree=2, inputCol=input_col, outputCol=output_col),
        "RobustScaler": lambda: MF.RobustScaler(inputCol=input_col, outputCol=output_col),
        "StandardScaler": lambda: MF.StandardScaler(withMean=True, withStd=True, inputCol=input_col,
                                                    outputCol=output_col),
        "OneHotEncoder": lambda: ST.VectorOneHot(inputCol=input_col, outputCol=output_col),
        "ZeroCount": lambda: ST.ZeroCount(inputCol=input_col, outputCol=output_col),
    }
    if name not in table:
        raise KeyError(f"unknown preprocessor {name!r}; known: {sorted(table)}")
    return table[name]()


# Named feature functions applied to a gridded frame in one projection.
_FEATURES: dict[str, Callable[[DataFrame], Column]] = {}


def register_feature(name: str, fn: Callable[[DataFrame], Column]) -> None:
    """E0 hook: ``fn(df) -> Column`` evaluated inside one ``select`` (no per-row Python)."""
    _FEATURES[name] = fn


def apply_features(df: DataFrame, names: Sequence[str], dropna: bool = True) -> DataFrame:
    """Column-concat of the named features, then drop rows with NULLs in them."""
    cols = [(_FEATURES[n](df)).alias(n) for n in names]
    out = df.select("*", *cols)
    return out.na.drop(subset=list(names)) if dropna else out


def select_columns(df: DataFrame, keep: Sequence[str], always: Sequence[str] = ()) -> DataFrame:
    """Keep the chosen feature columns (plus ``always``, e.g. keys and label)."""
    return df.select(*always, *[c for c in keep if c not in always])
