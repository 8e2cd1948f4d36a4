"""Joins, unions and set operations (J1-J12) that are not part of another module."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def params_matrix_from_arrays(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cartesian parameter grid of array columns, by successive ``explode`` (no join).

    ``df`` holds one row whose array columns are the value lists; the grid
    has prod(len(list)) rows.
    """
    out = df
    for c in columns:
        out = out.withColumn(c, F.explode(F.col(c)))
    return out.select(*columns)


def params_matrix(spark: SparkSession, params: Mapping[str, Sequence]) -> DataFrame:
    """Cartesian grid of a parameter dict (values are small literal lists)."""
    one = spark.range(1).select(*[F.array(*[F.lit(v) for v in vs]).alias(k) for k, vs in params.items()])
    return params_matrix_from_arrays(one, list(params))


def first_seen_distinct(df: DataFrame, group: Sequence[str], value: str, order: str, out: str = "values") -> DataFrame:
    """Per group, the distinct values in first-seen order (by ``order``).

    Each (group, value) is reduced to its first time before any list is
    built, so a list is bounded by the number of distinct values, not by
    the rows of the group.
    """
    first = df.groupBy(*group, value).agg(F.min(order).alias("_first"))
    lst = first.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("_first", value))).alias("_l"))
    return lst.select(*group, F.col(f"_l.{value}").alias(out))


def union_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing in a feed are NULL."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def concat_xy(x: DataFrame, y: DataFrame, keys: Sequence[str]) -> DataFrame:
    """X and y side by side on their time keys (inner)."""
    return x.join(y, on=list(keys), how="inner")


def outer_predictions(actual: DataFrame, predicted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Test labels full-outer-joined with predictions."""
    return actual.join(predicted, on=list(keys), how="full")


def missing_keys(src: DataFrame, dst: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``src`` absent from ``dst`` (left anti)."""
    return src.select(*keys).distinct().join(dst.select(*keys).distinct(), on=list(keys), how="left_anti")
