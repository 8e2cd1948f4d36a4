"""Sinks (K1-K12): partitioned Parquet landing, mirrors, purges, reports, models.

Writes go through a ``rebalance`` hint on the partition columns: AQE
splits a skewed (instrument, day) into several files and merges tiny ones,
so a hot instrument does not become one giant task or file.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions import yyyymmdd
from tidemark.operators.quality import non_empty
from tidemark.session import materialize
from tidemark.sources.scans import is_missing

TICK_PARTITIONS = ("exchange", "symbol", "date")
FEATURE_PARTITIONS = ("exchange", "symbol", "feature", "date")


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str], mode: str = "overwrite",
                      sort_col: str | None = "time", skip_empty: bool = False) -> bool:
    """Write ``df`` partitioned by ``partitions``; overwrite replaces only the partitions present.

    Returns False (and writes nothing) when ``skip_empty`` and ``df`` is empty (D7).
    """
    if skip_empty and not non_empty(df):
        return False
    out = df.hint("rebalance", *partitions)
    if sort_col and sort_col in df.columns:
        out = out.sortWithinPartitions(*partitions, sort_col)
    # per-write dynamic overwrite: only the partitions present are replaced (no session change)
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))
    return True


def write_ticks(df: DataFrame, path: str, mode: str = "overwrite", skip_empty: bool = True) -> bool:
    """K1: ticks -> Parquet partitioned by exchange/symbol/date (UTC day)."""
    d = df if "date" in df.columns else df.withColumn("date", yyyymmdd("time"))
    return write_partitioned(d, path, TICK_PARTITIONS, mode, "time", skip_empty)


def features_long(wide: DataFrame, features: Sequence[str], keys: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """M5: wide feature columns -> long rows (time, value, keys, feature, date); NULL values dropped."""
    stack = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in features)
    lng = wide.selectExpr(*keys, "time", f"stack({len(features)}, {stack}) AS (feature, value)")
    return lng.where(F.col("value").isNotNull()).withColumn("date", yyyymmdd("time")).select(
        "time", "value", *keys, "feature", "date")


def write_features(long_df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """K2: long features partitioned by exchange/symbol/feature/date; empty input -> no write."""
    return write_partitioned(long_df, path, FEATURE_PARTITIONS, mode, "time", skip_empty=True)


def write_dataset_csv(df: DataFrame, path: str, meta: dict | None = None) -> None:
    """K3: dataset as CSV (header) plus a one-row JSON meta document next to it."""
    df.write.mode("overwrite").option("header", True).csv(f"{path}/data")
    m = dict(meta or {})
    m.setdefault("columns", df.columns)
    df.sparkSession.createDataFrame([(json.dumps(m, sort_keys=True),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/meta")


def append_report(df: DataFrame, table: str, created_at: int, jdbc_url: str | None = None,
                  properties: dict | None = None) -> None:
    """K4: append report rows with ``created_at`` (epoch seconds, a parameter) to a table, or to Parquet files where
    ``table`` is a path.

    Failures propagate: no silent replace of the whole table.
    """
    d = df.withColumn("created_at", F.lit(int(created_at)).cast("long"))
    if jdbc_url:
        d.write.jdbc(jdbc_url, table, mode="append", properties=properties or {})
    elif "/" in table:
        d.write.mode("append").parquet(table)
    else:
        d.write.mode("append").saveAsTable(table)


def insert_run_context(spark: SparkSession, context: DataFrame, path: str) -> DataFrame:
    """K5: append (run_id, context JSON) rows whose run_id is not stored yet; returns the new rows."""
    new = context.select("run_id", F.col("context").cast("string").alias("context")).dropDuplicates(["run_id"])
    try:
        existing = spark.read.parquet(path).select("run_id")
        new = new.join(existing, on="run_id", how="left_anti")
    except AnalysisException as e:
        if not is_missing(e):
            raise
    new.write.mode("append").parquet(path)
    return new


def write_signal_tables(reports: DataFrame, path: str, signal_col: str = "signal", by: str = "sharp_ratio") -> None:
    """K6: one output per signal (a partition), replaced per signal, rows sorted by ``by`` desc."""
    (reports.hint("rebalance", signal_col).sortWithinPartitions(signal_col, F.col(f"`{by}`").desc())
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(signal_col).parquet(path))


def overwrite_table(df: DataFrame, path: str) -> None:
    """K7 / K8: publish a named dataset, replacing the previous version."""
    df.write.mode("overwrite").parquet(path)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def partition_keys(spark: SparkSession, path: str, partitions: Sequence[str]) -> DataFrame:
    """Distinct partition values of a landed table (answered from partition columns)."""
    from tidemark.sources.scans import _read

    return _read(spark, path).select(*partitions).distinct()


def mirror_partitions(spark: SparkSession, src: str, dst: str, partitions: Sequence[str] = TICK_PARTITIONS,
                      where: str | None = None, force: bool = False) -> DataFrame:
    """K9: copy the partitions of ``src`` missing in ``dst`` (all when ``force``); returns the copied keys.

    Missing keys = distinct source keys ``left_anti`` destination keys; the
    copy reads the source pruned to those keys (a semi join on partition
    columns, eligible for dynamic partition pruning) and overwrites only
    those partitions. Running it twice copies nothing the second time.
    """
    from tidemark.sources.scans import _read

    parts = list(partitions)
    src_df = _read(spark, src)
    if where:
        src_df = src_df.where(where)
    keys = src_df.select(*parts).distinct()
    if not force:
        try:
            keys = keys.join(partition_keys(spark, dst, parts), on=parts, how="left_anti")
        except AnalysisException as e:
            if not is_missing(e):
                raise
    keys = materialize(keys)  # one row per partition directory; fixed before the copy changes the answer
    if keys.isEmpty():
        return keys
    data = src_df.join(keys, on=parts, how="left_semi")
    write_partitioned(data.select(*src_df.columns), dst, parts, mode="overwrite", sort_col="time")
    return keys


def purge_partitions(spark: SparkSession, path: str, exchange: str, symbol: str, dates: Sequence[str],
                     confirm: bool = False) -> list[str]:
    """Drop the given day partitions of one instrument; dry run unless ``confirm``.

    Uses the Hadoop FileSystem of the path (HDFS, object stores, local).
    Returns the partition directories that exist (and were deleted when confirmed).
    """
    fs, _ = _hadoop_fs(spark, path)
    jvm = spark.sparkContext._jvm
    found = []
    for d in dates:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/exchange={exchange}/symbol={symbol}/date={d}")
        if fs.exists(p):
            found.append(p.toString())
            if confirm:
                fs.delete(p, True)
    return found


def write_predictions(pred: DataFrame, path: str, keys: Sequence[str] = ("time",)) -> None:
    """Prediction output (keys, prediction)."""
    pred.select(*keys, "prediction").write.mode("overwrite").parquet(path)
