"""Metric exports and points."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import anchored, as_ts, yyyymmdd
from tidemark.schema import METRIC_EXPORT, METRIC_FIELDS
from tidemark.session import landed

#: Ticks, or single metric values, that one task merges: the number of partitions grows with the rows, so a task's memory doesn't.
TASK_TICKS, TASK_VALUES, LEAST_TASKS = 1 << 18, 1 << 20, 8


def read_metric_export(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines ``{metric, timestamps: [ms...], values: [...]}`` with a declared schema."""
    return spark.read.schema(METRIC_EXPORT).json(path)


def metrics_long(export: DataFrame, fields: Sequence[str] = METRIC_FIELDS) -> DataFrame:
    """Explode each export into (exchange, symbol, field, ts_ms, pos, value).

    Metric names are ``<EXCHANGE>_<SYMBOL>_<field>``; the field is matched as
    a known suffix (symbols may contain '_'), the instrument splits on the
    first '_'.
    """
    alt = "|".join(sorted(fields, key=len, reverse=True))
    m = F.regexp_extract("metric", rf"^(.+)_({alt})$", 1)
    fld = F.regexp_extract("metric", rf"^(.+)_({alt})$", 2)
    d = export.select(m.alias("_inst"), fld.alias("field"),
                      F.posexplode(F.arrays_zip(F.col("timestamps").alias("ts"), F.col("values").alias("v"))))
    parts = F.split(F.col("_inst"), "_", 2)
    return d.where(F.col("field") != "").select(
        parts.getItem(0).alias("exchange"), parts.getItem(1).alias("symbol"), "field",
        F.col("col.ts").alias("ts_ms"), F.col("pos"), F.col("col.v").alias("value"))


def metrics_to_ticks(export: DataFrame, fields: Sequence[str] = METRIC_FIELDS) -> DataFrame:
    """Merge the per-metric series of each instrument by timestamp into wide ticks.

    A metric absent at a timestamp is NULL; a repeated (metric, timestamp)
    keeps the later array position. The export is landed, which tells how many
    values there are; they are dealt by instrument and timestamp to as many
    tasks as they need, and each merges its own in one aggregate.
    """
    export = landed(export.select("metric", "timestamps", "values"), "export")
    lng = metrics_long(export, fields)
    total = export.agg(F.sum(F.size("timestamps").cast("long"))).first()[0] or 0
    dealt = lng.repartition(max(LEAST_TASKS, math.ceil(total / TASK_VALUES)), "symbol", "ts_ms")
    of = lambda f, c: F.when(F.col("field") == f, F.col(c))
    wide = dealt.groupBy("exchange", "symbol", "ts_ms").agg(*[F.max_by(of(f, "value"), of(f, "pos")).alias(f) for f in fields])
    return wide.select("exchange", "symbol", F.timestamp_millis("ts_ms").alias("time"),
                       *[F.col(f).alias(f) for f in fields]).withColumn("date", yyyymmdd("time"))


def ticks_to_metrics(ticks: DataFrame, fields: Sequence[str] = METRIC_FIELDS,
                     chunk_seconds: int = 3600) -> DataFrame:
    """Inverse of S6 (exports for tests and backfills): export rows per instrument metric.

    One export row per (instrument, metric, time chunk), so no array grows
    with the data: a hot instrument yields more rows, not bigger ones.
    """
    present = [f for f in fields if f in ticks.columns]
    d = ticks.select("exchange", "symbol", F.unix_millis(F.col("time").cast("timestamp")).alias("_ts"),
                     *[F.col(f"`{f}`").cast("double").alias(f"_v{i}") for i, f in enumerate(present)])
    d = d.withColumn("_chunk", F.floor(F.col("_ts") / F.lit(int(chunk_seconds) * 1000)))
    # a chunk's ticks meet once, in as many tasks as the ticks need, and give one array per metric
    d = d.repartition(max(LEAST_TASKS, math.ceil(ticks.count() / TASK_TICKS)), "symbol", "_chunk")
    g = d.groupBy("exchange", "symbol", "_chunk").agg(
        F.collect_list(F.struct("_ts", *[f"_v{i}" for i in range(len(present))])).alias("_rows"))

    def series(f: str, v: str):
        known = F.filter("_rows", lambda r: r[v].isNotNull())
        return F.struct(F.lit(f).alias("field"), F.sort_array(F.transform(known, lambda r: F.struct(r["_ts"].alias("ts"), r[v].alias("v")))).alias("s"))

    g = g.select("exchange", "symbol", F.explode(F.array(*[series(f, f"_v{i}") for i, f in enumerate(present)])).alias("m")).where(F.size("m.s") > 0)
    return g.select(F.concat_ws("_", "exchange", "symbol", "m.field").alias("metric"),
                    F.col("m.s.ts").alias("timestamps"), F.col("m.s.v").alias("values"))


def normalize_points(points: DataFrame) -> DataFrame:
    """UTC time, upper-case exchange/symbol, ``YYYYMMDD`` date, epoch seconds (truncated)."""
    t = F.try_to_timestamp(F.col("time")) if dict(points.dtypes)["time"] == "string" else as_ts("time")
    return (points.withColumn("time", t)
            .withColumn("exchange", F.upper("exchange"))
            .withColumn("symbol", F.upper("symbol"))
            .withColumn("date", yyyymmdd("time"))
            .withColumn("database_timestamp", F.unix_seconds(F.col("time")).cast("double")))


def instrument_catalog(names: DataFrame, pattern: str | None = None, name_col: str = "metric") -> DataFrame:
    """Distinct instruments = first three '_' tokens of metric names, optionally regex-filtered."""
    inst = F.array_join(F.slice(F.split(F.col(name_col), "_"), 1, 3), "_")
    d = names.select(inst.alias("instrument")).distinct()
    return d.where(F.col("instrument").rlike(anchored(pattern))) if pattern else d


def series_filter(names: DataFrame, pattern: str, name_col: str = "series") -> DataFrame:
    """Distinct series names matching an anchored regex (``re.match`` semantics)."""
    return names.select(name_col).distinct().where(F.col(name_col).rlike(anchored(pattern)))


def flatten_distinct(df: DataFrame, col: str) -> DataFrame:
    """Flatten an array-of-arrays column keeping first-seen order, without repeats."""
    return df.select(F.array_distinct(F.flatten(F.col(col))).alias(col))
