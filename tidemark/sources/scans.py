"""Scans (S1-S5, S10-S14) over landed, Hive-partitioned tables.

Every scan is declarative: partition predicates on ``exchange``/``symbol``/
``date`` (and ``feature``) become PartitionFilters, column lists become the
ReadSchema, so only the needed directories and columns are read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.functions import nan_to_null, split_instrument, yyyymmdd
from tidemark.operators.quality import dedupe_rows, dedupe_seq, fill_qty
from tidemark.schema import FEATURES_LONG, KEYS, MODEL_META, PATTERN_SCORES, QUOTE_COLUMNS


def day_list(start_date: str, end_date: str) -> list[str]:
    """Inclusive list of ``YYYYMMDD`` days (parameters, not data)."""
    s = dt.date.fromisoformat(_iso(start_date))
    e = dt.date.fromisoformat(_iso(end_date))
    return [(s + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range((e - s).days + 1)]


def day_list_hours(start_date: str, end_date: str, start_hour: str = "00:00:00.000",
                   end_hour: str = "23:59:59.999") -> list[str]:
    """Day list of a tick scan: steps of 24 h from ``start_date start_hour`` while not past
    ``end_date end_hour``. With the default hours every day is included; a later start
    hour than end hour drops the last day. Hours never cut rows, only days."""
    s = dt.datetime.fromisoformat(f"{_iso(start_date)} {start_hour}")
    e = dt.datetime.fromisoformat(f"{_iso(end_date)} {end_hour}")
    out = []
    while s <= e:
        out.append(s.strftime("%Y%m%d"))
        s += dt.timedelta(days=1)
    return out


def _iso(d: str) -> str:
    d = d.strip()[:10]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}" if len(d) == 8 and d.isdigit() else d


PARTITION_COLUMNS = ("exchange", "symbol", "feature", "target", "type", "run_id", "date")


def is_missing(e: AnalysisException) -> bool:
    """Whether a read failed because its path doesn't exist (any other failure must not look like an empty table)."""
    return (e.getCondition() or "") == "PATH_NOT_FOUND"


def _read(spark: SparkSession, root: str, schema: T.StructType | None = None,
          instrument_id: str | None = None) -> DataFrame:
    """Hive-partitioned Parquet with partition values kept as STRING (no type inference:
    a day '20240102' or a symbol '0700' must not turn into a number). One instrument is
    read from its own folder, so only that folder is listed."""
    path = root
    if instrument_id:
        ex, sy = instrument_id.split("_", 1)
        path = f"{root.rstrip('/')}/exchange={ex}/symbol={sy}"
    if schema is None:
        inferred = spark.read.option("basePath", root).parquet(path).schema
        schema = T.StructType([T.StructField(f.name, T.StringType(), True) if f.name in PARTITION_COLUMNS else f
                               for f in inferred.fields])
    return spark.read.option("basePath", root).schema(schema).parquet(path)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _time_col(df: DataFrame) -> Column:
    """Landed times are epoch milliseconds (LONG) or TIMESTAMP; return a TIMESTAMP."""
    f = df.schema["time"].dataType
    if isinstance(f, (T.LongType, T.IntegerType)):
        return F.timestamp_millis(F.col("time"))
    if isinstance(f, T.DoubleType):
        return F.timestamp_millis(F.col("time").cast("long"))
    return F.col("time").cast("timestamp")


def _partition_filter(instrument_id: str | None, start_date: str | None, end_date: str | None,
                      date: str | None) -> Column:
    cond = F.lit(True)
    if instrument_id:
        ex, sy = instrument_id.split("_", 1)
        cond = cond & (F.col("exchange") == ex) & (F.col("symbol") == sy)
    if start_date and end_date:
        cond = cond & F.col("date").isin(day_list(start_date, end_date))
    elif date:
        cond = cond & (F.col("date") == _iso(date).replace("-", ""))
    return cond


def scan_quotes(spark: SparkSession, root: str, instrument_id: str | None = None, start_date: str | None = None,
                end_date: str | None = None, date: str | None = None,
                columns: Sequence[str] = QUOTE_COLUMNS) -> DataFrame:
    """Quotes of one instrument (or all), pruned by day list / one day / all days.

    Projects ``columns + seq + time``, dedupes by seq (D1), converts epoch ms,
    fills qty NULLs with 0 (P4), NaN -> NULL. Not globally sorted: order is
    a property of each windowed operator, not of the scan.
    """
    df = _read(spark, root, instrument_id=instrument_id)
    df = df.where(_partition_filter(instrument_id, start_date, end_date, date))
    cols = [c for c in columns if c in df.columns]
    df = df.select("exchange", "symbol", "date", "seq", _time_col(df).alias("time"),
                   *[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    df = dedupe_seq(df, keys=("exchange", "symbol"))
    return fill_qty(df)


def scan_ticks(spark: SparkSession, root: str, instrument_id: str, start_date: str, end_date: str,
               start_hour: str | None = None, end_hour: str | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Historical ticks; hours only widen or narrow the day list (rows are not cut by hour).

    A missing root or instrument gives an empty frame with the quote schema. Full-row
    dedupe ignoring time (D2) over every landed column, so ticks that differ
    in ``seq`` alone stay apart; ``columns`` are selected after it (default: all).
    """
    days = day_list_hours(start_date, end_date, start_hour or "00:00:00.000", end_hour or "23:59:59.999")
    schema = T.StructType([T.StructField("exchange", T.StringType()), T.StructField("symbol", T.StringType()),
                           T.StructField("time", T.TimestampType())]
                          + [T.StructField(c, T.DoubleType()) for c in (columns or QUOTE_COLUMNS)])
    try:
        df = _read(spark, root, instrument_id=instrument_id)
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return _empty(spark, schema)
    ex, sy = instrument_id.split("_", 1)
    df = df.where((F.col("exchange") == ex) & (F.col("symbol") == sy) & F.col("date").isin(days))
    others = [c for c in df.columns if c not in ("exchange", "symbol", "date", "time")]
    df = df.select("exchange", "symbol", _time_col(df).alias("time"),
                   *[nan_to_null(F.col(c).cast("double")).alias(c) if c in QUOTE_COLUMNS else F.col(c) for c in others])
    df = dedupe_rows(df)
    return df.select("exchange", "symbol", "time", *[c for c in (columns or others) if c in df.columns])


def scan_features(spark: SparkSession, root: str, features: Sequence[str], instrument_id: str | None = None,
                  start_date: str | None = None, end_date: str | None = None, date: str | None = None,
                  keys: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """Long feature rows -> one wide row per (instrument, time).

    One pruned scan (``feature IN list`` is a partition filter) and one
    pivot with a fixed value list (a single shuffle), outer-aligned on time.
    """
    df = _read(spark, root, FEATURES_LONG, instrument_id)
    df = df.where(_partition_filter(instrument_id, start_date, end_date, date) & F.col("feature").isin(list(features)))
    return features_wide(df, features, keys)


def features_wide(long_df: DataFrame, features: Sequence[str], keys: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """M6: long features (``feature``, ``value``) to one column per feature.

    Conditional aggregates over a fixed feature list: one shuffle on
    (instrument, time), partial aggregation before it.
    """
    return long_df.groupBy(*keys, "time").agg(*[
        F.first(F.when(F.col("feature") == F.lit(f), F.col("value")), ignorenulls=True).alias(f) for f in features])


def scan_directory(spark: SparkSession, path: str) -> DataFrame:
    """Lazy scan of a whole Parquet directory."""
    return spark.read.parquet(path)


def _range_bound(value: str, end: bool) -> Column:
    v = value.strip()
    if end:
        v = v + " 23:59:59.999" if len(v) <= 10 else (v + ".999" if "." not in v else v)
    return F.lit(v).cast("timestamp")


def scan_points(df: DataFrame, start: str, end: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Open interval ``start < time < end``; a date-only end means 23:59:59.999 of that day."""
    d = df.where((F.col("time") > _range_bound(start, False)) & (F.col("time") < _range_bound(end, True)))
    return d.select(*fields) if fields else d


def read_sql_table(spark: SparkSession, name: str, jdbc_url: str | None = None, properties: dict | None = None) -> DataFrame:
    """A report table by name — catalog table, or JDBC when a URL is given."""
    if jdbc_url:
        return spark.read.jdbc(jdbc_url, name, properties=properties or {})
    return spark.table(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; give a schema in production (no inference pass)."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def read_meta(spark: SparkSession, path: str, schema: T.StructType = MODEL_META) -> DataFrame:
    """Model meta documents (one JSON file each, as K11 writes them); malformed ones are skipped."""
    s = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType(), True)])
    raw = spark.read.option("wholetext", True).text(path)
    doc = F.from_json("value", s, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    d = raw.select(doc.alias("m")).where("m is not null and m._corrupt_record is null")
    return d.select(*[F.col(f"m.`{f.name}`").alias(f.name) for f in schema.fields])


def list_models(registry: DataFrame, exchange: str = "*", symbol: str = "*", target: str = "*", type_: str = "*",
                run_id: str = "*") -> DataFrame:
    """Registry rows matching wildcards (``*`` = any) on the partition columns."""
    d = registry
    for col, v in (("exchange", exchange), ("symbol", symbol), ("target", target), ("type", type_), ("run_id", run_id)):
        if v != "*":
            d = d.where(F.col(col).like(v.replace("*", "%")))
    return d


def load_buy_patterns(spark: SparkSession, path: str) -> DataFrame:
    """The buy set of a stored pattern table (score == 1), by instrument: ``exchange, symbol, pattern``."""
    keys = [T.StructField(k, T.StringType(), True) for k in KEYS]
    schema = T.StructType(keys + PATTERN_SCORES.fields)
    return spark.read.schema(schema).parquet(path).where(F.col("score") == F.lit(1.0)).select(*KEYS, "pattern")


def landed_quotes(df: DataFrame) -> DataFrame:
    """Adds the partition columns of a quote frame: date (UTC) from time, split instrument if needed."""
    out = df
    if "exchange" not in out.columns and "instrument_id" in out.columns:
        ex, sy = split_instrument("instrument_id")
        out = out.withColumn("exchange", ex).withColumn("symbol", sy)
    return out.withColumn("date", yyyymmdd("time"))
