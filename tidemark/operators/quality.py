"""Dedupe, data quality and cleaning operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import as_ts, epoch_micros, inf_to_null, week_of_year_sunday, yyyymmdd
from tidemark.plans.chunking import segmented_prev
from tidemark.schema import KEYS, QTY_COLUMNS
from tidemark.session import landed


# --- dedupe ---------------------------------------------------------------------------------

def dedupe_seq(df: DataFrame, keys: Sequence[str] = KEYS, seq: str = "seq", time_col: str = "time") -> DataFrame:
    """One row per (keys, seq), the last by time.

    Spark has no file order, so "last" is the latest ``time``; remaining
    ties are broken by the other columns so the choice is deterministic.
    A grouped ``max_by`` (partial aggregation) rather than a window: no
    sort of the whole partition, and a hot key is pre-reduced map-side.
    """
    others = [c for c in df.columns if c not in (*keys, seq)]
    order = F.struct(F.col(time_col), *[F.col(c) for c in others if c != time_col])
    return (
        df.groupBy(*keys, seq)
        .agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_r"))
        .select(*keys, seq, "_r.*")
        .select(*df.columns)
    )


def dedupe_rows(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Drop rows equal in every column but time; keep the last (latest time)."""
    others = [c for c in df.columns if c != time_col]
    return df.groupBy(*others).agg(F.max(time_col).alias(time_col)).select(*df.columns)


def dedupe_within_watermark(df: DataFrame, keys: Sequence[str] = KEYS, seq: str = "seq") -> DataFrame:
    """D1 for streams: drop repeated (keys, seq) inside the watermark delay."""
    return df.dropDuplicatesWithinWatermark([*keys, seq])


# --- gaps / coverage ------------------------------------------------------------------------

def seq_gaps(df: DataFrame, keys: Sequence[str] = KEYS, seq: str = "seq", time_col: str = "time",
             span: int = 3600) -> DataFrame:
    """D3: rows whose seq is not previous seq + 1, with ``seq_previous`` and ``gap``.

    The first row of each key is kept (its previous is missing, so the
    check is true). The previous row comes from a chunked scan.
    """
    d = df.withColumn("_tus", epoch_micros(time_col))
    d = segmented_prev(d, keys, order=F.struct(F.col("_tus"), F.col(seq)), value=F.col(seq), out="seq_previous",
                       span=int(span) * 1_000_000, chunk_source=F.col("_tus"))
    gap = ~(F.col(seq) - F.lit(1)).eqNullSafe(F.col("seq_previous"))
    return d.withColumn("gap", gap).where(F.col("gap")).drop("_tus")


def coverage(df: DataFrame, keys: Sequence[str] = KEYS, time_col: str = "time") -> DataFrame:
    """D4 (long form): one row per (instrument, day) that has data, with its ``%U`` week.

    Reads only the partition columns when ``date`` exists, so a landed
    table answers from partition metadata.
    """
    if "date" in df.columns:
        d = df.select(*keys, F.try_to_timestamp(F.col("date"), F.lit("yyyyMMdd")).cast("date").alias("_d"))
    else:
        d = df.select(*keys, F.to_date(as_ts(time_col)).alias("_d"))
    d = d.distinct()
    return d.select(
        *keys,
        F.concat_ws("_", *[F.col(k) for k in keys]).alias("instrument"),
        F.date_format("_d", "yyyyMMdd").alias("date"),
        week_of_year_sunday("_d").alias("week"),
        F.lit("OK").alias("status"),
    )


def coverage_map(df: DataFrame, keys: Sequence[str] = KEYS, time_col: str = "time",
                 instruments: Sequence[str] | None = None) -> DataFrame:
    """D4 (wide form): date x instrument -> 'OK' / NULL, grouped by week for display.

    ``instruments`` fixes the pivot values (otherwise Spark computes the
    distinct list first: one extra small job).
    """
    cov = coverage(df, keys, time_col)
    g = cov.groupBy("week", "date")
    g = g.pivot("instrument", list(instruments)) if instruments is not None else g.pivot("instrument")
    return g.agg(F.first("status"))


def missing_partitions(df: DataFrame, keys: Sequence[str] = KEYS, time_col: str = "time") -> DataFrame:
    """(instrument, day) cells where some instrument has data on that day but this one has not.

    The set of all days is a scalar subquery (one array, bounded by the
    calendar span, not by the data volume); each instrument subtracts its
    own days from it. No join, no pairing of rows.
    """
    cov = coverage(df, keys, time_col)
    all_days = cov.select("date").distinct().agg(F.sort_array(F.collect_list("date"))).scalar()
    per = cov.groupBy(*keys).agg(F.collect_set("date").alias("_own"))
    return per.select(*keys, F.explode(F.array_except(all_days, F.col("_own"))).alias("date"))


def feed_dates(df: DataFrame, keys: Sequence[str] = KEYS, price: str = "bid_price",
               time_col: str = "time") -> DataFrame:
    """First and last quote time per feed (rows with a price only)."""
    t = F.when(F.col(price).isNotNull(), F.col(time_col))
    return df.groupBy(*keys).agg(F.min(t).alias("first"), F.max(t).alias("last"))


def non_empty(df: DataFrame) -> bool:
    """Store-only-if-non-empty guard (reads at most one row)."""
    return not df.isEmpty()


# --- cleaning -------------------------------------------------------------------------------

def fill_qty(df: DataFrame, columns: Sequence[str] = QTY_COLUMNS) -> DataFrame:
    """Quantities NULL -> 0."""
    return df.na.fill(0.0, [c for c in columns if c in df.columns])


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """P5: drop rows with any NULL (or NaN) in ``subset``."""
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def clean_numeric(df: DataFrame, columns: Sequence[str] | None = None, drop: bool = True) -> DataFrame:
    """+-inf and NaN -> NULL, then drop rows with NULLs in those columns."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    d = df.select(*[inf_to_null(c).alias(c) if c in cols else F.col(c) for c in df.columns])
    return d.na.drop(how="any", subset=cols) if drop else d


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Non-null count per column (long form, one aggregate pass) and the row total.

    Output: column, non_null, nulls, rows. Sort by non_null desc for display.
    """
    cols = list(columns) if columns is not None else list(df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', `_nn_{i}`" for i, c in enumerate(cols))
    long = agg.selectExpr("_rows", f"stack({len(cols)}, {stack}) AS (column, non_null)")
    return long.select(
        F.col("column"), F.col("non_null"), (F.col("_rows") - F.col("non_null")).alias("nulls"), F.col("_rows").alias("rows")
    )


def dropped_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """How many rows ``dropna`` would remove (one aggregate)."""
    cols = list(subset) if subset else list(df.columns)
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) if len(cols) > 1 else F.col(cols[0]).isNull().cast("int")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(any_null).alias("dropped"))


def length_guard(df: DataFrame, min_rows: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keep only keys with at least ``min_rows`` rows.

    The per-key count is a small aggregate joined back; AQE turns the join
    into a broadcast at runtime when the count table is small.
    """
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= F.lit(int(min_rows)))
    return df.join(n.select(*keys), on=list(keys), how="left_semi")


def label_encode(df: DataFrame, column: str, out: str | None = None) -> DataFrame:
    """Classes -> 0..k-1 in sorted order.

    The ranking runs on the distinct classes only (one row per class), cut into ranges: a class's index is its place
    in its range plus the classes in the ranges before, so any number of classes is ranked in parallel.
    """
    out = out or f"{column}_index"
    name = F.col(f"`{column}`")
    classes = df.select(name).distinct().where(name.isNotNull()).repartitionByRange(name)
    classes = landed(classes.withColumn("_part", F.spark_partition_id()), "classes")
    before = Window.partitionBy().orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)      # a row a range
    sizes = classes.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(name))
    ranked = classes.join(sizes, "_part").select(name, (F.col("_before") + place - 1).cast("int").alias(out))
    return df.join(ranked, on=column, how="left")


def after(df: DataFrame, end: str | Column, time_col: str = "time") -> DataFrame:
    """P10: rows strictly after the training end."""
    e = F.lit(end).cast("timestamp") if isinstance(end, str) else end
    return df.where(as_ts(time_col) > e)


def last_hours(df: DataFrame, now: str, hours: float, time_col: str = "time") -> DataFrame:
    """Rows in [now - hours, now]; ``now`` is a parameter (no wall clock inside plans)."""
    n = F.lit(now).cast("timestamp")
    lo = n - F.make_interval(secs=F.lit(float(hours) * 3600.0))
    return df.where((as_ts(time_col) >= lo) & (as_ts(time_col) <= n))


def to_float32(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """float32 cast before fitting."""
    return df.select(*[F.col(c).cast("float").alias(c) if c in columns else F.col(c) for c in df.columns])


def select_regex(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Keep columns whose name matches any regex (schema-time, no data read)."""
    import re

    regs = [re.compile(p) for p in patterns]
    return df.select(*[c for c in df.columns if any(r.search(c) for r in regs)])


def split_xy(df: DataFrame, marker: str = "profit") -> tuple[list[str], list[str]]:
    """Feature columns (no ``marker`` in the name) and target columns."""
    y = [c for c in df.columns if marker in c]
    x = [c for c in df.columns if marker not in c]
    return x, y


def add_date_parts(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Partition helper: ``date`` = yyyyMMdd of the UTC time."""
    return df.withColumn("date", yyyymmdd(time_col))


def order_by_time(df: DataFrame, keys: Sequence[str] = KEYS, time_col: str = "time") -> DataFrame:
    """O1: rows in time order for output. A global sort is a range shuffle, so
    operators never sort internally; writers sort within partitions instead."""
    return df.orderBy(time_col, *keys)


def preview(df: DataFrame, n: int = 10) -> list:
    """The first ``n`` rows for display (a bounded ``take``)."""
    return df.take(int(n))
