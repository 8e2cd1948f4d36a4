"""Time-grid operators: G1 resample-last-fill, G2 forward as-of, G3 candles, G4 align."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import bucket, epoch_micros, seconds_to_ts
from tidemark.plans.chunking import CHUNK, auto_span, chunk_of, explode_points, segmented_prev
from tidemark.schema import KEYS


def _last_non_null(c: str, order: Column) -> Column:
    # max_by skips rows whose ordering is NULL, so this is "last non-null by order".
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order))


_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


def _packed_order(time_col: str, tiebreak: str) -> Column:
    """(time in microseconds, tie-break) as one decimal(38): the tie-break takes the lower 65 bits, null lowest."""
    low = F.coalesce(F.col(tiebreak).cast("decimal(20,0)"), F.lit(Decimal(-(1 << 63) - 1)))
    return (epoch_micros(time_col).cast("decimal(17,0)") * F.lit(Decimal(1 << 65)) + low).cast("decimal(38,0)")


def _ordered(df: DataFrame, time_col: str, tiebreak: str | None) -> tuple[DataFrame, Column]:
    """(frame, order of its rows): the packed number where the tie-break is an integer, else time or a struct."""
    if not tiebreak:
        return df, F.col(time_col)
    if df.schema[tiebreak].dataType in _INTEGERS:
        return df.withColumn("_order", _packed_order(time_col, tiebreak)), F.col("_order")
    return df, F.struct(F.col(time_col), F.col(tiebreak))


def _first_non_null(c: str, order: Column) -> Column:
    return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order))


def bucket_last(
    df: DataFrame,
    freq: int,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    time_col: str = "time",
    tiebreak: str | None = "seq",
) -> DataFrame:
    """One row per populated (keys, bucket): last non-null value of each column.

    "Last" is by time, then by ``tiebreak`` (the feed sequence), so the
    result does not depend on file order. Partial aggregation runs before
    the shuffle, so hot instruments are pre-reduced map-side. An integer
    tie-break is packed with the time into one fixed-width number, which the
    hash aggregate can hold (a struct would sort all rows first).
    """
    d, order = _ordered(df.withColumn("g", bucket(time_col, freq)), time_col, tiebreak)
    return d.groupBy(*keys, "g").agg(*[_last_non_null(c, order).alias(c) for c in columns])


def resample_last(
    df: DataFrame,
    freq: int = 1,
    columns: Sequence[str] = ("bid_price", "ask_price"),
    keys: Sequence[str] = KEYS,
    fill: str = "bfill",
    time_col: str = "time",
    tiebreak: str | None = "seq",
    span: int | None = None,
    with_length: bool = False,
) -> DataFrame:
    """G1: dense ``freq``-second grid, last non-null per column per bucket, then fill.

    fill='bfill' (the reference default) fills empty buckets and NULL cells
    with the NEXT non-null value of the column (look-ahead); 'ffill' with the
    previous one; 'none' leaves them NULL. The grid runs from the first to the
    last populated bucket of each key.

    Output: ``*keys, g (epoch s), time, *columns`` and, with ``with_length``,
    ``grid_rows`` = number of grid rows of the key (for length guards).

    Plan: bucket aggregate (partial agg) -> per (key, chunk) window for the
    local fill -> per-chunk summary carries values across chunk borders ->
    each populated bucket emits the gap before (bfill) or after (ffill) it.
    No window is ever partitioned by the key alone.
    """
    if fill not in ("bfill", "ffill", "none"):
        raise ValueError(f"fill must be bfill, ffill or none, got {fill!r}")
    keys = list(keys)
    columns = list(columns)
    f = int(freq)
    span = int(span or auto_span(f))
    b = bucket_last(df, f, columns, keys, time_col, tiebreak).withColumn(CHUNK, chunk_of("g", span))
    # Explicit key filters: the join below would otherwise infer them on one
    # branch only, and the two branches could not share one bucket exchange.
    nn_keys = F.col(CHUNK).isNotNull()
    for k in keys:
        nn_keys = nn_keys & F.col(k).isNotNull()
    b = b.where(nn_keys)

    # Per-chunk summary (one row per chunk), taken from the bucket table itself so
    # that both branches share the same bucket exchange (no second scan).
    summ_aggs = [F.min("g").alias("_ming"), F.max("g").alias("_maxg")]
    if fill == "bfill":
        summ_aggs += [_first_non_null(c, F.col("g")).alias(f"_edge_{c}") for c in columns]
    elif fill == "ffill":
        summ_aggs += [_last_non_null(c, F.col("g")).alias(f"_edge_{c}") for c in columns]
    summ = b.groupBy(*keys, CHUNK).agg(*summ_aggs)

    w_asc = Window.partitionBy(*keys, CHUNK).orderBy("g")
    running = Window.partitionBy(*keys, CHUNK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if fill == "ffill":
        # each bucket emits the gap after it: the next populated bucket bounds it
        w_run = running.orderBy("g")
        b = b.withColumn("_nb", F.lead("g").over(w_asc))
    else:
        # bfill / none: each bucket emits the gap before it
        w_run = running.orderBy(F.col("g").desc())
        b = b.withColumn("_nb", F.lag("g").over(w_asc))
    if fill != "none":
        for c in columns:
            b = b.withColumn(c, F.last(c, ignorenulls=True).over(w_run))

    per_key = Window.partitionBy(*keys)
    sw = per_key.orderBy(CHUNK)
    carry_cols = [F.col(k) for k in keys] + [F.col(CHUNK)]
    if fill == "bfill":
        later = per_key.orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
        carry_cols += [F.last(f"_edge_{c}", ignorenulls=True).over(later).alias(f"_carry_{c}") for c in columns]
        carry_cols.append(F.lag("_maxg").over(sw).alias("_nb_carry"))
    elif fill == "ffill":
        earlier = sw.rowsBetween(Window.unboundedPreceding, -1)
        carry_cols += [F.last(f"_edge_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns]
        carry_cols.append(F.lead("_ming").over(sw).alias("_nb_carry"))
    else:
        carry_cols.append(F.lag("_maxg").over(sw).alias("_nb_carry"))
    if with_length:
        carry_cols.append(
            ((F.max("_maxg").over(per_key) - F.min("_ming").over(per_key)) / F.lit(f) + F.lit(1))
            .cast("long")
            .alias("grid_rows")
        )
    carry = summ.select(*carry_cols)

    j = b.join(carry, on=[*keys, CHUNK], how="inner")
    if fill != "none":
        for c in columns:
            j = j.withColumn(c, F.coalesce(F.col(c), F.col(f"_carry_{c}")))
    nb = F.coalesce(F.col("_nb"), F.col("_nb_carry"))
    if fill == "ffill":
        lo, hi = F.col("g"), F.coalesce(nb - F.lit(f), F.col("g"))
    else:
        lo, hi = F.coalesce(nb + F.lit(f), F.col("g")), F.col("g")
    out = explode_points(j.withColumn("_src", F.col("g")), lo, hi, f, "g").select(
        *keys, "_src", "g", *columns, *(["grid_rows"] if with_length else []))
    if fill == "none":
        out = out.select(
            *keys, "g", *[F.when(F.col("g") == F.col("_src"), F.col(c)).alias(c) for c in columns],
            *(["grid_rows"] if with_length else []),
        )
    return out.select(*keys, "g", seconds_to_ts("g").alias("time"), *columns,
                      *(["grid_rows"] if with_length else []))


def resample_asof_next(
    df: DataFrame,
    freq: int = 1,
    columns: Sequence[str] = ("bid_price", "ask_price"),
    keys: Sequence[str] = KEYS,
    time_col: str = "time",
    tiebreak: str = "seq",
    span: int = 3600,
    dropna: bool = True,
) -> DataFrame:
    """At each grid point t take the whole first raw row at or after t.

    Grid = floor(first)..floor(last) per key. Rows with equal time: the one
    with the highest ``tiebreak`` wins. A raw row r serves the grid points in
    (previous row's time, r.time]; the previous row comes from a chunked scan
    (``segmented_prev``), so no window spans a whole key. Then NULL rows are
    dropped (``dropna``), as the reference does after its resample.
    """
    keys = list(keys)
    f = int(freq)
    d = df.select(*keys, F.col(time_col).cast("timestamp").alias("_t"), F.col(tiebreak).alias("_tb"), *columns)
    d = d.withColumn("_tus", F.unix_micros("_t"))
    d = segmented_prev(
        d,
        keys,
        order=F.struct(F.col("_tus"), -F.col("_tb")),
        value=F.col("_tus"),
        out="_prev_us",
        span=int(span) * 1_000_000,
        chunk_source=F.col("_tus"),
    )
    step_us = f * 1_000_000
    hi = F.floor(F.col("_tus") / F.lit(step_us)) * F.lit(f)
    lo = F.when(F.col("_prev_us").isNull(), hi).otherwise(
        F.floor(F.col("_prev_us") / F.lit(step_us)) * F.lit(f) + F.lit(f)
    )
    out = explode_points(d, lo, hi, f, "g")
    out = out.select(*keys, "g", seconds_to_ts("g").alias("time"), *columns)
    return out.na.drop(how="any", subset=list(columns)) if dropna else out


def candles(
    df: DataFrame,
    freq: int = 300,
    column: str = "bid_price",
    keys: Sequence[str] = KEYS,
    time_col: str = "time",
    tiebreak: str | None = "seq",
) -> DataFrame:
    """OHLC candles per ``freq`` seconds (only populated buckets).

    open/close = first/last non-null value by (time, tiebreak).
    """
    d, order = _ordered(df.withColumn("g", bucket(time_col, freq)), time_col, tiebreak)
    nn = F.col(column).isNotNull()
    return (
        d.groupBy(*keys, "g")
        .agg(
            F.min_by(F.col(column), F.when(nn, order)).alias("open"),
            F.max(column).alias("high"),
            F.min(column).alias("low"),
            F.max_by(F.col(column), F.when(nn, order)).alias("close"),
            F.count(column).alias("n"),
        )
        .withColumn("time", seconds_to_ts("g"))
    )


def stream_candles(df: DataFrame, freq: int = 300, column: str = "bid_price", keys: Sequence[str] = KEYS,
                   time_col: str = "time") -> DataFrame:
    """G3 for streams: tumbling ``window`` (pair with ``withWatermark`` upstream)."""
    return df.groupBy(*keys, F.window(time_col, f"{int(freq)} seconds").alias("window")).agg(
        F.min_by(F.col(column), F.col(time_col)).alias("open"),
        F.max(column).alias("high"),
        F.min(column).alias("low"),
        F.max_by(F.col(column), F.col(time_col)).alias("close"),
    )


def align_feeds(long_df: DataFrame, feeds: Sequence[str], keys: Sequence[str] = ("time",), feed_col: str = "feed",
                value_col: str = "value") -> DataFrame:
    """Outer-align several feeds on time (conditional aggregates of the long form, one shuffle)."""
    return long_df.groupBy(*keys).agg(*[
        F.first(F.when(F.col(feed_col) == F.lit(f), F.col(value_col)), ignorenulls=True).alias(f) for f in feeds])


def align_asof_next(long_df: DataFrame, feeds: Sequence[str], freq: int = 1, feed_col: str = "feed", value_col: str = "value",
                    time_col: str = "time", dropna: bool = True) -> DataFrame:
    """Raw feeds outer-aligned on their times (a column a feed), then G2: at each grid point the whole first aligned
    row at or after it; rows in which a feed is missing are dropped, as G2 does. Output: ``g, time``, a column a feed."""
    wide = align_feeds(long_df, feeds, (time_col,), feed_col, value_col)
    wide = wide.withColumn("_all", F.lit("all")).withColumn("_one", F.lit(0))
    return resample_asof_next(wide, freq, list(feeds), ("_all",), time_col, "_one", dropna=dropna).drop("_all")


__all__ = ["align_asof_next", "bucket_last", "resample_last", "resample_asof_next", "candles", "stream_candles", "align_feeds"]
