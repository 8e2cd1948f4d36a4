"""Plan shapes that keep ordered per-instrument work parallel.

Ordered operators (fills, lags, rolling frames) are naturally written as a
window partitioned by instrument. At scale that is one task per instrument,
and one hot instrument can hold a third of all rows. The helpers here split
every instrument into time chunks so a window runs per (instrument, chunk):

* ``segmented_*``: running scans (fill, previous row) computed inside each
  chunk, plus a tiny per-chunk summary that carries the value across chunk
  borders (a classic two-level scan). The summary has one row per chunk.
* ``with_halo``: sliding frames (rolling aggregates, lag/lead by a bounded
  distance). Each row is copied into the neighbouring chunks whose frames
  reach it, the window runs per chunk, and only each chunk's own rows are
  kept. Extra rows = halo / chunk span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
OWN = "_own"


def chunk_of(order_col: str | Column, span: int) -> Column:
    c = F.col(order_col) if isinstance(order_col, str) else order_col
    return F.floor(c / F.lit(int(span))).cast("long")


def auto_span(freq: int, halo_steps: int = 0, min_rows: int = 4096) -> int:
    """Chunk span (seconds) for a grid with step ``freq``.

    At least ``min_rows`` grid rows per chunk and at least 8x the halo, so
    the halo copies stay under ~12% of the rows.
    """
    rows = max(int(min_rows), 8 * int(halo_steps))
    return int(freq) * rows


def with_halo(df: DataFrame, order_col: str, span: int, before: int = 0, after: int = 0) -> DataFrame:
    """Add ``_chunk`` / ``_own``; a row is copied to each chunk whose frames need it.

    ``before``: how far back (in ``order_col`` units) a frame looks; a row at x
    is context for rows in (x, x+before]. ``after``: look-ahead distance; a
    row at x is context for rows in [x-after, x).
    """
    x = F.col(order_col)
    own = chunk_of(x, span)
    if before <= 0 and after <= 0:
        return df.withColumn(CHUNK, own).withColumn(OWN, F.lit(True))
    lo = chunk_of(x - F.lit(int(after)), span)
    hi = chunk_of(x + F.lit(int(before)), span)
    return df.withColumn(CHUNK, F.explode(F.sequence(lo, hi))).withColumn(OWN, F.col(CHUNK) == own)


POINTS = 4096  # grid points of one array


def explode_points(df: DataFrame, lo: Column, hi: Column, step: int, out: str) -> DataFrame:
    """One row per grid point lo, lo + step ... hi (none where lo > hi), in column ``out``.

    Blocks of points are exploded first, then the points of each block, so no array
    grows with the gap: a silent year at one second is 7,700 blocks, never one value.
    """
    d = df.withColumn("_lo", lo.cast("long")).withColumn("_hi", hi.cast("long")).where("_lo <= _hi")
    d = d.withColumn("_at", F.explode(F.sequence("_lo", "_hi", F.lit(int(step) * POINTS).cast("long"))))
    last = F.least(F.col("_hi"), F.col("_at") + F.lit(int(step) * (POINTS - 1)))
    return d.withColumn(out, F.explode(F.sequence("_at", last, F.lit(int(step)).cast("long")))).drop("_lo", "_hi", "_at")


def own_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(OWN)).drop(CHUNK, OWN)


def chunk_window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, CHUNK)


def segmented_prev(
    df: DataFrame,
    keys: Sequence[str],
    order: Column,
    value: Column,
    out: str,
    span: int,
    chunk_source: Column,
) -> DataFrame:
    """``out`` = ``value`` of the previous row per key in ``order`` (NULL for the first).

    ``order`` must be a sortable expression (a struct for compound orders).
    ``chunk_source`` is the numeric column the chunks are cut on (epoch seconds).
    """
    keys = list(keys)
    d = df.withColumn(CHUNK, chunk_of(chunk_source, span)).withColumn("_ord", order).withColumn("_val", value)
    # the chunk summary comes from the input rows, not from the windowed rows,
    # so the window runs once and the scan below is shared
    last_in_chunk = d.groupBy(*keys, CHUNK).agg(F.max_by("_val", "_ord").alias("_last"))
    w = Window.partitionBy(*keys, CHUNK).orderBy("_ord")
    d = d.withColumn("_first", F.lag(F.lit(True)).over(w).isNull()).withColumn("_lag", F.lag("_val").over(w))
    carry = last_in_chunk.select(
        *keys, CHUNK, F.lag("_last").over(Window.partitionBy(*keys).orderBy(CHUNK)).alias("_carry")
    )
    d = d.join(carry, on=[*keys, CHUNK], how="left")
    return d.withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag"))).drop(
        CHUNK, "_ord", "_val", "_first", "_lag", "_carry"
    )
