"""Rolling / window operators (W1-W28) over a dense grid.

All frames are evaluated per (instrument, chunk) with a halo (see
``plans.chunking``), so a long or hot instrument is spread over many tasks.
A pandas time window 'Ns' is the frame (t-N, t]; on integer seconds that is
``rangeBetween(-(N-1), 0)``. On a dense grid a row offset k equals k*freq
seconds, so lag/lead and integer windows are exact inside a chunk as long as
the halo covers them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import safe_div
from tidemark.plans.chunking import CHUNK, auto_span, own_rows, with_halo
from tidemark.schema import KEYS

METRICS = ("rolling_mean", "rolling_var", "rolling_coeff", "rolling_min", "rolling_max", "rolling_open",
           "rolling_close")


def ordered(keys: Sequence[str] = KEYS, order: str = "g") -> Window:
    return Window.partitionBy(*keys, CHUNK).orderBy(order)


def frame(window_seconds: int, keys: Sequence[str] = KEYS, order: str = "g") -> Window:
    """Left-open time frame (t-N, t] on an integer-seconds order column."""
    return ordered(keys, order).rangeBetween(-(int(window_seconds) - 1), 0)


def rows_frame(n_rows: int, freq: int, keys: Sequence[str] = KEYS, order: str = "g") -> Window:
    """Integer-row window on the dense grid (n rows = n*freq seconds)."""
    return frame(int(n_rows) * int(freq), keys, order)


def with_min_periods(expr: Column, c: str, w: Window, min_periods: int) -> Column:
    """NULL unless the frame holds at least ``min_periods`` non-null values."""
    if min_periods <= 1:
        return expr
    return F.when(F.count(c).over(w) >= F.lit(int(min_periods)), expr)


def lag_rows(c: str | Column, k: int, keys: Sequence[str] = KEYS) -> Column:
    """Value k grid rows earlier (shift(+k))."""
    return F.lag(c, int(k)).over(ordered(keys))


def lead_rows(c: str | Column, k: int, keys: Sequence[str] = KEYS) -> Column:
    """Value k grid rows later (shift(-k))."""
    return F.lead(c, int(k)).over(ordered(keys))


def quartiles(c: str, w: Window) -> Column:
    """Exact q25 and q75 (linear interpolation) of the frame, as an array."""
    return F.percentile(F.col(c), F.array(F.lit(0.25), F.lit(0.75))).over(w)


def quartile_coeff(q25: Column, q75: Column) -> Column:
    """(q75 - q25) / (q75 + q25); NULL when the denominator is 0."""
    return safe_div(q75 - q25, q75 + q25)


def framed(
    grid: DataFrame,
    window_cols: Mapping[str, Column],
    post_cols: Mapping[str, Column] | None = None,
    lookback: int = 0,
    lookahead: int = 0,
    span: int | None = None,
    freq: int = 1,
    order: str = "g",
) -> DataFrame:
    """Evaluate window columns per (key, chunk) with a halo, keep own rows.

    ``lookback`` / ``lookahead`` are the widest reach of any frame, lag or
    lead, in the units of ``order`` (seconds on the grid).
    """
    span = int(span or auto_span(freq, (lookback + lookahead) // max(int(freq), 1) + 1))
    d = with_halo(grid, order, span, before=int(lookback), after=int(lookahead))
    d = d.select("*", *[e.alias(n) for n, e in window_cols.items()])
    d = own_rows(d)
    if post_cols:
        d = d.select("*", *[e.alias(n) for n, e in post_cols.items()])
    return d.drop(*[n for n in window_cols if n.startswith("_")])


def rolling(
    grid: DataFrame,
    columns: Sequence[str],
    metrics: Sequence[str] = METRICS,
    window: int = 3600,
    freq: int = 1,
    min_periods: int = 1,
    keys: Sequence[str] = KEYS,
    rows: bool = False,
    span: int | None = None,
    engine: str = "kernels",
) -> DataFrame:
    """Rolling metrics of each column, named ``<col>_<metric>``.

    ``window`` is seconds (time window) or, with ``rows=True``, grid rows.
    Evaluated by the frame planner (Spark windows or pandas kernels).
    """
    from tidemark.plans.frames import M, compute_frames

    plain = {"rolling_mean": "mean", "rolling_mavg": "mean", "rolling_var": "var", "rolling_std": "std",
             "rolling_min": "min", "rolling_max": "max", "rolling_open": "open", "rolling_close": "close",
             "rolling_sum": "sum", "rolling_count": "count", "rolling_q25": "q25", "rolling_q75": "q75",
             "rolling_median": "median"}
    n_sec = int(window) * int(freq) if rows else int(window)
    ms: dict[str, M] = {}
    post: dict[str, Column] = {}
    for c in columns:
        for m in metrics:
            name = f"{c}_{m}"
            if m == "rolling_coeff":
                ms[f"_q25_{c}"] = M(c, "q25", n_sec, int(min_periods))
                ms[f"_q75_{c}"] = M(c, "q75", n_sec, int(min_periods))
                post[name] = quartile_coeff(F.col(f"_q25_{c}"), F.col(f"_q75_{c}"))
            else:
                ms[name] = M(c, plain[m], n_sec, int(min_periods))
    d = compute_frames(grid, keys, freq, ms, engine=engine, span=span)
    if post:
        d = d.select("*", *[e.alias(n) for n, e in post.items()])
    return d.drop(*[n for n in ms if n.startswith("_")])


# --- frame-aggregate library (W20-W28): group-level aggregates over a frame of rows ---------

def _pct(x: Column, ps: Sequence[float], approx: bool) -> Column:
    """Exact percentiles (linear interpolation) or, for very large groups, a bounded sketch."""
    arr = F.array(*[F.lit(float(p)) for p in ps])
    return F.percentile_approx(x, arr, 10000) if approx else F.percentile(x, arr)


def frame_stats(df: DataFrame, group: Sequence[str], c: str, approx: bool = False) -> DataFrame:
    """W20-W28 as one grouped aggregate (one row per group; partial aggregation):
    open/close/min/max/sum/count (W23), median/pct99/pct01 (W24), population
    std (W25), pct_change last vs first, NULL below 2 rows (W27), nonzero
    ratio (W28).

    Exact percentiles keep a count per distinct value of the group; pass
    ``approx=True`` for groups too large for that (a fixed-size sketch).
    """
    x = F.col(c)
    pct = _pct(x, (0.01, 0.5, 0.99), approx)
    return df.groupBy(*group).agg(
        F.min_by(x, F.col("g")).alias("open"),
        F.max_by(x, F.col("g")).alias("close"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.sum(x).alias("sum"),
        F.count(x).alias("count"),
        F.stddev_pop(x).alias("std"),
        F.avg(x).alias("mean"),
        pct.alias("_pct"),
        F.count_if(x != 0).alias("_nonzero"),
        F.count(F.lit(1)).alias("_n"),
    ).select(
        *group, "open", "close", "min", "max", "sum", "count", "std", "mean",
        F.col("_pct")[1].alias("median"), F.col("_pct")[2].alias("pct99"), F.col("_pct")[0].alias("pct01"),
        F.when(F.col("count") >= 2, safe_div(F.col("close") - F.col("open"), F.col("open"))).alias("pct_change"),
        (F.col("_nonzero") > F.col("_n") / 2).alias("ratio"),
    )


def remove_outliers(df: DataFrame, group: Sequence[str], c: str, k: float = 4.0) -> DataFrame:
    """Keep rows strictly within mean +- k*std (population std) of their group."""
    stats = df.groupBy(*group).agg(F.avg(c).alias("_m"), F.stddev_pop(c).alias("_s"))
    return (
        df.join(stats, on=list(group), how="inner")
        .where((F.col(c) > F.col("_m") - F.lit(k) * F.col("_s")) & (F.col(c) < F.col("_m") + F.lit(k) * F.col("_s")))
        .drop("_m", "_s")
    )


def remove_outliers_pct(df: DataFrame, group: Sequence[str], c: str, lo: float = 0.01, hi: float = 0.99,
                        approx: bool = False) -> DataFrame:
    """Keep rows strictly between the lo and hi percentiles of their group."""
    stats = df.groupBy(*group).agg(_pct(F.col(c), (lo, hi), approx).alias("_p"))
    return (
        df.join(stats, on=list(group), how="inner")
        .where((F.col(c) > F.col("_p")[0]) & (F.col(c) < F.col("_p")[1]))
        .drop("_p")
    )


def robust_open_close(df: DataFrame, group: Sequence[str], c: str, lo: float = 0.01, hi: float = 0.99,
                      approx: bool = False) -> DataFrame:
    """first/last value (by ``g``) among rows strictly between the group's lo/hi
    percentiles (W21); NULL when nothing is left.

    The percentiles come from a grouped aggregate joined back (AQE broadcasts
    it: one row per group); the open/close is a second grouped aggregate over
    the filtered-in rows only, and every group keeps a row.
    """
    stats = df.groupBy(*group).agg(_pct(F.col(c), (lo, hi), approx).alias("_p"))
    j = df.join(stats, on=list(group), how="inner")
    inside = (F.col(c) > F.col("_p")[0]) & (F.col(c) < F.col("_p")[1])
    return j.groupBy(*group).agg(F.min_by(F.when(inside, F.col(c)), F.when(inside, F.col("g"))).alias("open_r"),
                                 F.max_by(F.when(inside, F.col(c)), F.when(inside, F.col("g"))).alias("close_r"))


def diff(c: str, keys: Sequence[str] = KEYS) -> Column:
    """Successive difference on the ordered grid."""
    return F.col(c) - lag_rows(c, 1, keys)
