"""One planner for all frame work on the dense grid: rolling metrics, lags, leads.

Builders declare *what* they need; rows are copied into halo chunks, shuffled
by (instrument, chunk), and ``applyInPandas`` runs numpy kernels on each chunk:
pairwise-merged moments and sums (``tidemark.plans.sliding``), monotone-deque
min / max and skip-list quantiles, O(rows x log window). This is the one engine
for frames of any length. ``engine="windows"`` spells the same frames as Spark
window functions, O(rows x window); the tests hold the kernels against it.

Metric names: mean (W1), var (W2, ddof 1), std, min / max (W5), open /
close (W6), sum, count, q25, q75, median (W3). A metric of a frame with fewer than ``min_periods`` non-null
values is NULL (pandas' min_periods).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import seconds_to_ts
from tidemark.plans import sliding
from tidemark.plans.chunking import CHUNK, OWN, auto_span, own_rows, with_halo

QUANTILES = {"q25": 0.25, "q75": 0.75, "median": 0.5}


@dataclass(frozen=True)
class M:
    """A rolling metric of ``col`` over the time frame (t - window, t]."""

    col: str
    metric: str
    window: int
    min_periods: int = 1


@dataclass(frozen=True)
class Signature:
    """The pattern signature (T2-T4) of ``col`` over the time frame (t - window, t]."""

    col: str
    kind: str
    offsets: tuple[int, ...]
    window: int
    min_periods: int = 1


def compute_frames(grid: DataFrame, keys: Sequence[str], freq: int, metrics: Mapping[str, M] | None = None,
                   lags: Mapping[str, tuple[str, int]] | None = None,
                   leads: Mapping[str, tuple[str, int]] | None = None,
                   signatures: Mapping[str, Signature] | None = None,
                   engine: str = "kernels", span: int | None = None) -> DataFrame:
    """Grid columns + one column per metric / lag (k rows back) / lead (k rows ahead) / signature.

    ``grid`` must be dense per key (one row per ``freq`` step), as G1 gives.
    """
    metrics = dict(metrics or {})
    lags = dict(lags or {})
    leads = dict(leads or {})
    keys = list(keys)
    f = int(freq)
    signatures = dict(signatures or {})
    lookback = max([m.window - 1 for m in [*metrics.values(), *signatures.values()]] + [k * f for _, k in lags.values()]
                   + [k * f for x in signatures.values() for k in x.offsets] + [0])
    lookahead = max([k * f for _, k in leads.values()] + [0])
    span = int(span or auto_span(f, (lookback + lookahead) // f + 1))
    if engine == "kernels":
        return _kernels(grid, keys, f, metrics, lags, leads, signatures, lookback, lookahead, span)
    if engine == "windows" and not signatures:
        return _windows(grid, keys, f, metrics, lags, leads, lookback, lookahead, span)
    raise ValueError(f"engine must be kernels, or windows without signatures, got {engine!r}")


# --- Spark windows ---------------------------------------------------------------------------------

def _windows(grid, keys, f, metrics, lags, leads, lookback, lookahead, span) -> DataFrame:
    from tidemark.operators.rolling import frame, lag_rows, lead_rows

    win: dict[str, Column] = {}
    post: dict[str, Column] = {}
    for name, m in metrics.items():
        w = frame(m.window, keys)
        c = F.col(m.col)
        if m.metric in QUANTILES:
            qn = f"_q_{m.col}_{m.window}_{m.min_periods}"
            if qn not in win:
                win[qn] = F.percentile(c, F.array(*[F.lit(v) for v in QUANTILES.values()])).over(w)
            idx = list(QUANTILES).index(m.metric)
            e = F.col(qn)[idx]
        else:
            e = {
                "mean": lambda: F.avg(c).over(w),
                "var": lambda: F.var_samp(c).over(w),
                "std": lambda: F.stddev_samp(c).over(w),
                "min": lambda: F.min(c).over(w),
                "max": lambda: F.max(c).over(w),
                "open": lambda: F.first(c).over(w),
                "close": lambda: F.last(c).over(w),
                "sum": lambda: F.sum(c).over(w),
                "count": lambda: F.count(c).over(w),
            }[m.metric]()
        if m.min_periods > 1 and m.metric != "count":
            cn = f"_n_{m.col}_{m.window}"
            if cn not in win:
                win[cn] = F.count(c).over(w)
            if m.metric not in QUANTILES:
                win[f"_raw_{name}"] = e
                e = F.col(f"_raw_{name}")
            post[name] = F.when(F.col(cn) >= F.lit(int(m.min_periods)), e)
        elif m.metric in QUANTILES:
            post[name] = e
        else:
            win[name] = e
    for name, (c, k) in lags.items():
        win[name] = lag_rows(c, k, keys)
    for name, (c, k) in leads.items():
        win[name] = lead_rows(c, k, keys)
    d = with_halo(grid, "g", span, before=lookback, after=lookahead)
    d = d.select("*", *[e.alias(n) for n, e in win.items()])
    d = own_rows(d)
    if post:
        d = d.select("*", *[e.alias(n) for n, e in post.items()])
    return d.drop(*[n for n in win if n.startswith(("_q_", "_n_", "_raw_"))])


# --- kernels ------------------------------------------------------------------------------

def _kernels(grid, keys, f, metrics, lags, leads, signatures, lookback, lookahead, span) -> DataFrame:
    base_cols = [c for c in grid.columns if c not in (*keys, "g", "time")]
    d = with_halo(grid.drop("time"), "g", span, before=lookback, after=lookahead)
    out_names = list(metrics) + list(lags) + list(leads)
    fields = [T.StructField(k, grid.schema[k].dataType) for k in keys] + [T.StructField("g", T.LongType())]
    fields += [T.StructField(c, grid.schema[c].dataType) for c in base_cols]
    fields += [T.StructField(n, T.DoubleType()) for n in out_names]
    fields += [T.StructField(n, T.StringType()) for n in signatures]
    schema = T.StructType(fields)
    specs = [(n, m.col, m.metric, int(m.window), int(m.min_periods)) for n, m in metrics.items()]
    lag_specs = [(n, c, int(k)) for n, (c, k) in lags.items()]
    lead_specs = [(n, c, -int(k)) for n, (c, k) in leads.items()]
    cols = [fl.name for fl in fields]
    patterns = [(n, x.col, int(x.window), tuple(x.offsets), x.kind, int(x.min_periods)) for n, x in signatures.items()]

    def run(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("g", kind="stable").reset_index(drop=True)
        g = pdf["g"].to_numpy(dtype="int64")
        idx = pd.to_datetime(g, unit="s")
        values: dict[str, np.ndarray] = {}
        done: dict[tuple, tuple] = {}

        def ser(c):
            if c not in values:
                values[c] = pdf[c].to_numpy(dtype="float64", na_value=np.nan)
            return values[c]

        def once(what, c, window):
            key = (what, c, window)
            if key not in done:
                start = sliding.frame_starts(g, window)
                if what == "rolling":
                    done[key] = pd.Series(ser(c), index=idx).rolling(f"{window}s", min_periods=1)
                else:
                    done[key] = (sliding.moments if what == "moments" else sliding.sums)(ser(c), start)
            return done[key]

        out = {}
        for name, c, metric, window, mp in specs:
            n, mean, squares = once("moments", c, window)
            if metric == "mean":
                v = mean
            elif metric in ("var", "std"):
                v = np.where(n > 1, squares / np.maximum(n - 1, 1), np.nan)
                v = np.sqrt(v) if metric == "std" else v
            elif metric == "sum":
                v = once("sums", c, window)[0]
            elif metric == "count":
                v = n.copy()
            elif metric == "min":
                v = once("rolling", c, window).min().to_numpy()
            elif metric == "max":
                v = once("rolling", c, window).max().to_numpy()
            elif metric in QUANTILES:
                v = once("rolling", c, window).quantile(QUANTILES[metric], interpolation="linear").to_numpy()
            elif metric == "open":
                v = ser(c)[sliding.frame_starts(g, window)]
            elif metric == "close":
                v = ser(c).copy()
            else:
                raise ValueError(metric)
            v = np.asarray(v, dtype="float64")
            if metric != "count":
                v = np.where(n >= max(mp, 1), v, np.nan)
            out[name] = v
        for name, c, window, offsets, kind, mp in patterns:
            out[name] = sliding.signatures(g, ser(c), window, f, offsets, kind, mp)
        for name, c, k in lag_specs + lead_specs:
            # exact time shift on the grid: the row at g - k*freq (NaN when absent)
            vals = ser(c)
            target = g - k * f
            pos = np.searchsorted(g, target)
            ok = (pos < len(g)) & (g[np.minimum(pos, len(g) - 1)] == target)
            out[name] = np.where(ok, vals[np.minimum(pos, len(g) - 1)], np.nan)
        res = pdf.assign(**out)
        res = res[res[OWN].to_numpy(dtype=bool)]
        return res[cols]

    res = d.groupBy(*keys, CHUNK).applyInPandas(run, schema)
    # pandas NaN -> SQL NULL, and the timestamp back from g
    outs = [F.when(F.isnan(F.col(n)), F.lit(None)).otherwise(F.col(n)).alias(n) for n in out_names]
    return res.select(*keys, "g", seconds_to_ts("g").alias("time"), *base_cols, *outs, *signatures)
