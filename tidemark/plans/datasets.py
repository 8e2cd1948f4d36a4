"""Dataset builders B1-B10: grid -> length guard -> frames -> label -> dropna.

Every builder takes raw quotes (``*keys, time, seq, bid_price, ask_price,
bid_qty, ask_qty``) and returns one row per kept grid point with ``*keys, g,
time`` and its features. Parameters follow the reference: ``window`` in
seconds, ``shift`` and candle steps in grid rows; the reference runs at
``freq=1`` where rows and seconds coincide. ``min_rows`` is the length guard
(rows of the key's grid); keys below it produce no rows.

Each builder declares its rolling metrics, lags and leads once; the frame
planner (``plans.frames``) evaluates them in one pass per (instrument,
chunk) — Spark windows for short frames, pandas kernels for long ones —
so the plan has one shuffle for the grid fill and one for the frames.
``engine`` forces either path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_div
from tidemark.operators.grid import resample_last
from tidemark.plans.frames import M, compute_frames
from tidemark.schema import KEYS, QUOTE_COLUMNS

BASE = ("g", "time")

# rolling metric names of the reference -> frame planner metrics
METRICS = ("rolling_mean", "rolling_var", "rolling_coeff", "rolling_min", "rolling_max", "rolling_open",
           "rolling_close")
_PLAIN = {"rolling_mean": "mean", "rolling_mavg": "mean", "rolling_var": "var", "rolling_min": "min",
          "rolling_max": "max", "rolling_open": "open", "rolling_close": "close", "rolling_std": "std"}


def _grid(quotes: DataFrame, columns: Sequence[str], freq: int, min_rows: int | None, keys: Sequence[str],
          fill: str = "bfill") -> DataFrame:
    g = resample_last(quotes, freq, columns, keys, fill=fill, with_length=min_rows is not None)
    if min_rows is not None:
        g = g.where(F.col("grid_rows") >= F.lit(int(min_rows))).drop("grid_rows")
    return g


def _finish(d: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    return d.select(*keys, *BASE, *cols).na.drop(how="any", subset=list(cols))


def _declare(c: str, metric: str, window: int, mp: int, name: str, metrics: dict, post: dict) -> None:
    """Add the planner metrics for one reference metric (coeff = two quartiles + a ratio)."""
    if metric == "rolling_coeff":
        metrics[f"_q25_{c}"] = M(c, "q25", window, mp)
        metrics[f"_q75_{c}"] = M(c, "q75", window, mp)
        q25, q75 = F.col(f"_q25_{c}"), F.col(f"_q75_{c}")
        post[name] = safe_div(q75 - q25, q75 + q25)
    else:
        metrics[name] = M(c, _PLAIN[metric], window, mp)


def _label(lead: str, pct: float, ask: str = "ask_price") -> Column:
    """L1/L2 on a lead column: 1 if bid[t+shift] > ask*(1+pct) else 0 (tail -> 0)."""
    target = F.col(ask) + F.col(ask) * F.lit(float(pct))
    return F.when(F.col(lead) - target > F.lit(0), F.lit(1)).otherwise(F.lit(0))


def _apply(grid, keys, freq, metrics, lags, leads, post, engine):
    d = compute_frames(grid, keys, freq, metrics, lags, leads, engine=engine)
    if post:
        d = d.select("*", *[e.alias(n) for n, e in post.items()])
    return d


def ohlc(quotes: DataFrame, window: int = 3600, shift: int = 600, pct: float = 0.001, freq: int = 1,
         keys: Sequence[str] = KEYS, min_rows: int | None = None, engine: str = "kernels") -> DataFrame:
    """Rolling open/close/low/high/mean/var/coeff of bid + profit label."""
    keys = list(keys)
    guard = min_rows if min_rows is not None else window // freq + shift
    grid = _grid(quotes, ("bid_price", "ask_price"), freq, guard, keys)
    metrics, post = {}, {}
    for name, m in (("open", "rolling_open"), ("close", "rolling_close"), ("low", "rolling_min"),
                    ("high", "rolling_max"), ("rolling_mean", "rolling_mean"), ("rolling_var", "rolling_var"),
                    ("rolling_coeff", "rolling_coeff")):
        _declare("bid_price", m, window, 1, name, metrics, post)
    post["profit"] = _label("_lead", pct)
    d = _apply(grid, keys, freq, metrics, {}, {"_lead": ("bid_price", shift)}, post, engine)
    return _finish(d, keys, ["open", "close", "low", "high", "profit", "rolling_mean", "rolling_var",
                             "rolling_coeff"])


def quantile_coefficient(quotes: DataFrame, window: int = 3600, shift: int = 600, pct: float = 0.001,
                         freq: int = 1, keys: Sequence[str] = KEYS, min_rows: int | None = None,
                         engine: str = "kernels") -> DataFrame:
    """Bid, ask, rolling mean/var/quartile coefficient of bid, profit."""
    keys = list(keys)
    guard = min_rows if min_rows is not None else window // freq + shift
    grid = _grid(quotes, ("bid_price", "ask_price"), freq, guard, keys)
    metrics, post = {}, {}
    for m in ("rolling_mean", "rolling_var", "rolling_coeff"):
        _declare("bid_price", m, window, 1, m, metrics, post)
    post["profit"] = _label("_lead", pct)
    d = _apply(grid, keys, freq, metrics, {}, {"_lead": ("bid_price", shift)}, post, engine)
    return _finish(d, keys, ["bid_price", "ask_price", "rolling_mean", "rolling_var", "rolling_coeff", "profit"])


def all_fields(quotes: DataFrame, shift: int = 600, window: int = 7200, pct: float = 0.001, freq: int = 1,
               keys: Sequence[str] = KEYS, min_rows: int = 3600, engine: str = "kernels") -> DataFrame:
    """B1: rolling means of the four quote columns, value - mean (W8), profit."""
    keys = list(keys)
    cols = list(QUOTE_COLUMNS)
    grid = _grid(quotes, cols, freq, min_rows, keys)
    metrics = {f"{c}_rolling_mean": M(c, "mean", window) for c in cols}
    post = {f"{c}_mean_diff": F.col(c) - F.col(f"{c}_rolling_mean") for c in cols}
    post["profit"] = _label("_lead", pct)
    d = _apply(grid, keys, freq, metrics, {}, {"_lead": ("bid_price", shift)}, post, engine)
    out = cols + [f"{c}_rolling_mean" for c in cols] + [f"{c}_mean_diff" for c in cols] + ["profit"]
    return _finish(d, keys, out)


def cross_moving_average(quotes: DataFrame, max_window: int = 3600, min_window: int = 1200, shift: int = 1200,
                         pct: float = 0.001, freq: int = 1, keys: Sequence[str] = KEYS,
                         min_rows: int | None = None, engine: str = "kernels") -> DataFrame:
    """B2: signal = fast mean - slow mean (W9), profit."""
    keys = list(keys)
    guard = min_rows if min_rows is not None else max_window // freq + shift
    grid = _grid(quotes, ("bid_price", "ask_price"), freq, guard, keys)
    metrics = {"_fast": M("bid_price", "mean", min_window), "_slow": M("bid_price", "mean", max_window)}
    post = {"signal": F.col("_fast") - F.col("_slow"), "profit": _label("_lead", pct)}
    d = _apply(grid, keys, freq, metrics, {}, {"_lead": ("bid_price", shift)}, post, engine)
    return _finish(d, keys, ["bid_price", "ask_price", "signal", "profit"])


def moving_average_candles(quotes: DataFrame, window: int = 3600, shift: int = 1200, candle: int = 300,
                           min_periods: int | None = None, freq: int = 1, keys: Sequence[str] = KEYS,
                           min_rows: int | None = None, engine: str = "kernels") -> DataFrame:
    """signal = rolling mean - x[-candle] (the value candle-1 rows back), profit (pct 0).

    NULL until the frame holds ``min_periods`` values (default: the window in rows).
    """
    keys = list(keys)
    mp = int(min_periods if min_periods is not None else window // freq)
    guard = min_rows if min_rows is not None else window // freq + shift
    grid = _grid(quotes, ("bid_price", "ask_price"), freq, guard, keys)
    metrics = {"_mean": M("bid_price", "mean", window, mp)}
    lags = {"_back": ("bid_price", candle - 1)}
    post = {"signal": F.col("_mean") - F.col("_back"), "profit": _label("_lead", 0.0)}
    d = _apply(grid, keys, freq, metrics, lags, {"_lead": ("bid_price", shift)}, post, engine)
    return _finish(d, keys, ["bid_price", "ask_price", "signal", "profit"])


# Sample offsets (rows back, x[-k]) of the 8-bit moving-average
# pattern at a 300-row candle; the last pair is irregular in the original.
PATTERN_OFFSETS = (1, 300, 600, 900, 1200, 1500, 1800, 2100, 2300)


def moving_average_pattern(quotes: DataFrame, window: int = 3600, shift: int = 1200,
                           offsets: Sequence[int] = PATTERN_OFFSETS, min_periods: int | None = None,
                           freq: int = 1, keys: Sequence[str] = KEYS, min_rows: int | None = None,
                           engine: str = "kernels") -> DataFrame:
    """8 comparison bits x[-o_i] > x[-o_(i+1)] as one byte value 0-255 (signal), profit (pct 0).

    ``x[-k]`` of the frame is the value k-1 rows back. The label-encoding of
    the reference over all 256 8-digit patterns is exactly the byte value.
    Rows whose frame is not full (``min_periods``) get no signal and drop.
    """
    keys = list(keys)
    offs = list(offsets)
    mp = int(min_periods if min_periods is not None else window // freq)
    guard = min_rows if min_rows is not None else window // freq + shift
    grid = _grid(quotes, ("bid_price", "ask_price"), freq, guard, keys)
    metrics = {"_n": M("bid_price", "count", window)}
    lags = {f"_x{k}": ("bid_price", k - 1) for k in sorted(set(offs)) if k > 1}

    def x(k: int) -> Column:
        return F.col("bid_price") if k == 1 else F.col(f"_x{k}")

    nbits = len(offs) - 1
    byte = sum(F.when(x(offs[i]) > x(offs[i + 1]), F.lit(1 << (nbits - 1 - i))).otherwise(F.lit(0))
               for i in range(nbits))
    post = {"signal": F.when(F.col("_n") >= F.lit(mp), byte), "profit": _label("_lead", 0.0)}
    d = _apply(grid, keys, freq, metrics, lags, {"_lead": ("bid_price", shift)}, post, engine)
    return _finish(d, keys, ["bid_price", "ask_price", "signal", "profit"])


def moving_average_shift(quotes: DataFrame, window: int = 3600, shift: int = 1200, freq: int = 1,
                         keys: Sequence[str] = KEYS, min_rows: int | None = None, engine: str = "kernels") -> DataFrame:
    """open/close = shift(+/-shift) (W10), bid rolling mavg/var/coeff, lagged pct changes (W11), close label (L4)."""
    keys = list(keys)
    guard = min_rows if min_rows is not None else window // freq + shift
    grid = _grid(quotes, ("bid_price", "ask_price"), freq, guard, keys)
    metrics, post = {}, {}
    for m in ("rolling_mavg", "rolling_var", "rolling_coeff"):
        _declare("bid_price", m, window, 1, f"bid_price_{m}", metrics, post)
    lags = {"bid_price_open": ("bid_price", shift), "ask_price_open": ("ask_price", shift)}
    leads = {"bid_price_close": ("bid_price", shift), "ask_price_close": ("ask_price", shift)}
    post["bid_price_actual_pct_change"] = safe_div(F.col("bid_price") - F.col("bid_price_open"),
                                                   F.col("bid_price_open"))
    post["ask_price_actual_pct_change"] = safe_div(F.col("ask_price") - F.col("ask_price_open"),
                                                   F.col("ask_price_open"))
    close = F.col("bid_price_close")
    post["bid_price_next_pct_change"] = F.when(close.isNotNull(),
                                               F.when(close - F.col("ask_price") > F.lit(0), 1).otherwise(0))
    d = _apply(grid, keys, freq, metrics, lags, leads, post, engine)
    return _finish(d, keys, ["bid_price", "ask_price", "bid_price_open", "bid_price_close", "ask_price_open",
                             "ask_price_close", "bid_price_rolling_mavg", "bid_price_rolling_var",
                             "bid_price_rolling_coeff", "bid_price_actual_pct_change",
                             "ask_price_actual_pct_change", "bid_price_next_pct_change"])


def return_candles(quotes: DataFrame, step: int = 1200, n_candles: int = 8, freq: int = 1,
                   keys: Sequence[str] = KEYS, min_rows: int = 9600, engine: str = "kernels") -> DataFrame:
    """Candle returns at ``step``-row spacing and next_profit (tail kept as 0).

    candle_1 = (bid - bid[-s]) / bid[-s]; candle_k = (bid[-(k-1)s] - ask[-ks]) / ask[-ks].
    Lags and a lead only: O(rows) on either engine.
    """
    keys = list(keys)
    grid = _grid(quotes, ("bid_price", "ask_price"), freq, min_rows, keys)
    lags: dict[str, tuple[str, int]] = {}
    post: dict[str, Column] = {}
    names = []
    for k in range(1, n_candles + 1):
        n = f"bid_price_candle_{k}"
        names.append(n)
        lags[f"_a{k}"] = ("ask_price", k * step)
        lags[f"_b{k}"] = ("bid_price", k * step)
    post["bid_price_candle_1"] = safe_div(F.col("bid_price") - F.col("_b1"), F.col("_b1"))
    for k in range(2, n_candles + 1):
        post[f"bid_price_candle_{k}"] = safe_div(F.col(f"_b{k - 1}") - F.col(f"_a{k}"), F.col(f"_a{k}"))
    ret = safe_div(F.col("_lead") - F.col("ask_price"), F.col("ask_price"))
    post["next_profit"] = F.when(ret > F.lit(0), F.lit(1)).otherwise(F.lit(0))
    d = _apply(grid, keys, freq, {}, lags, {"_lead": ("bid_price", step)}, post, "windows")
    return _finish(d, keys, ["bid_price", "ask_price", *names, "next_profit"])


def _rolling_features(grid: DataFrame, features: Sequence[str], window: int, freq: int, min_periods: int,
                      keys: Sequence[str], rows: bool, target: bool, shift: int | None, profit: float,
                      engine: str):
    n_sec = int(window) * int(freq) if rows else int(window)
    metrics: dict[str, M] = {}
    post: dict[str, Column] = {}
    out: list[str] = []
    for feat in features:
        if "." not in feat:
            out.append(feat)  # bare column name: passthrough
            continue
        c, m = feat.split(".", 1)
        _declare(c, m, n_sec, int(min_periods), f"{c}_{m}", metrics, post)
        out.append(f"{c}_{m}")
    leads = {}
    if target:
        leads["_lead"] = ("bid_price", int(shift))
        target_ = F.col("ask_price") + F.col("ask_price") * F.lit(float(profit))
        pct = safe_div(F.col("_lead") - target_, F.col("ask_price"))
        post["profit_pct"] = pct
        post["profit_sign"] = F.when(pct.isNotNull(), (pct > F.lit(0)).cast("int"))
        out += ["profit_pct", "profit_sign"]
    d = _apply(grid, keys, freq, metrics, {}, leads, post, engine)
    return d, out


def rolling_all_fields(quotes: DataFrame, window: int = 3600, shift: int = 600, profit_pct_: float = 0.001,
                       min_periods: int = 600, freq: int = 1, keys: Sequence[str] = KEYS,
                       rows: bool = False, engine: str = "kernels") -> DataFrame:
    """4 columns x 7 rolling metrics (X) plus profit_pct / profit_sign (y), nulls dropped."""
    keys = list(keys)
    cols = list(QUOTE_COLUMNS)
    feats = [f"{c}.{m}" for c in cols for m in METRICS]
    grid = _grid(quotes, cols, freq, None, keys)
    d, out = _rolling_features(grid, feats, window, freq, min_periods, keys, rows, True, shift, profit_pct_, engine)
    return _finish(d, keys, out)


def rolling_data(quotes: DataFrame, features: Sequence[str], window: int = 3600, target: bool = True,
                 shift: int = 600, min_periods: int = 600, freq: int = 1, keys: Sequence[str] = KEYS,
                 rows: bool = False, engine: str = "kernels") -> DataFrame:
    """The requested ``<col>.<metric>`` features (bare names pass through), optional target.

    The target always uses a 0.1% profit margin, as the reference does.
    """
    keys = list(keys)
    cols = sorted({f.split(".")[0] for f in features} | ({"bid_price", "ask_price"} if target else set()))
    grid = _grid(quotes, cols, freq, None, keys)
    d, out = _rolling_features(grid, features, window, freq, min_periods, keys, rows, target, shift, 0.001, engine)
    return _finish(d, keys, out)
