"""Sliding-frame kernels in numpy: every frame is put together from runs of 1, 2, 4 ... rows.

Nothing is ever subtracted from a running value, so a spike that has left the frame leaves no trace: moments
merge pairwise (count, mean, squared deviations), and sums carry the rounding error of each addition as a
second double. O(n log window) additions, whatever the frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np


def frame_starts(g: np.ndarray, window: int) -> np.ndarray:
    """First row of the frame (t - window, t] of each row; ``g`` ascending."""
    return np.searchsorted(g, g - window, side="right")


def _fold(level: tuple[np.ndarray, ...], start: np.ndarray, merge: Callable) -> tuple[np.ndarray, ...]:
    """Merge of the rows start[i]..i for every i; ``level``: the values of single rows, zeros being neutral."""
    n = len(start)
    length = np.arange(n) - start + 1
    end = np.arange(n) + 1
    out = tuple(np.zeros(n) for _ in level)
    size = 1
    while n and size <= length.max():
        rows = np.flatnonzero(length & size)
        at = end[rows] - size
        for x, y in zip(out, merge(tuple(x[at] for x in level), tuple(x[rows] for x in out))):
            x[rows] = y
        end[rows] = at
        level = merge(tuple(x[:-size] for x in level), tuple(x[size:] for x in level)) if size < len(level[0]) else level
        size *= 2
    return out


def _merge_moments(a, b):
    (n1, m1, s1), (n2, m2, s2) = a, b
    n = n1 + n2
    d = m2 - m1
    share = np.divide(n2, n, out=np.zeros_like(n), where=n > 0)
    mean = np.where(n1 == 0, m2, np.where(n2 == 0, m1, m1 + d * share))
    return n, mean, s1 + s2 + np.where((n1 > 0) & (n2 > 0), d * d * n1 * share, 0.0)


def moments(v: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, mean, sum of squared deviations) of the non-NaN values of each frame."""
    ok = ~np.isnan(v)
    return _fold((ok.astype(float), np.where(ok, v, 0.0), np.zeros(len(v))), start, _merge_moments)


def _two_sum(a, b):
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def _merge_sums(a, b):
    s, e = _two_sum(a[0], b[0])
    t, f = _two_sum(a[1], b[1])
    s, e = _two_sum(s, e + t)
    return _two_sum(s, e + f)


def sums(v: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the non-NaN values of each frame as two doubles (the second is the first's error)."""
    return _fold((np.where(np.isnan(v), 0.0, v), np.zeros(len(v))), start, _merge_sums)


def _two_product(a, b):
    p = a * b
    split = 134217729.0
    ah, bh = a * split, b * split
    ah, bh = ah - (ah - a), bh - (bh - b)
    al, bl = a - ah, b - bh
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def _greater(p: np.ndarray, q: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """p + q > hi + lo; False where either is NaN."""
    d, e = _two_sum(p, -hi)
    return d + (e + (q - lo)) > 0


def above_mean(x: np.ndarray, v: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether x exceeds the frame's mean, decided as count * x > sum without rounding either side."""
    n = moments(v, start)[0]
    return _greater(*_two_product(n, x), *sums(v, start))


def medians(v: np.ndarray, start: np.ndarray, g: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The two middle values of each frame (equal for an odd count); NaN for an empty one."""
    import pandas as pd

    r = pd.Series(v, index=pd.to_datetime(g, unit="s")).rolling(f"{window}s", min_periods=1)
    return tuple(r.quantile(0.5, interpolation=i).to_numpy() for i in ("lower", "higher"))


def signatures(g: np.ndarray, v: np.ndarray, window: int, step: int, offsets: Sequence[int], kind: str,
               min_periods: int) -> np.ndarray:
    """Hex signature of the frame (t - window, t] of each row, or None below ``min_periods`` values.

    One digit for each offset k, of x = the value k - 1 steps back: ``{x > mean}111`` for kind mean,
    ``{x > median}111`` for median, ``{x > mean}{x > median}11`` for mean_median. A missing x exceeds nothing.
    Both comparisons are exact on the doubles, so they don't depend on the unit of the prices.
    """
    start = frame_starts(g, window)
    n = moments(v, start)[0]
    total = sums(v, start) if kind != "median" else None
    middle = _two_sum(*medians(v, start, g, window)) if kind != "mean" else None
    digits = np.frombuffer(b"0123456789abcdef", np.uint8)
    out = np.empty((len(g), len(offsets)), np.uint8)
    for i, k in enumerate(offsets):
        want = g - (k - 1) * step
        at = np.minimum(np.searchsorted(g, want), len(g) - 1)
        x = np.where(g[at] == want, v[at], np.nan)
        mean = _greater(*_two_product(n, x), *total) if total is not None else False
        median = _greater(2 * x, np.zeros(len(g)), *middle) if middle is not None else False
        out[:, i] = digits[{"mean": mean * 8 + 7, "median": median * 8 + 7, "mean_median": mean * 8 + median * 4 + 3}[kind]]
    text = np.ascontiguousarray(out).view(f"S{len(offsets)}").ravel().astype(str).astype(object)
    text[n < max(min_periods, 1)] = None
    return text
