"""Look-ahead profit labels (L1-L4) as window expressions on the dense grid.

The caller evaluates them through ``rolling.framed`` with ``lookahead`` =
shift*freq so the lead is exact across chunk borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import safe_div
from tidemark.operators.rolling import lead_rows
from tidemark.schema import KEYS


def profit_label(shift: int, pct: float = 0.001, bid: str = "bid_price", ask: str = "ask_price",
                 keys: Sequence[str] = KEYS) -> Column:
    """L1/L2: 1 if bid[t+shift] > ask*(1+pct) else 0.

    Tail rows (no future bid) get 0, not NULL: the comparison with a missing
    value is false, as NaN > x is in pandas. They survive ``dropna``.
    """
    fut = lead_rows(bid, shift, keys)
    target = F.col(ask) + F.col(ask) * F.lit(float(pct))
    return F.when(fut - target > F.lit(0), F.lit(1)).otherwise(F.lit(0))


def profit_pct(shift: int, pct: float = 0.001, bid: str = "bid_price", ask: str = "ask_price",
               keys: Sequence[str] = KEYS) -> Column:
    """L3: (bid[t+shift] - ask*(1+pct)) / ask; NULL at the tail (then dropped)."""
    fut = lead_rows(bid, shift, keys)
    target = F.col(ask) + F.col(ask) * F.lit(float(pct))
    return safe_div(fut - target, F.col(ask))


def profit_sign(pct_col: str | Column) -> Column:
    """L3: int(pct > 0); NULL stays NULL so the row is dropped with its pct."""
    c = F.col(pct_col) if isinstance(pct_col, str) else pct_col
    return F.when(c.isNotNull(), (c > F.lit(0)).cast("int"))


def close_label(close_col: str, ask: str = "ask_price") -> Column:
    """L4: 1 if close - ask > 0 else 0; NULL when close is NULL (tail dropped)."""
    c = F.col(close_col)
    return F.when(c.isNotNull(), F.when(c - F.col(ask) > F.lit(0), F.lit(1)).otherwise(F.lit(0)))
