"""Binary price-pattern mining.

A signature compares sampled frame values with a frame statistic; each
sample contributes one 4-bit nibble and the bit string is kept as a hex
STRING (the default 31 nibbles need 124 bits: no LONG holds it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import bit, hex_from_bits
from tidemark.operators.grid import resample_last
from tidemark.plans.chunking import CHUNK, auto_span, own_rows, with_halo
from tidemark.schema import KEYS

KINDS = ("mean", "median", "mean_median")

def sample_offsets(nbr_samples: int, step: int) -> list[int]:
    """``x[-1], x[-step], ..., x[-n*step]`` as positive distances from the end."""
    return [1] + [(i + 1) * int(step) for i in range(int(nbr_samples))]


def pattern_table(quotes: DataFrame, kind: str = "mean", window: int = 3600, shift: int = 600, step: int = 60,
                  nbr_samples: int = 30, pct: float = 0.0, freq: int = 1, keys: Sequence[str] = KEYS,
                  min_periods: int | None = None, span: int | None = None) -> DataFrame:
    """Grid -> signature over a full frame -> look-ahead label L1 -> dropna.

    The signature (T2-T4, ``tidemark.plans.sliding.signatures``) and the label's
    lead come from the frame planner; only the statistic that the kind reads is computed.
    Output: ``*keys, g, time, bid_price, ask_price, pattern, profit``.
    """
    from tidemark.plans.frames import Signature, compute_frames

    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    keys = list(keys)
    offs = sample_offsets(nbr_samples, step)
    mp = int(min_periods if min_periods is not None else window // freq)
    grid = resample_last(quotes, freq, ("bid_price", "ask_price"), keys)
    sig = Signature("bid_price", kind, tuple(offs), window, mp)
    d = compute_frames(grid, keys, freq, leads={"_lead": ("bid_price", shift)}, signatures={"pattern": sig}, span=span)
    target = F.col("ask_price") + F.col("ask_price") * F.lit(float(pct))
    d = d.select(*keys, "g", "time", "bid_price", "ask_price", "pattern",
                 F.when(F.col("_lead") - target > F.lit(0), F.lit(1)).otherwise(F.lit(0)).alias("profit"))
    return d.na.drop(subset=["bid_price", "ask_price", "pattern"])


def ohlc_pattern_table(quotes: DataFrame, candle: int = 300, nbr_candles: int = 12, shift: int = 600,
                       pct: float = 0.0, freq: int = 1, keys: Sequence[str] = KEYS) -> DataFrame:
    """T5: nibble ``{open>close}{open>close}11`` for each of the last ``nbr_candles`` candles.

    Candles are ``candle``-second buckets of the grid; candle 1 is the one
    containing the current row (open = its first grid value, close = the
    current value), candle k>1 is the full bucket k-1 before. Rows without
    ``nbr_candles`` candles of history get no pattern.

    One halo shuffle after the grid: inside each (instrument, chunk) the
    candle open/close are window aggregates over the candle's rows, and the
    bit of the candle k-1 buckets back is a RANGE frame ordered by the candle
    start with a fixed offset ((k-1)*candle) — all rows of a candle are peers,
    so no join back to the grid is needed.
    """
    keys = list(keys)
    c, n, f = int(candle), int(nbr_candles), int(freq)
    grid = resample_last(quotes, freq, ("bid_price", "ask_price"), keys)
    d = with_halo(grid.withColumn("cb", (F.floor(F.col("g") / F.lit(c)) * F.lit(c)).cast("long")), "g",
                  auto_span(f, (n * c + shift * f) // f + 1), before=n * c, after=shift * f)
    same = Window.partitionBy(*keys, CHUNK).orderBy("cb").rangeBetween(0, 0)
    d = d.withColumn("_open", F.min_by("bid_price", "g").over(same)) \
         .withColumn("_gt", F.when(F.max_by("bid_price", "g").over(same) < F.col("_open"), 1).otherwise(0))
    back = {k: Window.partitionBy(*keys, CHUNK).orderBy("cb").rangeBetween(-(k - 1) * c, -(k - 1) * c)
            for k in range(2, n + 1)}
    by_g = Window.partitionBy(*keys, CHUNK).orderBy("g")
    d = d.select("*", *[F.max("_gt").over(w).alias(f"_gt{k}") for k, w in back.items()],
                 F.lead("bid_price", int(shift)).over(by_g).alias("_lead"))
    d = own_rows(d)
    one = F.lit(1)
    first = bit(F.col("_open") > F.col("bid_price"))
    bits = [first, first, one, one]
    for k in range(2, n + 1):
        b = F.col(f"_gt{k}")
        bits += [b, b, one, one]
    complete = F.col(f"_gt{n}").isNotNull() if n > 1 else F.lit(True)
    target = F.col("ask_price") + F.col("ask_price") * F.lit(float(pct))
    return d.select(*keys, "g", "time", "bid_price", "ask_price",
                    F.when(complete, hex_from_bits(bits)).alias("pattern"),
                    F.when(F.col("_lead") - target > F.lit(0), F.lit(1)).otherwise(F.lit(0)).alias("profit")
                    ).na.drop(subset=["pattern"])


def pattern_score(table: DataFrame, threshold: float = 0.9, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per pattern, score = share of profit == 1, count; keep score > threshold and count > 1.

    Order for display with ``.orderBy(desc('score'), desc('count'), 'pattern')`` (O3).
    """
    return (
        table.groupBy(*keys, "pattern")
        .agg(F.avg(F.col("profit").cast("double")).alias("score"), F.count(F.lit(1)).alias("count"))
        .where((F.col("score") > F.lit(float(threshold))) & (F.col("count") > F.lit(1)))
    )


def buy_patterns(scores: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The buy set = patterns with score == 1."""
    return scores.where(F.col("score") == F.lit(1.0)).select(*keys, "pattern").distinct()


def pattern_match(table: DataFrame, buy: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """signal = 1 when the row's pattern is in the buy set of its instrument.

    A left join on (keys, pattern); AQE broadcasts the buy set when its
    runtime size is small, else it stays a sort-merge join.
    """
    b = buy.select(*keys, "pattern").distinct().withColumn("_hit", F.lit(1))
    return table.join(b, on=[*keys, "pattern"], how="left").withColumn(
        "signal", F.coalesce(F.col("_hit"), F.lit(0))).drop("_hit")


def pattern_semi(table: DataFrame, buy: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows whose pattern is in the buy set (left semi join)."""
    return table.join(buy.select(*keys, "pattern"), on=[*keys, "pattern"], how="left_semi")
