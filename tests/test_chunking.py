"""Chunked plans equal their un-chunked definitions (tiny chunk spans force many borders)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import grid as G
from tidemark.operators import rolling as W
from tidemark.plans.chunking import segmented_prev
from tidemark.sources.adapters import quotes

SF = "/root/testdata/sf0.001"


def test_rolling_chunked_equals_plain(spark):
    g = G.resample_last(quotes(spark, SF), 3600)
    plain_w = Window.partitionBy("exchange", "symbol").orderBy("g").rangeBetween(-(6 * 3600 - 1), 0)
    plain = g.select("exchange", "symbol", "g",
                     F.avg("bid_price").over(plain_w).alias("m"),
                     F.percentile("bid_price", F.lit(0.75)).over(plain_w).alias("q"),
                     F.lag("bid_price", 5).over(Window.partitionBy("exchange", "symbol").orderBy("g")).alias("l"),
                     F.lead("bid_price", 3).over(Window.partitionBy("exchange", "symbol").orderBy("g")).alias("f"))
    w = W.frame(6 * 3600)
    chunked = W.framed(g, {"m": F.avg("bid_price").over(w),
                           "q": F.percentile("bid_price", F.lit(0.75)).over(w),
                           "l": W.lag_rows("bid_price", 5), "f": W.lead_rows("bid_price", 3)},
                       lookback=6 * 3600, lookahead=3 * 3600, span=4 * 3600, freq=3600)
    a = plain.orderBy("symbol", "g").collect()
    b = chunked.select("exchange", "symbol", "g", "m", "q", "l", "f").orderBy("symbol", "g").collect()
    assert a == b


def test_grid_chunk_spans_agree(spark):
    q = quotes(spark, SF)
    a = G.resample_last(q, 600, ("bid_price", "bid_qty")).orderBy("symbol", "g").collect()
    b = G.resample_last(q, 600, ("bid_price", "bid_qty"), span=1800).orderBy("symbol", "g").collect()
    c = G.resample_last(q, 600, ("bid_price",), fill="ffill", span=1800).orderBy("symbol", "g").collect()
    d = G.resample_last(q, 600, ("bid_price",), fill="ffill").orderBy("symbol", "g").collect()
    assert a == b and c == d


def test_segmented_prev_matches_lag(spark):
    q = quotes(spark, SF).withColumn("tus", F.unix_micros("time"))
    want = q.select("symbol", "seq", F.lag("seq").over(
        Window.partitionBy("exchange", "symbol").orderBy("tus", "seq")).alias("prev"))
    got = segmented_prev(q, ["exchange", "symbol"], F.struct("tus", "seq"), F.col("seq"), "prev",
                         span=3600 * 1_000_000, chunk_source=F.col("tus")).select("symbol", "seq", "prev")
    assert want.exceptAll(got).count() == 0 and got.count() == want.count()


def test_asof_chunk_spans_agree(spark):
    q = quotes(spark, SF)
    a = G.resample_asof_next(q, 900, span=3600).orderBy("symbol", "g").collect()
    b = G.resample_asof_next(q, 900, span=86400 * 40).orderBy("symbol", "g").collect()
    assert a == b


def test_frame_engines_agree(spark):
    from tidemark.plans.frames import M, compute_frames
    from tidemark.schema import QUOTE_COLUMNS

    g = G.resample_last(quotes(spark, SF), 1800, QUOTE_COLUMNS)
    metrics = {f"{c}_{m}": M(c, m, 12 * 3600, 4) for c in ("bid_price", "bid_qty")
               for m in ("mean", "var", "std", "min", "max", "open", "close", "sum", "count", "q25", "q75", "median")}
    lags, leads = {"lb": ("bid_price", 5)}, {"ld": ("ask_price", 3)}
    a = compute_frames(g, ["exchange", "symbol"], 1800, metrics, lags, leads, engine="kernels", span=86400)
    b = compute_frames(g, ["exchange", "symbol"], 1800, metrics, lags, leads, engine="windows", span=86400)
    cols = list(metrics) + ["lb", "ld"]
    j = a.alias("a").join(b.alias("b"), ["exchange", "symbol", "g"])
    assert j.count() == a.count() == b.count() == g.count()
    diff = j.select(*[F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(c) for c in cols]).first().asDict()
    assert all(v is None or v < 1e-7 for v in diff.values()), diff
    nulls = j.select(*[F.sum((F.col(f"a.{c}").isNull() != F.col(f"b.{c}").isNull()).cast("int")).alias(c)
                       for c in cols]).first().asDict()
    assert all(v == 0 for v in nulls.values()), nulls


def test_frame_engines_agree_with_gaps(spark):
    """NULL cells inside frames (an unfilled grid): min_periods, open/close and quantiles agree."""
    from tidemark.plans.frames import M, compute_frames

    g = G.resample_last(quotes(spark, SF), 1800, ("bid_price",), fill="none")
    metrics = {f"m_{m}_{k}": M("bid_price", m, 10 * 3600, k) for m in ("mean", "var", "min", "open", "close",
                                                                        "q25", "median", "count") for k in (1, 3)}
    a = compute_frames(g, ["exchange", "symbol"], 1800, metrics, engine="kernels", span=86400)
    b = compute_frames(g, ["exchange", "symbol"], 1800, metrics, engine="windows", span=86400)
    j = a.alias("a").join(b.alias("b"), ["exchange", "symbol", "g"])
    cols = list(metrics)
    assert g.where("bid_price is null").count() > 0
    diff = j.select(*[F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(c) for c in cols]).first().asDict()
    assert all(v is None or v < 1e-7 for v in diff.values()), diff
    nulls = j.select(*[F.sum((F.col(f"a.{c}").isNull() != F.col(f"b.{c}").isNull()).cast("int")).alias(c)
                       for c in cols]).first().asDict()
    assert all(v == 0 for v in nulls.values()), nulls


def test_frames_after_a_spike(spark):
    """A bad tick leaves no trace once it has left the frame, whatever the chunk (relative 1e-9)."""
    import numpy as np
    import pandas as pd

    from helpers import grid_df
    from tidemark.plans.frames import M, compute_frames

    rng = np.random.default_rng(1)
    for spike in (1e6, 1e9):
        v = 1.0 + 1e-3 * rng.standard_normal(2000)
        v[500] = spike
        metrics = {m: M("bid_price", m, 60, 1) for m in ("mean", "var", "std", "sum")}
        for span in (128, 100_000):
            rows = compute_frames(grid_df(spark, v), ["exchange", "symbol"], 1, metrics, span=span).orderBy("g").collect()
            for i in (499, 500, 530, 559, 560, 561, 700, 1999):
                frame = pd.Series(v[max(0, i - 59) : i + 1])
                want = {"mean": frame.mean(), "var": ((frame - frame.mean()) ** 2).sum() / (len(frame) - 1), "sum": frame.sum()}
                for m, x in want.items():
                    assert abs(rows[i][m] - x) <= 1e-9 * abs(x), (spike, span, i, m, rows[i][m], x)
            assert all(r["var"] is None or r["var"] >= 0 for r in rows)


def test_signatures_do_not_depend_on_chunks_or_price_unit(spark):
    from tidemark.operators.patterns import pattern_table

    q = quotes(spark, SF)
    small = q.withColumn("bid_price", F.col("bid_price") * 2.0**-30).withColumn("ask_price", F.col("ask_price") * 2.0**-30)
    for kind in ("mean", "median", "mean_median"):
        cols = ["exchange", "symbol", "g", "pattern"]
        a = pattern_table(q, kind, 24 * 3600, 6, 2, 8, 0.0, freq=3600).select(cols)
        b = pattern_table(q, kind, 24 * 3600, 6, 2, 8, 0.0, freq=3600, span=30 * 3600).select(cols)
        c = pattern_table(small, kind, 24 * 3600, 6, 2, 8, 0.0, freq=3600).select(cols)
        assert a.count() == b.count() == c.count() > 0
        assert a.exceptAll(b).count() == 0 and a.exceptAll(c).count() == 0


def test_signature_by_definition():
    """Against exact fractions, with ties and constant stretches."""
    from fractions import Fraction

    import numpy as np

    from tidemark.plans.sliding import signatures

    rng = np.random.default_rng(2)
    v = np.round(rng.integers(0, 4, 300) * 0.1 + 0.7, 2)
    v[40:90] = 0.1
    v[120] = np.nan
    g = np.arange(300)
    for kind in ("mean", "median", "mean_median"):
        got = signatures(g, v, 12, 1, [1, 3, 7], kind, 12)
        for i in range(300):
            frame = [Fraction(x) for x in v[max(0, i - 11) : i + 1] if x == x]
            if len(frame) < 12:
                assert got[i] is None
                continue
            mean, s = sum(frame) / 12, sorted(frame)
            median = (s[5] + s[6]) / 2
            want = ""
            for k in (1, 3, 7):
                x = v[i - k + 1]
                a, b = x == x and Fraction(x) > mean, x == x and Fraction(x) > median
                want += format({"mean": a * 8 + 7, "median": b * 8 + 7, "mean_median": a * 8 + b * 4 + 3}[kind], "x")
            assert got[i] == want


def test_a_silent_year(spark):
    """Two ticks a year apart on a one-second grid: every point is there, and no array holds the gap."""
    from helpers import quotes_df

    year = 365 * 86400
    q = quotes_df(spark, [(0, 1.0, 1.0), (year, 2.0, 2.0)])
    for g in (G.resample_last(q, 1, ("bid_price",)), G.resample_asof_next(q, 1, ("bid_price",))):
        r = g.agg(F.count("*").alias("n"), F.max("g").alias("hi"), F.min("g").alias("lo"),
                  F.sum((F.col("bid_price") == 2.0).cast("int")).alias("filled")).first()
        assert r.n == year + 1 and r.hi - r.lo == year and r.filled == year
