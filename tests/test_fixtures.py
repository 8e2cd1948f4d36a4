"""Hand-computed micro-fixtures (FIXTURES.md §3): the expected values are part of the test."""

import math

import pytest
import numpy as np
from pyspark.sql import functions as F

from helpers import grid_df, quotes_df, ts
from tidemark.functions import hex_from_bits
from tidemark.operators import grid as G
from tidemark.operators import quality as Q
from tidemark.operators import reports as R
from tidemark.operators import rolling as W
from tidemark.operators.labels import profit_label, profit_pct, profit_sign
from tidemark.operators.ml.prep import minmax_scale
from tidemark.operators.ml.select import chi2_scores
from tidemark.plans.sliding import signatures
from tidemark.operators.portfolio import fee_returns, portfolio_report
from tidemark.plans import datasets as B
from tidemark.sources.scans import scan_points


def col(df, c, order="g"):
    return [r[c] for r in df.orderBy(order).collect()]


def test_grid_bfill(spark):
    q = quotes_df(spark, [(0.2, 10.0, 10.0), (0.9, 11.0, 11.0), (3.5, 13.0, 13.0)])
    assert col(G.resample_last(q, 1), "bid_price") == [11, 13, 13, 13]


def test_grid_bfill_chunked_matches(spark):
    q = quotes_df(spark, [(0.2, 10.0, 10.0), (0.9, 11.0, 11.0), (3.5, 13.0, 13.0), (9.1, 20.0, None)])
    a = G.resample_last(q, 1).orderBy("g").collect()
    b = G.resample_last(q, 1, span=2).orderBy("g").collect()
    assert a == b and len(a) == 10


def test_grid_asof_next(spark):
    q = quotes_df(spark, [(0.2, 10.0, 10.0), (0.9, 11.0, 11.0), (3.5, 13.0, 13.0)])
    assert col(G.resample_asof_next(q, 1), "bid_price") == [10, 13, 13, 13]


def test_grid_null_last(spark):
    q = quotes_df(spark, [(0.2, 10.0, 10.0), (0.9, None, 11.0)])
    r = G.resample_last(q, 1).collect()
    assert r[0]["bid_price"] == 10 and r[0]["ask_price"] == 11


def test_grid_ffill(spark):
    q = quotes_df(spark, [(0.2, 10.0, 10.0), (3.5, 13.0, 13.0)])
    assert col(G.resample_last(q, 1, fill="ffill"), "bid_price") == [10, 10, 10, 13]


def _framed_mean(spark, values, window, mp=1):
    g = grid_df(spark, values)
    w = W.frame(window)
    d = W.framed(g, {"m": W.with_min_periods(F.avg("bid_price").over(w), "bid_price", w, mp)}, lookback=window - 1)
    return col(d, "m")


def test_frame_left_open(spark):
    assert _framed_mean(spark, [1, 2, 3, 4], 2) == [1, 1.5, 2.5, 3.5]


def test_min_periods(spark):
    assert _framed_mean(spark, [1, 2, 3, 4], 4, mp=3) == [None, None, 2, 2.5]


def test_var_one(spark):
    d = W.rolling(grid_df(spark, [5.0]), ["bid_price"], ["rolling_var"], window=10)
    assert d.collect()[0]["bid_price_rolling_var"] is None


def test_quartile_coeff(spark):
    d = W.rolling(grid_df(spark, [1, 2, 3, 4]), ["bid_price"], ["rolling_q25", "rolling_q75", "rolling_coeff"],
                  window=4)
    last = d.orderBy(F.col("g").desc()).first()
    assert last["bid_price_rolling_q25"] == pytest.approx(1.75)
    assert last["bid_price_rolling_q75"] == pytest.approx(3.25)
    assert last["bid_price_rolling_coeff"] == pytest.approx(0.3)


def test_label_tail_kept(spark):
    g = grid_df(spark, [1, 2, 1])
    d = W.framed(g, {"profit": profit_label(1, 0.0)}, lookahead=1)
    assert col(d, "profit") == [1, 0, 0]


def test_label_tail_dropped(spark):
    g = grid_df(spark, [1, 2, 1])
    d = W.framed(g, {"pct": profit_pct(1, 0.0)}, {"sign": profit_sign("pct")}, lookahead=1).na.drop(subset=["pct"])
    assert col(d, "sign") == [1, 0]


def test_seq_gap(spark):
    q = quotes_df(spark, [(0, 1.0, 1.0, 1), (1, 1.0, 1.0, 2), (2, 1.0, 1.0, 4)])
    assert col(Q.seq_gaps(q), "seq", "seq") == [1, 4]


def test_dedupe_seq(spark):
    q = quotes_df(spark, [(0, 1.0, 1.0, 5), (1, 2.0, 2.0, 5)])
    r = Q.dedupe_seq(q).collect()
    assert len(r) == 1 and r[0]["bid_price"] == 2.0


def test_open_interval(spark):
    q = quotes_df(spark, [(0, 1.0, 1.0), (1, 2.0, 2.0), (2, 3.0, 3.0)])
    d = scan_points(q, str(ts(0)), str(ts(2)).replace(".000", ""))
    # a full datetime end gets .999 appended: 2 s is inside (0, 2.999); check the strict start
    assert [r["bid_price"] for r in d.orderBy("time").collect()][0] == 2.0
    d2 = q.where((F.col("time") > F.lit(str(ts(0))).cast("timestamp")) & (F.col("time") < F.lit(str(ts(2))).cast("timestamp")))
    assert [r["bid_price"] for r in d2.collect()] == [2.0]


def test_pattern_mean(spark):
    v = [1.0, 2.0, 6.0]
    assert signatures(np.arange(3), np.array(v), 3, 1, [1, 2], "mean", 3)[-1] == "f7"


def test_pattern_wide(spark):
    one = F.lit(1)
    r = spark.range(1).select(hex_from_bits([one] * (31 * 4)).alias("h")).first()["h"]
    assert r == "f" * 31


def test_byte_pattern(spark):
    n = 4000
    q = quotes_df(spark, [(i, float(i), float(i)) for i in range(n)])
    d = B.moving_average_pattern(q, window=3600, shift=10, freq=1)
    sig = d.select(F.min("signal").alias("lo"), F.max("signal").alias("hi")).first()
    assert sig["lo"] == 255 and sig["hi"] == 255


def test_scaler_const(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    s, _ = minmax_scale(df, ["x"])
    assert [r["x"] for r in s.collect()] == [0.0, 0.0]


def test_chi2(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 1), (1.0, 1)], "x double, y int")
    assert chi2_scores(df, ["x"], "y").first()["score"] == pytest.approx(1.0)


def test_margins(spark):
    p = spark.createDataFrame([(1, 1), (1, 0), (0, 0)], "actual int, predicted int")
    m = {(r["actual"], r["predicted"]): r["count"] for r in R.confusion_margins(p).collect()}
    assert m[("All", "All")] == 3 and m[("1", "All")] == 2 and m[("All", "0")] == 2


def test_iba(spark):
    p = spark.createDataFrame([(1, 1), (0, 1), (0, 0)], "actual int, predicted int")
    r = {x["label"]: x for x in R.imbalanced_report(p).collect()}["1"]
    assert r["rec"] == 1.0 and r["spe"] == 0.5
    assert r["geo"] == pytest.approx(0.707107, abs=1e-6) and r["iba"] == pytest.approx(0.525)


def test_classification_report_counts(spark):
    p = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 1)], "actual int, predicted int")
    r = {x["label"]: x for x in R.classification_report(p).collect()}
    assert r["1"]["precision"] == pytest.approx(2 / 3) and r["1"]["recall"] == 1.0
    assert r["accuracy"]["f1_score"] == pytest.approx(0.75) and r["accuracy"]["support"] == 4


def test_fee_return(spark):
    g = grid_df(spark, [10, 11], ask=[10.5, 11.5])
    r = col(fee_returns(g, window=1), "ret")
    assert r[0] is None and r[1] == pytest.approx(-0.217391, abs=1e-6)


def test_sharpe(spark):
    m = spark.createDataFrame([(1, 1.0, 0.0, 0.0), (2, 2.0, 0.0, 0.0), (3, 3.0, 0.0, 0.0)],
                              "g long, a double, b double, c double")
    rows = portfolio_report(m, ["a", "b", "c"]).collect()
    assert len(rows) == 6
    for r in rows:
        assert r["sharpe_ratio"] == pytest.approx(3.464102, abs=1e-6)
        assert r["total"] == 6 and r["pct_win"] == 100.0


def test_ttl_strict(spark):
    rep = spark.createDataFrame([("X", 1000, 1.5)], "instrument_id string, created_at long, sharp_ratio double")
    assert R.last_sharpe_ttl(rep, now_epoch=1100, ttl_seconds=100).first()["sharp_ratio"] is None
    assert R.last_sharpe_ttl(rep, now_epoch=1099, ttl_seconds=100).first()["sharp_ratio"] == 1.5


def test_split_sizes(spark):
    df = spark.createDataFrame([(ts(i),) for i in range(10)], "time timestamp")
    s = R.chrono_split(df, 0.25).orderBy("time").collect()
    assert [r["split"] for r in s] == ["train"] * 7 + ["test"] * 3


def test_split_chunked_exact(spark):
    df = spark.createDataFrame([(ts(i * 7),) for i in range(1000)], "time timestamp")
    a = [r["split"] for r in R.chrono_split(df, 0.3, chunk_seconds=60).orderBy("time").collect()]
    assert a == ["train"] * 700 + ["test"] * 300


def test_shuffled_split_exact(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    s = R.shuffled_split(df, ["k"], 0.25, seed=7)
    assert s.where("split = 'test'").count() == 250
    again = R.shuffled_split(df, ["k"], 0.25, seed=7)
    assert s.where("split='test'").select("k").exceptAll(again.where("split='test'").select("k")).count() == 0


def test_missing_partitions(spark):
    q = quotes_df(spark, [(0, 1.0, 1.0), (86400 * 2, 1.0, 1.0)], "A").unionByName(
        quotes_df(spark, [(0, 1.0, 1.0), (86400, 1.0, 1.0), (86400 * 2, 1.0, 1.0)], "B"))
    m = Q.missing_partitions(q).collect()
    assert [(r["symbol"], r["date"]) for r in m] == [("A", "20240102")]


def test_week_of_year(spark):
    from tidemark.functions import week_of_year_sunday

    r = spark.createDataFrame([("2024-01-01",), ("2024-01-07",), ("2023-01-01",)], "d string").select(
        week_of_year_sunday(F.to_date("d")).alias("w")).collect()
    assert [x["w"] for x in r] == ["00", "01", "01"]


def test_nan_is_null(spark):
    from tidemark.functions import nan_to_null

    r = spark.createDataFrame([(float("nan"),)], "x double").select(nan_to_null("x").alias("x")).first()
    assert r["x"] is None and not (isinstance(r["x"], float) and math.isnan(r["x"]))


def test_grid_no_fill(spark):
    q = quotes_df(spark, [(0.2, 10.0, 10.0), (3.5, 13.0, 13.0)])
    assert col(G.resample_last(q, 1, fill="none"), "bid_price") == [10, None, None, 13]
    assert col(G.resample_last(q, 1, fill="none", span=2), "bid_price") == [10, None, None, 13]
