"""A5/A11 fixtures, job compositions and plan-shape checks."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import reports as R
from tidemark.operators.align import first_seen_distinct, params_matrix
from tidemark.plans import jobs as X
from tidemark.sources.adapters import quotes

SF = "/root/testdata/sf0.001"


def test_backtest_rollup(spark):
    t = spark.createDataFrame(
        [("f1", 1, "2024-01-01", "2024-01-02", 1.0, 0.5, "s"), ("f1", 2, "2024-01-02", "2024-01-05", 3.0, 0.9, "s"),
         ("f2", 1, "2024-01-01", "2024-01-03", -1.0, -0.2, "t")],
        "source string, seq long, start_date string, end_date string, cum_profit double, sharp_ratio double, "
        "signal string")
    r = {x["source"]: x for x in R.backtest_rollup(t).collect()}
    assert r["f1"]["cum_profit"] == 3.0 and r["f1"]["number_of_trades"] == 2
    assert r["f1"]["first_date"] == "2024-01-01" and r["f1"]["last_date"] == "2024-01-05"
    assert r["f2"]["number_of_trades"] == 1 and len(r["f1"]["uuid"]) == 36


def test_event_listing(spark):
    ev = spark.createDataFrame(
        [("2024-01-02", "BTC", "fork", 10), ("2024-01-03", "ETH", "listing", 50), ("2024-02-01", "BTC", "fork", 99),
         ("2024-01-04", "BTC", "listing", 70)],
        "date_start string, coin string, tag string, views long").withColumn("date_start", F.to_date("date_start"))
    r = R.event_listing(ev, "2024-01-01", "2024-01-31", coins=["BTC"], page_size=30).collect()
    assert [x["views"] for x in r] == [70, 10]
    r = R.event_listing(ev, "2024-01-01", "2024-01-31", tags=["listing"], page_size=1).collect()
    assert [x["coin"] for x in r] == ["BTC"]


def test_params_matrix_and_first_seen(spark):
    pm = params_matrix(spark, {"depth": [2, 4], "eta": [0.1, 0.3, 0.5]})
    assert pm.count() == 6 and pm.distinct().count() == 6
    ev = spark.createDataFrame([(1, "b", 3), (1, "a", 1), (1, "b", 0), (2, "c", 5)], "u long, v string, t long")
    r = {x["u"]: x["vals"] for x in first_seen_distinct(ev, ["u"], "v", "t", "vals").collect()}
    assert r[1] == ["b", "a"] and r[2] == ["c"]


def test_job_backup_round_trip(spark, tmpdir_path):
    from tidemark.sources.metrics import ticks_to_metrics
    from tidemark.sources.scans import scan_quotes

    q = quotes(spark, SF).where("symbol = 'view'")
    exp = ticks_to_metrics(q.withColumn("seq", F.col("seq").cast("double")))
    exp.write.json(f"{tmpdir_path}/export")
    assert X.job_backup(spark, f"{tmpdir_path}/export", f"{tmpdir_path}/ticks")
    back = scan_quotes(spark, f"{tmpdir_path}/ticks", "SIM_view")
    assert back.count() == q.count()


def test_job_portfolio(spark, tmpdir_path):
    q = quotes(spark, SF)
    inst = sorted(f"SIM_{r[0]}" for r in q.select("symbol").distinct().collect())
    out = X.job_portfolio(q, inst, tmpdir_path, window=4, freq=3600)
    assert out["portfolio"].count() == 60 and out["correlation"].count() == 25


def test_job_learning_goes_on_where_it_stopped(spark, tmpdir_path, monkeypatch):
    import numpy as np

    from tidemark.operators.ml import train as MT

    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), float(c), int(a + 0.2 * b > 0)) for i, (a, b, c) in enumerate(rng.normal(size=(600, 3)))]
    d = spark.createDataFrame([*rows, (600, float("inf"), 0.0, 0.0, 1)], "i long, good double, some double, noise double, label int")
    d = d.withColumn("time", F.timestamp_seconds(F.col("i") * 60))
    bt = spark.createDataFrame([("ALL", "2024-01-05", 7, 2.5)], "instrument string, end_date string, number_of_trades long, sharp_ratio double")
    args = (d, ["good", "some", "noise"], "label", tmpdir_path)
    kw = dict(k=1, estimators=("LogisticRegression", "DecisionTreeClassifier"), ties="i", rounds=5, backtests=bt)
    real, fits = MT.train, []

    def train(df, features, label, name, *a, **k):
        fits.append((name, list(features)))
        if name == "DecisionTreeClassifier" and len(fits) == 2:
            raise RuntimeError("lost")
        return real(df, features, label, name, *a, **k)

    monkeypatch.setattr(MT, "train", train)
    with pytest.raises(RuntimeError):
        X.job_learning(*args, **kw)
    rep = X.job_learning(*args, **kw)
    assert [n for n, _ in fits] == ["LogisticRegression", "DecisionTreeClassifier", "DecisionTreeClassifier"]
    assert all("good" in f and "noise" not in f for _, f in fits)
    got = {(r["estimator"], r["label"]): r["f1_score"] for r in rep.collect()}
    assert len(got) == 10 and min(got[e, "accuracy"] for e in ("LogisticRegression", "DecisionTreeClassifier")) > 0.85
    # the scaler comes from the train part (420 of 600 complete rows)
    low = spark.read.parquet(f"{tmpdir_path}/scaler").first()["good_min"]
    assert low == min(r[1] for r in rows[:420])
    assert X.job_learning(d.limit(0), ["good"], "label", f"{tmpdir_path}/none").count() == 0
    summary = spark.read.parquet(f"{tmpdir_path}/learning_summary").collect()
    assert len(summary) == 2 and summary[0]["number_of_trades"] == 7


@pytest.mark.parametrize("name", ["resample_last", "ohlc", "rolling_data", "seq_gaps", "portfolio", "chrono_split"])
def test_no_single_partition_exchange(spark, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # a global window or sort would show up as a single-partition exchange
    assert "SinglePartition" not in plan
    if "Window [" in plan:
        # row windows run per (instrument, chunk); only per-chunk summaries are per instrument
        assert "_chunk" in plan or "_ck" in plan


def test_learning_summary(spark):
    p = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 1)], "actual int, predicted int")
    rep = R.classification_report(p).withColumn("instrument", F.lit("SIM_x")).withColumn("estimator", F.lit("lr"))
    bt = spark.createDataFrame([("SIM_x", "2024-01-02", 3, 1.5), ("SIM_x", "2024-01-05", 7, 2.5)],
                               "instrument string, end_date string, number_of_trades long, sharp_ratio double")
    r = R.learning_summary(rep, bt).collect()
    assert len(r) == 1
    assert r[0]["precision_1"] == pytest.approx(2 / 3) and r[0]["recall_0"] == 0.5
    assert r[0]["number_of_trades"] == 7 and r[0]["sharp_ratio"] == 2.5


def test_job_backtest_report(spark, tmpdir_path):
    csv = f"{tmpdir_path}/trades.csv"
    with open(csv, "w") as f:
        f.write("start_date,end_date,cum_profit,symbol.SELL,sharp_ratio,source_name.SELL,source,seq,signal\n")
        f.write("2024-01-01,2024-01-02,1.0,EUR,0.5,a,f1,1,macd\n")
        f.write("2024-01-02,2024-01-05,3.0,EUR,0.9,a,f1,2,macd\n")
        f.write("2024-01-01,2024-01-03,-1.0,USD,1.5,b,f2,1,macd\n")
        f.write("2024-01-01,2024-01-03,2.0,JPY,0.1,c,f3,1,rsi\n")
    ranked = X.job_backtest_report(spark, csv, f"{tmpdir_path}/out")
    r = {x["source"]: x for x in ranked.collect()}
    assert r["f2"]["rank"] == 1 and r["f1"]["rank"] == 2 and r["f3"]["rank"] == 1
    assert r["f1"]["number_of_trades"] == 2 and r["f1"]["cum_profit"] == 3.0
    out = spark.read.parquet(f"{tmpdir_path}/out")
    assert sorted(r["signal"] for r in out.select("signal").distinct().collect()) == ["macd", "rsi"]


def test_job_feed_dates(spark):
    q = quotes(spark, SF)
    series = spark.createDataFrame([("SIM_click",), ("SIM_view",), ("OTHER_x",)], "series string")
    r = X.job_feed_dates(series, q, "SIM_c").collect()
    assert [x["symbol"] for x in r] == ["click"] and r[0]["first"] < r[0]["last"]


def test_job_features_importance_and_csv(spark, tmpdir_path):
    from tidemark.sinks.writers import write_dataset_csv
    from tidemark.sources.adapters import dataset_from_lineitem, table

    d = dataset_from_lineitem(table(spark, SF, "lineitem"))
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    out = X.job_features_importance(d, feats, "label", tmpdir_path, k=2)
    assert out["chi2"].count() == 2 and out["rfe"].where("ranking = 1").count() == 1
    back = spark.read.option("header", True).csv(f"{tmpdir_path}/chi2")
    assert back.count() == 2
    write_dataset_csv(d.select(*feats, "label"), f"{tmpdir_path}/ds", {"target": "label"})
    meta = spark.read.text(f"{tmpdir_path}/ds/meta").first()["value"]
    assert '"target": "label"' in meta
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/ds/data").count() == d.count()


def test_job_patterns(spark, tmpdir_path):
    from tidemark.sources.scans import load_buy_patterns

    out = X.job_patterns(quotes(spark, SF), tmpdir_path, "mean", 0.5, window=24 * 3600, shift=6, step=2,
                         nbr_samples=8, freq=3600)
    n_buy = out["buy"].count()
    assert out["signals"].where("signal = 1").count() >= n_buy
    stored = load_buy_patterns(spark, f"{tmpdir_path}/scores")
    keys = ["exchange", "symbol", "pattern"]
    assert stored.select(*keys).distinct().count() == out["buy"].select(*keys).distinct().count()


def test_two_hundred_instruments_plan_at_once(spark):
    """The plan of F3 and F4 does not grow with the instruments; numbers against numpy on some triples."""
    import itertools
    import time

    import numpy as np

    from tidemark.operators.portfolio import correlation, portfolio_report, portfolios

    names = [f"i{k:03d}" for k in range(200)]
    rng = np.random.default_rng(3)
    x = rng.normal(size=(30, 200)) + 5.0
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{c} double" for c in names)).repartition(3)
    began = time.time()
    corr, report = correlation(df, names), portfolio_report(df, names, distinct_sets=True)
    assert time.time() - began < 20
    got = {(r.a, r.b): r["corr"] for r in corr.collect()}
    want = np.corrcoef(x.T)
    assert len(got) == 200 * 200
    assert all(abs(got[names[i], names[j]] - want[i, j]) < 1e-9 for i, j in ((0, 1), (7, 150), (199, 3), (5, 5)))
    rows = {r.portfolio: r for r in report.where("portfolio like 'i000_i00%'").collect()}
    assert report.count() == 200 * 199 * 198 // 6
    for a, b in itertools.combinations(range(1, 6), 2):
        r = x[:, 0] + x[:, a] + x[:, b]
        g = rows[f"{names[0]}_{names[a]}_{names[b]}"]
        assert abs(g.sharpe_ratio - r.mean() / r.std(ddof=1) * np.sqrt(30)) < 1e-8 and abs(g.total - r.sum()) < 1e-8
        assert g.pct_win == (r >= 0).mean() * 100
    assert portfolios(spark, names[:5]).count() == 60
