"""Round trips through the landed layouts (temp dirs)."""



from helpers import quotes_df
from pyspark.sql import functions as F

from tidemark.sinks import writers as K
from tidemark.sources import metrics as S6
from tidemark.sources import scans as S
from tidemark.sources.adapters import quotes


def test_ticks_round_trip(spark, tmpdir_path):
    q = quotes(spark, "/root/testdata/sf0.001")
    root = f"{tmpdir_path}/ticks"
    assert K.write_ticks(q, root)
    back = S.scan_quotes(spark, root, "SIM_click")
    want = q.where("symbol = 'click'")
    assert back.count() == want.count()
    cols = ["seq", "bid_price", "ask_price", "bid_qty", "ask_qty"]
    assert back.select(*cols).exceptAll(want.select(*cols)).count() == 0


def test_scan_prunes_partitions(spark, tmpdir_path):
    q = quotes(spark, "/root/testdata/sf0.001")
    root = f"{tmpdir_path}/ticks"
    K.write_ticks(q, root)
    d = S.scan_quotes(spark, root, "SIM_view", start_date="2024-01-02", end_date="2024-01-03")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "view" in plan
    assert set(r["date"] for r in d.select("date").distinct().collect()) <= {"20240102", "20240103"}


def test_scan_ticks_missing_root(spark, tmpdir_path):
    d = S.scan_ticks(spark, f"{tmpdir_path}/none", "SIM_x", "2024-01-01", "2024-01-02")
    assert d.count() == 0 and "bid_price" in d.columns


def test_write_skips_empty(spark, tmpdir_path):
    q = quotes(spark, "/root/testdata/sf0.001").limit(0)
    assert K.write_ticks(q, f"{tmpdir_path}/empty") is False


def test_features_round_trip(spark, tmpdir_path):
    from tidemark.operators.grid import resample_last

    g = resample_last(quotes(spark, "/root/testdata/sf0.001"), 3600, ("bid_price", "ask_price"))
    lng = K.features_long(g, ["bid_price", "ask_price"])
    root = f"{tmpdir_path}/features"
    assert K.write_features(lng, root)
    wide = S.scan_features(spark, root, ["bid_price", "ask_price"], "SIM_click")
    assert wide.count() == g.where("symbol = 'click'").count()


def test_metrics_round_trip(spark):
    q = quotes_df(spark, [(0.0, 1.0, 2.0), (1.0, 3.0, None), (2.5, None, 4.0)], "EUR_USD")
    exp = S6.ticks_to_metrics(q, ("seq", "bid_price", "ask_price"), chunk_seconds=1)
    ticks = S6.metrics_to_ticks(exp, ("seq", "bid_price", "ask_price")).orderBy("time").collect()
    assert [r["symbol"] for r in ticks] == ["EUR_USD"] * 3
    assert [r["bid_price"] for r in ticks] == [1.0, 3.0, None]
    assert [r["ask_price"] for r in ticks] == [2.0, None, 4.0]


def test_metric_values_are_dealt_to_tasks_by_their_number(spark, monkeypatch):
    """One task's share is bounded: ten times the values are ten times the tasks; what merges is unchanged."""
    monkeypatch.setattr(S6, "TASK_TICKS", 20)
    monkeypatch.setattr(S6, "TASK_VALUES", 50)
    rows = [(float(i % 300), float(i), None if i % 7 == 0 else float(-i)) for i in range(600)]
    q = quotes_df(spark, rows, "EUR_USD").unionByName(quotes_df(spark, rows[:5], "X"))
    exp = S6.ticks_to_metrics(q, ("bid_price", "ask_price"), chunk_seconds=10)
    assert exp.rdd.getNumPartitions() == 31                     # 605 ticks by 20
    got = {r["metric"] + str(r["timestamps"][0]): r for r in exp.collect()}
    assert len(got) == 62 and all(r["timestamps"] == sorted(r["timestamps"]) and None not in r["values"] for r in got.values())
    ticks = S6.metrics_to_ticks(exp, ("bid_price", "ask_price"))
    values = sum(len(r["values"]) for r in got.values())
    assert ticks.rdd.getNumPartitions() == -(-values // 50)
    at = {(r["symbol"], r["time"].second + 60 * r["time"].minute): (r["bid_price"], r["ask_price"]) for r in ticks.collect()}
    assert len(at) == 305
    for i in range(300):        # of a repeated timestamp the later place, that is the larger value
        asks = [-float(j) for j in (i, i + 300) if j % 7]
        assert at["EUR_USD", i] == (float(i + 300), max(asks) if asks else None)


def test_instrument_catalog(spark):
    names = spark.createDataFrame([("OANDA_EUR_USD_bid_price",), ("OANDA_EUR_USD_seq",), ("KRAKEN_BTC_EUR_seq",)],
                                  "metric string")
    cat = sorted(r["instrument"] for r in S6.instrument_catalog(names).collect())
    assert cat == ["KRAKEN_BTC_EUR", "OANDA_EUR_USD"]
    assert [r["instrument"] for r in S6.instrument_catalog(names, "OANDA").collect()] == ["OANDA_EUR_USD"]


def test_normalize_points(spark):
    p = spark.createDataFrame([("2024-01-01T10:00:00.700Z", "oanda", "eur_usd", 1.0)],
                              "time string, exchange string, symbol string, bid_price double")
    r = S6.normalize_points(p).first()
    assert r["exchange"] == "OANDA" and r["symbol"] == "EUR_USD" and r["date"] == "20240101"
    assert r["database_timestamp"] == 1704103200.0


def test_mirror_idempotent(spark, tmpdir_path):
    q = quotes(spark, "/root/testdata/sf0.001")
    src, dst = f"{tmpdir_path}/src", f"{tmpdir_path}/dst"
    K.write_ticks(q, src)
    first = K.mirror_partitions(spark, src, dst, where="symbol = 'click'").count()
    assert first > 0
    assert K.mirror_partitions(spark, src, dst, where="symbol = 'click'").count() == 0
    assert spark.read.parquet(dst).count() == q.where("symbol = 'click'").count()


def test_purge_dry_run(spark, tmpdir_path):
    q = quotes(spark, "/root/testdata/sf0.001")
    root = f"{tmpdir_path}/ticks"
    K.write_ticks(q, root)
    found = K.purge_partitions(spark, root, "SIM", "click", ["20240101", "20991231"])
    assert len(found) == 1
    assert spark.read.parquet(root).where("symbol='click' and date='20240101'").count() > 0
    K.purge_partitions(spark, root, "SIM", "click", ["20240101"], confirm=True)
    spark.catalog.clearCache()
    assert spark.read.parquet(root).where("symbol='click' and date='20240101'").count() == 0


def test_run_context_unique(spark, tmpdir_path):
    path = f"{tmpdir_path}/ctx"
    c = spark.createDataFrame([("r1", '{"a": 1}'), ("r1", '{"a": 2}'), ("r2", "{}")], "run_id string, context string")
    K.insert_run_context(spark, c, path)
    K.insert_run_context(spark, c, path)
    assert spark.read.parquet(path).count() == 2


def test_read_meta_skips_bad_json(spark, tmpdir_path):
    import os

    os.makedirs(f"{tmpdir_path}/meta")
    with open(f"{tmpdir_path}/meta/a.json", "w") as f:
        f.write('{"features": ["x"], "target": "profit", "parts": [{"split": "train", "size": 10}]}')
    with open(f"{tmpdir_path}/meta/b.json", "w") as f:
        f.write("{not json")
    m = S.read_meta(spark, f"{tmpdir_path}/meta").collect()
    assert len(m) == 1 and m[0]["target"] == "profit" and m[0]["parts"][0]["size"] == 10


def test_csv_scan(spark, tmpdir_path):
    p = f"{tmpdir_path}/r.csv"
    with open(p, "w") as f:
        f.write("start_date,end_date,cum_profit\n2024-01-01,2024-01-02,1.5\n")
    d = S.read_csv(spark, p, "start_date string, end_date string, cum_profit double")
    assert d.first()["cum_profit"] == 1.5


def test_tick_day_list_hours():
    assert S.day_list_hours("2024-01-01", "2024-01-03") == ["20240101", "20240102", "20240103"]
    assert S.day_list_hours("2024-01-01", "2024-01-03", "10:00:00", "09:00:00") == ["20240101", "20240102"]


def test_dynamic_overwrite_keeps_other_partitions(spark, tmpdir_path):
    q = quotes(spark, "/root/testdata/sf0.001")
    root = f"{tmpdir_path}/ticks"
    K.write_ticks(q, root)
    few = q.where("symbol = 'click'").orderBy("time").limit(5).withColumn("date", F.date_format("time", "yyyyMMdd"))
    days = [r["date"] for r in few.select("date").distinct().collect()]
    K.write_ticks(few, root)
    back = S._read(spark, root)
    assert back.where("symbol = 'view'").count() == q.where("symbol = 'view'").count()
    assert back.where(F.col("symbol") == "click").where(F.col("date").isin(days)).count() == 5
    others = q.where("symbol = 'click'").where(~F.date_format("time", "yyyyMMdd").isin(days)).count()
    assert back.where(F.col("symbol") == "click").where(~F.col("date").isin(days)).count() == others
