"""Stream == batch for the online state machines (availableNow file streams)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from helpers import quotes_df, ts
from tidemark.operators.grid import resample_last
from tidemark.schema import QUOTES
from tidemark.sources.adapters import quotes
from tidemark.streaming import state as R


def _run_stream(spark, df_stream, name):
    q = (df_stream.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
         .trigger(availableNow=True).start())
    q.awaitTermination(240)
    out = spark.sql(f"SELECT * FROM {name}")
    return out


def _days_in_order(df, path, days=8):
    """Land one file per day, sequentially, so file arrival order = event order."""
    import os
    import time as _t

    ds = sorted(r["d"] for r in df.select(F.to_date("time").alias("d")).distinct().collect())[:days]
    for d in ds:
        df.where(F.to_date("time") == F.lit(d)).coalesce(1).write.mode("append").parquet(path)
        _t.sleep(0.05)
    assert os.path.isdir(path)
    return df.where(F.to_date("time") <= F.lit(ds[-1]))


def _as_stream(spark, df, schema_ddl, files=4):
    path = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp") + "/src"
    df.repartition(files).write.mode("overwrite").parquet(path)
    return spark.readStream.schema(schema_ddl).option("maxFilesPerTrigger", 1).parquet(path)


def test_buffer_evict(spark):
    q = quotes_df(spark, [(0, 1.0, 1.0), (1, 2.0, 2.0), (2, 3.0, 3.0)])
    b = R.tick_buffer(q, 2).orderBy("time_us").collect()
    assert [r["buffer_size"] for r in b] == [1, 2, 2]
    assert b[-1]["buffer_start_us"] == b[1]["time_us"]


def test_buffer_stream_equals_batch(spark):
    q = quotes(spark, "/root/testdata/sf0.001").where("symbol in ('click', 'view')")
    schema = ("exchange string, symbol string, seq long, time timestamp, bid_price double, ask_price double, "
              "bid_qty double, ask_qty double")
    # one file per day, in time order, so arrival order = event order
    path = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp") + "/src"
    q = _days_in_order(q, path)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)
    got = _run_stream(spark, R.tick_buffer_stream(src, 6 * 3600), "buf_stream")
    want = R.tick_buffer(q, 6 * 3600)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_predict_closed(spark):
    q = quotes_df(spark, [(0, 1.0, 1.0, 1), (1, 2.0, 2.0, 2), (1, 3.0, 3.0, 3)])
    bars = R.closed_bars(q).collect()
    assert len(bars) == 1 and bars[0]["bid_price"] == 1.0
    schema = ("exchange string, symbol string, seq long, time timestamp, bid_price double, ask_price double, "
              "bid_qty double, ask_qty double")
    src = _as_stream(spark, q, schema, files=1)
    got = _run_stream(spark, R.closed_bars_stream(src), "bars_stream").collect()
    assert len(got) == 1 and got[0]["bid_price"] == 1.0


def test_pattern_signal_stream_equals_batch(spark):
    g = resample_last(quotes(spark, "/root/testdata/sf0.001").where("symbol = 'click'"), 3600)
    offsets = [1, 2, 4, 6]
    size = 8
    sig_all = R.pattern_signal(g, spark.createDataFrame([], "exchange string, symbol string, pattern string"),
                               size, offsets, freq=3600)
    some = [r["pattern"] for r in sig_all.select("pattern").distinct().limit(3).collect()]
    buy = sig_all.select("exchange", "symbol", "pattern").where(F.col("pattern").isin(some)).distinct()
    want = R.pattern_signal(g, buy, size, offsets, freq=3600)
    path = tempfile.mkdtemp(prefix="stream-src-", dir="/tmp") + "/src"
    g = _days_in_order(g, path)
    want = R.pattern_signal(g, buy, size, offsets, freq=3600)
    src = spark.readStream.schema("exchange string, symbol string, g long, time timestamp, bid_price double, "
                                  "ask_price double").option("maxFilesPerTrigger", 2).parquet(path)
    rows = [tuple(r) for r in buy.collect()]
    got = _run_stream(spark, R.pattern_signal_stream(src, rows, size, offsets), "sig_stream")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.where("signal = 1").count() > 0
    # the buy set of another instrument says nothing about this one
    other = _run_stream(spark, R.pattern_signal_stream(src, [("SIM", "other", p) for p in some], size, offsets), "sig_other")
    assert other.count() == got.count() and other.where("signal = 1").count() == 0
    joined = _run_stream(spark, R.pattern_stream(src, buy, size, offsets), "sig_joined")
    assert joined.exceptAll(got.select(*joined.columns)).count() == 0 and joined.count() == got.count()


def test_streaming_candles_and_dedupe(spark):
    from tidemark.streaming.replay import streaming_candles, streaming_dedupe

    q = quotes(spark, "/root/testdata/sf0.001").where("symbol = 'click'")
    schema = ("exchange string, symbol string, seq long, time timestamp, bid_price double, ask_price double, "
              "bid_qty double, ask_qty double")
    src = _as_stream(spark, q.unionByName(q), schema, files=2)
    n = _run_stream(spark, streaming_dedupe(src, "1 hour"), "dedupe_stream").count()
    assert n == q.count()
    src2 = _as_stream(spark, q, schema, files=1)
    c = _run_stream(spark, streaming_candles(src2, 21600, "1 hour"), "candle_stream")
    assert c.count() > 0



def test_buffer_state_with_late_ticks():
    """The vectorised buffer against the one-tick-at-a-time definition, over batches with late ticks."""
    import random

    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    rnd, seconds = random.Random(9), 1_000_000
    for trial in range(40):
        buf, state, fn, at = {}, State(), R._buffer_fn(5 * seconds), 0
        for _ in range(6):
            at += rnd.randint(0, 4)
            ticks = [(rnd.randint(max(0, at - 7), at + 3) * seconds, s, rnd.random()) for s in range(rnd.randint(1, 6))]
            want = []
            for t, s, v in sorted(ticks):
                newest = max(buf) if buf else t
                if buf and t <= newest - 5 * seconds:
                    continue
                buf[t] = v
                newest = max(newest, t)
                buf = {k: x for k, x in buf.items() if k > newest - 5 * seconds}
                want.append((t, s, v, len(buf), min(buf)))
            frame = pd.DataFrame(ticks, columns=["time_us", "seq", "bid_price"])
            got = [tuple(r[2:]) for out in fn(("X", "Y"), iter([frame]), state) for r in out.itertuples(index=False)]
            assert got == want
            assert not state.exists or dict(zip(*state.get)) == buf


def test_stream_signal_runs_a_batch_for_each_file(spark, monkeypatch):
    """The grid arrives as several micro-batches in time order, so the state is carried between them."""
    import glob

    from tidemark import registry

    made, fresh = {}, registry._stream_dir
    monkeypatch.setattr(registry, "_stream_dir", lambda s, name: made.setdefault(name, fresh(s, name)))
    assert registry.q_stream_signal(spark, "/root/testdata/sf0.001").count() > 0
    folder = made["stream_signal"].removeprefix("file:")
    assert len(glob.glob(f"{folder}/ckpt/commits/[0-9]*")) == registry.STREAM_FILES


def test_silent_instruments_expire(spark, tmpdir_path):
    """An instrument that is silent beyond the horizon is closed by time and leaves no state."""
    from tidemark.registry import _file_stream
    from tidemark.streaming.state import closed_bars_stream

    rows = [("SIM", "A", i, ts(i * 100), float(i), i + 1.0) for i in range(100)]
    rows += [("SIM", "B", 1000, ts(0), 5.0, 6.0), ("SIM", "B", 1001, ts(0), 7.0, 8.0), ("SIM", "C", 1002, ts(10), 1.0, None)]
    df = spark.createDataFrame(rows, "exchange string, symbol string, seq long, time timestamp, bid_price double, ask_price double")
    src = _file_stream(spark, df, f"{tmpdir_path}/ticks", ["time", "seq"])
    q = (closed_bars_stream(src, 600).writeStream.format("parquet").option("path", f"{tmpdir_path}/out")
         .option("checkpointLocation", f"{tmpdir_path}/ckpt").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{tmpdir_path}/out").collect()
    by = {s: sorted(r["bid_price"] for r in got if r["symbol"] == s) for s in "ABC"}
    assert by == {"A": [float(i) for i in range(99)], "B": [7.0], "C": [1.0]}
    last = [p for p in q.recentProgress if p["stateOperators"]][-1]
    assert last["stateOperators"][0]["numRowsTotal"] == 1                # A alone is still held
