"""Online state machines (R1-R3) on Structured Streaming, each with a batch twin.

State is kept per instrument with ``applyInPandasWithState``; within a
micro-batch rows are processed in (time, seq) order, exactly as ticks would
arrive one by one. The batch twins are window expressions that give the
same rows for the same input (checked in the tests with ``availableNow``).

Policy (the original has none): a tick older than the buffer horizon is
dropped; an equal-time tick replaces the buffered one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions import epoch_micros
from tidemark.plans import sliding
from tidemark.plans.chunking import CHUNK, with_halo
from tidemark.schema import KEYS

MICROS = 1_000_000


# --- R1: sliding tick buffer ----------------------------------------------------------------

BUFFER_OUT = "exchange string, symbol string, time_us long, seq long, bid_price double, buffer_size long, buffer_start_us long"
BUFFER_STATE = "times array<long>, values array<double>"


def _buffer_fn(max_us: int):
    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import numpy as np

        held = dict(zip(*state.get)) if state.exists else {}
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["time_us", "seq"], kind="stable")
        t = pdf["time_us"].to_numpy(dtype="int64")
        old = np.array(sorted(held), dtype="int64")
        if len(old):  # beyond the horizon of what is buffered: dropped
            keep = t > old[-1] - max_us
            pdf, t = pdf[keep], t[keep]
        if not len(t):
            return
        # within a batch times ascend: a tick's buffer is what is held and what came before it, less than
        # max_us older than the newest time so far
        newest = np.maximum(t, old[-1]) if len(old) else t
        fresh = np.unique(np.setdiff1d(t, old))
        everything = np.union1d(old, t)
        low = np.searchsorted(everything, newest - max_us, side="right")
        come = np.searchsorted(fresh, t, side="right")
        size = come + len(old) - np.searchsorted(old, newest - max_us, side="right") - np.searchsorted(fresh, newest - max_us, side="right")
        held.update(zip(t.tolist(), pdf["bid_price"].tolist()))
        ks = [k for k in sorted(held) if k > newest[-1] - max_us]
        state.update((ks, [held[k] for k in ks]))
        # the oldest buffered time: nothing that is still to come lies below the tick itself
        first = np.minimum(everything[np.minimum(low, len(everything) - 1)], t)
        yield pd.DataFrame({"exchange": key[0], "symbol": key[1], "time_us": t, "seq": pdf["seq"].to_numpy(),
                            "bid_price": pdf["bid_price"].to_numpy(), "buffer_size": size, "buffer_start_us": first})
    return fn


def _ticks(df: DataFrame) -> DataFrame:
    return df.select("exchange", "symbol", epoch_micros("time").alias("time_us"), "seq", "bid_price")


def tick_buffer_stream(ticks: DataFrame, max_seconds: int) -> DataFrame:
    """R1 (stream): per tick, the buffer size and start after add/replace and eviction.

    The buffer keeps rows with time > newest - max_seconds (strict).
    """
    return _ticks(ticks).groupBy("exchange", "symbol").applyInPandasWithState(
        _buffer_fn(int(max_seconds) * MICROS), BUFFER_OUT, BUFFER_STATE, "append", GroupStateTimeout.NoTimeout)


def tick_buffer(ticks: DataFrame, max_seconds: int, keys: Sequence[str] = KEYS, span_seconds: int = 86400) -> DataFrame:
    """R1 (batch twin, in-order input): buffer = distinct times in (t - max, t].

    Rows go to (instrument, day chunk) groups with a halo of ``max_seconds``
    (Spark shuffles them); inside each group the buffer size and start are
    binary searches over the sorted distinct times — O(n log n), where a
    range-frame window would rescan every frame per row.
    """
    keys = list(keys)
    d = _ticks(ticks)
    max_us = int(max_seconds) * MICROS
    h = with_halo(d, "time_us", int(span_seconds) * MICROS, before=max_us - 1)
    schema = ", ".join([f"{k} string" for k in keys]) + (
        ", time_us long, seq long, bid_price double, buffer_size long, buffer_start_us long")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        t = pdf["time_us"].to_numpy(dtype="int64")
        ut = np.unique(t)
        hi = np.searchsorted(ut, t, side="right")
        lo = np.searchsorted(ut, t - max_us, side="right")
        out = pdf.assign(buffer_size=(hi - lo).astype("int64"), buffer_start_us=ut[lo])
        out = out[out["_own"].to_numpy(dtype=bool)]
        return out[[*keys, "time_us", "seq", "bid_price", "buffer_size", "buffer_start_us"]]

    return h.groupBy(*keys, CHUNK).applyInPandas(run, schema)


# --- R2: online pattern signal --------------------------------------------------------------

SIGNAL_OUT = "exchange string, symbol string, time_us long, pattern string, signal int"
SIGNAL_STATE = "values array<double>"


def _signal_fn(size: int, offsets: Sequence[int], kind: str, buy: frozenset):
    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import numpy as np

        held = np.array(state.get[0] if state.exists else [], dtype="float64")
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values("time_us", kind="stable")
        vals = np.concatenate([held, pdf["bid_price"].to_numpy(dtype="float64", na_value=np.nan)])
        # rows are steps here: frames of ``size`` rows, nothing before the buffer is full
        found = sliding.signatures(np.arange(len(vals)), vals, size, 1, offsets, kind, 1)[len(held):]
        full = np.arange(len(held), len(vals)) >= size - 1
        state.update((vals[-size:].tolist(),))
        if full.any():
            rows = pdf[full]
            hit = [(key[0], key[1], p) in buy for p in found[full]]
            yield pd.DataFrame({"exchange": key[0], "symbol": key[1], "time_us": rows["time_us"].to_numpy(),
                                "pattern": found[full], "signal": np.array(hit, dtype="int32")})
    return fn


def pattern_signal_stream(grid: DataFrame, buy: Sequence[tuple[str, str, str]], size: int, offsets: Sequence[int],
                          kind: str = "mean") -> DataFrame:
    """R2 (stream): on gridded rows (one per step, in order), once ``size`` values are buffered,
    signal = 1 if the buffer's signature is in the buy set of its instrument.

    ``buy``: (exchange, symbol, pattern) rows, a pattern bought for one
    instrument says nothing about another. For buy sets too large to ship
    with the function use ``pattern_stream`` and join the set to its output.
    """
    d = grid.select("exchange", "symbol", epoch_micros("time").alias("time_us"), "bid_price")
    return d.groupBy("exchange", "symbol").applyInPandasWithState(
        _signal_fn(int(size), list(offsets), kind, frozenset(map(tuple, buy))), SIGNAL_OUT, SIGNAL_STATE, "append",
        GroupStateTimeout.NoTimeout)


def pattern_stream(grid: DataFrame, buy: DataFrame, size: int, offsets: Sequence[int], kind: str = "mean",
                   keys: Sequence[str] = KEYS) -> DataFrame:
    """R2 (stream): as ``pattern_signal_stream`` with the buy set as a static table: a stream-static
    left join on (instrument, pattern), so the set never passes through the driver."""
    found = pattern_signal_stream(grid, [], size, offsets, kind).drop("signal")
    b = buy.select(*keys, "pattern").distinct().withColumn("_hit", F.lit(1))
    return found.join(b, on=[*keys, "pattern"], how="left").select(
        *keys, "time_us", "pattern", F.coalesce("_hit", F.lit(0)).cast("int").alias("signal"))


def pattern_signal(grid: DataFrame, buy: DataFrame, size: int, offsets: Sequence[int], kind: str = "mean",
                   keys: Sequence[str] = KEYS, freq: int = 1) -> DataFrame:
    """R2 (batch twin): the same signature over the last ``size`` grid rows, joined with the buy set.

    Only full buffers get a signal.
    """
    from tidemark.plans.frames import M, Signature, compute_frames

    keys = list(keys)
    window = int(size) * int(freq)
    # rows of the frame, counted by their grid time (never null), decide whether the buffer is full
    d = compute_frames(grid.withColumn("_row", F.lit(1.0)), keys, freq, {"_n": M("_row", "count", window)},
                       signatures={"pattern": Signature("bid_price", kind, tuple(offsets), window)})
    d = d.where(F.col("_n") == F.lit(int(size)))
    b = buy.select(*keys, "pattern").distinct().withColumn("_hit", F.lit(1))
    return d.join(b, on=[*keys, "pattern"], how="left").select(
        *keys, F.unix_micros(F.col("time").cast("timestamp")).alias("time_us"), "pattern",
        F.coalesce("_hit", F.lit(0)).cast("int").alias("signal"))


# --- R3: closed bars for online prediction --------------------------------------------------

BAR_OUT = "exchange string, symbol string, time_us long, bid_price double, ask_price double"
BAR_STATE = "newest long, bid double, ask double, size long"


def _bar_fn(expire_ms: int | None = None):
    def fn(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import numpy as np

        newest, bid, ask = state.get[:3] if state.exists else (None, None, None)
        names = ["exchange", "symbol", "time_us", "bid_price", "ask_price"]
        if state.hasTimedOut:       # silent beyond the horizon: its open bar is closed by time, nothing is held
            state.remove()
            yield pd.DataFrame([(key[0], key[1], newest, bid, ask)], columns=names)
            return
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["time_us", "seq"], kind="stable")
        if newest is not None:      # older than the newest bar: dropped
            pdf = pdf[pdf["time_us"] >= newest]
        if len(pdf):
            t = pdf["time_us"].to_numpy(dtype="int64")
            last = np.append(np.flatnonzero(np.diff(t)), len(t) - 1)        # the last tick of every time
            bars = pdf.iloc[last][["time_us", "bid_price", "ask_price"]]
            if newest is not None and t[0] > newest:
                held = pd.DataFrame({"time_us": [newest], "bid_price": [bid], "ask_price": [ask]})
                bars = pd.concat([held.astype(bars.dtypes.to_dict()), bars], ignore_index=True)
            size = (state.get[3] if state.exists else 0) + len(last) - (newest is not None and t[0] == newest)
            end = bars.iloc[-1]
            value = [None if pd.isna(x) else float(x) for x in (end["bid_price"], end["ask_price"])]
            state.update((int(end["time_us"]), *value, int(size)))
            closed = bars.iloc[:-1]
            if len(closed):
                yield closed.assign(exchange=key[0], symbol=key[1])[names]
        if expire_ms is not None and state.exists:
            # a timeout must lie beyond the watermark
            at = max(state.get[0] // 1000 + expire_ms, state.getCurrentWatermarkMs() + 1)
            state.setTimeoutTimestamp(at)
    return fn


def closed_bars_stream(ticks: DataFrame, expire_seconds: int | None = None, watermark: str = "0 seconds") -> DataFrame:
    """R3 (stream): emit a bar when a newer time arrives (the second-to-last row = last closed bar).

    With ``expire_seconds`` an instrument that has been silent for so long (by the watermark) is closed by time: its
    last bar is emitted and its state removed, so the state doesn't grow with instruments that are gone.
    """
    if expire_seconds is not None:
        ticks = ticks.withWatermark("time", watermark)
    d = ticks.select("exchange", "symbol", "time", epoch_micros("time").alias("time_us"), "seq", "bid_price", "ask_price")
    if expire_seconds is None:
        return d.drop("time").groupBy("exchange", "symbol").applyInPandasWithState(
            _bar_fn(), BAR_OUT, BAR_STATE, "append", GroupStateTimeout.NoTimeout)
    return d.groupBy("exchange", "symbol").applyInPandasWithState(
        _bar_fn(int(expire_seconds) * 1000), BAR_OUT, BAR_STATE, "append", GroupStateTimeout.EventTimeTimeout)


def closed_bars(ticks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """R3 (batch twin): every time but the newest, with the last row at that time."""
    d = ticks.select(*keys, epoch_micros("time").alias("time_us"), "seq", "bid_price", "ask_price")
    last = d.groupBy(*keys, "time_us").agg(F.max_by(F.struct("bid_price", "ask_price"), "seq").alias("r"))
    newest = d.groupBy(*keys).agg(F.max("time_us").alias("_newest"))  # one row per instrument
    return last.join(newest, on=list(keys), how="inner").where(F.col("time_us") < F.col("_newest")).select(
        *keys, "time_us", "r.bid_price", "r.ask_price")


def predict_bars(model, path: str):
    """R3 sink: ``foreachBatch`` function applying a fitted model to closed bars.

    Predictions are appended to ``path`` (idempotent per epoch: the epoch id
    is a partition, overwritten on replay). Errors propagate (the original
    turned them into 0).
    """
    def run(batch: DataFrame, epoch_id: int) -> None:
        out = model.transform(batch).select("exchange", "symbol", "time_us",
                                            F.col("prediction").cast("int").alias("prediction"))
        (out.withColumn("epoch", F.lit(int(epoch_id))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path))
    return run
