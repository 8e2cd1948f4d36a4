"""Small builders for hand-computed fixtures."""

import datetime as dt

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def quotes_df(spark, rows, symbol="AAA"):
    """rows: (seconds, bid, ask[, seq]) -> quotes frame (bid/ask may be None)."""
    out = []
    for i, r in enumerate(rows):
        sec, bid, ask = r[0], r[1], r[2]
        seq = r[3] if len(r) > 3 else i + 1
        out.append(("SIM", symbol, int(seq), ts(sec), bid, ask, 1.0, 1.0))
    return spark.createDataFrame(
        out, "exchange string, symbol string, seq long, time timestamp, bid_price double, ask_price double, "
             "bid_qty double, ask_qty double")


def grid_df(spark, values, freq=1, symbol="AAA", ask=None):
    """A dense grid (g = i*freq seconds from T0) with bid = values."""
    base = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    rows = [("SIM", symbol, base + i * freq, ts(i * freq), float(v), float(ask[i] if ask else v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "exchange string, symbol string, g long, time timestamp, bid_price double, "
                                       "ask_price double")
