"""Declared schemas of the data model (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ("exchange", "symbol")

PRICE_COLUMNS = ("bid_price", "ask_price")
QTY_COLUMNS = ("bid_qty", "ask_qty")
QUOTE_COLUMNS = PRICE_COLUMNS + QTY_COLUMNS

# Metric fields of one instrument export, in export order.
METRIC_FIELDS = (
    "seq",
    "bid_price",
    "ask_price",
    "bid_qty",
    "ask_qty",
    "exchange_timestamp",
    "marketdata_timestamp",
    "status",
)

QUOTES = T.StructType(
    [
        T.StructField("time", T.TimestampType(), True),
        T.StructField("seq", T.LongType(), True),
        T.StructField("bid_price", T.DoubleType(), True),
        T.StructField("ask_price", T.DoubleType(), True),
        T.StructField("bid_qty", T.DoubleType(), True),
        T.StructField("ask_qty", T.DoubleType(), True),
    ]
)

# Landed quotes: quotes plus hive partition columns.
QUOTES_LANDED = T.StructType(
    QUOTES.fields
    + [
        T.StructField("exchange", T.StringType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("date", T.StringType(), True),
    ]
)

METRIC_EXPORT = T.StructType(
    [
        T.StructField("metric", T.StringType(), True),
        T.StructField("timestamps", T.ArrayType(T.LongType()), True),
        T.StructField("values", T.ArrayType(T.DoubleType()), True),
    ]
)

FEATURES_LONG = T.StructType(
    [
        T.StructField("time", T.TimestampType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("exchange", T.StringType(), True),
        T.StructField("symbol", T.StringType(), True),
        T.StructField("feature", T.StringType(), True),
        T.StructField("date", T.StringType(), True),
    ]
)

PATTERN_SCORES = T.StructType(
    [
        T.StructField("pattern", T.StringType(), True),
        T.StructField("score", T.DoubleType(), True),
        T.StructField("count", T.LongType(), True),
    ]
)

BACKTEST_TRADES = T.StructType(
    [
        T.StructField("start_date", T.StringType(), True),
        T.StructField("end_date", T.StringType(), True),
        T.StructField("cum_profit", T.DoubleType(), True),
        T.StructField("symbol.SELL", T.StringType(), True),
        T.StructField("sharp_ratio", T.DoubleType(), True),
        T.StructField("source_name.SELL", T.StringType(), True),
    ]
)

# A model's key in the registry, its meta document as ``publish_model`` writes it, and its registry row.
MODEL_KEY = ("exchange", "symbol", "target", "type", "run_id")


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()

MODEL_META = _fields(
    features=T.ArrayType(_S), target=_S, estimator=_S, end_date=_S, weights=T.MapType(_S, _D), intercept=_D,
    scaler=T.ArrayType(_fields(feature=_S, low=_D, high=_D)),
    parts=T.ArrayType(_fields(split=_S, start_date=_S, end_date=_S, size=_L)),
    report=T.ArrayType(_fields(label=_S, precision=_D, recall=_D, f1_score=_D, support=_L)),
    confusion=T.ArrayType(_fields(actual=T.IntegerType(), predicted=T.IntegerType(), count=_L)),
)

MODEL_ROW = _fields(path=_S, end_date=_S, meta=_S, **{k: _S for k in MODEL_KEY})

RUN_CONTEXT = T.StructType(
    [T.StructField("run_id", T.StringType(), False), T.StructField("context", T.StringType(), True)]
)
