"""Map the driver's test tables onto the data model (see FIXTURES.md §2).

These are plain projections: they keep the parquet scan prunable, so a
query that needs two columns reads two columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_ts, nan_to_null


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quotes_from_events(events: DataFrame) -> DataFrame:
    """``quotes`` with partition columns, from ``events``.

    exchange='SIM', symbol=event_type, seq=event_id, time=ts,
    bid=value, ask=value*1.001, bid_qty=props.$.k, ask_qty=100-bid_qty.
    """
    # try_cast: a malformed value becomes NULL instead of failing the job (ANSI mode)
    bid_qty = F.get_json_object("props", "$.k").try_cast("double")
    return events.select(
        F.lit("SIM").alias("exchange"),
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("seq"),
        as_ts("ts").alias("time"),
        nan_to_null("value").alias("bid_price"),
        nan_to_null(F.col("value") * F.lit(1.001)).alias("ask_price"),
        bid_qty.alias("bid_qty"),
        (F.lit(100.0) - bid_qty).alias("ask_qty"),
    )


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_from_events(table(spark, sf_dir, "events"))


def predictions_from_labels(labels: DataFrame) -> DataFrame:
    """actual = quality, predicted = 1 - toxic (a fixed rule, as a classifier stand-in)."""
    return labels.select(
        F.col("doc_id"),
        F.col("quality").cast("int").alias("actual"),
        (F.lit(1) - F.col("toxic")).cast("int").alias("predicted"),
    )


LINEITEM_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def dataset_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Wide dataset: 4 numeric features and a 0/1 label (returned items)."""
    return lineitem.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        *[nan_to_null(c).alias(c) for c in LINEITEM_FEATURES],
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
    )


def signal_report_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderpriority").alias("instrument_id"),
        F.unix_seconds(as_ts("o_orderdate")).alias("created_at"),
        F.col("o_totalprice").alias("sharp_ratio"),
        F.col("o_orderkey"),
    )


def volumes_from_supplier(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.lit("SIM").alias("exchange"),
        F.col("s_name").alias("symbol"),
        F.col("s_acctbal").alias("volume"),
        F.col("s_suppkey").alias("position"),
    )


def backtest_trades_from_orders(orders: DataFrame) -> DataFrame:
    """Backtest trade rows from ``orders`` (for A5/A6): one file per order priority,
    rows in order-key order, the order date as both trade dates, the total price as
    cumulative profit and as sharpe ratio."""
    day = F.date_format(as_ts("o_orderdate"), "yyyy-MM-dd")
    return orders.select(
        F.col("o_orderpriority").alias("source"),
        F.col("o_orderkey").alias("seq"),
        day.alias("start_date"),
        day.alias("end_date"),
        F.col("o_totalprice").alias("cum_profit"),
        F.col("o_totalprice").alias("sharp_ratio"),
        F.col("o_orderstatus").alias("signal"),
    )
