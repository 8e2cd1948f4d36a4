"""Replay and stream plumbing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import KEYS, QUOTES_LANDED


def replay(feeds: Sequence[DataFrame]) -> DataFrame:
    """R4 (batch): union of feeds (missing columns NULL) in (time, instrument) order."""
    out = feeds[0]
    for f in feeds[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.orderBy("time", *KEYS)


def replay_stream(spark: SparkSession, root: str, callback: Callable[[DataFrame, int], None],
                  checkpoint: str, max_files_per_trigger: int | None = None, available_now: bool = True):
    """R4 (stream): landed quote files as a file-source stream, one callback per micro-batch.

    ``checkpoint`` must be on shared storage; the stream resumes from it
    after a failure (exactly-once file tracking).
    """
    r = spark.readStream.schema(QUOTES_LANDED).option("basePath", root)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    w = r.parquet(root).writeStream.foreachBatch(callback).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def with_watermark(df: DataFrame, delay: str = "1 minute", time_col: str = "time") -> DataFrame:
    """Event-time watermark; state older than the delay is dropped."""
    return df.withWatermark(time_col, delay)


def streaming_candles(df: DataFrame, freq: int = 300, delay: str = "1 minute", column: str = "bid_price") -> DataFrame:
    """Watermarked tumbling candles (G3 on a stream, append mode emits closed candles)."""
    from tidemark.operators.grid import stream_candles

    return stream_candles(with_watermark(df, delay), freq, column)


def streaming_dedupe(df: DataFrame, delay: str = "1 minute") -> DataFrame:
    """D1 on a stream — repeated (instrument, seq) within the watermark delay are dropped."""
    return with_watermark(df, delay).dropDuplicatesWithinWatermark([*KEYS, "seq"])


def event_time_range(df: DataFrame) -> DataFrame:
    """Smallest and largest event time of a batch (for logs and checks)."""
    return df.agg(F.min("time").alias("first"), F.max("time").alias("last"))
