"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir, materialize

__all__ = ["bucket_of", "buckets_for", "checkpoint_dir", "labelled_texts", "landed", "materialize", "slices", "table", "text_bytes"]


#: Bounds on what a fit on the driver takes: bytes of a text, and of all texts.
TRAIN_TEXT_BYTES, TRAIN_BYTES = 256 << 10, 32 << 20


def labelled_texts(docs: DataFrame, known: DataFrame, label: str) -> list[Row]:
    """``doc_id, label, text`` of the documents in ``known`` (a bounded number of rows doc_id, label), for a fit on the driver.

    Of rows that repeat a doc_id the one whose text has the least hash is taken; texts longer than TRAIN_TEXT_BYTES aren't
    learned from; rows are taken by hash of the doc_id as long as they hold TRAIN_BYTES together. Null texts are empty.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.octet_length("text") <= TRAIN_TEXT_BYTES)
    rows = docs.join(F.broadcast(known), "doc_id").groupBy("doc_id", label).agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    # one task sees as many rows as ``known`` has
    taken = F.sum(F.octet_length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", label))
    return rows.withColumn("taken", taken).where(F.col("taken") <= TRAIN_BYTES).select("doc_id", label, "text").orderBy("doc_id", "text", label).collect()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """(rows, bytes of text) of the whole table: one scan, two numbers to the driver."""
    r = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def buckets_for(total: int, each: int) -> int:
    """Number of hash groups that hold about ``each`` units of ``total``."""
    return max(1, math.ceil(total / each))


def bucket_of(n: int, *cols: Column | str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    Cuts the lineage as ``checkpoint()`` does, but compressed and by column; lost executors cost a
    re-read. The folder is new for each call and stays until the cluster clears its checkpoints.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, columns: list[str], most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in row ranges of about ``most`` bytes of the given string columns (a row at least)."""
    size = np.zeros(batch.num_rows, np.int64)
    for c in columns:
        size += pc.binary_length(batch.column(c)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if j > i:
            yield batch.slice(i, j - i)
