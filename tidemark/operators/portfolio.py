"""Portfolio analytics (F1-F4) over gridded quotes."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import instrument_id, safe_div
from tidemark.operators.rolling import framed, lag_rows
from tidemark.schema import KEYS


def fee_returns(grid: DataFrame, window: int = 14400, freq: int = 1, keys: Sequence[str] = KEYS) -> DataFrame:
    """fee = (ask[-W] - bid[-W]) + (ask - bid); ret = (bid[-W] - ask - fee) / ask.

    ``[-W]`` is ``W`` grid rows earlier. Sign and direction as in the
    original. Output: ``*keys, instrument, g, ret`` (NULL for the first W rows).
    """
    keys = list(keys)
    w = int(window)
    win = {
        "_bid_w": lag_rows("bid_price", w, keys),
        "_ask_w": lag_rows("ask_price", w, keys),
    }
    fee = (F.col("_ask_w") - F.col("_bid_w")) + (F.col("ask_price") - F.col("bid_price"))
    post = {"ret": safe_div(F.col("_bid_w") - F.col("ask_price") - fee, F.col("ask_price"))}
    d = framed(grid.select(*keys, "g", "bid_price", "ask_price"), win, post, lookback=w * int(freq), freq=freq)
    return d.select(*keys, instrument_id(*keys).alias("instrument"), "g", "ret")


def merge_returns(returns: DataFrame, instruments: Sequence[str]) -> DataFrame:
    """Wide returns (one column per instrument), only times where all are present.

    One conditional aggregate per instrument over ``groupBy(g)`` (a single
    shuffle on ``g``; Spark's ``pivot`` would aggregate twice), then dropna.
    """
    wide = returns.groupBy("g").agg(*[
        F.first(F.when(F.col("instrument") == F.lit(i), F.col("ret")), ignorenulls=True).alias(i)
        for i in instruments])
    return wide.na.drop(how="any", subset=list(instruments))


def _matrices(batches: Iterator[pa.RecordBatch], n: int) -> np.ndarray:
    """The rows of a partition as a matrix, one column per instrument."""
    parts = [np.column_stack([b.column(j).to_numpy(zero_copy_only=False) for j in range(n)]) for b in batches if b.num_rows]
    return np.concatenate(parts) if parts else np.zeros((0, n))


def correlation(merged: DataFrame, instruments: Sequence[str]) -> DataFrame:
    """Pearson correlation matrix in long form (a, b, corr).

    Every partition turns its rows into sums of products about its own means (one matrix
    product), n(n+1)/2 rows; those are added up by pair. The plan is the same for
    any number of instruments. The diagonal is 1; a constant instrument has no correlation (NULL).
    """
    inst = list(instruments)
    n = len(inst)
    names = F.array(*map(F.lit, inst))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = _matrices(batches, n)
        if not len(x):
            return
        s = x.sum(axis=0)
        d = x - s / len(x)
        c = d.T @ d
        i, j = np.triu_indices(n, 1)
        k = len(x)
        yield pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32), "n": np.full(len(i), float(k)), "x": s[i], "y": s[j],
                               "xy": c[i, j] + s[i] * s[j] / k, "xx": c[i, i] + s[i] ** 2 / k, "yy": c[j, j] + s[j] ** 2 / k})

    kinds = "i int, j int, n double, x double, y double, xy double, xx double, yy double"
    t = merged.select(*[F.col(f"`{c}`") for c in inst]).mapInArrow(products, kinds).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "x", "y", "xy", "xx", "yy")])
    cov = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    var = (F.col("xx") - F.col("x") * F.col("x") / F.col("n")) * (F.col("yy") - F.col("y") * F.col("y") / F.col("n"))
    pairs = t.select("i", "j", safe_div(cov, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("corr"))
    both = pairs.unionByName(pairs.select(F.col("j").alias("i"), F.col("i").alias("j"), "corr"))
    same = merged.sparkSession.range(n).select(F.col("id").cast("int").alias("i"), F.col("id").cast("int").alias("j"), F.lit(1.0).alias("corr"))
    return both.unionByName(same).select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), "corr")


def _orders(size: int) -> Column:
    return F.array(*[F.array(*map(F.lit, p)) for p in itertools.permutations(range(size))])


def portfolios(spark, instruments: Sequence[str], size: int = 3, distinct_sets: bool = False) -> DataFrame:
    """Every ordered k-permutation of the instrument list, built by a DataFrame (no driver list).

    Output: portfolio (names joined by '_'), members (sorted positions of the names).
    """
    n = len(instruments)
    d = spark.range(n).select(F.array(F.col("id").cast("int")).alias("members"))
    for _ in range(size - 1):
        last = F.element_at("members", -1)
        d = d.where(last < n - 1).withColumn("next", F.explode(F.sequence(last + 1, F.lit(n - 1)))).select(
            F.concat("members", F.array("next")).alias("members"))
    return _named(d, instruments, size, distinct_sets)


def _named(sets: DataFrame, instruments: Sequence[str], size: int, distinct_sets: bool) -> DataFrame:
    """Rows with ``members`` (ascending positions) -> one row per order of the members, with its name."""
    names = F.array(*map(F.lit, instruments))
    orders = F.array(F.array(*map(F.lit, range(size)))) if distinct_sets else _orders(size)
    d = sets.withColumn("_order", F.explode(orders))
    name = F.array_join(F.transform("_order", lambda o: F.get(names, F.get(F.col("members"), o))), "_")
    return d.select(name.alias("portfolio"), *sets.columns)


def portfolio_report(merged: DataFrame, instruments: Sequence[str], size: int = 3,
                     distinct_sets: bool = False) -> DataFrame:
    """for every ordered triple: summed returns -> sharpe = mean/std(ddof 1)*sqrt(n),
    total, pct_win = share(>= 0)*100.

    Every partition reduces its rows to one row per member set (count, sum, squared deviations,
    wins), sets taken some thousands at a time; those are added up by set, and the orders of a
    set share its numbers. Partitions are rebalanced to the advisory size first (64 MB by default), so there are as many
    sums of a set as the merged table has pieces of that size, however it was partitioned. Nothing is listed on the driver and the plan does not grow
    with the number of instruments.
    """
    inst = sorted(instruments)
    n = len(inst)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = _matrices(batches, n)
        if not len(x):
            return
        sets = itertools.combinations(range(n), size)
        step = max(1, 4_000_000 // len(x))                    # about 32 MB of summed returns at a time
        while chunk := list(itertools.islice(sets, step)):
            at = np.array(chunk, dtype=np.int32)
            r = x[:, at[:, 0]].copy()
            for k in range(1, size):
                r += x[:, at[:, k]]
            s, wins = r.sum(axis=0), (r >= 0).sum(axis=0)
            r -= s / len(x)
            yield pa.record_batch({
                "members": pa.FixedSizeListArray.from_arrays(pa.array(at.ravel()), size).cast(pa.list_(pa.int32())),
                "n": np.full(len(at), float(len(x))), "s": s, "q": (r * r).sum(axis=0) + s * s / len(x), "w": wins.astype(float)})

    rows = merged.select(*[F.col(f"`{c}`") for c in inst]).hint("rebalance")
    parts = rows.mapInArrow(reduce, "members array<int>, n double, s double, q double, w double")
    t = parts.groupBy("members").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q", "w")])
    std = F.sqrt(F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0)) / F.when(F.col("n") > 1, F.col("n") - 1))
    stats = t.select("members", (safe_div(F.col("s") / F.col("n"), std) * F.sqrt("n")).alias("sharpe_ratio"),
                     F.col("s").alias("total"), (F.col("w") / F.col("n") * F.lit(100.0)).alias("pct_win"))
    return _named(stats, inst, size, distinct_sets).drop("members")
