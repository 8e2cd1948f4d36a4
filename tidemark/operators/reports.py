"""Aggregations and reports (A1-A12) and the split operators.

Classification reports reduce the prediction table to its confusion
counts first (one grouped aggregate, a handful of rows), then derive every
metric from those counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import anchored, as_ts, epoch_seconds, safe_div
from tidemark.session import materialize
from tidemark.plans.chunking import chunk_of


def _z(c: Column) -> Column:
    """sklearn's zero_division=0."""
    return F.coalesce(c, F.lit(0.0))


# --- A1-A3 ----------------------------------------------------------------------------------

def confusion_margins(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """A1: crosstab with margins, long form: actual, predicted ('All' for margins), count."""
    c = pred.cube(actual, predicted).agg(
        F.count(F.lit(1)).alias("count"), F.grouping(actual).alias("_ga"), F.grouping(predicted).alias("_gp"))
    return c.select(
        F.when(F.col("_ga") == 1, F.lit("All")).otherwise(F.col(actual).cast("string")).alias(actual),
        F.when(F.col("_gp") == 1, F.lit("All")).otherwise(F.col(predicted).cast("string")).alias(predicted),
        F.col("count"),
    )


def confusion_counts(pred: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = None,
                     by: Sequence[str] = ()) -> DataFrame:
    """Per class (and ``by``): tp, fp, fn, support and n, from one grouped count of (actual, predicted).

    Each confusion cell credits at most two classes (its actual and its
    predicted class), so the per-class sums need no join. ``weight``: a column that counts the rows.
    """
    by = list(by)
    cm = pred.groupBy(*by, actual, predicted).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("k"))
    k = F.col("k")
    same = F.col(actual) == F.col(predicted)
    zero = F.lit(0).cast("long")
    rows = F.array(
        F.struct(F.col(actual).alias("label"), F.when(same, k).otherwise(zero).alias("tp"), zero.alias("fp"),
                 F.when(same, zero).otherwise(k).alias("fn"), k.alias("support")),
        F.struct(F.col(predicted).alias("label"), zero.alias("tp"), F.when(same, zero).otherwise(k).alias("fp"),
                 zero.alias("fn"), zero.alias("support")),
    )
    per = cm.select(*by, F.explode(rows).alias("r")).select(*by, "r.*").groupBy(*by, "label").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "support")])
    return per.withColumn("n", F.sum("support").over(Window.partitionBy(*by)))


def classification_report(pred: DataFrame, actual: str = "actual", predicted: str = "predicted", weight: str | None = None,
                          by: Sequence[str] = ()) -> DataFrame:
    """A2: precision/recall/f1/support per class, then accuracy, macro avg, weighted avg (all per ``by``).

    Output: label STRING, precision, recall, f1_score, support (accuracy row:
    precision/recall NULL, f1_score = accuracy).
    """
    by = list(by)
    cc = confusion_counts(pred, actual, predicted, weight, by)
    per = cc.select(
        *by, F.col("label").cast("string").alias("label"),
        _z(safe_div(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))).alias("precision"),
        _z(safe_div(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))).alias("recall"),
        F.col("support").cast("long").alias("support"), F.col("tp"), F.col("n"),
    ).withColumn("f1_score", _z(safe_div(2 * F.col("precision") * F.col("recall"),
                                         F.col("precision") + F.col("recall"))))
    tot = per.groupBy(*by).agg(
        F.sum("tp").alias("tp"), F.max("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"), F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"),
    )
    n = F.col("n").cast("double")
    acc = tot.select(*by, F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("tp") / n).alias("f1_score"),
                     F.col("n").cast("long").alias("support"))
    macro = tot.select(*by, F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                       F.col("mr").alias("recall"), F.col("mf").alias("f1_score"), F.col("n").cast("long").alias("support"))
    weighted = tot.select(*by, F.lit("weighted avg").alias("label"), (F.col("wp") / n).alias("precision"),
                          (F.col("wr") / n).alias("recall"), (F.col("wf") / n).alias("f1_score"),
                          F.col("n").cast("long").alias("support"))
    cols = [*by, "label", "precision", "recall", "f1_score", "support"]
    return per.select(*cols).unionByName(acc).unionByName(macro).unionByName(weighted)


def imbalanced_report(pred: DataFrame, actual: str = "actual", predicted: str = "predicted",
                      alpha: float = 0.1) -> DataFrame:
    """A3: pre, rec, spe, f1, geo = sqrt(rec*spe), iba = (1 + alpha*(rec - spe))*geo^2, sup;
    plus an 'avg / total' row (support-weighted means, total support)."""
    cc = confusion_counts(pred, actual, predicted)
    tn = F.col("n") - F.col("tp") - F.col("fp") - F.col("fn")
    per = cc.select(
        F.col("label").cast("string").alias("label"),
        _z(safe_div(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))).alias("pre"),
        _z(safe_div(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))).alias("rec"),
        _z(safe_div(tn.cast("double"), (tn + F.col("fp")).cast("double"))).alias("spe"),
        F.col("support").cast("long").alias("sup"),
    )
    per = per.withColumn("f1", _z(safe_div(2 * F.col("pre") * F.col("rec"), F.col("pre") + F.col("rec"))))
    per = per.withColumn("geo", F.sqrt(F.col("rec") * F.col("spe")))
    per = per.withColumn("iba", (F.lit(1.0) + F.lit(float(alpha)) * (F.col("rec") - F.col("spe")))
                         * F.col("rec") * F.col("spe"))
    metrics = ["pre", "rec", "spe", "f1", "geo", "iba"]
    tot = per.agg(*[(F.sum(F.col(m) * F.col("sup")) / F.sum("sup")).alias(m) for m in metrics],
                  F.sum("sup").alias("sup"))
    tot = tot.select(F.lit("avg / total").alias("label"), *metrics, F.col("sup").cast("long").alias("sup"))
    return per.select("label", *metrics, "sup").unionByName(tot)


# --- A5-A12 ---------------------------------------------------------------------------------

def backtest_rollup(trades: DataFrame, source: str = "source", order: str = "seq") -> DataFrame:
    """A5: per backtest file: its last row, number_of_trades, first/last dates, a fresh uuid."""
    cols = [c for c in trades.columns if c not in (source, order)]
    return trades.groupBy(source).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), F.col(order)).alias("_last"),
        F.count(F.lit(1)).alias("number_of_trades"),
        F.min("start_date").alias("first_date"),
        F.max("end_date").alias("last_date"),
    ).select(source, "_last.*", "number_of_trades", "first_date", "last_date", F.expr("uuid()").alias("uuid"))


def rank_within(df: DataFrame, group: str, by: str, out: str = "rank") -> DataFrame:
    """1-based rank by ``by`` descending within ``group`` (ties broken by every other column, nulls last).

    Ranges of the whole order are cut over all groups together (a range
    partitioning), so a group that holds most rows is many ranges: a row's rank is
    its place in its range plus the group's rows in the ranges before.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    others = [F.col(f"`{c}`") for c in df.columns if c not in (group, by)]
    order = [F.col(f"`{by}`").desc(), *others]
    d = materialize(df.repartitionByRange(F.col(f"`{group}`"), *order).withColumn("_ck", F.spark_partition_id()))
    cnt = d.groupBy(F.col(f"`{group}`"), "_ck").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(F.col(f"`{group}`")).orderBy("_ck").rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.select(F.col(f"`{group}`").alias("_g"), F.col("_ck").alias("_k"), F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"))
    d = d.join(cnt, F.col(f"`{group}`").eqNullSafe(F.col("_g")) & (F.col("_ck") == F.col("_k")))
    w = Window.partitionBy(F.col(f"`{group}`"), "_ck").orderBy(*order)
    return d.withColumn(out, (F.col("_before") + F.row_number().over(w)).cast("int")).select(*columns, out)


def last_report(report: DataFrame, instrument: str = "instrument_id", created: str = "created_at",
                tiebreak: str | None = None) -> DataFrame:
    """Latest row per instrument by created_at (no sort: a grouped max_by)."""
    cols = [c for c in report.columns if c != instrument]
    order = F.struct(F.col(created), F.col(tiebreak)) if tiebreak else F.col(created)
    return report.groupBy(instrument).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r")).select(
        instrument, "_r.*")


def last_sharpe_ttl(report: DataFrame, now_epoch: int, ttl_seconds: int, instrument: str = "instrument_id",
                    created: str = "created_at", value: str = "sharp_ratio",
                    tiebreak: str | None = None) -> DataFrame:
    """Latest value per instrument among rows with now - ttl < created_at (strict), else NULL."""
    fresh = F.col(created) > F.lit(int(now_epoch) - int(ttl_seconds))
    order = F.struct(F.col(created), F.col(tiebreak)) if tiebreak else F.col(created)
    return report.groupBy(instrument).agg(F.max_by(F.col(value), F.when(fresh, order)).alias(value))


def top_volume(volumes: DataFrame, minimum: float) -> DataFrame:
    """Volume > minimum, with instrument = UPPER(exchange)_symbol."""
    return volumes.where(F.col("volume") > F.lit(float(minimum))).select(
        "exchange", "symbol", "volume", F.concat_ws("_", F.upper("exchange"), F.col("symbol")).alias("instrument"))


def pair_filter(volumes: DataFrame, pattern: str, n: int) -> DataFrame:
    """The first ``n`` pairs in page order (position) whose id matches an anchored regex; '/' -> '_'."""
    pid = F.regexp_replace(F.col("symbol"), "/", "_")
    return (volumes.select(pid.alias("pair"), "position").where(F.col("pair").rlike(anchored(pattern)))
            .orderBy("position").limit(int(n)))


def event_listing(events: DataFrame, start: str, end: str, coins: Sequence[str] | None = None,
                  tags: Sequence[str] | None = None, page_size: int = 30) -> DataFrame:
    """Events in [start, end], optional coin/tag filters, most viewed first, one page."""
    d = events.where((F.col("date_start") >= F.lit(start).cast("date")) & (F.col("date_start") <= F.lit(end).cast("date")))
    if coins:
        d = d.where(F.col("coin").isin(list(coins)))
    if tags:
        d = d.where(F.col("tag").isin(list(tags)))
    return d.orderBy(F.col("views").desc(), "date_start", "coin").limit(int(page_size))


def split_summary(df: DataFrame, split_col: str = "split", time_col: str = "time") -> DataFrame:
    """Start, end, size for all rows and per split (rollup = one aggregate)."""
    r = df.rollup(split_col).agg(F.min(time_col).alias("start_date"), F.max(time_col).alias("end_date"),
                                 F.count(F.lit(1)).alias("size"), F.grouping(split_col).alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col(split_col)).alias(split_col),
                    "start_date", "end_date", "size")


# --- E1 / E2 splits (H4: exact without a global window) -------------------------------------

def _rank_from_end(df: DataFrame, keys: Sequence[str], order: Column, chunk: Column) -> DataFrame:
    """Adds ``_rank`` = 1 for the last row by ``order`` per key, and ``_n`` = rows per key.

    Two-level: row counts per (key, chunk) (small) give how many rows lie in
    later chunks; a row_number inside each chunk finishes the rank. Chunks
    must be monotone in ``order``.
    """
    keys = list(keys)
    d = df.withColumn("_ck", chunk).withColumn("_o", order)
    cnt = d.groupBy(*keys, "_ck").agg(F.count(F.lit(1)).alias("_c"))
    pk = Window.partitionBy(*keys) if keys else Window.partitionBy()
    later = pk.orderBy(F.col("_ck").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.select(*keys, "_ck", F.coalesce(F.sum("_c").over(later), F.lit(0)).alias("_after"),
                     F.sum("_c").over(pk).alias("_n"))
    d = d.join(cnt, on=[*keys, "_ck"], how="inner")
    w = Window.partitionBy(*keys, "_ck").orderBy(F.col("_o").desc())
    return d.withColumn("_rank", F.col("_after") + F.row_number().over(w)).drop("_ck", "_o", "_after")


def chrono_split(df: DataFrame, test_size: float = 0.3, keys: Sequence[str] = (), time_col: str = "time",
                 tiebreak: str | None = None, chunk_seconds: int = 86400) -> DataFrame:
    """Chronological split without shuffling: the last ceil(n*test_size) rows per key are 'test'.

    Adds ``split`` ('train' / 'test'). Exact, and no window spans a whole key.
    """
    order = F.struct(as_ts(time_col), F.col(tiebreak)) if tiebreak else as_ts(time_col)
    d = _rank_from_end(df, keys, order, chunk_of(epoch_seconds(time_col), chunk_seconds))
    n_test = F.ceil(F.col("_n") * F.lit(float(test_size)))
    return d.withColumn("split", F.when(F.col("_rank") <= n_test, "test").otherwise("train")).drop("_rank", "_n")


def shuffled_split(df: DataFrame, id_cols: Sequence[str], test_size: float = 0.25, seed: int = 42,
                   rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Seeded shuffled split with exact sizes: order rows by md5 of the ids and the seed.

    Reproducible for the same ids and seed, in any engine; the test set is the
    last ceil(n*test_size) rows of that order. Buckets (the leading hex digits,
    as many as the row count needs) play the role of the time chunks of ``chrono_split``.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols], F.lit(str(int(seed))))
    order = F.struct(F.md5(text.cast("binary")), *[F.col(c) for c in id_cols])
    digits = 1
    n = df.count()
    while 16 ** digits * rows_per_bucket < n or 16 ** digits < 256:
        digits += 1
    bucket = F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")
    d = _rank_from_end(df, (), order, bucket)
    n_test = F.ceil(F.col("_n") * F.lit(float(test_size)))
    return d.withColumn("split", F.when(F.col("_rank") <= n_test, "test").otherwise("train")).drop("_rank", "_n")


def learning_summary(reports: DataFrame, backtests: DataFrame, keys: Sequence[str] = ("instrument", "estimator"),
                     instrument: str = "instrument") -> DataFrame:
    """A4: one row per instrument x estimator: class 0/1 metrics, the last backtest row, trade count.

    ``reports``: classification reports (A2) with ``keys`` columns; metrics are
    matched by class **name** ('0', '1'), not by row position. ``backtests``:
    rolled-up backtests (A5) with an ``instrument`` column; the latest by
    ``end_date`` is attached with a left join.
    """
    keys = list(keys)
    cls = reports.where(F.col("label").isin("0", "1"))
    wide = cls.groupBy(*keys).agg(*[
        F.first(F.when(F.col("label") == F.lit(lbl), F.col(m)), ignorenulls=True).alias(f"{m}_{lbl}")
        for lbl in ("0", "1") for m in ("precision", "recall", "f1_score", "support")])
    others = [c for c in backtests.columns if c != instrument]
    last = backtests.groupBy(instrument).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), F.col("end_date")).alias("_bt"))
    last = last.select(instrument, "_bt.*")
    return wide.join(last, on=instrument, how="left")
