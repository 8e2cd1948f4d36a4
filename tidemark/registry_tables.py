"""Queries over landed tables, selections, joins and small reports, each next to its DuckDB twin.

Same form as ``registry``: name -> (spark, sf_dir) -> DataFrame, run over whole tables. ``SQL`` holds the twins, written
as the plain formulation that the Spark plans must agree with.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import align as J
from tidemark.operators import grid as G
from tidemark.operators import quality as Q
from tidemark.operators import reports as R
from tidemark.operators import rolling as W
from tidemark.operators.ml import prep as MP
from tidemark.operators.ml import select as MS
from tidemark.plans.frames import M, compute_frames
from tidemark.registry import DAY, P, _landed_ticks, _lineitem_ds, _q, _qus, _signals, _stream_dir, round6
from tidemark.schema import KEYS, QUOTE_COLUMNS
from tidemark.sinks import writers as K
from tidemark.sources import metrics as S6
from tidemark.sources import scans as S
from tidemark.sources.adapters import LINEITEM_FEATURES, backtest_trades_from_orders, table

#: Parameters that queries and twins share.
T = {
    "after": "2024-01-12 06:00:00",
    "rows_window": 5,
    "pct_low": 0.05,
    "pct_high": 0.9,
    "regex": ("^l_.*price$", "key$"),
    "thin": 3,
    "start": "1995-01-01",
    "end": "1995-12-31",
    "coins": ("1-URGENT", "3-MEDIUM"),
    "top": 2,
    "purge": ("20240103", "20240105", "19990101"),
    "step": 7200,
}


def _hours(spark, sf):
    """Quotes of every instrument at whole hours (the last of an hour), hours without quotes left out: feeds to align."""
    return G.bucket_last(_q(spark, sf), 3600, ("bid_price",)).select(
        *KEYS, F.timestamp_seconds("g").alias("time"), F.col("symbol").alias("feed"), F.col("bid_price").alias("value"))


def _feeds(spark, sf) -> list[str]:
    return sorted(r[0] for r in table(spark, sf, "events").select("event_type").distinct().collect())


# --- grids and coverage -----------------------------------------------------------------------------

def q_align_asof_next(spark, sf):
    """Feeds outer-aligned on their times, then G2 over the aligned rows (complete ones stay)."""
    feeds = _feeds(spark, sf)
    return round6(G.align_asof_next(_hours(spark, sf), feeds, T["step"]).select("g", *feeds))


def q_coverage_wide(spark, sf):
    """D4 wide: a row a day, a column an instrument."""
    return Q.coverage_map(_q(spark, sf), instruments=[f"SIM_{f}" for f in _feeds(spark, sf)])


def _thinned(spark, sf):
    """Quotes with holes: every instrument misses the days whose number and name length fall together."""
    q = _q(spark, sf)
    return q.where((F.dayofmonth("time") + F.length("symbol")) % T["thin"] != 0)


def q_missing_days(spark, sf):
    """D5 on quotes with holes."""
    return Q.missing_partitions(_thinned(spark, sf))


def q_coverage_holes(spark, sf):
    """D4 wide on quotes with holes: NULL where an instrument has no quote that day."""
    return Q.coverage_map(_thinned(spark, sf), instruments=[f"SIM_{f}" for f in _feeds(spark, sf)])


# --- columns and rows -------------------------------------------------------------------------------

def q_select_regex(spark, sf):
    return Q.select_regex(table(spark, sf, "lineitem"), T["regex"])


def q_concat_xy(spark, sf):
    """Columns split by name into X and y, each aggregated on its own, joined again on their keys."""
    d = _lineitem_ds(spark, sf).withColumnRenamed("label", "profit")
    x, y = Q.split_xy(d.drop("l_orderkey", "l_linenumber"))
    left = d.groupBy("l_orderkey").agg(*[F.max(c).alias(c) for c in x])
    right = d.groupBy("l_orderkey").agg(*[F.sum(c).alias(c) for c in y])
    return round6(J.concat_xy(left, right, ["l_orderkey"]))


def _holey(spark, sf):
    """Quotes whose bid quantity is null where its last digit is 0."""
    q = _q(spark, sf)
    return q.withColumn("bid_qty", F.when(F.col("bid_qty") % 10 != 0, F.col("bid_qty")))


def q_fill_qty(spark, sf):
    return round6(_qus(Q.fill_qty(_holey(spark, sf))))


def q_after_end(spark, sf):
    return round6(_qus(Q.after(_q(spark, sf), T["after"])))


def q_to_float32(spark, sf):
    d = Q.to_float32(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES))
    return d.select(*[F.col(c).cast("double").alias(c) for c in LINEITEM_FEATURES], "l_orderkey", "l_linenumber")


def q_dropped_rows(spark, sf):
    """Rows that a drop of incomplete rows would remove."""
    return Q.dropped_rows(_holey(spark, sf), ["bid_price", "bid_qty"])


def q_latest_ticks(spark, sf):
    """The last quotes in time order, as a preview takes them."""
    d = _q(spark, sf).select(*KEYS, "seq", "time").orderBy(F.col("time").desc(), F.col("seq").desc())
    return spark.createDataFrame(Q.preview(_qus(d), 25), _qus(d).schema)


def q_select_columns(spark, sf):
    """Features with a score above zero that chi-squared and class means both find, and only those columns."""
    feats = list(LINEITEM_FEATURES)
    scaled, _ = MP.minmax_scale(_lineitem_ds(spark, sf), feats)
    scores = MS.chi2_scores(scaled, feats, "label")
    known = [r["feature"] for r in MS.drop_zero_importance(scores.withColumnRenamed("score", "importance")).collect()]
    top = [r["feature"] for r in MS.k_best(scores, T["top"]).collect()]
    taken = sorted(MS.intersect_features(known, top))
    wide = MP.select_columns(scaled, taken, ["l_orderkey", "l_linenumber", "label"])
    return round6(wide.unpivot(["l_orderkey", "l_linenumber", "label"], taken, "feature", "value"))


def q_top_features(spark, sf):
    """O2: the best features by chi-squared score."""
    scaled, _ = MP.minmax_scale(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES))
    return round6(MS.k_best(MS.chi2_scores(scaled, list(LINEITEM_FEATURES), "label"), T["top"]))


def q_apply_features(spark, sf):
    """Named features of a gridded frame, rows with a missing one dropped."""
    MP.register_feature("spread", lambda df: F.col("ask_price") - F.col("bid_price"))
    MP.register_feature("imbalance", lambda df: F.try_divide(F.col("bid_qty") - F.col("ask_qty"), F.col("bid_qty") + F.col("ask_qty")))
    MP.register_feature("long_bid", lambda df: F.when(F.col("bid_qty") > 50, F.col("bid_price")))
    g = G.resample_last(_q(spark, sf), P["freq"], QUOTE_COLUMNS)
    return round6(MP.apply_features(g, ["spread", "imbalance", "long_bid"]).select(*KEYS, "g", "spread", "imbalance", "long_bid"))


# --- windows ----------------------------------------------------------------------------------------

def q_rolling_rows(spark, sf):
    """Windows of so many grid rows."""
    g = G.resample_last(_q(spark, sf), P["freq"], ("bid_price",))
    window = T["rows_window"] * P["freq"]
    d = compute_frames(g, KEYS, P["freq"], {"mean": M("bid_price", "mean", window), "n": M("bid_price", "count", window)})
    return round6(d.select(*KEYS, "g", "mean", F.col("n").cast("long").alias("n")))


def q_diff(spark, sf):
    """Differences of neighbouring grid rows."""
    g = G.resample_last(_q(spark, sf), P["freq"], ("bid_price",))
    d = W.framed(g, {"diff": W.diff("bid_price")}, lookback=P["freq"], freq=P["freq"])
    return round6(d.where("diff is not null").select(*KEYS, "g", "diff"))


def q_remove_outliers_pct(spark, sf):
    """Rows strictly between two percentiles of their instrument and day."""
    q = _q(spark, sf).withColumn("day", F.date_format("time", "yyyyMMdd"))
    return W.remove_outliers_pct(q, [*KEYS, "day"], "bid_price", T["pct_low"], T["pct_high"]).select(*KEYS, "seq", "day")


# --- joins and unions -------------------------------------------------------------------------------

def q_union_feeds(spark, sf):
    """Feeds with different columns, one below the other."""
    q = _qus(_q(spark, sf))
    feeds = [q.where("symbol = 'click'").drop("bid_qty"), q.where("symbol = 'view'").drop("ask_price", "ask_qty"), q.where("symbol = 'error'")]
    d = J.union_feeds([f.select(*[c for c in (*KEYS, "seq", "time_us", *QUOTE_COLUMNS) if c in f.columns]) for f in feeds])
    return round6(d)


def q_outer_predictions(spark, sf):
    """The labels of some documents against predictions for others."""
    labels = table(spark, sf, "labels")
    actual = labels.where("doc_id % 3 <> 0").groupBy("doc_id").agg(F.max("quality").cast("double").alias("actual"))
    said = labels.where("doc_id % 2 = 0").groupBy("doc_id").agg((1 - F.max("toxic")).cast("double").alias("predicted"))
    return J.outer_predictions(actual, said, ["doc_id"])


def q_missing_keys(spark, sf):
    """Customers without an order in a year."""
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").where(F.to_date("o_orderdate").between(T["start"], T["end"]))
    return J.missing_keys(c.withColumnRenamed("c_custkey", "custkey"), o.withColumnRenamed("o_custkey", "custkey"), ["custkey"])


# --- reports ----------------------------------------------------------------------------------------

def q_event_listing(spark, sf):
    """Dated events of a year for some names and tags, most viewed first, a page of them."""
    o = table(spark, sf, "orders")
    events = o.groupBy(F.to_date("o_orderdate").alias("date_start"), F.col("o_orderpriority").alias("coin"), F.col("o_orderstatus").alias("tag")).agg(
        F.count(F.lit(1)).alias("views"))
    page = R.event_listing(events, T["start"], T["end"], T["coins"], ["F"])
    return page.select(F.date_format("date_start", "yyyy-MM-dd").alias("date_start"), "coin", "tag", "views")


def q_learning_summary(spark, sf):
    """A4: reports of the labels by source, with the roll-up of the orders as their backtests."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    pred = labels.join(docs.select("doc_id", "source"), "doc_id").select(
        F.concat(F.lit("s"), F.right("source", F.lit(1)).try_cast("int") % 5).alias("instrument"), F.lit("rule").alias("estimator"),
        F.col("quality").cast("int").alias("actual"), (1 - F.col("toxic")).cast("int").alias("predicted"))
    reports = R.classification_report(pred, by=["instrument", "estimator"])
    trades = backtest_trades_from_orders(table(spark, sf, "orders")).withColumn(
        "source", F.concat(F.lit("s"), F.substring("source", 1, 1).cast("int") % 5)).drop("signal")
    roll = R.backtest_rollup(trades, "source", "seq").withColumnRenamed("source", "instrument").drop("uuid", "first_date", "last_date", "start_date")
    return round6(R.learning_summary(reports, roll))


# --- landed tables ----------------------------------------------------------------------------------

def q_scan_directory(spark, sf):
    """A whole landed directory."""
    return S.scan_directory(spark, _landed_ticks(spark, sf)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows"))


def q_sql_table(spark, sf):
    """A report by name from the catalogue."""
    _signals(spark, sf).createOrReplaceTempView("tidemark_signals")
    return round6(S.read_sql_table(spark, "tidemark_signals"))


def q_csv_round_trip(spark, sf):
    """A dataset written as CSV with its meta document, read with a declared schema."""
    d = _lineitem_ds(spark, sf)
    path = _stream_dir(spark, "csv")
    K.write_dataset_csv(d, path, {"target": "label"})
    return round6(S.read_csv(spark, f"{path}/data", d.schema))


def q_model_listing(spark, sf):
    """Models published (one of them twice), listed by wildcard with their meta documents."""
    from tidemark.plans import models as LC

    root = _stream_dir(spark, "models")
    symbols = [r[0] for r in table(spark, sf, "events").select("event_type").distinct().orderBy("event_type").collect()]
    for symbol in [*symbols, symbols[0]]:
        LC.publish_model(spark, root, {"exchange": "SIM", "symbol": symbol, "target": "label", "type": LC.LINEAR_RULE, "run_id": "r1"},
                         {"features": ["bid_price"], "target": "label", "weights": {"bid_price": float(len(symbol))}})
    listed = S.list_models(LC.read_registry(spark, root), symbol="*i*", type_="Linear*")
    meta = S.read_meta(spark, f"{root}/models/*/*/*/*/*/meta").select(F.element_at("weights", "bid_price").alias("weight"))
    counts = meta.groupBy("weight").agg(F.count(F.lit(1)).alias("models_of_weight"))
    weight = F.get_json_object("meta", "$.weights.bid_price").cast("double")
    return listed.select("exchange", "symbol", "type", weight.alias("weight")).join(counts, "weight")


def q_buy_patterns(spark, sf):
    """Stored pattern scores, best and most frequent first, and the buy set read back from them."""
    rows = _signals(spark, sf).select(F.lit("SIM").alias("exchange"), F.col("instrument_id").alias("symbol"),
                                      F.hex(F.col("o_orderkey") % 16).alias("pattern"), (F.col("sharp_ratio") > 50_000).cast("int").alias("profit"))
    scores = rows.groupBy("exchange", "symbol", "pattern").agg(F.max("profit").cast("double").alias("score"), F.count(F.lit(1)).alias("count"))
    path = _stream_dir(spark, "scores")
    scores.orderBy(F.col("score").desc(), F.col("count").desc(), "pattern").write.parquet(path)
    return S.load_buy_patterns(spark, path)


def q_report_table(spark, sf):
    """Report rows appended in two runs, the latest of each instrument."""
    path = _stream_dir(spark, "reports")
    d = R.last_report(_signals(spark, sf), tiebreak="o_orderkey").drop("created_at")
    K.append_report(d, path, 100)
    K.append_report(d.withColumn("sharp_ratio", F.col("sharp_ratio") + 1), path, 200)
    return round6(R.last_report(spark.read.parquet(path)))


def q_run_context(spark, sf):
    """K5: run contexts inserted twice; a run that is stored already isn't stored again."""
    o = table(spark, sf, "orders")
    path = _stream_dir(spark, "context")
    rows = o.select(F.concat_ws("-", "o_orderpriority", "o_orderstatus").alias("run_id"), F.lit("{}").alias("context"))
    K.insert_run_context(spark, rows.where("o_orderstatus = 'O'"), path)
    K.insert_run_context(spark, rows, path)
    return spark.read.parquet(path).groupBy("run_id").agg(F.count(F.lit(1)).alias("rows"))


def q_signal_tables(spark, sf):
    """Backtests ranked within their signal, one table a signal, read back."""
    roll = R.backtest_rollup(backtest_trades_from_orders(table(spark, sf, "orders")), "source", "seq")
    path = _stream_dir(spark, "signals")
    K.write_signal_tables(R.rank_within(roll.drop("uuid"), "signal", "sharp_ratio"), path)
    return round6(spark.read.parquet(path).select("signal", "source", "rank", "sharp_ratio", "number_of_trades"))


def q_predictions_landed(spark, sf):
    """Predictions of a fixed rule, written and read back."""
    from tidemark.operators.ml.train import linear_rule

    path = _stream_dir(spark, "predictions")
    K.write_predictions(linear_rule(_qus(_q(spark, sf)), P["rule_weights"], P["rule_intercept"]), path, [*KEYS, "seq"])
    return spark.read.parquet(path)


def q_backup(spark, sf):
    """A metric export in JSON lines, backed up as landed ticks and scanned."""
    from tidemark.plans.jobs import job_backup

    fields = ("seq", *QUOTE_COLUMNS)
    path, root = _stream_dir(spark, "export"), _stream_dir(spark, "backup")
    S6.ticks_to_metrics(_q(spark, sf), fields, chunk_seconds=DAY).write.json(path)
    job_backup(spark, path, root)
    ticks = S.scan_quotes(spark, root)
    return round6(_qus(ticks.drop("date")).withColumn("seq", F.col("seq").cast("long")))


def q_purge(spark, sf):
    """The days of an instrument dropped from a landed table; what is left, by day."""
    root = _landed_ticks(spark, sf)
    dry = K.purge_partitions(spark, root, "SIM", "view", T["purge"])
    gone = K.purge_partitions(spark, root, "SIM", "view", T["purge"], confirm=True)
    left = S._read(spark, root).where("symbol = 'view'").groupBy("date").agg(F.count(F.lit(1)).alias("rows"))
    return left.withColumn("found", F.lit(len(dry))).withColumn("gone", F.lit(len(gone)))


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
