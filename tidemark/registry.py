"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the driver's test tables through the adapters and runs one
operator (or builder) over the whole tables. Names equal operator names.
Parameters: the events table is sparse (about 2,000 quotes per instrument
over 30 days at sf0.01), so grids use 3600 s steps; windows and shifts are
the reference defaults scaled to hours. Streaming queries land the events in
time order as several files under the checkpoint folder and run to completion
(``availableNow``), a micro-batch for each file, into Parquet there. Doubles are rounded (``rnd``) on both sides since
summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import grid as G
from tidemark.operators import patterns as T_
from tidemark.operators import portfolio as PF
from tidemark.operators import quality as Q
from tidemark.operators import reports as R
from tidemark.operators.ml import prep as MP
from tidemark.operators.ml import select as MS
from tidemark.operators.ml import train as MT
from tidemark.plans import datasets as B
from tidemark.plans import jobs as X_
from tidemark.plans.chunking import segmented_prev
from tidemark.schema import KEYS, MODEL_META, QUOTE_COLUMNS
from tidemark.session import landed
from tidemark.sources.adapters import (
    LINEITEM_FEATURES,
    dataset_from_lineitem,
    predictions_from_labels,
    quotes,
    signal_report_from_orders,
    table,
    volumes_from_supplier,
)

HOUR = 3600
# Decimal places both engines round doubles to before comparison.
ROUND_DIGITS = 8
DAY = 24 * HOUR

# Query parameters shared with the oracle SQL.
P = {
    "freq": HOUR,
    "window": DAY,          # 24 grid rows
    "long_window": 3 * DAY,  # 72 grid rows
    "shift": 6,
    "pct": 0.001,
    "cma_max": 36 * HOUR,
    "cma_min": 12 * HOUR,
    "cma_shift": 12,
    "mac_window": 36 * HOUR,
    "mac_candle": 5,
    "mac_shift": 12,
    "map_offsets": (1, 4, 8, 12, 16, 20, 24, 28, 31),
    "rc_step": 12,
    "rc_guard": 96,
    "all_fields_guard": 24,
    "min_periods": 6,
    "candle_freq": 6 * HOUR,
    "guard_rows": 2000,
    "pat_step": 2,
    "pat_samples": 8,
    "pat_candle": 6 * HOUR,
    "pat_candles": 4,
    "pat_threshold": 0.5,
    "ret_window": 4,
    "now_epoch": 901929600,     # 1998-08-01 00:00:00 UTC
    "ttl": 90 * DAY,
    "min_volume": 5000.0,
    "pair_regex": "Supplier#0000000",
    "pair_n": 20,
    "test_size": 0.25,
    "catalog_regex": "SIM_(click|view)",
    "points_start": "2024-01-05 00:00:00",
    "points_end": "2024-01-10",
    "outlier_k": 1.0,
    "now_ts": "2024-01-20 12:00:00",
    "last_hours": 48.0,
    "buffer_seconds": 6 * HOUR,
    "rule_weights": {"bid_price": -1.0, "ask_price": 0.5},
    "rule_intercept": 25.0,
    "online_weights": {"bid_price": -1.0, "ask_price": 0.5},
    "online_intercept": 0.125,
    "online_scaler": {"bid_price": (0.0, 100.0), "ask_price": (0.5, 80.5)},
    "online_expire": 600,
    "knn_k": 5,
    "knn_test": 0.05,
    "boost_rounds": 4,
    "boost_splits": {"l_quantity": (10.0, 20.0, 30.0, 40.0), "l_extendedprice": (20000.0, 40000.0, 60000.0, 80000.0),
                     "l_discount": (0.015, 0.035, 0.055, 0.075), "l_tax": (0.015, 0.035, 0.055)},
    "holdout_qty": 50.0,
    "holdout_models": (
        {"symbol": "click", "run_id": "steep", "weights": {"bid_price": 0.02, "ask_qty": -0.01}, "intercept": 0.0, "end_date": "2024-01-10 00:00:00"},
        {"symbol": "click", "run_id": "flat", "weights": {"bid_price": 0.001, "ask_qty": -0.02}, "intercept": 0.9, "end_date": "2024-01-20 12:00:00"},
        {"symbol": "view", "run_id": "steep", "weights": {"bid_price": -0.01}, "intercept": 0.3, "end_date": "2024-01-25 00:00:00"},
        {"symbol": "view", "run_id": "never", "weights": {"bid_price": 1.0}, "intercept": 0.0, "end_date": "2030-01-01 00:00:00"},
    ),
    "scan_instrument": "SIM_click",
    "scan_start": "2024-01-05",
    "scan_end": "2024-01-15",
    "rolling_data_features": (
        "bid_price.rolling_mean", "ask_price.rolling_var", "bid_qty.rolling_coeff", "ask_qty.rolling_min",
        "bid_price.rolling_max", "bid_price.rolling_open", "ask_price.rolling_close", "bid_price",
    ),
}


# Added before rounding: exact decimal ties (common: means and variances of
# 2-decimal prices terminate within 7 places) then sit 3e-8 off the rounding
# boundary, far beyond the ~1e-11 summation noise between engines.
ROUND_OFFSET = 3.14159e-8


def digits_for(name: str) -> int:
    """Variances carry the largest cross-engine noise (~1e-9): 4 places; deviations 6."""
    return 4 if "var" in name else (6 if "std" in name else ROUND_DIGITS)


def rnd(c, digits: int):
    """Round half up with plain IEEE steps so every engine gets the same double."""
    scale = float(10 ** digits)
    return (F.floor((c + F.lit(ROUND_OFFSET)) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")


def round6(df: DataFrame) -> DataFrame:
    return df.select(*[
        rnd(F.col(f.name), digits_for(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ])


def _q(spark: SparkSession, sf: str) -> DataFrame:
    return quotes(spark, sf)


def _nt(df: DataFrame) -> DataFrame:
    return round6(df.drop("time"))


def q_resample_last(spark, sf):
    return _nt(G.resample_last(_q(spark, sf), P["freq"], QUOTE_COLUMNS))


def q_resample_ffill(spark, sf):
    return _nt(G.resample_last(_q(spark, sf), P["freq"], QUOTE_COLUMNS, fill="ffill"))


def q_resample_asof_next(spark, sf):
    return _nt(G.resample_asof_next(_q(spark, sf), P["freq"], QUOTE_COLUMNS))


def q_candles(spark, sf):
    return _nt(G.candles(_q(spark, sf), P["candle_freq"], "bid_price"))


def q_ohlc(spark, sf):
    return _nt(B.ohlc(_q(spark, sf), P["window"], P["shift"], P["pct"], freq=P["freq"]))


def q_quantile_coefficient(spark, sf):
    return _nt(B.quantile_coefficient(_q(spark, sf), P["long_window"], P["shift"], P["pct"], freq=P["freq"]))


def q_all_fields(spark, sf):
    return _nt(B.all_fields(_q(spark, sf), P["shift"], P["window"], P["pct"], freq=P["freq"],
                            min_rows=P["all_fields_guard"]))


def q_cross_moving_average(spark, sf):
    return _nt(B.cross_moving_average(_q(spark, sf), P["cma_max"], P["cma_min"], P["cma_shift"], P["pct"],
                                      freq=P["freq"]))


def q_moving_average_candles(spark, sf):
    return _nt(B.moving_average_candles(_q(spark, sf), P["mac_window"], P["mac_shift"], P["mac_candle"],
                                        freq=P["freq"]))


def q_moving_average_pattern(spark, sf):
    return _nt(B.moving_average_pattern(_q(spark, sf), P["mac_window"], P["mac_shift"], P["map_offsets"],
                                        freq=P["freq"]))


def q_moving_average_shift(spark, sf):
    return _nt(B.moving_average_shift(_q(spark, sf), P["long_window"], P["shift"], freq=P["freq"]))


def q_return_candles(spark, sf):
    return _nt(B.return_candles(_q(spark, sf), P["rc_step"], 8, freq=P["freq"], min_rows=P["rc_guard"]))


def q_rolling_all_fields(spark, sf):
    return _nt(B.rolling_all_fields(_q(spark, sf), P["window"], P["shift"], P["pct"], P["min_periods"],
                                    freq=P["freq"]))


def q_rolling_data(spark, sf):
    return _nt(B.rolling_data(_q(spark, sf), P["rolling_data_features"], P["long_window"], True, P["shift"],
                              P["min_periods"], freq=P["freq"]))


# --- quality / cleaning ---------------------------------------------------------------------

def _qus(df: DataFrame) -> DataFrame:
    """Times as epoch micros (exact, engine-neutral)."""
    return df.withColumn("time_us", F.unix_micros(F.col("time").cast("timestamp"))).drop("time")


def q_dedupe_seq(spark, sf):
    return round6(_qus(Q.dedupe_seq(_q(spark, sf))))


def q_dedupe_rows(spark, sf):
    return round6(_qus(Q.dedupe_rows(_q(spark, sf).drop("seq"))))


def q_seq_gaps(spark, sf):
    d = Q.seq_gaps(_q(spark, sf))
    # nullable integer as DOUBLE so NULL reaches pandas as NaN on both engines
    return _qus(d.select("exchange", "symbol", "seq", F.col("seq_previous").cast("double").alias("seq_previous"),
                         "time"))


def q_coverage_map(spark, sf):
    return Q.coverage(_q(spark, sf))


def q_missing_partitions(spark, sf):
    return Q.missing_partitions(_q(spark, sf))


def q_feed_dates(spark, sf):
    d = Q.feed_dates(_q(spark, sf))
    return d.select("exchange", "symbol", F.unix_micros("first").alias("first_us"),
                    F.unix_micros("last").alias("last_us"))


def q_null_profile(spark, sf):
    return Q.null_profile(_q(spark, sf))


def q_clean_numeric(spark, sf):
    d = dataset_from_lineitem(table(spark, sf, "lineitem"))
    return round6(Q.clean_numeric(d, list(LINEITEM_FEATURES)))


def q_length_guard(spark, sf):
    return round6(_qus(Q.length_guard(_q(spark, sf), P["guard_rows"])))


def q_label_encode(spark, sf):
    return Q.label_encode(table(spark, sf, "events").select("event_id", "event_type"), "event_type")


# --- patterns -------------------------------------------------------------------------------

def _patterns(spark, sf, kind, window=None):
    return T_.pattern_table(_q(spark, sf), kind, window or P["window"], P["shift"], P["pat_step"], P["pat_samples"], 0.0,
                            freq=P["freq"])


def q_pattern_mean(spark, sf):
    return _nt(_patterns(spark, sf, "mean"))


def q_pattern_median(spark, sf):
    return _nt(_patterns(spark, sf, "median", P["long_window"]))


def q_pattern_mean_median(spark, sf):
    return _nt(_patterns(spark, sf, "mean_median"))


def q_pattern_ohlc(spark, sf):
    return _nt(T_.ohlc_pattern_table(_q(spark, sf), P["pat_candle"], P["pat_candles"], P["shift"], 0.0,
                                     freq=P["freq"]))


def q_pattern_score(spark, sf):
    return round6(T_.pattern_score(_patterns(spark, sf, "mean"), P["pat_threshold"]))


def q_pattern_match(spark, sf):
    table_ = _patterns(spark, sf, "mean")
    buy = T_.buy_patterns(T_.pattern_score(table_, P["pat_threshold"]))
    return _nt(T_.pattern_match(table_, buy))


# --- portfolio ------------------------------------------------------------------------------

def _grid_ba(spark, sf):
    return G.resample_last(_q(spark, sf), P["freq"], ("bid_price", "ask_price"))


def _instruments(spark, sf) -> list[str]:
    """Instrument list (small metadata: one distinct over a dictionary-encoded column)."""
    return sorted(f"SIM_{r[0]}" for r in table(spark, sf, "events").select("event_type").distinct().collect())


def q_returns(spark, sf):
    return round6(PF.fee_returns(_grid_ba(spark, sf), P["ret_window"], P["freq"]))


def _merged(spark, sf):
    inst = _instruments(spark, sf)
    return PF.merge_returns(PF.fee_returns(_grid_ba(spark, sf), P["ret_window"], P["freq"]), inst), inst


def q_merge_returns(spark, sf):
    m, inst = _merged(spark, sf)
    return round6(m)


def q_correlation(spark, sf):
    m, inst = _merged(spark, sf)
    return round6(PF.correlation(m, inst))


def q_portfolio(spark, sf):
    m, inst = _merged(spark, sf)
    return round6(PF.portfolio_report(m, inst))


# --- reports --------------------------------------------------------------------------------

def _pred(spark, sf):
    return predictions_from_labels(table(spark, sf, "labels"))


def q_confusion_margins(spark, sf):
    return R.confusion_margins(_pred(spark, sf))


def q_classification_report(spark, sf):
    return round6(R.classification_report(_pred(spark, sf)))


def q_imbalanced_report(spark, sf):
    return round6(R.imbalanced_report(_pred(spark, sf)))


def _signals(spark, sf):
    return signal_report_from_orders(table(spark, sf, "orders"))


def q_last_report(spark, sf):
    return round6(R.last_report(_signals(spark, sf), tiebreak="o_orderkey"))


def q_last_sharpe_ttl(spark, sf):
    return round6(R.last_sharpe_ttl(_signals(spark, sf), P["now_epoch"], P["ttl"], tiebreak="o_orderkey"))


def q_top_volume(spark, sf):
    return round6(R.top_volume(volumes_from_supplier(table(spark, sf, "supplier")), P["min_volume"]))


def q_pair_filter(spark, sf):
    return R.pair_filter(volumes_from_supplier(table(spark, sf, "supplier")), P["pair_regex"], P["pair_n"])


def _split(spark, sf):
    return R.chrono_split(_q(spark, sf), P["test_size"], keys=KEYS, tiebreak="seq")


def q_chrono_split(spark, sf):
    return _split(spark, sf).select("exchange", "symbol", "seq", "split")


def q_split_summary(spark, sf):
    s = R.split_summary(_split(spark, sf).withColumn("time", F.unix_micros("time")))
    return s.select("split", F.col("start_date").alias("start_us"), F.col("end_date").alias("end_us"), "size")


def q_shuffled_split(spark, sf):
    d = dataset_from_lineitem(table(spark, sf, "lineitem"))
    return R.shuffled_split(d, ["l_orderkey", "l_linenumber"], 0.25, 42).select("l_orderkey", "l_linenumber", "split")


# --- ML preparation -------------------------------------------------------------------------

def _lineitem_ds(spark, sf):
    return dataset_from_lineitem(table(spark, sf, "lineitem"))


def q_minmax_scale(spark, sf):
    scaled, _ = MP.minmax_scale(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES))
    return round6(scaled)


def q_chi2_kbest(spark, sf):
    scaled, _ = MP.minmax_scale(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES))
    return round6(MS.chi2_scores(scaled, list(LINEITEM_FEATURES), "label"))


def q_nearest_centroid(spark, sf):
    d = _lineitem_ds(spark, sf)
    model = MT.NearestCentroid(list(LINEITEM_FEATURES), "label").fit(d)
    return model.transform(d).select("l_orderkey", "l_linenumber", "label", "prediction")


def _knn_split(spark, sf):
    scaled, _ = MP.minmax_scale(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES))
    return R.shuffled_split(scaled, ["l_orderkey", "l_linenumber"], P["knn_test"], 42)


def q_knn_predict(spark, sf):
    """Five nearest neighbours of the held-out rows among all others, on scaled features."""
    d = landed(_knn_split(spark, sf), "split")
    model = MT.KNeighborsClassifier(list(LINEITEM_FEATURES), "label", P["knn_k"], ["l_orderkey", "l_linenumber"])
    out = model.fit(d.where("split = 'train'")).transform(d.where("split = 'test'"))
    return out.select("l_orderkey", "l_linenumber", "label", "prediction")


def q_adaboost_predict(spark, sf):
    """AdaBoost with stumps at fixed split points, fitted on all rows; every row's vote."""
    d = _lineitem_ds(spark, sf)
    model = MT.AdaBoost(list(LINEITEM_FEATURES), "label", P["boost_rounds"], P["boost_splits"]).fit(d)
    return model.transform(d).select("l_orderkey", "l_linenumber", "label", "prediction")


def q_model_testing(spark, sf):
    """Linear models published for some instruments, each tested on the quotes after its own end date."""
    from tidemark.plans import models as LC

    root = _stream_dir(spark, "models")
    for m in P["holdout_models"]:
        key = {"exchange": "SIM", "symbol": m["symbol"], "target": "label", "type": LC.LINEAR_RULE, "run_id": m["run_id"]}
        LC.publish_model(spark, root, key, {"features": list(m["weights"]), "target": "label", "weights": m["weights"],
                                            "intercept": m["intercept"], "end_date": m["end_date"]})
    rows = _q(spark, sf).withColumn("label", (F.col("bid_qty") > P["holdout_qty"]).cast("int"))
    return round6(LC.holdout_reports(spark, root, rows))


def q_train_models(spark, sf):
    """A logistic model for every instrument, published and listed; its test part's report from the registry."""
    from tidemark.plans import models as LC

    rows = _q(spark, sf).withColumn("label", (F.col("bid_qty") > P["holdout_qty"]).cast("int"))
    got = LC.train_models(rows, ["bid_price", "ask_qty"], "label", _stream_dir(spark, "models"), "r1", ties="seq")
    meta = F.from_json("meta", MODEL_META)
    return got.select("exchange", "symbol", "type", "run_id", F.explode(meta["report"]).alias("r")).select(
        "exchange", "symbol", "type", "run_id", "r.*")


# --- sources / alignment (data derived from the test tables) -------------------------------

def q_metrics_to_ticks(spark, sf):
    from tidemark.sources import metrics as S6

    exp = S6.ticks_to_metrics(_q(spark, sf), ("seq",) + tuple(QUOTE_COLUMNS))
    t = S6.metrics_to_ticks(exp, ("seq",) + tuple(QUOTE_COLUMNS))
    return round6(_qus(t))


def q_scan_features(spark, sf):
    from tidemark.sinks.writers import features_long
    from tidemark.sources.scans import features_wide

    g = G.resample_last(_q(spark, sf), P["freq"], QUOTE_COLUMNS)
    wide = features_wide(features_long(g, list(QUOTE_COLUMNS)), list(QUOTE_COLUMNS))
    return round6(_qus(wide))


def q_instrument_catalog(spark, sf):
    from tidemark.sources import metrics as S6

    names = S6.ticks_to_metrics(_q(spark, sf), ("seq",) + tuple(QUOTE_COLUMNS), chunk_seconds=DAY).select("metric")
    return S6.instrument_catalog(names, P["catalog_regex"])


def _points(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("time"), F.lit("sim").alias("exchange"),
                     F.col("event_type").alias("symbol"), F.col("value").alias("bid_price"))


def q_normalize_points(spark, sf):
    from tidemark.sources import metrics as S6

    return round6(_qus(S6.normalize_points(_points(spark, sf))))


def q_scan_points(spark, sf):
    from tidemark.sources.scans import scan_points

    return round6(_qus(scan_points(_q(spark, sf), P["points_start"], P["points_end"])))


def q_align_feeds(spark, sf):
    g = G.resample_last(_q(spark, sf), P["freq"], ("bid_price",))
    feeds = sorted(r[0] for r in table(spark, sf, "events").select("event_type").distinct().collect())
    lng = g.select("g", F.col("symbol").alias("feed"), F.col("bid_price").alias("value"))
    return round6(G.align_feeds(lng, feeds, keys=("g",)))


def q_params_matrix(spark, sf):
    from tidemark.operators.align import params_matrix_from_arrays

    li = table(spark, sf, "lineitem")
    one = li.agg(F.sort_array(F.collect_set("l_returnflag")).alias("l_returnflag"),
                 F.sort_array(F.collect_set("l_linestatus")).alias("l_linestatus"))
    return params_matrix_from_arrays(one, ["l_returnflag", "l_linestatus"])


def q_flatten_distinct(spark, sf):
    from tidemark.operators.align import first_seen_distinct

    ev = table(spark, sf, "events")
    d = first_seen_distinct(ev, ["user_id"], "event_type", "ts", "types")
    return d.select("user_id", F.array_join("types", ",").alias("types"))


# --- windows over groups, time filters, online twins ----------------------------------------

def _grid_days(spark, sf):
    g = G.resample_last(_q(spark, sf), P["freq"], ("bid_price",))
    return g.withColumn("day", F.date_format("time", "yyyyMMdd"))


def q_frame_stats(spark, sf):
    from tidemark.operators.rolling import frame_stats

    return round6(frame_stats(_grid_days(spark, sf), ["exchange", "symbol", "day"], "bid_price"))


def q_remove_outliers(spark, sf):
    from tidemark.operators.rolling import remove_outliers

    q = _q(spark, sf).withColumn("day", F.date_format("time", "yyyyMMdd"))
    return round6(_qus(remove_outliers(q, ["exchange", "symbol", "day"], "bid_price", P["outlier_k"])))


def q_rank_within(spark, sf):
    return round6(R.rank_within(_signals(spark, sf), "instrument_id", "sharp_ratio"))


def q_last_hours(spark, sf):
    return round6(_qus(Q.last_hours(_q(spark, sf), P["now_ts"], P["last_hours"])))


def q_tick_buffer(spark, sf):
    from tidemark.streaming.state import tick_buffer

    return round6(tick_buffer(_q(spark, sf), P["buffer_seconds"]))


def q_closed_bars(spark, sf):
    from tidemark.streaming.state import closed_bars

    return round6(closed_bars(_q(spark, sf)))


# --- ML fits (different learners than the reference: rows-only checks) ----------------------

def q_train_logistic(spark, sf):
    # landed: the fit's passes and the predictions read the split, they don't make it again
    d = landed(R.shuffled_split(_lineitem_ds(spark, sf), ["l_orderkey", "l_linenumber"], 0.25, 42), "split")
    model = MT.train(d.where("split = 'train'"), list(LINEITEM_FEATURES), "label", "LogisticRegression")
    return MT.predict(model, d.where("split = 'test'"), ["l_orderkey", "l_linenumber", "label"])


def q_gbt_importances(spark, sf):
    return MS.gbt_importances(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES), "label")


def q_rfe(spark, sf):
    return MS.rfe_ranking(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES), "label")


def q_leaderboard(spark, sf):
    return MT.leaderboard(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES), "label", ["l_orderkey", "l_linenumber"])


def _ar(spark, sf, p):
    g = G.resample_last(_q(spark, sf), P["freq"], ("bid_price",))
    models = MT.ar_fit(g, "bid_price", p, KEYS, freq=P["freq"])
    out = MT.ar_predict(g, models, "bid_price", p, KEYS, freq=P["freq"])
    return round6(out.select("exchange", "symbol", "g", "bid_price", "prediction"))


def q_ar_forecast(spark, sf):
    return _ar(spark, sf, 3)


def q_ar1_forecast(spark, sf):
    return _ar(spark, sf, 1)


# --- landed tables: written as the sinks write them, read back as the scans read them -------

def _landed_ticks(spark, sf) -> str:
    from tidemark.sinks.writers import write_ticks

    path = _stream_dir(spark, "ticks")
    write_ticks(_q(spark, sf), path)
    return path


def q_scan_quotes(spark, sf):
    from tidemark.sources.scans import scan_quotes

    return round6(_qus(scan_quotes(spark, _landed_ticks(spark, sf)).drop("date")))


def q_scan_ticks(spark, sf):
    """S2 over ticks whose prices are coarse, so that many differ in ``seq`` alone."""
    from tidemark.sinks.writers import write_ticks
    from tidemark.sources.scans import scan_ticks

    q = _q(spark, sf)
    coarse = q.select("exchange", "symbol", "time", "seq", *[F.floor(c).cast("double").alias(c) for c in QUOTE_COLUMNS])
    again = coarse.unionByName(coarse.withColumn("time", F.col("time") + F.expr("interval 1 second")))
    path = _stream_dir(spark, "ticks")
    write_ticks(again, path)
    return _qus(scan_ticks(spark, path, P["scan_instrument"], P["scan_start"], P["scan_end"]))


def q_scan_features_landed(spark, sf):
    from tidemark.sinks.writers import features_long, write_features
    from tidemark.sources.scans import scan_features

    path = _stream_dir(spark, "features")
    write_features(features_long(G.resample_last(_q(spark, sf), P["freq"], QUOTE_COLUMNS), list(QUOTE_COLUMNS)), path)
    return round6(_qus(scan_features(spark, path, list(QUOTE_COLUMNS))))


def q_metrics_landed(spark, sf):
    """S6 -> K1 -> S1: a metric export turned into ticks, landed, and scanned."""
    from tidemark.sinks.writers import write_ticks
    from tidemark.sources import metrics as S6
    from tidemark.sources.scans import scan_quotes

    fields = ("seq",) + tuple(QUOTE_COLUMNS)
    ticks = S6.metrics_to_ticks(S6.ticks_to_metrics(_q(spark, sf), fields), fields)
    path = _stream_dir(spark, "exported")
    write_ticks(ticks, path)
    return round6(_qus(scan_quotes(spark, path).drop("date")).withColumn("seq", F.col("seq").cast("long")))


def q_mirror(spark, sf):
    """K9: mirror of the landed ticks; the second run copies nothing."""
    from tidemark.sinks.writers import mirror_partitions
    from tidemark.sources.scans import _read

    src, dst = _landed_ticks(spark, sf), _stream_dir(spark, "mirror")
    first = mirror_partitions(spark, src, dst).count()
    again = mirror_partitions(spark, src, dst).count()
    out = _read(spark, dst).groupBy("exchange", "symbol", "date").agg(F.count(F.lit(1)).alias("rows"))
    return out.withColumn("copied", F.lit(first)).withColumn("copied_again", F.lit(again))


# --- streams (R1-R4), run to completion with availableNow -----------------------------------

def _stream_dir(spark, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder (never a local temp dir)."""
    import uuid

    from tidemark.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"


STREAM_FILES = 8  # micro-batches of a streaming query


def _events_stream(spark, sf):
    """The events table, one file or many in whatever order, as a stream of files in time order."""
    return _file_stream(spark, table(spark, sf, "events"), _stream_dir(spark, "events"), ["ts", "event_id"])


def _file_stream(spark, rows: DataFrame, path: str, order: list[str]) -> DataFrame:
    """Rows landed as files in ``order`` (time first), streamed with a micro-batch for each file.

    Rows are range-partitioned by time into files; a file stream goes by modification
    times, so those are set in the files' order before the stream starts.
    """
    rows.repartitionByRange(STREAM_FILES, *order).sortWithinPartitions(*order).write.parquet(path)
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(f.getPath().toString() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    newest = max(f.getModificationTime() for f in fs.listStatus(folder))
    for i, f in enumerate(files):  # as many as STREAM_FILES
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(f), newest + 1000 * (i - len(files)), -1)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _run_stream(spark, sdf, name: str) -> DataFrame:
    """Run a stream to the end of its input into Parquet files; return them as a batch frame."""
    d = _stream_dir(spark, name)
    q = (sdf.writeStream.format("parquet").option("path", f"{d}/out").option("checkpointLocation", f"{d}/ckpt")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{d}/out")


def q_stream_buffer(spark, sf):
    from tidemark.sources.adapters import quotes_from_events
    from tidemark.streaming.state import tick_buffer_stream

    return round6(_run_stream(spark, tick_buffer_stream(quotes_from_events(_events_stream(spark, sf)),
                                                        P["buffer_seconds"]), "stream_buffer"))


def q_stream_predict(spark, sf):
    """Closed bars from the tick stream, scored by a fixed linear rule (high bids fall, wide spreads rise)."""
    from tidemark.sources.adapters import quotes_from_events
    from tidemark.streaming.state import closed_bars_stream

    got = _run_stream(spark, closed_bars_stream(quotes_from_events(_events_stream(spark, sf))), "stream_bars")
    out = MT.linear_rule(got, P["rule_weights"], P["rule_intercept"])
    return out.select("exchange", "symbol", "time_us", "prediction")


def q_stream_predict_scaled(spark, sf):
    """R3 with a published model: bars from the tick stream, scaled by the registry row's scaler and judged by its rule;
    instruments that fall silent are closed by the watermark."""
    from tidemark.plans import models as LC
    from tidemark.sources.adapters import quotes_from_events
    from tidemark.streaming.state import closed_bars_stream

    root = _stream_dir(spark, "models")
    LC.publish_model(spark, root, {"exchange": "ALL", "symbol": "ALL", "target": "up", "type": LC.LINEAR_RULE, "run_id": "r1"}, {
        "features": list(P["online_weights"]), "target": "up", "weights": P["online_weights"], "intercept": P["online_intercept"],
        "scaler": [{"feature": f, "low": low, "high": high} for f, (low, high) in P["online_scaler"].items()]})
    row = LC.read_registry(spark, root).first()
    bars = closed_bars_stream(quotes_from_events(_events_stream(spark, sf)), P["online_expire"])
    got = _run_stream(spark, LC.predict_with(bars, row), "stream_scaled")
    return got.select("exchange", "symbol", "time_us", "prediction")


def q_stream_predict_logistic(spark, sf):
    """The same bars scored by a logistic model fitted on the batch bars, whose label looks one bar ahead."""
    from tidemark.sources.adapters import quotes_from_events
    from tidemark.streaming.state import closed_bars, closed_bars_stream

    bars = closed_bars(_q(spark, sf)).withColumn("time", F.timestamp_micros("time_us"))
    ahead = segmented_prev(bars, KEYS, F.struct((-F.col("time_us")).alias("t")), F.col("bid_price"), "next_bid",
                           span=DAY * 1_000_000, chunk_source=-F.col("time_us"))
    ahead = ahead.where("next_bid is not null").withColumn("label", (F.col("next_bid") > F.col("ask_price")).cast("int"))
    model = MT.train(ahead, ["bid_price", "ask_price"], "label", "LogisticRegression")
    got = _run_stream(spark, closed_bars_stream(quotes_from_events(_events_stream(spark, sf))), "stream_bars")
    return MT.predict(model, got, ["exchange", "symbol", "time_us"])


def q_stream_signal(spark, sf):
    """R2: gridded quotes landed as files, streamed through the online signature state."""
    from tidemark.streaming.state import pattern_stream

    g = G.resample_last(_q(spark, sf), P["freq"], ("bid_price", "ask_price"))
    src = _file_stream(spark, g, _stream_dir(spark, "grid"), ["time", *KEYS])
    offs = T_.sample_offsets(P["pat_samples"], P["pat_step"])
    buy = T_.buy_patterns(T_.pattern_score(_patterns(spark, sf, "mean"), P["pat_threshold"]))
    return _run_stream(spark, pattern_stream(src, buy, P["window"] // P["freq"], offs), "stream_signal")


def q_replay(spark, sf):
    """Landed ticks replayed as a file stream (one callback per micro-batch)."""
    from tidemark.sinks.writers import write_ticks
    from tidemark.streaming.replay import replay_stream

    d = _stream_dir(spark, "replay")
    write_ticks(_q(spark, sf), f"{d}/ticks")

    def land(batch, epoch_id):
        batch.withColumn("epoch", F.lit(int(epoch_id))).write.mode("append").parquet(f"{d}/out")

    replay_stream(spark, f"{d}/ticks", land, f"{d}/ckpt", max_files_per_trigger=50).awaitTermination()
    return round6(_qus(spark.read.parquet(f"{d}/out").drop("epoch")))


def q_stream_dedupe(spark, sf):
    """D1 on the stream — repeated (instrument, seq) within the watermark are dropped."""
    from tidemark.sources.adapters import quotes_from_events
    from tidemark.streaming.replay import streaming_dedupe

    out = _run_stream(spark, streaming_dedupe(quotes_from_events(_events_stream(spark, sf)), "1 hour"),
                      "stream_dedupe")
    return round6(_qus(out))


def q_robust_open_close(spark, sf):
    from tidemark.operators.rolling import robust_open_close

    return round6(robust_open_close(_grid_days(spark, sf), ["exchange", "symbol", "day"], "bid_price"))


def q_feed_catalog(spark, sf):
    series = _q(spark, sf).select(F.concat_ws("_", "exchange", "symbol").alias("series")).distinct()
    d = X_.job_feed_dates(series, _q(spark, sf), P["catalog_regex"])
    return d.select("exchange", "symbol", "series", F.unix_micros("first").alias("first_us"),
                    F.unix_micros("last").alias("last_us"))


def q_backtest_rollup(spark, sf):
    from tidemark.sources.adapters import backtest_trades_from_orders

    roll = R.backtest_rollup(backtest_trades_from_orders(table(spark, sf, "orders")), "source", "seq")
    return round6(roll.drop("uuid"))  # a fresh random id per row is not comparable


def q_stream_candles(spark, sf):
    """R5 / G3 on the stream: watermarked tumbling candles; append mode emits closed windows."""
    from tidemark.sources.adapters import quotes_from_events
    from tidemark.streaming.replay import streaming_candles

    out = _run_stream(spark, streaming_candles(quotes_from_events(_events_stream(spark, sf)), P["candle_freq"],
                                               "1 hour"), "stream_candles")
    return round6(out.select("exchange", "symbol", F.unix_seconds(F.col("window.start")).alias("g"),
                             "open", "high", "low", "close"))


def q_learning(spark, sf):
    """Hourly feeds of all instruments aligned on time (G4, G2), features of them (E0), and whether the clicks' bid
    rises in the next step, learned by two estimators on the features that the selectors vote for."""
    feeds = sorted(r[0] for r in table(spark, sf, "events").select("event_type").distinct().collect())
    hours = G.bucket_last(_q(spark, sf), HOUR, ("bid_price",)).select(F.timestamp_seconds("g").alias("time"), F.col("symbol").alias("feed"),
                                                                      F.col("bid_price").alias("value"))
    wide = G.align_asof_next(hours, feeds, 2 * HOUR)
    for f in feeds[1:]:
        MP.register_feature(f"{f}_to_{feeds[0]}", lambda df, f=f: F.try_divide(F.col(f), F.col(feeds[0])))
    data = MP.apply_features(wide, [f"{f}_to_{feeds[0]}" for f in feeds[1:]]).withColumn("all", F.lit("all"))
    ahead = segmented_prev(data, ["all"], F.struct((-F.col("g")).alias("g")), F.col(feeds[0]), "next", span=DAY * 30, chunk_source=-F.col("g"))
    data = ahead.where("next is not null").withColumn("label", (F.col("next") > F.col(feeds[0])).cast("int")).drop("next", "all")
    features = [*feeds, *[f"{f}_to_{feeds[0]}" for f in feeds[1:]]]
    return X_.job_learning(data, features, "label", _stream_dir(spark, "learning"), k=4, rounds=5, ties="g")


def q_boruta(spark, sf):
    return MS.boruta(_lineitem_ds(spark, sf), list(LINEITEM_FEATURES), "label", seed=7)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "resample_last": q_resample_last,
    "resample_ffill": q_resample_ffill,
    "resample_asof_next": q_resample_asof_next,
    "candles": q_candles,
    "ohlc": q_ohlc,
    "quantile_coefficient": q_quantile_coefficient,
    "all_fields": q_all_fields,
    "cross_moving_average": q_cross_moving_average,
    "moving_average_candles": q_moving_average_candles,
    "moving_average_pattern": q_moving_average_pattern,
    "moving_average_shift": q_moving_average_shift,
    "return_candles": q_return_candles,
    "rolling_all_fields": q_rolling_all_fields,
    "rolling_data": q_rolling_data,
    "dedupe_seq": q_dedupe_seq,
    "dedupe_rows": q_dedupe_rows,
    "seq_gaps": q_seq_gaps,
    "coverage_map": q_coverage_map,
    "missing_partitions": q_missing_partitions,
    "feed_dates": q_feed_dates,
    "null_profile": q_null_profile,
    "clean_numeric": q_clean_numeric,
    "length_guard": q_length_guard,
    "label_encode": q_label_encode,
    "pattern_mean": q_pattern_mean,
    "pattern_median": q_pattern_median,
    "pattern_mean_median": q_pattern_mean_median,
    "pattern_ohlc": q_pattern_ohlc,
    "pattern_score": q_pattern_score,
    "pattern_match": q_pattern_match,
    "returns": q_returns,
    "merge_returns": q_merge_returns,
    "correlation": q_correlation,
    "portfolio": q_portfolio,
    "confusion_margins": q_confusion_margins,
    "classification_report": q_classification_report,
    "imbalanced_report": q_imbalanced_report,
    "last_report": q_last_report,
    "last_sharpe_ttl": q_last_sharpe_ttl,
    "top_volume": q_top_volume,
    "pair_filter": q_pair_filter,
    "chrono_split": q_chrono_split,
    "split_summary": q_split_summary,
    "shuffled_split": q_shuffled_split,
    "minmax_scale": q_minmax_scale,
    "chi2_kbest": q_chi2_kbest,
    "nearest_centroid": q_nearest_centroid,
    "metrics_to_ticks": q_metrics_to_ticks,
    "scan_features": q_scan_features,
    "instrument_catalog": q_instrument_catalog,
    "normalize_points": q_normalize_points,
    "scan_points": q_scan_points,
    "align_feeds": q_align_feeds,
    "params_matrix": q_params_matrix,
    "flatten_distinct": q_flatten_distinct,
    "frame_stats": q_frame_stats,
    "remove_outliers": q_remove_outliers,
    "rank_within": q_rank_within,
    "last_hours": q_last_hours,
    "tick_buffer": q_tick_buffer,
    "closed_bars": q_closed_bars,
    "train_logistic": q_train_logistic,
    "knn_predict": q_knn_predict,
    "adaboost_predict": q_adaboost_predict,
    "model_testing": q_model_testing,
    "train_models": q_train_models,
    "gbt_importances": q_gbt_importances,
    "rfe": q_rfe,
    "leaderboard": q_leaderboard,
    "ar_forecast": q_ar_forecast,
    "boruta": q_boruta,
    "learning": q_learning,
    "stream_dedupe": q_stream_dedupe,
    "robust_open_close": q_robust_open_close,
    "feed_catalog": q_feed_catalog,
    "backtest_rollup": q_backtest_rollup,
    "stream_candles": q_stream_candles,
    "stream_buffer": q_stream_buffer,
    "stream_signal": q_stream_signal,
    "stream_predict": q_stream_predict,
    "stream_predict_scaled": q_stream_predict_scaled,
    "replay": q_replay,
    "stream_predict_logistic": q_stream_predict_logistic,
    "ar1_forecast": q_ar1_forecast,
    "scan_quotes": q_scan_quotes,
    "scan_ticks": q_scan_ticks,
    "scan_features_landed": q_scan_features_landed,
    "metrics_landed": q_metrics_landed,
    "mirror": q_mirror,
}

__all__ = ["QUERIES", "P", "round6", "KEYS"]
