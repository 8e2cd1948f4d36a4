"""Jobs (X1-X8): the compositions a user runs, each one lazy plan up to its sinks.

Long jobs cut lineage at their natural materialisation points with a
reliable checkpoint in the cluster's shared checkpoint folder
(``session.materialize``), so a lost executor does not replay the whole
upstream plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import align as J
from tidemark.operators import grid as G
from tidemark.operators import portfolio as PF
from tidemark.operators import quality as Q
from tidemark.operators import reports as R
from tidemark.operators.ml import prep as MP
from tidemark.operators.ml import select as MS
from tidemark.operators.ml import train as MT
from tidemark.plans import models as LC
from tidemark.session import materialize
from tidemark.sinks import writers as K
from tidemark.sources import metrics as S6
from tidemark.sources import scans as S


def job_backup(spark: SparkSession, export_path: str, ticks_root: str) -> bool:
    """Metric export (JSON lines) -> wide ticks -> partitioned Parquet."""
    ticks = S6.metrics_to_ticks(S6.read_metric_export(spark, export_path))
    return K.write_ticks(ticks, ticks_root)


def job_features_importance(df: DataFrame, features: Sequence[str], label: str, out_dir: str, k: int = 10,
                            seed: int = 42, rounds: int = 10) -> dict[str, DataFrame]:
    """Profile nulls, drop incomplete rows, score features with each selector (E4-E7), one CSV per selector."""
    feats = list(features)
    K.overwrite_table(Q.null_profile(df, feats + [label]), f"{out_dir}/null_profile")
    clean = materialize(Q.clean_numeric(df.select(*feats, label), feats))
    scaled, _ = MP.minmax_scale(clean, feats)
    out = {
        "chi2": MS.k_best(MS.chi2_scores(scaled, feats, label), k),
        "gbt": MS.gbt_importances(clean, feats, label, seed),
        "rfe": MS.rfe_ranking(clean, feats, label),
        "boruta": MS.boruta(clean, feats, label, rounds=rounds, seed=seed),
    }
    for name, d in out.items():
        d.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out_dir}/{name}")
    return out


def job_training(df: DataFrame, features: Sequence[str], label: str, out_dir: str, estimator: str = "LogisticRegression",
                 test_size: float = 0.25, time_col: str = "time", run_id: str = "run", keys: Sequence[str] = ("exchange", "symbol"),
                 ties: str | None = None, **params) -> DataFrame:
    """A model for every instrument (clean -> split -> scaler and fit on the train part -> reports -> published).

    A run that is repeated under the same ``run_id`` replaces its models. Returns the registry's rows of the run.
    """
    return LC.train_models(df, features, label, out_dir, run_id, estimator, test_size, time_col, keys, ties, **params)


def job_model_testing(spark: SparkSession, root: str, df: DataFrame, out_dir: str | None = None, time_col: str = "time",
                      **wildcards) -> DataFrame:
    """Every registered model matching the wildcards, tested on its instrument's rows after its own end date."""
    report = LC.holdout_reports(spark, root, df, time_col, **wildcards)
    if out_dir:
        K.overwrite_table(report, f"{out_dir}/model_testing")
    return report


def job_portfolio(quotes: DataFrame, instruments: Sequence[str], out_dir: str, window: int = 14400,
                  freq: int = 1) -> dict[str, DataFrame]:
    """Forward as-of grid -> fee-adjusted returns -> merged returns -> correlation + portfolios."""
    grid = G.resample_asof_next(quotes, freq, ("bid_price", "ask_price"))
    merged = materialize(PF.merge_returns(PF.fee_returns(grid, window, freq), instruments))
    out = {"correlation": PF.correlation(merged, instruments),
           "portfolio": PF.portfolio_report(merged, instruments)}
    for name, d in out.items():
        K.overwrite_table(d, f"{out_dir}/{name}")
    return out


def step(spark: SparkSession, path: str, make) -> DataFrame:
    """A step's landed output: made once, read again by a run that is started over (a write that was killed leaves no
    ``_SUCCESS`` mark and is made again)."""
    fs, mark = K._hadoop_fs(spark, f"{path}/_SUCCESS")
    if not fs.exists(mark):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def select_by_vote(df: DataFrame, features: Sequence[str], label: str, k: int, seed: int = 42, rounds: int = 10) -> DataFrame:
    """E4-E7 together: ``feature, chi2, boosting, elimination, boruta`` (whether each selector takes it) and ``votes``.

    ``df`` is scaled to [0, 1] (chi-squared needs that). The best ``k`` by chi-squared and by boosting importances (of
    those above zero), the last ``k`` that elimination leaves, and what Boruta doesn't reject.
    """
    feats = list(features)
    chosen = {
        "chi2": MS.k_best(MS.chi2_scores(df, feats, label), k),
        "boosting": MS.drop_zero_importance(MS.gbt_importances(df, feats, label, seed)).orderBy(F.col("importance").desc(), "feature").limit(k),
        "elimination": MS.rfe_ranking(df, feats, label, min(k, len(feats))).where("ranking = 1"),
        "boruta": MS.boruta(df, feats, label, rounds=rounds, seed=seed).where("decision <> 'rejected'"),
    }
    took = {name: {r["feature"] for r in d.select("feature").collect()} for name, d in chosen.items()}     # a row a feature
    rows = [(f, *[f in took[n] for n in took], sum(f in took[n] for n in took)) for f in feats]
    return df.sparkSession.createDataFrame(rows, "feature string, " + ", ".join(f"{n} boolean" for n in took) + ", votes int")


def job_learning(df: DataFrame, features: Sequence[str], label: str, out_dir: str, k: int = 5,
                 estimators: Sequence[str] = ("LogisticRegression", "RandomForestClassifier"),
                 test_size: float = 0.3, time_col: str = "time", keys: Sequence[str] = (), ties: str | None = None,
                 votes: int = 2, seed: int = 42, rounds: int = 10, backtests: DataFrame | None = None) -> DataFrame:
    """Clean -> chronological split -> scaler of the train part -> selection by vote -> several estimators -> reports.

    Every step lands under ``out_dir``: a run that is started over after a failure goes on with the first step that
    isn't complete. Scaler and selection see the train part only. Features with at least ``votes`` of the four selectors
    stay (all of them if none has). A train part without two classes gives an empty report. Returns a row per estimator and class (``learning_report``); with ``backtests``
    the summary (A4) lands as ``learning_summary``.
    """
    spark, feats = df.sparkSession, list(features)
    split = step(spark, f"{out_dir}/split", lambda: R.chrono_split(Q.clean_numeric(df, feats), test_size, keys=keys, time_col=time_col, tiebreak=ties))
    scaler = step(spark, f"{out_dir}/scaler", lambda: MP.minmax_scale(split.where("split = 'train'"), feats)[1])
    if split.where("split = 'train'").select(label).distinct().limit(2).count() < 2:
        K.overwrite_table(spark.createDataFrame([], f"estimator string, {LC.REPORT}"), f"{out_dir}/learning_report")
        return spark.read.parquet(f"{out_dir}/learning_report")      # nothing to learn from: an empty report
    data = MP.apply_minmax(split, scaler, feats)
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    selection = step(spark, f"{out_dir}/selection", lambda: select_by_vote(train, feats, label, k, seed, rounds))
    taken = {r["feature"] for r in selection.where(F.col("votes") >= votes).collect()} or set(feats)
    chosen = [f for f in feats if f in taken]

    def judged(name):
        model = MT.train(train, chosen, label, name, seed)
        return model.transform(test).select(F.lit(name).alias("estimator"), F.col(label).cast("int").alias("actual"),
                                            F.col("prediction").cast("int").alias("predicted"))

    pred = J.union_feeds([step(spark, f"{out_dir}/predictions/{name}", lambda name=name: judged(name)) for name in estimators])
    K.overwrite_table(R.classification_report(pred, by=["estimator"]), f"{out_dir}/learning_report")
    report = spark.read.parquet(f"{out_dir}/learning_report")
    if backtests is not None:
        K.overwrite_table(R.learning_summary(report.withColumn("instrument", F.lit("ALL")), backtests), f"{out_dir}/learning_summary")
    return report


def job_backtest_report(spark: SparkSession, trades_csv: str, out_dir: str, signal_col: str = "signal") -> DataFrame:
    """Backtest trade files -> last row per file + trade count -> rank by sharpe per signal."""
    from pyspark.sql import types as T

    from tidemark.schema import BACKTEST_TRADES

    schema = T.StructType(BACKTEST_TRADES.fields + [T.StructField("source", T.StringType()),
                                                    T.StructField("seq", T.LongType()),
                                                    T.StructField(signal_col, T.StringType())])
    trades = S.read_csv(spark, trades_csv, schema)
    roll = R.backtest_rollup(trades, source="source", order="seq")  # the signal rides in the last row
    ranked = R.rank_within(roll, signal_col, "sharp_ratio")
    K.write_signal_tables(ranked, out_dir, signal_col)
    return ranked


def job_feed_dates(series: DataFrame, quotes: DataFrame, pattern: str) -> DataFrame:
    """Feeds matching an anchored regex, with their first and last quote time."""
    feeds = S6.series_filter(series, pattern, "series")
    d = Q.feed_dates(quotes).withColumn("series", F.concat_ws("_", "exchange", "symbol"))
    return d.join(feeds, on="series", how="left_semi")


def job_patterns(quotes: DataFrame, out_dir: str, kind: str = "mean", threshold: float = 0.9, **params) -> dict:
    """T6 -> T7 -> S14 -> T9: pattern table (checkpointed once), scores, buy set, signals.

    The table feeds both the scores and the matching, so it is materialised
    once instead of being recomputed by each branch.
    """
    from tidemark.operators import patterns as T_

    table = materialize(T_.pattern_table(quotes, kind, **params))
    scores = T_.pattern_score(table, threshold)
    buy = T_.buy_patterns(scores)
    signals = T_.pattern_match(table, buy)
    scores.orderBy(F.col("score").desc(), F.col("count").desc(), "pattern").write.mode("overwrite").parquet(
        f"{out_dir}/scores")
    return {"table": table, "scores": scores, "buy": buy, "signals": signals}
