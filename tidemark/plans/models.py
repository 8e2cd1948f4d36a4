"""Life cycle of models: train one per instrument, publish, list, test on what came after.

A model's folder ``models/exchange=…/symbol=…/target=…/type=…/run_id=…`` holds the fitted pipeline (``model``) and its
meta document (``meta``); the registry's row for the same key is written last and replaces the one of an earlier run,
so what a killed run left behind is never listed and a repeated run doesn't add rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import as_ts, safe_div
from tidemark.operators import quality as Q
from tidemark.operators import reports as R
from tidemark.operators.ml import train as MT
from tidemark.schema import KEYS, MODEL_KEY, MODEL_META, MODEL_ROW
from tidemark.session import checkpoint_dir, landed
from tidemark.sources.scans import is_missing, list_models

#: Type of a model that is nothing but its meta document: weights of the (scaled) features and an intercept.
LINEAR_RULE = "LinearRule"
#: Fits that run at a time.
FITS = 4


def _folder(root: str, key: Mapping[str, str]) -> str:
    return f"{root.rstrip('/')}/models/" + "/".join(f"{k}={key[k]}" for k in MODEL_KEY)


def publish_model(spark: SparkSession, root: str, key: Mapping[str, str], meta: Mapping, model=None) -> str:
    """The model's files, then its meta document, then its row in the registry (which replaces an older one).

    ``key``: exchange, symbol, target, type, run_id. ``meta``: fields of ``MODEL_META``; missing ones are null.
    """
    folder = _folder(root, key)
    if model is not None:
        model.write().overwrite().save(f"{folder}/model")
    full = {f.name: meta.get(f.name) for f in MODEL_META.fields}
    spark.createDataFrame([full], MODEL_META).coalesce(1).write.mode("overwrite").json(f"{folder}/meta")
    row = {**{k: str(key[k]) for k in MODEL_KEY}, "path": folder, "end_date": meta.get("end_date"), "meta": json.dumps(full, sort_keys=True)}
    (spark.createDataFrame([row], MODEL_ROW).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*MODEL_KEY).parquet(f"{root.rstrip('/')}/registry"))
    return folder


def read_registry(spark: SparkSession, root: str) -> DataFrame:
    """The registry's rows; none if nothing was published yet."""
    from pyspark.sql.utils import AnalysisException

    try:
        return spark.read.schema(MODEL_ROW).parquet(f"{root.rstrip('/')}/registry")
    except AnalysisException as e:
        if not is_missing(e):
            raise
        return spark.createDataFrame([], MODEL_ROW)


def scaled(features: Sequence[str], scaler: Sequence[Mapping] | None, prefix: str = "") -> dict[str, Column]:
    """E3 with fitted bounds: the features as columns of literals, no join; a constant feature is 0."""
    bounds = {s["feature"]: s for s in scaler or ()}
    out = {}
    for f in features:
        x = F.col(f"`{prefix}{f}`").cast("double")
        if f in bounds:
            low, high = float(bounds[f]["low"]), float(bounds[f]["high"])
            x = F.when(x.isNotNull(), F.coalesce(safe_div(x - F.lit(low), F.lit(high) - F.lit(low)), F.lit(0.0)))
        out[f] = x
    return out


def split_by_instrument(df: DataFrame, test_size: float, keys: Sequence[str], time_col: str, ties: str | None) -> DataFrame:
    """E1 per instrument, landed in a folder for each, so that a fit reads its own rows only."""
    split = R.chrono_split(df, test_size, keys=keys, time_col=time_col, tiebreak=ties)
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/split-{uuid.uuid4().hex}"
    split.hint("rebalance", *keys).write.partitionBy(*keys).parquet(path)
    return df.sparkSession.read.schema(split.schema).parquet(path)


def train_models(df: DataFrame, features: Sequence[str], label: str, root: str, run_id: str, estimator: str = "LogisticRegression",
                 test_size: float = 0.25, time_col: str = "time", keys: Sequence[str] = KEYS, ties: str | None = None,
                 scale: bool = True, seed: int = 42, **params) -> DataFrame:
    """Clean -> chronological split -> scaler and fit on the train part -> test -> publish, for every instrument.

    Instruments are split and summarised together (one pass each); fits are MLlib jobs over one instrument's rows,
    a few at a time. An instrument without rows in both parts, or with one class to learn, gets no model. Returns the
    registry's rows of this run.
    """
    spark, feats, keys = df.sparkSession, list(features), list(keys)
    split = split_by_instrument(Q.clean_numeric(df, feats), test_size, keys, time_col, ties)
    time = as_ts(time_col)
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    stats = split.groupBy(*keys, "split").agg(
        stamp(F.min(time)).alias("start_date"), stamp(F.max(time)).alias("end_date"), F.count(F.lit(1)).alias("size"),
        F.count_distinct(F.col(f"`{label}`")).alias("classes"),
        *[F.struct(F.min(f"`{f}`").cast("double").alias("low"), F.max(f"`{f}`").cast("double").alias("high")).alias(f"s{i}") for i, f in enumerate(feats)])
    found: dict[tuple, dict] = {}
    for r in stats.collect():       # two rows an instrument
        found.setdefault(tuple(str(r[k]) for k in keys), {})[r["split"]] = r

    def one(item):
        names, parts = item
        if set(parts) != {"train", "test"} or parts["train"]["classes"] < 2:
            return
        mine = split
        for k, v in zip(keys, names):
            mine = mine.where(F.col(k) == v)
        scaler = [{"feature": f, "low": parts["train"][f"s{i}"]["low"], "high": parts["train"][f"s{i}"]["high"]}
                  for i, f in enumerate(feats)] if scale else []
        mine = mine.withColumns(scaled(feats, scaler))
        model = MT.train(mine.where("split = 'train'"), feats, label, estimator, seed, **params)
        counts = model.transform(mine.where("split = 'test'")).groupBy(
            F.col(f"`{label}`").cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted")).count()
        counts = [r.asDict() for r in counts.collect()]         # classes x classes
        told = spark.createDataFrame(counts, "actual int, predicted int, count long")
        report = [r.asDict() for r in R.classification_report(told, weight="count").collect()]
        meta = {"features": feats, "target": label, "estimator": estimator, "scaler": scaler, "end_date": max(p["end_date"] for p in parts.values()),
                "parts": [{"split": s, **{c: parts[s][c] for c in ("start_date", "end_date", "size")}} for s in ("train", "test")],
                "report": report, "confusion": counts}
        key = {**dict(zip(keys, names)), "target": label, "type": estimator, "run_id": run_id}
        publish_model(spark, root, key, meta, model)

    with ThreadPool(FITS) as pool:
        pool.map(one, sorted(found.items()))
    return list_models(read_registry(spark, root), target=label, type_=estimator, run_id=run_id)


def predict_with(df: DataFrame, row, out: str = "prediction", prefix: str = "") -> DataFrame:
    """``df`` (batch or stream) with the prediction of the model of a registry row: features scaled by its own
    scaler, then its pipeline or rule. Features are read from columns ``<prefix><feature>``; where one is null or NaN
    the prediction is null."""
    meta = json.loads(row["meta"])
    mine = scaled(meta["features"], meta["scaler"], prefix)
    whole = F.lit(True)
    for c in mine.values():
        whole = whole & c.isNotNull() & ~F.isnan(c)
    if row["type"] == LINEAR_RULE:
        score = F.lit(float(meta["intercept"] or 0.0))
        for f, w in meta["weights"].items():
            score = score + F.lit(float(w)) * mine[f]
        return df.withColumn(out, F.when(whole, (score > 0).cast("int")))
    from pyspark.ml import PipelineModel

    model = PipelineModel.load(f"{row['path']}/model")
    model.stages[0].setHandleInvalid("keep")
    raw = {c: F.col(f"`_raw_{i}`").alias(c) for i, c in enumerate(df.columns)}
    held = df.select(*[F.col(f"`{c}`").alias(f"_raw_{i}") for i, c in enumerate(df.columns)], *[c.alias(f) for f, c in mine.items()],
                     whole.alias("_whole"))
    return model.transform(held).select(*raw.values(), F.when(F.col("_whole"), F.col("prediction").cast("int")).alias(out))


def _judges(row, at: int, target: str) -> tuple[Column, Column]:
    """(whether the model of the row judges a row of the frame, the actual label)."""
    ok = F.col(f"_p{at}").isNotNull()
    if row["end_date"] is not None:
        ok = ok & (F.col("_time") > F.lit(row["end_date"]).cast("timestamp"))
    for k in KEYS:
        if row[k] != "ALL":
            ok = ok & (F.col(f"`{k}`") == F.lit(row[k]))
    return ok, F.col(f"`_x_{target}`").cast("int")


REPORT = "label string, precision double, recall double, f1_score double, support long"


def holdout_reports(spark: SparkSession, root: str, df: DataFrame, time_col: str = "time", **wildcards) -> DataFrame:
    """Every registered model that matches, tested on its instrument's rows after its own end date.

    All models judge one scan of ``df``: each adds its prediction as a column, and one aggregate counts
    (model, actual, predicted). Features, scaler, target and end date come from the registry row. A model with fewer than
    two rows to judge isn't reported; no match gives an empty report. Returns the model's key and its classification report.
    """
    models = list_models(read_registry(spark, root), **wildcards).orderBy(*MODEL_KEY).collect()     # a row a model
    if not models:
        return spark.createDataFrame([], ", ".join(f"{k} string" for k in MODEL_KEY) + ", " + REPORT)
    metas = [json.loads(m["meta"]) for m in models]
    used = sorted({c for m in metas for c in [*m["features"], m["target"]]})
    d = df.select(*[F.col(f"`{k}`") for k in KEYS], as_ts(time_col).alias("_time"), *[F.col(f"`{c}`").alias(f"_x_{c}") for c in used])
    judged = []
    for i, (row, meta) in enumerate(zip(models, metas)):
        d = predict_with(d, row, f"_p{i}", "_x_")
        ok, actual = _judges(row, i, meta["target"])
        judged.append(F.when(ok & actual.isNotNull(), F.struct(F.lit(i).alias("model"), actual.alias("actual"), F.col(f"_p{i}").alias("predicted"))))
    pairs = d.select(F.explode(F.filter(F.array(*judged), lambda x: x.isNotNull())).alias("r")).select("r.*")
    counts = landed(pairs.groupBy("model", "actual", "predicted").count(), "holdout")      # models x classes x classes rows
    report = R.classification_report(counts, weight="count", by=["model"])
    enough = counts.groupBy("model").agg(F.sum("count").alias("n")).where("n >= 2").select("model")
    keys = spark.createDataFrame([(i, *[m[k] for k in MODEL_KEY]) for i, m in enumerate(models)], "model int, " + ", ".join(f"{k} string" for k in MODEL_KEY))
    return report.join(enough, "model", "left_semi").join(keys, "model").select(*MODEL_KEY, "label", "precision", "recall", "f1_score", "support")
