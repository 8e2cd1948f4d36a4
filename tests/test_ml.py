"""MLlib edges: registry round trip (K11, S13, N5, X3, X4), selectors, grid search, stream replay."""

import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ml import prep as MP
from tidemark.operators.ml import select as MS
from tidemark.operators.ml import train as MT
from tidemark.sources.adapters import LINEITEM_FEATURES, dataset_from_lineitem, table

SF = "/root/testdata/sf0.001"
FEATS = list(LINEITEM_FEATURES)


@pytest.fixture(scope="module")
def ds(spark):
    d = dataset_from_lineitem(table(spark, SF, "lineitem"))
    return d.withColumn("time", F.timestamp_seconds(F.col("l_orderkey") * 60 + F.col("l_linenumber"))) \
            .withColumn("exchange", F.lit("SIM")).withColumn("symbol", F.lit("LI"))


def test_selectors_and_preprocessors(spark, ds):
    d = MP.assemble(ds, FEATS)
    sel = MS.variance_selector(0.0).fit(d)
    assert len(sel.selectedFeatures) == len(FEATS)
    uni = MS.univariate_selector("numTopFeatures", 2, label="label").fit(d)
    assert len(uni.selectedFeatures) == 2
    for name in MP.PREPROCESSORS:
        stage = MP.preprocessor(name)
        out = (stage.fit(d) if hasattr(stage, "fit") else stage).transform(d)
        assert "scaled" in out.columns
    zc = ds.select(MP.zero_count(FEATS).alias("z")).agg(F.max("z")).first()[0]
    assert zc is not None and zc >= 0


def test_zero_count_and_one_hot_over_vectors(spark):
    from pyspark.ml.functions import vector_to_array

    from tidemark.operators.ml.stages import VectorOneHot

    rows = [(0.0, 3.0, float(i)) for i in range(60)] + [(2.0, 0.0, 100.0 + i) for i in range(35)] + [(5.0, 3.0, -1.0)] * 5
    d = MP.assemble(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"])
    arr = lambda df: [r[0] for r in df.select(vector_to_array("scaled")).collect()]
    got = arr(MP.preprocessor("ZeroCount").transform(d))
    assert got[0] == [2.0, 1.0, 0.0, 3.0, 0.0] and got[60] == [1.0, 2.0, 2.0, 0.0, 100.0] and len(got) == 100
    model = VectorOneHot(threshold=5, minimumFraction=0.1).fit(d)
    assert model.values == {0: [0.0, 2.0], 1: [0.0, 3.0]}              # 5.0 is rare, c has too many values
    got = arr(model.transform(d))
    assert got[7] == [1, 0, 0, 0, 1, 0, 7.0] and got[60] == [0, 1, 0, 1, 0, 0, 100.0] and got[99] == [0, 0, 1, 0, 1, 0, -1.0]


def test_select_from_model_inside_a_search(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(i, *map(float, r), int(r[1] + r[2] > 0)) for i, r in enumerate(rng.normal(size=(600, 4)))]
    d = spark.createDataFrame(rows, "id int, a double, b double, c double, e double, label int")
    inner = MT.estimator("DecisionTreeClassifier", maxDepth=4)
    cv = MT.grid_search(d, ["a", "b", "c", "e"], "label", "LogisticRegression", {"regParam": [0.0, 0.1]}, ["id"], folds=2,
                        select=inner, thresholds=["mean", "q1.0"])
    assert len(cv.avgMetrics) == 4
    assert cv.bestModel.stages[1].selected == [1, 2]                   # the mean keeps both that matter, q1.0 only one
    assert cv.bestModel.transform(d).where("prediction = label").count() > 560


def test_grid_search_and_importance(spark, ds):
    cv = MT.grid_search(ds, FEATS, "label", "DecisionTreeClassifier", {"maxDepth": [2, 4]},
                        ["l_orderkey", "l_linenumber"], folds=3)
    assert len(cv.avgMetrics) == 2
    imp = MT.feature_importance(cv.bestModel, FEATS)
    assert len(imp) == len(FEATS) and abs(sum(v for _, v in imp) - 1.0) < 1e-6 or sum(v for _, v in imp) == 0


def test_nearest_centroid_fixture(spark):
    d = spark.createDataFrame([(0.0, 0.0, 0), (0.2, 0.0, 0), (5.0, 5.0, 1), (4.8, 5.2, 1), (2.4, 2.4, 0)],
                              "a double, b double, label int")
    m = MT.NearestCentroid(["a", "b"], "label").fit(d)
    preds = [r["prediction"] for r in m.transform(d).collect()]
    assert preds[:4] == [0, 0, 1, 1]


def test_boruta_confirms_a_planted_feature_and_rejects_noise(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = [(float(x), float(y), float(z), int(x + 0.3 * e > 0)) for x, y, z, e in rng.normal(size=(3000, 4))]
    d = spark.createDataFrame(rows + [(None, 0.0, 0.0, 1)], "good double, noise double, other double, label int")
    got = {r["feature"]: r["decision"] for r in MS.boruta(d, ["good", "noise", "other"], "label", rounds=8).collect()}
    assert got["good"] == "confirmed" and got["noise"] != "confirmed" and got["other"] != "confirmed"


def test_shadows_are_permutations_of_the_whole_column(spark, monkeypatch):
    monkeypatch.setattr(MS, "BLOCK_VALUES", 500)
    d = spark.range(1000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"), (F.col("id") % 2).alias("label"))
    blocks = MS._row_blocks(d, ["a", "b"], "label")
    assert blocks.count() >= 8
    got = MS.with_shadows(blocks, 2, 1).toPandas()
    assert sorted(got.s0) == sorted(got.x0) == list(range(1000)) and sorted(got.s1) == sorted(got.x1)
    assert (got.s0 != got.x0).mean() > 0.9 and ((got.x0 % 3) == got.x1).all() and ((got.x0 % 2) == got.y).all()


def test_replay_stream_counts_every_row(spark, tmpdir_path):
    from tidemark.sinks.writers import write_ticks
    from tidemark.sources.adapters import quotes
    from tidemark.streaming.replay import replay, replay_stream

    q = quotes(spark, SF)
    root = f"{tmpdir_path}/ticks"
    write_ticks(q, root)
    seen = []

    def cb(batch, epoch):
        seen.append(batch.count())

    s = replay_stream(spark, root, cb, tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"), max_files_per_trigger=20)
    s.awaitTermination(300)
    assert sum(seen) == q.count() and len(seen) > 1
    r = replay([q.where("symbol = 'view'"), q.where("symbol = 'click'").drop("bid_qty")])
    assert r.count() == q.where("symbol in ('view', 'click')").count() and "bid_qty" in r.columns


def test_boosting_over_counted_bins_finds_what_it_finds_on_the_rows(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    from tidemark.operators.ml.prep import assemble

    rng = np.random.default_rng(3)
    a, b, c = rng.normal(size=30000), rng.integers(0, 4, 30000), rng.integers(0, 60, 30000)
    y = ((a + b / 2 + rng.normal(size=30000)) > 1).astype(int)
    rows = [(float(p), float(q), float(r), int(s)) for p, q, r, s in zip(a, b, c, y)]       # enough rows for MLlib to sample
    d = spark.createDataFrame([*rows, (None, 1.0, 1.0, 1)], "a double, b double, c double, label int").repartition(3)
    d.write.parquet(path := tempfile.mkdtemp(prefix="tidemark-test-", dir="/tmp") + "/rows")
    d = spark.read.parquet(path)
    plain = GBTClassifier(labelCol="label", seed=5, maxIter=3).fit(assemble(d, ["a", "b", "c"])).featureImportances.toArray()
    fitted = []
    real = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *k: fitted.append(df.count()) or real(self, df, *k))
    got = {r["feature"]: r["importance"] for r in MS.gbt_importances(d, ["a", "b", "c"], "label", seed=5, max_iter=3).collect()}
    assert [got[f] for f in "abc"] == pytest.approx(plain.tolist(), abs=1e-6)
    assert fitted[0] < 16000                                       # cells (32 x 4 x 32 bins x 2 labels at most), not rows


def test_a_round_of_boruta_makes_its_rows_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    real = MS.with_shadows

    def counted(blocks, n, seed):
        d = real(blocks, n, seed)

        def count(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        return d.mapInArrow(count, d.schema)

    monkeypatch.setattr(MS, "with_shadows", counted)
    d = spark.range(2000).select((F.col("id") % 37).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("label"))
    held = set(spark.sparkContext._jsc.getPersistentRDDs())
    MS.boruta(d, ["a"], "label", rounds=1, trees=2, depth=2)
    assert made.value == 2000
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= held
