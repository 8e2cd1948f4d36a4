"""Random forests over rows told by bins (N1, E7): MLlib's forest, counted and packed."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ml import cells as CL
from tidemark.operators.ml import forest as FO
from tidemark.operators.ml import select as MS

FEATS = ["a", "b", "c", "e"]


@pytest.fixture(scope="module")
def d(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(20000, 4))
    x[:, 2], x[:, 3] = rng.integers(0, 6, 20000), x[:, 3].round(1)
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + 0.3 * x[:, 3] + rng.normal(size=20000) > 0.7).astype(int)
    path = str(tmp_path_factory.mktemp("forest") / "rows")
    spark.createDataFrame(pd.DataFrame(x, columns=FEATS).assign(label=y)).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def test_draws_are_poisson():
    import math

    got = np.bincount(FO.draws((1, 2, 3), 2_000_001, None), minlength=13) / 2_000_001
    assert len(got) == 13 and got[:6] == pytest.approx([math.exp(-1) / math.factorial(k) for k in range(6)], abs=2e-3)
    exact = [math.exp(-1) / math.factorial(k) for k in range(12)]
    assert np.diff([0, *FO.LIMITS[:12].astype(float)]) / 2**32 == pytest.approx(exact, abs=1e-9)
    n = np.array([1, 50, 10**6] * 1000)
    assert FO.draws((4,), 3000, n).reshape(-1, 3).mean(axis=0) == pytest.approx([1, 50, 10**6], rel=0.1)


@pytest.mark.parametrize("counted", [False, True])
def test_a_forest_finds_what_mllibs_finds(spark, d, counted):
    from pyspark.ml.classification import RandomForestClassifier

    from tidemark.operators.ml.prep import assemble

    splits = CL.row_splits(d, FEATS)
    rows = CL.binned(d, FEATS, "label", splits)
    kept = CL.cells(d, FEATS, "label", splits).sortWithinPartitions(*FEATS, "label") if counted else rows
    packed = FO.pack(kept, FEATS, "label", [0.0, 1.0], "n" if counted else None).persist()
    forest = FO.grow(packed, 4, [1.0, 2.0], 20, 5, 3)
    again = FO.grow(packed, 4, [1.0, 2.0], 20, 5, 3)
    packed.unpersist()
    assert [t.feature for t in again] == [t.feature for t in forest] and [t.cut for t in again] == [t.cut for t in forest]
    own = FO.predicted(rows, FEATS, ["label"], forest, [0.0, 1.0]).agg(F.avg((F.col("prediction") == F.col("label")).cast("int")), F.avg("prediction")).first()
    weighted = assemble(d, FEATS).withColumn("w", F.col("label") + 1.0)
    model = RandomForestClassifier(labelCol="label", weightCol="w", numTrees=20, maxDepth=5, seed=3).fit(weighted)
    ml = model.transform(weighted).agg(F.avg((F.col("prediction") == F.col("label")).cast("int")), F.avg("prediction")).first()
    assert own[0] == pytest.approx(ml[0], abs=0.02) and own[0] > 0.75 and own[1] == pytest.approx(ml[1], abs=0.04)
    assert FO.importances(forest, 4) == pytest.approx(model.featureImportances.toArray().tolist(), abs=0.04)


def test_sibling_leaves_that_predict_alike_become_one():
    tree = FO.Tree()
    tree.feature[0], tree.cut[0], tree.left[0], tree.sums[0], tree.gain[0] = 0, 3, 1, np.array([9.0, 5.0]), 0.1
    tree.add(np.array([8.0, 1.0])), tree.add(np.array([1.0, 4.0]))
    tree.feature[1], tree.cut[1], tree.left[1], tree.gain[1] = 1, 2, 3, 0.01
    tree.add(np.array([5.0, 0.0])), tree.add(np.array([3.0, 1.0]))
    tree.prune()
    assert tree.feature[:3] == [0, -1, -1] and FO.importances([tree], 2) == [1.0, 0.0]


def test_boruta_grows_its_forests_over_packed_rows(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    monkeypatch.setattr(RandomForestClassifier, "fit", None)                       # a fit on rows took minutes a round
    rng = np.random.default_rng(0)
    rows = [(float(x), float(y), int(x + 0.3 * e > 0)) for x, y, e in rng.normal(size=(3000, 3))]
    d = spark.createDataFrame([*rows, (None, 0.0, 1), (float("nan"), 0.0, 0)], "good double, noise double, label int")
    got = {r["feature"]: r["decision"] for r in MS.boruta(d, ["good", "noise"], "label", rounds=8).collect()}
    assert got["good"] == "confirmed" and got["noise"] != "confirmed"
    one = MS.boruta(d.where("label = 1"), ["good", "noise"], "label", rounds=8).collect()
    assert [(r["hits"], r["decision"]) for r in one] == [(0, "rejected")] * 2      # nothing to tell apart
    assert MS.boruta(d.where("false"), ["good"], "label").collect()[0]["hits"] == 0
