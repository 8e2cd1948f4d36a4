"""Feature selection."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_div
from tidemark.session import landed


def chi2_scores(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Chi-squared statistic of non-negative features against the class.

    observed[c, f] = sum of f over rows of class c; expected[c, f] =
    P(class c) * sum of f; score = sum_c (obs - exp)^2 / exp. One grouped
    aggregate (rows per class) and a tiny reduction. Not ``ChiSquareTest``,
    which treats values as categories. Output: feature, score.
    """
    from pyspark.sql import Window

    feats = list(features)
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"), *[F.sum(c).alias(c) for c in feats])
    # totals over the per-class table (one row per class): a window on a tiny table, no rescan
    everything = Window.partitionBy()
    per_class = per_class.select("*", F.sum("_nc").over(everything).alias("_n"),
                                 *[F.sum(c).over(everything).alias(f"_t_{c}") for c in feats])
    rows = []
    for c in feats:
        exp = F.col("_nc") / F.col("_n") * F.col(f"_t_{c}")
        rows.append(F.struct(F.lit(c).alias("feature"),
                             F.coalesce(safe_div((F.col(c) - exp) * (F.col(c) - exp), exp), F.lit(0.0)).alias("term")))
    terms = per_class.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return terms.groupBy("feature").agg(F.sum("term").alias("score"))


def k_best(scores: DataFrame, k: int) -> DataFrame:
    """O2: top-k features by score desc (ties by name) — a k-row report (E4 K-best)."""
    return scores.orderBy(F.col("score").desc(), "feature").limit(int(k))


def gbt_importances(df: DataFrame, features: Sequence[str], label: str, seed: int = 42, max_iter: int = 20) -> DataFrame:
    """Tree-boosting importances (feature, importance).

    The rows are counted by bins once (see ``cells``); the trees' passes run over the counts.
    """
    from pyspark.ml.classification import GBTClassifier

    from tidemark.operators.ml import cells as CL
    from tidemark.operators.ml.prep import assemble

    table = CL.cells(df, features, label, CL.tree_splits(df, features, seed))
    model = GBTClassifier(featuresCol="features", labelCol=label, weightCol="n", seed=seed, maxIter=max_iter,
                          maxBins=CL.all_bins(table)).fit(assemble(table, features))
    imp = model.featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(list(zip(list(features), [float(x) for x in imp])),
                                           "feature string, importance double")


def rfe_ranking(df: DataFrame, features: Sequence[str], label: str, n_select: int = 1) -> DataFrame:
    """Recursive feature elimination with logistic regression.

    Each round fits on the remaining features (a distributed fit) and drops
    the one with the smallest |coefficient|. Output: feature, ranking
    (1 = selected), like the reference's ranking.
    """
    from pyspark.ml.classification import LogisticRegression

    from tidemark.operators.ml.prep import assemble

    remaining = list(features)
    ranking: dict[str, int] = {}
    rank = len(remaining) - int(n_select) + 1
    while len(remaining) > int(n_select):
        model = LogisticRegression(featuresCol="features", labelCol=label, maxIter=50).fit(assemble(df, remaining))
        coefs = [abs(x) for x in model.coefficients.toArray().tolist()]
        drop = remaining[min(range(len(remaining)), key=lambda i: coefs[i])]
        ranking[drop] = rank
        rank -= 1
        remaining.remove(drop)
    for f in remaining:
        ranking[f] = 1
    return df.sparkSession.createDataFrame(sorted(ranking.items()), "feature string, ranking int")


#: Values of a block whose rows are permuted together.
BLOCK_VALUES = 1 << 21


def _row_blocks(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The rows with all features and the label, dealt at random to blocks of bounded size: ``block, rows`` (arrays).

    The table is landed first; a row's block follows from its place there, so rows that repeat are spread.
    """
    feats = [F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    d = df.select(*feats, F.col(f"`{label}`").cast("double").alias("y")).na.drop()
    d = landed(d, "boruta").withColumn("id", F.monotonically_increasing_id())
    each = max(1, BLOCK_VALUES // (2 * len(features) + 1))
    n = max(1, math.ceil(d.count() / each))
    d = d.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)))
    rows = F.array_sort(F.collect_list(F.struct("id", *[f"x{i}" for i in range(len(features))], "y")))
    return landed(d.groupBy("block").agg(rows.alias("rows")), "boruta")


def with_shadows(blocks: DataFrame, n: int, seed: int) -> DataFrame:
    """``x0..`` the features, ``s0..`` their shadows and ``y``: every feature permuted on its own, in one narrow pass.

    A block is a random part of the rows, so a permutation within blocks breaks what ties a feature to the label
    just as one over all rows does, and keeps its values.
    """
    names = [f"x{i}" for i in range(n)]

    def permute(batches):
        for batch in batches:
            for block, rows in zip(batch.column("block").to_pylist(), batch.column("rows")):
                rows = rows.values
                columns = {c: rows.field(c) for c in [*names, "y"]}
                for i in range(n):
                    order = np.random.default_rng((seed, block, i)).permutation(len(rows))
                    columns[f"s{i}"] = columns[f"x{i}"].take(pa.array(order))
                for at in range(0, len(rows), 1 << 16):
                    yield pa.record_batch({c: v.slice(at, 1 << 16) for c, v in columns.items()})

    schema = ", ".join(f"{c} double" for c in [*names, "y", *[f"s{i}" for i in range(n)]])
    return blocks.mapInArrow(permute, schema)


def boruta(df: DataFrame, features: Sequence[str], label: str, key: Sequence[str] = (), rounds: int = 10, seed: int = 42,
           alpha: float = 0.05, trees: int = 20, depth: int = 5) -> DataFrame:
    """Boruta with random-forest importances.

    Every round trains a shallow forest (depth 5, classes weighted to balance) on the features and a permuted shadow of
    each; a feature scores a hit when its importance beats the best shadow. A binomial test over ``rounds``
    (p = 1/2), corrected for the number of features, decides: confirmed / rejected / tentative. The rows are told by
    bins, whose split points come from all of them, and shuffled once, into blocks; a round permutes within them. Rows
    with a null or NaN feature or label take no part; ``key`` is not needed any more. Output: feature, hits, decision.
    """
    from tidemark.operators.ml import cells as CL
    from tidemark.operators.ml import forest as FO

    feats = list(features)
    alpha = alpha / max(1, len(feats))
    names = [f"x{i}" for i in range(len(feats))]
    rows = df.select(*[F.col(f"`{f}`").cast("double").alias(x) for f, x in zip(feats, names)], F.col(f"`{label}`").cast("double").alias("y"))
    rows = landed(rows.na.drop(), "boruta")
    blocks = _row_blocks(CL.binned(rows, names, "y", CL.row_splits(rows, names)), names, "y")
    counts = rows.groupBy("y").count().orderBy("y").collect()   # a row a class
    classes, total = [r["y"] for r in counts], sum(r["count"] for r in counts)
    weights = [total / (len(counts) * r["count"]) for r in counts]
    hits = {f: 0 for f in feats}
    for r in range(int(rounds) if len(counts) > 1 else 0):
        # kept: the passes over a round's rows read them, they don't permute again
        made = FO.pack(with_shadows(blocks, len(feats), seed + r), [f"{x}{i}" for x in "xs" for i in range(len(feats))], "y", classes)
        made = FO.dealt(made, total, 2 * len(feats)).persist(StorageLevel.DISK_ONLY)
        imp = FO.importances(FO.grow(made, 2 * len(feats), weights, trees, depth, seed + r), 2 * len(feats))
        made.unpersist(blocking=True)
        best_shadow = max(imp[len(feats):])
        for i, f in enumerate(feats):
            hits[f] += imp[i] > best_shadow
    n = int(rounds)

    def at_least(k: int) -> float:  # P(X >= k), X ~ Binomial(n, 1/2)
        return sum(math.comb(n, j) for j in range(k, n + 1)) / 2 ** n

    rows = []
    for f in feats:
        sure, not_at_all = at_least(hits[f]) < alpha, 1 - at_least(hits[f] + 1) < alpha
        rows.append((f, hits[f], "confirmed" if sure else "rejected" if not_at_all else "tentative"))
    return df.sparkSession.createDataFrame(rows, "feature string, hits int, decision string")


def drop_zero_importance(importances: DataFrame) -> DataFrame:
    """Features with a non-zero importance."""
    return importances.where(F.col("importance") != F.lit(0.0))


def univariate_selector(mode: str = "fwe", threshold: float = 0.05, features_col: str = "features",
                        label: str = "label", output_col: str = "selected"):
    """SelectFwe / SelectPercentile (F-test) as MLlib UnivariateFeatureSelector."""
    from pyspark.ml.feature import UnivariateFeatureSelector

    sel = UnivariateFeatureSelector(featuresCol=features_col, labelCol=label, outputCol=output_col,
                                    selectionMode=mode)
    sel.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(threshold)
    return sel


def variance_selector(threshold: float = 0.0, features_col: str = "features", output_col: str = "selected"):
    """VarianceThreshold."""
    from pyspark.ml.feature import VarianceThresholdSelector

    return VarianceThresholdSelector(featuresCol=features_col, outputCol=output_col, varianceThreshold=threshold)


def intersect_features(*lists: Sequence[str]) -> list[str]:
    """Features chosen by every selector (order of the first list)."""
    common = set(lists[0]).intersection(*[set(x) for x in lists[1:]]) if lists else set()
    return [f for f in lists[0] if f in common] if lists else []
