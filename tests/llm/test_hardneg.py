"""Hard negatives against brute force, and the early stop of the threshold algorithm."""

import math

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import hardneg
from tidemark.llm.hardneg import Block, hard_negatives

#: Names that the operator uses inside, as extra columns of the input.
CLASH = ["id", "dim", "n", "labels", "head", "rows", "copies", "score", "other", "place", "nth", "group", "block", "anchor_id"]
SCHEMA = "vec_id long, label int, embedding array<double>"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every, positives=5, negatives=10, low=30, high=90, scale=256):
    """Row by row, in Python integers."""
    use = []
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x * scale) for x in v):
            use.append((i, label, [math.floor(scale * x) for x in v]))
    out = []
    for n, (i, label, a) in enumerate(use):
        if i % every:
            continue
        scored = [(j, other, sum(x * y for x, y in zip(a, b))) for m, (j, other, b) in enumerate(use) if m != n and len(b) == len(a)]
        scored.sort(key=lambda r: (-r[2], r[0]))
        for j, _, s in [r for r in scored if r[1] == label][:positives]:
            inside = [r for r in scored if r[1] != label and low * s <= 100 * r[2] <= high * s][:negatives]
            out += [(i, j, rank, r[0], s, r[2]) for rank, r in enumerate(inside, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(*OUT).collect())


def vectors(n, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, int(rng.integers(0, 3)), rng.normal(0, 0.3, dim).round(2).tolist()) for i in range(n)]


def test_equals_brute_force_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 40)
    monkeypatch.setattr(hardneg, "ANCHOR_ROWS", 7)
    monkeypatch.setattr(hardneg, "RUN_ROWS", 90)
    rows = vectors(400)
    want = brute(rows, 10)
    assert want and got(hard_negatives(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0)) == want


def test_ties_repeats_nulls_and_clashing_columns(spark):
    rows = vectors(60, dim=3, seed=1)
    rows += [rows[0], rows[0], rows[5], (5, 2, rows[6][2]), (200, 1, None), (201, None, [0.1, 0.2, 0.3]), (None, 1, [0.1, 0.2, 0.3]),
             (202, 0, [0.1, None, 0.2]), (203, 0, [0.1, math.nan, 0.2]), (204, 0, [math.inf, 0.0, 0.0]), (210, 1, [0.0, 0.0, 0.0]),
             (220, 1, []), (221, 1, []), (222, 2, []), (230, 0, [0.5]), (231, 0, [0.25]), (232, 1, [0.125]),
             (240, 0, [3e15, 1.0, 1.0]), (241, 0, [2e15, 1.0, 3.0]), (242, 1, [1e15, 5.0, 1.0])]
    rows += [(300 + i, i % 2, [0.3, 0.3, 0.3]) for i in range(30)]          # all tie
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    top = (1 << 63) - 1
    want = [r for r in brute(rows, 10) if max(map(abs, r[4:])) <= top]
    assert [r for r in got(hard_negatives(df, F.col("vec_id") % 10 == 0)) if max(map(abs, r[4:])) < top] == want
    assert hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_reading_stops_before_the_lists_end(monkeypatch):
    rng = np.random.default_rng(3)
    rows = np.floor(256 * rng.normal(0, 0.01, (2000, 4)))
    rows[:20] += 500
    lists = np.argsort(rows, axis=0, kind="stable").T.astype(np.uint16)
    block = Block(np.arange(2000), np.zeros(2000, int), np.ones(2000, int), rows, lists)
    scored = []
    real = Block._scores
    monkeypatch.setattr(Block, "_scores", lambda self, at, a: scored.append(len(at)) or real(self, at, a))
    a = np.array([3.0, -0.0, 2.0, 1.0])
    at, score = block.search(a, np.ones(2000, bool), [(-np.inf, np.inf)], 5, [np.zeros(0)])[0]
    assert at.tolist() == sorted(range(2000), key=lambda i: (-(rows[i] @ a), i))[:5]
    assert score.tolist() == [rows[i] @ a for i in at] and sum(scored) < 500
