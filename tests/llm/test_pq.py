import numpy as np

from tidemark.llm import pq as P


def brute(rows):
    ids = sorted({i for i, _, _ in rows if i is not None})
    low, links = {i: i for i in ids}, {i: 0 for i in ids}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    good = [(i, np.array(v, float), label) for i, v, label in rows
            if i is not None and label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    for i, v, label in good:
        for j, w, other in good:
            if i != j and label == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93:
                links[i] += 1
                x, y = sorted((top(i), top(j)))
                low[y] = x
    return {i: (links[i], top(i)) for i in ids}


def rows_of(rng, n=600, dim=16):
    centre = rng.normal(size=(20, dim))
    out = []
    for i in range(n):
        v = centre[rng.integers(20)] + rng.normal(size=dim) * rng.choice([0.05, 0.3, 2.0])
        out.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    out += [(n + k, out[k][1], out[k][2]) for k in range(30)] + [(n + 50 + k, out[5][1], out[5][2]) for k in range(40)]
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0, 2.0], [2.0, 4.0]]
    out += [(n + 200 + k, v, 1) for k, v in enumerate(odd)] + [(n + 300, out[5][1], None), (n + 301, [1e-30, 2e-30], 1), (n + 302, [3e30, 6e30], 1)]
    return out


def test_links_and_components(spark, monkeypatch):
    """Small lists and blocks, so that links cross both; all links are found here, none is wrong."""
    monkeypatch.setattr(P, "LIST_ROWS", 20)
    monkeypatch.setattr(P, "BLOCK", 16)
    rows = rows_of(np.random.default_rng(7))
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, node int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in P.near_duplicate_vectors(df).collect()}
    want = brute(rows)
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(x[0] for x in got.values()) >= 0.99 * sum(x[0] for x in want.values())
    assert sum(got[i] != want[i] for i in want) <= 0.02 * len(want)
    big = max(x[0] for x in want.values())
    assert big >= 40


def test_every_link_of_a_dense_group(spark, monkeypatch):
    """A third of all rows are distinct near copies that fill many lists; none of their links is lost."""
    monkeypatch.setattr(P, "LIST_ROWS", 30)
    monkeypatch.setattr(P, "PAIRS", 1 << 10, raising=False)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 64))
    x[:300] = x[0] + 0.24 * rng.normal(size=(300, 64))        # some pairs below the threshold, most above
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x[rng.permutation(900)].astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    want = brute(rows)
    assert 30_000 < sum(n for n, _ in want.values()) < 89_000
    assert {r.vec_id: (r.n_links, r.component_id) for r in P.near_duplicate_vectors(df).collect()} == want


def test_no_links(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert P.near_duplicate_vectors(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(1, None, 1), (None, [1.0], 1), (2, [1.0], None)], schema)
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in P.near_duplicate_vectors(df).collect())
    assert got == [(0, 0, None, True), (1, 0, 1, True), (2, 0, 2, True)]


def test_doubles_keep_their_precision_and_repeated_rows_count_once(spark):
    c = 0.93
    near, below = [c + 1e-9, float(np.sqrt(1 - c * c))], [c - 1e-9, float(np.sqrt(1 - c * c))]
    rows = [(1, [1.0, 0.0], 1), (2, near, 1), (3, [1.0, 0.0], 2), (4, below, 2), (5, [1e39, 0.0], 3), (6, [1e39, 1.0], 3),
            (7, [0.0, 2.0], 4), (7, [0.0, 2.0], 4), (8, [0.0, 3.0], 4), (9, [1.0, 1e-12], 5), (10, [1.0, 2e-12], 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in P.near_duplicate_vectors(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (1, 7), 8: (1, 7), 9: (1, 9), 10: (1, 9)}
