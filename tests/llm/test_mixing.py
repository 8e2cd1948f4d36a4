import random
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import mixing as M


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by definition: share by weight, limit, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    limited = {}
    while True:
        open_ = [s for s in order if s not in limited]
        rest = share * sum(sizes.values()) - sum(limited.values())
        got = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if got[s] > most * sizes[s]]
        if not over:
            return limited | got
        limited |= {s: most * sizes[s] for s in over}


def test_targets(spark):
    sizes = {"b": 1000, "a": 10, "é": 500, "Z": 70, None: 300, "zz": 0, "𐍈": 90, "z": 2000}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    want = filled(sizes)
    assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes)


def test_mix_meets_targets(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(["w"] * min(3000, int(rnd.lognormvariate(4, 1.2)))), rnd.choice(["a", "a", "a", "b", "c", "d", None]))
            for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    a = M.mix_sources(df).collect()
    assert sorted(r.doc_id for r in a) == list(range(1500))
    assert {(r.doc_id, r.copies) for r in a} == {(r.doc_id, r.copies) for r in M.mix_sources(df.repartition(7)).collect()}
    sizes, taken, target, mean = defaultdict(int), defaultdict(int), {}, {}
    for r in a:
        assert r.size == len(rows[r.doc_id][1].split()) and 0 <= r.copies <= 2 and r.taken == r.copies * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    want = filled(sizes)
    for s in sizes:
        assert abs(want[s] - target[s]) < 1e-6 * sizes[s]
        n = sum(1 for r in a if r.source == s)
        assert abs(taken[s] - target[s]) <= 2 * sizes[s] / n, s   # a document or two of mean size


def test_rounding_is_unbiased(spark):
    """Over many seeds every document is taken as often as its fraction says."""
    units = spark.createDataFrame([("s", i, 1, size, 0.3, 40.0) for i, size in enumerate([10, 500, 20, 30, 45, 60, 7, 90])],
                                  "source string, doc_id long, nth int, size long, ratio double, mean double")
    folded = units.withColumn("p", F.col("ratio")).groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "nth", "size", "p"))).alias("units"))
    total, runs = defaultdict(float), 300
    columns = [M._fold(F.col("units"), seed, 0).alias(f"f{seed}") for seed in range(runs)]
    for i in range(0, runs, 50):
        row = folded.select(*columns[i : i + 50]).first()
        for f in row:
            done = list(f.done) + ([f.left] if f.left else [])
            assert abs(sum(u.size * u.p for u in done) - 0.3 * 762) < 1e-6      # words are kept exactly
            assert all(u.p in (0.0, 1.0) for u in f.done) and len(done) == 8
            for u in done:
                total[u.doc_id] += u.p / runs
    assert all(abs(total[i] - 0.3) < 0.1 for i in range(8))


def test_odd_rows(odd_docs, no_docs):
    out = M.mix_sources(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(r.taken <= 2 * r.size for r in out)
    assert sorted((r.nth for r in out if r.doc_id == 5)) == [1, 2]
    assert [r.size for r in out if r.doc_id in (1, 2, 3)] == [0, 0, 0]
    assert M.mix_sources(no_docs).collect() == []
