"""Quality grades and toxicity: fit on one part, judge on another, and by definition on small chains."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import quality as Q
from tidemark.llm import toxicity as X

BAD = ["blorn", "krat", "snorp"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        w = ["".join(rnd.choices(["ta", "li", "mo", "re", "su"], k=rnd.randint(1, 4))) for _ in range(rnd.randint(8, 60))]
        toxic, quality = int(rnd.random() < 0.3), int(rnd.random() < 0.8)
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                w[rnd.randrange(len(w))] = rnd.choice(BAD) + rnd.choice(["", "a", "i", "o", "."])
        if not quality:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x for x in w for _ in range(6)]
        out.append((i, " ".join(w), quality, toxic))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t, _, _ in rows], "doc_id long, text string, score string, p_usable int")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows if i < 600] + [(None, 1, 0), (7000, None, None), (3, None, 1)],
                                   "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_quality_on_held_out(tables):
    rows, docs, labels = tables
    out = {r.doc_id: r for r in Q.grade_documents(docs, Q.fit_grader(docs, labels)).collect()}
    held = [r for r in rows if r[0] >= 600]
    right = sum((out[i].p_usable >= 0.5) == bool(q) for i, _, q, _ in held) / len(held)
    assert right > 0.97
    grade = [0 if not q else 2 - x for _, _, q, x in held]
    assert np.corrcoef(grade, [out[r[0]].expected_grade for r in held])[0, 1] > 0.8
    assert all(0 <= out[i].p_usable <= 1 and 0 <= out[i].expected_grade <= 2 for i in out)


def test_thresholds_are_ordered_and_probabilities_add_up():
    rows = corpus(300, 2)
    g = Q.fit([t for _, t, _, _ in rows], np.array([0 if not q else 2 - x for _, _, q, x in rows]))
    assert (np.diff(g.thresholds) > 0).all()
    a = g.above(np.linspace(-5, 5, 11))
    assert (np.diff(a, axis=1) <= 0).all()


def test_toxicity_on_held_out(tables):
    rows, docs, labels = tables
    out = {r.doc_id: r for r in X.score_toxicity(docs, X.train_field(docs, labels)).collect()}
    held = [r for r in rows if r[0] >= 600]
    assert sum((out[i].score >= 0.3) == bool(x) for i, _, _, x in held) / len(held) > 0.97
    for i, t, _, x in held:
        for s in out[i].spans:
            if x:
                assert any(b in t[s.start : s.end].lower() for b in BAD)


def test_marginals_by_definition():
    """Forward-backward ratios against the sum over all labelings, on several short documents at once."""
    rng = np.random.default_rng(0)
    texts = ["a b c d", "", "e", "f g h i j k", None, "l m"]
    w, f = X.features(pa.array(texts))
    field = X.Field(np.zeros(1 << X.BITS), np.array([-0.7, 0.9, 0.3]), np.zeros(3))
    field.weights[f.ravel()] = rng.normal(size=f.size)
    p, e = field.marginals(f, w), field.emissions(f)
    a, b, s = field.chain
    for d in range(len(texts)):
        i, j = w.first[d], w.first[d + 1]
        total, on = 0.0, np.zeros(j - i)
        for y in itertools.product((0, 1), repeat=int(j - i)):
            score = sum(e[i + k] for k in range(j - i) if y[k])
            score += sum(b if u and v else a if v else 0 for u, v in zip(y, y[1:])) + (s if y and y[0] else 0)
            total += np.exp(score)
            on += np.exp(score) * np.array(y, float)
        assert np.allclose(p[i:j], on / total)


def test_odd_rows(odd_docs, no_docs, tables):
    _, docs, labels = tables
    field, grader = X.train_field(docs, labels), Q.fit_grader(docs, labels)
    for df in (odd_docs, no_docs):
        n = df.count()
        a, b = X.score_toxicity(df, field).collect(), Q.grade_documents(df, grader).collect()
        assert len(a) == len(b) == n
        assert all(0 <= r.score <= 1 for r in a) and all(0 <= r.p_usable <= 1 for r in b)
    empty = [r for r in X.score_toxicity(odd_docs, field).collect() if r.doc_id in (1, 2, 3)]
    assert len({r.score for r in empty}) == 1 and all(r.spans == [] and r.score < 0.3 for r in empty)


def test_no_labels(tables):
    _, docs, labels = tables
    none = labels.limit(0)
    assert all(0 <= r.score <= 1 for r in X.score_toxicity(docs.limit(5), X.train_field(docs, none)).collect())
    assert Q.grade_documents(docs.limit(5), Q.fit_grader(docs, none)).count() == 5


def test_a_fit_takes_a_bounded_part_of_the_labelled_texts(spark, monkeypatch):
    from tidemark.llm import common
    from tidemark.llm.quality import fit_grader

    rows = [(1, f"text number {i} " * 20) for i in range(200)] + [(2, "long " * 60_000), (3, None), (4, "a b c"), (5, "d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], "doc_id long, grade int")
    got = common.labelled_texts(docs, known, "grade")
    assert [r.doc_id for r in got] == [1, 3, 4, 5]                   # one row for 1, none for the long text
    assert got[0].text in {t for _, t in rows} and got[1].text == ""
    monkeypatch.setattr(common, "TRAIN_BYTES", 5)
    assert [len(r.text) for r in common.labelled_texts(docs, known, "grade")] in ([0, 5], [5], [0], [5, 0], [])
    monkeypatch.undo()
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (3, 1, 1), (4, 1, 0), (5, 0, 0)], "doc_id long, quality int, toxic int")
    assert fit_grader(docs, labels).thresholds.size == 2
