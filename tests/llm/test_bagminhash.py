import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemark.llm import bagminhash as B


def bag(text):
    w = (text or "").split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    a, b = bag(a), bag(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes(rows):
    """By definition: all pairs, transitively; least doc_id of each class."""
    low = {i: i for i, _ in rows}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for i, a in rows:
        for j, b in rows:
            if i < j and similarity(a, b) >= 0.8:
                x, y = sorted((top(i), top(j)))
                low[y] = x
    return {i: top(i) for i in low}


def family(rnd, words, n, edits):
    out = [words]
    for _ in range(n - 1):
        w = list(rnd.choice(out))
        for _ in range(edits):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        out.append(w)
    return [" ".join(w) for w in out]


def test_against_definition(spark):
    """Families whose members drift apart, so that classes hold pairs below the threshold; repeated words."""
    rnd = random.Random(3)
    texts = []
    for k in range(6):
        texts += family(rnd, [f"{k}x{rnd.randrange(400)}" for _ in range(200)], 12, 1 + k % 4)
    texts += ["ha " * n for n in (40, 44, 60, 200, 230)] + ["", "one two", "one two", "one two three"]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.class_id for r in B.near_duplicate_classes(df).collect()}
    assert found == classes(rows)


def test_signature_estimates_weighted_jaccard():
    a, b = "p q r s t u v w " * 30, "p q r s t u v w " * 24 + " ".join(f"z{i}" for i in range(40))
    doc, g, count, n = B.bags(pa.array([a, b]))
    s = B.signatures(doc, g, count, n, 4096)
    assert abs(float((s[0] == s[1]).mean()) - similarity(a, b)) < 0.03


def test_mixed_bucket_blocks_lose_no_pair():
    """Every pair of different components in a bucket is seen by some block pair."""
    sig, keys = np.zeros(B.LONG, np.uint8).tobytes(), np.arange(B.BANDS, dtype=np.uint32).tobytes()
    t = pa.table({"band": [0] * 4, "node": [1, 2, 3, 4], "component": [1, 1, 3, 4], "sig": [sig] * 4, "keys": [keys] * 4,
                  "side": [2, 2, 2, 2]})
    out = B._across(t)
    assert set(zip(out["u"].to_pylist(), out["v"].to_pylist())) == {(1, 3), (1, 4), (2, 3), (2, 4), (3, 4)}
    later = t.set_column(0, "band", pa.array([7] * 4))
    assert B._across(later).num_rows == 0      # they met in an earlier band


def test_odd_rows(odd_docs, no_docs):
    out = {(r.doc_id, r.class_id) for r in B.near_duplicate_classes(odd_docs).collect()}
    assert out == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (None, None), (7, 7), (8, 7), (9, 9), (10, 10), (11, 11)}
    assert B.near_duplicate_classes(odd_docs).count() == odd_docs.count()
    assert B.near_duplicate_classes(no_docs).collect() == []
