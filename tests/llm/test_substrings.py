import re

import pytest

from tidemark.llm import substrings as S

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, window):
    """(doc_id, n_words, n_removed, kept) by definition; rows in (doc_id, text) order, null first."""
    seen, out = set(), []
    for i, t in sorted(((-1 if i is None else i), t or "") for i, t in rows):
        w = WORD.findall(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            if k in seen:
                gone[p : p + window] = [True] * window
            seen.add(k)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out)


def got(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect())


@pytest.mark.parametrize("group_bytes", [2000, 1 << 20])
def test_against_definition(spark, monkeypatch, group_bytes):
    """Documents of shared passages, whatever the groups they fall into."""
    import random

    monkeypatch.setattr(S, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(S, "BUCKET_BYTES", group_bytes)
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "ßü"]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.randint(15, 70))] for _ in range(12)]
    rows = []
    for i in range(90):
        text = []
        for _ in range(rnd.randint(0, 4)):
            text += rnd.choice(passages)[rnd.randint(0, 10) :] if rnd.random() < 0.6 else rnd.choices(vocabulary, k=25)
        rows.append((i, rnd.choice([" ", "\n", "  \t"]).join(text)))
    rows.append((200, "a b " * 300))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(S.dedup_passages(df)) == brute(rows, 20)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(S.dedup_passages(odd_docs)) == brute(rows, 20)
    assert S.dedup_passages(no_docs).collect() == []
