"""The pipeline's stages on a small corpus, each held against what it must do to its own input."""

import os

import pytest

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
def test_stages(spark, tmpdir_path):
    import corpus_pipeline as C

    from test_bagminhash import classes
    from test_winnowing import brute as hits

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in C.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, SF).write.parquet(f"{tmpdir_path}/{name}")
        docs = spark.read.parquet(f"{tmpdir_path}/{name}")
        after = [r.doc_id for r in docs.collect()]
        if name != "tokens":
            assert docs.columns == columns
        ids = [i for i, _ in before]
        if name == "quality":
            good = [i for i in ids if labels.get(i) == 1]
            junk = [i for i in ids if labels.get(i) == 0]
            assert len(set(good) & set(after)) >= 0.98 * len(good)
            assert len(set(junk) & set(after)) <= 0.2 * len(junk)
        elif name == "near_duplicates":
            assert sorted(after) == sorted({c for c in classes(before).values()})
        elif name == "decontaminate":
            assert sorted(after) == sorted(r[0] for r in hits(before, items) if r[2] == 0)
        elif name == "mix":
            assert set(after) <= set(ids) and max(after.count(i) for i in set(after)) <= 2
        else:
            assert sorted(after) == sorted(ids)
            got = sorted(docs.collect(), key=lambda r: r.start)
            assert [r.doc_id for r in got] == sorted(ids)
            assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    assert C.ORACLE_SQL is None


def test_odd_rows(spark, odd_docs, no_docs):
    import corpus_pipeline as C

    for df in (odd_docs, no_docs):
        docs = df
        for name, stage in C.STAGES:
            out = stage(spark, docs, SF)
            if name != "tokens":
                assert out.columns == docs.columns
                docs = spark.createDataFrame(out.collect(), docs.schema)
            else:
                assert out.count() == docs.count()


def test_unlike_texts_that_share_a_doc_id_stay(spark):
    import corpus_pipeline as C

    one, two = "alpha beta gamma delta epsilon zeta eta theta " * 5, "some other words that nobody else has written here at all " * 5
    rows = [(1, one, "x"), (1, two, "y"), (2, one, "z"), (3, two + "again", "z"), (None, one, "n"), (4, "", "e"), (4, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string")
    got = sorted(((r.doc_id or 0), r.text or "") for r in C.near_duplicates(spark, docs, SF).collect())
    assert got == sorted([(1, one), (1, two), (0, one), (4, ""), (4, "")])
    got = C.near_duplicates(spark, docs.where("doc_id <> 1 and doc_id <> 4 or doc_id is null"), SF)
    assert got.columns == docs.columns and got.count() == 3
