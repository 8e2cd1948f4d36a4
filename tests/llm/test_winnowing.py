import random
import re

from tidemark.llm import winnowing as S

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            v = words(text)
            k = min(10, len(v))
            windows = {tuple(v[p : p + k]) for p in range(len(v) - k + 1)} if v else set()
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in windows:
                    hit |= set(range(p, p + k))
                    ids |= {str(item)} if item is not None else set()
        out.append((i if i is not None else -1, len(w), len(hit), sorted(ids)))
    return sorted(out)


def got(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_hit, r["items"]) for r in df.collect())


def test_against_definition(spark):
    rnd = random.Random(11)
    v = [f"w{i}" for i in range(25)] + ["É", "é", "Straße"]
    items = [(i, " ".join(rnd.choices(v, k=n))) for i, n in enumerate([30, 10, 11, 9, 5, 1, 2, 0, 40, 10])]
    items += [(None, items[0][1]), (3, " ".join(rnd.choices(v, k=12))), (50, None), (51, "same " * 15)]
    docs = []
    for i in range(60):
        t = rnd.choices(v, k=rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 2)):
            w = (rnd.choice(items)[1] or "").split()
            a = rnd.randint(0, 4)
            at = rnd.randint(0, len(t))
            t[at:at] = w[a : len(w) - rnd.randint(0, 4)]
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(x.upper() if rnd.random() < 0.1 and x.isascii() else x for x in t)))
    docs += [(70, "same " * 9), (71, "same " * 60), (None, items[0][1]), (70, "same " * 9), (72, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert got(S.find_contamination(d, b)) == brute(docs, items)


def test_words_are_equal_whatever_surrounds_them(spark):
    """The lower case of a Greek capital sigma depends on the next character; only A-Z are folded."""
    items = [(1, "ΚΟΣ ΑΒΓ"), (2, "ΚΟΣ " * 12)]
    docs = [(i, f"one ΚΟΣ{c}ΑΒΓ two") for i, c in enumerate(" .':")] + [(4, "ΚΟΣ." * 12 + "end"), (5, "κος αβγ")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert got(S.find_contamination(d, b)) == brute(docs, items)
    assert [x[2] for x in brute(docs, items)] == [2, 2, 2, 2, 12, 0]


def test_shuffled_joins_give_the_same(spark, monkeypatch, odd_docs):
    """Beyond the broadcast bound the same joins run as shuffles."""
    b = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog while seven wizards")], "item_id long, text string")
    want = got(S.find_contamination(odd_docs, b))
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    assert got(S.find_contamination(odd_docs, b)) == want
    monkeypatch.setattr(S, "BROADCAST_ROWS", 1000)
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)               # words count too, whatever the rows
    assert not S._small(b, ["text"])._jdf.queryExecution().logical().toString().startswith("UnresolvedHint")
    assert S._small(b)._jdf.queryExecution().logical().toString().startswith("UnresolvedHint")
    assert got(S.find_contamination(odd_docs, b)) == want
    assert sum(x[2] > 0 for x in want) == 4


def test_empty_tables(spark, odd_docs, no_docs):
    b = spark.createDataFrame([], "item_id long, text string")
    assert all(x[2] == 0 and x[3] == [] for x in got(S.find_contamination(odd_docs, b)))
    assert S.find_contamination(no_docs, b).collect() == []
