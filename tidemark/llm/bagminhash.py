"""Near-duplicate classes by BagMinHash: weighted-Jaccard signatures, bands, exact multiset overlap.

A document is the bag of its shingles of five words. For every shingle the weight axis is cut into the
nested intervals (0, 1], (1, 2], (2, 4], (4, 8] ...; each interval carries a Poisson process in time whose
rate is its length and whose points fall on one of its unit steps, all drawn from the shingle's hash. A
document sees the points at steps up to the shingle's count, and each signature register keeps the
earliest point that falls on it. Two registers agree with the probability sum(min) / sum(max) of the
counts. Points are drawn only up to the time by which all registers are full, so a signature of m
registers costs about n + m log m points instead of n * m.

Equal bags collapse first. The representatives meet in bands; each bucket links its members to its least
one, and a link counts only after the two bags' overlap is computed exactly from the texts. Buckets that
still hold several components are compared again in blocks, between components only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textnum as T
from tidemark.llm.common import landed, slices
from tidemark.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
#: 24 bands of 4 registers: a pair at the threshold shares no band with probability 0.59 ** 24 = 3e-6.
BANDS, ROWS = 24, 4
#: Registers (one byte each) of the longer signature that decides which pairs of a mixed bucket are
#: verified, and how many must agree: 4.5 standard deviations below the 2050 expected at the threshold.
#: So far above it, a pair is sure to link.
LONG, AGREE, SURE = 2560, 1959, 2141
#: Bytes of text that one numpy step handles, and rows of a block of a mixed bucket.
SLICE_BYTES, BLOCK = 4 << 20, 512
#: Bytes of text whose longer signatures a task holds at once.
LONG_BYTES = 1 << 20

_C = [np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC13FA9A902A6328F, 0x91E10DA5C79E7B1D)]


def bags(column: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(document, shingle hash, count) of every distinct shingle, by document; number of documents.

    A text of fewer than ``k`` words, but not none, is one shingle.
    """
    w = T.words(column)
    h = w.hashes()
    g, inside = T.grams(h, w.doc, k)
    doc, g = w.doc[: len(g)][inside], g[inside]
    short = np.flatnonzero((w.n > 0) & (w.n < k))
    if len(short):
        whole = []
        for d in short.tolist():
            v = np.array([w.n[d]], np.uint64)
            for x in h[w.first[d] : w.first[d + 1]]:
                v = v * T._ROLL + x
            whole.append(v)
        doc, g = np.append(doc, short), np.append(g, T.mix(np.array(whole, np.uint64)))
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], g[at], np.diff(np.append(at, len(g))), len(column)


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(doc: np.ndarray, g: np.ndarray, count: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """``n_docs`` x ``m`` point identities; zeros for a document without shingles."""
    # one process for each shingle and nested interval that its count reaches
    steps = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64), 0) + 1
    row = np.repeat(np.arange(len(g)), steps)
    level = np.arange(len(row)) - np.repeat(np.cumsum(steps) - steps, steps)
    rate = np.where(level > 0, 2.0 ** (level - 1), 1.0)
    base = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    key = T.mix(g[row] + level.astype(np.uint64) * _C[0])
    owner, weight = doc[row], count[row].astype(np.float64)
    total = np.bincount(doc, weights=count, minlength=n_docs)
    limit = np.where(total > 0, m * (np.log(m) + 3.0) / np.maximum(total, 1), 0.0)
    least, ident = np.full(n_docs * m, np.inf), np.zeros(n_docs * m, np.uint64)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        wanted = np.zeros(n_docs, bool)
        wanted[todo] = True
        here = np.flatnonzero(wanted[owner])
        time, i = np.zeros(len(here)), 0
        while len(here):
            many = 64 if len(here) < 4096 else 1
            number = np.arange(i + 1, i + many + 1, dtype=np.uint64)
            point = T.mix(key[here][:, None] + number[None, :] * _C[1])
            times = time[:, None] + np.cumsum(-np.log(_uniform(point)) / rate[here][:, None], axis=1)
            early = times <= limit[owner[here]][:, None]
            step = base[here][:, None] + np.floor(_uniform(T.mix(point ^ _C[2])) * rate[here][:, None]) + 1
            seen = early & (step <= weight[here][:, None])
            r, c = np.nonzero(seen)
            p, t = point[r, c], times[r, c]
            register = ((T.mix(p ^ _C[3]) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            at = owner[here[r]] * m + register.astype(np.int64)
            np.minimum.at(least, at, t)
            won = t == least[at]
            ident[at[won]] = p[won]
            go = early[:, -1]
            here, time, i = here[go], times[go, -1], i + many
        unfilled = np.isinf(least.reshape(n_docs, m)).any(axis=1)
        todo = todo[unfilled[todo]]
        limit[todo] *= 2
        least.reshape(n_docs, m)[todo] = np.inf
    return ident.reshape(n_docs, m)


def band_keys(doc: np.ndarray, g: np.ndarray, count: np.ndarray, n_docs: int) -> np.ndarray:
    """``n_docs`` x BANDS hashes, each of ROWS registers and the band's number."""
    s = signatures(doc, g, count, n_docs, BANDS * ROWS)
    key = np.zeros((n_docs, BANDS), np.uint64)
    for j in range(ROWS):
        key = T.mix(key * T._ROLL + s[:, j::ROWS])
    return T.mix(key + np.arange(BANDS, dtype=np.uint64) * _C[2])


def _sketch(batches):
    for batch in batches:
        for part in slices(batch, ["text"], SLICE_BYTES):
            doc, g, count, n = bags(part.column("text"))
            key = band_keys(doc, g, count, n)
            full = np.bincount(doc, minlength=n) > 0
            bag = T.mix(g ^ (count.astype(np.uint64) * _C[0]))
            one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            np.add.at(one, doc, bag)
            np.add.at(two, doc, T.mix(bag ^ _C[1]))
            off = pa.array(np.append(0, np.cumsum(np.where(full, BANDS, 0))).astype(np.int32))
            yield pa.record_batch({
                "doc_id": part.column("doc_id"),
                "h1": pa.array(one.view(np.int64)), "h2": pa.array(two.view(np.int64)),
                "bands": pa.ListArray.from_arrays(off, pa.array(key[full].reshape(-1).view(np.int64))),
            })


def _overlap(batches):
    """Pairs whose bags' weighted Jaccard similarity reaches the threshold."""
    for batch in batches:
        for part in slices(batch, ["text_u", "text_v"], SLICE_BYTES):
            d1, g1, c1, n = bags(part.column("text_u"))
            d2, g2, c2, _ = bags(part.column("text_v"))
            doc, g = np.concatenate([d1, d2]), np.concatenate([g1, g2])
            c = np.concatenate([c1, c2])
            order = np.lexsort((g, doc))
            doc, g, c = doc[order], g[order], c[order]
            same = (doc[1:] == doc[:-1]) & (g[1:] == g[:-1])
            both = np.bincount(doc[1:][same], weights=np.minimum(c[1:], c[:-1])[same], minlength=n)
            all_ = np.bincount(doc, weights=c, minlength=n) - both
            keep = pa.array((both >= THRESHOLD * all_ - 1e-9) & (all_ > 0))
            yield part.select(["u", "v"]).filter(keep)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (u, v) whose bags overlap enough, computed from the whole texts."""
    v = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    u = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    both = pairs.join(v, "v").join(u, "u").select("u", "v", "text_u", "text_v")
    return both.mapInArrow(_overlap, "u long, v long")


def _longer(batches):
    """Longer signatures of the documents of mixed buckets, and their band keys cut to 32 bits."""
    for batch in batches:
        for part in slices(batch, ["text"], LONG_BYTES):
            doc, g, count, n = bags(part.column("text"))
            sig = T.mix(signatures(doc, g, count, n, LONG)).astype(np.uint8)
            keys = band_keys(doc, g, count, n).astype(np.uint32)
            yield pa.record_batch({"node": part.column("node"), "sig": pa.array([x.tobytes() for x in sig], pa.binary()),
                                   "keys": pa.array([x.tobytes() for x in keys], pa.binary())})


def _across(t: pa.Table) -> pa.Table:
    """Within a block pair of a mixed bucket: pairs of different components whose signatures agree enough.

    A pair that shares several buckets is emitted in the first of its common bands only.
    """
    sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(t.num_rows, -1)
    keys = np.frombuffer(b"".join(t["keys"].to_pylist()), np.uint32).reshape(t.num_rows, -1)
    node, comp, side = (t[c].to_numpy() for c in ("node", "component", "side"))
    here = int(np.flatnonzero(keys[0] == t["band"].to_numpy()[:1].astype(np.uint32))[0])
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    us, vs = [], []
    for i in left:
        other = right[comp[right] != comp[i]]
        n = (sig[other] == sig[i]).sum(axis=1)
        near = np.flatnonzero(n >= AGREE)
        if not len(near):
            continue
        # of a component with a sure partner that one is enough (should another band be its first, it is there)
        near = near[np.lexsort((-n[near], comp[other[near]]))]
        best = np.append(True, comp[other[near]][1:] != comp[other[near]][:-1])
        sure = n[near][np.maximum.accumulate(np.where(best, np.arange(len(near)), 0))] >= SURE
        near = near[best | ~sure]
        near = near[(keys[other[near]] == keys[i]).argmax(axis=1) == here]
        us.append(np.full(len(near), node[i]))
        vs.append(node[other[near]])
    u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
    return pa.table({"u": np.minimum(u, v), "v": np.maximum(u, v)})


def _mixed(members: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of the buckets that hold several components: ``band, node, component, n`` (size of the bucket)."""
    rows = members.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b"),
                                     F.count(F.lit(1)).alias("n")).where("a <> b").select("band", "n")
    return rows.join(mixed, "band").select("band", "node", "component", "n")


def _mixed_pairs(rows: DataFrame, longer: DataFrame) -> DataFrame:
    """Pairs of different components in one bucket, found block by block (no bucket meets in one task)."""
    rows = rows.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(longer, "node")
    # block pair (i, j), i <= j: a row of block b is on the left of (b, j) and on the right of (i, b)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("band", "node", "component", "sig", "keys", F.least("block", "other").alias("i"),
                       F.greatest("block", "other").alias("j"),
                       F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0)
                       .otherwise(1).alias("side"))
    return rows.groupBy("band", "i", "j").applyInArrow(_across, "u long, v long").distinct()


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """Near-duplicate class of every document: similarity 0.8 of the bags of five-word shingles, transitively.

    ``docs``: columns ``doc_id`` (integer) and ``text``; others are ignored, whatever their names. Returns
    one row per input row: ``doc_id, class_id`` (the least doc_id of the class). A text of one to four words
    is one shingle; null and empty texts have none and stay alone. Rows that repeat a doc_id are one node
    with the links of all its texts.
    A null doc_id is returned with a null class. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = docs.where("doc_id is not null").mapInArrow(
        _sketch, "doc_id long, h1 long, h2 long, bands array<long>")
    sketch = landed(sketch, "sketches")
    some = sketch.where(F.size("bands") > 0)
    equal = some.groupBy("h1", "h2").agg(F.min("doc_id").alias("node"))
    chosen = F.col("doc_id") == F.col("node")
    same = landed(some.join(equal, ["h1", "h2"]).select("doc_id", "node", F.when(chosen, F.col("bands")).alias("bands")), "equal")
    bands = same.where(chosen).select("node", F.explode("bands").alias("band"))
    buckets = bands.groupBy("band").agg(F.min("node").alias("u"), F.max("node").alias("top")).where("u <> top")
    members = landed(bands.join(buckets.select("band", "u"), "band").select("band", "u", "node"), "members")
    first = members.where("node <> u").select("u", F.col("node").alias("v")).distinct()
    texts = docs.join(members.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = landed(texts, "texts")
    comp = components(_verified(first, texts))
    mixed = landed(_mixed(members.select("band", "node"), comp), "mixed")
    if not mixed.isEmpty():
        some = texts.withColumnRenamed("doc_id", "node").join(mixed.select("node").distinct(), "node", "left_semi")
        longer = landed(some.mapInArrow(_longer, "node long, sig binary, keys binary"), "longer")
        links = landed(_verified(_mixed_pairs(mixed, longer), texts), "links")
        if not links.isEmpty():
            comp = components(comp.toDF("u", "v").unionByName(links))
    repeated = sketch.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        out = same.join(comp, "node", "left").select("doc_id", F.coalesce("component", "node").alias("class_id"))
        out = out.unionByName(sketch.where(F.size("bands") <= 0).select("doc_id", F.col("doc_id").alias("class_id")))
        return out.unionByName(docs.where("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id")))
    # rows that share a doc_id tie the classes of their texts
    ties = same.where(~chosen).select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    comp = components(comp.toDF("u", "v").unionByName(ties))
    classes = comp.toDF("doc_id", "class_id")
    return docs.select("doc_id").join(classes, "doc_id", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def op6_bagminhash(spark, sf_dir: str) -> DataFrame:
    """Class and whether the document stays (the least doc_id of its class), for all documents."""
    from tidemark.llm.common import table

    out = near_duplicate_classes(table(spark, sf_dir, "documents"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i : i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
                                 WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
b AS (SELECT doc_id, g, count(*) AS c FROM s GROUP BY ALL),
n AS (SELECT doc_id, sum(c) AS n FROM b GROUP BY doc_id),
o AS (SELECT x.doc_id AS u, y.doc_id AS v, sum(least(x.c, y.c)) AS k FROM b x JOIN b y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT u, v FROM o JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v WHERE 5 * k >= 4 * (p.n + q.n - k)),
reach(u, v) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u)
SELECT u AS doc_id, min(v) AS class_id, u = min(v) AS kept FROM reach GROUP BY u
"""
