"""Near duplicates among vectors by product quantisation (inverted lists, residual codes, exact rerank).

Coarse centroids cut the sphere into lists; a vector is stored in its nearest list as the codes of its residual
in subspaces of four dimensions. A vector probes every list that can hold a vector near enough: between it and the
cell of another centroid lies at least its distance to the plane halfway between that centroid and its own. So no link
is lost, however many lists lie about as near. Within a list, distances from the probing vector to the codes come
from a table; since the error of each stored code is known, the distance can only be smaller by that error, and what
may still be near enough is compared exactly (cosine in double precision). Lists are worked off in blocks of bounded
size, so a list that holds a third of all vectors is many blocks; a block returns counts and a spanning forest, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import landed
from tidemark.llm.components import components

COSINE = 0.93
#: Bound on the vectors that centroids and codebooks are trained on, by hash of the vector.
TRAIN_ROWS = 20_000
#: Vectors of one label wanted in a list; most lists (an eighth of the sample); dimensions of a subspace, codewords in it.
LIST_ROWS, MOST_LISTS, SUB, CODES = 4096, TRAIN_ROWS // 8, 4, 256
#: Vectors on each side of a block; pairs of a block compared at a time.
BLOCK, PAIRS = 2048, 1 << 20


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids, from evenly spaced rows on; ``x`` comes in hash order."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        for j in range(x.shape[1]):
            s = np.bincount(at, weights=x[:, j], minlength=len(c))
            c[n > 0, j] = s[n > 0] / n[n > 0]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ c.T - half, axis=1) for i in range(0, len(x), 4096)] or [np.zeros(0, int)])


@dataclass
class Index:
    centroids: np.ndarray          # lists x dimensions
    codebooks: list[np.ndarray]    # for each subspace: codewords x its dimensions

    def encode(self, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, length of what they miss) of unit vectors in their lists."""
        r = x - self.centroids[at]
        codes, miss = np.zeros((len(x), len(self.codebooks)), np.uint8), np.zeros(len(x))
        for m, book in enumerate(self.codebooks):
            part = r[:, m * SUB : (m + 1) * SUB]
            codes[:, m] = _nearest(part, book)
            miss += ((part - book[codes[:, m]]) ** 2).sum(axis=1)
        return codes, np.sqrt(miss)

    def distances(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """From every row of ``x`` to every coded vector of list ``at``, by table lookup."""
        r = x - self.centroids[at]
        total = np.zeros((len(x), len(codes)), np.float32)
        for m, book in enumerate(self.codebooks):
            part = r[:, m * SUB : (m + 1) * SUB]
            table = ((part[:, None, :] - book[None, :, :]) ** 2).sum(axis=2).astype(np.float32)
            total += table[:, codes[:, m]]
        return np.sqrt(total)


def _scaled(raw: list[bytes], dim: int) -> np.ndarray:
    """The vectors as doubles, each divided by a power of two near its largest component: nothing is rounded."""
    x = np.frombuffer(b"".join(raw), "<f4" if raw and len(raw[0]) == 4 * dim else "<f8").reshape(len(raw), dim).astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def _units(raw: list[bytes], dim: int) -> np.ndarray:
    x = _scaled(raw, dim)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors that can link, as bytes of their own element type."""
    for batch in batches:
        ids, labels, raw, dims = [], [], [], []
        rows = batch.column("embedding")
        kind = "<f4" if pa.types.is_float32(rows.type.value_type) else "<f8"
        for i, label, v in zip(batch.column("vec_id").to_pylist(), batch.column("label").to_pylist(), rows):
            v = v.values if v.is_valid else None
            if i is None or label is None or v is None or not len(v) or v.null_count:
                continue
            x = v.to_numpy(zero_copy_only=False).astype(kind)
            if np.isfinite(x).all() and x.any():
                ids.append(i), labels.append(label), raw.append((x + x.dtype.type(0)).tobytes()), dims.append(len(x))
        yield pa.record_batch({"vec_id": pa.array(ids, pa.int64()), "label": pa.array(labels, pa.int64()),
                               "dim": pa.array(dims, pa.int32()), "vec": pa.array(raw, pa.binary())})


def _forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node of its component) of the graph of pairs, without the least nodes."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    low = np.arange(len(names))
    while True:
        new = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == low).all():
            break
        low = new
    child = low != np.arange(len(names))
    return names[child], names[low[child]]


def _spanning(same: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_forest`` of the pairs (p[i], q[j]) with ``same[i, j]``, without listing them.

    Every row and column first takes one of its links, then one that leaves its component, until none does.
    """
    names, at = np.unique(np.concatenate([p, q]), return_inverse=True)
    a, b = at[: len(p)], at[len(p) :]
    low, rest = np.arange(len(names)), same
    while rest.any():
        i, j = np.flatnonzero(rest.any(axis=1)), np.flatnonzero(rest.any(axis=0))
        u = np.concatenate([a[i], a[rest[:, j].argmax(axis=0)]])
        v = np.concatenate([b[rest[i].argmax(axis=1)], b[j]])
        child, least = _forest(low[u], low[v])
        to = np.arange(len(names))
        to[child] = least
        low = to[low]
        rest = same & (low[a][:, None] != low[b][None, :])
    child = low != np.arange(len(names))
    return names[child], names[low[child]]


#: A cosine of doubles that is this near to the threshold is decided on the vectors themselves in extended precision.
DOUBT = 1e-12


def _exactly(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    a, b = a.astype(np.longdouble), b.astype(np.longdouble)
    return (a * b).sum(axis=1) >= np.longdouble(cosine) * np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))


def _same(x: np.ndarray, y: np.ndarray, near: np.ndarray, cosine: float, plain_x: np.ndarray, plain_y: np.ndarray) -> np.ndarray:
    """Which of the pairs marked in ``near`` have the cosine; where many are marked, a product decides the clear ones."""
    same = np.zeros(near.shape, bool)
    if near.sum() > near.size // 64:
        product = x @ y.T
        same = near & (product >= cosine + DOUBT)
        near = near & (np.abs(product - cosine) < DOUBT)
    a, b = np.nonzero(near)
    for s in range(0, len(a), 1 << 16):                       # some pairs at a time
        i, j = a[s : s + (1 << 16)], b[s : s + (1 << 16)]
        value = np.einsum("ij,ij->i", x[i], y[j])
        same[i, j] = value >= cosine + DOUBT
        doubt = np.flatnonzero(np.abs(value - cosine) < DOUBT)
        same[i[doubt], j[doubt]] = _exactly(plain_x[i[doubt]], plain_y[j[doubt]], cosine)
    return same


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links between vectors of one label whose cosine is at least ``cosine``, and their components.

    ``vectors``: ``vec_id`` (integer), ``embedding`` (array of floats), ``label`` (integer); other columns are
    ignored, whatever their names. Returns one row per input row: ``vec_id, n_links`` (other vectors linked
    directly), ``component_id`` (least vec_id reachable, itself included), ``kept``. Vectors that are null, empty or
    zero, or have null or non-finite components, and those without label, link with nothing; nor do vectors
    of different length. Rows that repeat a vec_id and its vector count once; a vec_id with several vectors is one node of
    its component, and each of its vectors a link of its own to count. A null vec_id links with nothing and has a
    null component. An empty table gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
    good = landed(rows.mapInArrow(_usable, "vec_id long, label long, dim int, vec binary").distinct(), "vectors")
    nodes = landed(good.groupBy("label", "dim", "vec").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("n")), "nodes")
    edges, counts = None, None
    for dim in sorted(r[0] for r in nodes.select("dim").distinct().collect()):   # lengths that occur: one, as a rule
        found = _search(nodes.where(F.col("dim") == dim), dim, cosine)
        edges = found if edges is None else edges.unionByName(found)
    members = good.join(nodes.withColumnRenamed("n", "same"), ["label", "dim", "vec"]).select("vec_id", "node", "same")
    if edges is None:
        out = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    counts = edges.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    ties = members.where("vec_id <> node").select(F.col("vec_id").alias("u"), F.col("node").alias("v"))
    several = good.groupBy("vec_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    linked = edges.where("links = 0").select(F.col("node").alias("u"), F.col("other").alias("v"))
    comp = components(linked if several.isEmpty() else linked.unionByName(ties))
    got = members.join(counts, "node", "left").join(comp, "node", "left").groupBy("vec_id").agg(
        F.sum(F.coalesce("links", F.lit(0)) + F.col("same") - 1).alias("n_links"),
        F.min(F.coalesce("component", "node")).alias("component_id"))
    out = rows.select("vec_id").join(got, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _train(nodes: DataFrame, dim: int) -> Index:
    most = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0]
    sample = nodes.orderBy(F.xxhash64("vec"), "vec").select("vec").limit(TRAIN_ROWS).collect()
    x = _units([bytes(r[0]) for r in sample], dim)
    centroids = _kmeans(x, max(1, min(MOST_LISTS, -(-int(most) // LIST_ROWS), len(x))))
    r = x - centroids[_nearest(x, centroids)]
    return Index(centroids, [_kmeans(r[:, i : i + SUB], CODES, 6) for i in range(0, dim, SUB)])


def _search(nodes: DataFrame, dim: int, cosine: float) -> DataFrame:
    """Rows ``node, other, links``: links > 0 adds to a node's count, links = 0 says that the two are connected."""
    index = _train(nodes, dim)
    reach = np.sqrt(2 - 2 * cosine)
    apart = np.stack([np.sqrt(((index.centroids - c) ** 2).sum(axis=1)) for c in index.centroids])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _units(batch.column("vec").to_pylist(), dim)
            c = index.centroids
            d = np.sqrt(np.maximum(1 + (c * c).sum(axis=1)[None, :] - 2 * x @ c.T, 0))
            home = np.argmin(d, axis=1)
            codes, miss = index.encode(x, home)
            # the plane halfway to another centroid is (d^2 - nearest^2) / (2 * distance of the centroids) away; of
            # two lists, vectors of the first probe the second
            far = d * d - d[np.arange(len(x)), home][:, None] ** 2
            probe = (far <= 2 * apart[home] * reach + 1e-6) & (np.arange(len(c)) >= home[:, None])
            which = np.nonzero(probe)[1].astype(np.int32)
            off = np.append(0, np.cumsum(probe.sum(axis=1))).astype(np.int32)
            yield pa.record_batch({
                "label": batch.column("label"), "node": batch.column("node"), "n": batch.column("n"), "vec": batch.column("vec"),
                "home": pa.array(home, pa.int32()), "miss": pa.array(miss), "code": pa.array([r.tobytes() for r in codes], pa.binary()),
                "probes": pa.ListArray.from_arrays(off, pa.array(which))})

    placed = landed(nodes.select("label", "node", "n", "vec").mapInArrow(
        place, "label long, node long, n long, vec binary, home int, miss double, code binary, probes array<int>"), "placed")
    asks = placed.select("label", F.explode("probes").alias("list"), "node", "n", "vec", "home")
    size = placed.groupBy("label", F.col("home").alias("list")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("held"))
    asked = asks.groupBy("label", "list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("asking"))
    blocks = landed(size.join(asked, ["label", "list"]), "blocks")
    key = F.xxhash64("node")
    stored = placed.withColumn("list", F.col("home")).join(blocks, ["label", "list"]).select(
        "label", "list", F.pmod(key, "held").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("asking") - 1)).alias("j"),
        "node", "n", "vec", "miss", "code")
    asks = asks.join(blocks, ["label", "list"]).select(
        F.col("label").alias("a_label"), F.col("list").alias("a_list"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("held") - 1)).alias("a_i"), F.pmod(key, "asking").alias("a_j"),
        F.col("node").alias("a_node"), F.col("n").alias("a_n"), F.col("vec").alias("a_vec"), F.col("home").alias("a_home"))

    def compare(ask: pa.Table, held: pa.Table) -> pa.Table:
        none = np.zeros(0, np.int64)
        node, other, links = [none], [none], [none]
        if ask.num_rows and held.num_rows:
            plain_x, plain_y = _scaled(ask["a_vec"].to_pylist(), dim), _scaled(held["vec"].to_pylist(), dim)
            x, y = (v / np.sqrt((v * v).sum(axis=1, keepdims=True)) for v in (plain_x, plain_y))
            code = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint8).reshape(len(y), -1)
            here = held["list"][0].as_py()
            miss, p, q = held["miss"].to_numpy(), ask["a_node"].to_numpy(), held["node"].to_numpy()
            n, m = ask["a_n"].to_numpy(), held["n"].to_numpy()
            other_list = ask["a_home"].to_numpy() != here     # there the stored side doesn't ask, so it counts the link here
            stored, step = np.zeros(len(y)), max(1, PAIRS // len(y))
            for s in range(0, len(x), step):
                part = slice(s, s + step)
                near = index.distances(x[part], here, code) <= reach + miss[None, :] + 1e-4
                near &= p[part][:, None] != q[None, :]
                same = _same(x[part], y, near, cosine, plain_x[part], plain_y)
                if same.any():
                    one = same.astype(np.float64)
                    total = (one @ m).astype(np.int64)
                    stored += np.where(other_list[part], n[part], 0) @ one
                    some = np.flatnonzero(total)
                    node.append(p[part][some]), other.append(p[part][some]), links.append(total[some])
                    child, least = _spanning(same, p[part], q)
                    node.append(child), other.append(least), links.append(np.zeros(len(child), np.int64))
            some = np.flatnonzero(stored)
            node.append(q[some]), other.append(q[some]), links.append(stored[some].astype(np.int64))
        return pa.table({"node": np.concatenate(node), "other": np.concatenate(other), "links": np.concatenate(links)})

    cell = ["label", "list", "i", "j"]
    found = asks.groupBy(*(f"a_{c}" for c in cell)).cogroup(stored.groupBy(*cell)).applyInArrow(compare, "node long, other long, links long")
    return landed(found, "found")


def op7_pq(spark, sf_dir: str) -> DataFrame:
    """Links and components that op 7's contract asks for, over all embeddings."""
    from tidemark.llm.common import table

    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, [x::DOUBLE FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= {COSINE}),
reach(u, w) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.u, link.w FROM reach JOIN link ON reach.w = link.u),
low AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM link GROUP BY u)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN low ON vec_id = low.u LEFT JOIN n ON vec_id = n.u
"""
