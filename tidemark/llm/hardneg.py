"""Hard negatives of anchor vectors by Fagin's threshold algorithm.

Vectors are cut into blocks of bounded size, near each other by label. A block keeps, for every dimension, the list of
its rows sorted by that component. For an anchor all lists are read from the end that its component's sign asks for, a
few places further at a time: each row met is scored exactly by random access (an integer inner product), and the
components at the places reached bound the score of all rows not met yet. Reading stops once that threshold is strictly
below the k-th score found in each window of scores the anchor asks for (the window's lower end while it holds fewer),
so rows that tie with the k-th are all met. Blocks return at most k rows a window; those merge by partial top-k.

Two passes: the first finds an anchor's positives in the blocks that hold its label, the second takes the windows that
follow from the positives' scores to the blocks of all labels. Anchors travel in groups, each against runs of blocks, and
neither side of such a job grows with the tables. What a window has found in the run's earlier blocks counts as its k-th
score in the later ones, so those are read less far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import buckets_for, landed, table

#: Rows of a block (at most 65,536: places are 16 bits) and of a run of blocks, anchors of a group, places that lists
#: are read at first.
BLOCK_ROWS, RUN_ROWS, ANCHOR_ROWS, FIRST_DEPTH = 8192, 16384, 512, 32
#: Components are floor(SCALE * x).
SCALE = 256
#: Positives of an anchor, negatives of a positive, and the window: LOW and HIGH hundredths of the positive's score.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Integers up to here are exact in a double.
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


class Block:
    """Rows of one dimension count with their sorted lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray, rows: np.ndarray, lists: np.ndarray):
        self.ids, self.labels, self.copies, self.rows, self.lists = ids, labels, copies, rows, lists
        self.most = float(np.abs(rows).max()) if rows.size else 0.0

    def _scores(self, at: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Exact inner products of the rows ``at``: in doubles where those hold them, else in Python integers."""
        if self.most * float(np.abs(a).max(initial=0.0)) * max(len(a), 1) < _EXACT:
            return (self.rows @ a)[at] if 4 * len(at) > len(self.ids) else self.rows[at] @ a
        whole = np.array([int(x) for x in a], object)
        return np.array([sum(int(x) * y for x, y in zip(r, whole)) for r in self.rows[at].tolist()], object)

    def search(self, a: np.ndarray, ok: np.ndarray, windows: list[tuple], k: int, known: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (low, high) of scores the rows among ``ok`` that may be among the first ``k`` by score, then id:
        (places, scores). ``known``: scores that each window holds from elsewhere."""
        n, d = self.rows.shape
        live = np.flatnonzero(a)
        live = live if len(live) else np.arange(min(d, 1))
        rising, lists = a[live] < 0, self.lists[live]
        weight = [int(x) for x in a[live]]
        seen, met = np.zeros(n, bool), np.zeros(0, np.int64)
        score = np.zeros(0)
        depth, step = 0, FIRST_DEPTH
        if not d:
            met, score, depth = np.arange(n), np.zeros(n), n
        while depth < n:
            threshold, fit = self._threshold(live, rising, weight, depth), score[ok[met]]
            if all(self._closed(w, k, fit, threshold, held) for w, held in zip(windows, known)):
                break
            end = min(n, depth + step)
            places = np.where(rising[:, None], lists[:, depth:end], lists[:, n - end : n - depth]).ravel()
            before = seen.copy()
            seen[places] = True
            new = np.flatnonzero(seen & ~before)
            met, score = np.concatenate([met, new]), np.concatenate([score, self._scores(new, a)])
            depth, step = end, 2 * step
        out = []
        for low, high in windows:
            fit = np.flatnonzero(ok[met] & (score >= low) & (score <= high))
            if len(fit) > k:
                worst = np.partition(score[fit], len(fit) - k)[len(fit) - k]
                fit = fit[score[fit] >= worst]
            fit = fit[np.lexsort((self.ids[met[fit]], -score[fit]))][:k]
            out.append((met[fit], score[fit]))
        return out

    def _threshold(self, live: np.ndarray, rising: np.ndarray, weight: list[int], depth: int) -> int:
        """No row that the lists haven't shown down to ``depth`` scores above this."""
        n = len(self.ids)
        at = max(depth - 1, 0)
        reached = self.rows[np.where(rising, self.lists[live, at], self.lists[live, n - 1 - at]), live]
        return sum(w * int(x) for w, x in zip(weight, reached))

    @staticmethod
    def _closed(window: tuple, k: int, score: np.ndarray, threshold: int, held: np.ndarray) -> bool:
        low, high = window
        inside = np.concatenate([score[(score >= low) & (score <= high)], held])
        return threshold < (np.partition(inside, len(inside) - k)[len(inside) - k] if len(inside) >= k else low)


def search_all(blocks: list[Block], a: np.ndarray, eligible, windows: list[tuple], k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The first ``k`` rows of each window over all blocks: (ids, copies, scores). ``eligible(block)`` says how often
    each row of a block counts (0: not at all)."""
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) for _ in windows]
    for block in blocks:
        copies = eligible(block)
        if not copies.any():
            continue
        found = block.search(a, copies > 0, windows, k, [b[2] for b in best])
        for w, (at, score) in enumerate(found):
            ids, often, scores = (np.concatenate(x) for x in zip(best[w], (block.ids[at], copies[at], score)))
            first = np.lexsort((ids, -scores))[:k]
            best[w] = ids[first], often[first], scores[first]
    return best


# --- tables -----------------------------------------------------------------------------------------


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """Distinct rows that take part: ``vec_id, label, dim, vec`` (components floor(scale * x) as doubles), ``copies``.

    ``rows``: ``vec_id``, ``label``, ``embedding``; other columns are ignored. A row with a null id, label, vector or
    component, or with a component that is not finite once scaled, takes no part.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, label, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                v = v.values if v.is_valid else None
                if i is None or label is None or v is None or v.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(v.to_numpy(zero_copy_only=False).astype(np.float64) * scale) + 0.0
                if np.isfinite(x).all():
                    out.append((i, label, len(x), x.tobytes()))
            ids, labels, dims, vecs = zip(*out) if out else ((), (), (), ())
            yield pa.record_batch({"vec_id": pa.array(ids, pa.int64()), "label": pa.array(labels, pa.int64()),
                                   "dim": pa.array(dims, pa.int32()), "vec": pa.array(vecs, pa.binary())})

    d = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    d = d.mapInArrow(whole, "vec_id long, label long, dim int, vec binary")
    return d.groupBy("vec_id", "label", "dim", "vec").agg(F.count(F.lit(1)).alias("copies"))


PACKED = "id long, dim int, n int, labels array<long>, head binary, rows binary"


def _packed(rows: DataFrame, total: int, each: int, head: list[str]) -> DataFrame:
    """``rows`` in bounded groups of one dimension, next to each other by label: a row a group.

    ``head``: long columns kept as they are, one after the other. Ranges of (dim, label, hash of the id) are cut over
    the whole table, so a label that holds most rows is many groups.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        made, held, dim = TaskContext.get().partitionId() << 32, [], None

        def out() -> pa.RecordBatch:
            nonlocal made
            made += 1
            columns = np.array([h for h, _ in held], np.int64).T.copy()
            return pa.record_batch({
                "id": pa.array([made], pa.int64()), "dim": pa.array([dim], pa.int32()), "n": pa.array([len(held)], pa.int32()),
                "labels": pa.array([np.unique(columns[head.index("label")])], pa.list_(pa.int64())),
                "head": pa.array([columns.tobytes()], pa.binary()), "rows": pa.array([b"".join(v for _, v in held)], pa.binary())})

        for batch in batches:
            keep = zip(*(batch.column(c).to_pylist() for c in head))
            for h, d, v in zip(keep, batch.column("dim").to_pylist(), batch.column("vec").to_pylist()):
                if held and (d != dim or len(held) == each):
                    yield out()
                    held = []
                dim = d
                held.append((h, v))
        if held:
            yield out()

    order = ["dim", "label", F.xxhash64("vec_id")]
    d = rows.select(*head, "dim", "vec").repartitionByRange(buckets_for(total, each), *order).sortWithinPartitions(*order)
    return d.mapInArrow(pack, PACKED)


def _in_runs(blocks: DataFrame, total: int) -> DataFrame:
    """``blocks`` with ``run``: neighbouring blocks that hold about RUN_ROWS rows together."""
    parts = blocks.agg(F.max(F.shiftright("id", 32)).alias("m")).first()["m"] or 0
    return blocks.withColumn("run", F.floor(F.shiftright("id", 32) / max(1, RUN_ROWS * (parts + 1) // max(total, 1))).cast("long"))


def _jobs(groups: DataFrame, blocks: DataFrame, same_label: bool) -> DataFrame:
    """(group, run) of one dimension; with ``same_label`` those that hold a label in common."""
    g, b = groups.select(F.col("id").alias("group"), "dim", "labels"), blocks.select("run", "dim", "labels")
    if not same_label:
        return g.drop("labels").join(b.drop("labels").distinct(), "dim").select("group", "run", "dim")
    g, b = g.withColumn("label", F.explode("labels")).drop("labels"), b.withColumn("label", F.explode("labels")).drop("labels")
    return g.join(b.distinct(), ["dim", "label"]).select("group", "run", "dim").distinct()


def _search(groups: DataFrame, blocks: DataFrame, jobs: DataFrame, find, schema: str) -> DataFrame:
    """``find(anchors' head, anchors' rows, blocks)`` over every job; yields columns of ``schema``."""
    jobs = landed(jobs, "jobs")
    left = jobs.select("group", "run").join(groups.select(F.col("id").alias("group"), "dim", "n", "head", "rows"), "group")
    named = jobs.select(F.col("group").alias("to_group"), F.col("run").alias("to_run"), "dim")
    right = named.join(blocks.select(F.col("run").alias("to_run"), "dim", "n", "head", "rows", "lists"), ["to_run", "dim"])

    def run(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        g, blocks = mine.to_pylist()[0], []
        for b in theirs.to_pylist():
            ids, labels, copies = np.frombuffer(b["head"], np.int64).reshape(3, b["n"])
            blocks.append(Block(ids, labels, copies, np.frombuffer(b["rows"]).reshape(b["n"], b["dim"]),
                                np.frombuffer(b["lists"], np.uint16).reshape(b["dim"], b["n"])))
        return find(np.frombuffer(g["head"], np.int64).reshape(-1, g["n"]), np.frombuffer(g["rows"]).reshape(g["n"], g["dim"]), blocks)

    return left.groupBy("group", "run").cogroup(right.groupBy("to_group", "to_run")).applyInArrow(run, schema)


def _with_lists(blocks: DataFrame) -> DataFrame:
    """The sorted lists of every block: for each dimension the rows' places by ascending component."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                n, dim = one.column("n")[0].as_py(), one.column("dim")[0].as_py()
                rows = np.frombuffer(one.column("rows")[0].as_py()).reshape(n, dim)
                lists = np.argsort(rows, axis=0, kind="stable").T.astype(np.uint16)
                yield pa.record_batch([*one.columns, pa.array([lists.tobytes()], pa.binary())], names=[*one.schema.names, "lists"])

    return blocks.mapInArrow(sort, PACKED + ", lists binary")


def _long(score) -> list[int]:
    return [max(-_LONG - 1, min(_LONG, int(x))) for x in score]


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of every group by score, then id, counting repeated rows; ``place`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "other")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("copy", "copies")


def hard_negatives(rows: DataFrame, is_anchor: Column, scale: int = SCALE, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Per anchor and positive the first ``negatives`` rows of other labels in the window that the positive's score sets.

    ``rows``: ``vec_id``, ``label`` (integers), ``embedding`` (array of float or double); other columns are ignored,
    whatever their names. ``is_anchor`` speaks of ``vec_id`` and ``label``. A score is the inner product of the integers
    floor(scale * x); higher ones come first, ties by smaller vec_id. Positives are the first other rows of the anchor's
    label; a negative's score lies between ``low`` and ``high`` hundredths of the positive's. Returns ``anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score``.

    Rows that take no part: see ``whole_vectors``. Vectors are only compared with those of as many components (none at
    all score 0). Rows that repeat an id are rows of their own; a row that repeats in whole counts as often as it comes,
    as anchor, positive and negative. Scores beyond a long are cut to its range. An empty table gives no rows.
    """
    vectors = landed(whole_vectors(rows, scale), "vectors")
    nth = F.row_number().over(Window.partitionBy("vec_id").orderBy("label", "dim", "vec"))
    anchors = landed(vectors.where(is_anchor).withColumn("nth", nth.cast("long")), "anchors")
    n_anchors = anchors.count()
    total = vectors.count()
    blocks = landed(_with_lists(_packed(vectors, total, BLOCK_ROWS, ["vec_id", "label", "copies"])), "blocks")
    blocks = _in_runs(blocks, total)

    def nearest(head: np.ndarray, a: np.ndarray, blocks: list[Block]) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        for i, n, label, row in zip(*head, a):
            def others(block: Block) -> np.ndarray:
                copies = np.where(block.labels == label, block.copies, 0)
                same = np.flatnonzero((copies > 0) & (block.ids == i))
                copies[same[(block.rows[same] == row).all(axis=1)]] -= 1        # the anchor itself
                return copies

            ids, copies, score = search_all(blocks, row, others, [(-np.inf, np.inf)], positives)[0]
            for column, values in zip(out, ([i] * len(ids), [n] * len(ids), ids, copies, _long(score))):
                column.extend(values)
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("anchor_id", "nth", "other", "copies", "score"), out)})

    found = "anchor_id long, nth long, other long, copies long, score long"
    groups = landed(_packed(anchors, n_anchors, ANCHOR_ROWS, ["vec_id", "nth", "label"]), "anchors")
    first = _first(_search(groups, blocks, _jobs(groups, blocks, True), nearest, found), ["anchor_id", "nth"], positives)
    first = landed(first.toDF("anchor_id", "nth", "positive_id", "positive_score", "positive"), "positives")

    wanted = first.groupBy("anchor_id", "nth").agg(*[
        F.max(F.when(F.col("positive") == p, F.col("positive_score"))).alias(f"p{p}") for p in range(1, positives + 1)])
    names = [f"p{p}" for p in range(1, positives + 1)]
    asked = anchors.join(wanted.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "nth"])
    # a missing positive is marked by the positives' number; a score may be any long
    asked = asked.select("vec_id", "nth", "label", "dim", "vec", sum(F.col(p).isNotNull().cast("long") for p in names).alias("some"),
                         *[F.coalesce(p, F.lit(0)).alias(p) for p in names])
    groups = landed(_packed(asked, n_anchors, ANCHOR_ROWS, ["vec_id", "nth", "label", "some", *names]), "anchors")

    def windowed(head: np.ndarray, a: np.ndarray, blocks: list[Block]) -> pa.Table:
        out: list[list] = [[], [], [], [], [], []]
        for (i, n, label, some, *scores), row in zip(head.T, a):
            # 100 * negative >= low * positive and 100 * negative <= high * positive, in integers
            windows = [(-(-low * int(s) // 100), high * int(s) // 100) for s in scores[: int(some)]]
            asked = list(dict.fromkeys(w for w in windows if w[0] <= w[1]))
            got = dict(zip(asked, search_all(blocks, row, lambda block: np.where(block.labels != label, block.copies, 0), asked, negatives))) if asked else {}
            for p, w in enumerate(windows, 1):
                if w in got:
                    ids, copies, score = got[w]
                    for column, values in zip(out, ([i] * len(ids), [n] * len(ids), [p] * len(ids), ids, copies, _long(score))):
                        column.extend(values)
        names = ("anchor_id", "nth", "positive", "other", "copies", "score")
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(names, out)})

    found = "anchor_id long, nth long, positive long, other long, copies long, score long"
    hits = _first(_search(groups, blocks, _jobs(groups, blocks, False), windowed, found), ["anchor_id", "nth", "positive"], negatives)
    times = anchors.select(F.col("vec_id").alias("anchor_id"), "nth", F.col("copies").alias("times"))
    out = hits.join(first, ["anchor_id", "nth", "positive"]).join(times, ["anchor_id", "nth"])
    out = out.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return out.select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("other").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))


#: Anchors of the contract's query set, and the rows whose label moves on by one of ten.
ANCHOR_EVERY, MOVED_EVERY, LABELS = 100, 7, 10


def op11_threshold(spark, sf_dir: str) -> DataFrame:
    """The rows that op 11's contract asks for, over all embeddings."""
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(rows, F.col("vec_id") % ANCHOR_EVERY == 0)


OP11_SQL = f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % {MOVED_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         [floor({SCALE} * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM usable a JOIN usable r ON a.vec_id <> r.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
WHERE {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, s.vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
