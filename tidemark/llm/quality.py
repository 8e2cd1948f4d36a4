"""Quality grades from an ordinal cumulative-link regression on hashed text.

One weight vector is shared by all grades: a document's score is the mean weight of its words' features (the
hashed word, its hashed shape with runs of capitals, small letters and digits collapsed, and how many words
before it the same word came, up to four).
Ordered thresholds turn the score into P(grade > k) = sigmoid(score - threshold k), so the expected grade
and any tail probability come from one number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textnum as T
from tidemark.llm.common import labelled_texts, slices

#: Bound on the rated documents that the model is fitted to, by hash of doc_id.
TRAIN_ROWS = 4000
#: log2 of the number of hashed weights.
BITS = 18
#: Hashed features, and five for repetition.
N_WEIGHTS = (1 << BITS) + 5
ROUNDS, RATE, RIDGE = 80, 0.5, 0.1
SLICE_BYTES = 4 << 20
#: Characters of the texts that a fit turns into features at once.
FIT_CHARS = 1 << 20

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x30:0x3A], _CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x80:] = 0x30, 0x41, 0x61, 0x61


def features(column: pa.Array) -> tuple[T.Words, np.ndarray]:
    """Words of the texts; three feature numbers for each."""
    w = T.words(column)
    shift = np.uint64(64 - BITS)
    h = w.hashes()
    again = np.zeros(len(h), np.int64)
    for back in range(min(4, len(h) - 1), 0, -1):
        again[back:][(h[back:] == h[:-back]) & (w.doc[back:] == w.doc[:-back])] = back
    word = T.mix(h) >> shift
    kind = _CLASS[w.data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[w.start] = True
    at = np.append(0, np.cumsum(keep))
    shape = kind[keep]
    s = T.Words(shape, w.offsets, at[w.start], at[w.end], w.doc, w.first, np.append(shape, np.zeros(8, np.uint8)))
    shape = T.mix(s.hashes() ^ np.uint64(0x5851F42D4C957F2D)) >> shift
    return w, np.stack([word.astype(np.int64), shape.astype(np.int64), (1 << BITS) + again], axis=1)


@dataclass
class Grader:
    weights: np.ndarray
    thresholds: np.ndarray   # ascending; one less than there are grades

    def scores(self, f: np.ndarray, w: T.Words | _Docs) -> np.ndarray:
        """Mean weight of each document's words; 0 without words."""
        total = np.bincount(w.doc, weights=self.weights[f].sum(axis=1), minlength=len(w.n))
        return total / np.maximum(w.n, 1)

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every document and threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


@dataclass
class _Docs:
    doc: np.ndarray     # document of each word
    n: np.ndarray       # words of each document


def _sliced(texts: list[str | None]) -> tuple[_Docs, np.ndarray]:
    """Features of all texts, made some texts at a time: what a step holds besides its result is bounded."""
    size = np.cumsum([len(t or "") for t in texts])
    cuts = [0, *(np.flatnonzero(np.diff(size // FIT_CHARS)) + 1).tolist(), len(texts)]
    doc, n, f = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros((0, 3), np.int32)]
    for i, j in zip(cuts, cuts[1:]):
        w, part = features(pa.array(texts[i:j], pa.large_string()))
        doc.append((w.doc + i).astype(np.int32)), n.append(w.n), f.append(part.astype(np.int32))
    return _Docs(np.concatenate(doc), np.concatenate(n)), np.concatenate(f)


def fit(texts: list[str | None], grade: np.ndarray) -> Grader:
    """Maximum likelihood of the grades (0, 1, ...) with a ridge, by full gradient steps on the bounded sample."""
    w, f = _sliced(texts)
    n_grades = int(grade.max()) + 1 if len(grade) else 2
    share = np.array([(np.sum(grade > k) + 0.5) / (len(grade) + 1) for k in range(max(1, n_grades - 1))])
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(len(share)))
    g = Grader(np.zeros(N_WEIGHTS), start)
    if not len(f) or n_grades < 2:
        return g
    gap = np.log(np.maximum(np.diff(g.thresholds), 0.05))          # thresholds: the first, then log distances
    theta = np.append(g.thresholds[:1], gap)
    mean, var = np.zeros(N_WEIGHTS), np.zeros(N_WEIGHTS)
    mean_t, var_t = np.zeros(len(theta)), np.zeros(len(theta))
    per_word = 1.0 / np.maximum(w.n, 1)
    for i in range(1, ROUNDS + 1):
        g.thresholds = np.cumsum(np.append(theta[:1], np.exp(theta[1:])))
        above = np.column_stack([np.ones(len(grade)), g.above(g.scores(f, w)), np.zeros(len(grade))])
        rows = np.arange(len(grade))
        low, high = above[rows, grade], above[rows, grade + 1]     # P(> grade - 1), P(> grade)
        p = np.maximum(low - high, 1e-12)
        d_low, d_high = low * (1 - low), high * (1 - high)
        by_score = (d_low - d_high) / p                            # of the log-likelihood
        by_threshold = np.zeros(len(theta) + 2)
        np.add.at(by_threshold, grade, -d_low / p)
        np.add.at(by_threshold, grade + 1, d_high / p)
        by_threshold = by_threshold[1:-1]
        tail = np.cumsum(by_threshold[::-1])[::-1]
        by_theta = np.append(tail[:1], tail[1:] * np.exp(theta[1:]))
        gain = np.bincount(f.ravel(), weights=np.repeat((by_score * per_word)[w.doc], 3), minlength=N_WEIGHTS)
        gain -= RIDGE * g.weights
        for d, m, v, x in ((gain, mean, var, g.weights), (by_theta, mean_t, var_t, theta)):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            x += RATE * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-4)
    g.thresholds = np.cumsum(np.append(theta[:1], np.exp(theta[1:])))
    return g


def fit_grader(docs: DataFrame, labels: DataFrame) -> Grader:
    """Fit to rated documents: grade 0 for quality 0; else 1 if marked toxic, and 2 if not.

    ``docs``: doc_id, text; ``labels``: doc_id, quality, toxic. Rows without quality are left out; a null
    toxic counts as 0. At most TRAIN_ROWS ratings, the first by hash of doc_id, are used, and of their texts
    what ``labelled_texts`` takes (a row a document, bounded bytes).
    """
    grade = F.when(F.col("quality") == 0, 0).otherwise(F.when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2))
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", grade.alias("grade")).distinct()
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(TRAIN_ROWS)
    rows = labelled_texts(docs, known, "grade")
    return fit([r["text"] for r in rows], np.array([r["grade"] for r in rows], np.int64))


def grade_documents(docs: DataFrame, grader: Grader, passthrough: bool = False,
                    names: tuple[str, str] = ("expected_grade", "p_usable")) -> DataFrame:
    """``doc_id``, expected grade and P(grade > 0) for each row; with ``passthrough`` all columns of ``docs``
    stay as they are and only these two, under ``names`` that ``docs`` must not have, are added.

    Null and empty texts get the grade of a text whose words tell nothing. An empty table gives no rows.
    """
    docs = docs if passthrough else docs.select("doc_id", "text")
    out = docs.columns if passthrough else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, ["text"], SLICE_BYTES):
                w, f = features(rows.column("text"))
                above = grader.above(grader.scores(f, w))
                arrays = [rows.column(c) for c in out] + [pa.array(above.sum(axis=1)), pa.array(above[:, 0])]
                yield pa.record_batch(arrays, names=[*out, *names])

    schema = docs.select(*out).schema.add(names[0], "double").add(names[1], "double")
    return docs.mapInArrow(run, schema)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and decision for all documents."""
    from tidemark.llm.common import table

    docs = table(spark, sf_dir, "documents")
    out = grade_documents(docs, fit_grader(docs, table(spark, sf_dir, "labels")))
    return out.withColumn("keep", F.col("p_usable") >= 0.5)
