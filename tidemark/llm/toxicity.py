"""Toxic spans and document scores from a linear-chain conditional random field.

Tokens are lower-case words; their features are hashes of the word and of its first three to six bytes.
Two labels (other, toxic) form a chain over a whole document. Labels of tokens for training come from the
documents' labels: in documents marked toxic, the tokens with a feature that is bound to such documents far
beyond chance (a bound on the binomial tail, corrected for the number of features; near copies count
once); everything else is other. The field's weights maximise the conditional likelihood, by forward-backward passes over all
training documents. A document's score is a logistic function of its tokens' marginals.

Chains of two labels need just the ratio of the two messages, which every token maps by a Moebius
function; a batch of documents is one array, cut into short rows that advance together.
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

#: Bound on the labelled documents that the field is trained on: so many of each label, by hash of doc_id.
TRAIN_TOXIC, TRAIN_CLEAN = 1000, 2000
#: log2 of the number of hashed weights; byte lengths of the prefixes that are features.
BITS, PREFIXES = 21, (3, 4, 5, 6)
ROUNDS, RATE, RIDGE = 40, 0.5, 1e-4
SLICE_BYTES, ROW = 4 << 20, 64
#: Bytes of text that training handles at once.
PART_BYTES = 2 << 20
#: A feature marks tokens if it is so bound to toxic documents, beyond what chance explains.
PURITY, DOUBT = 0.9, 0.05

_PUNCT = np.ones(256, dtype=bool)
_PUNCT[0x30:0x3A] = _PUNCT[0x41:0x5B] = _PUNCT[0x61:0x7B] = _PUNCT[0x80:] = False
_KEY = np.array(PREFIXES, np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def features(column: pa.Array) -> tuple[T.Words, np.ndarray]:
    """Words of the texts; a row of feature numbers for each (0: no feature)."""
    w = T.words(column, _PUNCT, fold=True)
    size, lead = w.end - w.start, w.lead()
    out = np.zeros((len(size), 1 + len(PREFIXES)), np.int32)
    shift = np.uint64(64 - BITS)
    out[:, 0] = T.mix(w.hashes()) >> shift
    for i, n in enumerate(PREFIXES):
        h = T.mix((lead & T._LOW[n]) + _KEY[i]) >> shift
        out[:, 1 + i] = np.where(size >= n, h, 0)
    return w, out


def _ratios(e: np.ndarray, fresh: np.ndarray, a: float, b: float, s: float, forward: bool) -> np.ndarray:
    """Message ratios toxic / other of each token. ``e``: its emission score; ``fresh``: it begins a document
    (forward) or ends one (backward); ``a``, ``b``, ``s``: scores of other-toxic, toxic-toxic and of a toxic start."""
    n = len(e)
    if not n:
        return np.zeros(0)
    x, ea, eb = np.exp(e), np.exp(a), np.exp(b)
    if forward:   # r = x (ea + eb r') / (1 + r')
        m = [np.where(fresh, x * np.exp(s), x * eb), np.where(fresh, x * np.exp(s), x * ea), np.ones(n), np.ones(n)]
    else:         # q = (1 + eb x' q') / (1 + ea x' q'), x' of the next token
        nxt = np.append(x[1:], 1.0)
        m = [np.where(fresh, 0.0, eb * nxt), np.ones(n), np.where(fresh, 0.0, ea * nxt), np.ones(n)]
        m = [v[::-1] for v in m]
    rows = -(-n // ROW)
    pad = rows * ROW - n
    one = (1.0, 0.0, 0.0, 1.0)
    p, q, u, v = (np.append(c, np.full(pad, z)).reshape(rows, ROW).T.copy() for c, z in zip(m, one))
    # the product of each row's maps, scaled as it grows
    tp, tq, tu, tv = p[0], q[0], u[0], v[0]
    for i in range(1, ROW):
        tp, tq, tu, tv = p[i] * tp + q[i] * tu, p[i] * tq + q[i] * tv, u[i] * tp + v[i] * tu, u[i] * tq + v[i] * tv
        big = np.maximum(np.maximum(tp, tq), np.maximum(tu, tv))
        tp, tq, tu, tv = tp / big, tq / big, tu / big, tv / big
    start, r = np.empty(rows), 1.0
    for i, (c1, c2, c3, c4) in enumerate(zip(tp.tolist(), tq.tolist(), tu.tolist(), tv.tolist())):
        start[i] = r
        r = (c1 * r + c2) / (c3 * r + c4)
    out = np.empty((ROW, rows))
    r = start
    for i in range(ROW):
        r = (p[i] * r + q[i]) / (u[i] * r + v[i])
        out[i] = r
    out = out.T.reshape(-1)[:n]
    return out if forward else out[::-1]


@dataclass
class Field:
    weights: np.ndarray
    chain: np.ndarray      # a, b, s
    score: np.ndarray      # of the document: constant, largest marginal's log-odds, log of the sum of marginals

    def emissions(self, f: np.ndarray) -> np.ndarray:
        return np.clip(sum(self.weights[f[:, i]] for i in range(f.shape[1])), -30, 30)

    def messages(self, f: np.ndarray, w: T.Words | Part):
        e = self.emissions(f)
        first, last = np.zeros(len(e), bool), np.zeros(len(e), bool)
        some = w.n > 0
        first[w.first[:-1][some]], last[w.first[1:][some] - 1] = True, True
        a, b, s = self.chain
        return e, first, _ratios(e, first, a, b, s, True), _ratios(e, last, a, b, s, False)

    def marginals(self, f: np.ndarray, w: T.Words | Part) -> np.ndarray:
        _, _, r, q = self.messages(f, w)
        return r * q / (1 + r * q)

    def documents(self, p: np.ndarray, w: T.Words | Part) -> tuple[np.ndarray, np.ndarray]:
        """(features, score) of every document; one without words has the least marginal that occurs."""
        top = np.full(len(w.n), 1e-9)
        np.maximum.at(top, w.doc, p)
        top = np.clip(top, 1e-9, 1 - 1e-9)
        total = np.bincount(w.doc, weights=p, minlength=len(w.n))
        x = np.stack([np.ones(len(top)), np.log(top / (1 - top)), np.log(total + 1e-3)], axis=1)
        return x, 1 / (1 + np.exp(-np.clip(x @ self.score, -500, 500)))


@dataclass
class Part:
    """Some training documents: what the field needs of their words, and little more."""

    n: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    f: np.ndarray
    toxic: np.ndarray
    y: np.ndarray | None = None


def _least_hashes(w: T.Words) -> np.ndarray:
    """Four least hashes of each document's four-word shingles; the greatest value without shingles."""
    g, inside = T.grams(w.hashes(), w.doc, 4)
    doc, g = w.doc[: len(g)][inside], g[inside]
    out = np.full((len(w.n), 4), np.uint64(2**64 - 1))
    if len(doc):
        at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        for i in range(4):
            out[doc[at], i] = np.minimum.reduceat(T.mix(g ^ _KEY[i]), at)
    return out


def _parts(texts: list[str | None], toxic: np.ndarray) -> list[Part]:
    """The documents in parts of bounded size, without those that have an earlier near copy (it shares one of
    the four least hashes): copies of one toxic document would bind all its words to the label."""
    column = pa.array(texts, pa.large_string())
    rows = list(slices(pa.record_batch({"text": column}), ["text"], PART_BYTES))
    least = np.concatenate([_least_hashes(T.words(r.column("text"), _PUNCT, fold=True)) for r in rows] or [np.zeros((0, 4), np.uint64)])
    keep = np.ones(len(least), bool)
    for i in range(4):
        first = np.zeros(len(least), bool)
        first[np.unique(least[:, i], return_index=True)[1]] = True
        keep &= first | (least[:, i] == np.uint64(2**64 - 1))
    out, at = [], 0
    for r in rows:
        mine = keep[at : at + r.num_rows]
        w, f = features(r.column("text").filter(pa.array(mine)))
        out.append(Part(w.n, w.first, w.doc, f, toxic[at : at + r.num_rows][mine]))
        at += r.num_rows
    return out


def _mark(parts: list[Part]) -> None:
    """Labels of the tokens: in toxic documents, those with a feature that is bound to toxic documents."""
    n_bits = 1 << BITS
    toxic = np.concatenate([p.toxic for p in parts])
    rate = float(np.clip(toxic.mean(), 1e-3, 1 - 1e-3))
    bad, n = np.zeros(n_bits), np.zeros(n_bits)
    for p in parts:
        for i in range(p.f.shape[1]):
            seen = np.unique(p.doc * n_bits + p.f[:, i])
            bad += np.bincount(seen % n_bits, weights=p.toxic[seen // n_bits], minlength=n_bits)
            n += np.bincount(seen % n_bits, minlength=n_bits)
    share = np.clip(bad / np.maximum(n, 1), 1e-12, 1 - 1e-12)
    surprise = n * (share * np.log(share / rate) + (1 - share) * np.log((1 - share) / (1 - rate)))
    sure = (share >= PURITY) & (surprise > np.log((n > 0).sum() / DOUBT))
    sure[0] = False
    for p in parts:
        p.y = (sure[p.f].any(axis=1) & (p.toxic[p.doc] > 0)).astype(float)


def train(texts: list[str | None], toxic: np.ndarray) -> Field:
    """Fit the field and the document score to labelled texts (numpy, on the bounded sample)."""
    field = Field(np.zeros(1 << BITS), np.array([-4.0, 0.0, -4.0]), np.array([-2.0, 0.5, 0.0]))
    parts = _parts(texts, toxic)
    n_words = sum(len(p.doc) for p in parts)
    if not n_words or not toxic.any() or toxic.all():
        rate = (toxic.sum() + 0.5) / (len(toxic) + 1)
        field.score = np.array([np.log(rate / (1 - rate)), 0.0, 0.0])
        return field
    _mark(parts)
    m_w, v_w = np.zeros(1 << BITS), np.zeros(1 << BITS)
    m_c, v_c = np.zeros(3), np.zeros(3)
    for i in range(1, ROUNDS + 1):
        gain, grad = -RIDGE * n_words / (1 << BITS) * field.weights, -RIDGE * field.chain
        for part in parts:
            y, before = part.y, np.append(0.0, part.y[:-1])
            e, first, r, q = field.messages(part.f, part)
            p = r * q / (1 + r * q)
            prev = np.append(1.0, r[:-1])
            a, b, _ = field.chain
            x = np.exp(e) * q
            four = 1 + prev + np.exp(a) * x + np.exp(b) * prev * x
            inner = ~first
            grad += np.array([(inner * ((1 - before) * y - np.exp(a) * x / four)).sum(),
                              (inner * (before * y - np.exp(b) * prev * x / four)).sum(), (first * (y - p)).sum()])
            for k in range(part.f.shape[1]):
                gain += np.bincount(part.f[:, k], weights=y - p, minlength=1 << BITS)
        gain[0] = 0
        for g, mean, var, at in ((gain, m_w, v_w, field.weights), (grad, m_c, v_c, field.chain)):
            mean += 0.1 * (g - mean)
            var += 0.01 * (g * g - var)
            at += RATE * (mean / (1 - 0.9**i)) / (np.sqrt(var / (1 - 0.99**i)) + 1e-6)
    x = np.concatenate([field.documents(field.marginals(p.f, p), p)[0] for p in parts])
    toxic = np.concatenate([p.toxic for p in parts])
    beta = np.array([0.0, 0.1, 0.0])
    for _ in range(30):  # Newton steps of a logistic regression with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        step = np.linalg.solve(h, x.T @ (toxic - p) - 0.1 * beta)
        beta = beta + np.clip(step, -2, 2)
    field.score = beta
    field.weights = field.weights.astype(np.float32)
    return field


def train_field(docs: DataFrame, labels: DataFrame) -> Field:
    """A field from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0/1; null labels are left out): at most
    TRAIN_TOXIC and TRAIN_CLEAN documents, and of their texts what ``labelled_texts`` takes (a row a document, bounded bytes)."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", "toxic").distinct()
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    some = known.where("toxic = 1").orderBy(*order).limit(TRAIN_TOXIC).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(TRAIN_CLEAN))
    rows = labelled_texts(docs, some, "toxic")
    return train([r["text"] for r in rows], np.array([r["toxic"] for r in rows], float))


def score_toxicity(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, score`` (0 to 1) and ``spans`` (code-point ranges of toxic tokens, marginal 0.5 or more).

    ``docs``: ``doc_id``, ``text``; other columns are ignored, whatever their names. One row per input row;
    null and empty texts are scored as texts without words, and have no spans.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, ["text"], SLICE_BYTES):
                w, f = features(rows.column("text"))
                p = field.marginals(f, w)
                _, score = field.documents(p, w)
                point = np.append(0, np.cumsum((w.data & 0xC0) != 0x80))
                bad = np.flatnonzero(p >= 0.5)
                near = np.zeros(len(bad), bool)       # it follows a toxic token of its document
                near[1:] = (np.diff(bad) == 1) & (w.doc[bad[1:]] == w.doc[bad[:-1]])
                begin, end = bad[~near], bad[np.append(~near[1:], True)[: len(bad)]]
                base = point[w.offsets[w.doc[begin]]] if len(begin) else 0
                n = np.bincount(w.doc[begin], minlength=len(w.n))
                ranges = pa.StructArray.from_arrays(
                    [pa.array(point[w.start[begin]] - base, pa.int64()), pa.array(point[w.end[end]] - base, pa.int64())],
                    names=["start", "end"])
                yield pa.record_batch({"doc_id": rows.column("doc_id"), "score": pa.array(score), "spans":
                                       pa.ListArray.from_arrays(np.append(0, np.cumsum(n)).astype(np.int32), ranges)})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, spans array<struct<start:long,end:long>>")


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Held-out fold, score and decision that op 10's contract asks for, over all documents."""
    from tidemark.llm.common import table

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    field = train_field(docs, table(spark, sf_dir, "labels").where(~held_out))
    out = score_toxicity(docs, field)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "spans")
