"""Removal of repeated word passages with sharded Aho-Corasick automata.

Documents are dealt into hash groups of a few MB of text. Three steps meet by small binary blobs:

1. *Anchors.* A group fingerprints its windows of ``window`` words: the least hash of the k-grams in
   a window is its anchor, so equal windows have equal anchors anywhere. Each group sends every
   anchor once, to a bucket of the hash space; the bucket returns those of two windows or groups.
2. *Confirming.* Windows on a recurring anchor go, once per group with their first place, to the
   anchor's bucket, keyed by anchor and window hash (128 bits). The bucket returns one byte per
   window: whether it recurs in the corpus, and whether the group holds its first occurrence.
3. *Locating.* A group joins its recurring windows to passages, compiles phrases of half a window
   taken at every half window (each window of a passage contains one) into one Aho-Corasick automaton,
   and streams its texts through it. Around every hit the windows are looked up by key; all their
   words are removed but for the first occurrence.

A passage that a third of all documents share crosses the network once per group, not once per
occurrence, and no automaton or bucket grows with the corpus: their number does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textnum as T
from tidemark.llm.common import bucket_of, buckets_for, text_bytes

#: Bytes of text of one group; an automaton over nothing but recurring text takes some 40 times as much.
GROUP_BYTES = 4 << 20
#: Bytes of text whose anchors and windows one bucket compares.
BUCKET_BYTES = 8 << 20

_NULL_ID = -(1 << 63)
_BLOBS = "bucket int, g int, kind int, a binary, w binary, doc binary, pos binary, flag binary"


def _pack(x: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(x).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def _unpack(b: bytes, dtype) -> np.ndarray:
    if not b:
        return np.zeros(0, dtype)
    return np.frombuffer(pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True), dtype)


def _bucket(a: np.ndarray, n: int) -> np.ndarray:
    return (((a >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int32)


def _blob_table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * 8
    kinds = [pa.int32()] * 3 + [pa.binary()] * 5
    names = ["bucket", "g", "kind", "a", "w", "doc", "pos", "flag"]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, cols, kinds)})


class _Group:
    """Words, window keys and places of one group of documents, in (doc_id, text) order."""

    def __init__(self, docs: pa.Table, window: int, k: int):
        ids = docs["doc_id"].fill_null(_NULL_ID)
        text = docs["text"].cast(pa.large_string()).fill_null("")
        docs = pa.table({"doc_id": ids, "text": text}).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.ids = docs["doc_id"].to_numpy()
        w = self.words = T.words(docs["text"])
        h = w.hashes()
        # rows that repeat a doc_id are told apart by their rank among its rows
        new = np.ones(len(self.ids), bool)
        new[1:] = self.ids[1:] != self.ids[:-1]
        rank = np.arange(len(self.ids)) - np.maximum.accumulate(np.where(new, np.arange(len(self.ids)), 0))
        keys, inside = T.grams(h, w.doc, window)
        self.at = np.flatnonzero(inside)                      # first word of each window
        self.key = keys[self.at]
        g, _ = T.grams(h, w.doc, k)
        width = window - k + 1
        least = T.sliding_min(g, width)
        self.anchor = least[self.at]
        doc = w.doc[self.at]
        self.doc = self.ids[doc]
        self.pos = (rank[doc].astype(np.int64) << 40) | (self.at - w.first[doc])

    def unique(self, keep: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the windows in ``keep``: (first window of each key in key order, counts, key number of each)."""
        a, w = self.anchor[keep], self.key[keep]
        order = np.lexsort((keep, w, a))
        a, w = a[order], w[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (w[1:] != w[:-1])
        number = np.empty(len(a), np.int64)
        number[order] = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        return keep[order[at]], np.diff(np.append(at, len(a))), number


def _in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    i = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[i] == x


def _split(g: int, kind: int, bucket: np.ndarray, *cols: np.ndarray) -> list[tuple]:
    """One row per bucket of columns that are sorted by bucket."""
    names, first = np.unique(bucket, return_index=True)
    ends = np.append(first[1:], len(bucket))
    return [(int(b), g, kind, *(_pack(c[i:j]) for c in cols), *[b""] * (5 - len(cols)))
            for b, i, j in zip(names, first, ends)]


def _candidates(group: _Group, marks: pa.Table) -> tuple[np.ndarray, ...]:
    known = [_unpack(b, np.uint64) for b, k in zip(marks["a"].to_pylist(), marks["kind"].to_pylist()) if k == 0]
    known = np.sort(np.concatenate(known)) if known else np.zeros(0, np.uint64)
    return group.unique(np.flatnonzero(_in(known, group.anchor)))


def _phrases(group: _Group, at: np.ndarray, window: int):
    """An automaton of phrases of half a window that every window starting at a word in ``at`` contains one of."""
    import ahocorasick

    step = window // 2
    size = window - step
    starts = np.sort(at)
    head = np.ones(len(starts), bool)
    head[1:] = (np.diff(starts) != 1) | (group.words.doc[starts[1:]] != group.words.doc[starts[:-1]])
    at_head = np.maximum.accumulate(np.where(head, np.arange(len(starts)), 0))
    last = np.append(head[1:], True)
    # of a passage: the windows at every step, and the phrase that covers the windows after the last of them
    offset = np.arange(len(starts)) - at_head
    seeds = starts[offset % step == 0]
    tail = (starts + step - offset % step)[last & (offset % step != 0)]
    seeds = np.union1d(seeds, tail[tail + size <= len(group.words.start)])
    return ahocorasick, seeds, size


def _normal(w: T.Words) -> tuple[str, np.ndarray]:
    """All words, each followed by a space, as latin-1 text (one character a byte); where each begins."""
    size = w.end - w.start
    begin = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    shift = np.repeat(w.start - begin, size)
    where = np.arange(len(shift)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
    out[where] = w.data[where + shift]
    return out.tobytes().decode("latin-1"), begin


def _locate(group: _Group, recurs: np.ndarray, window: int, text: str, begin: np.ndarray) -> np.ndarray:
    """First words of the places where one of the phrases of the recurring windows occurs."""
    ac, seeds, size = _phrases(group, recurs, window)
    automaton = ac.Automaton()
    ends = np.append(begin, len(text))
    for i, j in zip(begin[seeds].tolist(), ends[seeds + size].tolist()):
        automaton.add_word(text[i:j], j - i)
    automaton.make_automaton()
    hits = np.array([e - n + 1 for e, n in automaton.iter(text)], np.int64)
    word = np.searchsorted(begin, hits)
    whole = (word < len(begin)) & (begin[np.minimum(word, len(begin) - 1)] == hits)  # not inside a word
    return np.unique(word[whole])


def dedup_passages(docs: DataFrame, window: int = 20) -> DataFrame:
    """Remove every word that a repeated window of ``window`` words covers, but for the first occurrence.

    ``docs``: columns ``doc_id`` (integer) and ``text``; others are ignored, whatever their names. Returns
    ``doc_id, n_words, n_removed, kept_text`` for each row. A window's first occurrence is the one in the
    least doc_id (null before all), then at the least word; rows that repeat a doc_id follow each other
    by text, so of repeated rows the first is kept. Null and empty texts have no words; a text of fewer
    words than ``window`` stays whole. An empty table gives no rows.
    """
    k = max(1, window * 2 // 5)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    _, size = text_bytes(docs)
    n_groups, n_buckets = buckets_for(size, GROUP_BYTES), buckets_for(size, BUCKET_BYTES)
    docs = docs.withColumn("g", bucket_of(n_groups, "doc_id"))

    def anchors(t: pa.Table) -> pa.Table:
        group = _Group(t, window, k)
        a = np.unique(group.anchor)
        _, at, n = np.unique(group.key, return_index=True, return_counts=True)
        several = _in(np.unique(group.anchor[at[n > 1]]), a)  # it has a window that recurs in the group
        return _blob_table(_split(t["g"][0].as_py(), 0, _bucket(a, n_buckets), a, several.view(np.uint8)))

    def recurring(t: pa.Table) -> pa.Table:
        sent = [_unpack(b, np.uint64) for b in t["a"].to_pylist()]
        several = np.concatenate([_unpack(b, np.uint8) for b in t["w"].to_pylist()])
        everything = np.concatenate(sent)
        values, place, n = np.unique(everything, return_inverse=True, return_counts=True)
        apart = n > 1
        twice = np.zeros(len(values), bool)
        np.logical_or.at(twice, place, several > 0)
        keep = values[apart | twice]
        g = t["g"].to_pylist()
        rows = []
        for i, a in enumerate(sent):
            a = a[_in(keep, a)]
            if len(a):
                rows.append((0, g[i], 0, _pack(a), b"", b"", b"", b""))
        return _blob_table(rows)

    def windows(t: pa.Table, marks: pa.Table) -> pa.Table:
        if not t.num_rows or not marks.num_rows:
            return _blob_table([])
        group = _Group(t, window, k)
        first, n, _ = _candidates(group, marks)
        a = group.anchor[first]
        return _blob_table(_split(t["g"][0].as_py(), 1, _bucket(a, n_buckets), a, group.key[first], group.doc[first],
                                  group.pos[first], np.minimum(n, 2).astype(np.uint8)))

    def confirm(t: pa.Table) -> pa.Table:
        kinds = (("a", np.uint64), ("w", np.uint64), ("doc", np.int64), ("pos", np.int64), ("flag", np.uint8))
        sent = {c: [_unpack(b, kind) for b in t[c].to_pylist()] for c, kind in kinds}
        size = [len(x) for x in sent["a"]]
        a, w, doc, pos, n = (np.concatenate(sent[c]) for c, _ in kinds)
        order = np.lexsort((pos, doc, w, a))
        new = np.ones(len(a), bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (w[order][1:] != w[order][:-1])
        number = np.cumsum(new) - 1
        total = np.bincount(number, weights=n[order])
        flag = np.zeros(len(a), np.uint8)
        flag[order] = (total[number] > 1) + 2 * new           # 1: it recurs; 2: the first of the corpus
        g, b, at, rows = t["g"].to_pylist(), t["bucket"].to_pylist(), 0, []
        for i, m in enumerate(size):
            rows.append((b[i], g[i], 1, b"", b"", b"", b"", _pack(flag[at : at + m])))
            at += m
        return _blob_table(rows)

    result = "doc_id long, n_words long, n_removed long, kept_text string"

    def locate(t: pa.Table, marks: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()),
                             "n_removed": pa.array([], pa.int64()), "kept_text": pa.array([], pa.string())})
        group = _Group(t, window, k)
        w = group.words
        removed = np.zeros(len(w.start), bool)
        text, begin = _normal(w)
        flags = sorted((b, f) for b, f, kind in zip(marks["bucket"].to_pylist(), marks["flag"].to_pylist(),
                                                    marks["kind"].to_pylist()) if kind == 1)
        if flags:
            first, _, number = _candidates(group, marks)
            flag = np.concatenate([_unpack(f, np.uint8) for _, f in flags])
            known = np.full(len(group.at), -1, np.int64)      # key number of each candidate window
            cand = np.flatnonzero(_in(np.unique(group.anchor[first]), group.anchor))
            known[cand] = number
            recurs = first[(flag & 1) > 0]
            if len(recurs):
                hit = _locate(group, group.at[recurs], window, text, begin)
                near = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(near, np.maximum(hit - (window - 1), 0), 1)
                np.add.at(near, hit + 1, -1)
                near = np.cumsum(near)[:-1] > 0               # windows that may contain a phrase
                cand = np.flatnonzero(near[group.at] & (known >= 0))
                key = known[cand]
                again = (flag[key] & 1) > 0
                again &= ~(((flag[key] & 2) > 0) & (first[key] == cand))
                cover = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(cover, group.at[cand[again]], 1)
                np.add.at(cover, group.at[cand[again]] + window, -1)
                removed = np.cumsum(cover)[:-1] > 0
        raw = np.frombuffer(text.encode("latin-1"), np.uint8)
        size = w.end - w.start + 1
        kept = raw[np.repeat(~removed, size)]
        length = np.bincount(w.doc, weights=size * ~removed, minlength=len(group.ids)).astype(np.int64)
        to = np.cumsum(length)
        kept = kept.tobytes()
        texts = [kept[j - n : max(j - 1, j - n)].decode("utf-8") for j, n in zip(to.tolist(), length.tolist())]
        ids = pa.array(group.ids, mask=group.ids == _NULL_ID)
        gone = np.bincount(w.doc, weights=removed, minlength=len(group.ids)).astype(np.int64)
        return pa.table({"doc_id": ids, "n_words": pa.array(w.n.astype(np.int64)), "n_removed": pa.array(gone),
                         "kept_text": pa.array(texts, pa.string())})

    marks = docs.groupBy("g").applyInArrow(anchors, _BLOBS).groupBy("bucket").applyInArrow(recurring, _BLOBS)
    sent = docs.groupBy("g").cogroup(marks.groupBy("g")).applyInArrow(windows, _BLOBS)
    flags = sent.groupBy("bucket").applyInArrow(confirm, _BLOBS)
    return docs.groupBy("g").cogroup(marks.union(flags).groupBy("g")).applyInArrow(locate, result)


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    """The digest that op 4's contract asks for, over all documents."""
    from tidemark.llm.common import table

    out = dedup_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(w[p : p + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM doc)),
again AS (SELECT doc_id, p FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1),
gone AS (SELECT doc_id, list(DISTINCT x) AS xs FROM (
  SELECT doc_id, unnest(range(p, p + 20)) AS x FROM again) GROUP BY doc_id),
word AS (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS x FROM doc),
kept AS (SELECT doc_id, string_agg(v, ' ' ORDER BY x) AS t FROM word
  LEFT JOIN (SELECT doc_id, unnest(xs) AS x, 1 AS g FROM gone) USING (doc_id, x) WHERE g IS NULL GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(xs), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
