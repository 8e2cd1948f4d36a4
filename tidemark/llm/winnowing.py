"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts are words of ASCII letters, digits and bytes above 0x7F, with A-Z in lower case. Of each ``window``
consecutive words the least hash of the ``K``-grams inside is kept; equal windows keep equal hashes, so a
document that shares a window with a benchmark item shares a fingerprint with it. Fingerprints of both
sides join; every hit then extends word by word to both sides on the real words, and counts if the
matched run holds a whole window. Items shorter than a window are one window of their own length, whose
hash is sought among all grams of that length.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import landed

#: Characters of a word; upper-case letters are lowered before.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of a fingerprinted gram.
K = 5
#: Rows up to which a table of fingerprints or document keys (some 16 bytes a row) may be broadcast, and bytes of the words
#: and ids it may hold besides; both are counted first, and larger tables join by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def exact_words(text: str) -> Column:
    """The words of the contract, also those that are hashed: ``lower`` would tell equal words apart, since a
    Greek capital sigma is lowered by what surrounds it."""
    return _words(F.translate(F.col(text), UPPER, LOWER))


def _grams(h: str, n: str, k: int) -> Column:
    """Hashes of all k-grams of an array of word hashes (empty if it has fewer words)."""
    each = F.transform(F.col(h), lambda x, i: F.xxhash64(F.lit(k), x, *(F.get(F.col(h), i + j) for j in range(1, k))))
    return F.slice(each, F.lit(1), F.greatest(F.col(n) - F.lit(k - 1), F.lit(0)))


def _least(g: str, n: str, window: int) -> Column:
    """The least gram hash in each window of words."""
    wide = window - K + 1
    each = F.transform(F.col(g), lambda x, i: F.least(x, *(F.get(F.col(g), i + j) for j in range(1, wide))))
    return F.slice(each, F.lit(1), F.greatest(F.col(n) - F.lit(window - 1), F.lit(0)))


def _hashed(df: DataFrame, words: Column) -> DataFrame:
    df = df.withColumn("words", words).withColumn("n_words", F.size("words").cast("long"))
    return df.withColumn("h", F.transform("words", lambda x: F.xxhash64(x)))


def _chosen(df: DataFrame, window: int, short: list[int]) -> DataFrame:
    """One row per chosen gram: ``fp``, ``size`` (its words), ``p`` (its place), ``near`` (the words around it).

    ``near`` holds the window - K words before the gram, the gram, and as many after it; null past the ends.
    """
    df = df.withColumn("n", F.col("n_words").cast("int")).withColumn("g", _grams("h", "n", K))
    df = df.withColumn("m", _least("g", "n", window))
    wide, side = window - K + 1, window - K

    def keep(x, i):  # the least of some window that contains it
        return F.greatest(*(F.get(F.col("m"), i - j) for j in range(wide))) == x

    def row(x, i, k, before, after):
        return F.struct(x.alias("fp"), F.lit(k).alias("size"), i.alias("p"), F.transform(
            F.sequence(i - before, i + (k - 1 + after)), lambda j: F.get(F.col("words"), j)).alias("near"))

    def whole(k):
        return lambda x, i: row(x, i, k, 0, 0)

    rows = [F.filter(F.transform("g", lambda x, i: F.when(keep(x, i), row(x, i, K, side, side))), lambda x: x.isNotNull())]
    for k in short:
        df = df.withColumn(f"g{k}", _grams("h", "n", k))
        rows.append(F.transform(f"g{k}", whole(k)))
    return df.withColumn("at", F.explode(F.concat(*rows))).select(
        *[c for c in df.columns if c in ("doc_id", "key", "item_id", "n")], "at.*")


def _small(df: DataFrame, words: Sequence[str] = ()) -> DataFrame:
    """``df`` marked for broadcast if its counted size allows it; ``words``: columns of strings or arrays of them."""
    held = [F.octet_length(F.array_join(c, "")) if t.startswith("array") else F.octet_length(c) for c, t in df.dtypes if c in words]
    size = sum((F.coalesce(b, F.lit(0)) for b in held), F.lit(0)).cast("long")
    r = df.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if r["rows"] <= BROADCAST_ROWS and r["bytes"] <= BROADCAST_BYTES else df


def _run(pairs: list[Column]) -> Column:
    """How many of the conditions hold before the first that doesn't."""
    total, so_far = F.lit(0), F.lit(True)
    for same in pairs:
        so_far = so_far & F.coalesce(same, F.lit(False))
        total = total + so_far.cast("int")
    return total


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Spans of benchmark windows in every document.

    ``docs``: ``doc_id``, ``text``; ``benchmark``: ``item_id``, ``text``; other columns are ignored, whatever
    their names. Returns one row per document row: ``doc_id, n_words, n_hit`` (words inside any occurrence of
    a window), ``spans`` (array of word ranges [start, end)), ``items`` (sorted item ids as strings). Null
    and empty texts have no words and no windows; a null item_id counts for hits, not in ``items``; equal
    rows give equal results; a null doc_id is kept. Empty tables give no rows, or rows without hits.
    """
    docs = docs.select("doc_id", "text").withColumn("key", F.xxhash64("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    items = _hashed(items, exact_words("text")).where("n_words > 0")
    lengths = items.where(F.col("n_words") < window).select("n_words").distinct()  # nine values at most
    short = sorted(r[0] for r in lengths.collect())
    prints = _chosen(items, window, short)
    # a short item is sought as a whole only, a longer one by its chosen grams only
    prints = prints.where((F.col("n") >= window) & (F.col("size") == K) & (F.size("near") == 2 * window - K)
                          | (F.col("n") < window) & (F.col("size") == F.col("n")) & (F.size("near") == F.col("n")))
    prints = landed(prints.drop("n"), "prints")

    # 1: documents that share a fingerprint; the null stands for the document itself
    first = _hashed(docs, exact_words("text")).withColumn("n", F.col("n_words").cast("int"))
    first = first.withColumn("g", _grams("h", "n", K))
    sought = [F.array_distinct(_least("g", "n", window)), *(F.array_distinct(_grams("h", "n", k)) for k in short)]
    first = first.select("doc_id", "key", "n_words", F.explode(
        F.concat(*sought, F.array(F.lit(None).cast("long")))).alias("fp"))
    known = _small(prints.select("fp").distinct().withColumn("known", F.lit(1)))
    first = first.join(known, "fp", "left").groupBy("doc_id", "key", "n_words").agg(
        F.sum(F.col("fp").isNull().cast("int")).alias("rows"), F.max("known").alias("known"))
    first = landed(first, "candidates")

    # 2: in those, every chosen gram that an item has too, extended on the words themselves
    again = _small(first.where("known = 1").select("doc_id", "key"))
    near = docs.alias("d").join(again.alias("a"), F.col("d.doc_id").eqNullSafe(F.col("a.doc_id"))
                                & (F.col("d.key") == F.col("a.key")), "left_semi").distinct()
    near = _chosen(_hashed(near, exact_words("text")), window, short)
    hit = near.join(_small(prints.select("fp", "size", "item_id", F.col("near").alias("theirs")), ["item_id", "theirs"]), ["fp", "size"])
    side = window - K
    same = [F.get("near", F.lit(i)) == F.get("theirs", F.lit(i)) for i in range(2 * side + K)]
    middle = reduce(lambda a, b: a & b, same[side : side + K])
    left, right = _run(same[:side][::-1]), _run(same[side + K :])
    whole = F.size("near") < 2 * side + K  # a short item
    hit = hit.where(F.size("near") == F.size("theirs")).select(
        "doc_id", "key", "item_id",
        F.when(whole, F.col("p")).otherwise(F.col("p") - left).alias("start"),
        F.when(whole, F.col("p") + F.size("near")).otherwise(F.col("p") + K + right).alias("end"),
        F.when(whole, F.col("near") == F.col("theirs")).otherwise(middle & (left + right + K >= window)).alias("ok"))
    found = hit.where("ok").groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("items"))
    joined = F.aggregate(  # spans in order of their starts become disjoint ones
        "spans", F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda done, x: F.when((F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= x["start"]), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
                F.get(done, F.size(done) - 1)["start"].alias("start"),
                F.greatest(F.get(done, F.size(done) - 1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(x))))
    found = found.withColumn("spans", joined).withColumn(
        "n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"])))
    out = first.alias("d").join(found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
                                & (F.col("d.key") == F.col("f.key")), "left")
    return out.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows")))).select(
        "d.doc_id", "d.n_words", F.coalesce("f.n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("f.spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans"),
        F.coalesce("f.items", F.expr("cast(array() as array<string>)")).alias("items"))


def op8_winnowing(spark, sf_dir: str) -> DataFrame:
    """The digest that op 8's contract asks for, over all documents and benchmark items."""
    from tidemark.llm.common import table

    out = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


OP8_SQL = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM doc),
found AS (
  SELECT doc_id, p, k, item_id FROM (
    SELECT doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') AS s, len(w) AS n
    FROM place, (SELECT DISTINCT k FROM win) WHERE p + k - 1 <= len(w)) JOIN win USING (k, s)),
covered AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (
  SELECT doc_id, unnest(range(p, p + k)) AS x FROM (SELECT DISTINCT doc_id, p, k FROM found)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
