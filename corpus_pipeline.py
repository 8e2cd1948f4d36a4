"""The corpus pipeline: grade, drop near copies, decontaminate, mix, write token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as
the next stage's ``docs``. All but the last return the columns of ``documents``. Each stage works on all that
its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.bagminhash import near_duplicate_classes
from tidemark.llm.common import checkpoint_dir, landed, table
from tidemark.llm.mixing import mix_sources, word_count
from tidemark.llm.quality import fit_grader, grade_documents
from tidemark.llm.tokenfiles import read_tokens, write_tokens
from tidemark.llm.winnowing import find_contamination

#: A document stays if it is usable (grade above 0) with this probability.
USABLE = 0.5


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have (names are compared without case)."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _columns(docs: DataFrame, of: str = "") -> list:
    """All columns by name, whatever the names (``of``: alias and dot)."""
    return [F.col(f"{of}`{c}`") for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal grader finds usable. Rows of equal text share their fate; a null or
    empty text is judged by the prior grades."""
    grader = fit_grader(docs, table(spark, sf_dir, "labels"))
    names = _unused(docs, "expected_grade"), _unused(docs, "p_usable")
    graded = grade_documents(docs, grader, passthrough=True, names=names)
    return graded.where(F.col(names[1]) >= USABLE).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the row of its least doc_id, of rows that repeat that id the first
    by a hash of the text. Rows are judged by their texts alone: unlike ones stay, also where they share a doc_id. Rows
    without doc_id are nobody's copies and stay."""
    known, names = docs.where("doc_id is not null"), _columns(docs)
    alone = docs.where("doc_id is null").select(*names)
    repeated = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():      # the doc_id tells the rows
        first = near_duplicate_classes(known).where("doc_id = class_id").select("doc_id").distinct()
        return known.join(first, "doc_id", "left_semi").select(*names).unionByName(alone)
    row = _unused(docs, "row")
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]]
    numbered = known.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(*order)
    numbered = landed(numbered.withColumn(row, F.monotonically_increasing_id()), "numbered")
    classes = near_duplicate_classes(numbered.select(F.col(row).alias("doc_id"), "text"))
    first = classes.where("doc_id = class_id").select(F.col("doc_id").alias(row)).distinct()
    return numbered.join(first, row, "left_semi").select(*names).unionByName(alone)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any word inside a benchmark window; rows that repeat a doc_id go together."""
    hit = find_contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0")
    hit = landed(hit.select("doc_id").distinct(), "contaminated")
    return docs.alias("d").join(hit.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")), "left_anti").select(*_columns(docs, "d."))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (none to two rows)."""
    chosen = landed(mix_sources(docs).where("copies > 0").select("doc_id", "source", "size", "nth", "copies"), "mix")
    size, nth, copy = (_unused(docs, c) for c in ("size", "nth", "copy"))
    keyed = docs.withColumn(size, word_count("text"))
    order = Window.partitionBy("doc_id", "source", size).orderBy(F.xxhash64("text"))
    keyed = keyed.withColumn(nth, F.row_number().over(order)).alias("d")
    c = chosen.alias("c")
    both = keyed.join(c, F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.source").eqNullSafe(F.col("c.source"))
                      & (F.col(f"d.{size}") == F.col("c.size")) & (F.col(f"d.{nth}") == F.col("c.nth")))
    both = both.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("c.copies"))))
    return both.select(*_columns(docs, "d."))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Token files of the mix, read back: where each document lies and a checksum of its ids."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    return read_tokens(write_tokens(docs, folder, tokenizer), with_ids=False)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

#: Models, tokenizer and random rounding can't be said in SQL; tests/llm holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
