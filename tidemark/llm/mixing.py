"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source should be taken ``target / source size`` times: a whole number of copies and a
fraction. Pivotal rounding settles the fractions: two documents exchange words' worth of probability (the
first gains what the second loses, by size) until one of them is 0 or 1, in a direction drawn so that
both expectations stay; the other goes on to the next. The taken words of a source thereby stay at the
target but for the last fraction. Documents of a source are dealt into blocks of about ``FAN``; a block is
one fold and leaves one fraction; the fractions of ``FAN`` blocks meet in the next level of the tree. All draws
are hashes of the seed, the level and the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import landed

#: Words of the contract.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Documents or fractions that one fold settles.
FAN = 64
#: Documents longer than so many times their source's mean size settle first, then those over the next.
LENGTHS = (8, 1)
SEED = 17


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size`` -> with ``target``: ``share`` of all words by weight, none above ``most`` times its size.

    Weights go to the sources in code-point order, null last, over and over. Order comes from a range
    partitioning and one count for each partition, so no task sorts all sources. What exceeds a limit is
    shared by weight among the others: a common factor of the weights that grows until the set of limited
    sources stays; each round is one aggregate of two numbers.
    """
    ranged = sizes.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id())
    ranged = landed(ranged, "sources")
    counts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = Window.partitionBy("part").orderBy(F.asc_nulls_last("source"))
    ranked = ranged.join(counts.withColumn("before", before), "part").withColumn(
        "rank", F.col("before") + F.row_number().over(within) - 1)
    weight = F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights)).cast("double")
    ranked = landed(ranked.select(*sizes.columns, weight.alias("weight"),
                                  (F.col("source_size") * F.lit(float(most))).alias("limit")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    factor, limited = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(factor) >= F.col("limit")
        row = ranked.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
                         F.sum(full.cast("long"))).first()
        if row[2] is None or row[2] == limited or not row[1]:
            break
        limited, factor = row[2], (share * total - row[0]) / row[1]
    return ranked.select(*sizes.columns, F.least(F.col("weight") * F.lit(factor), F.col("limit")).alias("target"))


def _draw(seed: int, level: int, *cols: Column) -> Column:
    """Uniform in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(level), *cols), F.lit(1 << 52)).cast("double") / float(1 << 52)


_UNIT = "struct<doc_id:bigint,nth:int,size:bigint,p:double>"
_STATE = f"named_struct('left', cast(null as {_UNIT}), 'done', cast(array() as array<{_UNIT}>))"


def _unit(x: Column, p: Column) -> Column:
    return F.struct(x["doc_id"].alias("doc_id"), x["nth"].alias("nth"), x["size"].alias("size"), p.alias("p"))


def _fold(units: Column, seed: int, level: int) -> Column:
    """Pivotal rounding along an array: ``left`` (a unit still fractional, or null) and ``done`` (p is 0 or 1)."""
    def step(state: Column, b: Column) -> Column:
        a, done = state["left"], state["done"]
        sa, sb = a["size"].cast("double"), b["size"].cast("double")
        a_full, b_empty = sa * (1 - a["p"]), sb * b["p"]       # words until a is 1, or b is 0
        a_empty, b_full = sa * a["p"], sb * (1 - b["p"])
        up, down = F.least(a_full, b_empty), F.least(a_empty, b_full)
        rise = _draw(seed, level, a["doc_id"], a["nth"], b["doc_id"], b["nth"]) * (up + down) < down
        one, none = F.lit(1.0), F.lit(0.0)
        pa = F.when(rise, F.when(a_full <= b_empty, one).otherwise(a["p"] + b_empty / sa)).otherwise(
            F.when(a_empty <= b_full, none).otherwise(a["p"] - b_full / sa))
        pb = F.when(rise, F.when(b_empty <= a_full, none).otherwise(b["p"] - a_full / sb)).otherwise(
            F.when(b_full <= a_empty, one).otherwise(b["p"] + a_empty / sb))
        a2, b2 = _unit(a, pa), _unit(b, pb)
        settled = F.array(a2, b2)
        settled = F.filter(settled, lambda u: (u["p"] <= 0) | (u["p"] >= 1))
        open_ = F.get(F.filter(F.array(a2, b2), lambda u: (u["p"] > 0) & (u["p"] < 1)), F.lit(0))
        return F.when(a.isNull(), F.struct(b.alias("left"), done.alias("done"))).otherwise(
            F.struct(open_.alias("left"), F.concat(done, settled).alias("done")))

    return F.aggregate(units, F.expr(_STATE), step)


def _settle(units: DataFrame, seed: int, salt: int) -> DataFrame:
    """Pivotal rounding of ``source, unit, base`` (0 < p < 1, size > 0) down to whole copies, source by source."""
    counts = units.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    open_ = units.join(counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "base", "unit", F.ceil(F.col("n") / FAN).alias("blocks"))
    settled, level = units.select("source", "base", "unit").limit(0), salt
    while most > 0:
        block = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "unit.doc_id", "unit.nth"), F.col("blocks"))
        folded = open_.groupBy("source", "base", "blocks", block.alias("block")).agg(
            F.sort_array(F.collect_list("unit")).alias("units"))
        folded = landed(folded.select("source", "base", "blocks", _fold(F.col("units"), seed, level).alias("f")), "rounding")
        settled = settled.unionByName(folded.select("source", "base", F.explode("f.done").alias("unit")))
        left = folded.where("f.left is not null").select("source", "base", F.col("f.left").alias("unit"), "blocks")
        if most <= FAN:  # one block a source was left, so one fraction each remains
            last = _draw(seed, level + 1, F.col("unit.doc_id"), F.col("unit.nth")) < F.col("unit.p")
            return settled.unionByName(left.select("source", "base", _unit(F.col("unit"), last.cast("double")).alias("unit")))
        open_ = left.withColumn("blocks", F.ceil(F.col("blocks") / FAN))
        most, level = -(-most // FAN), level + 1
    return settled


def choose_copies(units: DataFrame, seed: int = SEED) -> DataFrame:
    """Whole copies for units ``source, doc_id, nth, size, ratio, mean`` (wanted copies; mean size in the source).

    Long documents settle first, then middling, then short ones. The words by which a source's last long
    document misses its fraction are spread over its shorter ones' fractions (the expected miss is 0, so
    every document's expected copies stay), and the final miss is that of one short document.
    """
    whole = F.floor("ratio")
    units = units.withColumn("base", whole.cast("int")).withColumn("p", F.col("ratio") - whole)
    units = units.withColumn("length", F.when((F.col("p") <= 0) | (F.col("size") <= 0), -1).otherwise(
        F.lit(len(LENGTHS)) - sum((F.col("size") > F.col("mean") * x).cast("int") for x in LENGTHS)))
    units = landed(units, "units")
    plain = units.where("length < 0").withColumn("more", (_draw(seed, -1, F.col("doc_id"), F.col("nth")) < F.col("p")).cast("int"))
    out = plain.select("source", "doc_id", "nth", "size", (F.col("base") + F.col("more")).alias("copies"))
    miss = units.select("source").distinct().withColumn("miss", F.lit(0.0))
    for i in range(len(LENGTHS) + 1):
        some = units.where(F.col("length") == i)
        words = some.groupBy("source").agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col("p")).alias("wanted"))
        words = miss.alias("m").join(words.alias("w"), F.col("m.source").eqNullSafe(F.col("w.source")), "left").select(
            F.col("m.source").alias("s"), "miss", "words", "wanted",
            F.coalesce(F.col("miss") / F.col("words"), F.lit(0.0)).alias("shift"))
        words = landed(words, "misses")
        p = F.least(F.greatest(F.col("p") - F.col("shift"), F.lit(0.0)), F.lit(1.0))
        some = some.join(words.select("s", "shift"), F.col("source").eqNullSafe(F.col("s"))).select(
            "source", "base", F.struct("doc_id", "nth", "size", p.alias("p")).alias("unit"))
        sure = (F.col("unit.p") <= 0) | (F.col("unit.p") >= 1)
        done = landed(_settle(some.where(~sure), seed, 100 * i).unionByName(some.where(sure).select("source", "base", "unit")), "copies")
        out = out.unionByName(done.select("source", "unit.doc_id", "unit.nth", "unit.size",
                                          (F.col("base") + F.col("unit.p").cast("int")).alias("copies")))
        got = done.groupBy("source").agg(F.sum(F.col("unit.size") * F.col("unit.p")).alias("got"))
        miss = words.join(got, F.col("s").eqNullSafe(F.col("source")), "left").select(
            F.col("s").alias("source"), (F.col("miss") + F.coalesce("got", F.lit(0.0)) - F.coalesce("wanted", F.lit(0.0))).alias("miss"))
    return out


def mix_sources(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """How often to take each document so that sources meet their target words.

    ``docs``: ``doc_id`` (integer), ``text``, ``source``; other columns are ignored, whatever their names.
    Returns one row per input row: ``doc_id, source, nth, size`` (words), ``source_size, target`` (words, of
    its source), ``copies`` (0 to 2), ``taken`` (copies * size). ``nth`` numbers the rows that share doc_id,
    source and size, from 1; each is decided by itself. Null and empty texts have size 0 and a source of
    nothing else the target 0. A null source is a source. An empty table gives no rows.
    """
    units = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count("text").alias("size"))
    units = landed(units.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                        F.sum("rows").alias("rows"))
    targets = source_targets(sizes).withColumnRenamed("source", "s")
    units = units.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = units.join(targets.alias("t"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "doc_id", "nth", "size", ratio.alias("ratio"), (F.col("source_size") / F.col("t.rows")).alias("mean"))
    chosen = choose_copies(wanted, seed)
    return chosen.join(targets, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "nth", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents that op 5's contract asks for."""
    from tidemark.llm.common import table

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
