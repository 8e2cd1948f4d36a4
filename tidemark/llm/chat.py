"""Chat conversations as budgeted training windows, in DataFrame functions only.

Every turn becomes ``<|im_start|>role newline text <|im_end|> newline``. A turn counts as many tokens as that has UTF-8
bytes, which no byte-level tokenizer exceeds in any script. Prefix sums of those
place every turn on its conversation's axis; the axis is cut every ``stride`` tokens and a turn belongs to the
cut it lies in. A turn that crosses a cut is a window of its own, so a window holds one turn, or turns
that fit into the stride. Before its own turns a window repeats the leading system turn, and as many of
the turns just before as fit into ``history`` tokens; only assistant turns of its own are targets, so each
is a target once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import landed

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Tokens (bytes) of a window's own turns, and of the history it repeats; the system turn comes on top.
STRIDE, HISTORY = 4096, 1024
#: Turns summed as one block before the blocks are.
TURNS = 256

#: Control strings of common chat templates, split after their first character. A backslash goes there, one
#: more than there are, so no control string is left and each escape can be undone.
_REST = r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"
_PLAIN, _ESCAPED = r"([<\[])(\\*)" + _REST, r"([<\[])\\(\\*)" + _REST


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _turns(conversations: DataFrame) -> DataFrame:
    """Turns with their place on the conversation's axis: ``start`` and ``end`` in tokens, ``nth`` from 0.

    Two sums: within blocks of turn numbers, and over the blocks' totals; no task holds a conversation.
    """
    t = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    marks = len(BEGIN) + len(END) + 2
    t = t.withColumn("tokens", (F.octet_length(F.url_encode("role")) + F.octet_length(escape(F.col("text"))) + marks).cast("long"))
    t = t.withColumn("block", F.floor(F.col("turn") / TURNS))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    t = t.withColumn("end", F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.withColumn("nth", F.row_number().over(inside) - 1)
    blocks = t.groupBy("conv_id", "block").agg(F.sum("tokens").alias("all"), F.count(F.lit(1)).alias("many"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                           F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"),
                           F.coalesce(F.sum("many").over(before), F.lit(0)).alias("turns"))
    t = t.join(blocks, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    return t.select("conv_id", "role", "text", "tokens", (F.col("nth") + F.col("turns")).alias("nth"),
                    (F.col("end") + F.col("offset") - F.col("tokens")).alias("start"), (F.col("end") + F.col("offset")).alias("end"))


def format_windows(conversations: DataFrame, stride: int = STRIDE, history: int = HISTORY) -> DataFrame:
    """Training windows of all conversations.

    ``conversations``: ``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored, whatever their names.
    Turns go by ``turn`` (null first), then role and text; repeated rows are turns of their own; a null role or
    text is empty; a null conv_id is a conversation. Returns one row per window: ``conv_id, window`` (its
    order), ``formatted``, ``n_repeated`` (leading turns that are context only), ``loss`` (array of 0-based
    code-point ranges [start, end) of the targets' escaped texts in ``formatted``) and ``tokens``. A turn
    longer than the stride is kept whole, alone. An empty table gives no rows.
    """
    t = landed(_turns(conversations), "turns")
    cut = F.floor((F.col("end") - 1) / stride)
    crosses = F.floor(F.col("start") / stride) < cut
    t = t.withColumn("window", 2 * cut + F.when(crosses, 0).otherwise(1))
    windows = t.groupBy("conv_id", "window").agg(F.min("start").alias("at"))
    # a turn is history of the windows that begin within ``history`` tokens of its start, after it
    reach = F.sequence(F.floor(F.col("end") / stride), F.floor((F.col("start") + history) / stride) + 1)
    past = t.where(F.col("tokens") <= history).withColumn("cell", F.explode(reach)).select(
        "conv_id", "cell", "nth", "role", "text", "tokens", "start", "end")
    begin = windows.select(F.col("conv_id").alias("c"), F.col("window").alias("w"), "at", F.floor(F.col("at") / stride).alias("cell_at"))
    past = past.join(begin, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("cell") == F.col("cell_at"))).where(
        (F.col("end") <= F.col("at")) & (F.col("at") - F.col("start") <= history))
    past = past.where(~((F.col("nth") == 0) & (F.col("role") == "system")))
    system = t.where("nth = 0 and role = 'system'").select("conv_id", "nth", "role", "text", "tokens")
    lead = begin.where("at > 0").join(system, F.col("c").eqNullSafe(F.col("conv_id")))
    columns = ["conv_id", "window", "nth", "role", "text", "tokens", "own"]
    pieces = t.withColumn("own", F.lit(1)).select(*columns).unionByName(
        past.withColumn("window", F.col("w")).withColumn("own", F.lit(0)).select(*columns)).unionByName(
        lead.withColumn("window", F.col("w")).withColumn("own", F.lit(0)).select(*columns))
    pieces = pieces.withColumn("head", F.concat(F.lit(BEGIN), F.url_encode("role"), F.lit("\n")))
    pieces = pieces.withColumn("body", escape(F.col("text")))
    rows = pieces.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(
        F.struct("nth", "own", "head", "body", "role"))).alias("p"), F.sum("tokens").alias("tokens"))
    tail = END + "\n"
    rows = rows.withColumn("formatted", F.array_join(F.transform(
        "p", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), ""))
    spans = F.aggregate(
        "p", F.expr("named_struct('at', 0, 'loss', cast(array() as array<struct<start:int,end:int>>))"),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["head"]) + F.length(x["body"]) + len(tail)).alias("at"),
            F.when((x["own"] == 1) & (x["role"] == "assistant"), F.concat(s["loss"], F.array(F.struct(
                (s["at"] + F.length(x["head"])).alias("start"),
                (s["at"] + F.length(x["head"]) + F.length(x["body"])).alias("end"))))).otherwise(s["loss"]).alias("loss")))
    return rows.select("conv_id", "window", "formatted", F.size(F.filter("p", lambda x: x["own"] == 0)).alias("n_repeated"),
                       spans["loss"].alias("loss"), "tokens")


def read_windows(windows: DataFrame) -> DataFrame:
    """Each window's own turns and targets, parsed from its text: adds ``turns`` (array of role, text) and
    ``targets`` (array of texts), unescaped."""
    parts = F.split("formatted", r"\Q" + END + r"\E" + "\n")
    parts = F.slice(parts, F.col("n_repeated") + 1, F.size(parts))
    parts = F.filter(parts, lambda x: x != "")
    turn = F.transform(parts, lambda x: F.struct(
        F.url_decode(F.substring_index(F.substring(x, F.lit(len(BEGIN) + 1), F.length(x)), "\n", 1)).alias("role"),
        unescape(F.substring(x, F.instr(x, "\n") + 1, F.length(x))).alias("text")))
    targets = F.transform("loss", lambda x: unescape(F.substring(F.col("formatted"), x["start"] + 1, x["end"] - x["start"])))
    return windows.withColumn("turns", turn).withColumn("targets", targets)


def op2_chat(spark, sf_dir: str) -> DataFrame:
    """The digest that op 2's contract asks for, over all conversations and conversation -7, read back."""
    from tidemark.llm.common import table

    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    read = read_windows(landed(format_windows(rows.unionByName(extra)), "chat"))
    each = read.select("conv_id", "window", F.size("turns").alias("n"), F.array_join(F.transform(
        "turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("loss"), F.length("formatted").alias("chars"))
    # a digest of a whole conversation needs its text in one value
    whole = each.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(
        F.collect_list(F.struct("window", "turns", "loss"))).alias("w"))
    turns, loss = F.array_join(F.col("w.turns"), ""), F.array_join(F.col("w.loss"), "")
    return whole.select("conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
                        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
