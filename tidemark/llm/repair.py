"""Repair of conversation structure by weighted interval parsing (CYK).

The allowed order of roles is a small automaton over role initials. Its repair grammar in Chomsky normal form has a
symbol for every pair of states (p, q): the spans of rows that edits can turn into something that leads from p to q.
(p, q) goes into (p, r) (r, q); a row gives (p, q) by keeping, reroling or deleting it; nothing gives (p, q) by insertions, and
a row's cell is closed under those on both sides, which closes every longer span. A cell holds for each symbol the
least (cost, audit), the audit being the edits' initials in order. Two audits of a span with equal cost never are
prefixes of one another (an insertion costs), so least cells put together are least again.

Rows of a conversation are parsed in segments of bounded length, all spans of a segment bottom-up by length; the cells
of whole segments are then put together in runs by the same rules until one is left for the conversation. So a
conversation that holds most rows is many tasks; only its digest, one sha256 over its repaired text, is a single
stream through sorted rows, which keeps nothing but the audit.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import landed, slices, table

#: States of ``(s?(ua)+)?`` over role initials: 0 nothing yet, 1 after s, 2 after u, 3 after a.
PATTERN = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
START, ACCEPT = 0, (0, 3)
#: What can be inserted or reroled to, by initial; costs of the edits, and of a truncated row that stays.
ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Pairs of neighbouring initials that are in order.
LEGAL = ("su", "ua", "au")
#: Rows of a segment as a power of two, and segments put together at once as a power of two.
SEGMENT_BITS, RUN_BITS = 4, 6
SPACES = "\t\n\x0b\x0c\r "
SLICE_BYTES = 8 << 20

Cell = tuple  # for every symbol (cost, audit), or None where the span can't give it


def _reach() -> list[tuple[int, int]]:
    out = []
    for p in PATTERN:
        seen, todo = {p}, [p]
        while todo:
            for q in PATTERN[todo.pop()].values():
                if q not in seen:
                    seen.add(q), todo.append(q)
        out += [(p, q) for q in sorted(seen)]
    return out


SYMBOLS = _reach()
_AT = {s: i for i, s in enumerate(SYMBOLS)}
#: Binary rules: for every symbol the pairs of symbols it goes into.
BINARY = [[(_AT[p, r], _AT[r, q]) for r in PATTERN if (p, r) in _AT and (r, q) in _AT] for p, q in SYMBOLS]


def join(left: Cell, right: Cell) -> Cell:
    """Least (cost, audit) of every symbol over two neighbouring spans."""
    out = []
    for rules in BINARY:
        best = None
        for y, z in rules:
            a, b = left[y], right[z]
            if a is not None and b is not None and (best is None or a[0] + b[0] <= best[0]):
                new = (a[0] + b[0], a[1] + b[1])
                best = new if best is None or new < best else best
        out.append(best)
    return tuple(out)


def _least(*cells: Cell) -> Cell:
    return tuple(min((c for c in column if c is not None), default=None) for column in zip(*cells))


def _insertions() -> Cell:
    """What insertions alone give: closed under themselves."""
    step: list = [None] * len(SYMBOLS)
    for p, moves in PATTERN.items():
        step[_AT[p, p]] = (0, "")
        for x in ROLES:
            if x in moves:
                step[_AT[p, moves[x]]] = (INSERT, "I")
    cell = tuple(step)
    while (wider := _least(cell, join(cell, tuple(step)))) != cell:
        cell = wider
    return cell


EMPTY = _insertions()


#: Cells already found, in each worker. Plain dicts: a function under ``lru_cache`` doesn't travel with its task.
_ROWS: dict = {}
_PARSED: dict = {}


def _row(token: str) -> Cell:
    """The cell of one row: ``token`` is its initial and its fault (``.`` none, ``~`` truncated, ``!`` must go)."""
    if token in _ROWS:
        return _ROWS[token]
    initial, fault = token
    cell: list = [None] * len(SYMBOLS)
    for p, moves in PATTERN.items():
        edits = [(p, (DELETE, "D"))]
        if fault != "!":
            extra = TRUNCATED if fault == "~" else 0
            edits += [(q, (KEEP + extra, "K")) for x, q in moves.items() if x == initial]
            edits += [(q, (REROLE + extra, "R")) for x, q in moves.items() if x in ROLES]
        for q, way in edits:
            at = _AT[p, q]
            cell[at] = way if cell[at] is None else min(cell[at], way)
    _ROWS[token] = join(join(EMPTY, tuple(cell)), EMPTY)
    return _ROWS[token]


def parse(tokens: str) -> Cell:
    """The cell of a whole segment (two letters a row): all its spans, bottom-up by length."""
    if tokens in _PARSED:
        return _PARSED[tokens]
    rows = [_row(tokens[i : i + 2]) for i in range(0, len(tokens), 2)]
    spans = {(i, i + 1): cell for i, cell in enumerate(rows)}
    for length in range(2, len(rows) + 1):
        for i in range(len(rows) - length + 1):
            j = i + length
            spans[i, j] = _least(*(join(spans[i, k], spans[k, j]) for k in range(i + 1, j)))
    if len(_PARSED) >= 1 << 16:
        _PARSED.clear()
    _PARSED[tokens] = spans[0, len(rows)] if rows else EMPTY
    return _PARSED[tokens]


def best(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair."""
    return min(cell[_AT[START, q]] for q in ACCEPT if (START, q) in _AT and cell[_AT[START, q]] is not None)


def repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) after the edits of ``audit``, as ``rows`` go by. What remains alternates, so its number tells roles."""
    at = sum(x != "D" for x in audit) % 2   # odd: a kept first row comes before the pairs
    names = list(ROLES.values())
    for x in audit:
        role, text = ("", "") if x == "I" else next(rows)
        if x == "D":
            continue
        yield (role if x == "K" else names[at % 2]), text
        at += 1


# --- tables -----------------------------------------------------------------------------------------


def in_order(turns: DataFrame, tiebreak: Sequence[str] = ("role", "text")) -> DataFrame:
    """``conv_id, turn, role, text`` with ``at``: a number that rises through every conversation, by turn (nulls first).

    Ranges of the whole order are cut over all conversations; a row's place in its range makes up ``at``.
    """
    order = ["conv_id", "turn", *tiebreak]
    d = turns.select("conv_id", "turn", "role", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    return landed(d.withColumn("at", F.monotonically_increasing_id()), "turns")


def _faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, at, initial, fault`` (blank, duplicate, truncated, or none) of ordered rows."""
    tail = F.rtrim(F.col("text"), F.lit(SPACES))
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    d = rows.select("conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), said.alias("said"),
                    (tail == "").alias("blank"), (~F.right(tail, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    first = d.groupBy("conv_id", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    d = d.join(first, "at", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("new").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    return d.select("conv_id", "turn", "at", "initial", fault.alias("fault"))


#: What a run of rows says: distinct turns, first and last of them, first and last initial, illegal neighbours, blank,
#: duplicate and truncated rows, cells.
def _summary(turns: list, initials: list[str], faults: list[str]) -> list:
    known = [t for t in turns if t is not None]
    token = "".join((x if x in ("s", "u", "a") else "-") + {"": ".", "truncated": "~"}.get(f, "!") for x, f in zip(initials, faults))
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    return [len(set(known)), min(known, default=None), max(known, default=None), initials[0], initials[-1], illegal,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")), parse(token)]


def _together(runs: list[list]) -> list:
    """Neighbouring runs as one."""
    out = runs[0]
    for r in runs[1:]:
        same = out[2] is not None and out[2] == r[1]
        out = [out[0] + r[0] - same, out[1] if out[1] is not None else r[1], r[2] if r[2] is not None else out[2], out[3], r[4],
               out[5] + r[5] + (out[4] + r[3] not in LEGAL), out[6] + r[6], out[7] + r[7], out[8] + r[8], join(out[9], r[9])]
    return out


def _loaded(text: str) -> list:
    run = json.loads(text)
    run[9] = tuple(c if c is None else (c[0], c[1]) for c in run[9])
    return run


def parse_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, run``: what every conversation's rows say together (JSON). Segments first, then runs of segments."""

    @F.pandas_udf("string")
    def segment(turns: pd.Series, initials: pd.Series, faults: pd.Series) -> pd.Series:
        def one(t, i, f):
            return json.dumps(_summary([None if pd.isna(x) else int(x) for x in t], list(i), list(f)))
        return pd.Series([one(t, i, f) for t, i, f in zip(turns, initials, faults)], dtype=object)

    @F.pandas_udf("string")
    def merge(runs: pd.Series) -> pd.Series:
        return pd.Series([r[0] if len(r) == 1 else json.dumps(_together([_loaded(x) for x in r])) for r in runs], dtype=object)

    def ordered(name: str):
        return F.transform("rows", lambda r: r[name].cast("string")).alias(name)

    d = _faults(rows).withColumn("run_no", F.shiftright("at", SEGMENT_BITS))
    d = d.groupBy("conv_id", "run_no").agg(F.array_sort(F.collect_list(F.struct("at", "turn", "initial", "fault"))).alias("rows"))
    d = d.select("conv_id", "run_no", ordered("turn"), ordered("initial"), ordered("fault"))
    d = landed(d.select("conv_id", "run_no", segment("turn", "initial", "fault").alias("run")), "runs")
    while True:
        most = d.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        number = F.shiftright("run_no", RUN_BITS) if most > 1 << RUN_BITS else F.lit(0)
        d = d.groupBy("conv_id", number.alias("run_no")).agg(F.array_sort(F.collect_list(F.struct("run_no", "run"))).alias("rows"))
        d = d.select("conv_id", "run_no", merge(F.transform("rows", lambda r: r["run"])).alias("run"))
        if most <= 1 << RUN_BITS:
            return d.select("conv_id", "run")
        d = landed(d, "runs")


OUT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
       "repaired_sha256 string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from rows sorted by it: its run first, then its turns, hashed as they go by."""
    import itertools

    def rows():
        for batch in batches:
            for part in slices(batch, ["text"], SLICE_BYTES):
                yield from zip(*(part.column(c).to_pylist() for c in ("conv_id", "at", "run", "role", "text")))

    held: list[list] = []
    names = [f.split()[0] for f in OUT.split(", ")]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in OUT.split(", ")]

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    for conv, mine in itertools.groupby(rows(), key=lambda r: r[0]):
        run, digest = None, hashlib.sha256()
        first = next((r for r in mine if r[1] != -2), None)        # past the marks that the conversation exists
        counts, cost, audit = [0] * 5, 0, ""
        if first is not None:
            run = _loaded(first[2])
            counts = [run[2] - run[1] + 1 - run[0] if run[0] else 0, run[6], run[7], run[8], run[5]]
            cost, audit = best(run[9])
            for n, (role, text) in enumerate(repaired(audit, ((r[3], r[4]) for r in mine))):
                digest.update(("\n" if n else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        held.append([conv, *counts, cost, audit, digest.hexdigest()])
        if len(held) == 1000:
            yield out()
            held = []
    if held:
        yield out()


def repair_conversations(turns: DataFrame, everyone: DataFrame | None = None) -> DataFrame:
    """Faults, cheapest repair and the repaired text's digest of every conversation.

    ``turns``: ``conv_id, turn`` (integers), ``role, text``; other columns are ignored, whatever their names.
    ``everyone``: a frame whose ``conv_id`` are to be returned even if they have no turns. Rows go by turn, nulls first;
    rows that share a turn by role, then text; rows that repeat are turns of their own (the later ones duplicates). A
    null role or text is one space; rows without conv_id are one conversation. An empty text is blank; long texts are
    hashed as they go by. An empty table gives no rows.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    rows = in_order(turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *text))
    no_text = F.lit(None).cast("string")
    runs = parse_conversations(rows).select("conv_id", F.lit(-1).cast("long").alias("at"), "run", no_text.alias("role"), no_text.alias("text"))
    said = rows.select("conv_id", "at", no_text.alias("run"), "role", "text")
    both = runs.unionByName(said)
    if everyone is not None:
        marks = everyone.select(F.col("conv_id").cast("long")).distinct()
        both = both.unionByName(marks.select("conv_id", F.lit(-2).cast("long").alias("at"), no_text.alias("run"), no_text.alias("role"), no_text.alias("text")))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "at").mapInArrow(_digests, OUT)


#: Kinds of damage of the contract, by crc32 of ``conv_id:turn`` modulo KINDS.
KINDS, DROP, EMPTIED, UNENDED, REPEATED, AS_USER = 20, 0, 1, 2, 3, 4


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the contract's damage; nulls are one space."""
    one = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(one["conv_id"], F.lit(":"), one["turn"])) % KINDS
    d = turns.select("conv_id", "turn", one["role"].alias("role"), one["text"].alias("text"), kind.alias("kind")).where(F.col("kind") != DROP)
    text = F.when(F.col("kind") == EMPTIED, "").when(F.col("kind") == UNENDED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == AS_USER, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == REPEATED, 2).otherwise(1)
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def op12_repair(spark, sf_dir: str) -> DataFrame:
    """The rows that op 12's contract asks for, over all conversations."""
    turns = table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(turns), turns)
