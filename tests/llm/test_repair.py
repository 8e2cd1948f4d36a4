"""Conversation repair against a plain search over edits, and its queries against plain Python."""

import hashlib
import itertools
import os
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import repair
from tidemark.llm.repair import best, damaged, join, parse, repair_conversations

#: Names that the operator uses inside, as extra columns of the input.
CLASH = ["at", "run", "run_no", "rows", "initial", "fault", "said", "new", "kind", "copy", "gaps", "cost", "audit"]
SCHEMA = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\x0b\x0c\r"


def by_search(tokens):
    """Cheapest edits by trying all: (cost, audit, role initials), for short conversations."""
    found = []
    room = len(tokens) + 3

    def go(i, cost, audit, roles):
        if found and cost > found[0][0] or len(roles) > room:
            return
        if i == len(tokens) and GOOD.match(roles):
            found.append((cost, audit, roles))
            found.sort()
        for x in "ua":
            go(i, cost + 2, audit + "I", roles + x)
        if i < len(tokens):
            initial, fault = tokens[i]
            go(i + 1, cost + 3, audit + "D", roles)
            if fault != "!":
                go(i + 1, cost + (fault == "~"), audit + "K", roles + initial)
                for x in "ua":
                    go(i + 1, cost + 2 + (fault == "~"), audit + "R", roles + x)

    go(0, 0, "", "")
    return found[0][:2]


def test_cells_equal_a_search_over_all_edits():
    kinds = ["s.", "u.", "a.", "-.", "u~", "a!"]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            assert best(parse("".join(rows))) == by_search(rows), rows


def by_steps(tokens):
    """Cheapest edits row by row, over the states of the pattern."""
    now = {0: (0, "")}

    def widen(now):
        while True:
            new = dict(now)
            for p, (c, a) in now.items():
                for x in "ua":
                    if x in repair.PATTERN[p]:
                        q = repair.PATTERN[p][x]
                        new[q] = min(new.get(q, (1 << 60, "")), (c + 2, a + "I"))
            if new == now:
                return now
            now = new

    for initial, fault in tokens:
        now = widen(now)
        new = {}
        for p, (c, a) in now.items():
            ways = [(p, c + 3, "D")]
            if fault != "!":
                more = fault == "~"
                ways += [(q, c + more, "K") for x, q in repair.PATTERN[p].items() if x == initial]
                ways += [(q, c + 2 + more, "R") for x, q in repair.PATTERN[p].items() if x in "ua"]
            for q, cost, letter in ways:
                new[q] = min(new.get(q, (1 << 60, "")), (cost, a + letter))
        now = new
    now = widen(now)
    return min(now[q] for q in (0, 3) if q in now)


def test_segments_put_together_equal_one_parse():
    import random

    rnd = random.Random(5)
    for _ in range(200):
        rows = [rnd.choice("suua-") + rnd.choice("...~!") for _ in range(rnd.randrange(1, 14))]
        cut = rnd.randrange(0, len(rows) + 1)
        whole = parse("".join(rows))
        assert best(whole) == by_steps(rows)
        assert best(join(parse("".join(rows[:cut])), parse("".join(rows[cut:])))) == best(whole)


def plain(rows, convs):
    """The contract in plain Python; rows: (conv_id, turn, role, text) after damage."""
    out = {}
    for conv in convs:
        mine = sorted([r[1:] for r in rows if r[0] == conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        if not mine:
            out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
            continue
        seen, faults = set(), []
        for _, role, text in mine:
            tail = text.strip(SPACE)
            faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else "")
            seen.add((role, text))
        first = [r[1][:1] for r in mine]
        turns = {r[0] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit = by_steps([(x if x in ("s", "u", "a") else "-") + {"": ".", "truncated": "~"}.get(f, "!") for x, f in zip(first, faults)])
        kept = [x for x in audit if x != "D"]
        names = ["system"] * (len(kept) % 2) + ["user", "assistant"] * (len(kept) // 2)
        lines, at, n = [], 0, 0
        for x in audit:
            role, text = ("", "") if x == "I" else mine[at][1:]
            at += x != "I"
            if x == "D":
                continue
            lines.append(f"{role if x == 'K' else names[n]}:{text}")
            n += 1
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def collected(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in names) for r in rows}
    assert len(out) == len(rows)
    return out


ODD = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, None, "user", "a"), (2, None, "user", "a"), (2, 5, None, None),
       (3, 0, "", "x."), (3, 1, "tool", "y!"), (3, 1, "assistant", "z?"), (3, 9, "system", "late."), (None, 0, "user", "who?"),
       (None, None, "assistant", " \t\n"), (4, 0, "user", "long. " * 60_000), (4, 1, "assistant", "é　."), (5, 7, "user", ""),
       (6, -3, "user", "q."), (6, 4, "user", "q."), (6, 4, "assistant", "q."), (8, 0, "ünknown", "ok.")]


def test_odd_rows_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_BITS", 1)
    monkeypatch.setattr(repair, "RUN_BITS", 1)
    rows = ODD + [(9, i, ["user", "assistant", "user"][i % 3], f"turn {i % 17}" + "." * (i % 2)) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    everyone = spark.createDataFrame([(7,), (None,), (1,)], "conv_id long")
    said = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert collected(repair_conversations(df, everyone)) == plain(said, {r[0] for r in rows} | {7})
    assert repair_conversations(df.limit(0)).count() == 0


def test_damage_equals_plain_python(spark):
    rows = ODD + [(c, t, "user", f"What? {c}. And {t}!") for c in range(20) for t in range(10)]
    want = []
    for conv, turn, role, text in rows:
        one = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        kind = zlib.crc32(f"{one[0]}:{one[1]}".encode()) % 20
        role, text = one[2:]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    got = [tuple(r) for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
def test_query_equals_plain_python_on_the_whole_table(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in damaged(turns).collect()]
    convs = {r[0] for r in turns.select("conv_id").collect()}
    assert collected(repair.op12_repair(spark, SF)) == plain(rows, convs)
