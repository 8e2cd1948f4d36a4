import random

from tidemark.llm import chat as C

CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string, nth int, start string")


def read(df, **k):
    out = {}
    for r in C.read_windows(C.format_windows(df, **k)).orderBy("conv_id", "window").collect():
        turns, targets, windows = out.setdefault(r.conv_id, ([], [], []))
        turns += [(t.role, t.text) for t in r.turns]
        targets += r.targets
        windows.append(r)
    return out


def test_round_trip_and_budget(spark):
    rnd = random.Random(4)
    pieces = CONTROL + ["\\", "[\\INST]", "[\\\\/INST]", "<", "é𐍈", "\n", " plain words ", "\\Q", "$1"]
    rows = []
    for c in range(25):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * rnd.randint(0, 9)
        for i, role in enumerate(roles):
            text = "".join(rnd.choices(pieces, k=rnd.randint(0, 60))) * rnd.choice([1, 1, 1, 9])
            rows.append((c, i, role, text, "x", 0, None))
    out = read(conversations(spark, rows).repartition(4), stride=1200, history=400)
    for c in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == c]
        turns, targets, windows = out[c]
        assert turns == [(r[2], r[3]) for r in mine]                              # every turn once, in order
        assert targets == [r[3] for r in mine if r[2] == "assistant"]             # every target once
        at = 0
        for w in windows:
            own = len(w.turns)
            spoken = w.formatted.split("<|im_start|>")[1 + w.n_repeated :]
            assert own == 1 or sum(len(("<|im_start|>" + p).encode()) for p in spoken) <= 1200       # a window holds one turn, or fits
            parts = w.formatted.split("<|im_end|>\n")[:-1]
            assert len(parts) == w.n_repeated + own
            context = parts[: w.n_repeated]
            if at and mine[0][2] == "system":
                assert context[0].startswith("<|im_start|>system\n")              # the system turn stays
            assert sum(w.formatted.count(x) for x in CONTROL) == 2 * len(parts)   # nothing but the marks
            at += own


def test_history_is_repeated_and_masked(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "t" * 40 + str(i), "", 0, "") for i in range(20)]
    _, targets, windows = read(conversations(spark, rows), stride=256, history=160)[1]
    assert all(w.n_repeated >= 1 for w in windows[1:])
    assert len(targets) == 10


def test_blocks_of_turns(spark, monkeypatch):
    monkeypatch.setattr(C, "TURNS", 3)
    rows = [(1, i, "user", f"turn {i}", "", 0, "") for i in range(11)] + [(1, None, "user", "before", "", 0, "")]
    turns, _, _ = read(conversations(spark, rows))[1]
    assert turns == [("user", "before")] + [("user", f"turn {i}") for i in range(11)]


def test_odd_rows(spark):
    long = "sehr lang " * 30_000
    rows = [(1, 0, None, None, "", 0, ""), (1, 1, "a b\nc", "", "", 0, ""), (2, 5, "user", long, "", 0, ""), (None, 0, "user", "x", "", 0, ""),
            (3, 1, "user", "same", "", 0, ""), (3, 1, "user", "same", "", 0, ""), (3, 1, "assistant", "same", "", 0, "")]
    df = conversations(spark, rows)
    out = read(df)
    assert out[1][0] == [("", ""), ("a b\nc", "")]
    assert out[2][0] == [("user", long)] and out[None][0] == [("user", "x")]
    assert out[3][0] == [("assistant", "same"), ("user", "same"), ("user", "same")]
    assert C.read_windows(C.format_windows(df.limit(0))).collect() == []


def test_windows_fit_their_budget_in_any_script(spark):
    import pytest

    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    said = ["汉字和标点。" * 30, "def f(x):\n\treturn {x: [x ** 2]}\n" * 8, "Ünïcödé wörds 𐍈🙂 " * 9, "plain english words here. " * 9, "а б в г д " * 25]
    rows = [(c, i, "user" if i % 2 == 0 else "assistant", text, "", 0, "") for c, text in enumerate(said) for i in range(12)]
    n = 0
    for r in C.format_windows(conversations(spark, rows), stride=1500, history=600).collect():
        n += 1
        assert len(tokenizer.encode(r.formatted, add_special_tokens=False).ids) <= r.tokens <= 1500 + 600
    assert n > 5


def test_digest_equals_plain_python(spark):
    import hashlib
    import os

    import pytest

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("needs the generated tables")
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1], r[2], r[3] or "") for r in rows if r[0] == conv)
        loss = "".join(x for _, role, x in mine if role == "assistant")
        want[conv] = (len(mine), hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in mine).encode()).hexdigest(), len(loss),
                      hashlib.sha256(loss.encode()).hexdigest())
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.op2_chat(spark, sf).collect()}
    assert got == want
