import zlib

import numpy as np
import pytest
import zstandard

from tidemark.llm import tokenfiles as S

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def plain_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_round_trip(spark, odd_docs, tmpdir_path, monkeypatch):
    monkeypatch.setattr(S, "FILE_BYTES", 200_000)
    monkeypatch.setattr(S, "READ_DOCS", 3)
    manifest = S.write_tokens(odd_docs, tmpdir_path + "/out", PATH)
    assert manifest.count() > 1
    got = sorted(S.read_tokens(manifest).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in odd_docs.collect())
    assert [r.doc_id for r in got] == [k[1] if k[0] else None for k, _ in rows]
    at = 0
    for r, (_, text) in zip(got, rows):
        ids = plain_ids(text)
        assert (r.start, r.n_tokens, r.ids) == (at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_encoder_equals_the_tokenizer():
    import pyarrow as pa

    texts = ["", None, "  a  b ", "Ünï cödé x　y", "<|endoftext|> <|startoftext|>a", "it's I'll don't", "á ́b", "ΑΣ ΑΣ.",
             "1234 12.5%", "the, The. THE!! the&&& a's, o'clock's. J\u030c j\u030c, É, É. e\u0301. x<|endoftext|>, <|ENDOFTEXT|>",
             "mañana, straße... naïve) (naïve) a_b _ -- don't! 'tis \u2026, end\u2026. 東京, 東京. i̇, İ. ª, aª, ﬁ, ﬁx.",
             "1234 12.5%", "\x1c\x1d\x85 z", "word " * 1000, "e" * 5000]
    ids, n = S.Encoder(PATH)(pa.array(texts))
    ends = np.cumsum(n)
    for t, j, k in zip(texts, ends, n):
        assert ids[j - k : j].tolist() == plain_ids(t)[:-1], t


def test_any_zstandard_reader_and_checksums(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "one two three"), (2, "four"), (3, "five six")], "doc_id long, text string")
    row = S.write_tokens(df, tmpdir_path + "/out", PATH).first()
    raw = open(row.file, "rb").read()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert np.frombuffer(whole, "<u4").tolist() == plain_ids("one two three") + plain_ids("four") + plain_ids("five six")
    import io

    table, ids = S.read_table(io.BytesIO(raw), len(raw))
    assert ids.tolist() == [1, 2, 3]
    assert list(S.read_frames(io.BytesIO(raw), table, 1, 2)) == [np.array(plain_ids("four"), "<u4").tobytes()]
    wrong = table.copy()
    wrong[1, 2] ^= 1
    with pytest.raises(ValueError):
        list(S.read_frames(io.BytesIO(raw), wrong, 1, 2))


def test_no_rows(no_docs, tmpdir_path):
    assert S.read_tokens(S.write_tokens(no_docs, tmpdir_path + "/out", PATH)).collect() == []


def test_other_tokenizers_encode_whole_texts(spark, tmpdir_path):
    import json

    import pyarrow as pa
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.WordLevel({"Ab": 0, "ab": 1, "?": 2}, unk_token="?"))
    t.pre_tokenizer = pre_tokenizers.Whitespace()
    t.enable_truncation(3)
    path = tmpdir_path + "/two.json"
    t.save(path)
    assert not S.goes_by_pieces(path) and S.goes_by_pieces(PATH)
    ids, n = S.Encoder(path)(pa.array(["Ab ab", None, "ab AB ab Ab ab"]))
    assert ids.tolist() == [0, 1, 1, 2, 1, 0, 1] and n.tolist() == [2, 0, 5]
    told = json.load(open(PATH, encoding="utf-8"))
    told["normalizer"]["normalizers"].pop()                  # keeps capitals
    json.dump(told, open(path, "w", encoding="utf-8"))
    text = "The The the"
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert S.Encoder(path)(pa.array([text]))[0].tolist() == want != plain_ids(text)[:-1]


def test_requested_documents_alone_are_read(spark, tmpdir_path):
    import random

    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("alpha beta gamma delta".split()) + str(rnd.randrange(1000)) for _ in range(400))) for i in range(100)]
    rows += [(7, "seven again"), (None, "nobody")]
    manifest = S.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), tmpdir_path + "/out", PATH)
    got = sorted((r.doc_id, r.ids) for r in S.read_documents(manifest, [7, 63, 1000]).collect())
    assert got == sorted([(7, plain_ids(rows[7][1])), (7, plain_ids("seven again")), (63, plain_ids(rows[63][1]))])
    row = manifest.first()

    class Counted:
        def __init__(self, f):
            self.f, self.read_bytes = f, 0

        def seek(self, at):
            self.f.seek(at)

        def read(self, n):
            self.read_bytes += n
            return self.f.read(n)

    import os

    with open(row.file, "rb") as f:
        c, size = Counted(f), os.path.getsize(row.file)
        assert [d for d, _ in S.requested(c, size, np.array([63]))] == [63]
        assert c.read_bytes < size // 10
