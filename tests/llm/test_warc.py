"""WARC archives: whole round trips, revisits, and reads of nothing but the requested ranges."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.warc import ranges, read_records, resolve, write_archives

#: Names that the operator uses inside, as extra columns of the input.
CLASH = ["name", "bucket", "n", "top", "target", "total", "many", "shared", "revisit", "file", "offset", "length", "folder", "digest"]
SCHEMA = "page_id long, url string, html string"
LONG = "<p>ünïcode 漢字 " * 200
HUGE = "<html>" + "".join(f"<p>{i}</p>" for i in range(300_000))
ROWS = [(1, "http://a/1", None), (2, "http://a/2", ""), (3, None, "x"), (4, "http://a/4", LONG), (5, "http://a/5", LONG),
        (9, "http://a/ 9\r\nX: y", LONG), (9, "http://b/9", LONG), (7, "http://a/7", "short"), (8, "http://a/8", "short"),
        (None, "http://n", LONG), (10, "http://ä/%20", HUGE), (11, "u", "\r\n\r\n" * 400), (12, "u", "\r\n\r\n" * 400), (12, "u", "\r\n\r\n" * 400),
        (None, None, "n" * 1000), (None, None, "n" * 1000), (13, "", "m" * 999), (14, "", "m" * 999)]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    df = spark.createDataFrame(ROWS, SCHEMA).select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    return write_archives(df, str(tmp_path_factory.mktemp("warc"))).cache()


def test_every_row_comes_back(spark, index):
    got = [r.asDict() for r in read_records(index).collect()]
    key = lambda r: str(r)
    want = []
    for i, url, html in ROWS:
        raw = (html or "").encode()
        same = [p for p, _, h in ROWS if (h or "").encode() == raw and p is not None]
        again = len(raw) >= 1000 and bool(same) and i != max(same)
        want.append((i, url, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted([tuple(r[c] for c in names) for r in got], key=key) == sorted(want, key=key)
    stored = {r["payload_digest"]: r["payload"] for r in got if r["record_type"] == "response"}
    assert all(hashlib.sha1(p).hexdigest() == d for d, p in stored.items())
    assert all(r["payload"] is None for r in got if r["record_type"] == "revisit")


def test_revisits_resolve_to_whole_payloads(index):
    got = resolve(read_records(index), index).collect()
    assert len(got) == len(ROWS)
    assert all(hashlib.sha1(bytes(r["payload"])).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"] for r in got)


def test_archives_are_plain_gzip_members_of_records(index):
    n = 0
    for (file,) in index.select("file").distinct().collect():
        raw = gzip.open(file).read()
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ") and rest[size : size + 4] == b"\r\n\r\n"
            raw, n = rest[size + 4 :], n + 1
    assert n == len(ROWS)


def test_a_selection_reads_its_ranges_only(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://p/{i}", f"{i} " * 3000) for i in range(200)], SCHEMA).coalesce(1)
    index = write_archives(pages, str(tmp_path))
    some = index.where("page_id in (3, 4, 5, 150)")
    assert sorted(r["page_id"] for r in read_records(some).collect()) == [3, 4, 5, 150]
    entries = [r.asDict() for r in index.orderBy("file", "offset").collect()]
    assert sum(len(run) for run in ranges(entries)) == 200 and len(list(ranges(entries))) == 1
    picked = [*entries[3:6], entries[150]]
    runs = list(ranges(picked, gap=0))
    assert [len(r) for r in runs] == [3, 1]
    assert [len(r) for r in ranges(entries, most=1)] == [1] * 200


def test_damage_is_noticed(spark, tmp_path):
    index = write_archives(spark.createDataFrame([(1, "u", "abc" * 1000)], SCHEMA), str(tmp_path))
    file = index.first()["file"]
    raw = bytearray(open(file, "rb").read())
    raw[-30] ^= 1
    open(file, "wb").write(raw)
    with pytest.raises(Exception):
        read_records(index).collect()


def test_no_pages(spark, tmp_path):
    index = write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path))
    assert index.count() == 0 and read_records(index).count() == 0
