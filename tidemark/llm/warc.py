"""WARC archives with an index: written record by record, read by coalesced byte ranges.

Every record is a gzip member of its own, so any WARC tool reads an archive as a whole. While a task writes its archive
it notes for each record the file, offset, length, URL and digest; that index is a table and comes first in every read:
selected entries are sorted by file and offset, neighbours are read as one range, and only those bytes are read.

A payload that several records share is stored once, in the record of the largest page_id (a response); the others are
revisits that name it. Which one that is comes from aggregates per payload and hash bucket of the page, so a payload
that most pages share is split over the buckets before it meets in one place.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint_dir, landed, slices, table
from tidemark.llm.tokenfiles import _filesystem

#: Least bytes of a payload that later records may refer to.
SHARED_BYTES = 1000
#: Hash buckets that a payload's records are counted in.
BUCKETS = 64
#: Bytes and records of an archive after which a task starts the next; bytes of html handled at once.
ARCHIVE_BYTES, ARCHIVE_RECORDS, SLICE_BYTES = 1 << 30, 100_000, 8 << 20
#: A reading task's share of an archive; most bytes of one read; bytes between entries that are read along.
SHARE_BYTES, READ_BYTES, GAP_BYTES = 64 << 20, 8 << 20, 64 << 10
# fixed values of the format
VERSION, CRLF = "WARC/1.1", "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = ("page_id long, url string, record_id string, record_type string, digest string, file string, offset long, length long")
RECORDS = ("page_id long, url string, record_id string, record_type string, refers_to long, refers_to_record string, "
           "payload_bytes long, payload_digest string, payload binary")


def _record_id(*what) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, what)))}>"


def _record(page_id: int | None, url: str | None, payload: bytes, shared: str | None, target: int | None, revisit: bool,
            place: str) -> tuple[bytes, str, str, str]:
    """(record, its id, type, hex digest). A shared payload's response is named by page and payload, so that revisits
    written elsewhere can name it too; other records are named by their place."""
    sha = hashlib.sha1(payload)
    kind = "revisit" if revisit else "response"
    name = _record_id(page_id, shared) if shared and not revisit else _record_id(place)
    labelled = "sha1:" + base64.b32encode(sha.digest()).decode()
    http = (f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {len(payload)}{CRLF}{CRLF}").encode()
    body = http if revisit else http + payload
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", DATE), ("WARC-Payload-Digest", labelled),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(body)))]
    if url is not None:
        plain = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c.group()):02X}", url)
        head.append(("WARC-Target-URI", plain))
        if plain != url:
            head.append(("Page-URL", json.dumps(url)))
    if page_id is not None:
        head.append(("Page-ID", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(target, shared)), ("Refers-To-Page-ID", str(target))]
    lines = CRLF.join([VERSION, *(f"{k}: {v}" for k, v in head)])
    return lines.encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n", name, kind, sha.hexdigest()


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(fields, HTTP head, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split(CRLF)
    fields = dict(x.split(": ", 1) for x in lines)
    size = int(fields["Content-Length"])
    if version != VERSION or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, http, payload


def with_targets(pages: DataFrame, least: int = SHARED_BYTES) -> DataFrame:
    """``page_id, url, html, shared`` (the payload's name if records may share it), ``target``, ``revisit``."""
    size, name = F.octet_length("html"), F.sha2("html", 256)
    rows = pages.withColumn("name", name).withColumn("bucket", F.pmod(F.xxhash64("page_id", "url"), F.lit(BUCKETS)).cast("int"))
    counts = rows.where(size >= least).groupBy("name", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("top"))
    everywhere = Window.partitionBy("name")
    counts = counts.select("name", "bucket", F.max("top").over(everywhere).alias("target"), F.sum("n").over(everywhere).alias("total"))
    rows = rows.join(counts.where("total > 1").select("name", "bucket", "target", F.lit(True).alias("many")), ["name", "bucket"], "left")
    shared = F.col("many").isNotNull() & (size >= least)
    revisit = shared & F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    return rows.select("page_id", "url", "html", F.when(shared, F.col("name")).alias("shared"), "target", revisit.alias("revisit"))


def write_archives(pages: DataFrame, path: str, least: int = SHARED_BYTES) -> DataFrame:
    """A WARC record for every row of ``pages``; returns the index.

    ``pages``: ``page_id`` (integer), ``url``, ``html``; other columns are ignored, whatever their names. ``path`` is a
    folder that all executors share. The payload is the html in UTF-8; null and empty ones are empty, of whatever
    length otherwise. Of equal payloads of at least ``least`` bytes the record of the largest page_id is the response
    (null is the least; with nothing but nulls all are responses) and the others revisit it; rows that repeat that
    page_id are all responses. An archive appears under its name only once complete, so a task may run twice. An
    empty table gives an empty index and no archives.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))
    rows = with_targets(rows, least)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, folder = _filesystem(path)
        out, name, draft, offset, made, entries = None, "", "", 0, 0, []
        types = [pa.int64() if f.endswith("long") else pa.string() for f in INDEX.split(", ")]

        def done() -> pa.RecordBatch:
            out.close()
            fs.move(draft, name)
            columns = zip(*entries)
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in INDEX.split(", ")])

        for batch in batches:
            for piece in slices(batch, ["html"], SLICE_BYTES):
                for page_id, url, html, shared, target, revisit in zip(*(piece.column(c) for c in piece.schema.names)):
                    if out is not None and (offset >= ARCHIVE_BYTES or len(entries) >= ARCHIVE_RECORDS):
                        yield done()
                        out, entries = None, []
                    if out is None:
                        name = f"{folder}/part-{part:06d}-{made:04d}.warc.gz"
                        draft = f"{folder}/_part-{part:06d}-{uuid.uuid4().hex}"
                        fs.create_dir(folder, recursive=True)
                        out, offset, made = fs.open_output_stream(draft), 0, made + 1
                    page_id, url, target = page_id.as_py(), url.as_py(), target.as_py()
                    place = f"{name}#{len(entries)}"
                    raw, record, kind, digest = _record(page_id, url, html.as_buffer().to_pybytes(), shared.as_py(), target, revisit.as_py(), place)
                    press = zlib.compressobj(1, zlib.DEFLATED, 31)
                    member = press.compress(raw) + press.flush()
                    out.write(member)
                    entries.append((page_id, url, record, kind, digest, name, offset, len(member)))
                    offset += len(member)
        if out is not None:
            yield done()

    return landed(rows.mapInArrow(write, INDEX), "index").withColumn("folder", F.lit(path))


def ranges(entries: list[dict], most: int = READ_BYTES, gap: int = GAP_BYTES) -> Iterator[list[dict]]:
    """Sorted index entries in runs that are read at once."""
    run: list[dict] = []
    for e in entries:
        if run and (e["file"] != run[0]["file"] or e["offset"] - (run[-1]["offset"] + run[-1]["length"]) > gap
                    or e["offset"] + e["length"] - run[0]["offset"] > most):
            yield run
            run = []
        run.append(e)
    if run:
        yield run


def _read(entry: dict, member: bytes, with_payload: bool) -> tuple:
    fields, http, payload = parse_record(zlib.decompress(member, 31))
    named = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = fields["WARC-Type"] == "revisit"
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = named if revisit else hashlib.sha1(payload).hexdigest()
    if digest != entry["digest"] or named != digest or not revisit and len(payload) != size:
        raise ValueError(f"damaged record at {entry['file']}:{entry['offset']}")
    url = json.loads(fields["Page-URL"]) if "Page-URL" in fields else fields.get("WARC-Target-URI")
    page, target = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
    return (page and int(page), url, fields["WARC-Record-ID"], fields["WARC-Type"], target and int(target), fields.get("WARC-Refers-To"),
            size, digest, payload if with_payload and not revisit else None)


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the index entries given (any selection of ``write_archives``' index).

    Entries of one share of an archive go to one task in order; runs of neighbours are one read. A response's length
    and digest come from its payload, which must agree with its head and the index; a revisit's from its head, since
    the payload lies in the record it names (``resolve`` fetches it).
    """
    index = index.select("folder", "file", "offset", "length", "digest", F.floor(F.col("offset") / SHARE_BYTES).alias("share"))
    index = index.repartition("file", "share").sortWithinPartitions("file", "offset")
    names = [f.split()[0] for f in RECORDS.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, opened = None, None
        for batch in batches:
            for run in ranges(batch.to_pylist()):
                first, last = run[0], run[-1]
                if opened != first["file"]:
                    if stream is not None:
                        stream.close()
                    fs, _ = _filesystem(first["folder"])
                    stream, opened = fs.open_input_file(first["file"]), first["file"]
                stream.seek(first["offset"])
                raw = stream.read(last["offset"] + last["length"] - first["offset"])
                rows = []
                for e in run:
                    at = e["offset"] - first["offset"]
                    rows.append(_read(e, raw[at : at + e["length"]], with_payload))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        if stream is not None:
            stream.close()

    return index.mapInArrow(read, RECORDS)


def resolve(records: DataFrame, index: DataFrame) -> DataFrame:
    """Revisits of ``records`` with the payload of the response they name: its archive bytes are read once."""
    revisits = records.where("record_type = 'revisit'").drop("payload")
    named = index.join(revisits.select(F.col("refers_to_record").alias("record_id")).distinct(), "record_id", "left_semi")
    told = read_records(named).select(F.col("record_id").alias("refers_to_record"), "payload").dropDuplicates(["refers_to_record"])
    return records.where("record_type = 'response'").unionByName(revisits.join(told, "refers_to_record", "left").select(*records.columns))


def op13_warc(spark, sf_dir: str) -> DataFrame:
    """The rows that op 13's contract asks for: all pages, written and read back."""
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    records = read_records(write_archives(table(spark, sf_dir, "pages"), folder), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP13_SQL = f"""
WITH sized AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
told AS (
  SELECT page_id, payload_bytes, sha1(html) AS payload_digest, payload_bytes >= {SHARED_BYTES}
         AND page_id <> max(page_id) OVER (PARTITION BY html) AS again, max(page_id) OVER (PARTITION BY html) AS target
  FROM sized)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN target END::DOUBLE AS refers_to
FROM told
"""
