"""Token-id files in the zstandard seekable format: one frame a document, a trailing seek table.

File: the frames of its documents in order, each an independent zstandard frame of little-endian unsigned
32-bit ids; a skippable frame with the documents' ids; a skippable frame with the seek table (compressed
size, plain size and the low 32 bits of the plain bytes' xxhash64 for each frame, then the number of frames,
a descriptor byte and the format's magic number). Any zstandard tool can decompress a file as a whole; a
reader that wants some documents reads the table from the end, then only their frames, and checks each.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import buckets_for, checkpoint_dir, landed, slices, text_bytes

# fixed values of the zstandard seekable format
SKIPPABLE_TABLE, SKIPPABLE_INDEX, SEEKABLE = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
HAS_CHECKSUM = 0x80
FOOTER, FOOTER_SIZE = "<IBI", 9
#: Bytes of text of one file, and of one tokenizer step.
FILE_BYTES, SLICE_BYTES = 64 << 20, 8 << 20
#: Distinct words whose ids a task remembers at once.
KNOWN_WORDS = 500_000
#: Documents that one reading task opens a file for.
READ_DOCS = 20_000
END_ID = 2
_NULL_ID = -(1 << 63)


#: What a tokenizer file must say for its pieces to be encoded on their own (fixed values of the public 49k word BPE).
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def goes_by_pieces(path: str) -> bool:
    """Whether the tokenizer lower-cases, cuts texts into PIECES and marks a piece's last id."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)

    def parts(node: dict | None, inner: str) -> list:
        return [] if node is None else node[inner] if node.get("type") == "Sequence" else [node]

    cut = parts(told.get("pre_tokenizer"), "pretokenizers")
    return (parts(told.get("normalizer"), "normalizers") == NORMALIZERS and len(cut) == 2
            and (cut[0].get("pattern"), cut[0].get("behavior"), cut[0].get("invert")) == ({"Regex": PIECES}, "Removed", True)
            and cut[1].get("type") == "ByteLevel" and not cut[1].get("add_prefix_space") and not cut[1].get("use_regex")
            and told["model"].get("end_of_word_suffix") == "</w>" and not told["model"].get("dropout")
            and all(t["content"].startswith("<|") for t in told.get("added_tokens", [])))


class Encoder:
    """Ids of whole texts. A tokenizer that doesn't go by pieces encodes them as they are; for one that does, white space only separates words for this tokenizer, letters and punctuation are
    pieces of their own, and capitals don't count; so each distinct piece of a step is encoded once and the
    texts are put together from those. Pieces of other kinds (digits, quotes, other scripts) go whole."""

    #: A word that ends in punctuation behind a letter, and a piece of nothing but letters.
    TAIL = r"^(?P<stem>.*[A-Za-zÀ-ÖØ-öø-ÿ])(?P<tail>[!-&(-/:-@\[-`{-~]+)$"
    LETTERS = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
    TOGETHER = 500

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_pieces = goes_by_pieces(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)     # ids that end a piece
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.size, self.start, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _add(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.size), len(self.size) + len(words))))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.ids = np.concatenate([self.ids, ids])

    def _learn(self, words: list[str]) -> None:
        """Encode new pieces; those of letters together, since each ends with an id that ends a piece."""
        plain = pc.match_substring_regex(pa.array(words, pa.string()), self.LETTERS).to_numpy(zero_copy_only=False)
        letters = [w for w, x in zip(words, plain) if x]
        single = [w for w, x in zip(words, plain) if not x]
        parts = [letters[i : i + self.TOGETHER] for i in range(0, len(letters), self.TOGETHER)]
        found = self.tokenizer.encode_batch_fast([" ".join(x) for x in parts], add_special_tokens=False)
        sizes, flat, done = [], [], []
        for part, e in zip(parts, found):
            ids = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.last[ids])
            if len(ends) != len(part) or ends[-1] != len(ids) - 1:
                single += part
                continue
            sizes.append(np.diff(ends, prepend=-1)), flat.append(ids), done.extend(part)
        if done:
            self._add(done, np.concatenate(sizes), np.concatenate(flat))
        if single:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(single, add_special_tokens=False)]
            self._add(single, np.array([len(x) for x in got], np.int64), np.array([i for x in got for i in x], np.uint32))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        coded = pieces.dictionary_encode()
        names = coded.dictionary.to_pylist()
        new = [w for w in names if w not in self.known]
        if new:
            self._learn(new)
        place = np.fromiter((self.known[w] for w in names), np.int64, len(names))
        return place[coded.indices.to_numpy(zero_copy_only=False)] if len(names) else place

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        if not self.by_pieces:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        coded = lists.flatten().dictionary_encode()
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        words = coded.dictionary
        split = pc.extract_regex(words, self.TAIL)
        apart = pc.and_(split.is_valid(), pc.invert(pc.match_substring(words, "<|")))   # not a special token's name
        stem = pc.if_else(apart, pc.struct_field(split, "stem"), words)
        tail = pc.if_else(apart, pc.struct_field(split, "tail"), "")
        lower = pc.and_(pc.string_is_ascii(stem), pc.invert(pc.match_substring(stem, "<|")))
        stem = pc.if_else(lower, pc.ascii_lower(stem), stem)
        unit = np.stack([self._places(stem), self._places(tail)], axis=1)
        at = coded.indices.to_numpy(zero_copy_only=False)
        place = unit[at].ravel() if len(words) else np.zeros(0, np.int64)
        size = self.size[place]
        before = np.cumsum(size) - size
        ids = self.ids[np.repeat(self.start[place] - before, size) + np.arange(int(size.sum()))]
        ends = np.append(0, np.cumsum(size))[2 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())]
        return ids, np.diff(ends)


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write all documents in ascending (doc_id, text) order; returns the manifest, one row per file.

    ``docs``: ``doc_id`` (integer), ``text``; other columns are ignored, whatever their names. ``path`` is a
    folder that all executors share; ``tokenizer`` a tokenizers JSON file that each of them has. Null and
    empty texts hold just the end id; a null doc_id comes first; repeated rows are written as often as they
    come. A file appears under its name only once complete, so a task may run twice. An empty table gives
    no files.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    _, size = text_bytes(docs)
    order = (F.col("doc_id"), F.xxhash64("text"))
    docs = docs.repartitionByRange(buckets_for(size, FILE_BYTES), *order).sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        import zstandard
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode, press = None, zstandard.ZstdCompressor(level=1, write_checksum=True)
        fs, folder = _filesystem(path)
        name, draft = f"{folder}/part-{part:06d}.ids.zst", f"{folder}/_part-{part:06d}-{uuid.uuid4().hex}"
        out, table, ids, tokens = None, [], [], 0
        for batch in batches:
            for rows in slices(batch, ["text"], SLICE_BYTES):
                if out is None:
                    encode = Encoder(tokenizer)
                    fs.create_dir(folder, recursive=True)
                    out = fs.open_output_stream(draft)
                flat, counts = encode(rows.column("text"))
                ids.append(rows.column("doc_id").fill_null(_NULL_ID).to_numpy())
                at = 0
                for n in counts.tolist():
                    plain = np.append(flat[at : at + n], np.uint32(end_id)).astype("<u4").tobytes()
                    frame = press.compress(plain)
                    out.write(frame)
                    table.append((len(frame), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
                    at, tokens = at + n, tokens + n + 1
        if out is None:
            return
        out.write(_skippable(SKIPPABLE_INDEX, np.concatenate(ids).astype("<i8").tobytes()))
        body = np.array(table, "<u4").tobytes() + struct.pack(FOOTER, len(table), HAS_CHECKSUM, SEEKABLE)
        out.write(_skippable(SKIPPABLE_TABLE, body))
        out.close()
        fs.move(draft, name)
        yield pa.record_batch({"part": pa.array([part], pa.int32()), "file": [name], "n_docs": [len(table)], "n_tokens": [tokens],
                               "first_id": [int(ids[0][0])], "last_id": [int(ids[-1][-1])]})

    manifest = landed(docs.mapInArrow(write, "part int, file string, n_docs long, n_tokens long, first_id long, last_id long"), "manifest")
    return manifest.withColumn("folder", F.lit(path))



def read_table(stream, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(seek table rows, document ids) of an open file, read from its end."""
    stream.seek(size - FOOTER_SIZE)
    n, flags, magic = struct.unpack(FOOTER, stream.read(FOOTER_SIZE))
    if magic != SEEKABLE or flags != HAS_CHECKSUM:
        raise ValueError("not a seekable token file")
    body = 12 * n + FOOTER_SIZE
    stream.seek(size - body - 8 - 8 * n - 8)
    raw = stream.read(8 * n + 8 + 8 + 12 * n)
    kind, length = struct.unpack_from("<II", raw, 8 * n + 8)
    if (kind, length) != (SKIPPABLE_TABLE, body) or struct.unpack_from("<II", raw) != (SKIPPABLE_INDEX, 8 * n):
        raise ValueError("damaged seek table")
    return np.frombuffer(raw, "<u4", 3 * n, 8 * n + 16).reshape(n, 3).astype(np.int64), np.frombuffer(raw, "<i8", n, 8)


def read_frames(stream, table: np.ndarray, first: int, last: int) -> Iterator[bytes]:
    """Plain bytes of the documents ``first`` to ``last - 1``; every frame's checksum is verified."""
    import xxhash
    import zstandard

    unpress = zstandard.ZstdDecompressor()
    stream.seek(int(table[:first, 0].sum()))
    for packed, plain_size, check in table[first:last].tolist():
        plain = unpress.decompress(stream.read(packed))
        if len(plain) != plain_size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
            raise ValueError("a frame's checksum doesn't match")
        yield plain


def read_tokens(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """The documents of all files: ``doc_id, start`` (ids before it in all files), ``n_tokens, ids_crc32`` and,
    ``with_ids``, ``ids`` themselves. Files are read in ranges of documents; the files' offsets come from a
    running total over the manifest, one row a file."""
    start = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    jobs = manifest.withColumn("start", F.coalesce(start, F.lit(0).cast("long")))
    jobs = jobs.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_docs") - 1, F.lit(READ_DOCS).cast("long"))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():
                fs, _ = _filesystem(job["folder"])
                with fs.open_input_file(job["file"]) as stream:
                    table, ids = read_table(stream, stream.size())
                    first, last = job["first"], min(job["first"] + READ_DOCS, job["n_docs"])
                    plain = list(read_frames(stream, table, first, last))
                n = table[:, 1] // 4
                before = job["start"] + np.cumsum(n) - n
                doc = ids[first:last]
                out = {"doc_id": pa.array(doc, pa.int64(), mask=doc == _NULL_ID),
                       "start": pa.array(before[first:last], pa.int64()), "n_tokens": pa.array(n[first:last], pa.int64()),
                       "ids_crc32": pa.array([zlib.crc32(p) for p in plain], pa.int64())}
                if with_ids:
                    off = np.append(0, np.cumsum(n[first:last])).astype(np.int32)
                    out["ids"] = pa.ListArray.from_arrays(off, pa.array(np.frombuffer(b"".join(plain), "<u4").astype(np.int64)))
                yield pa.record_batch(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return jobs.repartition("file", "first").mapInArrow(read, schema)


def requested(stream, size: int, wanted: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(doc_id, plain bytes) of the wanted documents of an open file: its index from the end, then their frames alone."""
    table, ids = read_table(stream, size)
    for at in np.flatnonzero(np.isin(ids, wanted)).tolist():
        yield int(ids[at]), next(read_frames(stream, table, at, at + 1))


def read_documents(manifest: DataFrame, doc_ids: Sequence[int]) -> DataFrame:
    """``doc_id, ids`` of the documents asked for (an id as often as it was written; one that wasn't, not at all).

    Files go by document id, so the manifest tells which may hold one; those are opened, and only the frames asked for are
    read and decompressed. ``doc_ids`` is a request a driver can hold; a table of documents is read by ``read_tokens``.
    """
    wanted = np.unique(np.array(list(doc_ids), np.int64))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job in batch.to_pylist():
                mine = wanted[(wanted >= job["first_id"]) & (wanted <= job["last_id"])]
                if not len(mine):
                    continue
                fs, _ = _filesystem(job["folder"])
                with fs.open_input_file(job["file"]) as stream:
                    for doc, plain in requested(stream, stream.size(), mine):
                        ids = pa.array([np.frombuffer(plain, "<u4").astype(np.int64)], pa.list_(pa.int64()))
                        yield pa.record_batch({"doc_id": pa.array([doc], pa.int64()), "ids": ids})

    return manifest.repartition("file").mapInArrow(read, "doc_id long, ids array<long>")


def op9_tokenfiles(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """The digest that op 9's contract asks for, over all documents, read back from the files."""
    from tidemark.llm.common import table

    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    folder = f"{checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer), with_ids=False)
