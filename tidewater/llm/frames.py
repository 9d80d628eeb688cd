"""Token-id files: independent zstandard frames, a trailing seek table, per-frame checksums.

Documents are range-sorted by id; each partition streams one file. A file is a sequence of zstandard frames,
each the little-endian ids of a run of whole documents; then one skippable frame with the seek table. Spark's
text sink writes the rows as they are, and its record separator is an empty skippable frame, so any zstandard
reader can also decompress a file from end to end.

Seek table (little endian): frames as (offset u64, size u32, raw size u64, crc32 u32, documents u32), the
documents' ids (i64), null flags (u8) and token counts (u32), zstd-compressed; then a 32-byte trailer (table
size u32, frames u32, documents u32, shard u32, id width u32, crc32 of the table u32, 8-byte magic).

Defined results: a NULL text is empty and holds the end id only; NULL ids sort first; rows that repeat an id
are ordered by their text's hash and kept; an empty table gives files without documents; other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, parts_for, text_bytes
from tidewater.llm.tokens import encoder, text_runs
from tidewater.session import checkpoint_dir

EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
TABLE_MAGIC, TRAILER, MAGIC = 0x184D2A5E, struct.Struct("<IIIIII8s"), b"TWTOKENS"
FRAME = np.dtype([("offset", "<u8"), ("size", "<u4"), ("raw", "<u8"), ("crc", "<u4"), ("docs", "<u4")])
END_ID = 0


def _shard(batches, path: str, width: int, frame_ids: int):
    """Rows of one file: data frames, then the seek table."""
    import zstandard
    from pyspark import TaskContext

    pack = zstandard.ZstdCompressor(level=3, write_checksum=True)
    enc, dtype = encoder(path), np.dtype(f"<u{width}")
    frames, doc_ids, counts, offset = [], [], [], 0

    def frame(parts, n_docs):
        nonlocal offset
        raw = np.concatenate(parts).astype(dtype).tobytes()
        data = pack.compress(raw)
        frames.append((offset, len(data), len(raw), zlib.crc32(raw), n_docs))
        offset += len(data) + len(EMPTY_FRAME)
        return data

    for batch in batches:
        doc_ids.append(batch.column(0))
        for _, _, texts in text_runs(batch.column(1), 2 << 20):
            ids, n = enc.encode(texts)
            ends = np.cumsum(n)
            parts, held, n_docs, out = [], 0, 0, []
            for k, doc in enumerate(np.split(ids, ends[:-1])):
                parts += [doc, np.array([END_ID], np.uint32)]
                held, n_docs = held + len(doc) + 1, n_docs + 1
                if held >= frame_ids or k == len(n) - 1:
                    out.append(frame(parts, n_docs))
                    parts, held, n_docs = [], 0, 0
            counts.append(n + 1)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
    ids_of = pa.chunked_array(doc_ids, pa.int64()) if doc_ids else pa.chunked_array([], pa.int64())
    null = np.asarray(ids_of.is_null(), bool)
    table = b"".join([np.array(frames, FRAME).tobytes(), np.asarray(ids_of.fill_null(0), "<i8").tobytes(),
                      null.astype("u1").tobytes(), np.concatenate([[], *counts]).astype("<u4").tobytes()])
    table = pack.compress(table)
    tail = TRAILER.pack(len(table), len(frames), len(null), TaskContext.get().partitionId(), width,
                        zlib.crc32(table), MAGIC)
    row = struct.pack("<II", TABLE_MAGIC, len(table) + len(tail)) + table + tail
    yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["value"])


def write(docs: DataFrame, tokenizer: str, path: str, id_col: str = "doc_id", text_col: str = "text",
          file_bytes: int = 32 << 20, frame_ids: int = 32_768) -> None:
    """Encode whole texts and write their ids, each document closed by ``END_ID``, in ascending id order.

    ``file_bytes`` is the text that one file covers, ``frame_ids`` the ids from which on a frame is closed (a
    longer document is one frame).
    """
    from tokenizers import Tokenizer

    bound_batches(docs.sparkSession)
    width = 2 if Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 else 4
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = parts_for(text_bytes(d), file_bytes)
    d = d.withColumns({"h": F.xxhash64("text"), "m": F.monotonically_increasing_id()})
    d = d.repartitionByRange(n, "doc_id", "h", "m").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    rows = d.mapInArrow(lambda b: _shard(b, tokenizer, width, frame_ids), "value binary")
    rows.select(F.col("value").cast("string").alias("value")).write.format("text").option(
        "lineSep", EMPTY_FRAME.decode("latin-1")).save(path)


class SeekReader:
    """Documents of one file through ``read_at(offset, size)``: reads the trailer, the table and wanted frames only."""

    def __init__(self, size: int, read_at):
        import zstandard

        self.read_at, self.unpack = read_at, zstandard.ZstdDecompressor()
        at = size - len(EMPTY_FRAME) - TRAILER.size
        n, n_frames, n_docs, self.shard, self.width, crc, magic = TRAILER.unpack(read_at(at, TRAILER.size))
        table = read_at(at - n, n)
        if magic != MAGIC or zlib.crc32(table) != crc:
            raise ValueError("not a token file, or its seek table is damaged")
        table = self.unpack.decompress(table)
        self.frames = np.frombuffer(table, FRAME, n_frames)
        at = n_frames * FRAME.itemsize
        self.doc_ids = np.frombuffer(table, "<i8", n_docs, at)
        self.null = np.frombuffer(table, "u1", n_docs, at + 8 * n_docs).astype(bool)
        self.counts = np.frombuffer(table, "<u4", n_docs, at + 9 * n_docs).astype(np.int64)

    def frame(self, k: int) -> np.ndarray:
        f = self.frames[k]
        raw = self.unpack.decompress(self.read_at(int(f["offset"]), int(f["size"])), max_output_size=int(f["raw"]))
        if zlib.crc32(raw) != f["crc"]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, f"<u{self.width}")

    def documents(self):
        """(position, ids) of all documents, frame by frame."""
        doc = 0
        for k, n in enumerate(self.frames["docs"]):
            ids = self.frame(k)
            for x in np.split(ids, np.cumsum(self.counts[doc:doc + n])[:-1]):
                yield doc, x
                doc += 1

    def get(self, doc_id: int) -> list[np.ndarray]:
        """Ids of the documents with this id; only their frames are read."""
        out, ends = [], np.cumsum(self.frames["docs"])
        for doc in np.flatnonzero((self.doc_ids == doc_id) & ~self.null):
            k = int(np.searchsorted(ends, doc, "right"))
            first = int(ends[k] - self.frames["docs"][k])
            at = int(self.counts[first:doc].sum())
            out.append(self.frame(k)[at:at + int(self.counts[doc])])
        return out


def open_file(spark: SparkSession, path: str) -> SeekReader:
    """A reader of one file in any store that Spark reaches, by ranged reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(p)

    def read_at(offset, size):
        stream.seek(offset)
        return bytes(stream.readNBytes(size))

    return SeekReader(fs.getFileStatus(p).getLen(), read_at)


def _reader(content) -> SeekReader:
    return SeekReader(len(content), lambda at, n: content[at:at + n])


def _totals(batches):
    for b in batches:
        for x in b.column(0):
            r = _reader(memoryview(x.as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array([r.shard]), pa.array([int(r.counts.sum())])],
                                             ["shard", "total"])


def _documents(batches):
    for b in batches:
        for x in b.column(0):
            r = _reader(memoryview(x.as_buffer()))
            first = np.cumsum(r.counts) - r.counts
            rows, held = [], 0

            def out(rows):
                at = np.array([k for k, _ in rows])
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), r.shard, np.int64)), pa.array(r.doc_ids[at], mask=r.null[at]),
                     pa.array(first[at]), pa.array(r.counts[at]),
                     pa.array([i.astype("<u4").tobytes() for _, i in rows], pa.binary())],
                    ["shard", "doc_id", "at", "n_tokens", "ids"])

            for k, ids in r.documents():
                rows.append((k, ids))
                held += len(ids)
                if held > 1 << 20:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a written folder: ``doc_id, start, n_tokens, ids`` (u32 little endian)."""
    bound_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    totals = files.mapInArrow(_totals, "shard long, total long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    base = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    docs = files.mapInArrow(_documents, "shard long, doc_id long, at long, n_tokens long, ids binary")
    return docs.join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def scratch(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/token_files/{uuid.uuid4().hex}"
