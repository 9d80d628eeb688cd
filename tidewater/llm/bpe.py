"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

Documents are dealt to blocks of about ``BLOCK_BYTES`` of text. Each block explodes its texts into pieces and
sends its *distinct* pieces, dealt by hash into buckets, to the bucket's task, where each distinct piece of the
corpus is merged once. The id lists go back in the order in which the block sent the pieces; the block looks
its positions up and strings the ids together. So a piece that fills the corpus travels once per block, and
positions never leave the block. Lists travel packed (zstandard), the block's texts are shuffled once (the
second use reuses the exchange).

Decoding joins ids with the token-byte table, a broadcast of the vocabulary's fixed size.

Defined results: a NULL text is empty (no ids, no bytes); NULL ids and repeated rows are kept; equal texts get
equal ids; an empty table gives no rows; other columns are ignored by ``encode``. A stretch of visible characters
with one that Unicode has not assigned is one piece, split and merged by the tokenizer library itself.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, parts_for, text_bytes
from tidewater.llm.tokens import give_back, pieces, runs

BLOCK_BYTES = 16 << 20
_encodings: dict = {}


def encoding(path: str):
    """The tiktoken encoding of a rank file, once per worker."""
    if path not in _encodings:
        import public_tokenizers
        import tiktoken

        _encodings[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                             mergeable_ranks=read_ranks(path), special_tokens={})
    return _encodings[path]


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def token_bytes(path: str) -> dict[int, bytes]:
    """The token-byte table."""
    return {i: b for b, i in read_ranks(path).items()}


def pack(sizes: np.ndarray, body: bytes) -> bytes:
    import zstandard
    return zstandard.compress(len(sizes).to_bytes(4, "little") + sizes.astype("<u4").tobytes() + body, 3)


def unpack(data: bytes) -> tuple[np.ndarray, bytes]:
    import zstandard
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:4], "little")
    return np.frombuffer(raw, "<u4", n, 4).astype(np.int64), raw[4 + 4 * n:]


def dealt(found, n_buckets: int) -> dict[int, list[str]]:
    """Distinct pieces by bucket, in a fixed order."""
    out: dict[int, list[str]] = {}
    for p in sorted(found):
        out.setdefault(zlib.crc32(p.encode()) % n_buckets, []).append(p)
    return out


def _send(block: pa.Table, n_buckets: int) -> pa.Table:
    found: set[str] = set()
    for text in block.column("text"):
        found.update(pieces(text.as_py() or ""))
    by = dealt(found, n_buckets)
    words = [[p.encode() for p in v] for v in by.values()]
    give_back()
    return pa.table({"bucket": pa.array(list(by), pa.int64()),
                     "block": pa.array([block.column("block")[0].as_py()] * len(by), pa.int64()),
                     "words": pa.array([pack(np.array(list(map(len, v))), b"".join(v)) for v in words], pa.binary())})


def _merge(bucket: pa.Table, ranks: str) -> pa.Table:
    merge = encoding(ranks).encode_ordinary
    known: dict[bytes, list[int]] = {}
    out = []
    for words in bucket.column("words"):
        sizes, body = unpack(words.as_py())
        ends = np.cumsum(sizes).tolist()
        lists = []
        for lo, hi in zip([0, *ends], ends, strict=False):
            p = body[lo:hi]
            if p not in known:
                known[p] = merge(p.decode())
            lists.append(known[p])
        flat = np.fromiter((i for x in lists for i in x), "<u4")
        out.append(pack(np.fromiter(map(len, lists), np.int64, len(lists)), flat.tobytes()))
    give_back()
    return pa.table({"bucket": bucket.column("bucket"), "block": bucket.column("block"), "ids": pa.array(out, pa.binary())})


def _assemble(block: pa.Table, lists: pa.Table, n_buckets: int) -> pa.Table:
    index: dict[str, int] = {}
    codes, sizes = [], []
    for text in block.column("text"):
        found = pieces(text.as_py() or "")
        for p in set(found).difference(index):
            index[p] = len(index)
        codes.append(np.fromiter(map(index.__getitem__, found), np.int32, len(found)))
        sizes.append(len(found))
    by = dealt(index, n_buckets)
    first, length = np.zeros(len(index), np.int64), np.zeros(len(index), np.int64)
    flat, at = [], 0
    for bucket, ids in zip(lists.column("bucket").to_pylist(), lists.column("ids"), strict=True):
        n, body = unpack(ids.as_py())
        code = np.fromiter(map(index.__getitem__, by[bucket]), np.int64, len(n))
        length[code], first[code] = n, at + np.cumsum(n) - n
        flat.append(np.frombuffer(body, "<u4"))
        at += int(n.sum())
    flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
    counts, rows = [], []
    for lo, hi in runs(sizes, 1 << 18):  # a stretch of documents at a time
        code = np.concatenate(codes[lo:hi])
        n = length[code]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(first[code] - ends[:-1], n) + np.arange(ends[-1])]
        cut = ends[np.concatenate([[0], np.cumsum(sizes[lo:hi])])]
        rows += [ids[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
        counts += np.diff(cut).tolist()
    give_back()
    return pa.table({"doc_id": block.column("doc_id"), "n_tokens": pa.array(counts, pa.int64()),
                     "ids": pa.array(rows, pa.binary())})


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_tokens, ids`` (u32 little endian) of every row's whole text."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bound_batches(docs.sparkSession)
    n = parts_for(text_bytes(d), block_bytes)
    # Equal rows are spread by the partition that read them, so that a text repeated without end fills no block.
    d = d.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(n)).cast("long"))
    sent = d.groupBy("block").applyInArrow(lambda t: _send(t, n), "bucket long, block long, words binary")
    lists = sent.groupBy("bucket").applyInArrow(lambda t: _merge(t, ranks), "bucket long, block long, ids binary")
    return d.groupBy("block").cogroup(lists.groupBy("block")).applyInArrow(
        lambda a, b: _assemble(a, b, n) if a.num_rows else pa.table(
            {"doc_id": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64()), "ids": pa.array([], pa.binary())}),
        "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of each row's ids in column ``out`` (no bytes for NULL ids)."""
    held = encoded.sparkSession.sparkContext.broadcast(token_bytes(ranks))
    bound_batches(encoded.sparkSession)
    columns = [c for c in encoded.columns if c != out]
    at = columns.index(ids_col)

    def run(batches):
        of = held.value.__getitem__
        for b in batches:
            for lo, hi in runs([len(x) if x is not None else 0 for x in map(_buffer, b.column(at))], 8 << 20):
                part = b.slice(lo, hi - lo)
                texts = [b"".join(map(of, np.frombuffer(_buffer(x) or b"", "<u4").tolist())) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*columns, out])
            give_back()

    return encoded.select(*columns).mapInArrow(run, encoded.select(*columns).schema.add(out, "binary"))


def _buffer(x):
    return x.as_buffer() if x.is_valid else None
