"""Embedding near-dedup: randomised-rotation binary codes with correction factors and confidence bounds.

Equal vectors form a class; classes are compared. Signs of randomly rotated vectors give ``bands`` of ``bits``
bits, chosen so that a pair at the threshold shares a band with probability ``RECALL``; the bits grow with the
logarithm of the table, so a bucket of unrelated vectors stays small. Inside a bucket a pair is judged by code:
a vector's code is the signs of one more random rotation, its factor the inner product of code and vector; the
other vector comes as rotated components in 4-bit steps with unbiased rounding. Inner product over factor is an
unbiased estimate of the cosine, with a confidence bound from the factor. Pairs whose upper bounds reach the
threshold are kept as candidates (linear in the bucket: one edge per row), which connect into groups. Within each
group all vectors meet in tiles of bounded size; there the bounds decide again, pair by pair: only a pair whose upper
bound reaches the threshold is recomputed, from the vectors, in double precision. No pair is accepted by a bound
alone, since a link must hold exactly. At a cosine of 0.9 and 64 dimensions an upper bound falls short of the true
cosine only beyond more than five standard errors.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing;
vectors of different lengths never link; repeated vectors are copies and link with each other; NULL ids take
part, but name a component only if nothing else can; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, stage
from tidewater.llm.linkage import across, components, roots, spans, tiles

THRESHOLD, RECALL, BOUND = 0.9, 1 - 1e-6, 3.0
BLOCK_ROWS, PACK_ROWS = 1_000, 20_000
STEPS = 15  # a 4-bit scale
PAIRS = 4096  # recomputed at once


def plan_bands(n_vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bands, bits): about one unrelated vector per bucket; bands for the recall at the threshold."""
    bits = min(40, max(8, math.ceil(math.log2(max(n_vectors, 2)))))
    agree = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(1 - recall) / math.log(1 - agree ** bits)), bits


def rotation(dim: int, k: int) -> np.ndarray:
    """The k-th random orthonormal matrix of a dimension."""
    q, r = np.linalg.qr(np.random.default_rng([dim, k]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vector) -> np.ndarray | None:
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    return v if np.isfinite(v).all() and v.any() else None


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; large and tiny components are scaled first."""
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _classes(batches):
    for b in batches:
        vectors = [usable(x) for x in b.column(1).to_pylist()]
        raw = [None if v is None else (v + 0.0).tobytes() for v in vectors]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([None if x is None else hashlib.md5(x).digest() for x in raw], pa.binary()),
             pa.array(raw, pa.binary())], ["vec_id", "cls", "vector"])


def by_length(raw: list[bytes]):
    """(rows, matrix of unit vectors) for each vector length."""
    size = np.array([len(x) for x in raw])
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, unit(np.frombuffer(b"".join(raw[k] for k in at), np.float64).reshape(len(at), -1))


def band_keys(units: np.ndarray, bands: int, bits: int) -> np.ndarray:
    """One 64-bit bucket key per row and band: sign bits of successive rotations, with the band and the length."""
    dim, need = units.shape[1], bands * bits
    signs = np.concatenate([units @ rotation(dim, k + 1).T > 0 for k in range(math.ceil(need / dim))], 1)[:, :need]
    place = np.uint64(1) << np.arange(bits, dtype=np.uint64)
    keys = (signs.reshape(len(units), bands, bits) * place).sum(2, dtype=np.uint64)
    return keys | (np.arange(bands, dtype=np.uint64) << np.uint64(40)) | np.uint64(dim % 256 << 56)


def codes(units: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits, factors, 4-bit components (rounded at random, unbiased) and their (low, step)."""
    dim = units.shape[1]
    turned = units @ rotation(dim, 0).T
    signs = turned > 0
    factor = np.abs(turned).sum(1) / np.sqrt(dim)
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / STEPS, 1e-12)
    level = np.floor((turned - low[:, None]) / step[:, None] + rng.random(turned.shape))
    return np.packbits(signs, 1), factor, np.clip(level, 0, STEPS).astype(np.uint8), np.stack([low, step], 1)


def pack_code(signs: np.ndarray, factor: np.ndarray, level: np.ndarray, scale: np.ndarray) -> list[bytes]:
    """A row's code: dimension u16, factor, low and step f32, sign bits, two components to the byte."""
    if level.shape[1] % 2:
        level = np.concatenate([level, np.zeros((len(level), 1), np.uint8)], 1)
    half = (level[:, ::2] << 4 | level[:, 1::2]).astype(np.uint8)
    head = np.column_stack([factor, scale]).astype("<f4").view(np.uint8).reshape(len(factor), -1)
    return [r.tobytes() for r in np.concatenate([head, signs, half], 1)]


def unpack_code(rows: list[bytes], dim: int):
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    head = np.ascontiguousarray(raw[:, :12]).view("<f4")
    n = (dim + 7) // 8
    sign = np.unpackbits(raw[:, 12:12 + n], 1, dim).astype(np.float32) * 2 - 1
    half = raw[:, 12 + n:]
    level = np.stack([half >> 4, half & 15], 2).reshape(len(rows), -1)[:, :dim]
    return sign / np.sqrt(dim).astype(np.float32), head[:, 0], head[:, 1:2] + head[:, 2:3] * level


def _bands(batches, bands: int, bits: int):
    for b in batches:
        raw, cls = b.column(1).to_pylist(), b.column(0)
        for at, units in by_length(raw):
            for lo in range(0, len(at), 2000):
                part, u = at[lo:lo + 2000], units[lo:lo + 2000]
                keys = band_keys(u, bands, bits)
                who = cls.take(pa.array(np.repeat(part, bands)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), who], ["group", "node"])


def _codes(batches):
    for b in batches:
        raw = b.column("vector").to_pylist()
        for at, units in by_length(raw):
            seed = int.from_bytes(hashlib.md5(raw[at[0]]).digest()[:8], "little")
            packed = pack_code(*codes(units, np.random.default_rng(seed)))
            part = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array([units.shape[1]] * len(at), pa.int32()), pa.array(packed, pa.binary())],
                [*part.schema.names, "dim", "code"])


def slack(factor, comp):
    """How far an estimate may lie from the cosine: by the code's angle (per row of ``factor``), by rounding (of ``comp``)."""
    dim = comp.shape[1]
    return (BOUND * np.sqrt(np.maximum(1 - factor ** 2, 0) / max(dim - 1, 1)),
            BOUND * (comp.max(1) - comp.min(1)) / STEPS / 2)


def bounds(sign, factor, comp, i, j):
    """Lower and upper confidence bounds of the cosines of rows i and j: each code meets the other's components."""
    angle, rounding = slack(factor, comp)
    low, high = -np.inf, np.inf
    for a, b in ((i, j), (j, i)):
        estimate = np.einsum("ij,ij->i", sign[a], comp[b]) / factor[a]
        far = (angle[a] + rounding[b]) / factor[a]
        low, high = np.maximum(low, estimate - far), np.minimum(high, estimate + far)
    return low, high


def upper(sign, factor, comp):
    """Upper confidence bounds of the cosines of all rows with each other."""
    angle, rounding = slack(factor, comp)
    high = (sign @ comp.T + angle[:, None] + rounding[None, :]) / factor[:, None]
    return np.minimum(high, high.T)


def _estimate(pack: pa.Table, threshold: float) -> pa.Table:
    """Candidate edges of the pack's buckets: an edge to the least row that a row reaches, by upper bounds."""
    lo, hi = pack.column("lo").to_numpy(), pack.column("hi").to_numpy()
    group, block = pack.column("group").to_numpy(), pack.column("block").to_numpy()
    node, code, dims = pack.column("node").to_pylist(), pack.column("code").to_pylist(), pack.column("dim").to_numpy()
    order, parts = spans(group, lo, hi, dims)
    a, b = [], []
    small = [(i, j) for i, j in parts if j - i <= 24]
    for dim in np.unique(dims):
        # Small buckets together: rows in bucket order against the row t places on.
        rows = np.concatenate([np.zeros(0, np.int64), *[order[i:j] for i, j in small if dims[order[i]] == dim]]).astype(int)
        if len(rows) > 1:
            owner = np.repeat(np.arange(len(small)), [j - i if dims[order[i]] == dim else 0 for i, j in small])
            sign, factor, comp = unpack_code([code[k] for k in rows.tolist()], int(dim))
            for t in range(1, 24):
                p = np.flatnonzero(owner[t:] == owner[:-t])
                if not len(p):
                    break
                p = p[(lo[rows[p]] == hi[rows[p]]) | (block[rows[p]] != block[rows[p + t]])]
                high = bounds(sign, factor, comp, p, p + t)[1]
                for q in p[high >= threshold].tolist():
                    a.append(node[rows[q]]), b.append(node[rows[q + t]])
    for i, j in parts:
        if j - i > 24:
            rows = order[i:j]
            sign, factor, comp = unpack_code([code[k] for k in rows.tolist()], int(dims[rows[0]]))
            linked = across(upper(sign, factor, comp) >= threshold, block[rows], lo[rows[0]], hi[rows[0]])
            root = roots(linked)
            for k in np.flatnonzero(root != np.arange(len(rows))).tolist():
                a.append(node[rows[k]]), b.append(node[rows[root[k]]])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def confirmed(open_: np.ndarray, units: np.ndarray, threshold: float) -> np.ndarray:
    """Of the pairs that the bounds leave ``open_``, those whose cosine in double precision reaches the threshold."""
    i, j = np.nonzero(np.triu(open_))
    linked = np.zeros_like(open_)
    for at in range(0, len(i), PAIRS):
        a, b = i[at:at + PAIRS], j[at:at + PAIRS]
        yes = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
        linked[a[yes], b[yes]] = linked[b[yes], a[yes]] = True
    return linked


def _recompute(pack: pa.Table, threshold: float) -> pa.Table:
    """Links of a tile, by exact cosines where bounds leave them open: copies linked to each class, an edge to its root."""
    lo, hi, block = (pack.column(c).to_numpy() for c in ("lo", "hi", "block"))
    group = np.unique(pack.column("group").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    node, raw = pack.column("node").to_pylist(), pack.column("vector").to_pylist()
    code = pack.column("code")
    copies = pack.column("copies").to_numpy()
    order, parts = spans(group, lo, hi)
    nodes, counts, others = [], [], []
    for i, j in parts:
        for at, units in by_length([raw[k] for k in order[i:j].tolist()]):
            rows = order[i:j][at]
            linked = upper(*unpack_code([code[k].as_py() for k in rows.tolist()], units.shape[1])) >= threshold
            linked = confirmed(across(linked, block[rows], lo[rows[0]], hi[rows[0]]), units, threshold)
            count, root = linked @ copies[rows], roots(linked)
            for k in np.flatnonzero(count).tolist():
                nodes.append(node[rows[k]]), counts.append(int(count[k])), others.append(node[rows[root[k]]])
    return pa.table({"node": pa.array(nodes, pa.binary()), "links": pa.array(counts, pa.int64()),
                     "other": pa.array(others, pa.binary())})


def link(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
         recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links, component_id, kept``."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bound_batches(vectors.sparkSession)
    signed = stage(v.mapInArrow(_classes, "vec_id long, cls binary, vector binary"))
    classes = stage(signed.where("cls IS NOT NULL").groupBy("cls").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least_id"), F.first("vector").alias("vector")))
    bands, bits = plan_bands(classes.count(), threshold, recall)
    nodes = classes.select(F.col("cls").alias("node"), "vector", "copies")
    banded = nodes.select("node", "vector").mapInArrow(lambda b: _bands(b, bands, bits), "group long, node binary")
    dealt = tiles(banded, BLOCK_ROWS, PACK_ROWS)
    coded = stage(nodes.mapInArrow(_codes, "node binary, vector binary, copies long, dim int, code binary"))
    near = dealt.join(coded.select("node", "dim", "code"), "node").groupBy("pack").applyInArrow(lambda t: _estimate(t, threshold), "a binary, b binary")
    groups = components(near)
    dealt = tiles(groups.select(F.col("component").alias("group"), "node"), BLOCK_ROWS, PACK_ROWS)
    exact = dealt.join(coded, "node")
    found = stage(exact.groupBy("pack").applyInArrow(lambda t: _recompute(t, threshold),
                                                     "node binary, links long, other binary"))
    links = found.groupBy(F.col("node").alias("cls")).agg(F.sum("links").alias("links"))
    whole = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = stage(classes.select("cls", "copies", "least_id").join(links, "cls", "left")
                  .join(whole.withColumnRenamed("node", "cls"), "cls", "left")
                  .select("cls", "least_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                          F.coalesce("component", "cls").alias("component")))
    least = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    known = known.join(least, "component").select("cls", "n_links", "component_id")
    out = signed.select("vec_id", "cls").join(known, "cls", "left")
    own = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.col("vec_id").eqNullSafe(own).alias("kept"))
