"""Suffix-array dedup of repeated byte strings: suffix buckets sorted one block at a time with a difference cover.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. The suffixes to compare
are the windows of ``length`` bytes. They are dealt into buckets by content: a window's anchor is its ``GRAM``-byte
string of least hash (the rightmost of equals), so equal windows have equal anchors at equal places. The windows
of one anchor occurrence are consecutive; together they are its context, a run of bytes.

1. Anchors are counted by partial aggregates. An anchor that occurs once repeats nothing. If all contexts of an
   anchor are one string, all their windows repeat. No text moves for either. That two whole contexts are one string
   is judged by two 64-bit hashes, of the anchor and of the context with the anchor's place; nothing else is.
2. Only distinct contexts of the remaining anchors are sorted, a pack of buckets at a time. ``repeats`` builds the order of
   a block's window suffixes by a difference cover modulo ``V``: the ranks of the cover sample come first, by
   doubling; windows are sorted by their first ``V`` bytes; longer ties are resolved by the sample ranks at the shift
   where both positions lie in the cover. Neighbours in that order are compared byte by byte.
3. A bucket of more than ``BUCKET_CONTEXTS`` distinct contexts (a passage in a large share of all texts) is dealt on by
   a longer key: windows with the anchor at nearly one place share nearly all of their bytes, so the bytes that
   ``block`` neighbouring windows have in common (``length - block + 1``, for ever smaller blocks of ``FINER``) divide it.
   Equal windows stay together; every bucket goes through the same sort. In the last one all windows are one string.

Memory is bounded by the pack, whatever the corpus. Texts are shuffled once by document, for contexts and cuts.

Defined results: NULL text is empty; texts shorter than ``length`` lose nothing; rows that repeat (id, text)
repeat each other's strings and each lose them; NULL ids are rows like others; an empty table gives no rows;
``remove`` passes other columns through and drops the rest of a character that a cut splits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, parts_for, stage
from tidewater.llm.linkage import spans
from tidewater.llm.textarrays import mix, prefix_hash, span_hash
from tidewater.llm.tokens import give_back, runs, text_runs

LENGTH, GRAM = 200, 64
PIECE = 1 << 20  # bytes of windows that are hashed at once
V, COVER = 13, (0, 1, 3, 9)  # every difference modulo 13 is one of two members of the cover
BLOCK_WINDOWS, PACK_BYTES, BUCKET_CONTEXTS = 250_000, 4 << 20, 2_000
FINER = (32, 8, 1)  # windows that share a key, level by level
NO_ID = -(1 << 63)


def windows_by_anchor(buf: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs of windows with one anchor in texts strung together: start, end (exclusive), anchor, and two hashes.

    ``ends`` are the texts' ends; windows do not cross them. The first hash is the anchor's, the second that
    of the context with the place of the anchor in it.
    """
    n, width = len(buf), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none
    prefix = prefix_hash(buf)
    at = np.arange(n - gram + 1)
    hashes = span_hash(prefix, at, at + gram)
    low = np.uint64((1 << 24) - 1)
    key = (hashes & ~low) | (low - at.astype(np.uint64))  # of equal hashes the rightmost is least
    rows = -(-len(key) // width)
    padded = np.full(rows * width, ~np.uint64(0))
    padded[:len(key)] = key
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, 1).reshape(-1)
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].reshape(-1)
    count = n - length + 1
    least = np.minimum(behind[:count], ahead[width - 1:width - 1 + count])
    anchor = (low - (least & low)).astype(np.int64)
    end_of = np.repeat(ends, np.diff(np.concatenate([[0], ends])))[:count]
    start = np.flatnonzero(np.arange(count) + length <= end_of)
    if not len(start):
        return none, none, none, none, none
    cut = np.flatnonzero((np.diff(start) != 1) | (np.diff(anchor[start]) != 0)) + 1
    first, last = start[np.concatenate([[0], cut])], start[np.concatenate([cut - 1, [len(start) - 1]])]
    anchor = anchor[first]
    context = span_hash(prefix, first, last + length)
    place = (anchor - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
    return first, last + 1, anchor, hashes[anchor].view(np.int64), mix(context + mix(place)).view(np.int64)


def _pieces(texts: list[bytes], length: int):
    """(text index, offset, bytes): long texts in overlapping pieces, so that each window is in one piece."""
    for k, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), PIECE):
            yield k, at, t[at:at + PIECE + length - 1]


def _runs(batches, length: int, gram: int):
    for b in batches:
        for at, _, texts in text_runs(b.column(2), 2 << 20):
            parts = [(at + k, o, x) for k, o, x in _pieces([t.encode() for t in texts], length) if len(x) >= length]
            for i, j in runs([len(p[2]) for p in parts], PIECE):
                ends = np.cumsum([len(p[2]) for p in parts[i:j]])
                buf = np.frombuffer(b"".join(p[2] for p in parts[i:j]), np.uint8)
                lo, hi, anchor, h, c = windows_by_anchor(buf, ends, length, gram)
                piece = np.searchsorted(ends, lo, "right")
                shift = np.array([p[1] for p in parts[i:j]])[piece] - np.concatenate([[0], ends[:-1]])[piece]
                who = pa.array(np.array([p[0] for p in parts[i:j]])[piece])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(who), b.column(1).take(who), pa.array(h), pa.array(c), pa.array(lo + shift),
                     pa.array((hi - lo).astype(np.int32)), pa.array((anchor - lo).astype(np.int32))],
                    ["d", "t", "h", "c", "lo", "n", "place"])


def sample_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Rank of every cover position's suffix by its first ``length`` bytes or more (0 elsewhere and past the end)."""
    n = len(text)
    at = np.flatnonzero(np.isin(np.arange(n) % V, COVER))
    far = np.concatenate([text, np.zeros(16, np.uint8)])
    head, tail = (sum(far[at + k].astype(np.uint64) << np.uint64(8 * (7 - k)) for k in range(8)),
                  sum(far[at + k].astype(np.uint64) << np.uint64(8 * (12 - k)) for k in range(8, V)))
    rank = np.zeros(n + 2 * length + 2 * V, np.int64)
    rank[at] = dense(head, tail)
    known = V
    while known < length:  # a position and the one ``known`` (a multiple of V) ahead are both in the cover
        rank[at] = dense(rank[at], rank[np.minimum(at + known, len(rank) - 1)])
        known *= 2
    return rank


def dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1, equal for equal keys."""
    order, parts = _runs_of(*keys)
    out = np.empty(len(order), np.int64)
    out[order] = parts
    return out


def _runs_of(*keys):
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), np.int64)
    if len(order):
        new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], 0)
    return order, np.cumsum(new)


def shift_to_cover(x: int, y: int) -> int:
    """Least shift that brings positions of residues x and y both into the cover."""
    return next(s for s in range(V) if (x + s) % V in COVER and (y + s) % V in COVER)


def repeats(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each window [start, start + length) of ``text``: does an equal one start at another of ``starts``?"""
    out = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return out
    far = np.concatenate([text, np.zeros(16, np.uint8)])
    head, tail = (sum(far[starts + k].astype(np.uint64) << np.uint64(8 * (7 - k)) for k in range(8)),
                  sum(far[starts + k].astype(np.uint64) << np.uint64(8 * (12 - k)) for k in range(8, V)))
    order, group = _runs_of(head, tail)
    tied = np.bincount(group)[group] > 1
    order, group = order[tied], group[tied]
    if not len(order):
        return out
    rank = sample_ranks(text, length)
    pos, size = starts[order], np.int64(rank.max() + 1)
    residue = pos % V
    of = [np.flatnonzero(residue == r) for r in range(V)]
    less = np.zeros(len(pos), np.int64)
    for y in range(V):
        if not len(of[y]):
            continue
        for s in {shift_to_cover(x, y) for x in range(V) if len(of[x])}:
            key = np.sort(group[of[y]] * size + rank[pos[of[y]] + s])
            mine = [of[x] for x in range(V) if len(of[x]) and shift_to_cover(x, y) == s]
            mine = np.concatenate(mine)
            base = group[mine] * size
            less[mine] += np.searchsorted(key, base + rank[pos[mine] + s]) - np.searchsorted(key, base)
    final = np.lexsort((less, group))
    pos, group, order = pos[final], group[final], order[final]
    near = np.flatnonzero(group[1:] == group[:-1])
    byte = np.arange(length)
    for i in range(0, len(near), 20_000):
        k = near[i:i + 20_000]
        same = (text[pos[k][:, None] + byte] == text[pos[k + 1][:, None] + byte]).all(1)
        out[order[k[same]]] = out[order[k[same] + 1]] = True
    return out


def _contexts(batches, length: int):
    """Context bytes that a document was asked for."""
    kinds = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("copies", pa.int64()), ("n", pa.int32()),
                       ("place", pa.int32()), ("hot", pa.bool_()), ("bytes", pa.binary())])
    made = lambda got: pa.RecordBatch.from_pylist([dict(zip(kinds.names, x, strict=True)) for x in got], kinds)
    for b in batches:
        got, held = [], 0
        texts = b.column("text")
        for k, wanted in enumerate(b.column("wanted")):
            text = (texts[k].as_py() or "").encode()
            for w in wanted.as_py():
                got.append((w["h"], w["c"], w["copies"], w["n"], w["place"], w["hot"],
                            text[w["lo"]:w["lo"] + w["n"] + length - 1]))
                held += w["n"] + length
            if held > 4 << 20:
                yield made(got)
                got, held = [], 0
        if got:
            yield made(got)
        give_back()


def _stretches(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"lo": int(a), "hi": int(z)} for a, z in zip(edge[::2], edge[1::2], strict=True)]


def _sort_pack(pack: pa.Table, length: int) -> pa.Table:
    """Stretches of repeated windows in each context of a pack, one block of buckets at a time."""
    h, c = pack.column("h").to_numpy(), pack.column("c").to_numpy()
    order = spans(h, c)[0]
    count, copies = pack.column("n").to_numpy(), pack.column("copies").to_numpy()
    texts = pack.column("bytes")
    bucket = np.flatnonzero(np.concatenate([[True], np.diff(h[order]) != 0])) if len(order) else order
    weight = np.add.reduceat(count[order], bucket) if len(order) else bucket
    limits = [*bucket.tolist(), len(order)]
    found = []
    for i, j in runs(weight.tolist(), BLOCK_WINDOWS):
        rows = order[limits[i]:limits[j]]
        parts_ = [texts[k].as_buffer().to_pybytes() for k in rows.tolist()]
        size = np.array([len(x) for x in parts_])
        base = np.cumsum(size) - size
        n = count[rows]
        starts = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(n.sum())
        flags = repeats(np.frombuffer(b"".join(parts_), np.uint8), starts, length)
        for k, f in zip(rows.tolist(), np.split(flags, np.cumsum(n)[:-1]), strict=True):
            found.append(_stretches(np.ones(len(f), bool) if copies[k] > 1 else f))
    give_back()
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    return pa.table({"h": pa.array(h[order]), "c": pa.array(c[order]), "found": pa.array(found, kind)})


def _finer(batches, block: int, length: int):
    """Contexts of large buckets cut where the anchor's place in the window passes a multiple of ``block``.

    ``h`` is the hash of the bytes that all windows of such a stretch share, whatever lies around them.
    """
    for b in batches:
        n_all, place_all = (b.column(x).to_numpy().astype(np.int64) for x in ("n", "place"))
        pieces = place_all // block - (place_all - n_all + 1) // block + 1
        for i, j in runs((pieces * (length + block)).tolist()):
            n, place, raw = n_all[i:j], place_all[i:j], b"".join(b.column("bytes").slice(i, j - i).to_pylist())
            base = np.cumsum(n + length - 1) - (n + length - 1)
            who = np.repeat(np.arange(j - i), pieces[i:j])
            k = np.arange(len(who)) - np.repeat(np.cumsum(pieces[i:j]) - pieces[i:j], pieces[i:j])
            k += ((place - n + 1) // block)[who]
            near, far = place[who] - k * block, place[who] - k * block - block + 1  # starts of the block's windows
            lo, hi = np.maximum(far, 0), np.minimum(near, n[who] - 1)
            prefix = prefix_hash(np.frombuffer(raw, np.uint8))
            at = base[who]
            parent = b.column("h").to_numpy()[i:j][who].view(np.uint64)
            h = mix(span_hash(prefix, at + near, at + far + length) + mix(parent + k.astype(np.uint64)))
            around = (place[who] - lo).astype(np.uint64) << np.uint64(32) | (hi - lo).astype(np.uint64)
            c = mix(span_hash(prefix, at + lo, at + hi + length) + mix(around))
            take = pa.array(who + i)
            yield pa.RecordBatch.from_arrays(
                [b.column("h").take(take), b.column("c").take(take), pa.array(lo), pa.array(h.view(np.int64)),
                 pa.array(c.view(np.int64)), b.column("copies").take(take), pa.array((hi - lo + 1).astype(np.int32)),
                 pa.array((place[who] - lo).astype(np.int32)),
                 pa.array([raw[x:y] for x, y in zip((at + lo).tolist(), (at + hi + length).tolist(), strict=True)],
                          pa.binary())],
                ["of_h", "of_c", "off", "h", "c", "copies", "n", "place", "bytes"])


def _in_order(contexts: DataFrame, n_bytes: int, large: bool, length: int, most: int, blocks: tuple) -> DataFrame:
    """``h, c, found``: stretches of repeated windows in each context (distinct by ``h, c``); ``large``: are some ``hot``?"""
    contexts = stage(contexts) if large else contexts
    packs = parts_for(n_bytes, PACK_BYTES)
    pack = contexts.where("NOT hot").withColumn("pack", F.pmod(F.xxhash64("h"), F.lit(packs)))
    found = pack.groupBy("pack").applyInArrow(lambda t: _sort_pack(t, length),
                                              "h long, c long, found array<struct<lo:long,hi:long>>")
    if not large:
        return found
    block = blocks[0]
    cut = stage(contexts.where("hot").mapInArrow(
        lambda b: _finer(b, block, length),
        "of_h long, of_c long, off long, h long, c long, copies long, n int, place int, bytes binary"))
    distinct = stage(cut.groupBy("h", "c").agg(F.sum("copies").alias("copies"), F.first("n").alias("n"),
                                               F.first("place").alias("place"), F.first("bytes").alias("bytes")))
    # A bucket of one context that occurs once repeats nothing. Written, so that a large bucket can be split.
    sizes = stage(distinct.groupBy("h").agg(F.count("*").alias("contexts"), F.sum("copies").alias("times")).where("times > 1")
                  .select("h", (F.lit(len(blocks) > 1) & (F.col("contexts") > most)).alias("hot")))
    size = distinct.join(sizes, "h").agg(F.sum(F.octet_length("bytes")).cast("long")).first()[0] or 0
    finer = _in_order(distinct.join(sizes, "h"), size, bool(sizes.where("hot").limit(1).count()), length, most, blocks[1:])
    back = finer.join(cut.select("of_h", "of_c", "off", "h", "c"), ["h", "c"]).select(
        F.col("of_h").alias("h"), F.col("of_c").alias("c"),
        F.expr("transform(found, f -> named_struct('lo', f.lo + off, 'hi', f.hi + off))").alias("found"))
    return found.unionByName(back)


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                  bucket_contexts: int = BUCKET_CONTEXTS) -> DataFrame:
    """(d, t, lo, hi): byte runs of each text that repeated strings cover; they may overlap. ``docs`` has d, t, text."""
    bound_batches(docs.sparkSession)
    found = docs.select("d", "t", "text").mapInArrow(
        lambda b: _runs(b, length, gram), "d long, t long, h long, c long, lo long, n int, place int")
    tally = found.groupBy("h").agg(F.count("*").alias("times"), F.min("c").alias("least"), F.max("c").alias("most"))
    # Written, so that the join's two sides come straight from exchanges and adaptive execution can split a hot anchor.
    again = stage(tally.where("times > 1").select("h", (F.col("least") < F.col("most")).alias("mixed")))
    marked = stage(found.join(again, "h"))
    same = marked.where("NOT mixed").select("d", "t", "lo", (F.col("lo") + F.col("n") + (length - 1)).alias("hi"))

    mixed = marked.where("mixed")
    distinct = mixed.groupBy("h", "c").agg(F.count("*").alias("copies"),
                                           F.min(F.struct("d", "t", "lo", "n", "place")).alias("at"))
    distinct = stage(distinct)
    hot = stage(distinct.groupBy("h").count().where(F.col("count") > bucket_contexts).select("h", F.lit(True).alias("hot")))
    wanted = distinct.join(hot, "h", "left").groupBy(F.col("at.d").alias("d"), F.col("at.t").alias("t")).agg(
        F.collect_list(F.struct("h", "c", "copies", F.col("at.lo").alias("lo"), F.col("at.n").alias("n"),
                                F.col("at.place").alias("place"), F.coalesce("hot", F.lit(False)).alias("hot"))).alias("wanted"))
    once = docs.groupBy("d", "t").agg(F.first("text").alias("text"))  # a row that repeats brings its contexts once
    contexts = once.join(wanted, ["d", "t"]).mapInArrow(
        lambda b: _contexts(b, length), "h long, c long, copies long, n int, place int, hot boolean, bytes binary")
    weight = distinct.agg(F.sum(F.col("at.n") + F.lit(length)).cast("long")).first()[0] or 0
    sorted_ = _in_order(contexts, weight, bool(hot.limit(1).count()), length, bucket_contexts, FINER)
    part = mixed.join(sorted_, ["h", "c"]).select("d", "t", "lo", F.explode("found").alias("f"))
    part = part.select("d", "t", (F.col("lo") + F.col("f.lo")).alias("lo"),
                       (F.col("lo") + F.col("f.hi") + (length - 1)).alias("hi"))
    return same.unionByName(part)


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open runs as maximal runs in order."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]]) if len(lo) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return lo[at], hi[np.concatenate([at[1:] - 1, [len(lo) - 1]])] if len(lo) else hi


def _cut(batches, whole: bool):
    for b in batches:
        texts, cuts = b.column("text"), b.column("cuts")
        rows, held, first = [], 0, 0
        for k in range(b.num_rows):
            text = (texts[k].as_py() or "").encode()
            if cuts[k].is_valid:
                run = cuts[k].values
                lo, hi = merged(run.field("lo").to_numpy(), run.field("hi").to_numpy())
                kept = b"".join(text[i:j] for i, j in zip([0, *hi.tolist()], [*lo.tolist(), len(text)], strict=True))
                if whole:  # a cut may split a character: its other bytes go too
                    kept = kept.decode("utf-8", "ignore").encode()
                rows.append((len(text), int((hi - lo).sum()), len(lo), kept))
            else:
                rows.append((len(text), 0, 0, text))
            held += len(text)
            if held > 4 << 20 or k == b.num_rows - 1:
                n, gone, n_spans, kept = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, len(rows)), b.column("rest").slice(first, len(rows)),
                     pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(n_spans, pa.int64()),
                     pa.array(kept, pa.binary())],
                    ["doc_id", "rest", "n_bytes", "n_removed", "n_spans", "kept"])
                rows, held, first = [], 0, k + 1
        give_back()


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                bucket_contexts: int = BUCKET_CONTEXTS, carry: tuple = (), whole: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, rest`` (struct of the ``carry`` columns), counts and ``kept`` (bytes).

    ``whole`` also drops bytes of ``kept`` that a cut has left of a split character.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"),
                    F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"),
                    F.struct(F.col(text_col).isNull().alias("was_null"), *[F.col(c) for c in carry]).alias("rest"))
    found = repeated_runs(d, length, bucket_contexts=bucket_contexts)
    cuts = found.groupBy("d", "t").agg(F.collect_set(F.struct("lo", "hi")).alias("cuts"))
    rest = d.schema["rest"].dataType.simpleString()
    return d.join(cuts, ["d", "t"], "left").mapInArrow(
        lambda b: _cut(b, whole), f"doc_id long, rest {rest}, n_bytes long, n_removed long, n_spans long, kept binary")


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated strings cut from the text column; all rows and other columns stay."""
    others = [c for c in docs.columns if c != text_col]
    out = cut_repeats(docs, id_col, text_col, length, carry=tuple(others), whole=True)
    text = F.when(~F.col("rest.was_null"), F.col("kept").cast("string"))
    return out.select(*[text.alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])
