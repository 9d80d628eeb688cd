"""N-gram Jaccard join: MinHash banding, candidates by band, links verified on full n-gram sets.

A document's set holds the hashes of its word 5-grams (a text of fewer words, but not none, is one gram).
Documents with one set form a class; classes, not copies, are compared. ``plan_bands`` chooses bands and rows
for a target recall at the threshold. Band hashes are shuffled; in a band's bucket, cut into tiles of bounded size, classes
meet with a sketch, the low byte of each of their MinHashes. Only pairs whose sketches agree in at least ``plan_matches``
places become candidates (a pair at the threshold falls short with probability ``MISS``), so texts that merely share a band do
not chain into large groups; a bucket gives one edge per class, not its pairs. Within each connected group of candidates
the full sets meet in tiles and every pair is judged exactly, so no link inside a group depends on its band or its sketch.

Defined results: NULL, empty and wordless texts link with nothing and are their own component; repeated rows
are copies; NULL ids take part, but are nobody's component id unless all of the component are NULL; an empty table gives no rows; other
columns pass through ``deduplicate`` and are ignored by ``link``.
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
from tidewater.llm.textarrays import mix, word_hashes
from tidewater.llm.tokens import give_back, text_runs

N, THRESHOLD, RECALL, ROWS = 5, 0.8, 1 - 1e-6, 5
MISS = 1e-7  # chance that the sketches of a pair at the threshold agree in too few places
BLOCK_ROWS, PACK_ROWS = 400, 1_500
SKETCH_BLOCK_ROWS, SKETCH_PACK_ROWS = 2_000, 20_000
COLUMNS = 4096  # n-grams that a tile's matrix holds at once


def plan_bands(threshold: float, recall: float, rows: int = ROWS) -> int:
    """Bands of ``rows`` MinHashes needed so that a pair at the threshold shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def plan_matches(hashes: int, threshold: float, miss: float = MISS) -> int:
    """Most places in which sketches must agree so that a pair at the threshold falls short with probability ``miss``."""
    below, need = 0.0, 0
    while need < hashes:
        below += math.comb(hashes, need) * threshold ** need * (1 - threshold) ** (hashes - need)
        if below > miss:
            break
        need += 1
    return need


def gram_sets(texts: list[bytes], n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, strung together, and where each text's begin (plus the end)."""
    h, count = word_hashes(texts)
    begin = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(h)) - begin[owner]
    odd = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    full = np.flatnonzero(place + n <= count[owner])
    g = np.zeros(len(full), np.uint64)
    for j in range(n):
        g += h[full + j] * odd[j]
    who = owner[full]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = [np.sum(h[begin[k]:begin[k] + count[k]] * odd[:count[k]], dtype=np.uint64) + np.uint64(count[k]) for k in short]
        g, who = np.concatenate([g, np.array(extra, np.uint64)]), np.concatenate([who, short])
    g = mix(g)
    order = np.lexsort((g, who))
    g, who = g[order], who[order]
    if len(g):
        keep = np.concatenate([[True], (np.diff(who) != 0) | (g[1:] != g[:-1])])
        g, who = g[keep], who[keep]
    return g, np.searchsorted(who, np.arange(len(texts) + 1))


def band_hashes(grams: np.ndarray, first: np.ndarray, bands: int, rows: int, sketch: np.ndarray | None = None) -> np.ndarray:
    """One hash per text and band; texts without grams are left out. ``sketch`` takes the low byte of each MinHash."""
    rng = np.random.default_rng(12345)
    flip = rng.integers(0, 1 << 32, bands * rows, np.uint32)
    odd = rng.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
    start = first[:-1][np.diff(first) > 0]
    x = (grams >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(start), bands), np.uint64)
    value = np.empty_like(x)
    for b in range(bands):
        for j in range(rows):
            k = b * rows + j
            np.bitwise_xor(x, flip[k], out=value)
            np.multiply(value, odd[k], out=value)
            least = np.minimum.reduceat(value, start)
            if sketch is not None:
                sketch[:, k] = least & np.uint32(255)
            out[:, b] = mix(out[:, b] + least + np.uint64(j))
        out[:, b] = mix(out[:, b] + np.uint64(b))
    return out


def _signatures(batches, n: int, bands: int, rows: int):
    for batch in batches:
        for lo, hi, texts in text_runs(batch.column(2), 1 << 19):
            g, first = gram_sets([t.encode() for t in texts], n)
            some = np.diff(first) > 0
            low = np.zeros((int(some.sum()), bands * rows), np.uint8)
            hashes = band_hashes(g, first, bands, rows, low).view(np.int64) if some.any() else np.zeros((0, bands), np.int64)
            sketches = iter(low)
            keys = [hashlib.md5(g[i:j].tobytes()).digest() if j > i else None
                    for i, j in zip(first[:-1], first[1:], strict=True)]
            offsets = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.reshape(-1))),
                 pa.array([next(sketches).tobytes() if x else None for x in some], pa.binary())],
                ["doc_id", "text_hash", "cls", "bands", "sketch"])


def reached(sketch: np.ndarray, need: int) -> np.ndarray:
    """For each row a row that it is connected to by sketches that agree in ``need`` places (itself if to none before it).

    Rows already reached are not compared with each other, so a bucket of near copies costs about one comparison a row.
    """
    root, left = np.arange(len(sketch)), np.arange(len(sketch))
    while len(left):
        start, left = left[0], left[1:]
        queue = [start]
        while queue and len(left):
            hit = (sketch[left] == sketch[queue.pop()]).sum(1) >= need
            root[left[hit]] = start
            queue.extend(left[hit].tolist())
            left = left[~hit]
    return root


def _near(pack: pa.Table, need: int) -> pa.Table:
    """Candidate edges of the pack's buckets, at most one per row: to a row that it reaches by sketches."""
    lo, hi, group = (pack.column(c).to_numpy() for c in ("lo", "hi", "group"))
    order, parts = spans(group, lo, hi)
    node, raw = pack.column("node").take(pa.array(order)), pack.column("sketch").take(pa.array(order)).to_pylist()
    sketch = np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)
    root = np.repeat([i for i, _ in parts], [j - i for i, j in parts])
    alike = (sketch == sketch[root]).sum(1) >= need
    root = np.where(alike, root, np.arange(len(root)))
    for i, j in parts:
        if j - i > 2 and not alike[i:j].all():
            root[i:j] = i + reached(sketch[i:j], need)
    edge = np.flatnonzero(root != np.arange(len(root)))
    return pa.table({"a": node.take(pa.array(edge)), "b": node.take(pa.array(root[edge]))})


def links_of(texts: list[bytes], threshold: float, n: int) -> np.ndarray:
    """Boolean matrix: Jaccard similarity of the full n-gram sets is at least ``threshold``."""
    g, first = gram_sets(texts, n)
    size = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), size)
    order = np.argsort(g, kind="stable")
    g, owner = g[order], owner[order]
    column = np.concatenate([[0], np.cumsum(g[1:] != g[:-1])]) if len(g) else np.zeros(0, np.int64)
    shared = np.bincount(column)[column] > 1 if len(g) else np.zeros(0, bool)
    owner, column = owner[shared], column[shared]
    both = np.zeros((len(texts), len(texts)), np.float64)
    if len(column):
        column = np.concatenate([[0], np.cumsum(column[1:] != column[:-1])])
        for at in range(0, int(column[-1]) + 1, COLUMNS):
            i, j = np.searchsorted(column, [at, at + COLUMNS])
            has = np.zeros((len(texts), COLUMNS), np.float32)
            has[owner[i:j], column[i:j] - at] = 1
            both += has @ has.T
    union = size[:, None] + size[None, :] - both
    return (both >= threshold * union - 1e-9) & (both > 0)


def _verify(pack: pa.Table, threshold: float, n: int) -> pa.Table:
    """Per class the copies of classes linked in a tile, and an edge to the tile's root of its links."""
    group = np.unique(pack.column("group").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    lo, hi = pack.column("lo").to_numpy(), pack.column("hi").to_numpy()
    order, parts = spans(group, lo, hi)
    cls, texts = pack.column("node").to_pylist(), pack.column("text")
    block, copies = pack.column("block").to_numpy(), pack.column("copies").to_numpy()
    nodes, counts, others = [], [], []
    for i, j in parts:
        rows = {cls[k]: k for k in order[i:j].tolist()}
        at = np.array(list(rows.values()))
        linked = links_of([(texts[k].as_py() or "").encode() for k in at.tolist()], threshold, n)
        linked = across(linked, block[at], lo[at[0]], hi[at[0]])
        count, root, names = linked @ copies[at], roots(linked), list(rows)
        for k in np.flatnonzero(count).tolist():
            nodes.append(names[k]), counts.append(int(count[k])), others.append(names[root[k]])
    give_back()
    return pa.table({"node": pa.array(nodes, pa.binary()), "links": pa.array(counts, pa.int64()),
                     "other": pa.array(others, pa.binary())})


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N, threshold: float = THRESHOLD,
         recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_hash, class_id, n_links, component_id, kept, repeats``.

    ``n_links`` counts the other documents of similarity >= threshold, copies included; ``class_id`` is the
    smallest id with the same n-gram set; ``kept`` marks the component's smallest id; ``repeats`` is the number
    of rows with this id and text.
    """
    bound_batches(docs.sparkSession)
    bands = plan_bands(threshold, recall)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                    F.col(text_col).alias("text"))
    signed = stage(d.mapInArrow(lambda b: _signatures(b, n, bands, ROWS),
                                "doc_id long, text_hash long, cls binary, bands array<long>, sketch binary"))
    classes = stage(signed.where("cls IS NOT NULL").groupBy("cls").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("class_id"),
        F.min(F.struct("text_hash", "doc_id")).alias("rep"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")))
    nodes = classes.withColumnRenamed("cls", "node")
    banded = nodes.select("node", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("group"), "node")
    need = plan_matches(bands * ROWS, threshold)
    near = tiles(banded, SKETCH_BLOCK_ROWS, SKETCH_PACK_ROWS).join(nodes.select("node", "sketch"), "node")
    groups = components(near.groupBy("pack").applyInArrow(lambda t: _near(t, need), "a binary, b binary"))
    dealt = tiles(groups.select(F.col("component").alias("group"), "node"), BLOCK_ROWS, PACK_ROWS)
    # Keys without NULLs, so that one exchange serves the aggregate and the join; a row that repeats comes once.
    key = lambda i: (F.coalesce(i, F.lit(0)).alias("id0"), i.isNull().alias("no_id"))
    reps = classes.select(F.col("cls").alias("node"), "copies", F.col("rep.text_hash").alias("text_hash"),
                          *key(F.col("rep.doc_id")))
    once = d.select("text_hash", *key(F.col("doc_id")), "text").groupBy("text_hash", "id0", "no_id").agg(
        F.first("text").alias("text"))
    met = dealt.join(reps, "node").join(once, ["text_hash", "id0", "no_id"])
    met = met.select("pack", "group", "lo", "hi", "block", "node", "copies", "text")
    found = stage(met.groupBy("pack").applyInArrow(lambda t: _verify(t, threshold, n),
                                                   "node binary, links long, other binary"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    whole = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = (classes.select("cls", "copies", "class_id")
             .join(links.withColumnRenamed("node", "cls"), "cls", "left")
             .join(whole.withColumnRenamed("node", "cls"), "cls", "left")
             .select("cls", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component", "cls").alias("component")))
    known = stage(known)
    least = known.groupBy("component").agg(F.min("class_id").alias("component_id"))
    known = known.join(least, "component").select("cls", "class_id", "n_links", "component", "component_id")
    repeats = signed.groupBy("doc_id", "text_hash", "cls").agg(F.count("*").alias("repeats"))
    out = repeats.join(known, "cls", "left")
    own = F.col("cls").isNull()
    out = out.select("doc_id", "text_hash", F.when(own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                     F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                     F.when(own, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                     "component", "repeats")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each component, and every wordless text."""
    found = stage(link(docs, id_col, text_col))
    alone = found.where("component IS NULL")
    # Of a component's rows with the smallest id, one text stays.
    first = found.where("component IS NOT NULL AND kept").groupBy("component").agg(
        F.min(F.struct("doc_id", "text_hash", "repeats")).alias("r")).select("r.*")
    keep = alone.select("doc_id", "text_hash", F.lit(False).alias("again")).unionByName(
        first.select("doc_id", "text_hash", (F.col("repeats") > 1).alias("again")))
    keep = keep.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("again").alias("__again"))
    d = docs.withColumn("__text", F.xxhash64(F.col(text_col)))
    d = d.join(keep, d["__text"].eqNullSafe(keep["__hash"]) & d[id_col].cast("long").eqNullSafe(keep["__id"]))
    once, again = d.where(~F.col("__again")), d.where("__again").dropDuplicates(["__id", "__hash"])
    return once.unionByName(again).select(*docs.columns)
