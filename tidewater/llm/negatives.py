"""Hard-negative mining: Fagin's threshold algorithm over per-dimension sorted lists.

Components are rounded down to integers (``floor(scale * x)``), a row's score is its integer inner product with the
anchor; higher scores come first, ties go to the smaller id. Rows are dealt to blocks of about ``BLOCK_ROWS`` by a hash
and meet the anchors in blocks of ``ANCHORS``, so that a task holds one block of each. There each dimension has a list
of the block's rows sorted by its component. An anchor walks all lists at once, from the end that its own sign favours
(a dimension where it is 0 says nothing); rows met for the first time are scored in full by random access. The
threshold, the anchor times the last components met, bounds the score of every row not yet met: the walk stops once
it falls strictly below the k-th best score so far (strictly, since a tie may still bring a smaller id), or below
where the window ends. Each block sends its first ``k`` only; the first ``k`` of them all are the answer.

There are two walks: for the anchor's positives (other rows of its label), and, once these are known over all
blocks, for the negatives (rows of other labels) inside each positive's window of scores. Both are exact.

Defined results: rows without a label or vector, or with a NULL or non-finite component, take no part, nor do those
with a component so large that ``scale`` times it is not finite; vectors of different lengths never meet; NULL ids take
part, but not as anchors, and come after the other ids of their score; rows that repeat an id or a vector count one by
one, an anchor's copies are other rows; an anchor that has no positives or negatives gives no rows; an empty
table gives no rows; other columns are ignored. A pair whose score is beyond the range of a long is left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, stage

SCALE = 256.0
BLOCK_ROWS, ANCHORS = 8_192, 512
FIRST_DEPTH = 32  # entries of each list in the first step; each further step doubles the depth
LONG = (1 << 63) - 1
FOUND = "anchor long, anchor_id long, positive int, row long, id long, score long"


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """``id, label, cells`` (integer components as doubles) of the rows that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"),
                       F.transform(F.col(vector_col).cast("array<double>"), lambda x: x * F.lit(SCALE)).alias("cells"))
    finite = F.forall("cells", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # rint twice: a floor that stays a double, whatever its size
    floor = lambda x: F.rint(x) - F.when(F.rint(x) > x, F.lit(1.0)).otherwise(F.lit(0.0))
    return v.where(F.col("label").isNotNull() & F.col("cells").isNotNull() & finite).withColumn(
        "cells", F.transform("cells", floor))


class Block:
    """Rows of one length with their sorted lists; exact scores of any of them for an anchor."""

    def __init__(self, ids, rows, labels, cells: np.ndarray):
        order = np.lexsort((rows, ids))  # places follow the ids, so that equal scores are taken in order of place
        self.ids, self.rows, self.labels, self.cells = ids[order], rows[order], labels[order], cells[order]
        self.lists = np.argsort(self.cells, axis=0, kind="stable").T
        self.largest = float(np.abs(self.cells).max(initial=0))

    def exact(self, anchor: np.ndarray) -> bool:
        """Whether every sum of products with the anchor is exact in doubles."""
        return self.largest * float(np.abs(anchor).max(initial=0)) * len(anchor) < 2 ** 53

    def score(self, anchor: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Inner products: in doubles where they are exact, else in integers of any size."""
        if self.exact(anchor):
            return (self.cells[at] @ anchor).astype(np.int64)
        whole = [int(x) for x in anchor]
        return np.array([sum(int(x) * y for x, y in zip(r, whole, strict=True)) for r in self.cells[at]], object)

    def threshold(self, anchor: np.ndarray, dims: np.ndarray, last: np.ndarray) -> int:
        """The anchor times the last components met: no row that was not met scores more."""
        cells = self.cells[last, dims]
        if self.exact(anchor):
            return int(cells @ anchor[dims])
        return sum(int(a) * int(x) for a, x in zip(anchor[dims], cells, strict=True))

    def walk(self, anchor: np.ndarray, wanted: np.ndarray, windows: list[tuple], k: int) -> list[tuple]:
        """For each window (low, high; None is open) places and scores of the first ``k`` of the ``wanted`` in it."""
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        dims, n, depth = np.concatenate([up, down]), len(self.rows), 0
        unmet = wanted.copy()
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(windows)
        while True:  # each step doubles the depth
            met, to = np.zeros(n, bool), min(n, max(FIRST_DEPTH, 2 * depth))
            met[self.lists[up, n - to:n - depth]] = True
            met[self.lists[down, depth:to]] = True
            new = np.flatnonzero(met & unmet if len(dims) else unmet)
            unmet[new] = False
            scores = self.score(anchor, new)
            best = [first(np.concatenate([a, new]), np.concatenate([s, scores]), low, high, k)
                    for (a, s), (low, high) in zip(best, windows, strict=True)]
            if to == n or not unmet.any():
                return best
            most = self.threshold(anchor, dims, np.concatenate([self.lists[up, n - to], self.lists[down, to - 1]]))
            if all(len(s) == k and most < s[-1] or low is not None and most < low
                   for (_, s), (low, _) in zip(best, windows, strict=True)):
                return best
            depth = to


def first(at: np.ndarray, scores: np.ndarray, low, high, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` places of highest scores from ``low`` to ``high``, in order; of equal scores the smaller places."""
    if scores.dtype == object:
        long = (scores >= -LONG) & (scores <= LONG)
        at, scores = at[long], scores[long].astype(np.int64)
    if low is not None:
        at, scores = at[(scores >= low) & (scores <= high)], scores[(scores >= low) & (scores <= high)]
    if len(scores) > k:
        some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        at, scores = at[some], scores[some]
    order = np.lexsort((at, -scores))[:k]
    return at[order], scores[order]


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with low * positive <= 100 * s <= high * positive."""
    return -(-low * positive // 100), high * positive // 100


def _tile(t: pa.Table, k: int, windows) -> pa.Table:
    """The first ``k`` of the block's rows for each anchor and window of the tile."""
    kind = t.column("kind").to_numpy()
    width = t.column("dim")[0].as_py()
    cells = t.column("cells").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(kind), width)
    row, label = t.column("row").to_numpy(), t.column("label").to_numpy()
    ids = t.column("id").fill_null(LONG).to_numpy()
    known = t.column("id").is_valid().to_numpy()
    mine = np.flatnonzero(kind == 0)
    block = Block(ids[mine], row[mine], label[mine], cells[mine])
    has_id = dict(zip(row[mine].tolist(), known[mine].tolist(), strict=True))
    out = [[] for _ in range(6)]
    for a in np.flatnonzero(kind == 1).tolist():
        of, same = windows(t, a)
        wanted = (block.labels == label[a]) if same else (block.labels != label[a])
        wanted &= block.rows != row[a]
        if not of or not wanted.any():
            continue
        found = block.walk(cells[a], wanted, [w[1:] for w in of], k)
        for (which, _, _), (at, scores) in zip(of, found, strict=True):
            for p, s in zip(at.tolist(), scores.tolist(), strict=True):
                r = int(block.rows[p])
                values = (int(row[a]), int(ids[a]), which, r, int(block.ids[p]) if has_id[r] else None, s)
                for column, v in zip(out, values, strict=True):
                    column.append(v)
    names = ["anchor", "anchor_id", "positive", "row", "id", "score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return pa.table([pa.array(c, ty) for c, ty in zip(out, types, strict=True)], names=names)


def _walks(rows: DataFrame, anchors: DataFrame, blocks: int, k: int, windows) -> DataFrame:
    """All tiles of blocks of rows and blocks of anchors; the first ``k`` of each anchor and window."""
    parts = max(1, math.ceil(anchors.count() / ANCHORS))
    spread = F.pmod(F.xxhash64("row"), F.lit(blocks))
    r = rows.withColumns({"kind": F.lit(0), "block": spread, "pos": F.lit(None).cast("array<int>"),
                          "scores": F.lit(None).cast("array<long>"),
                          "part": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))})
    a = anchors.withColumns({"kind": F.lit(1), "part": F.pmod(F.xxhash64("row"), F.lit(parts)),
                             "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))})
    both = r.unionByName(a).withColumn("dim", F.size("cells"))
    found = both.groupBy("dim", "part", "block").applyInArrow(lambda t: _tile(t, k, windows), FOUND)
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each row where ``anchor`` holds
    and each of its first ``n_positives`` other rows of its label, the first ``n_negatives`` rows of other labels with
    ``low`` to ``high`` hundredths of the positive's score. ``anchor`` and ``label`` are columns of ``vectors``."""
    bound_batches(vectors.sparkSession)
    kept = vectors.withColumns({"__anchor": F.coalesce(anchor, F.lit(False)) & F.col(id_col).isNotNull()})
    rows = usable_rows(kept, id_col, vector_col, F.struct(label.cast("long").alias("y"), F.col("__anchor").alias("a")))
    rows = rows.where("label.y IS NOT NULL").select("id", F.col("label.y").alias("label"), F.col("label.a").alias("is_anchor"),
                                                     F.when(F.size("cells") > 0, F.col("cells")).otherwise(
                                                         F.array(F.lit(0.0))).alias("cells"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()))  # written: a row keeps its number
    blocks = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    anchors = rows.where("is_anchor").drop("is_anchor")
    rows = rows.drop("is_anchor")
    none = anchors.withColumns({"pos": F.lit(None).cast("array<int>"), "scores": F.lit(None).cast("array<long>")})
    positives = stage(_walks(rows, none, blocks, n_positives, lambda t, a: ([(0, None, None)], True)))
    told = positives.groupBy("anchor").agg(F.collect_list("rank").alias("pos"), F.collect_list("score").alias("scores"))
    seeking = anchors.join(told, F.col("row") == F.col("anchor")).drop("anchor")

    def windows(t: pa.Table, a: int):
        of = zip(t.column("pos")[a].as_py(), t.column("scores")[a].as_py(), strict=True)
        of = [(p, *window(s, low, high)) for p, s in of]
        return [w for w in of if w[1] <= w[2]], False

    found = _walks(rows, seeking, blocks, n_negatives, windows)
    p = positives.select("anchor", F.col("rank").alias("positive"), F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return found.join(p, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
