"""Links between many rows: connected components, and tiles that compare a group's rows in bounded blocks."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for all nodes of ``edges`` (``a``, ``b``).

    Alternating large-star and small-star steps: each is a partial aggregate and a join, the edge set never
    grows, and the number of rounds is about the logarithm of the longest chain. An edge keeps its larger end as
    key of the aggregates, so a hub's edges meet only in the large-star's join, whose other side is written before: its
    hot partition can be split. Each round is written to the shared checkpoint folder; nothing is gathered on the driver
    but a count and a checksum.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = stage(e.distinct())
    before = None
    while True:
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == before or not seen[0]:
            break
        before = tuple(seen)
        least = stage(e.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m")))
        large = e.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stage(small.union(least.select("a", F.col("m").alias("b"))).distinct())
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))


def tiles(members: DataFrame, block_rows: int, pack_rows: int) -> DataFrame:
    """Deal ``members`` (``group``, ``node``) to tiles, so that each pair of a group's nodes meets in one tile.

    A group of up to ``block_rows`` rows is one tile. A larger one is cut into blocks by the node's hash, and
    each pair of blocks (``lo`` <= ``hi``) is a tile; nodes in ``block`` lo meet those in hi. Small groups
    share a ``pack`` of about ``pack_rows`` rows, which is the unit of work. Groups of one node are left out.
    """
    # Written, so that a hot group's partition of the join with the members can be split.
    sizes = stage(members.groupBy("group").agg(F.count("*").alias("n")).where("n > 1"))
    packs = max(1, math.ceil((sizes.agg(F.sum("n")).first()[0] or 0) / pack_rows))
    m = members.join(sizes, "group").withColumn("blocks", F.ceil(F.col("n") / block_rows))
    m = m.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    m = m.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    pack = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("group"), F.lit(packs))).otherwise(
        F.xxhash64("group", "lo", "hi"))
    return m.withColumn("pack", pack).drop("n", "blocks", "other")


def spans(*keys: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Order that sorts by the keys, and the runs of equal keys in it."""
    order = np.lexsort(keys[::-1])
    if not len(order):
        return order, []
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    at = np.flatnonzero(new)
    return order, list(zip(at.tolist(), [*at[1:].tolist(), len(order)], strict=True))


def roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links: the least index that each index reaches."""
    n = len(linked)
    lab = np.arange(n)
    while True:
        new = np.minimum(lab, np.where(linked, lab[None, :], n).min(1))
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def across(linked: np.ndarray, block: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Links that the tile (lo, hi) answers for: between different rows, and of different blocks unless lo = hi."""
    np.fill_diagonal(linked, False)
    if lo != hi:
        linked &= block[:, None] != block[None, :]
    return linked
