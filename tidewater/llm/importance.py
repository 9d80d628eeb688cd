"""Target-distribution importance resampling: hashed n-gram weights and a seeded Gumbel draw without replacement.

Features are all runs of 1 to ``n`` consecutive words, joined by one space, repeats counted; the bucket of a feature is
the CRC-32 of its UTF-8 bytes modulo ``buckets``. A batch's texts are joined with a separator byte that no UTF-8 text
holds; one pass of one pattern finds all words and separators, a sorted search among the separators names each
word's document, and runs of words of two documents are masked before anything is counted. Corpus and target are
counted over all rows: each partition sends its counts once, so ``buckets`` numbers a partition are shuffled. A
document's weight is the sum of its features' gains; weight plus a Gumbel number drawn from a hash of the id is its
score, and the highest scores are the sample. Ranks come from range-partitioned buckets of written rows, so no task
sees more than a bucket.

Defined results: a NULL, empty or wordless text has no features and weight 0; a NULL id draws as the empty string and
goes after the others of its score; rows that repeat an id draw alike and are ranked one after the other; an empty
target or corpus counts 0 in each bucket; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import LOWER, UPPER, bound_batches, stage
from tidewater.llm.textarrays import in_pieces
from tidewater.llm.tokens import text_runs

SEPARATOR = b"\xff"
TOKEN = re.compile(rb"[0-9a-z\x80-\xfe]+|\xff")
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
CACHE_WORDS = 200_000  # words whose codes a worker keeps; emptied when full, results do not depend on it
RUN = 1 << 20  # bytes of text whose words are in memory at once
BUCKET_ROWS = 100_000


class Features:
    """Buckets of the features of many texts."""

    def __init__(self, n: int, buckets: int):
        self.n, self.buckets = n, buckets
        self._empty()

    def _empty(self) -> None:
        self.index, self.words, self.crc = {SEPARATOR: 0}, [SEPARATOR], np.zeros(1, np.uint32)

    def _codes(self, found: list[bytes]) -> np.ndarray:
        """A code for each word, 0 for separators."""
        if len(self.index) > CACHE_WORDS:
            self._empty()
        new = list(set(found).difference(self.index))
        if new:
            self.index.update(zip(new, range(len(self.words), len(self.words) + len(new)), strict=True))
            self.words += new
            self.crc = np.concatenate([self.crc, np.fromiter(map(zlib.crc32, new), np.uint32, len(new))])
        return np.fromiter(map(self.index.__getitem__, found), np.int64, len(found))

    def _longer(self, crc: np.ndarray, code: np.ndarray) -> np.ndarray:
        """CRC-32 of each run with one more word after it; equal pairs are computed once."""
        pairs, back = np.unique(crc.astype(np.uint64) << np.uint64(32) | code.astype(np.uint64), return_inverse=True)
        made = [zlib.crc32(b" " + self.words[int(p) & 0xFFFFFFFF], int(p) >> 32) for p in pairs]
        return np.array(made, np.uint32)[back]

    def of(self, texts: list[bytes]):
        """Runs of (text of each word, text of each feature, bucket of each feature)."""
        tail, tail_of = [], -1  # the last words of a text that goes on in the next run
        for who, parts in in_pieces(texts, RUN):
            tail = tail if who[0] == tail_of else []
            code = self._codes(tail + TOKEN.findall(SEPARATOR.join(parts).translate(LOWERED)))
            at, ends = np.flatnonzero(code), np.flatnonzero(code == 0)
            owner, code = who[np.searchsorted(ends, at)], code[at]
            first, crc, features, hashes = np.arange(len(at)), self.crc[code], [], []
            for k in range(1, self.n + 1):
                if k > 1:
                    first, crc = first[first + k <= len(at)], crc[first + k <= len(at)]
                    inside = owner[first] == owner[first + k - 1]
                    first, crc = first[inside], crc[inside]
                    crc = self._longer(crc, code[first + k - 1])
                new = first + k > len(tail)
                features.append(owner[first[new]]), hashes.append(crc[new])
            yield owner[len(tail):], np.concatenate(features), np.concatenate(hashes) % self.buckets
            last = code[owner == owner[-1]] if len(owner) else code
            tail = [self.words[c] for c in last[len(last) - min(self.n - 1, len(last)):]] if self.n > 1 else []
            tail_of = owner[-1] if len(owner) else -1


def _count(batches, n: int, buckets: int):
    features, counts = Features(n, buckets), np.zeros(buckets, np.int64)
    for b in batches:
        for _, _, texts in text_runs(b.column(0), RUN):
            for _, _, bucket in features.of([t.encode() for t in texts]):
                counts += np.bincount(bucket, minlength=buckets)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text_col: str = "text", n: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features in each bucket over all rows; one number a bucket reaches the driver."""
    bound_batches(texts.sparkSession)
    made = texts.select(F.col(text_col).alias("text")).mapInArrow(lambda b: _count(b, n, buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in made.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket 1000 times the smoothed log-ratio of the target's share to the corpus's, rounded down."""
    s, t, size = corpus.astype(np.float64), target.astype(np.float64), len(corpus)
    up, down = (t + 1) * (s.sum() + size), (s + 1) * (t.sum() + size)
    return np.array([math.floor(1000 * math.log(x)) for x in (up / down).tolist()], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", n: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row's whole text."""
    bound_batches(docs.sparkSession)
    names = ["doc_id", "n_words", "n_features", "weight"]

    def run(batches):
        features = Features(n, len(gain))
        for b in batches:
            for lo, hi, texts in text_runs(b.column(1), RUN):
                words, count, weight = (np.zeros(hi - lo, np.int64) for _ in range(3))
                for word_of, feature_of, bucket in features.of([t.encode() for t in texts]):
                    words += np.bincount(word_of, minlength=hi - lo)
                    count += np.bincount(feature_of, minlength=hi - lo)
                    weight += np.bincount(feature_of, gain[bucket], hi - lo).astype(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *map(pa.array, (words, count, weight))],
                                                 names)

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(id_col: str, seed: str) -> Column:
    """A standard Gumbel number of the id, times 1000, rounded down."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def draw(scored: DataFrame, eligible: Column, percent: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows of ``scored`` (``doc_id``, ``score``) with ``rank``: 1, 2, 3 ... for the drawn, else NULL.

    Rows get a number when they are written, so that many rows of one id and score still spread over the buckets.
    """
    rows = stage(scored.withColumns({"drawable": F.coalesce(eligible, F.lit(False)), "row": F.monotonically_increasing_id()}))
    some = rows.where("drawable")
    n = some.count()
    m = n * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    cut = some.repartitionByRange(max(1, math.ceil(n / bucket_rows)), *order)
    cut = stage(cut.withColumn("bucket", F.spark_partition_id()))
    # One row a bucket: a sum over all buckets before each.
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    totals = cut.groupBy("bucket").agg(F.count("*").alias("n")).select("bucket", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(*order)) + F.col("before")
    ranked = cut.join(totals, "bucket").withColumn("rank", place.cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= m, F.col("rank")))
    rest = rows.where("NOT drawable").withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest).drop("drawable", "row")


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20,
             seed: str = "2024", id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row; of those with ``min_words`` words or more,
    ``percent`` of a hundred are drawn (rounded down) by the target's likeness."""
    gain = gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_col, n, buckets))
    scored = weigh(docs, gain, id_col, text_col, n).withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    return draw(scored, F.col("n_words") >= min_words, percent)
