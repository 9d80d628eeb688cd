"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is the bag of its words and their character n-grams (3 to 5 bytes, with word-boundary marks), each
hashed to one of ``BUCKETS`` embeddings. The average embedding times ``GAIN`` goes through a linear layer and a
softmax over two classes. Embeddings and layer learn together, by adaptive steps over mini-batches on at most
``MAX_TRAIN`` labelled rows: of each class those with the smallest hash of the id, up to half for the smaller class,
so that rare toxic rows are not thinned out (a bounded, documented sample; scoring covers every whole text). The
bias is then set back to the classes' shares in all labelled rows. A bucket enters with the square of its smoothed
log-ratio between the classes: one that a few texts hold by chance weighs little, one that only toxic texts hold
weighs more with each of them. An unseen misspelling shares most n-grams with the word it disguises.

Scoring a text needs one scalar per bucket (embedding times layer), a table of fixed size that is broadcast.

Defined results: a NULL or wordless text scores by the bias alone; rows whose label is NULL do not train; an
id labelled more than once counts by its mean label (half or more is toxic); without labelled rows
nothing counts as toxic, with one class only the model is the smoothed share of that class; scores depend on the text alone, so repeated
rows score alike; other columns pass through ``score`` untouched.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, stage
from tidewater.llm.textarrays import Words, in_pieces, mix, prefix_hash, span_hash
from tidewater.llm.tokens import give_back, text_runs

BUCKETS, DIM, GAIN = 1 << 17, 8, 20.0
SIZES = (3, 4, 5)
MAX_TRAIN, STEPS, BATCH, RATE, DECAY = 8_000, 600, 128, 0.2, 0.01
#: Blank features that each text has besides its own, so that a few words alone decide less.
BLANKS = 200
#: Texts at the classes' common share that each bucket has besides its own.
PRIOR_DOCS = 1.0
UNTAUGHT = -10.0  # log-odds when there is nothing to learn from
RUN = 1 << 18  # bytes of text whose features are in memory at once
HELD_OUT_MOD = 5


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str(doc_id).encode()) % HELD_OUT_MOD == 0


def held_out_column(c):
    return F.crc32(F.coalesce(c.cast("string"), F.lit("None")).cast("binary")) % HELD_OUT_MOD == 0


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, in runs by feature kind; and the text of each."""
    w = Words(texts)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    text_of = np.searchsorted(w.ends, w.start, "right")
    buckets, owner = [(w.hashes() >> shift).astype(np.int32)], [text_of.astype(np.int32)]
    # Marked words, strung together: <word><word>...; an n-gram must lie inside one marked word.
    size = w.end - w.start + 2
    last = np.cumsum(size)
    marked = np.zeros(int(last[-1]), np.uint8)
    marked[last - size], marked[last - 1] = 60, 62
    word_of = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(marked)) - np.repeat(last - size, size)
    inner = (place > 0) & (place < size[word_of] - 1)
    marked[inner] = w.buf[(w.start[word_of] + place - 1)[inner]]
    pre = prefix_hash(marked)
    for n in SIZES:
        at = np.flatnonzero(place + n <= size[word_of])
        buckets.append((mix(span_hash(pre, at, at + n) + np.uint64(n)) >> shift).astype(np.int32))
        owner.append(text_of[word_of[at]].astype(np.int32))
    return np.concatenate(buckets), np.concatenate(owner)


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    counts = np.zeros(BUCKETS, np.int64)
    for _, parts in in_pieces([text], RUN):
        counts += np.bincount(features(parts)[0], minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), (counts[found] / (counts.sum() + BLANKS)).astype(np.float32)


def weights(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> np.ndarray:
    """Per bucket the squared log-ratio of its texts of either class to those expected, with ``PRIOR_DOCS`` more."""
    texts = np.zeros((2, BUCKETS))
    for (b, _), y in zip(rows, labels, strict=True):
        texts[int(y), b] += 1  # the buckets of a text are distinct
    expected = texts.sum(0) * np.array([[1 - labels.mean()], [labels.mean()]])
    clean, toxic = np.log((texts + PRIOR_DOCS) / (expected + PRIOR_DOCS))
    return ((toxic - clean) ** 2).astype(np.float32)


def prior_odds(n_toxic: float, n_clean: float) -> float:
    return float(np.log((n_toxic + 0.5) / (n_clean + 0.5)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7,
          totals: tuple[int, int] | None = None) -> tuple[np.ndarray, float]:
    """Scalar per bucket and bias of the toxic class's log-odds.

    ``totals`` are the clean and toxic rows of which ``rows`` are a sample by class. Embeddings start at zero, so
    a bucket that was not trained says nothing.
    """
    n_toxic, n = float(labels.sum()), len(labels)
    prior = prior_odds(n_toxic, n - n_toxic)
    shift = prior_odds(totals[1], totals[0]) - prior if totals else 0.0
    if n_toxic in (0, n):
        return np.zeros(BUCKETS, np.float32), prior + shift
    rng = np.random.default_rng(seed)
    emb = np.zeros((BUCKETS, DIM), np.float32)
    layer = (rng.standard_normal(DIM) * 0.3).astype(np.float32)  # class 1 minus class 0
    mean, square, bias = np.zeros_like(emb), np.zeros(BUCKETS, np.float32), prior
    weight = weights(rows, labels)
    queue = np.zeros(0, np.int64)
    for step in range(1, STEPS + 1):
        if len(queue) < min(BATCH, n):
            queue = np.concatenate([queue, rng.permutation(n)])
        some, queue = queue[:BATCH], queue[BATCH:]
        idx = np.concatenate([rows[i][0] for i in some])
        share = np.concatenate([rows[i][1] for i in some]) * GAIN * weight[idx]
        who = np.repeat(np.arange(len(some)), [len(rows[i][0]) for i in some])
        pulled = emb[idx] * share[:, None]
        hidden = np.stack([np.bincount(who, pulled[:, d], len(some)) for d in range(DIM)], 1)
        err = (1 / (1 + np.exp(-np.clip(hidden @ layer + bias, -30, 30))) - labels[some]) / len(some)
        flow = np.bincount(idx, share * err[who], BUCKETS).astype(np.float32)
        grad = flow[:, None] * layer[None, :]
        mean += 0.1 * (grad - mean)
        square += 0.001 * ((grad * grad).mean(1) - square)
        emb -= RATE * (mean / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-5)[:, None] + DECAY * emb)
        layer = (layer - 0.1 * RATE * (hidden.T @ err)).astype(np.float32)
        bias -= RATE * float(err.sum())
    return (emb @ layer * weight).astype(np.float32), float(bias) + shift


def log_odds(texts: list[bytes], scalar: np.ndarray, bias: float) -> np.ndarray:
    score, total = np.zeros(len(texts)), np.full(len(texts), float(BLANKS))
    for who, parts in in_pieces(texts, RUN):
        b, t = features(parts)
        np.add.at(score, who, np.bincount(t, scalar[b], len(parts)))
        np.add.at(total, who, np.bincount(t, minlength=len(parts)))
    return bias + GAIN * score / total


def _bags(batches):
    for b in batches:
        for lo, hi, texts in text_runs(b.column(1), 1 << 20):
            got = [bag(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), pa.array([x[0] for x in got], pa.list_(pa.int32())),
                 pa.array([x[1] for x in got], pa.list_(pa.float32())), b.column(2).slice(lo, hi - lo)],
                ["y", "buckets", "shares", "place"])


def _train(batches, totals: tuple[int, int]):
    rows, labels = [], []
    for b in batches:
        for k in range(b.num_rows):
            rows.append((b.column(1)[k].values.to_numpy(), b.column(2)[k].values.to_numpy()))
        labels.append(b.column(0).to_numpy(zero_copy_only=False))
    scalar, bias = np.zeros(BUCKETS, np.float32), UNTAUGHT
    if rows:
        scalar, bias = train(rows, np.concatenate(labels).astype(np.float64), totals=totals)
    del rows
    give_back()
    yield pa.RecordBatch.from_arrays([pa.array([scalar.tobytes()], pa.binary()), pa.array([bias])], ["scalar", "bias"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Train on at most ``max_train`` labelled rows outside the held-out fold, up to half of them of the smaller
    class; the model has a fixed size."""
    y = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
         .agg((F.avg(F.col(label_col)) >= 0.5).cast("double").alias("y")).where(~held_out_column(F.col("doc_id"))))
    y = stage(y)
    n = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    totals = n.get(0.0, 0), n.get(1.0, 0)
    quota = [max(max_train - max_train // 2 if k else max_train // 2, max_train - totals[1 - k]) for k in (0, 1)]
    some = [y.where(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(quota[k]) for k in (0, 1)]
    y = some[0].unionByName(some[1])
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    bound_batches(docs.sparkSession)
    # A repeated id trains once, by its smallest text.
    sample = texts.join(F.broadcast(y), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    # Bags are made where the texts are; only they meet in the training task, in a fixed order.
    rows = sample.select("y", "text", F.xxhash64("doc_id").alias("place")).mapInArrow(
        _bags, "y double, buckets array<int>, shares array<float>, place long")
    rows = rows.repartition(1).sortWithinPartitions("place")
    model = rows.mapInArrow(lambda b: _train(b, totals), "scalar binary, bias double").first()
    if model is None:  # an empty table has no partition that could train
        return np.zeros(BUCKETS, np.float32), UNTAUGHT
    return np.frombuffer(model["scalar"], np.float32), model["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of the toxic class of each whole text in column ``out``."""
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in docs.columns if c != out]
    schema = docs.select(*columns).schema.add(out, "double")
    text_at = columns.index(text_col)

    def run(batches):
        scalar, bias = held.value
        for b in batches:
            z = [log_odds([t.encode() for t in texts], scalar, bias)
                 for _, _, texts in text_runs(b.column(text_at), 1 << 20)]
            z = np.clip(np.concatenate(z) if z else np.zeros(0), -500, 500)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-z)))], [*columns, out])

    return docs.select(*columns).mapInArrow(run, schema)


def toxic_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs.select("doc_id", "text"), fit(docs, labels))
