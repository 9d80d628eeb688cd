"""Language identification: averaged hashed subword embeddings with a linear softmax, and a calibrated rejection.

A text is the bag of the n-grams (2 to 4 bytes, with word-boundary marks) of its words, which are maximal runs of
letters A-Z, lower-cased, and of bytes of other characters; each is hashed to one of ``BUCKETS`` embeddings. The average
embedding goes through a linear layer and a softmax over the languages. Embeddings and layer are trained jointly by
stochastic gradient descent in numpy (mini-batches, one falling rate) on a bounded sample: of each language the rows
with the smallest remainder of a hash, about ``MAX_TRAIN`` in all, shared evenly, so that a rare language is not
crowded out; the biases are then set back to the languages' shares of all rows that may be learned from. One in
``CALIBRATION`` rows of the sample does not train: there a temperature is fitted, so that a score is the probability
that the prediction is right, and the least score is found above which predictions are right in ``PRECISION`` of
cases; a prediction below it is not ``accepted``. Every whole text is scored, with a table of fixed size.

Defined results: a NULL text or one without any letter is ``und`` with score 0 and not accepted; digits and
punctuation say nothing; rows whose language or text is NULL, or of the held-out fold, do not train; equal rows train
once; without rows to learn from everything is ``und``, with one language everything that has a letter is that
language; predictions depend on the text alone, so repeated rows are alike; NULL ids take part; an empty table gives
no rows; other columns pass through ``predict`` untouched.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import bound_batches, stage
from tidewater.llm.textarrays import in_pieces
from tidewater.llm.tokens import give_back, text_runs

UNKNOWN = "und"
BUCKETS, DIM, SIZES = 1 << 16, 8, (2, 3, 4)
MAX_TRAIN, MAX_LANGUAGES = 6_000, 1_000
EPOCHS, BATCH, RATE, GAIN = 5, 32, 0.3, 8.0
CALIBRATION, PRECISION = 5, 0.99
RUN = 1 << 18  # bytes of text whose features are in memory at once
HELD_OUT_MOD = 5
LETTER = regex.compile(r"\p{L}")

#: Bytes of words, A-Z lower-cased, else 0.
WORD_BYTE = np.zeros(256, np.uint8)
WORD_BYTE[97:123] = WORD_BYTE[65:91] = np.arange(97, 123)
WORD_BYTE[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Model:
    """Fixed-size model: embeddings, layer and biases (scaled by the temperature), languages and the least score."""
    emb: np.ndarray
    layer: np.ndarray
    bias: np.ndarray
    languages: tuple[str, ...]
    least: float


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(str(doc_id).encode()) % HELD_OUT_MOD == 0


def held_out_column(c: Column) -> Column:
    return F.crc32(F.coalesce(c.cast("string"), F.lit("None")).cast("binary")) % HELD_OUT_MOD == 0


def ngrams(texts: list[bytes]):
    """For each size: buckets of the n-grams of all texts, in order, and the place of each text's first (and the end)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    marked = np.concatenate([WORD_BYTE[np.frombuffer(b" " + b" ".join(texts) + b"   ", np.uint8)]]).astype(np.uint32)
    start = np.concatenate([[0], np.cumsum(size + 1)])  # a text owns the mark before it
    mark = marked == 0
    key, end = marked, int(start[-1])
    for n in SIZES:
        key = key[:-1] | marked[n - 1:] << np.uint32(8 * (n - 1))
        # An n-gram lies in one word, but its first and last byte may be the marks on either side.
        good = ~(mark[:end] & mark[1:end + 1])
        for k in range(1, n - 1):
            good &= ~mark[k:end + k]
        at = np.flatnonzero(good)
        hashed = (key[at] + np.uint32(n)) * np.uint32(0x9E3779B1)
        hashed = (hashed ^ hashed >> np.uint32(15)) * np.uint32(0x85EBCA77)
        yield (hashed >> np.uint32(33 - BUCKETS.bit_length())).astype(np.int64), np.searchsorted(at, start)


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their shares."""
    counts = np.zeros(BUCKETS, np.int64)
    for _, parts in in_pieces([text], RUN):
        for buckets, _ in ngrams(parts):
            counts += np.bincount(buckets, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found.astype(np.int32), (counts[found] / max(1, counts.sum())).astype(np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def averages(rows: list[tuple[np.ndarray, np.ndarray]], emb: np.ndarray):
    """Average embeddings of bags, with the flat buckets, shares and the bag of each."""
    at = np.concatenate([r[0] for r in rows])
    share = np.concatenate([r[1] for r in rows])
    who = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    pulled = emb[at] * share[:, None]
    hidden = np.stack([np.bincount(who, pulled[:, d], len(rows)) for d in range(emb.shape[1])], 1) * GAIN
    return hidden, at, share, who


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n_classes: int, seed: int = 13):
    """Embeddings, layer and biases by stochastic gradient descent on the softmax's log-loss."""
    rng = np.random.default_rng(seed)
    emb = (rng.standard_normal((BUCKETS, DIM)) * 0.05).astype(np.float32)
    layer = (rng.standard_normal((DIM, n_classes)) / np.sqrt(DIM)).astype(np.float32)
    bias = np.zeros(n_classes)
    steps = EPOCHS * -(-len(rows) // BATCH)
    queue = np.zeros(0, np.int64)
    for step in range(steps):
        if not len(queue):
            queue = rng.permutation(len(rows))
        some, queue = queue[:BATCH], queue[BATCH:]
        rate = RATE * (1 - step / steps)
        hidden, at, share, who = averages([rows[k] for k in some], emb)
        err = softmax(hidden @ layer + bias)
        err[np.arange(len(some)), y[some]] -= 1
        back = (err @ layer.T).astype(np.float32) * (GAIN * rate)
        for d in range(DIM):
            emb[:, d] -= np.bincount(at, share * back[who, d], BUCKETS).astype(np.float32)
        layer -= (rate / len(some) * (hidden.T @ err)).astype(np.float32)
        bias -= rate / len(some) * err.sum(0)
    return emb, layer, bias


def calibrate(z: np.ndarray, y: np.ndarray, precision: float) -> tuple[float, float]:
    """(temperature, least score): log-loss is least at the temperature; predictions of the least score or more are
    right in ``precision`` of cases (all are accepted if they are right that often)."""
    grid = np.exp(np.linspace(np.log(0.2), np.log(20), 60))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-300)).sum() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    p = softmax(z / t)
    best, right = p.max(1), p.argmax(1) == y
    order = np.argsort(-best, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(y) + 1)
    enough = np.flatnonzero(share >= precision)
    if len(enough) and enough[-1] == len(y) - 1:
        return t, 0.0
    return t, float(best[order[enough[-1]]]) if len(enough) else 1.0


def fit_bags(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, shares: np.ndarray, precision: float):
    """Model arrays of a sample: every ``CALIBRATION``-th row calibrates, the others train. ``shares`` are those of all rows."""
    n_classes = len(shares)
    aside = np.arange(len(rows)) % CALIBRATION == CALIBRATION - 1
    if n_classes < 2 or not aside.any():
        aside[:] = False
    emb, layer, bias = train([r for r, a in zip(rows, aside, strict=True) if not a], y[~aside], n_classes)
    seen = np.bincount(y[~aside], minlength=n_classes) + 0.5
    bias = bias + np.log(shares / shares.sum()) - np.log(seen / seen.sum())
    t, least = 1.0, 0.0
    if aside.any():
        z = averages([r for r, a in zip(rows, aside, strict=True) if a], emb)[0] @ layer + bias
        t, least = calibrate(z, y[aside], precision)
    return emb, (layer / t).astype(np.float32), bias / t, least


def _bags(batches):
    for b in batches:
        for lo, hi, texts in text_runs(b.column(1), 1 << 20):
            got = [bag(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo),
                 pa.array([x[0] for x in got], pa.list_(pa.int32())),
                 pa.array([x[1] for x in got], pa.list_(pa.float32()))], ["y", "key", "buckets", "shares"])


def _train(batches, shares: list[float], precision: float):
    rows, y, keys = [], [], []
    for b in batches:
        for k in range(b.num_rows):
            rows.append((b.column(2)[k].values.to_numpy(), b.column(3)[k].values.to_numpy()))
        y.append(b.column(0).to_numpy()), keys.append(b.column(1).to_numpy())
    if rows:
        order = np.argsort(np.concatenate(keys), kind="stable")  # the same order however the rows came
        made = fit_bags([rows[k] for k in order], np.concatenate(y)[order], np.array(shares), precision)
        del rows
        give_back()
        yield pa.RecordBatch.from_arrays([*[pa.array([m.tobytes()], pa.binary()) for m in made[:3]], pa.array([made[3]])],
                                         ["emb", "layer", "bias", "least"])


def fit(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_train: int = MAX_TRAIN, precision: float = PRECISION) -> Model:
    """Learn from the rows where ``learnable`` holds, of which about ``max_train`` are read whole."""
    bound_batches(docs.sparkSession)
    d = docs.where(learnable & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    d = d.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
                 F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"))
    sizes = stage(d.select("lang", "key").distinct().groupBy("lang").agg(F.count("*").alias("n")))
    n_lang = sizes.count()
    if n_lang > MAX_LANGUAGES:
        raise ValueError(f"{n_lang} different values of {lang_col}; a model holds at most {MAX_LANGUAGES}")
    sizes = sorted((r["lang"], r["n"]) for r in sizes.collect())
    languages = tuple(lang for lang, _ in sizes)
    if not sizes:
        return Model(np.zeros((1, 1), np.float32), np.zeros((1, 0), np.float32), np.zeros(0), (), 0.0)
    quota = max(1, max_train // n_lang)
    # A table of at most MAX_LANGUAGES rows: of each language one in n / quota keys, about quota rows.
    told = docs.sparkSession.createDataFrame([(lang, k, n) for k, (lang, n) in enumerate(sizes)], "lang string, y int, n long")
    some = d.join(F.broadcast(told), "lang").where(F.pmod(F.xxhash64("key"), F.col("n")) < quota)
    some = some.groupBy("y", "key").agg(F.first("text").alias("text"))  # copies train once
    bags = some.select("y", "text", "key").mapInArrow(_bags, "y int, key long, buckets array<int>, shares array<float>")
    made = bags.repartition(1).mapInArrow(lambda b: _train(b, [n for _, n in sizes], precision),
                                          "emb binary, layer binary, bias binary, least double").first()
    return Model(np.frombuffer(made["emb"], np.float32).reshape(BUCKETS, DIM),
                 np.frombuffer(made["layer"], np.float32).reshape(DIM, -1), np.frombuffer(made["bias"], np.float64),
                 languages, made["least"])


def scores(texts: list[bytes], model: Model) -> np.ndarray:
    """Probability of each language for each whole text."""
    total, n = np.zeros((len(texts), model.emb.shape[1])), np.zeros(len(texts), np.int64)
    for who, parts in in_pieces(texts, RUN):
        for buckets, first in ngrams(parts):
            some = np.flatnonzero(np.diff(first))
            if len(some):
                np.add.at(total, who[some], np.add.reduceat(model.emb[buckets], first[some], 0))
                np.add.at(n, who[some], np.diff(first)[some])
    return softmax(GAIN * total / np.maximum(n, 1)[:, None] @ model.layer + model.bias)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted`` of each whole text."""
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    made = ["lang_pred", "score", "accepted"]
    columns = [c for c in docs.columns if c not in made]
    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    text_at = columns.index(text_col)

    def run(batches):
        m = held.value
        for b in batches:
            out = []
            for _, _, texts in text_runs(b.column(text_at), RUN):
                p = scores([t.encode() for t in texts], m) if m.languages else np.zeros((len(texts), 1))
                best, most = p.argmax(1).tolist(), p.max(1).tolist()
                out += [(m.languages[k], x, x >= m.least) if m.languages and LETTER.search(t) else (UNKNOWN, 0.0, False)
                        for t, k, x in zip(texts, best, most, strict=True)]
            types = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array([r[k] for r in out], ty) for k, ty in enumerate(types)]], [*columns, *made])

    return docs.select(*columns).mapInArrow(run, schema)


def languages(docs: DataFrame) -> DataFrame:
    """``documents`` with predictions of a model learned from the rows outside the held-out fold."""
    model = fit(docs, ~held_out_column(F.col("doc_id")))
    return predict(docs.select("doc_id", "text"), model)
