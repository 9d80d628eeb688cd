"""Hard negatives, importance resampling and language identification, against brute force, with the odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import importance, langid, negatives

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


# ---------------------------------------------------------------- hard negatives

def brute_negatives(rows, k=5, low=80, high=100):
    """(anchor, positive, rank, negative, positive score, negative score), whole rows against whole rows in integers."""
    part = []
    for i, (key, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(256 * x) for x in vector):
            continue
        label = (label + 1) % 10 if key is not None and key % 7 == 0 else label
        part.append((i, key, [math.floor(256 * x) for x in vector], label))
    out = []
    for i, key, v, label in part:
        if key is None or key % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, r, y) for r, j, w, y in part
                  if r != i and len(w) == len(v)]
        scored.sort()
        ids = {r: j for r, j, _, _ in part}
        for p in [s for s in scored if s[4] == label][:k]:
            found = [s for s in scored if s[4] != label and low * -p[0] <= 100 * -s[0] <= high * -p[0]][:k]
            out += [(key, ids[p[3]], n, ids[s[3]], -p[0], -s[0]) for n, s in enumerate(found, 1)]
    return out


def mined(df, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(df, F.col("vec_id") % 100 == 0, label, **options)
    return Counter(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                         "negative_score").collect()))


SCHEMA = "vec_id long, embedding array<double>, label int"


def odd_vectors():
    rng = np.random.default_rng(3)
    base = rng.standard_normal((12, 6)) / 2
    rows = [(100 * k if k < 9 else 1000 + k, (base[k % 12] + rng.standard_normal(6) * 0.2).tolist(), k % 4) for k in range(150)]
    rows += [(200, [0.0] * 6, 1), (1, [0.0] * 6, 2), (None, base[0].tolist(), 1), (None, base[0].tolist(), 0)]
    rows += [(300, base[1].tolist(), 3), (300, base[1].tolist(), 3), (301, base[1].tolist(), 1), (301, base[1].tolist(), 1)]
    rows += [(400, None, 1), (500, base[2].tolist(), None), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (700, [float("nan")] * 6, 1)]
    rows += [(800, [float("inf")] + [0.0] * 5, 1), (2, [1e308] * 6, 1), (900, [1.0, 2.0], 1), (901, [1.0, 2.0], 1), (902, [1.0, 1.5], 2)]
    rows += [(1100, [], 1), (1101, [], 1), (1102, [], 2)]
    return rows


@pytest.mark.parametrize("block_rows, anchors, depth", [(8192, 512, 32), (20, 3, 1)])
def test_negatives_equal_brute_force(spark, monkeypatch, block_rows, anchors, depth):
    for name, value in (("BLOCK_ROWS", block_rows), ("ANCHORS", anchors), ("FIRST_DEPTH", depth)):
        monkeypatch.setattr(negatives, name, value)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = Counter(brute_negatives(rows))
    assert sum(want.values()) > 50
    for clash in (df, df.withColumns({c: F.lit("x") for c in ("id", "row", "block", "cells", "kind", "score", "anchor")})):
        assert mined(clash) == want
    assert mined(df.limit(0)) == Counter()


def test_negatives_with_components_beyond_doubles(spark):
    """Sums of products above 2**53 are exact integers."""
    rows = [(100, [1e6, 1.0, 2.0], 1), (1, [1e6, 2.0, 1.0], 1), (2, [1e6, 1.0, 1.0], 1), (3, [1e6, 1.5, 1.0], 2),
            (4, [999999.0, 1.0, 1.0], 2), (5, [1e6, 1.0, 1.0], 3)]
    want = Counter(brute_negatives(rows))
    assert len(want) == 5 and all(w[4] > 2 ** 53 for w in want)
    assert mined(spark.createDataFrame(rows, SCHEMA)) == want
    assert not mined(spark.createDataFrame([(k, [1e9, 1.0], y) for k, _, y in rows], SCHEMA))  # beyond a long


def test_walk_stops_before_the_lists_end():
    rng = np.random.default_rng(5)
    cells = np.floor(256 * rng.standard_normal((5000, 3)))
    cells[:20] += 2000
    block = negatives.Block(np.arange(5000), np.arange(5000), np.zeros(5000, int), cells)
    scored = []
    block.score = lambda a, at: scored.append(len(at)) or negatives.Block.score(block, a, at)
    anchor = np.array([300.0, -20.0, 250.0])
    (at, s), = block.walk(anchor, np.ones(5000, bool), [(None, None)], 5)
    want = sorted(zip((-(cells @ anchor)).tolist(), range(5000)))[:5]
    assert [(-x, p) for x, p in zip(s.tolist(), at.tolist())] == [(w, p) for w, p in want]
    assert sum(scored) < 1000


def test_ties_take_the_smaller_ids_over_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 10)
    rows = [(7_000 - k * 2 + 1 if k else 100, [1.0, 0.5], k % 2 + 1) for k in range(200)]
    rows = [(key, v, 1 if key == 100 else y) for key, v, y in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == Counter(brute_negatives(rows))


# ---------------------------------------------------------------- importance resampling

def brute_resample(docs, target, n, buckets=10_000, percent=10, min_words=20):
    def features(text):
        w = [x.encode() for x in WORDS.findall((text or "").translate(LOWER))]
        return len(w), [zlib.crc32(b" ".join(w[i:i + k])) % buckets for k in range(1, n + 1) for i in range(len(w) - k + 1)]

    made = [features(t) for _, t in docs]
    s, t = (Counter(b for _, f in x for b in f) for x in (made, [features(x) for x in target]))
    size, aim = sum(s.values()), sum(t.values())
    out = []
    for (key, _), (words, f) in zip(docs, made):
        weight = sum(math.floor(1000 * math.log(float((t[b] + 1) * (size + buckets)) / float((s[b] + 1) * (aim + buckets))))
                     for b in f)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, words, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    order = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, r in enumerate(order[:len(order) * percent // 100], 1):
        r[5] = place
    return Counter((r[0], r[2], r[3], r[4], r[5]) for r in out)


def odd_texts():
    rng = random.Random(4)
    vocab = [f"w{k}" for k in range(300)] + ["É", "ß", "日本", "a b", "Straße"]
    docs = [(k, " ".join(rng.choices(vocab, k=rng.randrange(0, 60)))) for k in range(250)]
    docs += [(300, None), (301, ""), (302, " ... "), (None, "w1 " * 30), (None, "w1 " * 30), (303, "W7 w9\tw7;w9\x01w7\x00w7")]
    docs += [(304, "w5 " * 25)] * 40 + [(305, " ".join(rng.choices(vocab, k=40_000))), (306, "x" * 300_000 + " y z"), (307, "ÿ þ \x7f" * 9)]
    return docs, ["w1 w2 w3 w4 w5 " * 20, "é ß w7", None, ""]


@pytest.mark.parametrize("n, run, cache", [(1, 1 << 20, 200_000), (1, 500, 10), (3, 1 << 20, 200_000), (3, 400, 10)])
def test_resampling_equals_brute_force(spark, monkeypatch, n, run, cache):
    monkeypatch.setattr(importance, "RUN", run)
    monkeypatch.setattr(importance, "CACHE_WORDS", cache)
    docs, target = odd_texts()
    if n > 1:
        f = importance.Features(n, 10_000)  # the module's settings hold here; workers have their own
        w, got = 0, Counter()
        for words, who, bucket in f.of([(t or "").encode() for _, t in docs]):
            w, got = w + len(words), got + Counter(zip(who.tolist(), bucket.tolist()))
        want = Counter()
        for k, (_, t) in enumerate(docs):
            x = [v.encode() for v in WORDS.findall((t or "").translate(LOWER))]
            want += Counter((k, zlib.crc32(b" ".join(x[i:i + g])) % 10_000) for g in range(1, n + 1) for i in range(len(x) - g + 1))
        assert got == want and w == sum(len(WORDS.findall(t or "")) for _, t in docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns(
        {c: F.lit("x") for c in ("bucket", "row", "score", "rank", "n_words", "drawable", "before")})
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(df, aim, n)
    got = Counter(map(tuple, got.select("doc_id", "n_features", "weight", "score", "rank").collect()))
    assert got == brute_resample(docs, target, n)


def test_ranks_over_many_buckets_and_repeated_rows(spark):
    rows = [(k % 50, 7 if k % 3 else k % 11, k % 5 > 0) for k in range(2000)] + [(None, 7, True)] * 100
    df = spark.createDataFrame(rows, "doc_id long, score long, ok boolean")
    got = importance.draw(df, F.col("ok"), 50, bucket_rows=37).collect()
    some = sorted((r for r in rows if r[2]), key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, len(some) // 2 + 1))
    assert [(r.doc_id, r.score) for r in drawn] == [r[:2] for r in some[:len(some) // 2]]
    assert len(got) == len(rows)


def test_resampling_of_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string"), spark.createDataFrame([], "text string")
    assert importance.resample(docs.limit(0), docs).count() == 0
    r = importance.resample(docs, none, percent=100).first()
    assert (r.n_features, r["rank"]) == (30, 1)


# ---------------------------------------------------------------- language identification

def spoken(n, seed=1):
    """Texts of three made languages; the third is rare."""
    rng = random.Random(seed)
    sounds = {"aa": ["ka", "to", "mi", "ra", "so"], "bb": ["sch", "ein", "ung", "der", "ß"], "cc": ["ωρ", "αλ", "ικ", "ου"]}
    out = []
    for k in range(n):
        lang = "cc" if k % 20 == 0 else ("aa" if k % 3 else "bb")
        words = ["".join(rng.choices(sounds[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 40))]
        out.append((k, " ".join(words), lang))
    return out


@pytest.fixture(scope="module")
def tongue(spark):
    rows = spoken(1500)
    df = spark.createDataFrame(rows + [(2000, None, "aa"), (2001, "kato", None), (2002, "...", "bb"), (None, "miraso kato", "aa")],
                               "doc_id long, text string, lang string")
    return rows, df, langid.fit(df, ~langid.held_out_column(F.col("doc_id")))


def test_held_out_languages(spark, tongue):
    rows, df, model = tongue
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    held = [got[k].lang_pred == lang for k, _, lang in rows if langid.held_out(k)]
    assert len(held) > 200 and np.mean(held) > 0.98
    rare = [got[k].lang_pred == lang for k, _, lang in rows if langid.held_out(k) and lang == "cc"]
    assert len(rare) >= 5 and np.mean(rare) > 0.9
    assert model.languages == ("aa", "bb", "cc") and langid.held_out(7) == (zlib.crc32(b"7") % 5 == 0)


def test_labels_of_the_held_out_fold_are_not_used(spark, tongue):
    _, df, model = tongue
    held = langid.held_out_column(F.col("doc_id"))
    other = langid.fit(df.withColumn("lang", F.when(held, F.lit("zz")).otherwise(F.col("lang"))), ~held)
    assert other.languages == model.languages
    assert np.array_equal(other.emb, model.emb) and np.array_equal(other.bias, model.bias)


def test_calibration_and_rejection():
    rng = np.random.default_rng(6)
    y = rng.integers(0, 3, 6000)
    z = rng.standard_normal((6000, 3)) + 2.0 * np.eye(3)[y]
    t, least = langid.calibrate(5 * z, y, 0.95)  # too sure by a factor
    p = langid.softmax(5 * z / t)
    best, right = p.max(1), p.argmax(1) == y
    for lo in (0.4, 0.6, 0.8):
        some = (best >= lo) & (best < lo + 0.2)
        assert abs(best[some].mean() - right[some].mean()) < 0.05
    assert right[best >= least].mean() >= 0.95 and 0.1 < (best >= least).mean() < 0.95
    assert langid.calibrate(50 * np.eye(3)[y], y, 0.95)[1] == 0.0


def test_odd_texts_and_empty_tables(spark, tongue):
    _, df, model = tongue
    texts = [None, "", "123 ... !", "É", "kato " * 100_000, "kato " * 100_000, "日本", "K"]
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = langid.predict(odd, model).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.score, r.accepted) for r in got[:3]] == [("und", 0.0, False)] * 3
    assert all(r.lang_pred in model.languages and 0 < r.score <= 1 for r in got[3:])
    assert got[4].score == got[5].score and got[4].lang_pred == "aa"
    assert langid.predict(odd.limit(0), model).count() == 0
    none = langid.fit(df, F.lit(False))
    assert {r.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}
    one = langid.fit(df, F.col("lang") == "aa")
    assert {r.lang_pred for r in langid.predict(odd, one).collect()} == {"und", "aa"}


def test_batches_and_pieces_do_not_change_a_score(monkeypatch):
    rng = np.random.default_rng(2)
    model = langid.Model(rng.standard_normal((langid.BUCKETS, 8)).astype(np.float32), np.eye(8, dtype=np.float32)[:, :3],
                         np.zeros(3), ("a", "b", "c"), 0.5)
    texts = [t.encode() for _, t, _ in spoken(40)] + [b"", b"..", b"abc"]
    alone = np.concatenate([langid.scores([t], model) for t in texts])
    assert np.allclose(langid.scores(texts, model), alone, atol=1e-5)
    monkeypatch.setattr(langid, "RUN", 30)
    assert np.allclose(langid.scores(texts, model), alone, atol=1e-5)
    by_hand = Counter()
    for word in re.findall(r"[a-z]+", "Kato, miß".lower().replace("ß", " ")):
        by_hand.update(len((" " + word + " ")[i:i + n]) for n in langid.SIZES for i in range(len(word) + 3 - n))
    assert sum(len(b) for b, _ in langid.ngrams([b"Kato, mi"])) == sum(by_hand.values())
