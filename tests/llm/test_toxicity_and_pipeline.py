"""The classifier on held-out rows, and the pipeline stage by stage."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_similarity_operators import brute_cut, brute_links, grams
from test_text_operators import brute_marks
from tidewater.llm import bpe, toxicity
from tidewater.llm.queries import RULES, Q, vocabulary

SF = "/root/testdata/sf0.001"
BAD, GOOD = ["vile", "scumbag", "idiot", "worthless"], [f"plain{i}" for i in range(80)]


def made(n, seed=2):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        toxic = int(rng.random() < 0.3)
        words = rng.choices(GOOD, k=rng.randrange(20, 120))
        for _ in range((2 + len(words) // 30) * toxic):
            words[rng.randrange(len(words))] = rng.choice(BAD)
        out.append((k, " ".join(words), toxic))
    return out


@pytest.fixture(scope="module")
def model(spark):
    rows = made(900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (0, None)], "doc_id long, toxic int")
    return rows, docs, toxicity.fit(docs, labels)


def test_held_out_accuracy_and_misspellings(spark, model):
    rows, docs, fitted = model
    got = {r.doc_id: r.score for r in toxicity.score(docs, fitted).collect()}
    held = [(got[k] >= 0.5) == bool(y) for k, _, y in rows if toxicity.held_out(k)]
    assert len(held) > 100 and np.mean(held) > 0.95
    assert toxicity.held_out(7) == (zlib.crc32(b"7") % 5 == 0)
    texts = [" ".join(GOOD[:40]), " ".join(GOOD[:36] + ["idiots", "scumbagg", "worthlesss", "viile"])]
    low, high = toxicity.log_odds([t.encode() for t in texts], *fitted)
    assert high > low + 1


def slurred(n, n_toxic, slurs, seed):
    """Texts of which the first ``n_toxic`` hold two slurs each, and every text three words of its own."""
    rng = random.Random(seed)
    good = [f"{a}{b}{c}" for a in ("bar", "sel", "ton", "mir") for b in ("ga", "lo", "ni", "ve") for c in ("den", "rus", "p")]
    out = []
    for k in range(n):
        words = rng.choices(good, k=rng.randrange(10, 30))
        for p in rng.sample(range(len(words)), 3):
            words[p] = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
        if k < n_toxic:
            for p in rng.sample(range(len(words)), 2):
                words[p] = rng.choice(slurs)
        out.append(" ".join(words).encode())
    return out


@pytest.mark.parametrize("n, n_toxic", [(800, 12), (3000, 30), (3000, 300)])
def test_recall_of_slurs_that_few_texts_hold(n, n_toxic):
    slurs = ["zwoxkrat", "quibfoj", "hjupsny", "vyxgolm"] if n_toxic < 100 else [f"zw{a}x{b}k" for a in "aeiouy" for b in "qjvfhgwcm"]
    assert n_toxic * 2 / len(slurs) < 20  # fewer texts than the floor that there once was
    labels = np.repeat([1.0, 0.0], [n_toxic, n - n_toxic])
    model = toxicity.train([toxicity.bag(t) for t in slurred(n, n_toxic, slurs, 1)], labels)
    toxic, clean = (toxicity.log_odds(slurred(300, k, slurs, 2), *model) for k in (300, 0))
    assert (toxic > np.quantile(clean, 0.99)).mean() > 0.9
    assert (toxic >= 0).mean() > 0.6 and (clean >= 0).mean() < 0.02


def test_sample_keeps_rare_toxic_rows_and_the_share_of_all_labels(spark):
    rows = [(k, t.decode()) for k, t in enumerate(slurred(4000, 80, ["zwoxkrat"], 4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < 80).cast("int").alias("toxic"))
    scalar, bias = toxicity.fit(docs, labels, max_train=200)  # by hash alone about 4 of the 64 toxic rows outside the fold
    toxic, clean = (toxicity.log_odds(slurred(300, k, ["zwoxkrat"], 5), scalar, bias) for k in (300, 0))
    assert (toxic >= 0).mean() > 0.9 and (clean >= 0).mean() < 0.01


def test_scores_of_odd_rows(spark, model):
    df = spark.createDataFrame([(None, None), (1, ""), (1, "!!"), (2, "idiot " * 20_000), (2, "idiot " * 20_000)],
                               "doc_id long, text string").withColumn("score", F.lit("clash"))
    rows = toxicity.score(df, model[2]).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    by = sorted(r.score for r in rows if not (r.text or "").strip("!"))
    assert by[0] == by[1] and rows[-1].score == rows[-2].score > 0.5
    assert toxicity.score(df.limit(0), model[2]).count() == 0


def test_training_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, none)).first().score < 0.01
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.fit(docs, one)).first().score < 0.5


def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    out = docs
    for name, f in corpus_pipeline.STAGES:
        before = out
        out = corpus_pipeline.stage(f(spark, before, SF))
        rows, kept = before.orderBy("doc_id").collect(), {r.doc_id: r for r in out.collect()}
        texts = [r.text for r in rows]
        if name != "byte_bpe":
            assert out.schema == docs.schema
        if name == "toxicity":
            assert 0 < len(rows) - len(kept) < len(rows) / 3
            assert all(kept[r.doc_id] == r for r in rows if r.doc_id in kept)
        elif name == "jaccard_join":
            _, least = brute_links([grams(t) for t in texts],
                                   lambda a, b: bool(a & b) and 5 * len(a & b) >= 4 * len(a | b))
            assert set(kept) == {rows[i].doc_id for i in least}
        elif name == "suffix_array_dedup":
            want = brute_cut([(r.doc_id, (r.text or "").encode()) for r in rows], 200)
            assert {w[0]: w[4].decode("utf-8", "ignore") for w in want} == {k: r.text or "" for k, r in kept.items()}
            assert all(r.n_chars == len(r.text) for r in kept.values() if r.text is not None)
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            marks = brute_marks([(r.doc_id, r.text) for r in rows], items)
            assert set(kept) == {m[0] for m in marks if not m[2]}
        else:
            enc = bpe.encoding(vocabulary("byte_bpe_multi_50k.tiktoken"))
            assert {k: r.n_tokens for k, r in kept.items()} == {
                r.doc_id: len(enc.encode_ordinary(r.text or "")) for r in rows}


def test_run_keeps_only_the_tables_that_its_result_reads(spark):
    from tidewater import session
    with session.staged_tables() as own:
        out = corpus_pipeline.run(spark, SF)
        fs = spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        there = [fs.Path(p).getFileSystem(conf).exists(fs.Path(p)) for p in own]
    ids = {r.doc_id for r in out.select("doc_id").collect()}
    assert ids and len(ids) < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert there.count(True) <= 2 and there.count(False) > 10


def test_every_operator_is_registered_once():
    assert sorted(int(k[2:].split("_")[0]) for k in Q) == list(range(1, 14))
    assert len(RULES) == 5
