"""Near-duplicates by n-grams, vectors and byte strings, against brute force, with the odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import embeddings, jaccard, linkage, suffixes
from tidewater.llm.textarrays import Words, cut_at_words, in_pieces

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute_links(sets, linked):
    """(number of links, least index reachable) by comparing all pairs."""
    parent, count = list(range(len(sets))), [0] * len(sets)
    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                count[i], count[j] = count[i] + 1, count[j] + 1
                a, b = find(parent, i), find(parent, j)
                parent[max(a, b)] = min(a, b)
    return count, [find(parent, i) for i in range(len(sets))]


def grams(text, n=5):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_texts():
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", " ... ", "One two", "one TWO", "one two three", "é", "É", "x " * 4000]
    for _ in range(8):
        base = rng.choices(vocab, k=rng.choice([20, 60, 120]))
        texts.append(" ".join(base))
        for edits in (0, 1, 1, 2, 3, 5, 9, 14):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(", ".join(w) + ".")
    texts += [" ".join(rng.choices(vocab, k=50)) for _ in range(30)]
    return texts


@pytest.mark.parametrize("block_rows", [400, 3])
def test_jaccard_join_equals_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block_rows)
    texts = near_texts()
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns(
        {c: F.lit("x") for c in ("cls", "bands", "group", "node", "copies", "component")})
    sets = [grams(t) for t in texts]
    count, least = brute_links(sets, lambda a, b: bool(a & b) and 5 * len(a & b) >= 4 * len(a | b))
    got = {r.doc_id: r for r in jaccard.link(df).collect()}
    assert {k: (r.n_links, r.component_id, r.kept) for k, r in got.items()} == {
        k: (count[k], least[k], least[k] == k) for k in range(len(texts))}
    first = {}
    for k, s in enumerate(sets):
        first.setdefault(frozenset(s) or k, k)
    assert {k: r.class_id for k, r in got.items()} == {k: first[frozenset(s) or k] for k, s in enumerate(sets)}
    kept = jaccard.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least))


def test_jaccard_join_with_repeated_and_null_ids(spark):
    long = " ".join(f"a{i}" for i in range(40))
    rows = [(7, long), (7, long), (7, long + " z"), (None, long), (9, None), (9, None), (None, "b c d e f g")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_links, r.component_id, r.repeats) for r in jaccard.link(df).collect()), key=str)
    assert got == sorted([(7, 3, 7, 2), (7, 3, 7, 1), (None, 3, 7, 1), (9, 0, 9, 2), (None, 0, None, 1)], key=str)
    kept = jaccard.deduplicate(df).collect()
    assert Counter(r.doc_id for r in kept) == {7: 1, 9: 2, None: 1}
    assert jaccard.link(df.limit(0)).count() == 0 and jaccard.deduplicate(df.limit(0)).count() == 0


def test_hot_group_of_copies_is_one_class(spark):
    text = " ".join(f"a{i}" for i in range(30))
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 500, text).otherwise(
        F.concat(F.lit("u v w x "), "id")).alias("text"))
    rows = jaccard.link(df).collect()
    assert {(r.n_links, r.component_id) for r in rows if r.doc_id < 500} == {(499, 0)}


def test_rows_repeated_in_bulk_bring_their_text_once(spark, monkeypatch):
    words = [f"w{k}" for k in range(60)]
    verify = jaccard._verify

    def watched(pack, threshold, n):
        assert pack.num_rows <= 2
        return verify(pack, threshold, n)

    monkeypatch.setattr(jaccard, "_verify", watched)
    bulk = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(" ".join(words)).alias("text"))
    other = spark.createDataFrame([(1, " ".join(words[1:]))], "doc_id long, text string")
    got = jaccard.link(bulk.unionByName(other)).select("doc_id", "n_links", "component_id", "repeats").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 100_000, 1, 100_000), (1, 100_000, 1, 1)], key=str)


def test_bands_meet_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        bands = jaccard.plan_bands(threshold, 1 - 1e-6)
        assert 1 - (1 - threshold ** jaccard.ROWS) ** bands >= 1 - 1e-6
    rng = np.random.default_rng(2)
    hits = 0
    for _ in range(300):  # Jaccard similarity of exactly 0.8
        g = rng.integers(0, 1 << 63, 90).astype(np.uint64)
        a, b = np.sort(np.concatenate([g[:80], g[80:90]])), np.sort(np.concatenate([g[:80], rng.integers(0, 1 << 63, 10).astype(np.uint64)]))
        h = jaccard.band_hashes(np.concatenate([a, b]), np.array([0, 90, 180]), 35, 5)
        hits += (h[0] == h[1]).any()
    assert hits == 300


def test_sketches_keep_pairs_at_the_threshold_and_drop_weak_ones():
    need = jaccard.plan_matches(175, 0.8)
    assert sum(math.comb(175, k) * 0.8 ** k * 0.2 ** (175 - k) for k in range(need)) <= jaccard.MISS
    assert jaccard.plan_matches(175, 1.0) == 175
    rng = np.random.default_rng(6)
    agree = {}
    for shared, own in ((8, 1), (80, 10), (800, 100), (60, 30)):  # three of similarity 0.8, one of 0.5
        for _ in range(200):
            g = rng.integers(0, 1 << 63, shared + 2 * own).astype(np.uint64)
            sets = [np.sort(g[:shared + own]), np.sort(np.concatenate([g[:shared], g[shared + own:]]))]
            low = np.zeros((2, 175), np.uint8)
            jaccard.band_hashes(np.concatenate(sets), np.array([0, shared + own, 2 * (shared + own)]), 35, 5, low)
            agree.setdefault(shared, []).append(int((low[0] == low[1]).sum()))
    assert all(min(agree[k]) >= need for k in (8, 80, 800))
    assert sum(x >= need for x in agree[60]) <= 4


def test_reached_rows_are_the_components_of_agreeing_sketches():
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 40):
        sketch = rng.integers(0, 3, (n, 12)).astype(np.uint8)
        same = (sketch[:, None, :] == sketch[None, :, :]).sum(2) >= 7
        assert (jaccard.reached(sketch, 7) == linkage.roots(same)).all()


def test_chains_of_weak_candidates_do_not_grow_into_groups(spark, monkeypatch):
    """Each text shares half of its 5-grams with the next: candidates by their bands, links of nothing."""
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 20)
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghij", k=9)) for _ in range(400 * 22 + 100)]
    texts = [" ".join(words[k * 22:k * 22 + 70]) for k in range(400)]
    one, two = ({tuple(t.split()[i:i + 5]) for i in range(66)} for t in texts[:2])
    assert 0.5 <= len(one & two) / len(one | two) <= 0.51
    seen = []

    def watched(members, block_rows, pack_rows):
        seen.append(tiles(members, block_rows, pack_rows))
        return seen[-1]

    tiles = linkage.tiles
    monkeypatch.setattr(jaccard, "tiles", watched)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert jaccard.link(df).where("n_links > 0 OR component_id <> doc_id").count() == 0
    buckets, groups = seen
    assert buckets.select("node").distinct().count() > 200  # most texts share a band with a neighbour
    assert groups.count() < 40  # few go on to the full sets; a chain of all would bring 400 x 20 rows


def test_words_are_those_of_the_pattern():
    rng = random.Random(4)
    texts = ["".join(rng.choices("aZ9é -_\n中@[`{", k=rng.randrange(30))) for _ in range(200)]
    w = Words([t.encode() for t in texts])
    for k, t in enumerate(texts):
        got = [w.buf[w.start[i]:w.end[i]].tobytes().decode() for i in range(w.first[k], w.first[k + 1])]
        assert got == WORDS.findall(t.translate(LOWER))


def test_texts_are_cut_between_words():
    rng = random.Random(7)
    texts = ["".join(rng.choices("aZ9é -", k=n)).encode() for n in (0, 1, 30, 5000)] + [b"w" * 9000 + b" x", b"", b"q" * 5000]
    whole = Words(texts)
    for most in (1, 7, 100, 4096, 1 << 20):
        assert [b"".join(cut_at_words(t, most)) for t in texts] == texts
        counts, hashes = np.zeros(len(texts), int), []
        for who, parts in in_pieces(texts, most):
            w = Words(parts)
            np.add.at(counts, who, np.diff(w.first))
            hashes.append(w.hashes())
        assert counts.tolist() == np.diff(whole.first).tolist()
        assert np.concatenate(hashes).tolist() == whole.hashes().tolist()


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)]
    edges += [(5, 5), (300, 301), (301, 300)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in linkage.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200 + i: 200 for i in range(30)} | {300: 300, 301: 300}
    assert got == want
    assert linkage.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tiles_bring_each_pair_together_once(spark):
    members = spark.createDataFrame([(g, n) for g, size in ((1, 1), (2, 5), (3, 37)) for n in range(size)], "group long, node long")
    rows = linkage.tiles(members, 8, 10).collect()
    met = Counter()
    tiles = {}
    for r in rows:
        tiles.setdefault((r.group, r.lo, r.hi), []).append((r.block, r.node))
    for (g, lo, hi), t in tiles.items():
        for i, (b, n) in enumerate(t):
            for c, m in t[:i]:
                if lo == hi or b != c:
                    met[g, *sorted((n, m))] += 1
    assert met == {(g, i, j): 1 for g, size in ((2, 5), (3, 37)) for j in range(size) for i in range(j)}


@pytest.mark.parametrize("block_rows", [1000, 7])
def test_embeddings_equal_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(3)
    vectors = []
    for spread in (0.0, 0.03, 0.05, 0.06, 0.08):
        base = rng.standard_normal(32)
        vectors += [(base + spread * np.sqrt(32) * rng.standard_normal(32) / np.sqrt(32) * 5).tolist() for _ in range(40)]
    vectors += [rng.standard_normal(32).tolist() for _ in range(60)] + [rng.standard_normal(8).tolist() for _ in range(5)]
    vectors += [vectors[0], [x * 1e200 for x in vectors[0]], [x * 1e-200 for x in vectors[0]], [-x for x in vectors[0]]]
    odd = [None, [], [0.0] * 32, [None] + [1.0] * 31, [float("nan")] * 32, [float("inf")] * 32, [1.0], [2.0], [-1.0]]
    rows = list(enumerate(vectors + odd))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit(1) for c in ("cls", "vector", "node", "group", "code")})

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v) / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units = [unit(v) for _, v in rows]
    count, least = brute_links(units, lambda a, b: a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.link(df).collect()}
    assert got == {k: (count[k], least[k], least[k] == k) for k in range(len(rows))}
    assert 0 < sum(c > 0 for c in count) < len(rows)
    assert embeddings.link(df.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    errors, outside = [], 0
    for _ in range(40):
        a = rng.standard_normal((50, 64))
        u = embeddings.unit(np.concatenate([a, a + 0.45 * rng.standard_normal((50, 64))]))
        q = np.linalg.qr(rng.standard_normal((64, 64)))[0]
        sign, factor, comp = embeddings.unpack_code(embeddings.pack_code(*embeddings.codes(u @ q, rng)), 64)
        i, j = np.arange(50), np.arange(50, 100)
        exact = (u[i] * u[j]).sum(1)
        estimate = np.einsum("ij,ij->i", sign[i], comp[j]) / factor[i]
        errors += (estimate - exact).tolist()
        low, high = embeddings.bounds(sign, factor, comp, i, j)
        outside += int(((exact < low) | (exact > high)).sum())
    assert abs(np.mean(errors)) < 4 * np.std(errors) / np.sqrt(len(errors)) + 1e-3
    assert outside == 0


@pytest.mark.parametrize("dim", [2, 3, 5, 16, 64, 300])
def test_bounds_leave_every_link_open_and_spare_most_pairs(dim):
    rng = np.random.default_rng(dim)
    base = rng.standard_normal((60, dim))
    near = base + rng.uniform(0.05, 0.47, (60, 1)) * rng.standard_normal((60, dim))
    u = embeddings.unit(np.concatenate([base, near, rng.standard_normal((200, dim))]))
    code = embeddings.unpack_code(embeddings.pack_code(*embeddings.codes(u, rng)), dim)
    open_ = embeddings.upper(*code) >= 0.9
    exact = u @ u.T >= 0.9
    np.fill_diagonal(open_, False), np.fill_diagonal(exact, False)
    assert not (exact & ~open_).any() and exact.any()
    assert (embeddings.confirmed(open_, u, 0.9) == exact).all()
    i, j = np.nonzero(np.triu(open_))
    assert (embeddings.bounds(*code, i, j)[1] >= 0.9 - 1e-5).all()
    if dim >= 64:
        assert open_.sum() < 0.05 * open_.size


def brute_cut(docs, length):
    times = Counter(b[i:i + length] for _, b in docs for i in range(len(b) - length + 1))
    out = []
    for d, b in docs:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if times[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [suffixes.BUCKET_CONTEXTS, 1, 4])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    rng = random.Random(12)
    text = lambda n: "".join(rng.choices("abcdé \n", k=n))
    passages = [text(n) for n in (150, 199, 200, 201, 260, 900)]
    docs = [(None, None), (0, ""), (1, "a" * 1000), (2, "ab" * 500), (3, "a" * 199), (4, text(200)), (5, text(3000))]
    for k in range(40):
        parts = [text(rng.randrange(0, 300)) for _ in range(3)]
        docs.append((10 + k, parts[0] + rng.choice(passages) + parts[1] + rng.choice(passages) + parts[2]))
    docs += [(60, docs[-1][1]), (60, docs[-1][1]), (61, docs[-2][1][:-1]), (62, "x" + docs[6][1]), (60, "y" + passages[5])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6).withColumns(
        {c: F.lit("q") for c in ("h", "c", "d", "t", "rest", "kept", "lo")})
    want = brute_cut([(d, (t or "").encode()) for d, t in docs], 200)
    got = suffixes.cut_repeats(df, bucket_contexts=hot).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == want
    if hot == suffixes.BUCKET_CONTEXTS:
        left = suffixes.remove(df)
        assert left.columns == df.columns and left.first().h == "q"
        texts = sorted(((r.doc_id, r.text or "") for r in left.collect()), key=str)
        assert texts == sorted(((w[0], w[4].decode("utf-8", "ignore")) for w in want), key=str)
        assert suffixes.cut_repeats(df.limit(0)).count() == 0


def test_passage_in_all_texts_is_dealt_to_small_buckets(spark, monkeypatch):
    """A passage with other surroundings everywhere: every bucket that is sorted stays small, results are exact."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = {n: word(n) for n in (150, 205, 230)}
    docs = [(k, word(150) + shared[n] + word(150)) for k, n in enumerate(rng.choices(list(shared), k=240))]
    docs += [(1000 + k, word(149) + docs[0][1][150 - k:]) for k in range(20)]  # shares k more bytes before the passage
    sort = suffixes._sort_pack

    def watched(pack, length):
        h = pack.column("h").to_numpy()
        most = int(np.unique(h, return_counts=True)[1].max()) if len(h) else 0
        out = sort(pack, length)
        assert most <= 30 or bool((pack.column("n").to_numpy() == 1).all())
        return out

    monkeypatch.setattr(suffixes, "_sort_pack", watched)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = suffixes.cut_repeats(df, bucket_contexts=30).collect()
    want = brute_cut([(d, t.encode()) for d, t in docs], 200)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == want
    assert sum(w[2] > 0 for w in want) > 100


def test_rows_repeated_in_bulk_bring_their_contexts_once(spark, monkeypatch):
    rng = random.Random(8)
    base = "".join(rng.choices("abcdefgh ", k=420))
    sort = suffixes._sort_pack

    def watched(pack, length):
        assert pack.num_rows < 200 and pack.nbytes < 1 << 20
        return sort(pack, length)

    monkeypatch.setattr(suffixes, "_sort_pack", watched)
    bulk = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(base).alias("text"))
    other = spark.createDataFrame([(1, "x" + base[:300] + "y"), (2, base[100:] + "zz")], "doc_id long, text string")
    got = suffixes.cut_repeats(bulk.unionByName(other)).groupBy("doc_id", "n_removed", "n_spans", F.length("kept")).count()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, 420, 1, 0, 100_000), (1, 300, 1, 2, 1), (2, 320, 1, 2, 1)], key=str)


def test_order_by_the_difference_cover():
    rng = np.random.default_rng(5)
    assert {(a - b) % suffixes.V for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.V))
    for letters, n in ((1, 300), (2, 700), (3, 400)):
        text = rng.integers(97, 97 + letters, n).astype(np.uint8)
        text[n // 2:n // 2 + 60] = text[10:70]
        starts = np.sort(rng.choice(n - 40, n // 2, replace=False))
        times = Counter(text[s:s + 40].tobytes() for s in starts)
        assert suffixes.repeats(text, starts, 40).tolist() == [times[text[s:s + 40].tobytes()] > 1 for s in starts]
