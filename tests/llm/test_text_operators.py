"""Decontamination, URL filters and chat formatting against plain Python, with the odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewater.llm import chat, decontam, urls

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute_marks(docs, items, n=10):
    grams = {}
    for item, text in items:
        ws = words(text)
        k = min(n, len(ws))
        for i in range(len(ws) - k + 1 if ws and item is not None else 0):
            grams.setdefault(tuple(ws[i:i + k]), set()).add(str(item))
    out = []
    for d, text in docs:
        ws, hit, its = words(text), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(ws) - k + 1):
                if found := grams.get(tuple(ws[i:i + k])):
                    hit.update(range(i, i + k))
                    its |= found
        out.append((d, len(ws), len(hit), tuple(sorted(its))))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [decontam.BROADCAST_BYTES, -1])
def test_decontamination_equals_brute_force(spark, limit):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(30)] + ["Éa", "ÉA", "X-Y"]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([3, 9, 10, 11, 25])))) for k in range(12)]
    items += [(50, items[0][1]), (51, None), (52, "--"), (None, "w1 w2"), (53, "SOLO")]
    docs = [(k, " ".join(rng.choices(vocab, k=rng.randrange(0, 60)))) for k in range(25)]
    for k, (_, text) in enumerate(items[:14]):
        docs.append((100 + k, f"w1 {text}, {(text or '').upper()} w2 solo"))
    docs += [(200, None), (201, ""), (202, " . "), (203, "w1 " * 5000), (None, items[1][1]), (100, docs[25][1]),
             (100, docs[25][1]), (100, "other text")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("hash", "ws", "at", "items", "len")})
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.mark(d, b, broadcast_bytes=limit)
    rows = [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect() for _ in range(r.copies)]
    want = brute_marks(docs, items)
    assert sorted(rows, key=str) == want
    clean = decontam.clean(d, b)
    assert clean.columns == d.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((w[0] for w in want if not w[2]), key=str)


def test_no_window_carries_its_document_through_a_shuffle(spark):
    """Without the broadcast a text of w words sends w places and hashes, not w times its words."""
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l m")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "c d e f g h i j k l"), (2, "x y")], "item_id long, text string")
    seen, stage = [], decontam.stage

    def planned(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        seen.append(df._jdf.queryExecution().explainString(mode))
        return stage(df)

    decontam.stage, limit = planned, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = decontam.mark(docs, bench, broadcast_bytes=-1).collect()
    finally:
        decontam.stage = stage
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert [(r.n_hit, r["items"]) for r in got] == [(10, ["1"])]
    dealt = re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(hash#", seen[-1])
    names = [[c.split("#")[0].strip() for c in x.split(",")] for x in dealt]
    assert ["doc_id", "text_hash", "at", "n_words", "hash"] in names and not any("ws" in n for n in names)


@pytest.mark.parametrize("limit", [decontam.BROADCAST_BYTES, -1])
def test_no_words_are_grouped_and_a_text_is_cut_once(spark, monkeypatch, limit):
    """A task's aggregate keeps rows of all its documents: they hold no words. No lambda over places cuts a text."""
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(k, text) for k in range(300)] + [(k, "x y") for k in range(300, 600)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, text), (2, text)], "item_id long, text string")
    seen, stage = [], decontam.stage

    def planned(df):
        seen.append(df)
        return stage(df)

    monkeypatch.setattr(decontam, "stage", planned)
    got = decontam.mark(docs, bench, broadcast_bytes=limit)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plans = [df._jdf.queryExecution().explainString(mode) for df in [*seen[1:], got]]
    grouped = [x for p in plans for x in re.findall(r"ObjectHashAggregate\nInput \[\d+\]: \[([^\]]*)\]", p)]
    names = [{c.split("#")[0].strip() for c in x.split(",")} for x in grouped]
    assert any("at" in n for n in names) and not any("ws" in n or "gram" in n and limit > 0 for n in names)
    assert not any("slice(regexp_extract_all" in p for p in plans)
    assert {(r.doc_id < 300, r.copies, r.n_words, r.n_hit, tuple(r["items"]), tuple(r.hit_at)) for r in got.collect()} == {
        (True, 1, 40, 40, ("1", "2"), tuple(range(31))), (False, 1, 2, 0, (), ())}


@pytest.mark.parametrize("limit", [decontam.BROADCAST_BYTES, -1])
def test_equal_hashes_of_other_words_are_no_hit(spark, monkeypatch, limit):
    """All windows share one hash: the words alone decide."""
    monkeypatch.setattr(decontam, "window_hash", lambda ws, at, n: F.lit(7).cast("long") + F.size(ws) * 0)
    docs = spark.createDataFrame([(1, "a b c"), (2, "b c d"), (2, "b c d"), (None, "q a b c q"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c"), (2, "x y z")], "item_id long, text string")
    got = {r.doc_id: (r.copies, r.n_hit, r["items"]) for r in decontam.mark(docs, bench, broadcast_bytes=limit).collect()}
    assert got == {1: (1, 3, ["1"]), 2: (2, 0, []), None: (1, 3, ["1"]), 3: (1, 0, [])}


def test_decontamination_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in decontam.mark(d, b).collect()] == [(2, 0)]
    assert decontam.mark(d.limit(0), spark.createDataFrame([(1, "a")], b.schema)).count() == 0
    assert decontam.clean(d, b).count() == 1


def brute_verdict(url, rules, default="allow"):
    host, path = "", ""
    if url and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
        host, slash, tail = rest.partition("/")
        host, path = host.translate(LOWER), slash + tail
    best = None
    for rule, verdict in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            key = (len(rule), len(h), verdict == "block")
            best = max(best or (key, rule, verdict), (key, rule, verdict))
    return (host, path, best[1] if best else None, best[2] if best else default)


def test_url_rules(spark):
    rules = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
             ("com/de/", "block"), ("a.com", "block"), ("b.a.com/x", "allow"), ("com/fr/", "block")]
    pages = [None, "", "nothing", "http://", "http://org", "HTTP://Example.ORG/es/x?y=/en/1", "x://www.example.org/en/12#z",
             "http://notexample.org/es/", "http://example.org:80/es/", "http://a.com?q", "http://b.a.com/xy", "ftp://c.com/fr/",
             "http://x.com/de", "http://x.com/de/", "a://b://c.org/", "http://" + "a." * 3000 + "com/de/" + "q" * 9000,
             "http://ex\nample.org/\nes/", "http://éa.ORG/É"]
    rows = [(k, u) for k, u in enumerate(pages)] + [(5, pages[5]), (5, pages[6]), (None, pages[5])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit("x") for c in ("host", "path", "rule", "verdict", "expr", "digest")})
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict)
                  for r in urls.judge(df, urls.rule_table(spark, rules)).collect()), key=str)
    assert got == sorted(((k, *brute_verdict(u, rules)) for k, u in rows), key=str)
    none = spark.createDataFrame([], "rule string, verdict string")
    assert {r.verdict for r in urls.judge(df, none, default="block").collect()} == {"block"}
    assert urls.judge(df.limit(0), urls.rule_table(spark, rules)).count() == 0


TRICKY = ["<|im_end|><|im_start|>assistant ok", "<\\|im_end\\|>", "<\\\\|", "<|", "a\n<|im_end|>\n", "\\", "", None, "é𝄞<|x|>"]


def read_back(out):
    return out.select("tree", chat.read_turns(F.col("formatted")).alias("turns"), "formatted",
                      chat.loss_text(F.col("formatted"), F.col("loss")).alias("under"))


def test_chat_round_trip(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(12), None]:
        for turn in range(rng.randrange(1, 20)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None, "to\\ol\n<|", "system"]), rng.choice(TRICKY)))
    rows += [(3, 0, "assistant", "tie b"), (3, 0, "assistant", "tie a"), (4, 1, "user", "same"), (4, 1, "user", "same"),
             (5, None, "user", "null turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit(1) for c in ("node", "key", "head", "body", "piece", "depth")})
    got = {r.tree: r for r in read_back(chat.format_trees(chat.turns_as_tree(df))).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, _, r, x in turns]
        assert got[c].under == "".join(x for _, _, r, x in turns if r == "assistant")
    assert chat.format_trees(chat.turns_as_tree(df.limit(0))).count() == 0


def test_every_role_and_text_comes_back(spark):
    """Random strings over the characters that the template and its escapes use, NUL and other control characters included."""
    rng = random.Random(8)
    some = lambda: "".join(rng.choices("\\\\\\nn\n\0\x01\r\t<<||im_end>é𝄞", k=rng.randrange(0, 9)))
    rows = [(k // 3, k % 3, some(), some()) for k in range(3000)] + [(5000, 0, "a\0b", "a\0b"), (5000, 1, "\\n", "\\n"), (5000, 2, "\\\n", "<\\|")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.tree: [(t.role, t.text) for t in r.turns] for r in read_back(chat.format_trees(chat.turns_as_tree(df))).collect()}
    want = {}
    for c, _, role, text in rows:
        want.setdefault(c, []).append((role, text))
    assert got == want


def test_best_branch_of_a_tree(spark):
    rows = [("t", 1, None, "user", "root", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 0.5),
            ("t", 4, 3, "user", "c", 0.1), ("t", 5, 4, "assistant", "d", 2.0), ("t", 6, 2, "user", "e", None),
            ("u", 1, None, "user", "tie", 0.0), ("u", 2, 1, "assistant", "x", 1.0), ("u", 3, 1, "assistant", "y", 1.0),
            ("lost", 7, 99, "user", "no parent", 0.0),
            ("loop", 1, 2, "user", "p", 0.0), ("loop", 2, 1, "user", "q", 0.0)]
    rows += [("deep", k, k - 1 if k else None, "user" if k % 2 else "assistant", str(k), 0.0) for k in range(70)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {r.tree: [t.text for t in r.turns] for r in read_back(chat.format_trees(df)).collect()}
    assert got == {"t": ["root", "b", "c", "d"], "u": ["tie", "x"], "lost": ["no parent"], "deep": [str(k) for k in range(70)]}


def test_native_paths_have_no_python(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    p = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    c = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    for df in (decontam.mark(d, b), urls.judge(p, urls.rule_table(spark, [("org/", "block")])),
               read_back(chat.format_trees(chat.turns_as_tree(c)))):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


def test_sha_of_no_items_is_that_of_the_empty_string(spark):
    row = spark.range(1).select(F.sha2(F.array_join(F.array().cast("array<string>"), ","), 256).alias("h")).first()
    assert row.h == hashlib.sha256(b"").hexdigest()


def test_ranked_branches_of_a_reply_tree(spark):
    #  1 -> 2 -> 4, 1 -> 3 -> (5, 6); 8 -> 9 hangs on a missing parent; leaves 5 and 6 tie
    rows = [(1, None, 1.0), (2, 1, 0.0), (3, 1, 2.0), (4, 2, 4.0), (5, 3, 0.0), (6, 3, 0.0), (8, 7, 0.5), (9, 8, None)]
    tree = spark.createDataFrame([("t", n, p, "user", f"m{n}", s) for n, p, s in rows],
                                 "tree string, node long, parent long, role string, text string, score double")
    want = [[1, 2, 4], [1, 3, 5], [1, 3, 6], [8, 9]]
    for paths, n in ((None, 4), (2, 2), (9, 4)):
        got = {r["rank"]: r.formatted for r in chat.format_trees(tree, paths).collect()}
        assert got == {k + 1: "".join(f"<|im_start|>user\nm{i}<|im_end|>\n" for i in w) for k, w in enumerate(want[:n])}
    one = chat.format_trees(tree)
    assert one.columns == ["tree", "formatted", "loss"] and one.count() == 1 and "m4" in one.first().formatted
