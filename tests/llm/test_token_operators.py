"""Token files, counts by section and BPE against the tokenizer libraries, with the odd rows."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import attribution, bpe, frames, tokens

VOCAB = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", " ", "\n\n\n", "a", "Hello world, it's 3 o'clock…", "x<|endoftext|>y", "\u00b2\u00bd \u2460 ½", "é à\u0301 中文 한국어 🤦🏼‍♂️ 𝄞",
         "tab\tand\x1c\x85 ends  ", "'S 'll''ve", "word " * 3000, "A\r\nB\n\nC \n  D", "\ud7a4\u0558\u058b"]


def odd_docs(spark):
    rng = random.Random(9)
    alphabet = "ab AB'’.,\n\t 12é中\u00a0\u3000😀"
    rows = list(enumerate(TEXTS)) + [(20 + k, "".join(rng.choices(alphabet, k=rng.randrange(80)))) for k in range(60)]
    rows += [(None, "null id"), (3, "same id"), (5, TEXTS[5]), (5, TEXTS[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return rows, df.withColumns({c: F.lit(1) for c in ("ids", "block", "h", "m", "words", "start", "section")})


def test_safe_characters_split_alike():
    split = Tokenizer.from_file(VOCAB).pre_tokenizer.pre_tokenize_str
    pattern = regex.compile(public_tokenizers.PATTERN)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or tokens.UNSAFE.match(chr(c)):
            continue
        for s in (f"a{chr(c)}a", f"1{chr(c)} ", f"!{chr(c)}\n "):
            spans = [m.span() for m in tokens.PIECE.finditer(s)]
            assert spans == [m.span() for m in pattern.finditer(s)]
            if c < 0x600 or c % 37 == 0:
                assert spans == [x[1] for x in split(s)]


def test_pattern_splits_all_assigned_characters_as_the_library():
    split = Tokenizer.from_file(VOCAB).pre_tokenizer.pre_tokenize_str
    some = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and tokens.UNSAFE.match(chr(c))]
    clear = [c for c in some if not tokens.doubtful(c)]
    assert len(clear) > 100_000  # emoji, ideographs of all planes, private use, historic scripts
    for c in clear:
        if 0xE000 <= ord(c) < 0xF900 or ord(c) >= 0xF0000:
            if ord(c) % 97:  # private use
                continue
        s = f"a{c}1{c} {c}.{c}{c} {c}"
        assert tokens.pieces(s) == [s[i:j] for _, (i, j) in split(s)], hex(ord(c))


def test_unusual_characters_take_the_distinct_words(spark):
    import tiktoken

    rng = random.Random(4)
    odd = "🙂🚀™②½ঝ𠮷\u0378\U0003d001\u0558 \n\t\x1c\u3000ab1.'"
    texts = [f"{rng.choice('🙂™𠮷')} said the text number {k}: {''.join(rng.choices(odd, k=40))}" for k in range(300)]
    whole = [p for t in texts for p in tokens.pieces(t)]
    assert all("".join(tokens.pieces(t)) == t for t in texts) and len(set(whole)) < len(whole) / 2
    assert all(regex.fullmatch(r"\s*\S*", p) for p in whole)  # no text goes whole
    enc, t = tokens.PieceEncoder(VOCAB), Tokenizer.from_file(VOCAB)
    mixed = [*texts, "🙂<|endoftext|> x<|endoftext|>", "<|endoftext|>"]
    ids, counts = enc.encode(mixed)
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
        t.encode(x, add_special_tokens=False).ids for x in mixed]
    lib = tiktoken.Encoding("r", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (bytes(r.ids), bytes(r.decoded)) for r in
           bpe.decode(bpe.encode(df, RANKS, block_bytes=2_000), RANKS).collect()}
    assert got == {k: (np.array(lib.encode_ordinary(x), "<u4").tobytes(), x.encode()) for k, x in enumerate(texts)}


def test_encoder_equals_the_library():
    enc, t = tokens.PieceEncoder(VOCAB, cache_pieces=10), Tokenizer.from_file(VOCAB)
    texts = [x or "" for x in TEXTS]
    for _ in range(2):  # the second time with an emptied cache
        ids, counts = enc.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [
            t.encode(x, add_special_tokens=False).ids for x in texts]


def test_token_files_round_trip(spark, tmp_path):
    rows, df = odd_docs(spark)
    t = Tokenizer.from_file(VOCAB)
    path = str(tmp_path / "tokens")
    frames.write(df, VOCAB, path, file_bytes=2_000, frame_ids=50)
    got = frames.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens * 4) == (at, len(r.ids))
        at += r.n_tokens
    want = sorted((i, (np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4").tobytes())) for i, x in rows if i is not None)
    assert sorted((r.doc_id, bytes(r.ids)) for r in got if r.doc_id is not None) == want
    files = sorted(tmp_path.glob("tokens/part-*"))
    assert len(files) > 1
    found = 0
    for f in files:
        reader = frames.open_file(spark, str(f))
        total = zstandard.ZstdDecompressor().decompressobj
        data, raw = f.read_bytes(), b""
        while data:  # any zstandard reader can go through the file
            d = total()
            raw += d.decompress(data)
            data = d.unused_data
            while data[:3] and 0x184D2A50 <= int.from_bytes(data[:4], "little") <= 0x184D2A5F:
                data = data[8 + int.from_bytes(data[4:8], "little"):]
        assert len(raw) == int(reader.counts.sum()) * reader.width
        read = []
        reader.read_at = (lambda old: lambda o, n: read.append(n) or old(o, n))(reader.read_at)
        for ids in reader.get(11):
            found += 1
            assert ids.tolist() == t.encode(TEXTS[11], add_special_tokens=False).ids + [0]
            assert sum(read) < f.stat().st_size
    assert found == 1


def test_damage_is_noticed(spark, tmp_path):
    path = tmp_path / "t"
    frames.write(spark.createDataFrame([(1, "some text here")], "doc_id long, text string"), VOCAB, str(path))
    data = bytearray(next(f for f in path.glob("part-*") if f.stat().st_size > 100).read_bytes())
    data[6] ^= 255
    reader = frames.SeekReader(len(data), lambda o, n: bytes(data[o:o + n]))
    with pytest.raises((ValueError, zstandard.ZstdError)):
        reader.get(1)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    frames.write(df, VOCAB, str(tmp_path / "e"))
    assert frames.read(spark, str(tmp_path / "e")).count() == 0
    assert bpe.decode(bpe.encode(df, RANKS), RANKS).count() == 0
    assert attribution.section_tokens(df, VOCAB).count() == 0


@pytest.mark.parametrize("rule", attribution.RULES)
def test_sections_against_offsets(spark, rule):
    rows, df = odd_docs(spark)
    df = df.withColumn("title", F.concat(F.lit("T "), "doc_id"))
    t = Tokenizer.from_file(VOCAB)
    by = {}
    for r in attribution.section_tokens(df, VOCAB, fields=("title", "text"), rule=rule).collect():
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for i, x in rows:
        title = "" if i is None else f"T {i}"
        text = f"{title}\n{x or ''}"
        e = t.encode(text, add_special_tokens=False)
        times = sum(row == (i, x) for row in rows)  # repeated rows bring their sections again
        secs = sorted(by[i, len(e.ids)], key=lambda r: (r.field == "text", r.section))[::times]
        assert "".join(text[r.start_char:r.start_char + r.n_chars] for r in secs) == text
        assert sum(r.n_tokens for r in secs) == len(e.ids)


def brute_sections(tokenizer, values, rule):
    """(field, section, start, chars, tokens, crossing) of each line, from the tokenizer's own character offsets."""
    names, text, ends = [], "", []
    for f, value in enumerate(values):
        lines = re.findall(r"[^\n]*\n|[^\n]+", value) or [""]
        lines[-1] += "\n" if f < len(values) - 1 else ""
        for k, line in enumerate(lines):
            names.append((f, k, len(text), len(line)))
            text += line
            ends.append(len(text))
    counts, crossing = [0] * len(names), [0] * len(names)
    for a, b in tokenizer.encode(text, add_special_tokens=False).offsets:
        section_of = [next(k for k, e in enumerate(ends) if c < e) for c in range(a, b)]
        met = sorted(set(section_of))
        weight = {k: sum(len(text[c].encode()) for c, own in zip(range(a, b), section_of) if own == k) for k in met}
        chosen = {"first": met[0], "last": met[-1], "most": min(met, key=lambda k: (-weight[k], k))}[rule]
        counts[chosen] += 1
        if len(met) > 1:
            for k in range(met[0], met[-1] + 1):
                crossing[k] += 1
    return sorted((*n, c, x) for n, c, x in zip(names, counts, crossing))


@pytest.mark.parametrize("rule", attribution.RULES)
def test_each_section_against_the_tokenizers_offsets(spark, rule):
    rng, t = random.Random(12), Tokenizer.from_file(VOCAB)
    some = lambda: "".join(rng.choices(["\n", "\n\n", " ", "  ", "a", "word", "é", "日本", "😀", ".", "\t", "}\n", "\r\n"], k=rng.randrange(25)))
    rows = [(k, some(), some()) for k in range(150)]
    rows += [(200, None, None), (201, "", "\n\n\n"), (202, "\n", ""), (None, "x\n", "y"), (203, "a\n\n\n\nb\n\n", "\n\nc")]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string").repartition(3)
    got = {}
    for r in attribution.section_tokens(df, VOCAB, fields=("title", "text"), rule=rule).collect():
        got.setdefault(r.doc_id, []).append((int(r.field == "text"), r.section, r.start_char, r.n_chars, r.n_tokens, r.n_crossing))
    want = {i: brute_sections(t, [a or "", b or ""], rule) for i, a, b in rows}
    assert {i: sorted(v) for i, v in got.items()} == want
    assert sum(x[5] > 0 for v in want.values() for x in v) > 50  # tokens do cross lines here


def test_allocation_rules():
    bounds = np.array([3, 5, 9])
    start, end = np.array([0, 2, 2, 4, 8]), np.array([2, 4, 9, 9, 9])
    chosen = {r: attribution.allocate(start, end, bounds, r)[0].tolist() for r in attribution.RULES}
    assert chosen == {"first": [0, 0, 0, 1, 2], "last": [0, 1, 2, 2, 2], "most": [0, 0, 2, 2, 2]}


def test_bpe_equals_the_library(spark):
    rows, df = odd_docs(spark)
    enc = bpe.encoding(RANKS)
    got = bpe.decode(bpe.encode(df, RANKS, block_bytes=500), RANKS).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, bytes(r.decoded).decode(), np.frombuffer(r.ids, "<u4").tolist()) for r in got), key=key) == sorted(
        ((i, x or "", enc.encode_ordinary(x or "")) for i, x in rows), key=key)
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)
