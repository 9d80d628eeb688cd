"""Benchmark decontamination: hash set of normalised benchmark n-grams against training token windows.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased. A window is ``n``
consecutive words of an item; an item with fewer words, but not none, is one window. Every document position
is hashed for each window length that occurs; hashes meet the benchmark's, the words confirm the hit.

The benchmark's distinct windows are broadcast only when their measured size is below ``broadcast_bytes``. Beyond
it both sides are shuffled on the window hash, where adaptive execution splits hot windows: of a document's window its
place and hash go, not its words, so that the shuffle is linear in the text; the words of the documents where
hashes have met are read again, once, to confirm. A document's row is carried by one sentinel. A document's words end
at the filter: what is grouped by document is places, lengths and item ids (beyond the bound also the hits' grams).

Defined results: a NULL or wordless text has no words and no hits; rows that repeat one (id, text) pair each
get the same result; an empty benchmark hits nothing; an empty table gives no rows; NULL items are ignored;
NULL ids are kept as rows; other columns pass through ``clean`` untouched and are ignored by ``mark``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N = 10
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def window_hash(ws: Column, at, n: int) -> Column:
    """Hash of the ``n`` words from place ``at`` (from 0) of an array of words."""
    return F.xxhash64(*[F.get(ws, F.lit(at + j) if isinstance(at, int) else at + j) for j in range(n)], F.lit(n))


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows: ``hash``, ``len``, ``gram`` (words), ``items`` (sorted distinct item ids as strings)."""
    b = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("ws"))
    b = b.where(F.col("item").isNotNull() & (F.size("ws") > 0))
    size = F.least(F.size("ws"), F.lit(n))
    grams = F.transform(F.sequence(F.lit(0), F.size("ws") - size), lambda i: F.slice(F.col("ws"), i + 1, size))
    g = b.select("item", F.explode(grams).alias("gram"))
    g = g.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hashes = F.coalesce(*[F.when(F.size("gram") == k, window_hash(F.col("gram"), 0, k)) for k in range(1, n + 1)])
    return g.select(hashes.alias("hash"), F.size("gram").alias("len"), "gram", "items")


def same_words(ws: Column, at: Column, length: Column, gram: Column) -> Column:
    return F.slice(ws, at + 1, length) == gram


def confirm(per_doc: DataFrame, rows: DataFrame) -> DataFrame:
    """``per_doc`` with those of its ``found`` places only whose words are the gram's, not merely their hash.

    The texts of documents with places are read again, one copy of each; all places of a text are judged in one row.
    """
    hit = per_doc.where(F.size("found") > 0).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "found")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    again = rows.join(hit, same).groupBy("_id", "_hash").agg(F.first(F.struct("text", "found")).alias("b"))
    # The outer lambda binds the words of a text: named by a column they would be cut anew for every place.
    sure = again.select("_id", "_hash", F.transform(F.array(words(F.col("b.text"))), lambda ws: F.filter(
        "b.found", lambda m: same_words(ws, m["at"], m["len"], m["gram"])))[0].alias("sure"))
    out = per_doc.join(sure, same, "left").drop("_id", "_hash")
    return out.withColumn("found", F.coalesce("sure", F.filter("found", lambda m: F.lit(False)))).drop("sure")


def mark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N,
         broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per distinct (id, text): ``doc_id, text_hash, copies, n_words, n_hit, items, hit_at, hit_len``.

    ``hit_at`` / ``hit_len`` are the word positions and lengths of the matched windows, ``items`` the sorted ids.
    """
    grams = stage(benchmark_windows(benchmark, n))
    lengths = sorted(r[0] for r in grams.select("len").distinct().collect())  # at most n values
    weight = grams.agg(F.sum(F.octet_length(F.concat_ws(" ", "gram")) + 16 * F.size("gram")
                             + 32 * F.size("items") + 64)).first()[0] or 0
    small = weight <= broadcast_bytes
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    d = rows.select("doc_id", "text_hash", words(F.col("text")).alias("ws"))
    # Place -1 is the row that carries the document. Hashes are taken after the explode, inside generated code.
    last = F.greatest(F.lit(-1), F.size("ws") - min(lengths, default=1))
    d = d.select("doc_id", "text_hash", "ws", F.explode(F.sequence(F.lit(-1), last)).alias("at"))
    of_length = [window_hash(F.col("ws"), F.col("at"), k) for k in lengths]
    carrier = F.when(F.col("at") < 0, F.xxhash64("doc_id", "text_hash"))
    if len(lengths) == 1:
        hashes = F.coalesce(carrier, of_length[0])
    else:  # a window that runs over the text's end holds NULL words; its gram differs from all
        hashes = F.explode(F.when(F.col("at") < 0, F.array(carrier)).otherwise(
            F.array(*of_length) if lengths else F.array().cast("array<long>")))
    n_words = F.when(F.col("at") < 0, F.size("ws")).alias("n_words")
    # Only beside a broadcast table do the words stay in a window's row; what is shuffled is a place and a hash.
    d = d.select("doc_id", "text_hash", "at", n_words, *(["ws"] if small else []), hashes.alias("hash"))
    j = d.join(F.broadcast(grams) if small else grams, "hash", "left")
    met = (F.col("at") >= 0) & F.col("len").isNotNull()
    if small:
        met = met & same_words(F.col("ws"), F.col("at"), F.col("len"), F.col("gram"))
    # Of the rows left, those with a place are hits. To name ``met`` again below would send the words of a document's
    # row, and of each of its hits, into the aggregate, which sorts its rows once a task has more than a few documents.
    left = j.where((F.col("at") == -1) | met).groupBy("doc_id", "text_hash")
    each = lambda *cols: F.collect_set(F.when(F.col("at") >= 0, F.struct(*cols)))
    counts = [F.count("n_words").alias("copies"), F.max("n_words").alias("n_words")]
    if small:
        per_doc = left.agg(*counts, each("at", "len").alias("found"), each("items").alias("sets"))
    else:
        per_doc = confirm(stage(left.agg(*counts, each("at", "len", "items", "gram").alias("found"))), rows)
        per_doc = per_doc.withColumn("sets", F.col("found"))
    runs = F.transform("found", lambda m: F.struct(m["at"].alias("at"), m["len"].alias("len")))
    per_doc = per_doc.select("doc_id", "text_hash", "copies", "n_words", F.array_sort(F.array_distinct(runs)).alias("runs"),
                             F.col("sets.items").alias("sets"))
    covered = F.aggregate("runs", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda acc, r: F.struct(
        F.greatest(acc["end"], r["at"] + r["len"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), r["at"] + r["len"] - F.greatest(acc["end"], r["at"]))).alias("n")))
    return per_doc.select("doc_id", "text_hash", "copies", "n_words", covered["n"].alias("n_hit"),
                          F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items"),
                          F.col("runs.at").alias("hit_at"), F.col("runs.len").alias("hit_len"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = N) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no benchmark window."""
    bad = mark(docs, benchmark, id_col, text_col, n).where("n_hit > 0")
    bad = bad.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    return docs.join(bad, F.xxhash64(docs[text_col]).eqNullSafe(F.col("__hash"))
                     & docs[id_col].eqNullSafe(F.col("__id")), "left_anti")
