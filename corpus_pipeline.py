"""Corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, byte-level BPE.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontam, jaccard, suffixes, toxicity
from tidewater.llm.common import stage, table
from tidewater.llm.queries import vocabulary
from tidewater.session import drop_tables, staged_tables

RANKS = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled rows outside the held-out fold, does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="__score").where("__score < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by 5-gram Jaccard similarity of 0.8 or more."""
    return jaccard.deduplicate(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the 200-byte strings that also start anywhere else; ``n_chars`` follows the text."""
    out = suffixes.remove(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and what they decode to, by hash."""
    ranks = vocabulary(RANKS)
    out = bpe.decode(bpe.encode(docs, ranks), ranks)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("jaccard_join", drop_near_duplicates),
          ("suffix_array_dedup", cut_repeated_passages), ("benchmark_decontamination", drop_benchmark_leaks),
          ("byte_bpe", encode)]

#: A trained classifier decides the first stage, so SQL has no equal; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Once a stage is written, all that it and the ones before it had staged is deleted."""
    docs = table(spark, sf_dir, "documents")
    with staged_tables() as own:
        for k, (_, f) in enumerate(STAGES):
            docs = f(spark, docs, sf_dir)
            if k < len(STAGES) - 1:
                docs = stage(docs)
                drop_tables(spark, own[:-1])
                del own[:-1]
    return docs
