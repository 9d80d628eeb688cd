"""Incremental ingest of new raw files with the batch cleaning plan (K9).

``readStream`` over the raw folder (explicit schema, no inference) ->
``foreachBatch``: the batch job's column cleaning and splits. There is no
state store: which rows have been taken stands in an index of row hashes by month
(``seen.py``), of which a batch reads the cells of its own rows only. Rows
without a customer wait in ``pending``; they are tested again once per version
of the customers table, as a full recompute would, not with every batch.

Layout of the output folder: ``valid``, ``quarantine`` and ``pending`` grow by one
``batch=<step>`` folder a step; a test of the waiting rows writes those that still wait
as one folder, which takes the place of the earlier ones. A step is written under its own name
(``<micro-batch>.0000``, tests after it ``.0001`` ...), so a replayed
micro-batch overwrites what it wrote before; ``pending`` is written last and
names the steps that count.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.parse import parse_date_multi
from tidewater.operators.quality import NEGATIVE_AMOUNT, PROCESSED_AT, REASON, key_set, mark_orphans
from tidewater.plans import clean as pc
from tidewater.session import materialize
from tidewater.sources.io import list_folder, read_small, write_small
from tidewater.streaming.seen import CELL, ROW, SeenRows

TABLE = "transacciones"
BATCH = ".0000"  # ending of a micro-batch's step; tests of the waiting rows have other numbers


def steps(spark: SparkSession, out_dir: str) -> list[str]:
    """The steps that were written whole, in order."""
    return [n.removeprefix("batch=") for n, _, _ in list_folder(spark, f"{out_dir}/pending") if n.startswith("batch=")]


def _read(spark: SparkSession, out_dir: str, kind: str, names: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{out_dir}/{kind}/batch={s}" for s in names])


def _waiting(spark: SparkSession, out_dir: str, done: list[str]) -> DataFrame:
    """Rows that wait for a customer: those of the last test, and of the micro-batches since."""
    tests = [s for s in done if not s.endswith(BATCH)]
    return _read(spark, out_dir, "pending", [s for s in done if not tests or s >= tests[-1]])


def _split(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Cleaned rows with their reason, written once."""
    tagged = mark_orphans(rows, keys, "cliente_id").withColumn(REASON, pc.reject_reason(TABLE)).drop("_parent_found")
    return materialize(tagged)


def _write(tagged: DataFrame, out_dir: str, step: str) -> None:
    """The step's three folders."""
    negative = tagged.where(F.col(REASON) == NEGATIVE_AMOUNT).withColumn(PROCESSED_AT, F.current_timestamp())
    orphans = tagged.where(F.col(REASON).isNotNull() & (F.col(REASON) != NEGATIVE_AMOUNT))
    for kind, part in (("valid", tagged.where(F.col(REASON).isNull()).drop(REASON)), ("quarantine", negative),
                       ("pending", orphans.withColumn(PROCESSED_AT, F.current_timestamp()))):
        part.write.mode("overwrite").parquet(f"{out_dir}/{kind}/batch={step}")  # pending last: it names the step


def clean_transactions_stream(spark: SparkSession, raw_dir: str, raw_schema, customers: str, out_dir: str,
                              checkpoint: str, max_files_per_trigger: int | None = None, **layout):
    """Run the transactions cleaning over every raw file present, then stop; ``customers`` is a written table.

    ``layout`` goes to the index of taken rows (``grain``, ``digits``; see ``SeenRows``).
    Returns the finished ``StreamingQuery``.
    """
    retest_orphans(spark, customers, out_dir)
    keys = key_set(spark.read.parquet(customers), "cliente_id")  # once a run: the version just tested
    reader = spark.readStream.schema(raw_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        step, index = f"{batch_id:09d}{BATCH}", SeenRows(batch.sparkSession, f"{out_dir}/seen", **layout)
        rows = materialize(index.keyed(batch, parse_date_multi("fecha")))  # read for its cells, then for its rows
        tagged = _split(pc.clean_tx_columns(index.unseen(rows, step)), keys)
        index.add(tagged, step)
        _write(tagged.drop(CELL), out_dir, step)

    q = (reader.parquet(raw_dir).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def retest_orphans(spark: SparkSession, customers: str, out_dir: str) -> bool:
    """Take up waiting rows whose customer has arrived since; False if this version of the customers was tested before."""
    version = hashlib.md5(repr(list_folder(spark, customers)).encode()).hexdigest()
    if read_small(spark, f"{out_dir}/customers_tested") == version:
        return False
    done = steps(spark, out_dir)
    if done:
        batch, again = done[-1].split(".")
        waiting = _waiting(spark, out_dir, done).drop(REASON, PROCESSED_AT)
        keys = key_set(spark.read.parquet(customers), "cliente_id")
        _write(_split(waiting, keys), out_dir, f"{batch}.{int(again) + 1:04d}")
    write_small(spark, f"{out_dir}/customers_tested", version)
    return True


def read_stream_output(spark: SparkSession, out_dir: str, kind: str = "valid") -> DataFrame:
    """All valid rows, or all rejected rows (the quarantine and the rows that wait for a customer now), of whole steps."""
    done = steps(spark, out_dir)
    if kind == "valid":
        return _read(spark, out_dir, "valid", done).drop(ROW)
    rejected = _read(spark, out_dir, "quarantine", done)
    return rejected.unionByName(_waiting(spark, out_dir, done)).drop(ROW)
