"""Registered streaming query (K9): file-source stream must equal the batch cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.plans import clean as pc
from tidewater.plans import oracle as o
from tidewater.session import checkpoint_dir
from tidewater.sources.bronze import bronze_tables
from tidewater.streaming.ingest import clean_transactions_stream, read_stream_output
from tidewater.streaming.seen import CELL, UNDATED, SeenRows

GRAIN = "yyyy"  # the test tables hold some thousand transactions a year
TRIGGERS, FILES = 4, 12  # a trigger takes so many files, which as many tasks write and read
Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _streamed(spark, sf):
    """Output folder of an availableNow stream over the raw transactions, which land as ``FILES`` files for each of ``TRIGGERS`` triggers."""
    base = f"{checkpoint_dir(spark)}/stream_{uuid.uuid4().hex[:8]}"
    b = bronze_tables(spark, sf)
    raw = b["transacciones"]
    raw.repartition(TRIGGERS * FILES, "transaccion_id").write.mode("overwrite").parquet(f"{base}/raw")
    pc.customer_keys(b["clientes"]).write.parquet(f"{base}/clientes")
    clean_transactions_stream(spark, f"{base}/raw", raw.schema, f"{base}/clientes", f"{base}/out", f"{base}/ckpt",
                              max_files_per_trigger=FILES, grain=GRAIN)
    return f"{base}/out"


@register("stream_clean_transactions", o.sql_for(["s_transacciones"], "SELECT * FROM s_transacciones"))
def stream_clean_transactions(spark, sf):
    """K9: the valid rows of the stream are those of the batch job."""
    return read_stream_output(spark, _streamed(spark, sf), "valid")


@register("stream_rejected_rows", o.sql_for(["s_transacciones_all"], """
SELECT motivo_descarte, count(*) AS filas FROM s_transacciones_all WHERE motivo_descarte IS NOT NULL GROUP BY 1"""))
def stream_rejected_rows(spark, sf):
    """K9 + K10: rejected and waiting rows of the stream by reason."""
    rejected = read_stream_output(spark, _streamed(spark, sf), "rejected")
    return rejected.groupBy("motivo_descarte").agg(F.count(F.lit(1)).alias("filas"))


@register("stream_seen_rows", o.sql_for(["b_transacciones"], f"""
SELECT coalesce(strftime({o.pdate('fecha')}, '%Y'), '{UNDATED}') AS periodo, count(*) AS filas
FROM (SELECT DISTINCT * FROM b_transacciones) GROUP BY 1"""))
def stream_seen_rows(spark, sf):
    """K9: rows that the stream has taken, by year, from its index; the raw files hold some of them more than once."""
    seen = SeenRows(spark, f"{_streamed(spark, sf)}/seen").read()
    return seen.groupBy(F.col(CELL).alias("periodo")).agg(F.count(F.lit(1)).alias("filas"))
