"""Small shared pieces: table access, staging and expression helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back (a lineage cut that outlives executors)."""
    return materialize(df)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_bytes(df: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of a text column, to size partitions from data instead of from file counts."""
    return df.agg(F.sum(F.octet_length(F.col(col)).cast("long"))).first()[0] or 0


def bound_batches(spark: SparkSession, size: str = "4m") -> None:
    """Let Arrow batches to and from Python hold at most ``size`` bytes, however long the texts are.

    A setting of the session: it changes how rows are cut into batches, never a result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def parts_for(n_bytes: int, per_part: int) -> int:
    return max(1, math.ceil(n_bytes / per_part))
