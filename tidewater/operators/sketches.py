"""Sketches that are stored per part of a table and merged over parts: quantiles (A11) and distinct counts (Q7).

A part is what arrives or is replaced together (a load date, a month). Its sketches are built from its rows alone, written
under its name, and a profile of all history reads sketches only: a part that is loaded again replaces its own. Rows are
folded into sketches before the shuffle, so a hot group costs one sketch per task.

Quantiles are KLL sketches: the rank of an estimate differs from the rank asked for by at most ``quantile_rank_error(k)`` of
the rows in 99 of 100 cases, whatever the merges. Distinct counts are HyperLogLog sketches with a relative standard
error of ``distinct_error(lg_k)``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_K = 200
HLL_LG_K = 12
PART = "parte"


def quantile_rank_error(k: int = KLL_K) -> float:
    """Normalised rank error of a KLL sketch of size ``k`` at 99 % confidence (the sketch's published fit)."""
    return 2.296 / k ** 0.9021


def distinct_error(lg_k: int = HLL_LG_K) -> float:
    return 1.04 / math.sqrt(1 << lg_k)


def _long(df: DataFrame, by: Sequence[str], part: Column, cols: Sequence[str], cast: str) -> DataFrame:
    """One row per row and column: (part, ``by``, columna, valor), NULLs left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast(cast).alias("valor")) for c in cols])
    told = F.coalesce(part.cast("string"), F.lit("sin_parte")).alias(PART)
    return df.select(told, *by, F.explode(cells).alias("_c")).select(PART, *by, "_c.*").where("valor IS NOT NULL")


def quantile_sketches(df: DataFrame, by: Sequence[str], part: Column, cols: Sequence[str], k: int = KLL_K) -> DataFrame:
    """(parte, ``by``, columna, boceto): a KLL sketch of each numeric column per part and group. NaN is left out."""
    v = _long(df, by, part, cols, "double").where(~F.isnan("valor"))
    return v.groupBy(PART, *by, "columna").agg(F.kll_sketch_agg_double("valor", k).alias("boceto"))


def distinct_sketches(df: DataFrame, part: Column, cols: Sequence[str], lg_k: int = HLL_LG_K) -> DataFrame:
    """(parte, columna, boceto): a HyperLogLog sketch of each column's values, as text, per part."""
    return _long(df, [], part, cols, "string").groupBy(PART, "columna").agg(F.hll_sketch_agg("valor", lg_k).alias("boceto"))


def store(sketches: DataFrame, path: str) -> None:
    """Write the sketches' parts; a part that is there already is replaced, others stay."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path))


def quantiles(sketches: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(``by``, columna, n, p, valor) of all parts' sketches merged; n counts the values."""
    merged = sketches.groupBy(*by, "columna").agg(F.kll_merge_agg_double("boceto").alias("_s"))
    each = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("_s", F.lit(float(p))).alias("valor"))
                     for p in probs])
    return merged.select(*by, "columna", F.kll_sketch_get_n_double("_s").alias("n"), F.explode(each).alias("_q")).select(
        *by, "columna", "n", "_q.*")


def rank_gaps(values: DataFrame, by: Sequence[str], estimates: DataFrame) -> DataFrame:
    """How far the exact rank of each estimate (see ``quantiles``) is from its p, as a share of the group's values."""
    wide = [c for c in values.columns if c not in by]
    long = _long(values, by, F.lit(""), wide, "double").where(~F.isnan("valor")).drop(PART)
    e = estimates.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("columna").alias("_columna"), "n", "p",
                         F.col("valor").alias("_estimate"))
    on = F.col("columna") == F.col("_columna")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    counted = long.join(e, on).groupBy(*by, "columna", "n", "p").agg(
        F.avg((F.col("valor") < F.col("_estimate")).cast("int")).alias("_below"),
        F.avg((F.col("valor") <= F.col("_estimate")).cast("int")).alias("_up_to"))
    gap = F.greatest(F.lit(0.0), F.col("_below") - F.col("p"), F.col("p") - F.col("_up_to"))
    return counted.select(*by, "columna", "n", "p", gap.alias("distancia"))


def distinct_counts(sketches: DataFrame) -> DataFrame:
    """(columna, n_estimado) of all parts' sketches merged."""
    return sketches.groupBy("columna").agg(F.hll_sketch_estimate(F.hll_union_agg("boceto")).alias("n_estimado"))
