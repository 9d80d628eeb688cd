"""Data-quality operators: quarantine splits, duplicate flags, profiles."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import materialize

REASON = "motivo_descarte"
PROCESSED_AT = "fecha_proceso"
# Quarantine reasons of the reference.
ORPHAN = "cliente_id_huerfano"
NEGATIVE_AMOUNT = "monto_negativo_invalido"


@dataclass
class Split:
    """Valid rows and rejected rows (with a reason) of one table.

    ``frame`` (optional) is the single plan both come from: every row with its
    reason, NULL for valid rows.
    """

    valid: DataFrame
    rejected: DataFrame | None
    frame: DataFrame | None = None


def key_set(parent: DataFrame, key: str) -> DataFrame:
    """The distinct non-NULL keys of a parent table, written once.

    Children join the written table, so no ``distinct`` stands between the two
    sides of that join and adaptive execution can split a hot key's partition.
    """
    return materialize(parent.select(key).where(F.col(key).isNotNull()).distinct())


def mark_orphans(child: DataFrame, keys: DataFrame, key: str, marker: str = "_parent_found") -> DataFrame:
    """J3 core: one left join to unique parent ``keys`` (see ``key_set``) adds a found-marker.

    One join (one shuffle of the child, or none when Spark broadcasts the key
    set after measuring it) replaces the semi + anti pair, which would read and
    shuffle the child twice. NULL keys never match, so they count as orphans.
    """
    return child.join(keys.select(key, F.lit(True).alias(marker)), on=key, how="left")


def split_by_reason(marked: DataFrame, reason: Column, with_time: bool = True) -> Split:
    """Rows whose ``reason`` is NULL are valid; the rest are rejected with that reason.

    The first matching reason wins, so an orphan that is also negative counts once.
    """
    tagged = marked.withColumn(REASON, reason)
    valid = tagged.filter(F.col(REASON).isNull()).drop(REASON)
    rejected = tagged.filter(F.col(REASON).isNotNull())
    if with_time:
        rejected = rejected.withColumn(PROCESSED_AT, F.current_timestamp())
    return Split(valid, rejected, tagged)


def orphan_split(child: DataFrame, parent_keys: DataFrame, key: str = "cliente_id",
                 with_time: bool = True) -> Split:
    """J1+J2+J3: rows whose key exists in the parent vs. orphans, reason attached."""
    m = mark_orphans(child, key_set(parent_keys, key), key)
    s = split_by_reason(m, F.when(F.col("_parent_found").isNull(), F.lit(ORPHAN)), with_time)
    return Split(s.valid.drop("_parent_found"), s.rejected.drop("_parent_found"), s.frame.drop("_parent_found"))


def semi_join(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in ``parent``."""
    return child.join(parent.select(key), on=key, how="left_semi")


def anti_join(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not exist in ``parent`` (NULL keys included)."""
    return child.join(parent.select(key), on=key, how="left_anti")


def flag_duplicated(df: DataFrame, key: str, flag: str) -> DataFrame:
    """``count(*) over (partition by key) > 1`` without a window buffer.

    The per-key count is a partial (map-side) aggregate, so a key holding a
    third of the rows costs one counter per task, not one giant window
    partition. It is joined back null-safely: NULL keys form one group, exactly
    like a window partition. AQE may split a skewed side of this join.
    """
    counts = df.groupBy(key).agg((F.count(F.lit(1)) > 1).alias(flag))
    c = counts.withColumnRenamed(key, "_k")
    return df.join(c, df[key].eqNullSafe(c["_k"]), "left").drop("_k")


COPIES = "_copias"


def count_copies(raw: DataFrame) -> DataFrame:
    """De-duplicated rows with the number of raw rows each stands for."""
    return raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias(COPIES))


def run_report(tagged: DataFrame, table: str) -> DataFrame:
    """Raw rows, processed rows, quarantined rows and rows per reason, as one row.

    ``tagged`` holds each distinct raw row once, with its number of copies
    (``count_copies``) and its reason (NULL for valid rows), so one pass over
    the raw table gives all counts. The reason map is bounded by the reasons.
    """
    per = tagged.groupBy(REASON).agg(F.sum(COPIES).alias("_raw"), F.count(F.lit(1)).alias("n"))
    rejected = F.col(REASON).isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return per.agg(
        F.lit(table).alias("tabla"), total(F.col("_raw")).alias("filas_crudas"),
        total(F.when(~rejected, F.col("n"))).alias("filas_procesadas"),
        total(F.when(rejected, F.col("n"))).alias("filas_cuarentena"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
            F.when(rejected, F.struct(REASON, "n")))))).alias("motivos"))


# ----------------------------------------------------------------------------- profiles

def _is_missing(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    miss = F.col(c).isNull()
    if isinstance(t, (T.FloatType, T.DoubleType)):
        miss = miss | F.isnan(F.col(c))
    elif isinstance(t, T.StringType):
        # the reference's isnan(string) counted the text "NaN"; keep that meaning
        miss = miss | (F.lower(F.col(c)) == F.lit("nan"))
    return miss


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q6: NULL-or-NaN count per column, one row, one pass, type-aware."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(_is_missing(df, c)).alias(c) for c in cols])


def null_profile_long(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q6 as (column, n_missing) rows."""
    wide = null_profile(df, columns)
    cols = wide.columns
    return wide.unpivot([], cols, "columna", "n_nulos")


def cardinality_profile(df: DataFrame, columns: Sequence[str] | None = None,
                        approximate: bool = False) -> DataFrame:
    """Q7: distinct count per column as (column, n_distinct).

    Exact counts unpivot first and count distinct (column, value) pairs in one
    aggregation; ``approximate`` uses HyperLogLog++ sketches (bounded memory).
    """
    cols = list(columns or df.columns)
    if approximate:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return wide.unpivot([], cols, "columna", "n_distintos")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in cols
    ])).alias("p")).select("p.*")
    return (long.filter(F.col("valor").isNotNull()).distinct()
            .groupBy("columna").agg(F.count(F.lit(1)).alias("n_distintos")))


def frequency_profile(df: DataFrame, col: Column | str, name: str = "valor") -> DataFrame:
    """Q8: value -> count, most frequent first."""
    c = F.col(col) if isinstance(col, str) else col
    return (df.groupBy(c.alias(name)).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_first(name)))


def length_profile(df: DataFrame, col: str) -> DataFrame:
    """Q8: string length -> count, most frequent first."""
    return frequency_profile(df, F.length(col), "longitud")


def duplicate_key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q9: keys seen more than once, with how many distinct row versions they have.

    ``n_versiones == 1`` means every copy is byte-equal (an exact duplicate);
    more means conflicting rows share the key. One pass: distinct whole rows
    first (shuffle by row), then a count per key.
    """
    keys = list(keys)
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return (per_row.groupBy(*keys)
            .agg(F.sum("_n").cast("bigint").alias("n_apariciones"),
                 F.count(F.lit(1)).alias("n_versiones"))
            .filter(F.col("n_apariciones") > 1))


def cooccurrence(df: DataFrame, group_col: str, present_col: str, *more: Column) -> DataFrame:
    """Q10: per value of ``group_col``: rows with and without ``present_col``, and ``more`` aggregates."""
    return df.groupBy(group_col).agg(
        F.count_if(F.col(present_col).isNotNull()).alias("n_con"),
        F.count_if(F.col(present_col).isNull()).alias("n_sin"), *more)


def entity_trace(tables: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Q12: every whole row of one key across tables, with the table's name; columns a table lacks are NULL."""
    out = None
    for name, df in tables.items():
        part = df.filter(F.col(key) == value).select(F.lit(name).alias("tabla"), "*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


__all__ = [n for n in dir() if not n.startswith("_") and n not in {"annotations", "Iterable"}]
