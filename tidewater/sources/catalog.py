"""Zone registration with a schema history (K8).

The catalog's table follows the files: columns that appear are added to it, columns whose type changes are
redefined, columns that disappear stay (old readers get NULL) and are reported. What a table looked like at its last registration
stands in a small file per generation under the history folder, beside a log with one row per change.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.sources.io import list_folder, read_small, write_small

ADDED, REMOVED, RETYPED, RESTORED = "agregada", "eliminada", "cambio_de_tipo", "restaurada"
LOG = "zona string, tabla string, generacion int, columna string, cambio string, antes string, despues string"


def schema_changes(declared: T.StructType, present: set[str], now: T.StructType) -> list[tuple]:
    """(column, change, type before, type now) from a table as ``declared``, of whose columns ``present`` were in the files."""
    types = {f.name: f.dataType.simpleString() for f in declared}
    new = {f.name: f.dataType.simpleString() for f in now}
    out = [(c, ADDED, None, t) for c, t in new.items() if c not in types]
    out += [(c, RESTORED, types[c], t) for c, t in new.items() if c in types and c not in present and types[c] == t]
    out += [(c, RETYPED, types[c], t) for c, t in new.items() if c in types and types[c] != t]
    out += [(c, REMOVED, types[c], None) for c in types if c in present and c not in new]
    return sorted(out)


def follow(declared: T.StructType, now: T.StructType) -> T.StructType:
    """The declared columns with the files' types, then the files' new columns."""
    new = {f.name: f for f in now}
    kept = [T.StructField(f.name, new[f.name].dataType if f.name in new else f.dataType) for f in declared]
    return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in now if f.name not in set(declared.names)])


def _columns(fields) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _generation(spark: SparkSession, folder: str) -> tuple[int, T.StructType, set[str]]:
    """(number, declared schema, columns in the files) of the last registration; 0 before the first."""
    known = sorted(int(n) for n, _, _ in list_folder(spark, folder) if n.isdigit())
    if not known:
        return 0, T.StructType(), set()
    told = json.loads(read_small(spark, f"{folder}/{known[-1]:06d}"))
    return known[-1], T.StructType.fromJson(told["declared"]), set(told["present"])


def register(spark: SparkSession, zone: str, tables: dict[str, str], history: str) -> DataFrame:
    """One database per zone and one external table per folder; the log rows of what changed since the last registration.

    A first registration logs every column as added. The change is applied to the catalog, then logged, then the
    generation is written: a run that dies in between finds the same changes again.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {zone}")
    rows = []
    for name, location in tables.items():
        fq, folder = f"{zone}.{name}", f"{history}/schemas/{zone}.{name}"
        now = spark.read.option("mergeSchema", "true").parquet(location).schema
        number, declared, present = _generation(spark, folder)
        changes, table = schema_changes(declared, present, now), follow(declared, now)
        known = spark.catalog.tableExists(fq)
        if known and any(c[1] == RETYPED for c in changes):
            spark.sql(f"DROP TABLE {fq}")  # external: the definition alone
            known = False
        if not known:
            spark.sql(f"CREATE TABLE {fq} ({_columns(table)}) USING parquet LOCATION '{location}'")
        elif missing := [f for f in table if f.name not in spark.table(fq).columns]:
            spark.sql(f"ALTER TABLE {fq} ADD COLUMNS ({_columns(missing)})")
        spark.catalog.refreshTable(fq)
        if changes or not number:
            rows += [(zone, name, number + 1, *c) for c in changes]
            log = spark.createDataFrame([(zone, name, number + 1, *c) for c in changes], LOG)
            log.coalesce(1).write.mode("overwrite").parquet(f"{history}/log/{zone}.{name}/generacion={number + 1}")
            write_small(spark, f"{folder}/{number + 1:06d}", json.dumps(
                {"declared": json.loads(table.json()), "present": sorted(now.names)}))
    return spark.createDataFrame(rows, LOG)


def read_log(spark: SparkSession, zone: str, table: str, history: str) -> DataFrame:
    """All logged changes of a table."""
    folders = [f"{history}/log/{zone}.{table}/{n}" for n, _, _ in list_folder(spark, f"{history}/log/{zone}.{table}")]
    return spark.read.schema(LOG).parquet(*folders)
