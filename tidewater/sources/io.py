"""Scans, sinks and catalog registration.

Reads stay lazy: ``read_table`` only resolves the schema, so Catalyst can push
filters and prune columns into the Parquet scan of whatever plan uses it.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumns(ValueError):
    pass


def table_path(sf_dir: str, name: str) -> str:
    """Where a table lies: ``<folder>/<name>.parquet`` (a file or a folder), in any store Spark reads."""
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               required: Iterable[str] = (), merge_schema: bool = False) -> DataFrame:
    """K1: Parquet scan of one table (file or folder), schema from the files.

    ``required`` columns are checked up front so a wrong input fails at plan
    time instead of deep inside a job. Extra columns pass through.
    """
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
    df = reader.parquet(table_path(sf_dir, name))
    require(df, required, name)
    return df


def require(df: DataFrame, cols: Iterable[str], what: str = "input") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns(f"{what}: missing columns {missing}")
    return df


def write_full(df: DataFrame, path: str) -> None:
    """K2: full refresh of one folder."""
    df.write.mode("overwrite").parquet(path)


def write_quarantine(rejected: DataFrame, path: str, reason_col: str = "motivo_descarte") -> None:
    """K3: rejected rows, one sub-folder per reason; always rewritten as a whole.

    The overwrite is static whatever the session says: a reason that no longer
    occurs must not leave its old folder behind.
    """
    (rejected.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(reason_col).parquet(path))


def write_by_date(df: DataFrame, path: str, date_col: str = "dt") -> None:
    """K5: date-partitioned sink; re-running a date replaces only that date.

    Needs ``spark.sql.sources.partitionOverwriteMode=dynamic`` (set per write).
    """
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(date_col).parquet(path))


SCORES_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
  cliente_id STRING,
  score_uplift DOUBLE,
  p_tratamiento DOUBLE,
  p_control DOUBLE,
  segmento_uplift STRING,
  razones_principales STRING,
  version_modelo STRING,
  dt STRING)
USING parquet
PARTITIONED BY (dt)
LOCATION '{location}'
"""


def register_scores_table(spark: SparkSession, name: str, location: str) -> DataFrame:
    """K6/K7: explicit-schema external table partitioned by ``dt``.

    New ``dt=`` folders are picked up with ``MSCK REPAIR``-free discovery by
    ``RECOVER PARTITIONS``; filters on ``dt`` prune directories.
    """
    spark.sql(SCORES_DDL.format(name=name, location=location))
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def read_dates(spark: SparkSession, path: str, schema, start: str, end: str, step_days: int = 1,
               date_col: str = "dt") -> DataFrame:
    """K7: the rows of a date range of a date-partitioned folder, without listing the other dates.

    The folders are named from the range (``start`` to ``end``, both included, every ``step_days``); absent dates are skipped. ``schema``
    is that of the files, without ``date_col``, which comes back as a string.
    """
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    days = [first + dt.timedelta(days=k) for k in range(0, (last - first).days + 1, step_days)]
    present = [d for d in (f"{path.rstrip('/')}/{date_col}={day.isoformat()}" for day in days) if folder_exists(spark, d)]
    whole = T.StructType([f for f in schema.fields if f.name != date_col] + [T.StructField(date_col, T.StringType())])
    if not present:
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).option("basePath", path).parquet(*present)


def register_zone(spark: SparkSession, zone: str, tables: dict[str, str]) -> list[str]:
    """K8: one database per zone and one external table per folder.

    Schemas are read from the files with ``mergeSchema`` so added columns show
    up. ``catalog.register`` does the same with a history of schemas and a log of changes.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {zone}")
    made = []
    for name, location in tables.items():
        fq = f"{zone}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {fq}")
        spark.sql(f"CREATE TABLE {fq} USING parquet OPTIONS (mergeSchema 'true') LOCATION '{location}'")
        made.append(fq)
    return made


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """One-row metrics document written as JSON beside the model."""
    spark.createDataFrame([metrics]).coalesce(1).write.mode("overwrite").json(path)


def write_table_csv(df: DataFrame, path: str) -> None:
    """Small result table (e.g. covariate balance) as CSV with header."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def schema_report(df: DataFrame) -> list[tuple[str, str]]:
    """Q11: (column, type) pairs of a DataFrame (metadata only, no job)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def read_json_metrics(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in any store that Spark reaches."""
    fs, p = _folder(spark, path)
    return fs.exists(p)


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time in ms) of a folder's entries, [] if there is none."""
    fs, p = _folder(spark, path)
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)) if fs.exists(p) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def write_small(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """A short text (a version, a pointer) as one file, in any store that Spark reaches."""
    fs, p = _folder(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name that must be free; False if it is taken. One step in stores that rename in one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, there = _folder(spark, target)
    fs.mkdirs(there.getParent())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(there.toUri(), conf)
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    from py4j.protocol import Py4JJavaError
    try:
        files.rename(jvm.org.apache.hadoop.fs.Path(source), there, plain)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of ``write_small``, None if there is no such file."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


__all__ = ["read_table", "require", "write_full", "write_quarantine", "write_by_date",
           "register_scores_table", "register_zone", "write_metrics", "write_table_csv", "schema_report", "F"]
