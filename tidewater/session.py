"""Session bootstrap and run parameters."""

from __future__ import annotations

import datetime as _dt
import os
import tempfile
import threading
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Params:
    """Dates and thresholds of one analysis run.

    ``as_of`` replaces the reference's ``current_date()`` so runs are repeatable.
    The panel dates define the common cut around which treated and control
    customers are compared.
    """

    as_of: str = "2001-09-01"
    pre_start: str = "1998-06-01"
    cut: str = "1999-06-01"
    post_end: str = "2000-06-01"
    treated_group: str = "fisica_activa"
    control_group: str = "solo_virtual"
    scoring_group: str = "solo_virtual"
    smd_alert: float = 0.25
    segment_threshold: float = 0.5
    test_fraction: float = 0.25
    seed: int = 42
    n_trees: int = 300
    max_depth: int = 8
    model_version: str = "tlearner_v1"
    numeric_features: tuple = (
        "feat_frecuencia_mensual",
        "feat_monto_mensual",
        "feat_pct_compra_tarjeta",
        "feat_n_categorias_comercio",
        "feat_n_interacciones_marketing",
        "feat_tasa_respuesta_marketing",
        "feat_edad",
        "feat_antiguedad_dias",
    )
    categorical_features: tuple = ("feat_ciudad", "feat_canal_adquisicion")
    category_buckets: int | None = None  # None: code lists; a number: labels are hashed to so many columns

    def days(self, a: str, b: str) -> int:
        return (_dt.date.fromisoformat(b) - _dt.date.fromisoformat(a)).days


def get_session(app: str = "tidewater", master: str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with UTC clock, ANSI mode, AQE (coalescing + skew join) and no UI.

    On a cluster ``master`` stays None so the launcher's settings win; the
    shuffle partition count is then left to AQE coalescing from the cluster
    default.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            b = b.config("spark.driver.memory", "16g")
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.ansi.enabled", "true")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staging tables, as the cluster names it in ``spark.checkpoint.dir``.

    Only in local mode, where driver and executors are one process, a scratch
    folder is made when it is unset; on a cluster that would scatter the files
    over the executors' own disks, so it is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidewater-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


_STAGED: list[str] = []
_OWN = threading.local()


def materialize(df):
    """Cut lineage by writing a Parquet table in the shared checkpoint folder and reading it back.

    Used before a table is read more than once (cut points + final pass, or
    several plan branches), so its upstream runs exactly once. Unlike
    ``checkpoint(eager=True)``, which computes the plan once to count and again
    to save Java-serialised rows, this is one columnar write. A lost executor
    re-reads the files instead of recomputing the lineage. ``drop_staged``
    deletes the tables when a job is done.
    """
    import uuid
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _STAGED.append(path)
    for own in getattr(_OWN, "scopes", ()):
        own.append(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def staged_tables():
    """The paths that this thread stages inside the block, in order, so that a job can drop its own tables and no others."""
    scopes = _OWN.__dict__.setdefault("scopes", [])
    own: list[str] = []
    scopes.append(own)
    try:
        yield own
    finally:
        scopes[:] = [x for x in scopes if x is not own]


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete these staged tables; no DataFrame that reads them may be needed any more."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    gone = set(paths)
    _STAGED[:] = [x for x in _STAGED if x not in gone]


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables that this process has staged; call it when no DataFrame that reads them is needed any more."""
    paths = list(_STAGED)
    drop_tables(spark, paths)
    return len(paths)
