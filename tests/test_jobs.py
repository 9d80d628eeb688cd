"""The four jobs end to end on sf0.001, through written folders only."""

import tempfile

from pyspark.sql import functions as F

from tidewater.plans import jobs
from tidewater.plans.scoring import published_latest
from tidewater.session import Params
from tidewater.sources.bronze import bronze_tables
from tidewater.sources.io import read_json_metrics, register_scores_table, register_zone

SF = "/root/testdata/sf0.001"


def test_pipeline_end_to_end(spark):
    base = tempfile.mkdtemp(prefix="tw-jobs-")
    rep = {r.tabla: r for r in jobs.standardize(spark, bronze_tables(spark, SF), f"{base}/silver",
                                                 f"{base}/quarantine").collect()}
    assert rep["transacciones"].filas_cuarentena > 0 and rep["clientes"].filas_cuarentena == 0
    reasons = {r[0] for r in spark.read.parquet(f"{base}/quarantine/transacciones")
               .select("motivo_descarte").distinct().collect()}
    assert reasons == {"cliente_id_huerfano", "monto_negativo_invalido"}

    dist = {r.grupo_piloto: r.n_clientes for r in jobs.enrich(spark, f"{base}/silver", f"{base}/gold").collect()}
    assert sum(dist.values()) == spark.read.parquet(f"{base}/silver/clientes").count()
    assert spark.read.parquet(f"{base}/gold/piloto_pilot_summary").count() == len(dist)

    p = Params(n_trees=5, max_depth=3)
    metrics = jobs.train(spark, f"{base}/gold", f"{base}/silver", f"{base}/models", p)
    assert metrics["n_train"] > 0 and metrics["n_test"] > 0
    assert read_json_metrics(spark, f"{base}/models/metricas_uplift")["n_test"] == metrics["n_test"]
    assert spark.read.option("header", "true").csv(f"{base}/models/balance_covariables").count() == 8

    for day in ("2001-09-01", "2001-10-01", "2001-09-01"):  # re-run of a date replaces it
        seg = jobs.score(spark, f"{base}/gold", f"{base}/models", f"{base}/pred", day, p)
    assert seg.agg(F.sum("n")).first()[0] > 0
    scores = spark.read.parquet(f"{base}/pred/uplift_scores")
    per_day = {r.dt: r["count"] for r in scores.groupBy(F.col("dt").cast("string").alias("dt")).count().collect()}
    assert set(per_day) == {"2001-09-01", "2001-10-01"} and len(set(per_day.values())) == 1
    latest = published_latest(spark, f"{base}/pred/uplift_scores_latest")
    assert latest.count() == latest.select("cliente_id").distinct().count() == per_day["2001-10-01"]

    # new raw files: ingest -> enrich -> score gives what the full jobs gave
    bronze_tables(spark, SF)["transacciones"].write.parquet(f"{base}/raw")
    jobs.refresh(spark, f"{base}/raw", f"{base}/silver", f"{base}/work", f"{base}/gold2", f"{base}/models", f"{base}/pred2",
                 "2001-10-01", p)
    cols = ["cliente_id", "score_uplift", "segmento_uplift"]
    a = published_latest(spark, f"{base}/pred2/uplift_scores_latest").select(*cols)
    assert a.count() == latest.count() and a.exceptAll(latest.select(*cols)).count() == 0
    some = [r[0] for r in latest.select("cliente_id").orderBy("cliente_id").limit(3).collect()]
    got = {r.cliente_id: r.encontrado for r in jobs.lookup(spark, f"{base}/pred", [*some, "nadie"]).collect()}
    assert got == {**dict.fromkeys(some, True), "nadie": False}

    t = register_scores_table(spark, "uplift_scores_test", f"{base}/pred/uplift_scores")
    assert t.filter(F.col("dt") == "2001-10-01").count() == per_day["2001-10-01"]
    made = register_zone(spark, "silver_test", {"clientes": f"{base}/silver/clientes"})
    assert spark.table(made[0]).count() == sum(dist.values())


def test_quarantine_keeps_no_stale_reason_whatever_the_session_says(spark):
    from tidewater.sources.io import write_quarantine
    path = tempfile.mkdtemp(prefix="tw-quarantine-") + "/q"
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "motivo_descarte string, x int")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for n in (2, 1, 0):
            write_quarantine(rows.limit(n), path)
            assert spark.read.schema(rows.schema).parquet(path).count() == n
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)


def test_no_local_checkpoint_folder_on_a_cluster(spark, monkeypatch):
    import pytest

    from tidewater import session

    class Other:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Other)


def test_staged_tables_are_deleted_when_a_job_is_done(spark, monkeypatch):
    from tidewater import session
    from tidewater.sources.io import folder_exists
    monkeypatch.setattr(session, "_STAGED", [])
    assert session.materialize(spark.range(3)).count() == 3
    path = session._STAGED[0]
    assert folder_exists(spark, path) and session.drop_staged(spark) == 1 and not folder_exists(spark, path)


def test_changed_inputs_give_new_zones(spark):
    from tidewater.plans import zones
    base = tempfile.mkdtemp(prefix="tw-zone-")
    spark.range(3).write.parquet(f"{base}/t.parquet")
    first = zones._fingerprint(spark, base)
    assert first == zones._fingerprint(spark, f"file://{base}/")
    spark.range(3).write.mode("append").parquet(f"{base}/t.parquet")
    assert zones._fingerprint(spark, base) != first


def test_ingest_and_training_flags(spark, monkeypatch, capsys):
    base = tempfile.mkdtemp(prefix="tw-ingest-")
    b = bronze_tables(spark, SF)
    b["transacciones"].write.parquet(f"{base}/raw")
    jobs.standardize(spark, b, f"{base}/silver", f"{base}/quarantine")
    monkeypatch.setattr(jobs, "get_session", lambda *a, **k: spark)
    jobs.main(["ingest", "--raw", f"{base}/raw", "--silver", f"{base}/silver", "--work", f"{base}/work"])
    got = spark.read.parquet(f"{base}/work/valid").drop("batch", "_fila")
    want = spark.read.parquet(f"{base}/silver/transacciones")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    seen = {}
    monkeypatch.setattr(jobs, "train", lambda s, g, v, m, params: seen.update(p=params) or {})
    jobs.main(["train", "--gold", "g", "--silver", "s", "--model-dir", "m", "--pre-start", "2025-01-01", "--cut", "2026-05-01"])
    assert (seen["p"].pre_start, seen["p"].cut, seen["p"].post_end) == ("2025-01-01", "2026-05-01", Params.post_end)


def test_a_job_drops_the_tables_of_its_own_block_and_thread_only(spark):
    import os
    import threading

    from tidewater import session
    path = lambda df: df.inputFiles()[0].removeprefix("file:").replace("///", "/").rsplit("/", 1)[0]
    before = session.materialize(spark.range(3))
    with session.staged_tables() as own:
        mine = session.materialize(spark.range(4))
        others = []
        t = threading.Thread(target=lambda: others.append(session.materialize(spark.range(5))))
        t.start()
        t.join()
        with session.staged_tables() as inner:
            session.materialize(spark.range(6))
        assert len(own) == 2 and own[1:] == inner
        at = path(mine)
        assert os.path.exists(at)
        session.drop_tables(spark, own)
    session.materialize(spark.range(7))
    assert len(own) == 2
    assert not os.path.exists(at) and before.count() == 3 and others[0].count() == 5
