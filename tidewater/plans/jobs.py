"""End-to-end jobs with command-line parameters.

    python -m tidewater.plans.jobs standardize --input DIR --output DIR --quarantine DIR
    python -m tidewater.plans.jobs enrich      --input SILVER --output GOLD
    python -m tidewater.plans.jobs train       --gold GOLD --silver SILVER --model-dir DIR
    python -m tidewater.plans.jobs score       --gold GOLD --model-dir DIR --output SCORES --fecha YYYY-MM-DD
    python -m tidewater.plans.jobs ingest      --raw DIR --silver SILVER --work DIR
    python -m tidewater.plans.jobs lookup      --output SCORES --cliente-id ID --cliente-id ID
    python -m tidewater.plans.jobs refresh     --raw DIR --silver SILVER --work DIR --gold GOLD --model-dir DIR --output SCORES

Raw inputs of ``standardize`` are the five raw tables; ``--from-test-tables``
derives them from the driver's test tables (``tidewater.sources.bronze``).
Every job reads and writes Parquet folders only; nothing passes through the
driver except one-row reports.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import Params, drop_staged, get_session

RAW_TABLES = ["clientes", "tarjetas", "transacciones", "interacciones_marketing", "catalogo_comercios"]


def standardize(spark: SparkSession, raw: dict[str, DataFrame], output: str, quarantine: str,
                params: Params = Params()) -> DataFrame:
    """Job 1: bronze -> silver + quarantine; returns the run report."""
    from tidewater.plans.clean import run_standardize
    return run_standardize(spark, raw, output, quarantine, params)


def enrich(spark: SparkSession, silver_dir: str, gold_dir: str, params: Params = Params(),
           transactions: DataFrame | None = None) -> DataFrame:
    """Job 2: silver -> gold ``cliente_360`` + ``piloto_pilot_summary``; returns the group distribution.

    ``transactions`` takes the place of the silver zone's, e.g. those that ``ingest`` keeps up to date.
    """
    from tidewater.plans.gold import customer_360, pilot_summary
    from tidewater.sources.io import write_full
    r = {t: spark.read.parquet(f"{silver_dir}/{t}") for t in RAW_TABLES if t != "transacciones" or transactions is None}
    if transactions is not None:
        r["transacciones"] = transactions
    g = customer_360(r["clientes"], r["tarjetas"], r["transacciones"], r["interacciones_marketing"],
                     r["catalogo_comercios"], params)
    write_full(g, f"{gold_dir}/cliente_360")
    gold = spark.read.parquet(f"{gold_dir}/cliente_360")
    write_full(pilot_summary(gold), f"{gold_dir}/piloto_pilot_summary")
    return gold.groupBy("grupo_piloto").agg(F.count(F.lit(1)).alias("n_clientes"))


def train(spark: SparkSession, gold_dir: str, silver_dir: str, model_dir: str, params: Params = Params()) -> dict:
    """Job 3: panel, balance, split, T-learner, metrics; saves model (K12), metrics JSON and SMD CSV."""
    from tidewater.plans.scoring import train_and_evaluate
    from tidewater.sources.io import write_metrics, write_table_csv
    gold = spark.read.parquet(f"{gold_dir}/cliente_360")
    tx = spark.read.parquet(f"{silver_dir}/transacciones")
    model, metrics, balance, _ = train_and_evaluate(gold, tx, params)
    model.save(spark, f"{model_dir}/modelo_uplift_tlearner")
    write_metrics(spark, metrics, f"{model_dir}/metricas_uplift")
    write_table_csv(balance, f"{model_dir}/balance_covariables")
    return metrics


def score(spark: SparkSession, gold_dir: str, model_dir: str, output: str, fecha: str,
          params: Params = Params(), calibrated: bool = False) -> DataFrame:
    """Job 4: score the untreated population, publish under ``dt=fecha`` (K5), refresh latest-per-key (K4)."""
    from tidewater.operators.uplift import UpliftModel
    from tidewater.plans.scoring import imputed_share, publish_latest, score_population, segment_distribution
    from tidewater.sources.io import write_by_date, write_metrics
    from tidewater.sources.snapshots import expire
    model = UpliftModel.load(spark, f"{model_dir}/modelo_uplift_tlearner")
    gold = spark.read.parquet(f"{gold_dir}/cliente_360")
    scores = score_population(model, gold, params, calibrated=calibrated).withColumn("dt", F.lit(fecha))
    write_by_date(scores, f"{output}/uplift_scores")
    population = gold.filter(F.col("grupo_piloto") == params.scoring_group)
    write_metrics(spark, imputed_share(population, params.numeric_features).first().asDict(), f"{output}/uplift_imputados")
    # the run's partition alone is read back; earlier dates stay untouched
    run = spark.read.parquet(f"{output}/uplift_scores").withColumn("dt", F.col("dt").cast("string")).filter(F.col("dt") == fecha)
    publish_latest(spark, f"{output}/uplift_scores_latest", run)
    expire(spark, f"{output}/uplift_scores_latest")
    return segment_distribution(run)


def ingest(spark: SparkSession, raw: str, silver: str, work: str) -> DataFrame:
    """New raw transaction files into the silver zone: cleaned once each, late customers' orphans taken up."""
    from tidewater.streaming.ingest import clean_transactions_stream, retest_orphans
    schema = spark.read.parquet(raw).schema
    clean_transactions_stream(spark, raw, schema, f"{silver}/clientes", work, f"{work}/checkpoint")
    retest_orphans(spark, f"{silver}/clientes", work)
    return spark.read.parquet(f"{work}/valid").groupBy("batch").agg(F.count(F.lit(1)).alias("filas"))


def refresh(spark: SparkSession, raw: str, silver: str, work: str, gold: str, model_dir: str, output: str, fecha: str,
            params: Params = Params()) -> DataFrame:
    """What new raw files set off: ingest, enrich on the ingested transactions, score and publish."""
    from tidewater.streaming.ingest import read_stream_output
    ingest(spark, raw, silver, work)
    enrich(spark, silver, gold, params, read_stream_output(spark, work))
    return score(spark, gold, model_dir, output, fecha, params)


def lookup(spark: SparkSession, output: str, ids: list[str]) -> DataFrame:
    """What is published of some customers (J13): one row an id, found or not."""
    from tidewater.plans.scoring import lookup_published
    return lookup_published(spark.createDataFrame([(i,) for i in ids], "cliente_id string"), f"{output}/uplift_scores_latest")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tidewater.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    s1 = sub.add_parser("standardize")
    s1.add_argument("--input", required=True)
    s1.add_argument("--output", required=True)
    s1.add_argument("--quarantine", required=True)
    s1.add_argument("--from-test-tables", action="store_true")
    s2 = sub.add_parser("enrich")
    s2.add_argument("--input", required=True)
    s2.add_argument("--output", required=True)
    s3 = sub.add_parser("train")
    s3.add_argument("--gold", required=True)
    s3.add_argument("--silver", required=True)
    s3.add_argument("--model-dir", required=True)
    s3.add_argument("--n-estimators", type=int, default=Params.n_trees)
    s3.add_argument("--max-depth", type=int, default=Params.max_depth)
    s3.add_argument("--test-size", type=float, default=Params.test_fraction)
    s3.add_argument("--random-state", type=int, default=Params.seed)
    for flag in ("pre-start", "cut", "post-end", "treated-group", "control-group"):
        s3.add_argument(f"--{flag}", default=getattr(Params, flag.replace("-", "_")))
    s3.add_argument("--smd-alert", type=float, default=Params.smd_alert)
    s5 = sub.add_parser("ingest")
    for flag in ("raw", "silver", "work"):
        s5.add_argument(f"--{flag}", required=True)
    s4 = sub.add_parser("score")
    s4.add_argument("--gold", required=True)
    s4.add_argument("--model-dir", required=True)
    s4.add_argument("--output", required=True)
    s4.add_argument("--fecha", default=dt.date.today().isoformat())
    s4.add_argument("--version-modelo", default=Params.model_version)
    s4.add_argument("--calibrated", action="store_true")
    s6 = sub.add_parser("refresh")
    for flag in ("raw", "silver", "work", "gold", "model-dir", "output"):
        s6.add_argument(f"--{flag}", required=True)
    s6.add_argument("--fecha", default=dt.date.today().isoformat())
    s7 = sub.add_parser("lookup")
    s7.add_argument("--output", required=True)
    s7.add_argument("--cliente-id", action="append", required=True)
    for sp in (s1, s2, s3, s4, s5, s6, s7):
        sp.add_argument("--as-of", default=Params.as_of)
        sp.add_argument("--master", default=None)
    a = p.parse_args(argv)
    params = Params(as_of=a.as_of)
    spark = get_session(f"tidewater-{a.job}", master=a.master)
    if a.job == "standardize":
        if a.from_test_tables:
            from tidewater.sources.bronze import bronze_tables
            raw = bronze_tables(spark, a.input)
        else:
            raw = {t: spark.read.parquet(f"{a.input}/{t}.parquet") for t in RAW_TABLES}
        out = standardize(spark, raw, a.output, a.quarantine, params)
        print(json.dumps([r.asDict() for r in out.collect()], ensure_ascii=False, indent=2))
    elif a.job == "enrich":
        out = enrich(spark, a.input, a.output, params)
        print(json.dumps({r["grupo_piloto"]: r["n_clientes"] for r in out.collect()}, indent=2))
    elif a.job == "train":
        params = Params(as_of=a.as_of, n_trees=a.n_estimators, max_depth=a.max_depth,
                        test_fraction=a.test_size, seed=a.random_state, pre_start=a.pre_start, cut=a.cut,
                        post_end=a.post_end, treated_group=a.treated_group, control_group=a.control_group,
                        smd_alert=a.smd_alert)
        print(json.dumps(train(spark, a.gold, a.silver, a.model_dir, params), indent=2))
    elif a.job == "lookup":
        found = lookup(spark, a.output, a.cliente_id)
        print(json.dumps([r.asDict() for r in found.collect()], ensure_ascii=False, indent=2))
    elif a.job == "ingest":
        print(json.dumps({r["batch"]: r["filas"] for r in ingest(spark, a.raw, a.silver, a.work).collect()}, indent=2))
    elif a.job == "refresh":
        out = refresh(spark, a.raw, a.silver, a.work, a.gold, a.model_dir, a.output, a.fecha, params)
        print(json.dumps([r.asDict() for r in out.collect()], indent=2))
    else:
        params = Params(as_of=a.as_of, model_version=a.version_modelo)
        out = score(spark, a.gold, a.model_dir, a.output, a.fecha, params, a.calibrated)
        print(json.dumps([r.asDict() for r in out.collect()], indent=2))
    drop_staged(spark)


if __name__ == "__main__":
    main()
