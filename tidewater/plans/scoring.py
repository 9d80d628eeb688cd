"""Training, scoring, publishing and lookup plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.segments import (PERSUADABLE, SEGMENTS, SURE_THING, describe_segment, reason_text,
                                          segment)
from tidewater.operators import stats as st
from tidewater.operators.uplift import UpliftModel, fit_tlearner
from tidewater.plans import causal as pcz
from tidewater.session import Params, materialize
from tidewater.sources import snapshots

SCORE_COLS = ["cliente_id", "score_uplift", "p_tratamiento", "p_control", "segmento_uplift",
              "razones_principales", "version_modelo"]


def with_segments(scored: DataFrame, params: Params = Params(), version: str | None = None) -> DataFrame:
    """F18 + F19 + the model version literal."""
    return scored.withColumns({
        "segmento_uplift": segment("p_tratamiento", "p_control", params.segment_threshold),
    }).withColumns({
        "razones_principales": reason_text("segmento_uplift", "p_tratamiento", "p_control"),
        "version_modelo": F.lit(version or params.model_version),
    })


def train_and_evaluate(gold: DataFrame, tx: DataFrame, params: Params = Params(), calibrated: bool = False):
    """C1 -> P11 -> U3 -> M1-M4 -> M5, C12, C14 on the test rows. Returns (model, metrics row, balance)."""
    panel = pcz.complete_cases(pcz.model_panel(gold, tx, params), params.numeric_features)
    # stratified by arm x outcome with exact quotas, as the reference's split
    panel = materialize(pcz.split_flag_quota(panel, ["tratado", "aumento_uso"], params=params))
    train, test = panel.filter(~F.col("en_test")), panel.filter(F.col("en_test"))
    model = fit_tlearner(train, params)
    # The forests pass over the test rows once. Metrics are those of the scores that get published (raw by
    # default); the same on the calibrated scale go by their own names.
    scored = materialize(model.transform(test, calibrated).select(
        "cliente_id", "tratado", "aumento_uso", "p_tratamiento", "p_control", "score_uplift", "p_tratamiento_otra",
        "p_control_otra"))
    auc_t = st.auc(scored.filter(F.col("tratado") == 1), "p_tratamiento", "aumento_uso").first()["auc"]
    auc_c = st.auc(scored.filter(F.col("tratado") == 0), "p_control", "aumento_uso").first()["auc"]
    ate = st.ate_interval(scored, "aumento_uso", "tratado", "p_tratamiento", "p_control").first()
    other = st.ate_interval(scored, "aumento_uso", "tratado", "p_tratamiento_otra", "p_control_otra").first()
    qini = st.qini_score(scored, "score_uplift", "aumento_uso", "tratado").first()["qini_score"]
    rates = pcz.crude_uplift(scored).first()
    counts = panel.groupBy("en_test").count().collect()
    n = {r["en_test"]: r["count"] for r in counts}
    metrics = {"n_train": n.get(False, 0), "n_test": n.get(True, 0), "auc_control": auc_c,
               "auc_tratamiento": auc_t, "ate": ate["ate"], "ate_lb": ate["ate_lb"], "ate_ub": ate["ate_ub"],
               "escala": "calibrada" if calibrated else "cruda", "ate_otra_escala": other["ate"], "qini_score": qini, "tasa_aumento_control": rates["tasa_control"],
               "tasa_aumento_tratamiento": rates["tasa_tratado"], "version_modelo": params.model_version}
    balance = st.covariate_balance(panel, list(params.numeric_features), "tratado")
    return model, metrics, balance, scored


def score_population(model: UpliftModel, gold: DataFrame, params: Params = Params(),
                     calibrated: bool = False) -> DataFrame:
    """M7: score the untreated population (NULL features are imputed, not dropped), segment, explain."""
    pop = gold.filter(F.col("grupo_piloto") == params.scoring_group)
    s = model.transform(pop, calibrated=calibrated)
    return with_segments(s, params).select(*SCORE_COLS)


def imputed_share(population: DataFrame, features) -> DataFrame:
    """V7: customers scored, and how many of them miss at least one feature, which scoring imputes."""
    missing = F.greatest(*[F.col(f).isNull().cast("int") for f in features])
    return population.agg(F.count(F.lit(1)).alias("n"), F.sum(missing).cast("long").alias("n_imputados"),
                          F.avg(missing).alias("proporcion_imputada"))


def current_run(latest: DataFrame, fecha: str, order: str = "dt") -> DataFrame:
    """Of the latest table only the customers that the run of ``fecha`` scored."""
    return latest.where(F.col(order) == fecha)


def latest_per_key(scores: DataFrame, key: str = "cliente_id", order: str = "dt") -> DataFrame:
    """The row with the greatest ``order`` per key, as a partial aggregate (``max_by``).

    No window buffer per key: a key with a third of all rows folds map-side.
    Numbers are rounded to 6 places as on the serving copy.
    """
    others = [c for c in scores.columns if c != key]
    best = scores.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_s")).select(key, "_s.*")
    return best.withColumns({c: F.round(c, 6) for c in ("score_uplift", "p_tratamiento", "p_control")
                             if c in best.columns})


def merge_latest(latest: DataFrame, run: DataFrame, key: str = "cliente_id", order: str = "dt") -> DataFrame:
    """K4 as an upsert: the latest table with one run's rows put in, a full join of two tables unique by key.

    Of two rows of a key the one with the greater ``order`` stays (the run's of equals); the history of earlier
    runs is not read. Numbers are rounded to 6 places as on the serving copy.
    """
    run = run.withColumns({c: F.round(c, 6) for c in ("score_uplift", "p_tratamiento", "p_control") if c in run.columns})
    others = [c for c in run.columns if c != key]
    a = latest.select(F.col(key).alias("_ka"), F.struct(*others).alias("_a"))
    b = run.select(F.col(key).alias("_kb"), F.struct(*others).alias("_b"))
    newer = F.col("_a").isNull() | (F.col(f"_b.{order}") >= F.col(f"_a.{order}"))
    row = F.when(F.col("_b").isNotNull() & newer, F.col("_b")).otherwise(F.col("_a"))
    return (a.join(b, F.col("_ka") == F.col("_kb"), "full")
            .select(F.coalesce("_ka", "_kb").alias(key), row.alias("_s")).select(key, "_s.*"))


def lookup(requests: DataFrame, latest: DataFrame, key: str = "cliente_id") -> DataFrame:
    """Batch lookup of requested keys with a found flag and the segment description."""
    j = requests.select(key).distinct().join(latest, key, "left")
    return j.withColumns({"encontrado": F.col("segmento_uplift").isNotNull(),
                          "segmento_descripcion": F.when(F.col("segmento_uplift").isNotNull(),
                                                         describe_segment("segmento_uplift"))})


def publish_latest(spark: SparkSession, root: str, run: DataFrame, key: str = "cliente_id") -> snapshots.Version:
    """K4: the latest-score table with one run's rows put in, published as a new snapshot of ``root``."""
    upsert = lambda before: merge_latest(run.limit(0) if before is None else before, run, key)
    return snapshots.publish(spark, root, upsert, key)


def published_latest(spark: SparkSession, root: str) -> DataFrame | None:
    """The latest-score table that was published last, None if there is none."""
    return snapshots.read(spark, root)


def lookup_published(requests: DataFrame, root: str, key: str = "cliente_id",
                     pushed_keys: int = snapshots.PUSHED_KEYS) -> DataFrame:
    """``lookup`` in the published table, of which only what may hold the requested keys is read."""
    found = snapshots.find(requests.sparkSession, root, requests, pushed_keys)
    if found is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return lookup(requests, found, key)


def budget_topk(scores: DataFrame, k: int) -> DataFrame:
    """Persuadables first, then sure things, by score; sleeping dogs and lost causes never.

    ``orderBy(...).limit(k)`` plans as a distributed top-k (per-partition top k, then merge).
    """
    pri = F.when(F.col("segmento_uplift") == PERSUADABLE, 1).otherwise(2)
    return (scores.filter(F.col("segmento_uplift").isin(PERSUADABLE, SURE_THING))
            .orderBy(pri, F.desc("score_uplift"), "cliente_id").limit(k))


def segment_distribution(scores: DataFrame) -> DataFrame:
    """Customers per segment in the fixed order, zero-filled, with shares."""
    return st.ordered_distribution(scores, "segmento_uplift", SEGMENTS)
