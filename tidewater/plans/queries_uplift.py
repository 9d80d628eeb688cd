"""Registered uplift queries: segments, reasons, distribution, top-k, serving tables, and the model."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.functions.segments import DESCRIPTIONS, REASONS, SEGMENTS
from tidewater.plans import causal as pcz
from tidewater.plans import oracle as o
from tidewater.plans import scoring as ps
from tidewater.plans.queries_causal import cc_panel, data, r, rounded
from tidewater.plans.queries_gold import gold
from tidewater.session import Params, checkpoint_dir, materialize

Q: dict = {}
SQL: dict = {}
P = Params()
DATES = ["2000-09-01", "2001-04-01", "2001-09-01"]  # the last transactions fall around these
ACTIVE_DAYS = 360


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- SQL helpers

def seg_sql(pt: str, pc: str) -> str:
    return (f"CASE WHEN {pt} >= 0.5 AND NOT ({pc} >= 0.5) THEN 'persuadible' WHEN {pt} >= 0.5 AND {pc} >= 0.5 "
            f"THEN 'sure_thing' WHEN NOT ({pt} >= 0.5) AND NOT ({pc} >= 0.5) THEN 'lost_cause' ELSE 'sleeping_dog' END")


def pct_sql(p: str, signed: bool = False) -> str:
    fmt = "%+d%%" if signed else "%d%%"
    return f"printf('{fmt}', CAST(round_even({p} * 100, 0) AS BIGINT))"


def reason_sql(seg: str, pt: str, pc: str) -> str:
    subs = {"{c}": pct_sql(pc), "{t}": pct_sql(pt), "{g}": pct_sql(f"({pt} - {pc})", signed=True)}
    whens = []
    for name in SEGMENTS:
        txt = "'" + REASONS[name].replace("'", "''") + "'"
        for k, v in subs.items():
            txt = txt.replace(k, f"' || {v} || '")
        whens.append(f"WHEN '{name}' THEN {txt}")
    return f"CASE {seg} {' '.join(whens)} END"


def hash_sql(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5('{salt}:' || {key}), 1, 8))::BIGINT % 10000) / CAST(10000.0 AS DOUBLE)"


_f = "coalesce(feat_frecuencia_mensual, CAST(0 AS DOUBLE))"
_m = "coalesce(feat_monto_mensual, CAST(0 AS DOUBLE))"
o.cte("u_heur0", ["g_360"], f"""
SELECT cliente_id, {_f} / ({_f} + CAST(0.15 AS DOUBLE)) AS p_tratamiento,
  {_m} / ({_m} + CAST(45000.0 AS DOUBLE)) AS p_control
FROM g_360 WHERE grupo_piloto = '{P.scoring_group}'""")
o.cte("u_heur", ["u_heur0"], f"""
SELECT *, p_tratamiento - p_control AS score_uplift, {seg_sql('p_tratamiento', 'p_control')} AS segmento_uplift
FROM u_heur0""")
_dated = " UNION ALL ".join(
    f"SELECT cliente_id, {hash_sql('cliente_id', 't' + d)} AS p_tratamiento, {hash_sql('cliente_id', 'c' + d)} AS p_control, "
    f"'{d}' AS dt FROM g_360 WHERE grupo_piloto = '{P.scoring_group}' AND (ultima_transaccion IS NULL OR (ultima_transaccion < DATE '{d}' AND ultima_transaccion >= DATE '{d}' - {ACTIVE_DAYS}))"
    for d in DATES)
o.cte("u_dated0", ["g_360"], _dated)
o.cte("u_dated", ["u_dated0"], f"""
SELECT cliente_id, p_tratamiento - p_control AS score_uplift, p_tratamiento, p_control,
  {seg_sql('p_tratamiento', 'p_control')} AS segmento_uplift,
  {reason_sql(seg_sql('p_tratamiento', 'p_control'), 'p_tratamiento', 'p_control')} AS razones_principales,
  'referencia_v1' AS version_modelo, dt FROM u_dated0""")
o.cte("u_latest", ["u_dated"], """
SELECT cliente_id, round(score_uplift, 6) AS score_uplift, round(p_tratamiento, 6) AS p_tratamiento,
  round(p_control, 6) AS p_control, segmento_uplift, razones_principales, version_modelo, dt
FROM (SELECT *, row_number() OVER (PARTITION BY cliente_id ORDER BY dt DESC) AS rn FROM u_dated) WHERE rn = 1""")


def heuristic_population(spark, sf):
    pop = gold(spark, sf).filter(F.col("grupo_piloto") == P.scoring_group)
    return ps.with_segments(pcz.heuristic_scores(pop), P)


def stand_in_scores(gold_table, dt):
    """Hash-made scores of one date for the customers whose last transaction lies in the ``ACTIVE_DAYS`` before it.

    Customers without a transaction are in at each date; others come and go, as their own data say.
    """
    last, day = F.col("ultima_transaccion"), F.lit(dt).cast("date")
    active = last.isNull() | ((last < day) & (last >= F.date_sub(day, ACTIVE_DAYS)))
    pop = gold_table.filter((F.col("grupo_piloto") == P.scoring_group) & active)
    s = pop.select("cliente_id", pcz.hash_unit(F.col("cliente_id"), f"t{dt}").alias("p_tratamiento"),
                   pcz.hash_unit(F.col("cliente_id"), f"c{dt}").alias("p_control"))
    s = s.withColumn("score_uplift", F.col("p_tratamiento") - F.col("p_control"))
    return ps.with_segments(s, P, "referencia_v1").select(*ps.SCORE_COLS).withColumn("dt", F.lit(dt))


def dated_scores(spark, sf):
    g = gold(spark, sf)
    out = None
    for d in DATES:
        s = stand_in_scores(g, d)
        out = s if out is None else out.unionByName(s)
    return out


# ---------------------------------------------------------------- queries

@register("uplift_segments", o.sql_for(["u_heur"], f"""
SELECT cliente_id, {r('p_tratamiento', 'p_tratamiento')}, {r('p_control', 'p_control')},
  {r('score_uplift', 'score_uplift')}, segmento_uplift FROM u_heur"""))
def uplift_segments(spark, sf):
    h = heuristic_population(spark, sf)
    return rounded(h.select("cliente_id", "p_tratamiento", "p_control", "score_uplift", "segmento_uplift"))


@register("reason_text", o.sql_for(["u_heur"], f"""
SELECT cliente_id, segmento_uplift, {reason_sql('segmento_uplift', 'p_tratamiento', 'p_control')} AS razones_principales
FROM u_heur"""))
def reason_text_q(spark, sf):
    return heuristic_population(spark, sf).select("cliente_id", "segmento_uplift", "razones_principales")


_order_vals = ", ".join(f"('{s}', {i + 1})" for i, s in enumerate(SEGMENTS))


@register("segment_distribution", o.sql_for(["u_heur"], f"""
SELECT g.segmento_uplift, g.orden, coalesce(c.n, 0) AS n, coalesce(c.n, 0) / (SELECT count(*) FROM u_heur) AS proporcion
FROM (VALUES {_order_vals}) AS g(segmento_uplift, orden)
LEFT JOIN (SELECT segmento_uplift, count(*) AS n FROM u_heur GROUP BY 1) c ON g.segmento_uplift = c.segmento_uplift"""))
def segment_distribution(spark, sf):
    return ps.segment_distribution(heuristic_population(spark, sf))


@register("budget_topk", o.sql_for(["u_heur"], f"""
SELECT cliente_id, segmento_uplift, {r('score_uplift', 'score_uplift')} FROM u_heur
WHERE segmento_uplift IN ('persuadible', 'sure_thing')
ORDER BY CASE WHEN segmento_uplift = 'persuadible' THEN 1 ELSE 2 END, score_uplift DESC, cliente_id LIMIT 100"""))
def budget_topk(spark, sf):
    """The next wave's 100 cards (k is the budget: a top-k report)."""
    t = ps.budget_topk(heuristic_population(spark, sf), 100)
    return rounded(t.select("cliente_id", "segmento_uplift", "score_uplift"))


@register("latest_scores", o.sql_for(["u_latest"], "SELECT * FROM u_latest"))
def latest_scores(spark, sf):
    """K4: one upsert per date into the latest table, as the daily job does."""
    g = gold(spark, sf)
    runs = [stand_in_scores(g, d) for d in DATES]
    latest = runs[0].limit(0)
    for run in runs:
        latest = ps.merge_latest(latest, run)
    return latest


_desc = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in DESCRIPTIONS.items())


@register("score_lookup", o.sql_for(["g_360", "u_latest"], f"""
SELECT q.cliente_id, l.score_uplift, l.p_tratamiento, l.p_control, l.segmento_uplift, l.razones_principales,
  l.version_modelo, l.dt, l.segmento_uplift IS NOT NULL AS encontrado,
  CASE WHEN l.segmento_uplift IS NOT NULL THEN coalesce(CASE l.segmento_uplift {_desc} END, '') END
    AS segmento_descripcion
FROM (SELECT DISTINCT cliente_id FROM g_360) q LEFT JOIN u_latest l ON q.cliente_id = l.cliente_id"""))
def score_lookup(spark, sf):
    """Every customer of the gold table looked up against the latest scores."""
    return ps.lookup(gold(spark, sf).select("cliente_id"), ps.latest_per_key(dated_scores(spark, sf)))


def _published(spark, sf):
    """Root of a latest-score table into which every date's run was published in turn."""
    root = _folder(spark)
    for d in DATES:
        ps.publish_latest(spark, root, stand_in_scores(gold(spark, sf), d))
    return root


@register("published_latest", o.sql_for(["u_latest"], "SELECT * FROM u_latest"))
def published_latest(spark, sf):
    """K4: the serving table after three runs, each published as a snapshot; two of them have expired."""
    from tidewater.sources.snapshots import expire
    root = _published(spark, sf)
    expire(spark, root, keep=1)
    return ps.published_latest(spark, root)


@register("campaign_lookup", o.sql_for(["u_heur", "u_latest"], f"""
SELECT q.cliente_id, l.score_uplift, l.p_tratamiento, l.p_control, l.segmento_uplift, l.razones_principales,
  l.version_modelo, l.dt, l.segmento_uplift IS NOT NULL AS encontrado,
  CASE WHEN l.segmento_uplift IS NOT NULL THEN coalesce(CASE l.segmento_uplift {_desc} END, '') END
    AS segmento_descripcion
FROM (SELECT cliente_id FROM u_heur WHERE segmento_uplift IN ('persuadible', 'sure_thing')
      ORDER BY CASE WHEN segmento_uplift = 'persuadible' THEN 1 ELSE 2 END, score_uplift DESC, cliente_id LIMIT 100) q
LEFT JOIN u_latest l ON q.cliente_id = l.cliente_id"""))
def campaign_lookup(spark, sf):
    """The customers of the budgeted wave (O5) looked up in the published table by their keys."""
    asked = ps.budget_topk(heuristic_population(spark, sf), 100).select("cliente_id")
    return ps.lookup_published(asked, _published(spark, sf))


@register("published_lookup", o.sql_for(["g_360", "u_latest"], f"""
SELECT q.cliente_id, l.score_uplift, l.dt, l.segmento_uplift IS NOT NULL AS encontrado
FROM (SELECT DISTINCT cliente_id FROM g_360) q LEFT JOIN u_latest l ON q.cliente_id = l.cliente_id"""))
def published_lookup(spark, sf):
    """Every customer looked up in the published table, bucket by bucket."""
    found = ps.lookup_published(gold(spark, sf).select("cliente_id"), _published(spark, sf))
    return found.select("cliente_id", "score_uplift", "dt", "encontrado")


@register("scores_by_date", o.sql_for(["u_dated"], "SELECT * FROM u_dated WHERE dt = '2001-04-01'"))
def scores_by_date(spark, sf):
    """K5 + K7: write scores partitioned by ``dt`` to the shared folder, read back one date (pruned)."""
    from tidewater.sources.io import write_by_date
    path = f"{checkpoint_dir(spark)}/uplift_scores_{uuid.uuid4().hex[:8]}"
    write_by_date(dated_scores(spark, sf), path)
    return spark.read.parquet(path).filter(F.col("dt") == "2001-04-01") \
        .withColumn("dt", F.col("dt").cast("string"))


def _trained(spark, sf):
    from tidewater.plans.zones import model_zone
    model, metrics, _, scored = model_zone(spark, sf, P)
    return gold(spark, sf), model, metrics, scored


@register("tlearner_train")
def tlearner_train(spark, sf):
    """Train the two forests and report test metrics (one row)."""
    _, _, metrics, _ = _trained(spark, sf)
    return spark.createDataFrame([metrics])


@register("tlearner_score")
def tlearner_score(spark, sf):
    """Raw and calibrated scores of the untreated population with segments and reasons."""
    g, model, _, _ = _trained(spark, sf)
    return materialize(ps.score_population(model, g, P))  # a scoring job's written rows


@register("effect_importance")
def effect_importance(spark, sf):
    """M8: importance of encoded features for the individual effect (surrogate forest)."""
    from tidewater.operators.uplift import effect_importance as ei
    _, model, _, _ = _trained(spark, sf)
    panel = pcz.split_flag_quota(cc_panel(spark, sf), ["tratado", "aumento_uso"]).filter(F.col("en_test"))
    return ei(model, model.transform(panel), P)


@register("tlearner_score_calibrated")
def tlearner_score_calibrated(spark, sf):
    """M6b + M7: scores with the per-arm class weights undone (true-probability scale)."""
    g, model, _, _ = _trained(spark, sf)
    return materialize(ps.score_population(model, g, P, calibrated=True))


@register("quadrant_table")
def quadrant_table(spark, sf):
    """M9: customers per uplift quadrant of the forest scores, fixed order, with shares."""
    g, model, _, _ = _trained(spark, sf)
    return ps.segment_distribution(materialize(ps.score_population(model, g, P).select("segmento_uplift")))


_cc = "(SELECT count(*) FROM c_cc)"
_pop = f"(SELECT count(*) FROM g_360 WHERE grupo_piloto = '{P.scoring_group}')"


@register("model_invariants", o.sql_for(["g_360", "c_cc", "c_split"], f"""
SELECT 'filas_entrenamiento' AS medida, (SELECT count(*) FROM c_split WHERE NOT en_test) AS n UNION ALL
SELECT 'filas_prueba', (SELECT count(*) FROM c_split WHERE en_test) UNION ALL
SELECT 'metricas_en_rango', 1 UNION ALL
SELECT 'clientes_puntuados', {_pop} UNION ALL SELECT 'diferencia_exacta', {_pop} UNION ALL
SELECT 'probabilidades_en_rango', {_pop} UNION ALL SELECT 'segmento_coincide', {_pop} UNION ALL
SELECT 'calibracion_coincide', {_pop} UNION ALL SELECT 'clientes_en_cuadrantes', {_pop} UNION ALL
SELECT 'cuadrantes', 4 UNION ALL SELECT 'importancias_suman_uno', 1"""))
def model_invariants(spark, sf):
    """M1-M9: what must hold of the trained learner's metrics, scores, calibration, quadrants and importances."""
    g, model, metrics, _ = _trained(spark, sf)
    spark_rows = [("filas_entrenamiento", metrics["n_train"]), ("filas_prueba", metrics["n_test"]),
                  ("metricas_en_rango", int(0 <= metrics["auc_control"] <= 1 and 0 <= metrics["auc_tratamiento"] <= 1
                                            and metrics["ate_lb"] <= metrics["ate"] <= metrics["ate_ub"]))]
    pop = g.filter(F.col("grupo_piloto") == P.scoring_group)
    columns = ["score_uplift", "p_tratamiento", "p_control", "p_tratamiento_otra", "segmento_uplift"]
    s = materialize(ps.with_segments(model.transform(pop), P).select(*columns))  # counted twice, scored once
    pt, pc = F.col("p_tratamiento"), F.col("p_control")
    fair = F.try_divide(pt * model.meta["pi_t"], pt * model.meta["pi_t"] + (1 - pt) * (1 - model.meta["pi_t"]))
    named = F.concat(F.when(pt >= P.segment_threshold, "t").otherwise("-"), F.when(pc >= P.segment_threshold, "c").otherwise("-"))
    names = {"t-": "persuadible", "tc": "sure_thing", "--": "lost_cause", "-c": "sleeping_dog"}
    right = F.coalesce(*[F.when(named == k, F.col("segmento_uplift") == v) for k, v in names.items()])
    counted = s.agg(F.count(F.lit(1)).alias("clientes_puntuados"),
                    F.count_if(F.abs(F.col("score_uplift") - (pt - pc)) < 1e-12).alias("diferencia_exacta"),
                    F.count_if(pt.between(0, 1) & pc.between(0, 1)).alias("probabilidades_en_rango"),
                    F.count_if(right).alias("segmento_coincide"),
                    F.count_if(F.abs(F.col("p_tratamiento_otra") - fair) < 1e-12).alias("calibracion_coincide"))
    counted = counted.unpivot([], counted.columns, "medida", "n")
    quadrants = ps.segment_distribution(s).agg(F.sum("n").alias("clientes_en_cuadrantes"), F.count(F.lit(1)).alias("cuadrantes"))
    quadrants = quadrants.unpivot([], quadrants.columns, "medida", "n")
    shares = Q["effect_importance"](spark, sf).agg(F.lit("importancias_suman_uno").alias("medida"), (
        F.abs(F.sum("importancia") - 1) < 1e-9).cast("long").alias("n"))
    return spark.createDataFrame(spark_rows, "medida string, n long").unionByName(counted).unionByName(quadrants).unionByName(shares)


def _folder(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/roundtrip_{uuid.uuid4().hex}"


@register("imputed_share", o.sql_for(["g_360"], f"""
SELECT count(*) AS n, CAST(sum(m) AS BIGINT) AS n_imputados, {r('avg(m)', 'proporcion_imputada')} FROM (
  SELECT CASE WHEN {' OR '.join(f'{f} IS NULL' for f in P.numeric_features)} THEN 1 ELSE 0 END AS m
  FROM g_360 WHERE grupo_piloto = '{P.scoring_group}')"""))
def imputed_share(spark, sf):
    """V7: the share of scored customers with an imputed feature."""
    pop = gold(spark, sf).filter(F.col("grupo_piloto") == P.scoring_group)
    return rounded(ps.imputed_share(pop, P.numeric_features))


@register("current_run_scores", o.sql_for(["u_latest"], f"SELECT * FROM u_latest WHERE dt = '{DATES[2]}'"))
def current_run_scores(spark, sf):
    """The latest table without customers that the run of one date did not score."""
    return ps.current_run(latest_scores(spark, sf), DATES[2])


@register("zone_roundtrip", o.sql_for(["g_360"], "SELECT cliente_id, grupo_piloto, monto_total FROM g_360"))
def zone_roundtrip(spark, sf):
    """K2 + K8: the gold table written twice to one folder, registered in a zone and read back by SQL."""
    from tidewater.sources.io import register_zone, write_full
    path, zone = _folder(spark), f"zona_{uuid.uuid4().hex[:12]}"
    for _ in range(2):
        write_full(gold(spark, sf).select("cliente_id", "grupo_piloto", "monto_total"), path)
    (table,) = register_zone(spark, zone, {"cliente_360": path})
    return spark.sql(f"SELECT cliente_id, grupo_piloto, monto_total FROM {table}")


@register("scores_table_roundtrip", o.sql_for(["u_dated"], "SELECT dt, count(*) AS n FROM u_dated GROUP BY dt"))
def scores_table_roundtrip(spark, sf):
    """K5 + K6: every date written, one date again, then read through the registered table."""
    from tidewater.sources.io import register_scores_table, write_by_date
    path = _folder(spark)
    write_by_date(dated_scores(spark, sf), path)
    write_by_date(stand_in_scores(gold(spark, sf), DATES[1]), path)
    t = register_scores_table(spark, f"puntajes_{uuid.uuid4().hex[:12]}", path)
    return t.groupBy(F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))


@register("metrics_roundtrip", o.sql_for(["g_360"], """
SELECT grupo_piloto, count(*) AS n FROM g_360 GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM g_360"""))
def metrics_roundtrip(spark, sf):
    """A metrics document (JSON) and a small table (CSV) written and read back."""
    from tidewater.sources.io import read_json_metrics, write_metrics, write_table_csv
    base, g = _folder(spark), gold(spark, sf)
    write_table_csv(g.groupBy("grupo_piloto").agg(F.count(F.lit(1)).alias("n")), f"{base}/tabla")
    write_metrics(spark, {"n": g.count()}, f"{base}/metricas")
    back = spark.read.option("header", "true").schema("grupo_piloto string, n long").csv(f"{base}/tabla")
    n = read_json_metrics(spark, f"{base}/metricas")["n"]
    return back.unionByName(spark.createDataFrame([("total", n)], "grupo_piloto string, n long"))


@register("model_roundtrip", o.sql_for(["g_360"], f"SELECT cliente_id FROM g_360 WHERE grupo_piloto = '{P.scoring_group}'"))
def model_roundtrip(spark, sf):
    """Customers whose score is the same by the learner and by its saved and loaded copy (all of them)."""
    from tidewater.operators.uplift import UpliftModel
    g, model, _, _ = _trained(spark, sf)
    path = _folder(spark)
    model.save(spark, path)
    pop = g.filter(F.col("grupo_piloto") == P.scoring_group)
    a = materialize(model.transform(pop).select("cliente_id", F.col("score_uplift").alias("a")))
    b = materialize(UpliftModel.load(spark, path).transform(pop).select("cliente_id", F.col("score_uplift").alias("b")))
    return a.join(b, "cliente_id").where("a = b").select("cliente_id")
