"""Registered queries of what is stored and merged, followed or thinned out: sketches (A11, Q7), schema history (K8),
date projection (K7), curve points (C13), hashed categories (M2)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.operators import quality as oq
from tidewater.operators import sketches as sk
from tidewater.operators import stats as st
from tidewater.operators.uplift import collision_share, preprocessor
from tidewater.plans import oracle as o
from tidewater.plans.queries_causal import r, rounded, scored_test
from tidewater.plans.queries_clean import silver_zone
from tidewater.plans.queries_gold import gold
from tidewater.plans.queries_uplift import DATES, dated_scores
from tidewater.session import Params, checkpoint_dir

Q: dict = {}
SQL: dict = {}
P = Params()


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _folder(spark):
    return f"{checkpoint_dir(spark).rstrip('/')}/stored_{uuid.uuid4().hex}"


MEDIANS = ["n_transacciones_total", "monto_total"]
PROBS = [0.25, 0.5, 0.75]


@register("pilot_summary_sketch", o.sql_for(["g_360"], " UNION ALL ".join(f"""
SELECT grupo_piloto, '{c}' AS columna, count({c}) AS n, {p} AS p, TRUE AS dentro_de_cota FROM g_360
GROUP BY grupo_piloto HAVING count({c}) > 0""" for c in MEDIANS for p in ("CAST(0.25 AS DOUBLE)", "CAST(0.5 AS DOUBLE)", "CAST(0.75 AS DOUBLE)"))))
def pilot_summary_sketch(spark, sf):
    """Quartiles per pilot group from sketches stored by the customers' year of registration, against exact ranks.

    One year is stored twice, as a load that is repeated. Twice the sketch's error bound holds in all but one of some 10 million cases.
    """
    g, path = gold(spark, sf), _folder(spark)
    year = F.year("fecha_registro")
    sk.store(sk.quantile_sketches(g, ["grupo_piloto"], year, MEDIANS), path)
    sk.store(sk.quantile_sketches(g.where(year == 1997), ["grupo_piloto"], year, MEDIANS), path)
    estimates = sk.quantiles(spark.read.parquet(path), ["grupo_piloto"], PROBS)
    gaps = sk.rank_gaps(g.select("grupo_piloto", *MEDIANS), ["grupo_piloto"], estimates)
    return gaps.select("grupo_piloto", "columna", "n", "p", (F.col("distancia") <= 2 * sk.quantile_rank_error()).alias("dentro_de_cota"))


_TX = ["transaccion_id", "cliente_id", "comercio_codigo", "tipo_transaccion"]


@register("cardinality_sketch", o.sql_for(["s_transacciones"], " UNION ALL ".join(
    f"SELECT '{c}' AS columna, count(DISTINCT {c}) AS n_distintos, TRUE AS dentro_de_cota FROM s_transacciones" for c in _TX)))
def cardinality_sketch(spark, sf):
    """Q7: distinct values of the whole history from sketches stored by month, within 4 standard errors of the exact number."""
    tx, path = silver_zone(spark, sf)["transacciones"].valid, _folder(spark)
    sk.store(sk.distinct_sketches(tx, F.date_format("fecha", "yyyy-MM"), _TX), path)
    exact = oq.cardinality_profile(tx, _TX)
    near = F.abs(F.col("n_estimado") - F.col("n_distintos")) <= 4 * sk.distinct_error() * F.col("n_distintos")
    return exact.join(sk.distinct_counts(spark.read.parquet(path)), "columna").select("columna", "n_distintos", near.alias("dentro_de_cota"))


@register("zone_schema_history", o.sql_for(["g_360"], """
SELECT c.*, CASE c.columna WHEN 'cliente_id' THEN n_cliente WHEN 'grupo_piloto' THEN n_grupo
  WHEN 'monto_total' THEN 0 WHEN 'edad' THEN n_edad ELSE n_tx END AS n_valores
FROM (SELECT count(cliente_id) AS n_cliente, count(grupo_piloto) AS n_grupo, count(edad) AS n_edad,
             count(n_transacciones_total) AS n_tx FROM g_360), (VALUES (1, 'cliente_id', 'agregada', NULL, 'string'), (1, 'grupo_piloto', 'agregada', NULL, 'string'),
  (1, 'monto_total', 'agregada', NULL, 'double'), (1, 'n_transacciones_total', 'agregada', NULL, 'bigint'),
  (2, 'monto_total', 'eliminada', 'double', NULL), (2, 'edad', 'agregada', NULL, 'bigint'),
  (2, 'n_transacciones_total', 'cambio_de_tipo', 'bigint', 'double')) AS c(generacion, columna, cambio, antes, despues)"""))
def zone_schema_history(spark, sf):
    """K8: two generations of the gold table in one folder; the log of both, with the values that each column now has."""
    from tidewater.sources import catalog
    from tidewater.sources.io import write_full
    base, zone, g = _folder(spark), f"zona_{uuid.uuid4().hex[:12]}", gold(spark, sf)
    for table in (g.select("cliente_id", "grupo_piloto", "monto_total", "n_transacciones_total"),
                  g.select("cliente_id", "grupo_piloto", F.col("n_transacciones_total").cast("double"), "edad")):
        write_full(table, f"{base}/cliente_360")
        catalog.register(spark, zone, {"cliente_360": f"{base}/cliente_360"}, f"{base}/historia")
    t = spark.table(f"{zone}.cliente_360")
    counts = t.agg(*[F.count(c).alias(c) for c in t.columns]).unpivot([], t.columns, "columna", "n_valores")
    log = catalog.read_log(spark, zone, "cliente_360", f"{base}/historia").drop("zona", "tabla")
    return log.join(counts, "columna")


@register("scores_by_projection", o.sql_for(["u_dated"], f"""
SELECT dt, count(*) AS n, count(DISTINCT cliente_id) AS n_clientes FROM u_dated
WHERE dt BETWEEN '{DATES[1]}' AND '{DATES[2]}' GROUP BY dt"""))
def scores_by_projection(spark, sf):
    """K7: the scores of a date range, whose folders are named from the range instead of listed."""
    from tidewater.sources.io import read_dates, write_by_date
    path, scores = _folder(spark), dated_scores(spark, sf)
    write_by_date(scores, path)
    part = read_dates(spark, path, scores.schema, DATES[1], DATES[2])
    return part.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cliente_id").alias("n_clientes"))


POINTS = 20


@register("qini_points", o.sql_for(["c_qini"], f"""
SELECT {r('cum_n / n_total', 'fraccion')}, {r('qini', 'qini')}, {r('aleatorio', 'aleatorio')} FROM (
  SELECT *, row_number() OVER (PARTITION BY cum_n * {POINTS} // n_total ORDER BY cum_n DESC) AS place FROM c_qini) WHERE place = 1"""))
def qini_points(spark, sf):
    """The curve in at most 21 points."""
    return rounded(st.qini_points(scored_test(spark, sf), "score_uplift", "aumento_uso", "tratado", POINTS))


BUCKETS = 1 << 12


@register("hashed_categories", o.sql_for(["g_360"], """
SELECT count(*) AS filas, count(*) AS filas_completas, TRUE AS choques_en_cota FROM g_360"""))
def hashed_categories(spark, sf):
    """M2: national ids (as many as customers) and cities hashed to 4,096 columns: each row has both its labels in them, and no
    more ids than expected share a column (6 standard deviations)."""
    from pyspark.ml.functions import vector_to_array
    g = gold(spark, sf).withColumn("uno", F.lit(1.0))
    x = preprocessor(["uno"], ["cedula", "ciudad"], BUCKETS).fit(g).transform(g).select("cedula", vector_to_array("_hash").alias("h"))
    ids = g.select("cedula").where("cedula IS NOT NULL").distinct().withColumns({"uno": F.lit(1.0), "ciudad": F.lit("-")})
    place = preprocessor(["uno"], ["cedula"], BUCKETS).fit(ids).transform(ids).select(
        F.array_position(vector_to_array("_hash"), 1.0).alias("place"))
    shared = place.groupBy("place").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("shared"))
    n, met = shared.first()
    share = collision_share(n, BUCKETS)
    fair = abs(met - n * share) <= 6 * (2 * n * max(share * (1 - share), 1.0 / n)) ** 0.5
    whole = F.aggregate("h", F.lit(0.0), lambda a, v: a + v) == 2.0
    return x.agg(F.count(F.lit(1)).alias("filas"), F.count_if(whole).alias("filas_completas"), F.lit(fair).alias("choques_en_cota"))
