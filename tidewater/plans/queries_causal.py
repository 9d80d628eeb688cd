"""Registered causal-analysis queries (C1-C16, U2, U3, M3, M5) with closed-form SQL twins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import stats as st
from tidewater.operators.exact import mann_whitney_exact, wilcoxon_exact
from tidewater.plans import causal as pcz
from tidewater.plans import oracle as o
from tidewater.plans.queries_clean import silver_zone
from tidewater.plans.queries_gold import gold
from tidewater.plans import gold as pg
from tidewater.session import Params

Q: dict = {}
SQL: dict = {}
P = Params()
NUM = list(P.numeric_features)
DIGITS = 9


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Presentation: round double columns so float summation order cannot change a value hash."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def r(expr: str, alias: str) -> str:
    return f"round({expr}, {DIGITS}) AS {alias}"


def erfc_sql(x: str) -> str:
    """erfc by Simpson's rule over its integral exp(-z^2) 2/sqrt(pi) int_0^8 exp(-s^2 - 2zs) ds: not the plan's method."""
    z, n, h = f"abs({x})", 4000, 0.002
    term = f"(CASE WHEN i = 0 OR i = {n} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-(i * {h}) * (i * {h}) - 2 * {z} * i * {h})"
    tail = f"(2 / sqrt(pi()) * exp(-{z} * {z}) * list_sum([{term} for i in range(0, {n} + 1)]) * {h} / 3)"
    return f"(CASE WHEN {x} >= 0 THEN {tail} ELSE 2.0 - {tail} END)"


SQRT2 = f"CAST({math.sqrt(2.0)!r} AS DOUBLE)"


def data(spark, sf):
    """Gold and silver transactions as written zone tables."""
    return gold(spark, sf), silver_zone(spark, sf)["transacciones"].valid


def cc_panel(spark, sf):
    g, tx = data(spark, sf)
    return pcz.complete_cases(pcz.model_panel(g, tx), NUM)


STRATA = ["tratado", "aumento_uso"]


def scored_test(spark, sf):
    p = pcz.heuristic_scores(pcz.split_flag_quota(cc_panel(spark, sf), STRATA))
    return p.filter(F.col("en_test"))


# ---------------------------------------------------------------- SQL building blocks
_days_pre = P.days(P.pre_start, P.cut) / 30.44
_days_post = P.days(P.cut, P.post_end) / 30.44
o.cte("c_cust", ["g_360"], f"""
SELECT *, CAST(grupo_piloto = '{P.treated_group}' AS INTEGER) AS tratado FROM g_360
WHERE grupo_piloto IN ('{P.treated_group}', '{P.control_group}') AND fecha_registro < DATE '{P.pre_start}'""")
o.cte("c_counts", ["s_transacciones", "c_cust"], f"""
SELECT cliente_id, count_if(fecha < DATE '{P.cut}') AS pre, count_if(fecha >= DATE '{P.cut}') AS post
FROM s_transacciones WHERE fecha >= DATE '{P.pre_start}' AND fecha < DATE '{P.post_end}'
  AND cliente_id IN (SELECT cliente_id FROM c_cust)
GROUP BY cliente_id""")
o.cte("c_panel", ["c_cust", "c_counts"], """
SELECT c.*, coalesce(k.pre, 0) AS pre, coalesce(k.post, 0) AS post,
  CAST(coalesce(k.post, 0) > coalesce(k.pre, 0) AS INTEGER) AS aumento_uso
FROM c_cust c LEFT JOIN c_counts k ON c.cliente_id = k.cliente_id""")
o.cte("c_cc", ["c_panel"], "SELECT * FROM c_panel WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in NUM))
o.cte("c_split_hash", ["c_cc"], f"""
SELECT *, ('0x' || substr(md5('{P.seed}:' || cliente_id), 1, 8))::BIGINT % 10000 < 2500 AS en_test FROM c_cc""")
o.cte("c_split", ["c_cc"], f"""
SELECT c.* EXCLUDE (_h), c._h <= t.thr AS en_test
FROM (SELECT *, ('0x' || substr(md5('{P.seed}:' || cliente_id), 1, 8))::BIGINT AS _h FROM c_cc) c
JOIN (SELECT tratado, aumento_uso,
             quantile_disc(('0x' || substr(md5('{P.seed}:' || cliente_id), 1, 8))::BIGINT, {P.test_fraction}) AS thr
      FROM c_cc GROUP BY 1, 2) t ON c.tratado = t.tratado AND c.aumento_uso = t.aumento_uso""")
o.cte("c_scored", ["c_split"], """
SELECT *, feat_frecuencia_mensual / (feat_frecuencia_mensual + CAST(0.15 AS DOUBLE)) AS p_tratamiento,
  feat_monto_mensual / (feat_monto_mensual + CAST(45000.0 AS DOUBLE)) AS p_control,
  feat_frecuencia_mensual / (feat_frecuencia_mensual + CAST(0.15 AS DOUBLE))
    - feat_monto_mensual / (feat_monto_mensual + CAST(45000.0 AS DOUBLE)) AS score_uplift
FROM c_split""")
o.cte("c_test", ["c_scored"], "SELECT * FROM c_scored WHERE en_test")
o.cte("c_did", ["c_cust", "c_counts"], f"""
SELECT c.cliente_id, c.tratado, coalesce(k.pre, 0) / CAST({_days_pre!r} AS DOUBLE) AS frecuencia_pre,
  coalesce(k.post, 0) / CAST({_days_post!r} AS DOUBLE) AS frecuencia_post
FROM c_cust c LEFT JOIN c_counts k ON c.cliente_id = k.cliente_id""")


def ranks_sql(src: str, value: str, counts: dict[str, str]) -> str:
    """Distinct values with n, extra sums and average rank (DuckDB window over the whole input)."""
    extra = "".join(f", sum({e}) AS {k}" for k, e in counts.items())
    return (f"SELECT *, (sum(n) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n) "
            f"+ (n + 1) / 2.0 AS avg_rank FROM (SELECT {value} AS v, count(*) AS n{extra} FROM {src} "
            f"WHERE {value} IS NOT NULL GROUP BY 1)")


def mw_sql(feature: str) -> str:
    src = (f"(SELECT {feature}, CAST(grupo_piloto = '{P.treated_group}' AS BIGINT) AS g FROM g_360 "
           f"WHERE grupo_piloto IN ('{P.treated_group}', '{P.control_group}'))")
    rk = ranks_sql(src, feature, {"n1": "g"})
    u = "(r1 - n1 * (n1 + 1) / 2.0)"
    var = "(n1 * (n - n1) / 12.0 * ((n + 1) - ties / (n * (n - 1.0))))"
    z = f"(({u} - n1 * (n - n1) / 2.0 - 0.5) / sqrt({var}))"
    return (f"SELECT '{feature}' AS feature, n1, n - n1 AS n2, {r(u, 'u')}, {r(z, 'z')}, "
            f"{r(f'0.5 * {erfc_sql(f"{z} / {SQRT2}")}', 'p_value')} FROM ("
            f"SELECT CAST(sum(n1 * avg_rank) AS DOUBLE) AS r1, CAST(sum(n1) AS BIGINT) AS n1, CAST(sum(n) AS BIGINT) AS n, "
            f"sum(CAST(n AS DOUBLE) * n * n - n) AS ties FROM ({rk}))")


def wx_sql(metric: str, post: str, pre: str) -> str:
    src = (f"(SELECT abs({post} - {pre}) AS a, CAST({post} - {pre} > 0 AS BIGINT) AS pos FROM g_360 "
           f"WHERE grupo_piloto = '{P.treated_group}' AND " + " AND ".join(f"{c} IS NOT NULL" for c in
                                                                           ["frecuencia_mensual_pre",
                                                                            "frecuencia_mensual_post",
                                                                            "monto_mensual_pre",
                                                                            "monto_mensual_post"])
           + f" AND {post} - {pre} <> 0)")
    rk = ranks_sql(src, "a", {"n_pos": "pos"})
    w = "least(r_mas, r_menos)"
    z = f"(({w} - n * (n + 1) / 4.0) / sqrt(n * (n + 1.0) * (2 * n + 1) / 24.0 - ties / 48.0))"
    return (f"SELECT '{metric}' AS metrica, n, {r('r_mas', 'r_mas')}, {r('r_menos', 'r_menos')}, "
            f"{r(w, 'estadistico')}, {r(z, 'z')}, {r(erfc_sql(f'abs({z}) / {SQRT2}'), 'p_value')} FROM ("
            f"SELECT CAST(sum(n_pos * avg_rank) AS DOUBLE) AS r_mas, CAST(sum((n - n_pos) * avg_rank) AS DOUBLE) AS r_menos, "
            f"CAST(sum(n) AS BIGINT) AS n, sum(CAST(n AS DOUBLE) * n * n - n) AS ties FROM ({rk}))")


def auc_sql(arm: int, score: str) -> str:
    rk = ranks_sql(f"(SELECT {score}, CAST(aumento_uso AS BIGINT) AS y FROM c_test WHERE tratado = {arm})",
                   score, {"n_pos": "y"})
    return (f"SELECT {arm} AS tratado, n_pos, n - n_pos AS n_neg, "
            f"{r('(r1 - n_pos * (n_pos + 1) / 2.0) / (n_pos * (n - n_pos))', 'auc')} FROM ("
            f"SELECT CAST(sum(n_pos * avg_rank) AS DOUBLE) AS r1, CAST(sum(n_pos) AS BIGINT) AS n_pos, "
            f"CAST(sum(n) AS BIGINT) AS n FROM ({rk}))")


EXACT_ROWS = 20


def exact_sql(src: str, of_size: bool, alternative: str) -> str:
    """Per group ``k`` of (k, x, g): n, n1 and r2 (doubled rank sum of g = 1) and p by counting subsets of the ranks, one rank a
    step of a recursion. Takes the place of a CTE list: rk, grp, dp, fin."""
    width, size = ("n * (n + 1) + 1", "n1 + 1") if of_size else ("n * (n + 1) + 1", "1")
    back, inside = ("w + r", "p > w AND (p - 1) % w >= r") if of_size else ("r", "p - 1 >= r")
    upper = "list_sum(c[r2 + 1:]) / list_sum(c)"
    lower = "list_sum(c[:r2 + 1]) / list_sum(c)"
    p = {"greater": upper, "two-sided": f"least(1.0, 2.0 * least({upper}, {lower}))"}[alternative]
    return f"""
rk AS (SELECT k, g, 2 * rank() OVER (PARTITION BY k ORDER BY x) - 1 + count(*) OVER (PARTITION BY k, x) AS r2,
         row_number() OVER (PARTITION BY k ORDER BY x) AS i FROM {src}),
grp AS (SELECT k, count(*) AS n, CAST(sum(g) AS BIGINT) AS n1, CAST(sum(g * r2) AS BIGINT) AS r2 FROM rk GROUP BY k),
dp(k, i, n, w, st) AS (
  SELECT k, 0, n, {width}, list_transform(range(({size}) * ({width})), lambda j: CASE WHEN j = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
  FROM grp WHERE n <= {EXACT_ROWS}
  UNION ALL
  SELECT dp.k, dp.i + 1, dp.n, dp.w, list_transform(range(1, len(st) + 1), lambda p: st[p] + CASE WHEN {inside.replace("r", "rk.r2")}
    THEN st[p - ({back.replace("r", "rk.r2")})] ELSE 0.0::DOUBLE END)
  FROM dp JOIN rk ON rk.k = dp.k AND rk.i = dp.i + 1),
fin AS (SELECT grp.*, {p} AS p FROM grp LEFT JOIN
  (SELECT dp.k, {"st[grp.n1 * w + 1:(grp.n1 + 1) * w]" if of_size else "st"} AS c FROM dp JOIN grp ON grp.k = dp.k WHERE dp.i = dp.n) d
  ON d.k = grp.k)"""


def recursive(deps: list[str], ctes: str, select: str) -> str:
    """``sql_for`` with CTEs of the query's own, one of them recursive."""
    return o.sql_for(deps, "-- own" + ctes + select).replace("WITH ", "WITH RECURSIVE ", 1).replace("\n-- own", ",", 1)


# ---------------------------------------------------------------- queries

@register("exact_amount_shift", recursive(["s_transacciones"], f"""
v AS (SELECT cliente_id AS k, monto AS x, CAST(fecha >= DATE '{P.cut}' AS BIGINT) AS g FROM s_transacciones
      WHERE monto IS NOT NULL AND fecha IS NOT NULL),""" + exact_sql("v", True, "greater"), f"""
SELECT k AS cliente_id, n1, n - n1 AS n2, CAST(r2 / 2.0 - n1 * (n1 + 1) / 2.0 AS DOUBLE) AS u,
  {r("CASE WHEN n1 > 0 AND n1 < n THEN p END", "p_value")} FROM fin"""))
def exact_amount_shift(spark, sf):
    """C7 exact: per customer, are amounts from the cut on larger than before? (customers of up to 20 amounts)"""
    _, tx = data(spark, sf)
    v = tx.where("monto IS NOT NULL AND fecha IS NOT NULL")
    return rounded(mann_whitney_exact(v, ["cliente_id"], "monto", F.col("fecha") >= F.lit(P.cut).cast("date"),
                                      max_rows=EXACT_ROWS))


@register("exact_frequency_shift", recursive(["g_360"], f"""
v AS (SELECT coalesce(ciudad, '-') || '|' || coalesce(canal_adquisicion, '-') AS k,
        abs(frecuencia_mensual_post - frecuencia_mensual_pre) AS x,
        CAST(frecuencia_mensual_post > frecuencia_mensual_pre AS BIGINT) AS g FROM g_360
      WHERE grupo_piloto = '{P.treated_group}' AND frecuencia_mensual_post <> frecuencia_mensual_pre),"""
    + exact_sql("v", False, "two-sided"), f"""
SELECT k AS segmento, n, CAST(r2 / 2.0 AS DOUBLE) AS r_mas, CAST(n * (n + 1) / 2.0 - r2 / 2.0 AS DOUBLE) AS r_menos,
  {r("p", "p_value")} FROM fin"""))
def exact_frequency_shift(spark, sf):
    """C6 exact: per city and channel, did the monthly frequency of treated customers change? (up to 20 of them)"""
    g, _ = data(spark, sf)
    t = g.where(F.col("grupo_piloto") == P.treated_group).withColumn("segmento", F.concat_ws(
        "|", F.coalesce("ciudad", F.lit("-")), F.coalesce("canal_adquisicion", F.lit("-"))))
    return rounded(wilcoxon_exact(t, ["segmento"], "frecuencia_mensual_post", "frecuencia_mensual_pre", max_rows=EXACT_ROWS))


@register("treated_control_panel", o.sql_for(["c_panel"], """
SELECT cliente_id, grupo_piloto, tratado, pre, post, aumento_uso FROM c_panel"""))
def treated_control_panel(spark, sf):
    g, tx = data(spark, sf)
    return pcz.model_panel(g, tx).select("cliente_id", "grupo_piloto", "tratado", "pre", "post", "aumento_uso")


_bal = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, avg(CASE WHEN tratado = 1 THEN CAST({f} AS DOUBLE) END) AS mt, "
    f"avg(CASE WHEN tratado = 0 THEN CAST({f} AS DOUBLE) END) AS mc, "
    f"var_samp(CASE WHEN tratado = 1 THEN CAST({f} AS DOUBLE) END) AS vt, "
    f"var_samp(CASE WHEN tratado = 0 THEN CAST({f} AS DOUBLE) END) AS vc FROM c_cc" for f in NUM)
o.cte("c_balance", ["c_cc"], f"""
SELECT feature, mt AS media_tratado, mc AS media_control,
  CASE WHEN sqrt((vt + vc) / 2) > 0 THEN (mt - mc) / sqrt((vt + vc) / 2) END AS smd
FROM ({_bal})""")


@register("covariate_balance", o.sql_for(["c_balance"], f"""
SELECT feature, {r('media_tratado', 'media_tratado')}, {r('media_control', 'media_control')}, {r('smd', 'smd')}
FROM c_balance"""))
def covariate_balance(spark, sf):
    return rounded(st.covariate_balance(cc_panel(spark, sf), NUM, "tratado"))


@register("imbalance_alert", o.sql_for(["c_balance"], f"""
SELECT feature, {r('media_tratado', 'media_tratado')}, {r('media_control', 'media_control')}, {r('smd', 'smd')},
  {r('abs(smd)', 'abs_smd')},
  CASE WHEN smd IS NULL THEN 'indeterminado' WHEN abs(smd) > {P.smd_alert} THEN 'grande'
       WHEN abs(smd) > 0.1 THEN 'moderado' ELSE 'bueno' END AS nivel,
  coalesce(abs(smd) > {P.smd_alert}, FALSE) AS alerta
FROM c_balance ORDER BY abs(smd) ASC NULLS LAST, feature"""))
def imbalance_alert(spark, sf):
    b = st.covariate_balance(cc_panel(spark, sf), NUM, "tratado")
    return rounded(st.imbalance_levels(b, P.smd_alert))


@register("adoption_funnel", o.sql_for(["g_360"], """
SELECT count(*) AS n_clientes, count_if(tiene_tarjeta_fisica) AS n_recibio_fisica, count_if(fisica_activada) AS n_activo,
  count_if(tiene_tarjeta_fisica) / count(*) AS pct_recibio,
  CASE WHEN count_if(tiene_tarjeta_fisica) > 0 THEN count_if(fisica_activada) / count_if(tiene_tarjeta_fisica) END
    AS pct_activo
FROM g_360"""))
def adoption_funnel(spark, sf):
    return pcz.adoption_funnel(gold(spark, sf))


_pp = ["frecuencia_mensual_pre", "frecuencia_mensual_post", "monto_mensual_pre", "monto_mensual_post"]


@register("pre_post_means", o.sql_for(["g_360"], f"""
SELECT n, {', '.join(r(c, c) for c in _pp)},
  {r('CASE WHEN frecuencia_mensual_pre = 0 THEN NULL ELSE (frecuencia_mensual_post / frecuencia_mensual_pre - 1.0) * 100.0 END', 'pct_cambio_frecuencia')},
  {r('CASE WHEN monto_mensual_pre = 0 THEN NULL ELSE (monto_mensual_post / monto_mensual_pre - 1.0) * 100.0 END', 'pct_cambio_monto')}
FROM (SELECT count(*) AS n, {', '.join(f'avg({c}) AS {c}' for c in _pp)} FROM g_360
      WHERE grupo_piloto = '{P.treated_group}' AND {' AND '.join(f'{c} IS NOT NULL' for c in _pp)})"""))
def pre_post_means(spark, sf):
    return rounded(pcz.pre_post_means(gold(spark, sf)))


@register("wilcoxon_paired", o.sql_for(["g_360"], wx_sql("frecuencia_mensual", "frecuencia_mensual_post",
                                                          "frecuencia_mensual_pre")
                                       + " UNION ALL " + wx_sql("monto_mensual", "monto_mensual_post",
                                                                 "monto_mensual_pre")))
def wilcoxon_paired(spark, sf):
    a = pcz.activated_complete(gold(spark, sf))
    out = None
    for metric in ("frecuencia_mensual", "monto_mensual"):
        w = st.wilcoxon_signed_rank(a, f"{metric}_post", f"{metric}_pre").select(F.lit(metric).alias("metrica"), "*")
        out = w if out is None else out.unionByName(w)
    return rounded(out)


@register("mann_whitney", o.sql_for(["g_360"], mw_sql("feat_frecuencia_mensual") + " UNION ALL "
                                    + mw_sql("feat_monto_mensual")))
def mann_whitney(spark, sf):
    g = gold(spark, sf).filter(F.col("grupo_piloto").isin(P.treated_group, P.control_group))
    out = None
    for f in ("feat_frecuencia_mensual", "feat_monto_mensual"):
        m = st.mann_whitney(g.select(f, "grupo_piloto"), f, F.col("grupo_piloto") == P.treated_group)
        m = m.select(F.lit(f).alias("feature"), "*")
        out = m if out is None else out.unionByName(m)
    return rounded(out)


@register("did_panel", o.sql_for(["c_did"], f"""
SELECT cliente_id, tratado, {r('frecuencia_pre', 'frecuencia_pre')}, {r('frecuencia_post', 'frecuencia_post')}
FROM c_did"""))
def did_panel(spark, sf):
    g, tx = data(spark, sf)
    return rounded(pcz.did_panel(g, tx))


@register("did_means", o.sql_for(["c_did"], f"""
SELECT tratado, count(*) AS n, {r('avg(frecuencia_pre)', 'frecuencia_pre')}, {r('avg(frecuencia_post)', 'frecuencia_post')}
FROM c_did GROUP BY tratado"""))
def did_means(spark, sf):
    g, tx = data(spark, sf)
    return rounded(pcz.did_means(pcz.did_panel(g, tx)))


_cells = ", ".join(
    f"count_if(t = {a} AND p = {b}) AS n{a}{b}, avg(CASE WHEN t = {a} AND p = {b} THEN y END) AS m{a}{b}, "
    f"var_pop(CASE WHEN t = {a} AND p = {b} THEN y END) AS v{a}{b}" for a in (0, 1) for b in (0, 1))
_coef = "((m11 - m10) - (m01 - m00))"
_nobs = "CAST(n00 + n01 + n10 + n11 AS DOUBLE)"
_se = f"sqrt({_nobs} / ({_nobs} - 4) * (v00 / n00 + v01 / n01 + v10 / n10 + v11 / n11))"


@register("did_hc1", o.sql_for(["c_did"], f"""
SELECT {r(_coef, 'coef_did')}, {r(_se, 'se_hc1')}, {r(f'{_coef} / {_se}', 'z')},
  {r(erfc_sql(f'abs({_coef} / {_se}) / {SQRT2}'), 'p_value')}, CAST({_nobs} AS BIGINT) AS n_obs,
  {r('m00', 'm00')}, {r('m01', 'm01')}, {r('m10', 'm10')}, {r('m11', 'm11')}
FROM (SELECT {_cells} FROM (SELECT tratado AS t, 0 AS p, frecuencia_pre AS y FROM c_did
                            UNION ALL SELECT tratado, 1, frecuencia_post FROM c_did))"""))
def did_hc1(spark, sf):
    g, tx = data(spark, sf)
    return rounded(st.did_hc1(pcz.did_panel(g, tx), "tratado", "frecuencia_pre", "frecuencia_post"))


@register("crude_uplift", o.sql_for(["c_cc"], f"""
SELECT {r('tc', 'tasa_control')}, {r('tt', 'tasa_tratado')}, {r('tt - tc', 'diferencia')}
FROM (SELECT avg(CASE WHEN tratado = 0 THEN aumento_uso END) AS tc, avg(CASE WHEN tratado = 1 THEN aumento_uso END) AS tt
      FROM c_cc)"""))
def crude_uplift(spark, sf):
    return rounded(pcz.crude_uplift(cc_panel(spark, sf)))


@register("stratified_split", o.sql_for(["c_split_hash"], """
SELECT cliente_id, tratado, aumento_uso, en_test FROM c_split_hash"""))
def stratified_split(spark, sf):
    return pcz.split_flag(cc_panel(spark, sf)).select("cliente_id", "tratado", "aumento_uso", "en_test")


@register("stratified_split_quota", o.sql_for(["c_split"], """
SELECT cliente_id, tratado, aumento_uso, en_test FROM c_split"""))
def stratified_split_quota(spark, sf):
    """U3 exact-quota variant: 25 % test inside each arm x outcome stratum."""
    p = pcz.split_flag_quota(cc_panel(spark, sf), ["tratado", "aumento_uso"])
    return p.select("cliente_id", "tratado", "aumento_uso", "en_test")


@register("class_weights", o.sql_for(["c_split"], f"""
SELECT c.tratado, c.aumento_uso, c.n, t.n_brazo, {r('t.n_brazo / (2.0 * c.n)', 'peso')}
FROM (SELECT tratado, aumento_uso, count(*) AS n FROM c_split WHERE NOT en_test GROUP BY 1, 2) c
JOIN (SELECT tratado, count(*) AS n_brazo FROM c_split WHERE NOT en_test GROUP BY 1) t ON c.tratado = t.tratado"""))
def class_weights(spark, sf):
    train = pcz.split_flag_quota(cc_panel(spark, sf), STRATA).filter(~F.col("en_test"))
    return rounded(pcz.class_weights(train))


@register("auc_by_arm", o.sql_for(["c_test"], auc_sql(1, "p_tratamiento") + " UNION ALL " + auc_sql(0, "p_control")))
def auc_by_arm(spark, sf):
    t = scored_test(spark, sf)
    a1 = st.auc(t.filter(F.col("tratado") == 1), "p_tratamiento", "aumento_uso").select(F.lit(1).alias("tratado"), "*")
    a0 = st.auc(t.filter(F.col("tratado") == 0), "p_control", "aumento_uso").select(F.lit(0).alias("tratado"), "*")
    return rounded(a1.unionByName(a0))


_zq = "CAST(1.959963984540054 AS DOUBLE)"
_seq = "sqrt((v0 / (1 - n_t / n) + v1 / (n_t / n) + v2) / n)"


@register("ate_interval", o.sql_for(["c_test"], f"""
SELECT n, {r('ate', 'ate')}, {r(_seq, 'se')}, {r(f'ate - {_zq} * {_seq}', 'ate_lb')}, {r(f'ate + {_zq} * {_seq}', 'ate_ub')}
FROM (SELECT count(*) AS n, CAST(sum(tratado) AS DOUBLE) AS n_t, avg(p_tratamiento - p_control) AS ate,
        var_pop(CASE WHEN tratado = 0 THEN aumento_uso - p_control END) AS v0,
        var_pop(CASE WHEN tratado = 1 THEN aumento_uso - p_tratamiento END) AS v1,
        var_pop(p_tratamiento - p_control) AS v2 FROM c_test)"""))
def ate_interval(spark, sf):
    return rounded(st.ate_interval(scored_test(spark, sf), "aumento_uso", "tratado", "p_tratamiento", "p_control"))


o.cte("c_qini", ["c_test"], """
SELECT *,
  (CASE WHEN cum_n - cum_nt > 0 THEN cum_yt - cum_yc * cum_nt / (cum_n - cum_nt) ELSE 0 END) / scale AS qini,
  cum_n / n_total * (q_end / scale) AS aleatorio
FROM (SELECT *, sum(n) OVER w AS cum_n, sum(nt) OVER w AS cum_nt, sum(yt) OVER w AS cum_yt, sum(yc) OVER w AS cum_yc
      FROM (SELECT score_uplift AS s, count(*) AS n, sum(tratado) AS nt, sum(aumento_uso * tratado) AS yt,
                   sum(aumento_uso * (1 - tratado)) AS yc FROM c_test GROUP BY 1)
      WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) q,
     (SELECT n_total, q_end, CASE WHEN abs(q_end) > 0 THEN abs(q_end) ELSE 1.0 END AS scale
      FROM (SELECT count(*) AS n_total,
              CASE WHEN count(*) - sum(tratado) > 0
                   THEN sum(aumento_uso * tratado) - sum(aumento_uso * (1 - tratado)) * sum(tratado) / (count(*) - sum(tratado))
                   ELSE 0 END AS q_end FROM c_test)) tot""")


@register("qini_curve", o.sql_for(["c_qini"], f"""
SELECT {r('cum_n / n_total', 'fraccion')}, {r('qini', 'qini')}, {r('aleatorio', 'aleatorio')} FROM c_qini"""))
def qini_curve(spark, sf):
    return rounded(st.qini_curve(scored_test(spark, sf), "score_uplift", "aumento_uso", "tratado"))


@register("qini_score", o.sql_for(["c_qini"], f"""
SELECT {r('sum(n * (qini - aleatorio)) / (max(n_total) + 1)', 'qini_score')} FROM c_qini"""))
def qini_score(spark, sf):
    return rounded(st.qini_score(scored_test(spark, sf), "score_uplift", "aumento_uso", "tratado"))


@register("score_histogram", o.sql_for(["c_test"], f"""
SELECT bin, {r('mn + bin * w', 'desde')}, {r('mn + (bin + 1) * w', 'hasta')}, n FROM (
  SELECT CAST(CASE WHEN w > 0 THEN least(floor((score_uplift - mn) / w), 39) ELSE 0 END AS INTEGER) AS bin,
         any_value(mn) AS mn, any_value(w) AS w, count(*) AS n
  FROM c_test, (SELECT min(score_uplift) AS mn, (max(score_uplift) - min(score_uplift)) / 40 AS w FROM c_test)
  WHERE score_uplift IS NOT NULL GROUP BY 1)"""))
def score_histogram(spark, sf):
    return rounded(st.histogram(scored_test(spark, sf), "score_uplift", 40))


def _box_sql(f: str) -> str:
    src = (f"(SELECT grupo_piloto, {f} AS x FROM g_360 WHERE grupo_piloto IN ('{P.treated_group}', "
           f"'{P.control_group}') AND {f} IS NOT NULL)")
    return (f"SELECT '{f}' AS feature, d.grupo_piloto, q.n, {r('q.q1', 'q1')}, {r('q.mediana', 'mediana')}, "
            f"{r('q.q3', 'q3')}, {r('min(CASE WHEN d.x >= q.q1 - 1.5 * (q.q3 - q.q1) THEN d.x END)', 'bigote_inf')}, "
            f"{r('max(CASE WHEN d.x <= q.q3 + 1.5 * (q.q3 - q.q1) THEN d.x END)', 'bigote_sup')} "
            f"FROM {src} d JOIN (SELECT grupo_piloto, count(*) AS n, quantile_disc(x, 0.25) AS q1, "
            f"quantile_disc(x, 0.5) AS mediana, quantile_disc(x, 0.75) AS q3 FROM {src} GROUP BY 1) q "
            f"ON d.grupo_piloto = q.grupo_piloto GROUP BY d.grupo_piloto, q.n, q.q1, q.mediana, q.q3")


@register("box_summary", o.sql_for(["g_360"], _box_sql("feat_frecuencia_mensual") + " UNION ALL "
                                   + _box_sql("feat_monto_mensual")))
def box_summary(spark, sf):
    g = gold(spark, sf).filter(F.col("grupo_piloto").isin(P.treated_group, P.control_group))
    out = None
    for f in ("feat_frecuencia_mensual", "feat_monto_mensual"):
        b = st.box_summary(g, "grupo_piloto", f).select(F.lit(f).alias("feature"), "*")
        out = b if out is None else out.unionByName(b)
    return rounded(out)


@register("did_long", o.sql_for(["c_did"], f"""
SELECT cliente_id, tratado, periodo, {r('frecuencia', 'frecuencia')},
  CAST(periodo = 'frecuencia_post' AS INTEGER) AS post FROM (
  SELECT cliente_id, tratado, 'frecuencia_pre' AS periodo, frecuencia_pre AS frecuencia FROM c_did
  UNION ALL SELECT cliente_id, tratado, 'frecuencia_post', frecuencia_post FROM c_did)"""))
def did_long(spark, sf):
    """Melt of the DiD panel (wide -> long) with the post indicator."""
    g, tx = data(spark, sf)
    d = pcz.did_panel(g, tx)
    long = d.unpivot(["cliente_id", "tratado"], ["frecuencia_pre", "frecuencia_post"], "periodo", "frecuencia")
    return rounded(long.withColumn("post", (F.col("periodo") == "frecuencia_post").cast("int")))
