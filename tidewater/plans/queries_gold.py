"""Registered queries for the gold layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans import gold as pg
from tidewater.plans import oracle as o
from tidewater.plans.queries_clean import silver, silver_zone

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def gold(spark, sf):
    """The gold table as written once per session and input version (consumer queries)."""
    from tidewater.plans.zones import gold_zone
    return gold_zone(spark, sf)


def gold_fresh(spark, sf):
    """Gold computed in this plan from the silver zone (gold-step queries)."""
    return pg.gold_from_silver(silver_zone(spark, sf))


@register("card_aggregate", o.sql_for(["g_cards"], "SELECT *, TRUE AS tiene_alguna_tarjeta FROM g_cards"))
def card_aggregate(spark, sf):
    return pg.card_aggregate(silver_zone(spark, sf)["tarjetas"].valid)


@register("pilot_group", o.sql_for(["g_360"], """
SELECT cliente_id, grupo_piloto, dias_hasta_activacion, tiene_alguna_tarjeta, tiene_tarjeta_fisica, fisica_activada
FROM g_360"""))
def pilot_group(spark, sf):
    return gold(spark, sf).select("cliente_id", "grupo_piloto", "dias_hasta_activacion", "tiene_alguna_tarjeta",
                                  "tiene_tarjeta_fisica", "fisica_activada")


@register("category_fallback", o.sql_for(["g_txc"], """
SELECT transaccion_id, comercio_codigo, categoria_comercio FROM g_txc"""))
def category_fallback(spark, sf):
    s = silver_zone(spark, sf)
    t = s["transacciones"].valid.select("transaccion_id", "comercio_codigo")
    return pg.merchant_category(t, s["catalogo_comercios"].valid)


_TXA = ", ".join(pg.TX_COLS)
@register("transaction_aggregate", o.sql_for(["g_tx"], f"SELECT cliente_id, {_TXA} FROM g_tx"))  # noqa: E302
def transaction_aggregate(spark, sf):
    g = gold(spark, sf).filter(F.col("primera_transaccion").isNotNull() | (F.col("n_transacciones_total") > 0))
    return g.select("cliente_id", *pg.TX_COLS)


_PIV = ", ".join(f"n_{t}" for t in pg.TX_TYPES)
@register("tx_type_pivot", o.sql_for(["g_360"], f"SELECT cliente_id, {_PIV} FROM g_360"))  # noqa: E302
def tx_type_pivot(spark, sf):
    return gold(spark, sf).select("cliente_id", *[f"n_{t}" for t in pg.TX_TYPES])


@register("pre_post_activity", o.sql_for(["g_360"], """
SELECT cliente_id, n_transacciones_pre, monto_pre, n_transacciones_post, monto_post, dias_pre, dias_post,
       frecuencia_mensual_pre, frecuencia_mensual_post, monto_mensual_pre, monto_mensual_post
FROM g_360 WHERE fecha_activacion_fisica IS NOT NULL"""))
def pre_post_activity(spark, sf):
    return gold(spark, sf).filter(F.col("fecha_activacion_fisica").isNotNull()).select(
        "cliente_id", "n_transacciones_pre", "monto_pre", "n_transacciones_post", "monto_post", "dias_pre",
        "dias_post", "frecuencia_mensual_pre", "frecuencia_mensual_post", "monto_mensual_pre", "monto_mensual_post")


@register("pre_issue_activity", o.sql_for(["g_360"], """
SELECT cliente_id, n_transacciones_pre_emision, monto_pre_emision, n_compra_tarjeta_pre_emision,
       n_categorias_comercio_pre_emision, dias_pre_emision, frecuencia_mensual_pre_emision,
       monto_mensual_pre_emision, pct_compra_tarjeta_pre_emision
FROM g_360 WHERE fecha_emision_fisica IS NOT NULL"""))
def pre_issue_activity(spark, sf):
    return gold(spark, sf).filter(F.col("fecha_emision_fisica").isNotNull()).select(
        "cliente_id", "n_transacciones_pre_emision", "monto_pre_emision", "n_compra_tarjeta_pre_emision",
        "n_categorias_comercio_pre_emision", "dias_pre_emision", "frecuencia_mensual_pre_emision",
        "monto_mensual_pre_emision", "pct_compra_tarjeta_pre_emision")


@register("marketing_activity", o.sql_for(["g_mk"], "SELECT * FROM g_mk"))
def marketing_activity(spark, sf):
    return gold(spark, sf).filter(F.col("n_interacciones_marketing") > 0).select("cliente_id", *pg.MK_COLS)


@register("marketing_pre_issue", o.sql_for(["g_mkpe"], "SELECT * FROM g_mkpe"))
def marketing_pre_issue(spark, sf):
    return gold(spark, sf).filter(F.col("n_interacciones_pre_emision") > 0).select("cliente_id", *pg.MKPRE_COLS)


@register("customer_360", o.sql_for(["g_360"], "SELECT " + ", ".join(pg.GOLD_COLS) + " FROM g_360"))
def customer_360(spark, sf):
    """The wide table from the written silver zone.

    The orphan join of the zone's writing feeds no aggregate, so a hot customer's rows can be split there; here the
    transactions are combined to the day grain on the map side before they are dealt by customer.
    """
    return gold_fresh(spark, sf)


@register("pilot_summary", o.sql_for(["g_360"], """
SELECT grupo_piloto, count(*) AS n_clientes,
  round(avg(n_transacciones_total), 9) AS avg_n_transacciones_total,
  quantile_disc(n_transacciones_total, 0.5) AS mediana_n_transacciones_total,
  round(avg(monto_total), 4) AS avg_monto_total, round(quantile_disc(monto_total, 0.5), 4) AS mediana_monto_total,
  round(avg(frecuencia_mensual_pre), 9) AS avg_frecuencia_mensual_pre,
  round(avg(frecuencia_mensual_post), 9) AS avg_frecuencia_mensual_post,
  round(avg(monto_mensual_pre), 4) AS avg_monto_mensual_pre, round(avg(monto_mensual_post), 4) AS avg_monto_mensual_post,
  round(avg(tasa_respuesta), 9) AS avg_tasa_respuesta_marketing
FROM g_360 GROUP BY grupo_piloto"""))
def pilot_summary(spark, sf):
    from tidewater.plans.queries_causal import rounded
    money = ["avg_monto_total", "mediana_monto_total", "avg_monto_mensual_pre", "avg_monto_mensual_post"]
    s = pg.pilot_summary(gold(spark, sf))
    return rounded(s.withColumns({c: F.round(c, 4) for c in money}))
