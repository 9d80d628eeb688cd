"""Registered queries for column functions, cleaning and quarantine."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewater.functions import parse as fp
from tidewater.functions import text as ft
from tidewater.operators import quality as oq
from tidewater.plans import clean as pc
from tidewater.plans import oracle as o
from tidewater.sources.bronze import bronze_tables
from tidewater.sources.io import read_table

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def silver(spark, sf, with_time=False):
    """Silver computed from the raw tables in this plan (pipeline-step queries)."""
    return pc.silver_tables(bronze_tables(spark, sf), with_time=with_time)


def silver_zone(spark, sf):
    """Silver as written tables (queries that consume the zone)."""
    from tidewater.plans.zones import silver_zone as sz
    return sz(spark, sf)


# ---- functions --------------------------------------------------------------

@register("normalize_text_docs", o.sql_for([], f"""
SELECT doc_id, lang, {o.norm('text')} AS texto_normalizado, {o.norm('source')} AS fuente FROM documents"""))
def normalize_text_docs(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", "lang", ft.normalize_text("text").alias("texto_normalizado"),
                    ft.normalize_text("source").alias("fuente"))


@register("code_and_title_case", o.sql_for([], f"""
SELECT p_partkey, {o.code('p_type')} AS tipo_codigo, {o.title('p_name')} AS nombre_titulo,
       {o.title('p_brand')} AS marca_titulo FROM part"""))
def code_and_title_case(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", ft.normalize_code("p_type").alias("tipo_codigo"),
                    ft.proper_name("p_name").alias("nombre_titulo"), ft.proper_name("p_brand").alias("marca_titulo"))


@register("null_text_unify", o.sql_for(["b_clientes"], f"""
SELECT cliente_id, canal_adquisicion AS crudo, {o.null_word('canal_adquisicion')} AS canal FROM b_clientes"""))
def null_text_unify(spark, sf):
    b = bronze_tables(spark, sf)["clientes"]
    return b.select("cliente_id", F.col("canal_adquisicion").alias("crudo"),
                    ft.null_if_blank_word("canal_adquisicion").alias("canal"))


@register("parse_boolean", o.sql_for(["b_transacciones", "b_marketing"], f"""
SELECT transaccion_id AS id, es_devolucion AS crudo, {o.boolean('es_devolucion')} AS valor FROM b_transacciones
UNION ALL
SELECT interaccion_id, respondio, {o.boolean('respondio')} FROM b_marketing"""))
def parse_boolean(spark, sf):
    b = bronze_tables(spark, sf)
    t = b["transacciones"].select(F.col("transaccion_id").alias("id"), F.col("es_devolucion").alias("crudo"),
                                  ft.parse_bool("es_devolucion").alias("valor"))
    m = b["interacciones_marketing"].select(F.col("interaccion_id").alias("id"), F.col("respondio").alias("crudo"),
                                            ft.parse_bool("respondio").alias("valor"))
    return t.unionByName(m)


@register("clean_id", o.sql_for(["b_clientes"], f"""
SELECT cliente_id, trim(cliente_id) AS cliente_id_limpio, cedula AS crudo, {o.digits('cedula')} AS cedula
FROM b_clientes"""))
def clean_id(spark, sf):
    b = bronze_tables(spark, sf)["clientes"]
    return b.select("cliente_id", F.trim("cliente_id").alias("cliente_id_limpio"), F.col("cedula").alias("crudo"),
                    ft.digits_only("cedula").alias("cedula"))


@register("money_parse", o.sql_for(["b_transacciones"], f"""
SELECT transaccion_id, monto AS crudo, {o.money('monto')} AS monto FROM b_transacciones"""))
def money_parse(spark, sf):
    b = bronze_tables(spark, sf)["transacciones"]
    return b.select("transaccion_id", F.col("monto").alias("crudo"), fp.parse_money("monto").alias("monto"))


@register("multi_format_date", o.sql_for(["b_transacciones", "b_clientes", "b_tarjetas"], f"""
SELECT 'tx' AS origen, transaccion_id AS id, fecha AS crudo, {o.pdate('fecha')} AS fecha FROM b_transacciones
UNION ALL SELECT 'nac', cliente_id, fecha_nacimiento, {o.pdate('fecha_nacimiento')} FROM b_clientes
UNION ALL SELECT 'reg', cliente_id, fecha_registro, {o.pdate('fecha_registro')} FROM b_clientes
UNION ALL SELECT 'act', tarjeta_id, fecha_activacion, {o.pdate('fecha_activacion')} FROM b_tarjetas"""))
def multi_format_date(spark, sf):
    b = bronze_tables(spark, sf)

    def part(df, origin, idc, c):
        return df.select(F.lit(origin).alias("origen"), F.col(idc).alias("id"), F.col(c).alias("crudo"),
                         fp.parse_date_multi(c).alias("fecha"))
    out = part(b["transacciones"], "tx", "transaccion_id", "fecha")
    out = out.unionByName(part(b["clientes"], "nac", "cliente_id", "fecha_nacimiento"))
    out = out.unionByName(part(b["clientes"], "reg", "cliente_id", "fecha_registro"))
    return out.unionByName(part(b["tarjetas"], "act", "tarjeta_id", "fecha_activacion"))


@register("age_and_validity", o.sql_for(["b_clientes"], f"""
SELECT cliente_id, fecha_nacimiento AS crudo, d AS fecha,
  {o.age('d')} AS edad,
  (d IS NOT NULL AND {o.age('d')} >= 18 AND {o.age('d')} <= 100) AS valida,
  {o.ddiff(f"DATE '{o.P.as_of}'", 'd')} AS dias
FROM (SELECT cliente_id, fecha_nacimiento, {o.pdate('fecha_nacimiento')} AS d FROM b_clientes)"""))
def age_and_validity(spark, sf):
    b = bronze_tables(spark, sf)["clientes"]
    p = pc.Params()
    d = b.select("cliente_id", F.col("fecha_nacimiento").alias("crudo"),
                 fp.parse_date_multi("fecha_nacimiento").alias("fecha"))
    return d.select("cliente_id", "crudo", "fecha", fp.age_years("fecha", p.as_of).alias("edad"),
                    fp.valid_age("fecha", p.as_of).alias("valida"),
                    fp.days_between(F.lit(p.as_of).cast("date"), "fecha").alias("dias"))


@register("map_with_exceptions", o.sql_for(["b_tarjetas"], f"""
SELECT tarjeta_id, tipo AS crudo,
  CASE {o.code('tipo')} WHEN 'f' THEN 'fisica' WHEN 'v' THEN 'virtual' ELSE {o.code('tipo')} END AS tipo
FROM b_tarjetas"""))
def map_with_exceptions(spark, sf):
    b = bronze_tables(spark, sf)["tarjetas"]
    return b.select("tarjeta_id", F.col("tipo").alias("crudo"),
                    ft.map_with_exceptions(ft.normalize_code("tipo"), pc.CARD_TYPE_ABBREVIATIONS).alias("tipo"))


@register("category_repair", o.sql_for(["s_comercios"], "SELECT * FROM s_comercios"))
def category_repair(spark, sf):
    return pc.clean_merchants(bronze_tables(spark, sf)["catalogo_comercios"])


@register("clean_customers", o.sql_for(["s_clientes"], "SELECT * FROM s_clientes"))
def clean_customers(spark, sf):
    return silver(spark, sf)["clientes"].valid


@register("clean_cards", o.sql_for(["s_tarjetas"], "SELECT * FROM s_tarjetas"))
def clean_cards(spark, sf):
    return silver(spark, sf)["tarjetas"].valid


@register("clean_transactions", o.sql_for(["s_transacciones"], "SELECT * FROM s_transacciones"))
def clean_transactions(spark, sf):
    return silver(spark, sf)["transacciones"].valid


@register("clean_marketing", o.sql_for(["s_marketing"], "SELECT * FROM s_marketing"))
def clean_marketing(spark, sf):
    return silver(spark, sf)["interacciones_marketing"].valid


@register("clean_merchants", o.sql_for(["s_comercios"], "SELECT * FROM s_comercios"))
def clean_merchants(spark, sf):
    return silver(spark, sf)["catalogo_comercios"].valid


@register("orphan_split", o.sql_for(["s_tarjetas_all", "s_marketing_all"], """
SELECT 'tarjetas' AS tabla, tarjeta_id AS id, cliente_id, motivo_descarte FROM s_tarjetas_all WHERE motivo_descarte IS NOT NULL
UNION ALL
SELECT 'interacciones_marketing', interaccion_id, cliente_id, motivo_descarte FROM s_marketing_all
WHERE motivo_descarte IS NOT NULL"""))
def orphan_split(spark, sf):
    s = silver(spark, sf)
    a = s["tarjetas"].rejected.select(F.lit("tarjetas").alias("tabla"), F.col("tarjeta_id").alias("id"),
                                      "cliente_id", oq.REASON)
    b = s["interacciones_marketing"].rejected.select(F.lit("interacciones_marketing").alias("tabla"),
                                                     F.col("interaccion_id").alias("id"), "cliente_id", oq.REASON)
    return a.unionByName(b)


@register("negative_amount_split", o.sql_for(["s_transacciones_all"],
                                             "SELECT * FROM s_transacciones_all WHERE motivo_descarte IS NOT NULL"))
def negative_amount_split(spark, sf):
    return silver(spark, sf)["transacciones"].rejected


_report_sql = []
for _t, _b, _v, _r in [("clientes", "b_clientes", "s_clientes", None),
                       ("tarjetas", "b_tarjetas", "s_tarjetas", "s_tarjetas_all"),
                       ("transacciones", "b_transacciones", "s_transacciones", "s_transacciones_all"),
                       ("interacciones_marketing", "b_marketing", "s_marketing", "s_marketing_all"),
                       ("catalogo_comercios", "b_comercios", "s_comercios", None)]:
    if _r:
        rej = (f"(SELECT count(*) FROM {_r} WHERE motivo_descarte IS NOT NULL)",
               f"(SELECT coalesce('{{' || string_agg('\"' || motivo_descarte || '\":' || CAST(n AS VARCHAR), ',' "
               f"ORDER BY motivo_descarte) || '}}', '{{}}') FROM (SELECT motivo_descarte, count(*) AS n FROM {_r} "
               f"WHERE motivo_descarte IS NOT NULL GROUP BY 1))")
    else:
        rej = ("0", "'{}'")
    _report_sql.append(f"SELECT '{_t}' AS tabla, (SELECT count(*) FROM {_b}) AS filas_crudas, "
                       f"(SELECT count(*) FROM {_v}) AS filas_procesadas, CAST({rej[0]} AS BIGINT) AS filas_cuarentena, "
                       f"{rej[1]} AS motivos")


@register("quarantine_report", o.sql_for(
    ["b_clientes", "s_clientes", "b_tarjetas", "s_tarjetas", "s_tarjetas_all", "b_transacciones", "s_transacciones",
     "s_transacciones_all", "b_marketing", "s_marketing", "s_marketing_all", "b_comercios", "s_comercios"],
    "\nUNION ALL\n".join(_report_sql)))
def quarantine_report(spark, sf):
    b = bronze_tables(spark, sf)
    return pc.report_all(b, pc.customer_keys(b["clientes"]))


@register("quarantine_roundtrip", o.sql_for(["s_tarjetas_all"], """
SELECT motivo_descarte, count(*) AS n FROM s_tarjetas_all WHERE motivo_descarte IS NOT NULL GROUP BY 1"""))
def quarantine_roundtrip(spark, sf):
    """K3: rejects of transactions (two reasons), then of cards (one), to one folder; only the last run is there."""
    from tidewater.session import checkpoint_dir
    from tidewater.sources.io import write_quarantine
    path = f"{checkpoint_dir(spark).rstrip('/')}/quarantine_{uuid.uuid4().hex}"
    s = silver(spark, sf)
    for name in ("transacciones", "tarjetas"):
        write_quarantine(s[name].rejected, path)
    return spark.read.parquet(path).groupBy(F.col(oq.REASON).cast("string").alias(oq.REASON)).agg(
        F.count(F.lit(1)).alias("n"))


@register("duplicate_id_flag", o.sql_for(["s_clientes"], """
SELECT cliente_id, cedula, cedula_duplicada FROM s_clientes"""))
def duplicate_id_flag(spark, sf):
    return silver(spark, sf)["clientes"].valid.select("cliente_id", "cedula", "cedula_duplicada")


@register("duplicate_key_report", o.sql_for([], """
SELECT l_orderkey, l_linenumber, CAST(sum(n) AS BIGINT) AS n_apariciones, count(*) AS n_versiones
FROM (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL)
GROUP BY l_orderkey, l_linenumber HAVING sum(n) > 1"""))
def duplicate_key_report(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return oq.duplicate_key_report(li, ["l_orderkey", "l_linenumber"])


@register("duplicate_tx_report", o.sql_for(["b_transacciones"], """
SELECT transaccion_id, CAST(sum(n) AS BIGINT) AS n_apariciones, count(*) AS n_versiones
FROM (SELECT *, count(*) AS n FROM b_transacciones GROUP BY ALL)
GROUP BY transaccion_id HAVING sum(n) > 1"""))
def duplicate_tx_report(spark, sf):
    return oq.duplicate_key_report(bronze_tables(spark, sf)["transacciones"], ["transaccion_id"])


@register("semi_anti_join", o.sql_for(["s_transacciones_all"], """
SELECT CASE WHEN motivo_descarte = 'cliente_id_huerfano' THEN 'huerfano' ELSE 'con_cliente' END AS grupo,
       transaccion_id, cliente_id FROM s_transacciones_all"""))
def semi_anti_join(spark, sf):
    """J1 + J2 as separate operators: transactions with a known customer (semi) and orphans (anti)."""
    b = bronze_tables(spark, sf)
    ids = pc.customer_keys(b["clientes"])
    t = pc.clean_tx_columns(b["transacciones"].dropDuplicates()).select("transaccion_id", "cliente_id")
    semi = oq.semi_join(t, ids, "cliente_id").select(F.lit("con_cliente").alias("grupo"), "transaccion_id",
                                                     "cliente_id")
    anti = oq.anti_join(t, ids, "cliente_id").select(F.lit("huerfano").alias("grupo"), "transaccion_id",
                                                     "cliente_id")
    return semi.unionByName(anti)


@register("null_channel_rows", o.sql_for(["s_clientes"], """
SELECT cliente_id, ciudad FROM s_clientes WHERE canal_adquisicion IS NULL"""))
def null_channel_rows(spark, sf):
    """SQL-string predicate on the cleaned customers."""
    return silver_zone(spark, sf)["clientes"].valid.filter("canal_adquisicion IS NULL").select("cliente_id", "ciudad")
