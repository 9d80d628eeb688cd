"""Registered profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import quality as oq
from tidewater.plans import gold as pg
from tidewater.plans import oracle as o
from tidewater.plans.queries_clean import silver_zone as silver
from tidewater.plans.queries_gold import gold
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


_TX_RAW = ["transaccion_id", "cliente_id", "fecha", "tipo_transaccion", "monto", "comercio_codigo", "es_devolucion"]
_nullsql = " UNION ALL ".join(
    f"SELECT '{c}' AS columna, count_if({c} IS NULL OR lower({c}) = 'nan') AS n_nulos FROM b_transacciones"
    for c in _TX_RAW)


@register("null_profile", o.sql_for(["b_transacciones"], _nullsql))
def null_profile(spark, sf):
    return oq.null_profile_long(bronze_tables(spark, sf)["transacciones"])


@register("null_profile_events", o.sql_for([], """
SELECT count_if(event_id IS NULL) AS event_id, count_if(ts IS NULL) AS ts, count_if(user_id IS NULL) AS user_id,
  count_if(event_type IS NULL OR lower(event_type) = 'nan') AS event_type,
  count_if(value IS NULL OR isnan(value)) AS value, count_if(props IS NULL OR lower(props) = 'nan') AS props
FROM events"""))
def null_profile_events(spark, sf):
    return oq.null_profile(read_table(spark, sf, "events"))


_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("cardinality_profile", o.sql_for([], " UNION ALL ".join(
    f"SELECT '{c}' AS columna, count(DISTINCT {c}) AS n_distintos FROM customer" for c in _CUST)))
def cardinality_profile(spark, sf):
    return oq.cardinality_profile(read_table(spark, sf, "customer"))


@register("frequency_profile", o.sql_for(["b_transacciones"], """
SELECT tipo_transaccion AS valor, count(*) AS n FROM b_transacciones GROUP BY 1"""))
def frequency_profile(spark, sf):
    return oq.frequency_profile(bronze_tables(spark, sf)["transacciones"], "tipo_transaccion")


@register("length_profile", o.sql_for(["b_clientes"], """
SELECT CAST(length(cedula) AS INTEGER) AS longitud, count(*) AS n FROM b_clientes GROUP BY 1"""))
def length_profile(spark, sf):
    return oq.length_profile(bronze_tables(spark, sf)["clientes"], "cedula")


@register("doc_length_profile", o.sql_for([], """
SELECT lang AS valor, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS n_caracteres FROM documents GROUP BY 1"""))
def doc_length_profile(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.groupBy(F.col("lang").alias("valor")).agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum(F.length("text")).alias("n_caracteres"))


@register("top_raw_types", o.sql_for(["b_transacciones"], """
SELECT tipo_transaccion AS valor, count(*) AS n FROM b_transacciones GROUP BY 1
ORDER BY n DESC, valor ASC NULLS FIRST LIMIT 10"""))
def top_raw_types(spark, sf):
    """O1+O2: the ten most frequent raw spellings (a top-k report)."""
    return oq.frequency_profile(bronze_tables(spark, sf)["transacciones"], "tipo_transaccion").limit(10)


@register("type_merchant_cooccurrence", o.sql_for(["s_transacciones"], """
SELECT tipo_transaccion, count_if(comercio_codigo IS NOT NULL) AS n_con, count_if(comercio_codigo IS NULL) AS n_sin,
  min(fecha) AS fecha_min, max(fecha) AS fecha_max
FROM s_transacciones GROUP BY 1"""))
def type_merchant_cooccurrence(spark, sf):
    t = silver(spark, sf)["transacciones"].valid
    return oq.cooccurrence(t, "tipo_transaccion", "comercio_codigo", F.min("fecha").alias("fecha_min"),
                           F.max("fecha").alias("fecha_max"))


@register("distinct_channels", o.sql_for(["s_clientes"], """
SELECT DISTINCT canal_adquisicion FROM s_clientes ORDER BY 1 NULLS FIRST"""))
def distinct_channels(spark, sf):
    """A18 + O1: distinct cleaned channels, sorted."""
    c = silver(spark, sf)["clientes"].valid
    return c.select("canal_adquisicion").distinct().orderBy(F.asc_nulls_first("canal_adquisicion"))


@register("group_distribution", o.sql_for(["g_360"], """
SELECT g.grupo_piloto, g.orden, coalesce(c.n, 0) AS n,
  coalesce(c.n, 0) / (SELECT count(*) FROM g_360) AS proporcion
FROM (VALUES ('sin_tarjeta_registrada', 1), ('solo_virtual', 2), ('fisica_no_activa', 3), ('fisica_activa', 4))
  AS g(grupo_piloto, orden)
LEFT JOIN (SELECT grupo_piloto, count(*) AS n FROM g_360 GROUP BY 1) c ON g.grupo_piloto = c.grupo_piloto"""))
def group_distribution(spark, sf):
    """Counts over a fixed, ordered value list (zero-filled) and shares of the total."""
    from tidewater.operators.stats import ordered_distribution
    return ordered_distribution(gold(spark, sf), "grupo_piloto", pg.GROUPS)


_traced = {"clientes": "s_clientes", "tarjetas": "s_tarjetas", "transacciones": "s_transacciones",
           "interacciones_marketing": "s_marketing"}


@register("entity_trace", o.sql_for(list(_traced.values()), " UNION ALL BY NAME ".join(
    f"SELECT '{t}' AS tabla, * FROM {c} WHERE cliente_id = 'CHK-000010'" for t, c in _traced.items())))
def entity_trace(spark, sf):
    """Q12: every whole row of one customer in the four silver tables (the feature is a single-key trace)."""
    s = silver(spark, sf)
    return oq.entity_trace({t: s[t].valid for t in _traced}, "cliente_id", "CHK-000010")


_KIND = ("replace(replace(replace(lower(column_type), 'varchar', 'string'), 'integer', 'int'), "
         "'timestamp with time zone', 'timestamp')")


@register("schema_report", "SELECT column_name AS columna, " + _KIND + " AS tipo FROM (DESCRIBE "
          + o.sql_for(["g_360"], "SELECT " + ", ".join(pg.GOLD_COLS) + " FROM g_360") + ")")
def schema_report(spark, sf):
    """Q11: (column, type) of the gold table - metadata only, no data job."""
    g = gold(spark, sf)
    from tidewater.sources.io import schema_report as sr
    return spark.createDataFrame(sr(g), "columna string, tipo string")
