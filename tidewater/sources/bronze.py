"""Bronze (dirty, all-text) campaign tables derived from the driver's test tables.

The reference ships no raw data, so the five raw inputs it cleans are derived
here, row for row, from the TPC-H-like test tables:

    clientes                <- customer ⋈ nation
    tarjetas                <- customer (0..3 cards per customer)
    transacciones           <- orders
    interacciones_marketing <- events
    catalogo_comercios      <- supplier

Each dirty spelling is chosen by ``key % m`` so that the DuckDB twin in
``tidewater.plans.oracle`` derives byte-identical text. All rules are
projections plus one generator (``explode``) per table: the work grows linearly
with the input. Orders and events are split across their parquet row groups;
customers, of few bytes a row and so of few splits, are dealt out as they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans.clean import MERCHANT_CATEGORY_FIX
from tidewater.sources.io import read_table

# Spellings of the eight transaction types: [plain code, UPPER, leading blank, Title words]
TX_TYPES = ["cash_in", "cash_out", "p2p_in", "p2p_out",
            "compra_tarjeta", "recarga_celular", "pago_servicio", "remesa"]
TX_SPELLINGS = [
    [t for t in TX_TYPES],
    [t.upper() for t in TX_TYPES],
    [" " + t for t in TX_TYPES],
    [" ".join(w.capitalize() for w in t.split("_")) for t in TX_TYPES],
]
BOOL_SPELLINGS = ["True", "TRUE", "1", "S", "Si", "Sí", "False", "false", "0",
                  "N", "No", "nan", "", "true"]
VIRTUAL_SPELLINGS = ["V", "virtual", "Virtual", " VIRTUAL", "v", "Virtual "]
PHYSICAL_SPELLINGS = ["F", "física", "FISICA", "Fisica", " fisica", "f"]
CAMPAIGNS = ["Bienvenida", "verano  plus", "BLACK FRIDAY", "Referidos ", "cashback", " Navidad Feliz"]
GENERIC_CATEGORIES = ["supermercado", "restaurante", "retail", "salud", "transporte", "entretenimiento"]
# Brand merchants of the catalogue: the fixed names whose category the cleaning repairs.
BRANDS = list(MERCHANT_CATEGORY_FIX)
CODE_WIDTH = 9


def _lit_array(values) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _pick(values, idx_sql: str) -> str:
    """SQL: the value at 0-based index ``idx_sql`` of a literal list."""
    return f"element_at({_lit_array(values)}, cast(({idx_sql}) as int) + 1)"


def _fmt_date(d: str, mode: str) -> str:
    """SQL: print date ``d`` as ISO (0), dd/MM/yyyy (1) or epoch milliseconds (2)."""
    return (f"CASE ({mode}) WHEN 0 THEN date_format({d}, 'yyyy-MM-dd') "
            f"WHEN 1 THEN date_format({d}, 'dd/MM/yyyy') "
            f"ELSE cast(cast(unix_date({d}) as bigint) * 86400000 as string) END")


def _id(prefix: str, k: str, width: int) -> str:
    return f"concat('{prefix}', lpad(cast({k} as string), {width}, '0'))"


def _dealt(rows: DataFrame) -> DataFrame:
    """Narrow rows dealt out in their order before their text is made, which one task would do for a whole small file.

    The deal goes by the row's place, so neither null nor repeated keys meet in one task.
    """
    return rows.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange("_place").drop("_place")


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _dealt(read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"))
    n = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = c.join(n, "c_nationkey", "left")
    k = "c_custkey"
    cid = _id("CHK-", k, 6)
    ced_k = f"CASE WHEN {k} % 97 = 0 AND {k} > 0 THEN {k} - 1 ELSE {k} END"
    ced = f"concat('17', lpad(cast((({ced_k}) * 7919) % 100000000 as string), 8, '0'))"
    birth = f"date_add(DATE'1930-01-01', cast(({k} * 131) % 33000 as int))"
    reg = f"date_add(DATE'1994-01-01', cast(({k} * 17) % 1900 as int))"
    out = j.select(
        F.expr(f"CASE {k} % 3 WHEN 0 THEN {cid} WHEN 1 THEN concat(' ', {cid}) "
               f"ELSE concat({cid}, '  ') END").alias("cliente_id"),
        F.expr(f"CASE WHEN {k} % 5 = 0 THEN concat(substr({ced}, 1, 9), '-', substr({ced}, 10, 1)) "
               f"WHEN {k} % 7 = 0 THEN concat(' ', {ced}, ' ') ELSE {ced} END").alias("cedula"),
        F.expr(f"CASE WHEN {k} % 17 = 0 THEN '31 de marzo' ELSE {_fmt_date(birth, f'{k} % 3')} END")
         .alias("fecha_nacimiento"),
        F.expr(f"CASE {k} % 4 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) "
               f"WHEN 2 THEN concat('  ', n_name) ELSE replace(n_name, 'A', 'Á') END").alias("ciudad"),
        F.expr(f"CASE WHEN {k} % 11 = 0 THEN 'N/A' "
               f"WHEN {k} % 11 = 1 THEN {_pick(['NULL', 'None', '', 'nan'], f'({k} div 11) % 4')} "
               f"WHEN {k} % 13 = 0 THEN concat(' ', lower(c_mktsegment), ' ') "
               f"ELSE c_mktsegment END").alias("canal_adquisicion"),
        F.expr(f"CASE WHEN c_acctbal >= 0 THEN {_pick(['Activa', 'ACTIVA ', ' activa'], f'{k} % 3')} "
               f"ELSE {_pick(['Suspendida', 'SUSPENDIDA  '], f'{k} % 2')} END").alias("estado_cuenta"),
        F.expr(_fmt_date(reg, f"({k} + 1) % 3")).alias("fecha_registro"),
        F.expr(f"CASE WHEN {k} % 50 = 0 THEN 2 ELSE 1 END").alias("_copies"),
    )
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def bronze_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _dealt(read_table(spark, sf_dir, "customer").select("c_custkey"))
    k = "c_custkey"
    cid = _id("CHK-", k, 6)
    issue_v = f"date_add(DATE'1996-01-01', cast({k} % 300 as int))"
    issue_f = f"date_add(DATE'1999-06-01', cast({k} % 45 as int))"
    act_f = f"date_add({issue_f}, cast({k} % 25 as int))"
    virtual = (f"named_struct('tarjeta_id', {_id('TRJ-', f'{k} * 2', 7)}, "
               f"'cliente_id', CASE WHEN {k} % 4 = 3 THEN concat({cid}, ' ') ELSE {cid} END, "
               f"'tipo', {_pick(VIRTUAL_SPELLINGS, f'{k} % 6')}, "
               f"'fecha_emision', {_fmt_date(issue_v, f'{k} % 3')}, "
               f"'fecha_activacion', {_fmt_date(issue_v, f'({k} + 1) % 3')}, "
               f"'estado_codigo', cast({k} % 3 + 1 as int))")
    physical = (f"named_struct('tarjeta_id', {_id('TRJ-', f'{k} * 2 + 1', 7)}, "
                f"'cliente_id', {cid}, "
                f"'tipo', {_pick(PHYSICAL_SPELLINGS, f'{k} % 6')}, "
                f"'fecha_emision', CASE WHEN {k} % 63 = 4 THEN CAST(NULL AS STRING) "
                f"ELSE {_fmt_date(issue_f, f'{k} % 3')} END, "
                f"'fecha_activacion', CASE WHEN {k} % 2 = 0 THEN {_fmt_date(act_f, f'({k} + 2) % 3')} "
                f"ELSE CAST(NULL AS STRING) END, "
                f"'estado_codigo', cast(({k} + 1) % 3 + 1 as int))")
    orphan = (f"named_struct('tarjeta_id', concat('TRJ-9', lpad(cast({k} as string), 6, '0')), "
              f"'cliente_id', concat('CHK-X', lpad(cast({k} as string), 6, '0')), "
              f"'tipo', 'virtual', "
              f"'fecha_emision', {_fmt_date(issue_v, '0')}, "
              f"'fecha_activacion', {_fmt_date(issue_v, '0')}, "
              f"'estado_codigo', 1)")
    cards = (f"filter(array("
             f"CASE WHEN {k} % 20 <> 0 THEN {virtual} END, "
             f"CASE WHEN {k} % 60 = 1 THEN {virtual} END, "
             f"CASE WHEN {k} % 9 IN (1, 2, 3, 4) THEN {physical} END, "
             f"CASE WHEN {k} % 40 = 7 THEN {orphan} END), x -> x IS NOT NULL)")
    return c.select(F.explode(F.expr(cards)).alias("t")).select("t.*")


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k = "o_orderkey"
    # card purchases range over all suppliers and, for about a tenth, over codes that no supplier has
    n_sup = read_table(spark, sf_dir, "supplier").agg(F.expr("count(*) + count(*) div 10 + 3")).scalar()
    # the rounded amount stands in many branches of the text below: made once a row
    o = o.withColumns({"_merchant": F.expr(f"{k} div 8") % n_sup, "_cents": F.expr("cast(round(o_totalprice * 100) as bigint)")})
    cid = _id("CHK-", "o_custkey", 6)
    d = "cast(o_orderdate as date)"
    cents = "_cents"
    dollars = f"({cents} div 100)"
    body = (f"concat(CASE WHEN {k} % 3 = 0 AND {dollars} >= 1000 "
            f"THEN concat(cast({dollars} div 1000 as string), ',', lpad(cast({dollars} % 1000 as string), 3, '0')) "
            f"ELSE cast({dollars} as string) END, '.', lpad(cast({cents} % 100 as string), 2, '0'))")
    spelled = "array(" + ", ".join(_lit_array(s) for s in TX_SPELLINGS) + ")"
    out = o.select(
        F.expr(f"CASE WHEN {k} % 5 = 0 THEN concat(' ', {_id('TX-', k, 8)}) ELSE {_id('TX-', k, 8)} END")
         .alias("transaccion_id"),
        F.expr(f"CASE WHEN {k} % 127 = 9 THEN concat('CHK-X', lpad(cast(o_custkey as string), 6, '0')) "
               f"WHEN {k} % 4 = 1 THEN concat({cid}, ' ') ELSE {cid} END").alias("cliente_id"),
        F.expr(f"CASE WHEN {k} % 301 = 7 THEN 'sin fecha' ELSE {_fmt_date(d, f'{k} % 3')} END").alias("fecha"),
        F.expr(f"CASE WHEN {k} % 97 = 13 THEN 'Ajuste Manual' "
               f"ELSE element_at(element_at({spelled}, cast(({k} div 8) % 4 as int) + 1), "
               f"cast({k} % 8 as int) + 1) END").alias("tipo_transaccion"),
        F.expr(f"CASE WHEN {k} % 211 = 5 THEN 'nan' WHEN {k} % 301 = 11 THEN CAST(NULL AS STRING) "
               f"WHEN {k} % 100 = 3 THEN concat('-', {body}) "
               f"WHEN {k} % 2 = 0 THEN concat('$', {body}) ELSE {body} END").alias("monto"),
        F.expr(f"CASE WHEN {k} % 8 = 4 AND {k} % 97 <> 13 THEN concat(CASE WHEN {k} % 7 = 0 THEN ' ' ELSE '' END, "
               f"'COM-', lpad(cast(_merchant as string), {CODE_WIDTH}, '0')) END").alias("comercio_codigo"),
        F.expr(_pick(BOOL_SPELLINGS, f"{k} % 14")).alias("es_devolucion"),
        F.expr(f"CASE WHEN {k} % 83 = 1 THEN 2 ELSE 1 END").alias("_copies"),
    )
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def bronze_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    # Customer count is one scalar subquery evaluated once, not a join.
    n_cust = read_table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    k = "event_id"
    # the scalar subquery is referenced once; later expressions read the column
    e = e.withColumn("_cust", F.lpad((F.col(k) % n_cust).cast("string"), 6, "0"))
    cid = F.concat(F.lit("CHK-"), F.col("_cust"))
    contact = f"date_add(DATE'1996-01-01', cast(({k} * 13) % 2000 as int))"
    out = e.select(
        F.expr(_id("INT-", k, 7)).alias("interaccion_id"),
        F.when(F.col(k) % 151 == 3, F.concat(F.lit("CHK-X"), F.col("_cust")))
         .when(F.col(k) % 6 == 5, F.concat(F.lit(" "), cid))
         .otherwise(cid).alias("cliente_id"),
        F.expr(_pick(CAMPAIGNS, "cast(get_json_object(props, '$.k') as bigint) % 6")).alias("campana"),
        F.expr(_fmt_date(contact, f"{k} % 3")).alias("fecha_contacto"),
        F.expr(f"CASE {k} % 3 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type) "
               f"ELSE concat(' ', event_type, ' ') END").alias("canal"),
        F.expr(f"CASE WHEN {k} % 29 = 0 THEN CAST(NULL AS STRING) ELSE {_pick(BOOL_SPELLINGS, f'{k} % 14')} END")
         .alias("respondio"),
        F.expr(f"CASE WHEN {k} % 97 = 2 THEN 2 ELSE 1 END").alias("_copies"),
    )
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def bronze_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    k = "s_suppkey"
    code = _id("COM-", k, CODE_WIDTH)
    out = s.select(
        F.expr(f"CASE WHEN {k} % 5 = 0 THEN concat(' ', {code}, ' ') ELSE {code} END").alias("comercio_codigo"),
        F.expr(f"CASE WHEN {k} < 15 THEN {_pick(BRANDS, k)} ELSE concat('Comercio ', cast({k} as string)) END")
         .alias("nombre_comercio"),
        F.expr(f"CASE WHEN {k} < 15 THEN (CASE WHEN {k} IN (6, 7, 8) THEN 'servicios_publicos' ELSE 'otros' END) "
               f"ELSE {_pick(GENERIC_CATEGORIES, f'{k} % 6')} END").alias("categoria"),
        F.expr(f"CASE WHEN {k} = 20 THEN 2 ELSE 1 END").alias("_copies"),
    )
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


BRONZE = {
    "clientes": bronze_customers,
    "tarjetas": bronze_cards,
    "transacciones": bronze_transactions,
    "interacciones_marketing": bronze_marketing,
    "catalogo_comercios": bronze_merchants,
}


class LazyTables(dict):
    """Mapping whose values are built on first access (unused tables cost no planning)."""

    def __init__(self, factories: dict):
        super().__init__()
        self._factories = factories

    def __missing__(self, key):
        value = self._factories[key]()
        self[key] = value
        return value

    def keys(self):
        return self._factories.keys()

    def items(self):
        return [(k, self[k]) for k in self._factories]

    def values(self):
        return [self[k] for k in self._factories]

    def __iter__(self):
        return iter(self._factories)

    def __len__(self):
        return len(self._factories)

    def __contains__(self, key):
        return key in self._factories


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return LazyTables({name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in BRONZE.items()})
