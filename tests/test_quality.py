from pyspark.sql import functions as F

from tidewater.operators import quality as oq
from tidewater.plans import clean as pc
from tidewater.plans import gold as pg
from tidewater.sources.bronze import bronze_tables

SF = "/root/testdata/sf0.001"


def test_valid_and_rejected_partition_the_deduplicated_input(spark):
    b = bronze_tables(spark, SF)
    s = pc.silver_tables(b, with_time=False)
    for name in ("tarjetas", "transacciones", "interacciones_marketing"):
        n_in = b[name].dropDuplicates().count()
        v, r = s[name].valid.count(), s[name].rejected.count()
        assert v + r == n_in, name
        assert r > 0, name


def test_orphan_counted_once_even_if_negative(spark):
    child = spark.createDataFrame([("a", -1.0), ("zz", -2.0), (None, 1.0), ("a", 3.0)], "cliente_id string, monto double")
    parent = spark.createDataFrame([("a",)], "cliente_id string")
    m = oq.mark_orphans(child, parent, "cliente_id")
    s = oq.split_by_reason(m, F.when(F.col("_parent_found").isNull(), oq.ORPHAN).when(F.col("monto") < 0, oq.NEGATIVE_AMOUNT),
                           with_time=False)
    reasons = sorted(r[0] for r in s.rejected.groupBy(oq.REASON).count().select(oq.REASON, "count").collect()
                     for _ in [0])
    got = {r[oq.REASON]: r["count"] for r in s.rejected.groupBy(oq.REASON).count().collect()}
    assert got == {oq.ORPHAN: 2, oq.NEGATIVE_AMOUNT: 1} and s.valid.count() == 1 and reasons


def test_duplicate_flag_null_keys_group_together(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "x"), ("3", None), ("4", None), ("5", "y")], "id string, k string")
    got = {r.id: r.dup for r in oq.flag_duplicated(df, "k", "dup").collect()}
    assert got == {"1": True, "2": True, "3": True, "4": True, "5": False}


def test_pilot_groups_partition_customers(spark):
    s = pc.silver_tables(bronze_tables(spark, SF), with_time=False)
    g = pg.gold_from_silver(s)
    n = s["clientes"].valid.count()
    assert g.count() == n and g.select("cliente_id").distinct().count() == n
    assert set(r[0] for r in g.select("grupo_piloto").distinct().collect()) <= set(pg.GROUPS)


def test_pre_plus_post_equals_dated_transactions_of_activated(spark):
    s = pc.silver_tables(bronze_tables(spark, SF), with_time=False)
    g = pg.gold_from_silver(s)
    act = g.filter(F.col("fecha_activacion_fisica").isNotNull()).select("cliente_id")
    dated = s["transacciones"].valid.filter(F.col("fecha").isNotNull()).join(act, "cliente_id", "left_semi").count()
    tot = g.agg(F.sum(F.col("n_transacciones_pre") + F.col("n_transacciones_post"))).first()[0]
    assert tot == dated


def test_report_counts(spark):
    b = bronze_tables(spark, SF)
    s = pc.silver_tables(b, with_time=False)["transacciones"]
    rows = {r.tabla: r for r in pc.report_all(b, pc.customer_keys(b["clientes"])).collect()}
    r = rows["transacciones"]
    assert len(rows) == 5 and r.filas_crudas == b["transacciones"].count()
    assert (r.filas_procesadas, r.filas_cuarentena) == (s.valid.count(), s.rejected.count())
    assert rows["catalogo_comercios"].motivos == "{}"


def test_profiles_type_aware(spark):
    df = spark.createDataFrame([("nan", float("nan"), None), ("a", 1.0, 2)], "s string, d double, i int")
    got = oq.null_profile(df).first().asDict()
    assert got == {"s": 1, "d": 1, "i": 1}


def test_a_repeated_merchant_code_does_not_multiply_transactions(spark):
    from tidewater.operators.joins import lookup_join
    tx = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, None)], "id long, comercio_codigo string")
    dim = spark.createDataFrame([("A", "x"), ("A", "a"), (None, "z")], "comercio_codigo string, categoria string")
    got = {r.id: (r.comercio_codigo, r.categoria) for r in lookup_join(tx, dim, "comercio_codigo").collect()}
    assert got == {1: ("A", "a"), 2: ("B", None), 3: (None, None), 4: (None, None)}


def test_hot_customer_in_the_raw_rows(spark):
    """A third of all raw transactions on one customer: same rows as the plain semi / anti join."""
    n = 6000
    raw = spark.range(n).select(
        F.concat(F.lit("TX-"), "id").alias("transaccion_id"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 50)).alias("cliente_id"),
        F.lit("2000-01-01").alias("fecha"), F.lit("remesa").alias("tipo_transaccion"), F.lit("1.00").alias("monto"),
        F.lit(None).cast("string").alias("comercio_codigo"), F.lit("no").alias("es_devolucion"))
    keys = spark.createDataFrame([("HOT",), ("C1",)], "cliente_id string")
    s = pc.clean_transactions(raw, oq.key_set(keys, "cliente_id"), with_time=False)
    kinds = {r.cliente_id: r["count"] for r in s.valid.groupBy("cliente_id").count().collect()}
    assert kinds["HOT"] == n // 3 and set(kinds) == {"HOT", "C1"}
    assert s.rejected.count() == n - sum(kinds.values())
