"""Plan hygiene of every registered query (sf0.001): no cross products, no Python evaluation in the plan."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
SKIP = {"tlearner_train", "effect_importance", "schema_report"}  # driver-side model / metadata results
# Queries of the optional training-data operators have their own tests.
OWN = tuple(f"op{n}_" for n in range(1, 11)) + ("pipeline",)
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "RoundRobinPartitioning"]


def plan_of(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n not in SKIP and not n.startswith(OWN)))
def test_plan_has_no_cross_product_or_python(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"


def without_broadcast(spark):
    class Off:
        def __enter__(self):
            self.old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.adaptive.enabled", "false")

        def __exit__(self, *_):
            for k, v in self.old.items():
                spark.conf.set(k, v)
    return Off()


def test_gold_combines_transactions_before_they_are_dealt_by_customer(spark):
    with without_broadcast(spark):
        lines = plan_of(E.queries()["customer_360"](spark, SF)).split("\n\n")
    scans = [x for x in lines if "Scan parquet" in x.split("\n")[0] and "tipo_transaccion" in x]
    assert scans and not any("Exchange" in x.split("\n")[0] and "transaccion_id" in x for x in lines)
    daily = [x for x in lines if "HashAggregate" in x.split("\n")[0] and "fecha" in x and "partial_sum(monto" in x.replace("#", "")]
    assert daily or any("partial_count(1)" in x and "tipo_transaccion" in x for x in lines)


def test_orphan_join_has_no_distinct_above_its_keys(spark):
    """With both sides straight from an exchange, adaptive execution can split a hot customer's partition."""
    with without_broadcast(spark):
        df = E.queries()["clean_transactions"](spark, SF)
        lines = df._jdf.queryExecution().sparkPlan().toString().split("\n")
    at = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    column = lines[at].index("SortMergeJoin")
    right = next(i for i in range(at + 1, len(lines)) if lines[i][column:column + 3] == "+- ")
    subtree = "\n".join(lines[right:])
    assert "Aggregate" not in subtree and "FileScan parquet" in subtree


def test_quarantine_report_scans_each_raw_table_once(spark):
    plan = plan_of(E.queries()["quarantine_report"](spark, SF))
    for table in ("orders", "events", "supplier"):
        reads = [x for x in plan.split("\n\n") if x.lstrip().startswith("(") and "Scan parquet" in x.split("\n")[0]
                 and f"{table}.parquet" in x and "ReadSchema: struct<>" not in x]
        assert len(reads) <= 1, (table, len(reads))


def test_running_sums_use_no_single_partition_over_rows(spark):
    from pyspark.sql import functions as F

    from tidewater.operators import ranks
    t = spark.range(1000).select((F.col("id") % 300).alias("x"), F.lit(1).alias("n")).groupBy("x").agg(F.sum("n").alias("n"))
    plan = plan_of(ranks.prefix_sums(t, "x", ["n"], n_buckets=5))
    first = plan.index("SinglePartition") if "SinglePartition" in plan else len(plan)
    assert "hashpartitioning(_b" in plan and plan.count("SinglePartition") <= 2 and first > plan.index("hashpartitioning(_b")
