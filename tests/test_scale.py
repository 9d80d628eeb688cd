"""Work that must be spread over tasks, or be done once: text of the raw tables, scores, shares, landed files."""

import re
import tempfile

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewater import session
from tidewater.operators import stats as st
from tidewater.operators import uplift
from tidewater.operators.uplift import UpliftModel, effect_importance, fit_tlearner
from tidewater.plans import queries_stream as qs
from tidewater.session import Params, checkpoint_dir, materialize
from tidewater.sources.bronze import bronze_cards, bronze_customers, bronze_transactions
from tidewater.sources.io import list_folder

SF = "/root/testdata/sf0.001"


def one_file(spark, rows=4000):
    """A folder whose customers lie in one split, with null and repeated keys."""
    base = tempfile.mkdtemp(prefix="tw-scale-")
    c = spark.range(rows).select(F.when(F.col("id") % 50 != 3, F.col("id") % 3900).alias("c_custkey"), (F.col("id") % 5).cast("int").alias("c_nationkey"),
                                 (F.col("id") - 100.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment"))
    c.coalesce(1).write.parquet(f"{base}/customer.parquet")
    spark.range(5).select(F.col("id").cast("int").alias("n_nationkey"), F.lit("PERU").alias("n_name")).write.parquet(f"{base}/nation.parquet")
    return base, c


def test_text_of_customers_in_one_file_is_made_by_many_tasks(spark):
    base, c = one_file(spark)
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(option)
    spark.conf.set(option, "false")
    try:
        for raw in (bronze_customers(spark, base), bronze_cards(spark, base)):
            tasks = raw.groupBy(F.spark_partition_id()).count().count()
            assert tasks > 1
    finally:
        spark.conf.set(option, before)
    assert bronze_customers(spark, base).count() == c.selectExpr("sum(CASE WHEN c_custkey % 50 = 0 THEN 2 ELSE 1 END)").first()[0]


def test_amount_is_rounded_once_a_row(spark):
    plan = bronze_transactions(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bround\(", plan)) == 1


def test_distribution_passes_over_its_rows_once(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("z",)], "s string")
    out = st.ordered_distribution(df, "s", ["b", "c", "a"])
    assert [tuple(r) for r in out.orderBy("orden").collect()] == [("b", 1, 1, 0.2), ("c", 2, 0, 0.0), ("a", 3, 2, 0.4)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan and "subquery" not in plan.lower()
    none = st.ordered_distribution(df.where("s = 'q'"), "s", ["a"]).collect()
    assert [tuple(r) for r in none] == [("a", 1, 0, None)]


def test_importance_scores_each_row_once(spark):
    p = Params(n_trees=3, max_depth=2)
    base = spark.range(300).withColumns({f: F.rand(3) for f in p.numeric_features}).withColumns(
        {c: F.lit("x") for c in p.categorical_features})
    base = base.withColumn("tratado", (F.col("id") % 2).cast("int")).withColumn("aumento_uso", (F.col("id") % 3 == 0).cast("int"))
    model, scored = fit_tlearner(base, p), spark.sparkContext.accumulator(0)
    tick = F.udf(lambda x: scored.add(1) or x, "double")
    out = effect_importance(model, base.withColumn("score_uplift", tick(F.col("feat_edad"))), p).collect()
    assert scored.value == 300
    assert abs(sum(r.importancia for r in out) - 1) < 1e-9


def test_both_forests_score_batches_of_rows_exactly_as_mllib_does(spark):
    p = Params(n_trees=12, max_depth=6)
    base = spark.range(900).withColumns({f: F.when(F.rand(i) > 0.1, F.round(F.randn(i + 9), 2)) for i, f in enumerate(p.numeric_features)})
    base = base.withColumns({c: F.element_at(F.array(*map(F.lit, "abc"), F.lit(None)), (F.col("id") % m).cast("int") + 1)
                             for c, m in zip(p.categorical_features, (3, 4), strict=True)})
    base = base.withColumn("tratado", (F.col("id") % 2).cast("int")).withColumn(
        "aumento_uso", (F.col("feat_edad").isNull() | (F.col("feat_ciudad") == "a") & (F.col("id") % 5 > 0)).cast("int"))
    model = fit_tlearner(base, p)
    odd = base.limit(40).withColumns({"id": F.col("id") + 900, "feat_ciudad": F.lit("unseen"), "feat_edad": F.lit(float("nan"))})
    rows = base.unionByName(odd).localCheckpoint()
    x = model.prep.transform(rows)
    for forest in (model.treated, model.control):
        x = forest.transform(x)
    assert "in {" in model.treated.toDebugString + model.control.toDebugString  # some splits are by category
    want = {r[0]: r[1:] for r in x.select("id", *[vector_to_array(c)[1] for c in ("_prob_t", "_prob_c")]).collect()}
    path = f"{checkpoint_dir(spark)}/scored_model"
    model.save(spark, path)
    for m in (model, UpliftModel.load(spark, path)):
        out = m.transform(rows)
        assert {r.id: (r.p_tratamiento, r.p_control) for r in out.select("id", "p_tratamiento", "p_control").collect()} == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1  # one pass for both forests, not one call a row for each
    assert m.transform(rows.where("id < 0")).count() == 0


def test_training_rows_are_dealt_out_in_equal_parts(spark, monkeypatch):
    p = Params(n_trees=2, max_depth=2)
    base = spark.range(0, 3000, 1, 2).withColumns({f: F.rand(3) for f in p.numeric_features}).withColumns(
        {c: F.lit("x") for c in p.categorical_features})
    base = base.withColumn("tratado", (F.col("id") % 2).cast("int")).withColumn("aumento_uso", (F.col("id") % 3 == 0).cast("int"))
    base = base.where("id < 1500 OR id % 100 < 2")  # most rows lie in one of two parts
    monkeypatch.setattr(uplift, "ROWS_PER_TASK", 200)
    written = []
    monkeypatch.setattr(session, "materialize", lambda df: written.append(df) or materialize(df))
    fit_tlearner(base, p)
    sizes = [r["count"] for r in written[0].groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1530 and len(sizes) == 8 and max(sizes) <= 200


def test_each_trigger_of_the_stream_takes_files_of_many_tasks(spark):
    out = qs._streamed(spark, SF)
    assert out.startswith(checkpoint_dir(spark))
    files = [n for n, size, _ in list_folder(spark, f"{out[:-len('/out')]}/raw") if n.startswith("part-")]
    assert len(files) == qs.TRIGGERS * qs.FILES
    assert len(list_folder(spark, f"{out}/pending")) == qs.TRIGGERS
