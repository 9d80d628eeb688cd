"""The parts of a trained learner against plain Python: medians, moments, encoded columns, calibration of both arms."""

import statistics

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewater.operators.uplift import UNKNOWN_CATEGORY, fit_tlearner, preprocessor
from tidewater.session import Params

ROWS = [(1.0, "a"), (2.0, "b"), (None, "a"), (40.0, None), (3.0, "b")]


def encoded(spark, fit_rows, rows):
    schema = "x double, c string"
    model = preprocessor(["x"], ["c"]).fit(spark.createDataFrame(fit_rows, schema))
    out = model.transform(spark.createDataFrame(rows, schema))
    return model, out.select("x", "c", vector_to_array("_num_z").alias("z"), vector_to_array("_ohe_c").alias("o")).collect()


def test_numeric_fill_is_a_middle_value_and_moments_include_it(spark):
    model, out = encoded(spark, ROWS, ROWS)
    fill = model.stages[1].surrogateDF.first()["x"]
    assert fill in (2.0, 3.0)
    values = [fill if x is None else x for x, _ in ROWS]
    mean, sd = statistics.mean(values), statistics.stdev(values)
    for row, v in zip(out, values, strict=True):
        assert row["z"][0] == pytest.approx((v - mean) / sd)


def test_each_label_has_a_column_of_its_own_and_unseen_ones_none(spark):
    model, out = encoded(spark, ROWS, [*ROWS, (1.0, "new")])
    names = model.stages[4].labelsArray[0]
    assert sorted(names) == sorted(["a", "b", UNKNOWN_CATEGORY])
    for row in out:
        label = row["c"] or UNKNOWN_CATEGORY
        on = [i for i, v in enumerate(row["o"]) if v]
        if label == "new":
            assert not any(i < len(names) for i in on)
        else:
            assert on == [names.index(label)]


def test_calibration_uses_the_rate_of_its_own_arm(spark):
    p = Params(n_trees=5, max_depth=3)
    base = spark.range(400).withColumns({f: F.rand(3) for f in p.numeric_features}).withColumns(
        {c: F.lit("x") for c in p.categorical_features})
    base = base.withColumn("tratado", (F.col("id") % 2).cast("int")).withColumn(
        "aumento_uso", F.when(F.col("tratado") == 1, F.col("id") % 20 == 1).otherwise(F.col("id") % 8 == 0).cast("int"))
    model = fit_tlearner(base, p)
    assert (model.meta["pi_t"], model.meta["pi_c"]) == (pytest.approx(0.1), pytest.approx(0.25))
    for row in model.transform(base).limit(50).collect():
        for side, pi in (("tratamiento", 0.1), ("control", 0.25)):
            raw, fair = row[f"p_{side}"], row[f"p_{side}_otra"]
            assert fair == pytest.approx(raw * pi / (raw * pi + (1 - raw) * (1 - pi)))
            assert fair <= raw  # both rates are below one half
