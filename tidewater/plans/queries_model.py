"""Registered queries of the trained learner's parts, against counts and moments from SQL: numeric (M1) and categorical (M2)
preprocessing, the forests of both arms (M4), their calibration (M6b) and the importances of the effect (M8)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewater.operators import stats as st
from tidewater.operators.uplift import UNKNOWN_CATEGORY, UpliftModel, effect_importance
from tidewater.plans import oracle as o
from tidewater.plans.queries_causal import STRATA, cc_panel, r, rounded
from tidewater.plans.queries_gold import gold
from tidewater.plans.zones import model_zone
from tidewater.session import Params, materialize

Q: dict = {}
SQL: dict = {}
P = Params()
NUM, CAT = list(P.numeric_features), list(P.categorical_features)
NO_COLUMN = "(sin columna)"
#: Median imputation looks for the middle rank within this share of the rows.
RANK_ERROR = 0.001


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def trained(spark, sf) -> UpliftModel:
    return model_zone(spark, sf, P)[0]


def training_rows(spark, sf):
    from tidewater.plans.causal import split_flag_quota
    return split_flag_quota(cc_panel(spark, sf), STRATA).where(~F.col("en_test"))


def beside(a, b):
    """Two tables of one row each as one row, without a join."""
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


_numeric = " UNION ALL ".join(f"""
SELECT '{c}' AS variable, (SELECT count(*) FROM g_360 WHERE {c} IS NULL) AS n_imputados,
  {r(f'avg(CAST({c} AS DOUBLE))', 'media')}, {r(f'stddev_samp(CAST({c} AS DOUBLE))', 'desviacion')},
  TRUE AS mediana_en_cota, CAST(0 AS BIGINT) AS n_nulos_despues
FROM c_split WHERE NOT en_test""" for c in NUM)


@register("numeric_preprocessing", o.sql_for(["g_360", "c_split"], _numeric))
def numeric_preprocessing(spark, sf):
    """M1: per feature the moments that standardise it (those of the training rows), the customers whose value is imputed,
    and whether the imputed value stands in the middle of the training rows."""
    prep, train, g = trained(spark, sf).prep, training_rows(spark, sf), gold(spark, sf)
    fills = prep.stages[1].surrogateDF.first().asDict()  # one row: a fill per feature
    scaler = prep.stages[3]
    z = prep.transform(g.select(*NUM, *CAT)).select(*NUM, vector_to_array("_num_z").alias("z"))
    after = z.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{k}") for k, c in enumerate(NUM)],
                  *[F.count_if(F.isnull(F.col("z")[k]) | F.isnan(F.col("z")[k])).alias(f"left_{k}") for k in range(len(NUM))])
    middle = train.agg(F.count(F.lit(1)).alias("n"), *[x for k, c in enumerate(NUM) for x in (
        F.count_if(F.col(c) < fills[c]).alias(f"below_{k}"), F.count_if(F.col(c) <= fills[c]).alias(f"upto_{k}"))])
    error = F.col("n") * RANK_ERROR + 1
    rows = [F.struct(F.lit(c).alias("variable"), F.col(f"nulls_{k}").alias("n_imputados"),
                     F.lit(float(scaler.mean[k])).alias("media"), F.lit(float(scaler.std[k])).alias("desviacion"),
                     ((F.col(f"below_{k}") <= F.col("n") / 2 + error) & (F.col(f"upto_{k}") >= F.col("n") / 2 - error))
                     .alias("mediana_en_cota"), F.col(f"left_{k}").alias("n_nulos_despues")) for k, c in enumerate(NUM)]
    return rounded(beside(after, middle).select(F.inline(F.array(*rows))))


_categorical = " UNION ALL ".join(f"""
SELECT '{c}' AS variable, coalesce(t.etiqueta, '{NO_COLUMN}') AS etiqueta, count(*) AS n
FROM g_360 g LEFT JOIN (SELECT DISTINCT coalesce({c}, '{UNKNOWN_CATEGORY}') AS etiqueta FROM c_split WHERE NOT en_test) t
  ON coalesce(g.{c}, '{UNKNOWN_CATEGORY}') = t.etiqueta GROUP BY 2""" for c in CAT)


@register("categorical_preprocessing", o.sql_for(["g_360", "c_split"], _categorical))
def categorical_preprocessing(spark, sf):
    """M2: customers per encoded column; those whose label no training row has stand in none of them."""
    prep = trained(spark, sf).prep
    labels = prep.stages[4].labelsArray
    x = prep.transform(gold(spark, sf).select(*NUM, *CAT))
    parts = []
    for c, names in zip(CAT, labels, strict=True):
        place = F.array_position(vector_to_array(f"_ohe_{c}"), 1.0)  # 0: no column
        named = F.when(place.between(1, len(names)), F.get(F.array(*map(F.lit, names)), (place - 1).cast("int")))
        parts.append(x.select(F.lit(c).alias("variable"), F.coalesce(named, F.lit(NO_COLUMN)).alias("etiqueta")))
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("variable", "etiqueta").agg(F.count(F.lit(1)).alias("n"))


_arm = " UNION ALL ".join(f"""
SELECT '{arm}' AS brazo, count(*) AS n_entrenamiento, {r('avg(CAST(aumento_uso AS DOUBLE))', 'tasa')},
  CAST({P.n_trees} AS BIGINT) AS arboles, TRUE AS profundidad_en_cota, TRUE AS arboles_difieren, TRUE AS aprende,
  TRUE AS variables_coinciden, count(*) AS calibracion_coincide, TRUE AS importancias_coinciden
FROM c_split WHERE NOT en_test AND tratado = {w}""" for arm, w in (("tratamiento", 1), ("control", 0)))


@register("forests_by_arm", o.sql_for(["c_split"], _arm))
def forests_by_arm(spark, sf):
    """What must hold of each arm's forest.

    The rate that calibration uses is that of the arm's training rows; the trees are as many as asked for, no deeper, and not
    one and the same; a random row of the class 1 scores above one of class 0 in training (``aprende``); calibrated
    probabilities undo the class weights row by row; features and importances are one per encoded column, with importances
    that are shares. (That calibrated means come nearer to the rate is no such rule on the rows a forest was grown on.)
    """
    model = trained(spark, sf)
    train = materialize(training_rows(spark, sf))
    scored = materialize(model.transform(train))
    columns = len(NUM) + sum(s.size for s in _encoded(model, train))
    shares = effect_importance(model, scored, P).agg(
        F.count(F.lit(1)).alias("n"), F.sum("importancia").alias("total"), F.min("importancia").alias("least")).first()
    fair_shares = shares["n"] == columns and abs(shares["total"] - 1) < 1e-9 and shares["least"] >= 0
    out = []
    for arm, w, forest, p, pi in (("tratamiento", 1, model.treated, "p_tratamiento", model.meta["pi_t"]),
                                  ("control", 0, model.control, "p_control", model.meta["pi_c"])):
        mine = scored.where(F.col("tratado") == w)
        odds = F.col(p) * pi, (1 - F.col(p)) * (1 - pi)  # weights n / 2n_class undone
        a = st.auc(mine, p, "aumento_uso").select((F.col("auc") > 0.5).alias("aprende"))
        whole = mine.agg(F.count(F.lit(1)).alias("n_entrenamiento"), F.count_if(
            F.abs(F.col(f"{p}_otra") - F.try_divide(odds[0], odds[0] + odds[1])) < 1e-12).alias("calibracion_coincide"))
        trees = forest.trees
        facts = {"brazo": arm, "tasa": pi, "arboles": len(trees),
                 "profundidad_en_cota": max(t.depth for t in trees) <= P.max_depth,
                 "arboles_difieren": len({t.numNodes for t in trees}) > 1,
                 "variables_coinciden": forest.numFeatures == columns, "importancias_coinciden": bool(fair_shares)}
        out.append(beside(whole, a).withColumns({k: F.lit(v) for k, v in facts.items()}).withColumn("arboles", F.col("arboles").cast("long")))
    return rounded(out[0].unionByName(out[1]))


def _encoded(model: UpliftModel, rows):
    """The vectors of one encoded row, a vector per categorical feature."""
    return model.prep.transform(rows.limit(1)).select(*[f"_ohe_{c}" for c in CAT]).first()
