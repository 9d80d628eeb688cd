"""Two-model (T-learner) uplift learning on Spark MLlib.

* preprocessing (M1, M2): median imputation + standardisation of the numeric
  features, constant fill + one-hot of the categorical ones (unseen -> all
  zeros; or hashed to a fixed number of columns), fitted once on the training rows of both arms;
* per-arm balanced class weights (M3) joined from a 4-row count table;
* one random forest per arm (M4), distributed by MLlib (trees grown level by
  level across executors);
* probabilities from both forests for every row (M6), a tree at a time for a batch
  of rows, and the calibrated variant that undoes the class weights (M6b);
* save / load of the whole learner (K12) as MLlib folders + a one-row JSON.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import (FeatureHasher, Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.segments import calibrate
from tidewater.session import Params, checkpoint_dir

# Rows that pass a tree together: their values and the tree stay in a core's cache.
SCORED_TOGETHER = 4096
# Training rows of one task: few bytes and much work each, so that files of a usual size would leave all rows to a few tasks.
ROWS_PER_TASK = 20_000
# Fixed value: fill for missing categorical features.
UNKNOWN_CATEGORY = "desconocido"


def collision_share(labels: int, buckets: int) -> float:
    """Expected share of ``labels`` different labels that share a bucket with another one."""
    return 1.0 - (1.0 - 1.0 / buckets) ** (labels - 1)


def preprocessor(numeric: list[str], categorical: list[str], buckets: int | None = None) -> Pipeline:
    """M1 + M2. Without ``buckets`` categories are code lists: every label reaches the driver and gets a column of its own.
    With it labels of any number are hashed to so many columns (``collision_share`` of them meet another), and no
    label is kept anywhere.
    """
    imp = [f"_imp_{c}" for c in numeric]
    filled = [f"_fill_{c}" for c in categorical]
    idx = [f"_idx_{c}" for c in categorical]
    ohe = [f"_ohe_{c}" for c in categorical]
    fill_sql = ", ".join(f"coalesce(CAST({c} AS STRING), '{UNKNOWN_CATEGORY}') AS {f}"
                         for c, f in zip(categorical, filled))
    stages = [
        SQLTransformer(statement=f"SELECT *, {fill_sql} FROM __THIS__"),
        Imputer(strategy="median", inputCols=numeric, outputCols=imp),
        VectorAssembler(inputCols=imp, outputCol="_num", handleInvalid="keep"),
        StandardScaler(inputCol="_num", outputCol="_num_z", withMean=True, withStd=True),
    ]
    if buckets:
        hashed = [FeatureHasher(inputCols=filled, outputCol="_hash", numFeatures=buckets, categoricalCols=filled)]
        return Pipeline(stages=[*stages, *hashed, VectorAssembler(inputCols=["_num_z", "_hash"], outputCol="features")])
    return Pipeline(stages=[
        *stages,
        StringIndexer(inputCols=filled, outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="keep"),
        VectorAssembler(inputCols=["_num_z", *ohe], outputCol="features"),
    ])


def with_class_weights(train: DataFrame, y: str, w: str) -> DataFrame:
    """M3: weight = n_arm / (2 * n_arm_class), joined from a table of at most 4 rows."""
    from tidewater.plans.causal import class_weights
    cw = class_weights(train, y, w).select(w, y, "peso")
    return train.join(F.broadcast(cw), [w, y], "left")


def forest_nodes(spark: SparkSession, path: str) -> tuple:
    """The nodes of a saved forest as arrays: as many as ``numTrees`` and ``maxDepth`` allow, whatever the data.

    A row goes from node ``i`` to ``child[2 * i + 1]`` where its ``feature[i]`` is at most ``threshold[i]``, else to
    ``child[2 * i]``; a leaf leads to itself. ``shares`` are a leaf's class counts over their sum, ``trees`` the first node
    and the depth of each tree.
    """
    columns = ("id", "impurityStats", "leftChild", "rightChild", "split.featureIndex", "split.leftCategoriesOrThreshold",
               "split.numCategories")
    rows = sorted(spark.read.parquet(f"{path}/data").select("treeID", *[f"nodeData.{c}" for c in columns]).collect(),
                  key=lambda row: row[:2])
    feature, threshold = np.zeros(len(rows), np.int64), np.full(len(rows), np.inf)
    child, shares = np.repeat(np.arange(len(rows)), 2), np.zeros((2, len(rows)))
    level, trees = np.zeros(len(rows), np.int64), []
    for i, (tree, _, stats, left, right, f, told, categories) in enumerate(rows):
        if not trees or tree != rows[i - 1][0]:
            trees.append([i, 0])
        root = trees[-1][0]
        trees[-1][1] = max(trees[-1][1], int(level[i]))
        if left < 0:
            total = sum(stats)
            shares[:, i] = [x / total for x in stats] if total else 0.0
            continue
        ends = [root + right, root + left]
        if categories >= 0:  # the encoded labels are 0 or 1: one of the two goes left
            if categories != 2 or len(told) != 1:
                raise ValueError(f"feature {f} has {categories} categories; encoded features are numbers or 0/1")
            ends, told = (ends[::-1] if told[0] == 1.0 else ends), [0.5]
        feature[i], threshold[i], child[2 * i:2 * i + 2] = f, told[0], ends
        level[ends] = level[i] + 1
    return feature, threshold, child, shares, trees


def forest_probability(nodes: tuple, x: np.ndarray) -> np.ndarray:
    """Probability of class 1 of each row of ``x``: the trees' shares summed in their order, as MLlib does, so equal to its.

    All rows pass one tree before the next: MLlib takes each row through all trees, whose nodes no cache holds.
    """
    feature, threshold, child, shares, trees = nodes
    flat, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
    votes = np.zeros((2, len(x)))
    for root, depth in trees:
        at = np.full(len(x), root)
        for _ in range(depth):
            at = child[2 * at + (flat[first + feature[at]] <= threshold[at])]
        votes += shares[:, at]
    total = votes.sum(axis=0)
    return np.divide(votes[1], total, out=np.zeros(len(x)), where=total != 0)


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows dealt out in equal parts of at most ``ROWS_PER_TASK``; rows of one part stay where they are."""
    parts = -(-n // ROWS_PER_TASK)
    return rows.repartition(parts) if parts > 1 else rows


@dataclass
class UpliftModel:
    prep: PipelineModel
    treated: RandomForestClassificationModel
    control: RandomForestClassificationModel
    meta: dict = field(default_factory=dict)
    nodes: object = field(default=None, repr=False)  # broadcast arrays of both forests, made by ``load`` or the first scoring

    def _probabilities(self, spark: SparkSession):
        """UDF: both forests' probabilities of class 1 for encoded rows."""
        if self.nodes is None:
            base = f"{checkpoint_dir(spark).rstrip('/')}/forests/{uuid.uuid4().hex}"
            self._save_forests(base)
            self.nodes = self._saved_nodes(spark, base)
        nodes = self.nodes

        @F.pandas_udf("t double, c double")
        def probabilities(features: pd.Series) -> pd.DataFrame:
            out = np.empty((len(features), 2))
            for k in range(0, len(features), SCORED_TOGETHER):
                x = np.stack(features.iloc[k:k + SCORED_TOGETHER].to_numpy())
                for j, forest in enumerate(nodes.value):
                    out[k:k + SCORED_TOGETHER, j] = forest_probability(forest, x)
            return pd.DataFrame(out, columns=["t", "c"])

        return probabilities

    def transform(self, df: DataFrame, calibrated: bool = False) -> DataFrame:
        """M6: ``p_tratamiento``, ``p_control`` and ``score_uplift`` for every row.

        One pass of each forest gives both scales: the columns hold the raw probabilities, or with
        ``calibrated`` those with the class weights undone, and the ``*_otra`` columns the other scale.
        """
        both = self._probabilities(df.sparkSession)(vector_to_array("features"))
        x = self.prep.transform(df).withColumn("_prob", both)
        raw = [F.col("_prob.t"), F.col("_prob.c")]
        fair = [calibrate(raw[0], self.meta["pi_t"]), calibrate(raw[1], self.meta["pi_c"])]
        (pt, pc), (qt, qc) = (fair, raw) if calibrated else (raw, fair)
        x = x.withColumns({"p_tratamiento": pt, "p_control": pc, "p_tratamiento_otra": qt, "p_control_otra": qc})
        x = x.withColumn("score_uplift", F.col("p_tratamiento") - F.col("p_control"))
        drop = [c for c in x.columns if c.startswith("_") or c in ("features",)]
        return x.drop(*drop)

    def save(self, spark: SparkSession, path: str) -> None:
        """Two MLlib models + preprocessing + metadata, all under one folder."""
        self.prep.write().overwrite().save(f"{path}/preprocesador")
        self._save_forests(path)
        spark.createDataFrame([(json.dumps(self.meta),)], "meta string").coalesce(1) \
             .write.mode("overwrite").text(f"{path}/meta")

    def _save_forests(self, path: str) -> None:
        self.treated.write().overwrite().save(f"{path}/modelo_tratamiento")
        self.control.write().overwrite().save(f"{path}/modelo_control")

    @staticmethod
    def _saved_nodes(spark: SparkSession, path: str):
        return spark.sparkContext.broadcast(
            [forest_nodes(spark, f"{path}/{name}") for name in ("modelo_tratamiento", "modelo_control")])

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "UpliftModel":
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        return cls(PipelineModel.load(f"{path}/preprocesador"),
                   RandomForestClassificationModel.load(f"{path}/modelo_tratamiento"),
                   RandomForestClassificationModel.load(f"{path}/modelo_control"), meta, cls._saved_nodes(spark, path))


def _forest(params: Params, y: str, suffix: str) -> RandomForestClassifier:
    # maxMemoryInMB / cacheNodeIds only change how many nodes are split per data pass
    # and whether node ids are cached (checkpointed every 10 iterations): same model, fewer passes.
    return RandomForestClassifier(
        featuresCol="features", labelCol=y, weightCol="peso", numTrees=params.n_trees, maxDepth=params.max_depth,
        featureSubsetStrategy="sqrt", seed=params.seed, probabilityCol=f"_prob_{suffix}",
        rawPredictionCol=f"_raw_{suffix}", predictionCol=f"_pred_{suffix}",
        maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10)


def fit_tlearner(train: DataFrame, params: Params = Params(), y: str = "aumento_uso",
                 w: str = "tratado") -> UpliftModel:
    """M4: preprocessing fitted on all training rows, then one weighted forest per arm."""
    num, cat = list(params.numeric_features), list(params.categorical_features)
    checkpoint_dir(train.sparkSession)  # node-id cache checkpoints go to the shared folder
    prep = preprocessor(num, cat, params.category_buckets).fit(train)
    x = with_class_weights(prep.transform(train).select("features", y, w), y, w) \
        .withColumn(y, F.col(y).cast("double"))
    from tidewater.session import materialize
    x = materialize(dealt(x, train.count()))
    rates = {r[w]: r["rate"] for r in x.groupBy(w).agg(F.avg(y).alias("rate")).collect()}
    m_t = _forest(params, y, "t").fit(x.filter(F.col(w) == 1))
    m_c = _forest(params, y, "c").fit(x.filter(F.col(w) == 0))
    meta = {"numeric_features": num, "categorical_features": cat, "treatment_name": 1, "control_name": 0,
            "pi_t": rates.get(1), "pi_c": rates.get(0), "category_buckets": params.category_buckets, "version": params.model_version}
    return UpliftModel(prep, m_t, m_c, meta)


def effect_importance(model: UpliftModel, scored: DataFrame, params: Params = Params()) -> DataFrame:
    """M8: surrogate forest regressor on the individual effect; importances by encoded feature name."""
    x = model.prep.transform(scored).select("features", "score_uplift")
    attrs = x.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    x = x.persist()  # the fit passes over its rows several times, and would score them anew; their places, which it draws by, stay
    rf = RandomForestRegressor(featuresCol="features", labelCol="score_uplift", numTrees=50,
                               maxDepth=params.max_depth, seed=params.seed).fit(x)
    x.unpersist()
    names = {}
    for group in attrs.values():
        for a in group:
            names[a["idx"]] = a["name"]
    imp = rf.featureImportances.toArray().tolist()
    rows = [(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(imp)]
    # one row per encoded feature: bounded by the feature count, not by the data
    return scored.sparkSession.createDataFrame(rows, "feature string, importancia double") \
        .orderBy(F.desc("importancia"), "feature")
