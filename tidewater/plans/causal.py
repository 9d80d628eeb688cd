"""Causal analysis plans over the gold table.

Everything stays a DataFrame; only one-row statistics ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.parse import DAYS_PER_MONTH, pct_change
from tidewater.operators.pointintime import within
from tidewater.operators.ranks import exact_quantiles
from tidewater.session import Params


def panel_customers(gold: DataFrame, params: Params = Params()) -> DataFrame:
    """C1 (P8, P9, F21): treated and control customers registered before the pre-window."""
    return (gold.filter(F.col("grupo_piloto").isin(params.treated_group, params.control_group)
                        & (F.col("fecha_registro") < F.lit(params.pre_start).cast("date")))
            .withColumn("tratado", (F.col("grupo_piloto") == params.treated_group).cast("int")))


def window_counts(tx: DataFrame, params: Params = Params()) -> DataFrame:
    """Transactions per customer before / on-or-after the common cut inside the window.

    The date window pushes into the Parquet scan; the per-customer count is a
    partial aggregate, so hot customers cost one counter per task.
    """
    cut = F.lit(params.cut).cast("date")
    return (tx.filter(within("fecha", params.pre_start, params.post_end))
            .groupBy("cliente_id")
            .agg(F.count_if(F.col("fecha") < cut).alias("pre"), F.count_if(F.col("fecha") >= cut).alias("post")))


def model_panel(gold: DataFrame, tx: DataFrame, params: Params = Params()) -> DataFrame:
    """Panel ⟕ window counts (J9, J10), missing -> 0, outcome = post > pre."""
    p = panel_customers(gold, params).join(window_counts(tx, params), "cliente_id", "left")
    p = p.withColumns({"pre": F.coalesce("pre", F.lit(0)), "post": F.coalesce("post", F.lit(0))})
    return p.withColumn("aumento_uso", (F.col("post") > F.col("pre")).cast("int"))


def complete_cases(df: DataFrame, cols) -> DataFrame:
    """Drop rows with NULL (or NaN) in any listed column."""
    return df.na.drop(subset=list(cols))


def did_panel(gold: DataFrame, tx: DataFrame, params: Params = Params()) -> DataFrame:
    """Monthly frequency before / after the cut per panel customer (no complete-case filter)."""
    days_pre = params.days(params.pre_start, params.cut)
    days_post = params.days(params.cut, params.post_end)
    p = panel_customers(gold, params).select("cliente_id", "tratado").join(
        window_counts(tx, params), "cliente_id", "left")
    return p.select("cliente_id", "tratado",
                    (F.coalesce("pre", F.lit(0)) / F.lit(days_pre / DAYS_PER_MONTH)).alias("frecuencia_pre"),
                    (F.coalesce("post", F.lit(0)) / F.lit(days_post / DAYS_PER_MONTH)).alias("frecuencia_post"))


def did_means(did: DataFrame) -> DataFrame:
    """2x2 table of mean frequency by arm and period."""
    return did.groupBy("tratado").agg(F.count(F.lit(1)).alias("n"),
                                      F.avg("frecuencia_pre").alias("frecuencia_pre"),
                                      F.avg("frecuencia_post").alias("frecuencia_post"))


def adoption_funnel(gold: DataFrame) -> DataFrame:
    """Customers, physical cards received, activated, and the two shares."""
    a = gold.agg(F.count(F.lit(1)).alias("n_clientes"),
                 F.count_if(F.col("tiene_tarjeta_fisica")).alias("n_recibio_fisica"),
                 F.count_if(F.col("fisica_activada")).alias("n_activo"))
    return a.withColumns({"pct_recibio": F.try_divide(F.col("n_recibio_fisica"), F.col("n_clientes")),
                          "pct_activo": F.try_divide(F.col("n_activo"), F.col("n_recibio_fisica"))})


PRE_POST_METRICS = ["frecuencia_mensual_pre", "frecuencia_mensual_post", "monto_mensual_pre", "monto_mensual_post"]


def activated_complete(gold: DataFrame, params: Params = Params()) -> DataFrame:
    return complete_cases(gold.filter(F.col("grupo_piloto") == params.treated_group), PRE_POST_METRICS)


def pre_post_means(gold: DataFrame, params: Params = Params()) -> DataFrame:
    """Paired means before / after own activation with % change (complete cases)."""
    a = activated_complete(gold, params).agg(F.count(F.lit(1)).alias("n"),
                                             *[F.avg(c).alias(c) for c in PRE_POST_METRICS])
    return a.withColumns({
        "pct_cambio_frecuencia": pct_change("frecuencia_mensual_post", "frecuencia_mensual_pre"),
        "pct_cambio_monto": pct_change("monto_mensual_post", "monto_mensual_pre")})


def crude_uplift(panel: DataFrame, y: str = "aumento_uso", w: str = "tratado") -> DataFrame:
    """Outcome rate per arm and the difference."""
    t = F.col(w) == 1
    a = panel.agg(F.avg(F.when(~t, F.col(y))).alias("tasa_control"),
                  F.avg(F.when(t, F.col(y))).alias("tasa_tratado"))
    return a.withColumn("diferencia", F.col("tasa_tratado") - F.col("tasa_control"))


def hash_unit(key: Column, salt: str) -> Column:
    """Deterministic uniform number in [0, 1) from md5(salt:key); same in any SQL engine."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return (h % 10000) / F.lit(10000.0)


def split_flag(df: DataFrame, key: str = "cliente_id", params: Params = Params()) -> DataFrame:
    """Deterministic test flag (md5 bucket < test share); stable under recompute and re-partitioning."""
    return df.withColumn("en_test", hash_unit(F.col(key), str(params.seed)) < F.lit(params.test_fraction))


def split_flag_quota(df: DataFrame, strata: list[str], key: str = "cliente_id",
                     params: Params = Params()) -> DataFrame:
    """U3 exact-quota variant: inside every stratum the test rows are the ceil(share * n) smallest hashes.

    The threshold of a stratum is the discrete ``share`` quantile of the md5
    hash, counted exactly; its table has one row per stratum (AQE broadcasts
    it once measured). No window over a stratum gathers it in one task.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{params.seed}:"), F.col(key).cast("string"))), 1, 8),
               16, 10).cast("bigint")
    x = df.withColumn("_h", h)
    thr = exact_quantiles(x, strata, "_h", [params.test_fraction]).select(*strata, F.col("q")[0].alias("_thr"))
    return x.join(thr, strata, "left").withColumn("en_test", F.col("_h") <= F.col("_thr")).drop("_h", "_thr")


def class_weights(train: DataFrame, y: str = "aumento_uso", w: str = "tratado") -> DataFrame:
    """M3: balanced weights inside each arm: n_arm / (2 * n_arm_class)."""
    c = train.groupBy(w, y).agg(F.count(F.lit(1)).alias("n"))
    tot = train.groupBy(w).agg(F.count(F.lit(1)).alias("n_brazo"))
    return c.join(tot, w).withColumn("peso", F.col("n_brazo") / (2 * F.col("n")))


def heuristic_scores(panel: DataFrame) -> DataFrame:
    """Deterministic, feature-derived stand-in scores in [0, 1) so metric plans have an exact SQL twin."""
    f = F.coalesce(F.col("feat_frecuencia_mensual"), F.lit(0.0))
    m = F.coalesce(F.col("feat_monto_mensual"), F.lit(0.0))
    return panel.withColumns({"p_tratamiento": f / (f + F.lit(0.15)), "p_control": m / (m + F.lit(45000.0))}) \
                .withColumn("score_uplift", F.col("p_tratamiento") - F.col("p_control"))
