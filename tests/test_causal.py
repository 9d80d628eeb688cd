import datetime as dt
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewater.operators import stats as st
from tidewater.plans import causal as pcz
from tidewater.session import Params

OWN = Params(pre_start="2010-02-01", cut="2010-05-02", post_end="2010-08-01")


def made_panel(spark, n=60, seed=21):
    """Random customers and transactions around the window, with the outcomes counted in plain Python."""
    rng = np.random.default_rng(seed)
    day = lambda lo, hi: dt.date(2010, 1, 1) + dt.timedelta(int(rng.integers(lo, hi)))
    groups = ["fisica_activa", "solo_virtual", "fisica_no_activa", "sin_tarjeta_registrada"]
    customers = [(f"k{i}", groups[int(rng.integers(4))], day(-300, 90)) for i in range(n)]
    tx = [(f"k{int(rng.integers(n))}", day(-20, 260)) for _ in range(n * 8)]
    start, cut, end = (dt.date.fromisoformat(x) for x in (OWN.pre_start, OWN.cut, OWN.post_end))
    want = {}
    for cid, group, registered in customers:
        if group in (OWN.treated_group, OWN.control_group) and registered < start:
            mine = [d for c, d in tx if c == cid]
            pre, post = sum(start <= d < cut for d in mine), sum(cut <= d < end for d in mine)
            grew = post / (end - cut).days > pre / (cut - start).days
            want[cid] = (int(group == OWN.treated_group), int(grew))
    return (spark.createDataFrame(customers, "cliente_id string, grupo_piloto string, fecha_registro date"),
            spark.createDataFrame(tx, "cliente_id string, fecha date"), want)


def test_panel_equals_counting_by_hand(spark):
    gold, tx, want = made_panel(spark)
    got = {r.cliente_id: (r.tratado, r.aumento_uso) for r in pcz.model_panel(gold, tx, OWN).collect()}
    assert got == want and len({v for v in want.values()}) == 4


def _smd(spark, t_vals, c_vals):
    rows = [(1, float(v)) for v in t_vals] + [(0, float(v)) for v in c_vals]
    df = spark.createDataFrame(rows, "tratado int, feat_x double")
    return st.covariate_balance(df, ["feat_x"], "tratado").first()["smd"]


def test_smd_of_shifted_copies_is_the_shift_in_deviations(spark):
    x = np.array([1.0, 2.0, 4.0, 7.0, 11.0])
    for shift in (0.0, 0.1, -1.5):
        assert abs(_smd(spark, x + shift * x.std(ddof=1), x) - shift) < 1e-9


def test_smd_matches_pandas_formula(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(1, 2, 40), rng.normal(0, 1, 60)
    want = (a.mean() - b.mean()) / math.sqrt((a.var(ddof=1) + b.var(ddof=1)) / 2)
    assert abs(_smd(spark, a, b) - want) < 1e-9


def test_did_hc1_matches_matrix_sandwich(spark):
    rng = np.random.default_rng(7)
    n = 60
    t = (rng.random(n) < 0.4).astype(int)
    pre = rng.poisson(2, n).astype(float)
    post = pre + rng.poisson(1 + 2 * t, n)
    df = spark.createDataFrame(pd.DataFrame({"tratado": t, "pre": pre, "post": post}))
    got = st.did_hc1(df, "tratado", "pre", "post").first()
    # OLS y ~ 1 + t + post + t:post with HC1 sandwich, by numpy
    y = np.concatenate([pre, post])
    tt = np.concatenate([t, t])
    pp = np.concatenate([np.zeros(n), np.ones(n)])
    X = np.column_stack([np.ones(2 * n), tt, pp, tt * pp])
    beta = np.linalg.solve(X.T @ X, X.T @ y)
    e = y - X @ beta
    bread = np.linalg.inv(X.T @ X)
    meat = X.T @ (X * (e ** 2)[:, None])
    cov = bread @ meat @ bread * (2 * n) / (2 * n - 4)
    assert abs(got.coef_did - beta[3]) < 1e-9
    assert abs(got.se_hc1 - math.sqrt(cov[3, 3])) < 1e-9
    assert abs(got.p_value - math.erfc(abs(beta[3] / math.sqrt(cov[3, 3])) / math.sqrt(2))) < 1e-12


def test_erfc_column_accuracy(spark):
    xs = [x / 16 for x in range(-48, 400)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for x, g in zip(xs, (r[0] for r in df.select(st.erfc(F.col("x"))).collect())):
        assert abs(g - math.erfc(x)) <= 1e-12 * math.erfc(x)


def test_crude_uplift_and_funnel(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "tratado int, aumento_uso int")
    r = pcz.crude_uplift(df).first()
    assert abs(r.tasa_tratado - 0.5) < 1e-12 and abs(r.tasa_control - 1 / 3) < 1e-12


def test_quota_split_takes_exact_share_per_stratum(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("cliente_id"),
                                  (F.col("id") % 2).cast("int").alias("tratado"),
                                  (F.col("id") % 7 < 2).cast("int").alias("aumento_uso"))
    got = pcz.split_flag_quota(df, ["tratado", "aumento_uso"]).groupBy("tratado", "aumento_uso").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("en_test").alias("t")).collect()
    assert len(got) == 4
    for r in got:
        assert r.t == math.ceil(0.25 * r.n)
