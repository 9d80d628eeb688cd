import math

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import ranks as rk
from tidewater.operators import stats as st


def _df(spark, values, groups=None):
    pdf = pd.DataFrame({"x": values})
    if groups is not None:
        pdf["g"] = groups
    return spark.createDataFrame(pdf)


def test_bucketed_prefix_sums_equal_single_window(spark):
    rng = np.random.default_rng(1)
    vals = rng.integers(0, 500, 3000).astype(float)
    t = _df(spark, vals).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    got = rk.prefix_sums(t, "x", ["n"], n_buckets=7).select("x", "cum_n").orderBy("x").toPandas()
    want = t.withColumn("c", F.sum("n").over(Window.orderBy("x"))).orderBy("x").toPandas()
    assert got["cum_n"].tolist() == want["c"].tolist()


def test_descending_prefix_sums(spark):
    t = spark.createDataFrame([(1.0, 1), (2.0, 2), (3.0, 3)], "x double, n long")
    got = {r.x: r.cum_n for r in rk.prefix_sums(t, "x", ["n"], descending=True, n_buckets=2).collect()}
    assert got == {3.0: 3, 2.0: 5, 1.0: 6}


def test_average_ranks_match_pandas(spark):
    rng = np.random.default_rng(2)
    vals = rng.integers(0, 40, 500).astype(float)
    r = rk.average_ranks(_df(spark, vals), "x", n_buckets=5).toPandas().set_index("x")["avg_rank"]
    want = pd.Series(vals).rank(method="average")
    assert all(abs(r[v] - w) < 1e-12 for v, w in zip(vals, want))


def test_mann_whitney_matches_closed_form(spark):
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 30, 70).astype(float), rng.integers(0, 25, 90).astype(float)
    vals = np.concatenate([a, b])
    df = _df(spark, vals, [1] * len(a) + [0] * len(b))
    got = st.mann_whitney(df, "x", F.col("g") == 1, n_buckets=4).first()
    ranks = pd.Series(vals).rank().to_numpy()
    u = ranks[: len(a)].sum() - len(a) * (len(a) + 1) / 2
    n1, n2, n = len(a), len(b), len(vals)
    ties = sum(c ** 3 - c for c in pd.Series(vals).value_counts())
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (u - n1 * n2 / 2 - 0.5) / s
    assert abs(got.u - u) < 1e-9 and abs(got.z - z) < 1e-9
    assert abs(got.p_value / (0.5 * math.erfc(z / math.sqrt(2))) - 1) < 1e-9


def test_wilcoxon_matches_closed_form(spark):
    rng = np.random.default_rng(5)
    pre = rng.integers(0, 10, 120).astype(float)
    post = pre + rng.integers(-3, 6, 120)
    df = spark.createDataFrame(pd.DataFrame({"post": post, "pre": pre}))
    got = st.wilcoxon_signed_rank(df, "post", "pre", n_buckets=3).first()
    d = post - pre
    d = d[d != 0]
    r = pd.Series(np.abs(d)).rank().to_numpy()
    rp, rm = r[d > 0].sum(), r[d < 0].sum()
    n = len(d)
    ties = sum(c ** 3 - c for c in pd.Series(np.abs(d)).value_counts())
    z = (min(rp, rm) - n * (n + 1) / 4) / math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48)
    assert got.n == n and abs(got.r_mas - rp) < 1e-9 and abs(got.z - z) < 1e-9


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "s double, y int")
    # pairs (pos, neg): (0.9,0.8)=1 (0.9,0.1)=1 (0.8,0.8)=0.5 (0.8,0.1)=1 -> 3.5 / 4
    assert abs(st.auc(df, "s", "y").first().auc - 0.875) < 1e-12


def test_qini_perfect_ranking_beats_random(spark):
    rows = [(1.0 - i / 100, i % 2, 1 if (i % 2 == 1 and i < 50) else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "s double, w int, y int")
    assert st.qini_score(df, "s", "y", "w").first().qini_score > 0.1


def test_histogram_edges_and_counts(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    h = {r.bin: r.n for r in st.histogram(df, "x", 5).collect()}
    assert sum(h.values()) == 11 and h[4] == 3  # last bin closed: 8, 9, 10


def test_ranks_are_exact_beyond_doubles_and_keep_nan_last(spark):
    big = 1 << 53
    t = spark.createDataFrame([(big + i, 1) for i in range(6)], "x long, n long")
    got = {r.x: r.cum_n for r in rk.prefix_sums(t, "x", ["n"], n_buckets=3).collect()}
    assert got == {big + i: i + 1 for i in range(6)}
    t = spark.createDataFrame([(1.0, 1), (float("nan"), 1), (-2.0, 1)], "x double, n long")
    got = sorted((r.cum_n, r.x) for r in rk.prefix_sums(t, "x", ["n"], n_buckets=2).collect())
    assert [x for _, x in got[:2]] == [-2.0, 1.0] and math.isnan(got[2][1])


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(9)
    vals, groups = rng.integers(0, 200, 3000), rng.integers(0, 4, 3000)
    df = spark.createDataFrame(list(zip(groups.tolist(), vals.tolist())), "g long, x long")
    for r in rk.exact_quantiles(df, ["g"], "x", [0.25, 0.5, 0.9]).collect():
        v = vals[groups == r.g]
        assert r.n == len(v) and r.q == [int(np.quantile(v, p, method="inverted_cdf")) for p in (0.25, 0.5, 0.9)]
