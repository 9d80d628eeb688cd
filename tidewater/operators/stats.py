"""Statistical aggregates as DataFrame plans (A14-A17, C2-C16 building blocks)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ALTERNATIVES = ("two-sided", "greater", "less")
SPLIT, SERIES_TERMS, FRACTION_TERMS = 1.5, 34, 60


def ordered_distribution(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Count per value of a fixed, ordered list (missing -> 0) and share of all rows.

    The rows are passed over once, into one row of counts of a size that the code fixes. Unlisted and NULL values
    count towards the total only.
    """
    counts = [F.count_if(F.col(col) == v).alias(f"_n{i}") for i, v in enumerate(order)]
    places = F.array(*[F.struct(F.lit(v).alias(col), F.lit(i + 1).alias("orden"), F.col(f"_n{i}").alias("n")) for i, v in enumerate(order)])
    one = df.agg(F.count(F.lit(1)).alias("_total"), *counts)
    return (one.select(F.explode(places).alias("p"), "_total").select("p.*", "_total")
            .withColumn("proporcion", F.try_divide(F.col("n"), F.col("_total"))).drop("_total"))


def erfc(x: Column) -> Column:
    """Complementary error function as a Column expression, to about 14 digits.

    Below ``SPLIT`` one minus the series erf(z) = 2z/sqrt(pi) exp(-z^2) (1 + 2z^2/3 (1 + 2z^2/5 (1 + ...))), all
    of whose terms are positive; above it the continued fraction exp(-z^2)/sqrt(pi) / (z + 1/2/(z + 1/(z +
    3/2/(z + ...)))). Plain arithmetic keeps p-values in the plan, next to their z.
    """
    z = F.abs(x)
    bell = F.exp(-z * z) / F.lit(math.sqrt(math.pi))
    # From the innermost term outwards. A fold over its numbers keeps the plan as small as one term.
    inner = F.lit([2.0 / (2 * k + 1) for k in range(SERIES_TERMS, 0, -1)])
    series = F.aggregate(inner, F.lit(1.0), lambda rest, c: F.lit(1.0) + z * z * c * rest)
    fraction = F.aggregate(F.lit([k / 2.0 for k in range(FRACTION_TERMS, 0, -1)]), z, lambda rest, c: z + c / rest)
    upper = F.when(z < F.lit(SPLIT), F.lit(1.0) - F.lit(2.0) * z * bell * series).otherwise(bell / fraction)
    return F.when(x >= 0, upper).otherwise(F.lit(2.0) - upper)


def two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z) / F.lit(math.sqrt(2.0)))


def upper_tail_p(z: Column) -> Column:
    return F.lit(0.5) * erfc(z / F.lit(math.sqrt(2.0)))


# --------------------------------------------------------------------- rank tests

def tail_z(center: Column, sd: Column, correction: float, alternative: str) -> Column:
    """z of a statistic's distance from its mean, with a continuity correction towards it."""
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative must be one of {ALTERNATIVES}")
    towards = {"greater": F.lit(1.0), "less": F.lit(-1.0), "two-sided": F.signum(center)}[alternative]
    return (center - towards * correction) / sd


def tail_p(z: Column, alternative: str) -> Column:
    if alternative == "two-sided":
        return two_sided_p(z)
    return upper_tail_p(z if alternative == "greater" else -z)


def whole_table_exact(test, df: DataFrame, *args, **options) -> DataFrame:
    """An exact test of one group, the whole table."""
    return test(df.withColumn("_todo", F.lit(1)), ["_todo"], *args, **options).drop("_todo")


def mann_whitney(df: DataFrame, value_col: str, group1: Column, n_buckets: int | None = None,
                 alternative: str = "greater", method: str = "normal") -> DataFrame:
    """Mann-Whitney U of group 1 vs the rest, normal approximation, by default one-sided 'greater'.

    ``method="exact"`` takes p from the exact distribution instead (``exact.mann_whitney_exact``; no z, small tables).
    U = R1 - n1(n1+1)/2; var = n1 n2 / 12 * ((N+1) - Σ(t³-t) / (N(N-1)));
    z = (U - n1 n2 / 2 - 0.5) / sqrt(var) (continuity correction); p = upper tail.
    """
    from tidewater.operators.exact import mann_whitney_exact
    from tidewater.operators.ranks import average_ranks, tie_term
    if method == "exact":
        return whole_table_exact(mann_whitney_exact, df, value_col, group1, alternative)
    d = df.select(F.col(value_col), group1.cast("long").alias("_g"))
    r = average_ranks(d, value_col, {"n1": F.col("_g")}, n_buckets)
    a = r.agg(F.sum(F.col("n1") * F.col("avg_rank")).alias("r1"), F.sum("n1").alias("n1"),
              F.sum("n").alias("n"), F.sum(tie_term(F.col("n"))).alias("ties"))
    n1, n = F.col("n1").cast("double"), F.col("n").cast("double")
    n2 = n - n1
    u = F.col("r1") - n1 * (n1 + 1) / 2
    var = n1 * n2 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1)))
    z = tail_z(u - n1 * n2 / 2, F.sqrt(var), 0.5, alternative)
    a = a.select(F.col("n1").alias("n1"), (F.col("n") - F.col("n1")).alias("n2"), u.alias("u"), z.alias("z"))
    return a.withColumn("p_value", tail_p(F.col("z"), alternative))


def wilcoxon_signed_rank(df: DataFrame, x_col: str, y_col: str, n_buckets: int | None = None,
                         alternative: str = "two-sided", method: str = "normal") -> DataFrame:
    """Paired signed-rank test of x - y, zero differences dropped, normal approximation, by default two-sided.

    ``method="exact"`` takes p from the exact distribution instead (``exact.wilcoxon_exact``; no z, small tables).
    W = min(R+, R-), or R+ for a one-sided alternative; mean n(n+1)/4; var = n(n+1)(2n+1)/24 - Σ(t³-t)/48.
    """
    from tidewater.operators.exact import wilcoxon_exact
    from tidewater.operators.ranks import average_ranks, tie_term
    if method == "exact":
        return whole_table_exact(wilcoxon_exact, df, x_col, y_col, alternative)
    d = (df.select((F.col(x_col) - F.col(y_col)).alias("_d"))
           .filter(F.col("_d").isNotNull() & (F.col("_d") != 0))
           .select(F.abs("_d").alias("_a"), (F.col("_d") > 0).cast("long").alias("_pos")))
    r = average_ranks(d, "_a", {"n_pos": F.col("_pos")}, n_buckets)
    a = r.agg(F.sum(F.col("n_pos") * F.col("avg_rank")).alias("r_mas"),
              F.sum((F.col("n") - F.col("n_pos")) * F.col("avg_rank")).alias("r_menos"),
              F.sum("n").alias("n"), F.sum(tie_term(F.col("n"))).alias("ties"))
    n = F.col("n").cast("double")
    w = F.least("r_mas", "r_menos") if alternative == "two-sided" else F.col("r_mas")
    var = n * (n + 1) * (2 * n + 1) / 24 - F.col("ties") / 48
    z = tail_z(w - n * (n + 1) / 4, F.sqrt(var), 0.0, alternative)
    a = a.select("n", "r_mas", "r_menos", w.alias("estadistico"), z.alias("z"))
    return a.withColumn("p_value", tail_p(F.col("z"), alternative))


def auc(df: DataFrame, score_col: str, label_col: str, n_buckets: int | None = None) -> DataFrame:
    """M5: ROC AUC = U / (n_pos n_neg) from average ranks (ties count one half)."""
    from tidewater.operators.ranks import average_ranks
    d = df.select(F.col(score_col), F.col(label_col).cast("long").alias("_y"))
    r = average_ranks(d, score_col, {"n_pos": F.col("_y")}, n_buckets)
    a = r.agg(F.sum(F.col("n_pos") * F.col("avg_rank")).alias("r1"), F.sum("n_pos").alias("n_pos"),
              F.sum("n").alias("n"))
    npos = F.col("n_pos").cast("double")
    nneg = F.col("n").cast("double") - npos
    return a.select(F.col("n_pos"), (F.col("n") - F.col("n_pos")).alias("n_neg"),
                    ((F.col("r1") - npos * (npos + 1) / 2) / (npos * nneg)).alias("auc"))


# --------------------------------------------------------------------- balance, DiD, ATE

def covariate_balance(df: DataFrame, features: Sequence[str], treat_col: str) -> DataFrame:
    """Per feature mean by arm and SMD = (m_t - m_c) / sqrt((s²_t + s²_c) / 2) (sample variances).

    One wide aggregate over the table's rows; its single row is then unpivoted. NULLs are left out per feature.
    SMD is NULL when the pooled deviation is 0.
    """
    t = F.col(treat_col) == 1
    parts = {"media_tratado": (F.avg, t), "media_control": (F.avg, ~t), "_vt": (F.var_samp, t), "_vc": (F.var_samp, ~t)}
    wide = df.agg(*[F.struct(*[agg(F.when(arm, F.col(f).cast("double"))).alias(name) for name, (agg, arm) in parts.items()])
                    .alias(f"f{i}") for i, f in enumerate(features)])
    g = wide.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), *[F.col(f"f{i}")[n].alias(n) for n in parts])
                                        for i, f in enumerate(features)])).alias("p")).select("p.*")
    pooled = F.sqrt((F.col("_vt") + F.col("_vc")) / 2)
    return g.select("feature", "media_tratado", "media_control",
                    F.when(pooled > 0, (F.col("media_tratado") - F.col("media_control")) / pooled).alias("smd"))


def imbalance_levels(balance: DataFrame, alert: float = 0.25, good: float = 0.1) -> DataFrame:
    """C3 + O4: level per feature, alert flag above ``alert``, sorted by |SMD|."""
    a = F.abs("smd")
    return (balance.withColumn("abs_smd", a)
            .withColumn("nivel", F.when(a.isNull(), "indeterminado").when(a > alert, "grande")
                        .when(a > good, "moderado").otherwise("bueno"))
            .withColumn("alerta", F.coalesce(a > alert, F.lit(False)))
            .orderBy(F.asc_nulls_last("abs_smd"), "feature"))


def did_hc1(panel: DataFrame, treat_col: str, pre_col: str, post_col: str) -> DataFrame:
    """Difference-in-differences of ``y ~ treat * post`` with HC1 robust errors.

    The 2x2 saturated design makes OLS fitted values the four cell means, so
    coef = (m11 - m10) - (m01 - m00) and the HC1 variance is
    N / (N - 4) * Σ_cells SSR_c / n_c²; SSR_c = n_c * var_pop_c. Melting (U2)
    would double the rows to N = 2 x customers; the cells are read off the
    wide rows instead. One aggregate, no matrix.
    """
    aggs = []
    for tv in (0, 1):
        for pv, col in ((0, pre_col), (1, post_col)):
            y = F.when(F.col(treat_col).cast("int") == tv, F.col(col).cast("double"))
            in_cell = F.when(F.col(treat_col).cast("int") == tv, F.lit(1))
            aggs += [F.count(in_cell).alias(f"n{tv}{pv}"), F.avg(y).alias(f"m{tv}{pv}"), F.var_pop(y).alias(f"v{tv}{pv}")]
    a = panel.agg(*aggs)
    coef = (F.col("m11") - F.col("m10")) - (F.col("m01") - F.col("m00"))
    n = sum((F.col(f"n{t}{p}") for t in (0, 1) for p in (0, 1)), F.lit(0)).cast("double")
    hc0 = sum((F.col(f"v{t}{p}") / F.col(f"n{t}{p}") for t in (0, 1) for p in (0, 1)), F.lit(0.0))
    se = F.sqrt(n / (n - 4) * hc0)
    a = a.select(coef.alias("coef_did"), se.alias("se_hc1"), (coef / se).alias("z"), n.cast("long").alias("n_obs"),
                 "m00", "m01", "m10", "m11")
    return a.withColumn("p_value", two_sided_p(F.col("z")))


# Fixed value: 97.5 % quantile of the standard normal (two-sided 95 % interval).
Z_975 = 1.959963984540054


def ate_interval(scored: DataFrame, y: str, w: str, p_t: str, p_c: str) -> DataFrame:
    """ATE = mean(p_t - p_c) with the T-learner normal interval (population variances).

    se² = (var(y - p_c | w=0) / (1 - π) + var(y - p_t | w=1) / π + var(p_t - p_c)) / n.
    """
    wt = F.col(w) == 1
    a = scored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(w)).alias("n_t"),
                   F.avg(F.col(p_t) - F.col(p_c)).alias("ate"),
                   F.var_pop(F.when(~wt, F.col(y) - F.col(p_c))).alias("_v0"),
                   F.var_pop(F.when(wt, F.col(y) - F.col(p_t))).alias("_v1"),
                   F.var_pop(F.col(p_t) - F.col(p_c)).alias("_v2"))
    pi = F.col("n_t") / F.col("n")
    se = F.sqrt((F.col("_v0") / (1 - pi) + F.col("_v1") / pi + F.col("_v2")) / F.col("n"))
    return a.select("n", "ate", se.alias("se"), (F.col("ate") - Z_975 * se).alias("ate_lb"),
                    (F.col("ate") + Z_975 * se).alias("ate_ub"))


# --------------------------------------------------------------------- Qini, histogram, box

def qini_table(scored: DataFrame, score: str, y: str, w: str, n_buckets: int | None = None) -> DataFrame:
    """C13 core: Qini value after each distinct score (descending), normalised, plus the random line.

    q = ΣyT - ΣyC * nT / nC (0 while nC = 0); normalised by |q at the end|;
    the random line goes straight from 0 to the normalised end value. The
    per-score table is checkpointed; its four totals come back in one row.
    """
    from tidewater.operators.ranks import prefix_sums
    from tidewater.session import materialize
    wt = F.col(w).cast("long")
    yy = F.col(y).cast("long")
    t = materialize(scored.filter(F.col(score).isNotNull()).groupBy(score).agg(
        F.count(F.lit(1)).alias("n"), F.sum(wt).alias("nt"), F.sum(yy * wt).alias("yt"),
        F.sum(yy * (1 - wt)).alias("yc")))
    N, NT, YT, YC = t.agg(F.sum("n"), F.sum("nt"), F.sum("yt"), F.sum("yc")).first()
    N, NT, YT, YC = (v or 0 for v in (N, NT, YT, YC))
    q_end = float(YT - YC * NT / (N - NT)) if N - NT > 0 else 0.0
    scale = abs(q_end) if abs(q_end) > 0 else 1.0
    p = prefix_sums(t, score, ["n", "nt", "yt", "yc"], descending=True, n_buckets=n_buckets, materialized=True)
    cnc = F.col("cum_n") - F.col("cum_nt")
    q = F.when(cnc > 0, F.col("cum_yt") - F.col("cum_yc") * F.col("cum_nt") / cnc).otherwise(F.lit(0.0))
    return p.select(score, "n", "cum_n", (q / F.lit(scale)).alias("qini"),
                    (F.col("cum_n") / F.lit(N) * F.lit(q_end / scale)).alias("aleatorio"),
                    F.lit(N).cast("long").alias("n_total"))


def qini_curve(scored: DataFrame, score: str, y: str, w: str) -> DataFrame:
    """The whole curve, one point per distinct score (``qini_points`` thins it out)."""
    t = qini_table(scored, score, y, w)
    return t.select((F.col("cum_n") / F.col("n_total")).alias("fraccion"), "qini", "aleatorio")


def qini_points(scored: DataFrame, score: str, y: str, w: str, points: int = 100) -> DataFrame:
    """C13 thinned out for drawing: at most ``points`` + 1 points of the curve, evenly spread over the customers.

    Of the points in each 1 / ``points`` of the customers the last is kept, and so is the end. Between two kept points lie
    at most a ``points``-th of the customers, or one distinct score.
    """
    t = qini_table(scored, score, y, w)
    part = F.expr(f"cum_n * {int(points)} DIV n_total")
    kept = t.groupBy(part.alias("_part")).agg(F.max_by(F.struct("cum_n", "n_total", "qini", "aleatorio"), "cum_n").alias("_p"))
    return kept.select((F.col("_p.cum_n") / F.col("_p.n_total")).alias("fraccion"), "_p.qini", "_p.aleatorio")


def qini_score(scored: DataFrame, score: str, y: str, w: str) -> DataFrame:
    """C14: mean gap between the curve and the random line over all rows (and the origin)."""
    t = qini_table(scored, score, y, w)
    return t.agg(((F.sum(F.col("n") * (F.col("qini") - F.col("aleatorio")))) / (F.first("n_total") + 1))
                 .alias("qini_score"))


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Fixed-width histogram between the global min and max (last bin closed).

    min and max come back in one one-row action (input checkpointed first).
    """
    from tidewater.session import materialize
    v = materialize(df.select(col).filter(F.col(col).isNotNull()))
    mn, mx = v.agg(F.min(col), F.max(col)).first()
    if mn is None:
        return v.sparkSession.createDataFrame([], "bin int, desde double, hasta double, n bigint")
    width = (mx - mn) / bins
    b = F.when(F.lit(width) > 0, F.least(F.floor((F.col(col) - F.lit(mn)) / F.lit(width)), F.lit(bins - 1))) \
        .otherwise(F.lit(0))
    return (v.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.lit(mn) + F.col("bin") * F.lit(width)).alias("desde"),
                    (F.lit(mn) + (F.col("bin") + 1) * F.lit(width)).alias("hasta"), "n"))


def box_summary(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Exact discrete quartiles per group and 1.5 IQR whiskers at data points."""
    from tidewater.operators.ranks import exact_quantiles
    v = df.filter(F.col(value_col).isNotNull())
    q = exact_quantiles(v, [group_col], value_col, [0.25, 0.5, 0.75])
    q = q.select(group_col, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("mediana"), F.col("q")[2].alias("q3"))
    j = v.join(q, group_col)
    iqr = F.col("q3") - F.col("q1")
    x = F.col(value_col)
    return j.groupBy(group_col, "n", "q1", "mediana", "q3").agg(
        F.min(F.when(x >= F.col("q1") - 1.5 * iqr, x)).alias("bigote_inf"),
        F.max(F.when(x <= F.col("q3") + 1.5 * iqr, x)).alias("bigote_sup"))
