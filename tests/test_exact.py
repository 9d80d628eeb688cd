"""Exact rank tests against enumeration of all choices, and erfc's plan."""

import itertools
import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidewater.operators import exact as ex
from tidewater.operators import stats as st


def average_ranks(values):
    return [Fraction(2 * sum(w < v for w in values) + sum(w == v for w in values) + 1, 2) for v in values]


def tails(sums, observed, alternative):
    n = sum(sums.values())
    upper, lower = (Fraction(sum(c for s, c in sums.items() if keep(s)), n) for keep in (lambda s: s >= observed, lambda s: s <= observed))
    return float({"greater": upper, "less": lower, "two-sided": min(Fraction(1), 2 * min(upper, lower))}[alternative])


def brute_mann_whitney(a, b, alternative):
    ranks = average_ranks(a + b)
    sums = Counter(sum(c) for c in itertools.combinations(ranks, len(a)))
    r1 = sum(ranks[:len(a)])
    return float(r1 - Fraction(len(a) * (len(a) + 1), 2)), tails(sums, r1, alternative)


def brute_wilcoxon(d, alternative):
    d = [x for x in d if x]
    ranks = average_ranks([abs(x) for x in d])
    sums = Counter(sum(r for r, s in zip(ranks, signs) if s) for signs in itertools.product((0, 1), repeat=len(d)))
    plus = sum(r for r, x in zip(ranks, d) if x > 0)
    return float(plus), tails(sums, plus, alternative)


@pytest.mark.parametrize("alternative", ex.ALTERNATIVES)
def test_mann_whitney_equals_enumeration(spark, alternative):
    """All sizes up to 8 and 8, without ties and with many."""
    rng, rows, want = random.Random(1), [], {}
    for n1, n2, most in itertools.product(range(1, 9), range(1, 9), (4, 10 ** 6)):
        a, b = ([rng.randrange(most) for _ in range(n)] for n in (n1, n2))
        key = f"{n1}-{n2}-{most}"
        rows += [(key, float(v), 1) for v in a] + [(key, float(v), 0) for v in b]
        want[key] = brute_mann_whitney(a, b, alternative)
    rows += [("one side", 1.0, 1), ("one side", 2.0, 1), (None, 1.0, 1), (None, 3.0, 0), ("1-1-4", None, 1), ("1-1-4", 5.0, None)]
    df = spark.createDataFrame(rows, "k string, x double, g int")
    got = {r.k: r for r in ex.mann_whitney_exact(df, ["k"], "x", F.col("g"), alternative).collect()}
    for key, (u, p) in want.items():
        assert got[key].u == u and abs(got[key].p_value - p) < 1e-12, key
    assert got["one side"].p_value is None and got["one side"].n2 == 0
    assert got[None].p_value == brute_mann_whitney([1.0], [3.0], alternative)[1]


@pytest.mark.parametrize("alternative", ex.ALTERNATIVES)
def test_wilcoxon_equals_enumeration(spark, alternative):
    rng, rows, want = random.Random(2), [], {}
    for n, most in itertools.product(range(1, 13), (3, 10 ** 6)):
        d = [rng.randrange(-most, most + 1) or 1 for _ in range(n)]
        rows += [(f"{n}-{most}", float(x + 7), 7.0) for x in d]
        want[f"{n}-{most}"] = brute_wilcoxon(d, alternative)
    rows += [("12-3", 7.0, 7.0), ("12-3", None, 1.0), ("zeros", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    got = {r.k: r for r in ex.wilcoxon_exact(df, ["k"], "x", "y", alternative).collect()}
    assert set(got) == set(want)
    for key, (plus, p) in want.items():
        assert got[key].r_mas == plus and abs(got[key].p_value - p) < 1e-12, key


def test_published_critical_values(spark):
    """Textbook tails: U = 0 of 5 and 5 has 1 / 252; R+ = 55 of 10 has 1 / 1024."""
    df = spark.createDataFrame([(float(v), int(v > 5)) for v in range(1, 11)], "x double, g int")
    r = st.mann_whitney(df, "x", F.col("g") == 1, method="exact").first()
    assert (r.n1, r.n2, r.u) == (5, 5, 25.0) and abs(r.p_value - 1 / 252) < 1e-15
    w = st.wilcoxon_signed_rank(df.withColumn("y", F.lit(0.0)), "x", "y", alternative="greater", method="exact").first()
    assert (w.n, w.r_mas, w.r_menos) == (10, 55.0, 0.0) and abs(w.p_value - 1 / 1024) < 1e-15


def test_large_groups_have_no_exact_p(spark):
    df = spark.range(400).selectExpr("CASE WHEN id < 390 THEN 'big' ELSE 'small' END AS k", "CAST(id % 97 AS DOUBLE) AS x", "id % 2 AS g")
    got = {r.k: r for r in ex.mann_whitney_exact(df, ["k"], "x", F.col("g")).collect()}
    assert got["big"].p_value is None and got["big"].n1 + got["big"].n2 == 390 and 0 < got["small"].p_value <= 1
    assert ex.mann_whitney_exact(df.limit(0), ["k"], "x", F.col("g")).count() == 0


def test_the_normal_approximation_nears_the_exact_p(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.gauss(0.3 * g, 1), g) for g in (0, 1) for _ in range(20)], "x double, g int")
    near, right = (st.mann_whitney(df, "x", F.col("g") == 1, method=m).first().p_value for m in ("normal", "exact"))
    assert abs(near - right) < 0.01


def test_erfc_keeps_the_plan_small(spark):
    df = spark.range(10).select((F.col("id") / 3.0 - 1).alias("z"))
    plan = df.select(st.two_sided_p(F.col("z")).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 8_000
    p = [r.p for r in df.select(st.two_sided_p(F.col("z")).alias("p")).collect()]
    assert all(abs(x - math.erfc(abs(k / 3.0 - 1) / math.sqrt(2))) < 1e-13 for k, x in enumerate(p))


def test_a_distribution_is_counted_once_for_all_groups_of_the_same_ranks(spark, monkeypatch):
    """60 customers of six different amounts have the same ranks: their choices are counted once, not 60 times."""
    counted, real, rng = spark.sparkContext.accumulator(0), ex.subset_sums_of, random.Random(5)
    tick = F.udf(lambda r: counted.add(1) or r, "array<int>")
    monkeypatch.setattr(ex, "subset_sums_of", lambda ranks, size, most: real(tick(ranks), size, most))
    groups = {f"k{i}": rng.sample(range(10 ** 6), 6) for i in range(60)}
    df = spark.createDataFrame([(k, float(v), int(i < 3)) for k, vs in groups.items() for i, v in enumerate(vs)], "k string, x double, g int")
    got = {r.k: r.p_value for r in ex.mann_whitney_exact(df, ["k"], "x", F.col("g")).collect()}
    for k, vs in groups.items():
        assert abs(got[k] - brute_mann_whitney(vs[:3], vs[3:], "greater")[1]) < 1e-12
    assert counted.value <= 4
