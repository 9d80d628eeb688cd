"""Exact null distributions of the rank tests, per group, as Column expressions.

Under the null hypothesis every choice of ``n1`` of the ``n`` rows (every choice of signs) is equally likely. How many of
them reach a given rank sum is counted by a dynamic programme over the ranks, carried in one array per group: taking
a rank up shifts the counts by it. Ties keep their average ranks, so the distribution is that of the data at hand
(without ties the textbook one). Ranks are doubled to whole numbers.

Ranks come from the distributed running sums of ``ranks.py``, whatever a group's size; only groups of at most
``max_rows`` rows are gathered, the others have no p-value (NULL): the choice between this and the normal
approximation is the caller's, never the data's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ranks import prefix_sums
from tidewater.session import materialize

MAX_ROWS = 40  # the counts of 2 ** 40 choices are exact in doubles
ALTERNATIVES = ("two-sided", "greater", "less")


def shifted(counts: Column, i: Column, back: Column, inside: Column) -> Column:
    """The count ``back`` places before ``i``, 0 where that is outside."""
    return F.when(inside, F.get(counts, (i - back).cast("int"))).otherwise(F.lit(0.0))


def one_at(size: Column) -> Column:
    """``size`` counts: 1 for the empty choice, else 0."""
    return F.transform(F.sequence(F.lit(1), size), lambda i: F.when(i == 1, F.lit(1.0)).otherwise(F.lit(0.0)))


def subset_sums(ranks: Column, most: Column) -> Column:
    """For each sum 0 .. ``most`` the number of subsets of ``ranks`` (whole numbers) that add up to it."""
    return F.aggregate(ranks, one_at(most + 1), lambda counts, r: F.transform(
        counts, lambda x, i: x + shifted(counts, i, r, i >= r)))


def subset_sums_of(ranks: Column, size: Column, most: Column) -> Column:
    """For each sum 0 .. ``most`` the number of subsets with ``size`` members that add up to it.

    The array holds a stretch of ``most`` + 1 counts for each number of members up to ``size``.
    """
    width = most + 1
    whole = F.aggregate(ranks, one_at((size + 1) * width), lambda counts, r: F.transform(
        counts, lambda x, i: x + shifted(counts, i, width + r, (i >= width) & (F.pmod(i, width) >= r))))
    return F.slice(whole, size * width + 1, width)


def total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)


def exact_p(counts: Column, observed: Column, alternative: str) -> Column:
    """Share of choices whose sum is at least (at most) the ``observed``; two-sided: twice the smaller, 1 at most."""
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative must be one of {ALTERNATIVES}")
    upper = total(F.slice(counts, observed + 1, F.size(counts) - observed)) / total(counts)
    lower = total(F.slice(counts, F.lit(1), observed + 1)) / total(counts)
    both = F.least(F.lit(1.0), F.lit(2.0) * F.least(upper, lower))
    return {"greater": upper, "less": lower, "two-sided": both}[alternative]


def _ranked(values: DataFrame, by: list[str], counts: dict[str, Column], max_rows: int) -> DataFrame:
    """Per group: ``n``, each of ``counts`` with its sum of doubled ranks (``r2_<name>``), and the doubled ranks of small groups."""
    t = values.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(k) for k, c in counts.items()])
    p = prefix_sums(t, "_v", ["_n"], by=by).withColumn("_r2", 2 * F.col("cum__n") - F.col("_n") + 1)
    p = materialize(p.select(*by, "_n", "_r2", *counts))
    sizes = p.groupBy(*by).agg(F.sum("_n").alias("n")).select(*[F.col(c).alias(f"_by_{c}") for c in by], "n")
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    tie = F.when(F.col("n") <= max_rows, F.struct("_r2", "_n"))
    g = p.join(sizes, on).groupBy(*by, "n").agg(
        *[F.sum(k).alias(k) for k in counts], *[F.sum(F.col(k) * F.col("_r2")).alias(f"r2_{k}") for k in counts],
        F.collect_list(tie).alias("_ties"))
    ranks = F.flatten(F.transform(F.array_sort("_ties"), lambda t: F.array_repeat(t["_r2"].cast("int"), t["_n"].cast("int"))))
    return g.withColumn("_ranks", F.when(F.col("n") <= max_rows, ranks)).drop("_ties")


def _halved(g: DataFrame, *sums: str) -> DataFrame:
    """Ranks and their sums in units of 2 where no rank is odd (no ties of an even number of rows): half the counts."""
    unit = F.when(F.forall("_ranks", lambda r: r % 2 == 0), F.lit(2)).otherwise(F.lit(1))
    g = g.withColumn("_unit", unit)
    g = g.withColumn("_ranks", F.transform("_ranks", lambda r: (r / F.col("_unit")).cast("int")))
    g = g.withColumns({f"_u_{c}": (F.col(c) / F.col("_unit")).cast("int") for c in sums})
    return g.withColumn("_most", F.aggregate("_ranks", F.lit(0), lambda a, r: a + r))


def _with_p(g: DataFrame, usable: Column, counts: Column, observed: str, alternative: str, drawn: Sequence[str] = ()) -> DataFrame:
    """``g`` with ``p_value``, NULL where not ``usable``.

    The distribution hangs on the ranks (and on how many are ``drawn``) alone, and without ties all groups of one size have
    the same ranks. So each distribution that occurs is counted once, for all sums observed under it, and joined to its groups.
    """
    case = ["_ranks", *drawn]
    g = materialize(g.withColumn("_p_of", F.when(usable, F.struct(*case, observed))))
    seen = (g.where(F.col("_p_of").isNotNull()).groupBy(*case, "_most").agg(F.collect_set(observed).alias("_sums"))
            .withColumn("_counts", counts))
    p = seen.select(*case, F.explode("_sums").alias(observed), "_counts").select(
        F.struct(*case, observed).alias("_p_of"), exact_p(F.col("_counts"), F.col(observed), alternative).alias("p_value"))
    return g.join(p, "_p_of", "left").drop("_p_of")


def mann_whitney_exact(df: DataFrame, by: Sequence[str], value_col: str, group1: Column, alternative: str = "greater",
                       max_rows: int = MAX_ROWS) -> DataFrame:
    """C7 per group of ``by``: ``n1, n2, u, p_value`` of group 1 against the rest, p from the exact distribution.

    NULL values and rows with a NULL group are left out. ``p_value`` is NULL if a side is empty, or beyond ``max_rows``.
    """
    by = list(by)
    d = df.select(*by, F.col(value_col).alias("_v"), group1.cast("int").alias("_g")).where("_v IS NOT NULL AND _g IS NOT NULL")
    g = _halved(_ranked(d, by, {"n1": F.col("_g")}, max_rows), "r2_n1")
    u = F.col("r2_n1") / F.lit(2.0) - F.col("n1") * (F.col("n1") + 1) / F.lit(2.0)
    n1 = F.col("n1").cast("int")
    usable = F.col("_ranks").isNotNull() & (F.col("n1") > 0) & (F.col("n1") < F.col("n"))
    g = _with_p(g, usable, subset_sums_of(F.col("_ranks"), n1, F.col("_most")), "_u_r2_n1", alternative, ["n1"])
    return g.select(*by, F.col("n1").cast("long").alias("n1"), (F.col("n") - F.col("n1")).alias("n2"), u.alias("u"), "p_value")


def wilcoxon_exact(df: DataFrame, by: Sequence[str], x_col: str, y_col: str, alternative: str = "two-sided",
                   max_rows: int = MAX_ROWS) -> DataFrame:
    """C6 per group of ``by``: ``n, r_mas, r_menos, p_value`` of the differences x - y, p from the exact distribution.

    NULL and zero differences are left out; a group without any other has no row. ``p_value`` is NULL beyond ``max_rows``.
    """
    by = list(by)
    d = df.select(*by, (F.col(x_col) - F.col(y_col)).alias("_d")).where("_d IS NOT NULL AND _d <> 0")
    d = d.select(*by, F.abs("_d").alias("_v"), (F.col("_d") > 0).cast("int").alias("_pos"))
    g = _halved(_ranked(d, by, {"n_pos": F.col("_pos")}, max_rows), "r2_n_pos")
    whole = F.col("n") * (F.col("n") + 1) / F.lit(2.0)
    plus = F.col("r2_n_pos") / F.lit(2.0)
    g = _with_p(g, F.col("_ranks").isNotNull(), subset_sums(F.col("_ranks"), F.col("_most")), "_u_r2_n_pos", alternative)
    return g.select(*by, "n", plus.alias("r_mas"), (whole - plus).alias("r_menos"), "p_value")
