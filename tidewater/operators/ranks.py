"""Global ranks and running sums without a single-partition window.

``Window.orderBy(x)`` with no partition key moves every row to one task. The
recipe here keeps the work distributed, with one algorithm at all sizes:

1. pre-aggregate by the ordering value (ties collapse to one row, with counts);
2. range-partition the distinct values into buckets of about ``BUCKET_ROWS``
   rows (the number follows the measured row count, without a ceiling) and
   write them with their bucket number, so a recompute after executor loss
   reads the same buckets. The order is Spark's own order of the column:
   exact for longs and decimals, NaN after all numbers;
3. running sums inside ``Window.partitionBy(bucket).orderBy(value)``; bucket
   totals (one row per bucket) get an exclusive running sum and are joined back.

Average rank with ties = rows before the value + (n + 1) / 2.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import materialize

BUCKET_ROWS = 100_000


def prefix_sums(t: DataFrame, order_col: str, sum_cols: Sequence[str], descending: bool = False,
                n_buckets: int | None = None, prefix: str = "cum_", materialized: bool = False,
                by: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` over distinct ``order_col`` values, within each ``by`` group.

    ``t`` is written first (unless ``materialized``) so its upstream runs once.
    """
    by = list(by)
    if not materialized:
        t = materialize(t)
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    nb = n_buckets or max(1, math.ceil(t.count() / BUCKET_ROWS))
    b = materialize(t.repartitionByRange(nb, *by, key).withColumn("_b", F.spark_partition_id()))
    w_in = Window.partitionBy("_b", *by).orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = b.withColumns({f"_in_{c}": F.sum(c).over(w_in) for c in sum_cols})
    totals = b.groupBy("_b", *by).agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    # one row per bucket and group: bounded by the number of buckets plus that of groups
    w_tot = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("_b").alias("_ob"), *[F.col(c).alias(f"_by_{c}") for c in by],
                            *[F.coalesce(F.sum(f"_t_{c}").over(w_tot), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    on = F.col("_b") == F.col("_ob")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    out = within.join(offsets, on)
    out = out.withColumns({f"{prefix}{c}": F.col(f"_in_{c}") + F.col(f"_o_{c}") for c in sum_cols})
    return out.drop("_b", "_ob", *[f"_by_{c}" for c in by], *[f"_in_{c}" for c in sum_cols],
                    *[f"_o_{c}" for c in sum_cols])


def exact_quantiles(df: DataFrame, by: Sequence[str], value_col: str, probs: Sequence[float]) -> DataFrame:
    """One row per group of ``by`` (one column at least): ``n`` and ``q`` (the discrete quantiles: least value with at least p * n rows up to it).

    Rows are counted by distinct value and the counts summed in order: exact at any size, with no sketch and
    no group gathered in one task. NULL values are left out.
    """
    by = list(by)
    t = df.where(F.col(value_col).isNotNull()).groupBy(*by, value_col).agg(F.count(F.lit(1)).alias("n"))
    p = materialize(prefix_sums(t, value_col, ["n"], by=by))
    total = p.groupBy(*by).agg(F.sum("n").alias("_total")).select(*[F.col(c).alias(f"_by_{c}") for c in by], "_total")
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    j = p.join(total, on)
    least = [F.min(F.when(F.col("cum_n") >= F.lit(x) * F.col("_total"), F.col(value_col))) for x in probs]
    return j.groupBy(*by).agg(F.first("_total").alias("n"), F.array(*least).alias("q"))


def average_ranks(df: DataFrame, value_col: str, counts: Mapping[str, Column] | None = None,
                  n_buckets: int | None = None) -> DataFrame:
    """One row per distinct value with ``n``, extra per-value sums and ``avg_rank``."""
    counts = dict(counts or {})
    t = (df.filter(F.col(value_col).isNotNull())
           .groupBy(value_col)
           .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(k) for k, c in counts.items()]))
    p = prefix_sums(t, value_col, ["n"], n_buckets=n_buckets)
    return p.withColumn("avg_rank", (F.col("cum_n") - F.col("n")).cast("double")
                        + (F.col("n") + F.lit(1)).cast("double") / F.lit(2.0)).drop("cum_n")


def tie_term(n: Column) -> Column:
    """Σ (t³ - t) contribution of one tie group, in double to avoid long overflow."""
    d = n.cast("double")
    return d * d * d - d
