"""Lookup join with a dimension table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import materialize

#: A missing key matches nothing; it is spread over this many keys that no dimension holds.
MISSING_KEYS = 997


def lookup_join(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact left join dim on ``key`` (a string).

    The dimension is reduced to one row per key (of rows that repeat a key the
    least one, so a repeated key cannot multiply facts), written once and
    joined plainly: adaptive execution broadcasts it by its measured bytes or
    splits hot keys. Facts without a key would all meet in one task of a
    shuffle join; they get one of ``MISSING_KEYS`` stand-ins instead.
    """
    others = [c for c in dim.columns if c != key]
    one = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("_d"))
    one = materialize(one.select(F.col(key).alias("_key"), *[F.col(f"_d.{c}").alias(c) for c in others]))
    stand_in = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*fact.columns), F.lit(MISSING_KEYS)).cast("string"))
    return fact.withColumn("_key", F.coalesce(F.col(key), stand_in)).join(one, "_key", "left").drop("_key")
