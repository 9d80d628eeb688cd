"""URL filters: host-suffix / path-prefix expressions, short hash prefixes, full digests, rule precedence.

Each URL is expanded into the expressions that a rule could equal; the expressions meet the rules in an
equi-join on the first 32 bits of their SHA-256, the full digests confirm, and the longest rule wins. Only
distinct URLs are expanded, so a URL that holds a third of all rows costs one expansion; the verdicts then
join back to the rows (an ordinary join that adaptive execution may split or broadcast by measured size).

Defined results: a NULL URL or one without ``://`` has an empty host and path and gets the default verdict;
an empty path does not start with ``/``, so it fits only rules with an empty path. Repeated rows each get
their own row. Two rules of one length: the longer host wins, then ``block``. An empty table gives no rows;
columns other than the id and the URL are ignored, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower

PREFIX_HEX = 8  # 32 bits
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``; both empty for a NULL URL or one without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    return df.withColumns({"host": ascii_lower(F.regexp_extract(u, URL_PARTS, 1)),
                           "path": F.regexp_extract(u, URL_PARTS, 2)})


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as (rule, verdict) rows, e.g. ``("example.org/es/", "block")``."""
    return spark.createDataFrame(rules, "rule string, verdict string")


def _expression(suffix: Column):
    return lambda n: F.concat(suffix, F.substr(F.col("path"), F.lit(1), n))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, the winning rule (or NULL) and its verdict (or ``default``)."""
    r = (rules.where(F.col("rule").isNotNull())
         .withColumn("r_host", ascii_lower(F.substring_index("rule", "/", 1)))
         .withColumn("r_path", F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)"))
         .withColumn("r_digest", F.sha2(F.concat("r_host", "r_path"), 256))
         .withColumn("r_labels", F.size(F.split("r_host", r"\."))))
    # The shapes of the rules bound the expansion: which numbers of host labels occur, and which path lengths.
    shapes: dict[int, list[int]] = {}
    for k, n in r.select("r_labels", F.length("r_path")).distinct().collect():
        shapes.setdefault(k, []).append(n)

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    urls = split_url(rows.select("url").where(F.col("url").isNotNull()).distinct())
    none = F.array().cast("array<string>")
    options = []
    for k, lengths in sorted(shapes.items()):
        suffix = F.substring_index("host", ".", -k)
        fits = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]), lambda n: n <= F.length("path"))
        cut = F.transform(fits, _expression(suffix))
        options.append(F.when(F.size(F.split("host", r"\.")) >= k, cut).otherwise(none))
    wanted = urls.select("url", F.explode(F.array_distinct(F.concat(*options) if options else none)).alias("expr"))
    wanted = wanted.withColumn("digest", F.sha2("expr", 256))
    met = (wanted.withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
           .join(r.withColumn("prefix", F.substring("r_digest", 1, PREFIX_HEX)), "prefix")
           .where(F.col("digest") == F.col("r_digest")))
    order = F.struct(F.length("rule"), F.length("r_host"), F.col("verdict") == "block", "rule", "verdict")
    best = met.groupBy("url").agg(F.max(order).alias("best"))
    found = best.select("url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    return (split_url(rows.join(found, "url", "left"))
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
