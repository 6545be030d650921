"""URL filters: host-suffix / path-prefix expressions looked up by hash.

Each URL is expanded into every pair (host suffix at a label boundary, path
prefix of a length that some rule has).  The expression's SHA-256 digest is
cut to a short prefix; expressions meet rules in an equi-join on that prefix,
the full digest confirms the hit, and the longest fitting rule decides.

Edge cases: a null URL or one without ``://`` has an empty host and path and
meets no rule; the same URL on many rows is expanded once and the verdict is
joined back, so each input row comes back exactly once, repeated rows and null
ids included.  Rules that are written twice count once; of two rules with the
same text, ``block`` wins.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.llm.common import small

#: Hex digits of the digest that the join uses (4 bytes, as URL lists ship them).
PREFIX = 8
_AFTER = "(?s)^.*?://"


def url_host(url: Column) -> Column:
    """The text after the first :// up to / ? # or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, _AFTER + "([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, _AFTER + "[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (verdict, host, path) as a table for ``filter_urls``."""
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, rule_host string, rule_path string")


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule (null: none fits) and verdict of every page.

    ``rules`` has verdict, rule_host, rule_path; a rule fits its host and all
    subdomains, for paths that start with its path; the longest one wins.
    """
    rules = (
        rules.where("rule_host is not null and rule_path is not null")
        .select(F.concat("rule_host", "rule_path").alias("rule"), F.length("rule_path").alias("cut"), "verdict")
        .groupBy("rule", "cut").agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("digest", F.sha2("rule", 256))
        .withColumn("prefix", F.substring("digest", 1, PREFIX))
    )
    # As many lengths as rule paths have, never more than the longest path.
    cuts = sorted(r[0] for r in rules.select("cut").distinct().collect())
    asked = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    heads = F.filter(
        F.array(*[F.when(F.length("path") >= c, F.substring("path", 1, c)) for c in cuts]) if cuts else F.array().cast("array<string>"),
        lambda p: p.isNotNull(),
    )
    said = (
        asked.where("host <> '' or path <> ''").groupBy("host", "path").agg(F.lit(1).alias("one"))
        .withColumn("suffix", F.explode(suffixes)).withColumn("head", F.explode(heads))
        .withColumn("own_digest", F.sha2(F.concat("suffix", "head"), 256))
        .withColumn("cut", F.length("head"))
        .withColumn("prefix", F.substring("own_digest", 1, PREFIX))
        .join(small(rules), ["prefix", "cut"])
        .where("own_digest = digest")
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "rule_verdict"), F.struct(F.length("rule"), "rule_verdict", "rule")).alias("best"))
        .select("host", "path", "best.rule", "best.rule_verdict")
    )
    return asked.join(said, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict")
    )
