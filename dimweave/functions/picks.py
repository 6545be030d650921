"""Row picks and bounded list collection.

``first_per_key`` keeps one row per key -- the smallest in a given order --
with ``row_number() = 1``.  Spark plans this with a *partial*
``WindowGroupLimit`` below the shuffle: each map task forwards at most one
row per key, so a key holding a large share of the rows is cut down before
the exchange (like a partial aggregation) instead of being sorted whole in
one task.  Columns a caller does not use are pruned below the window.

``collect_lists`` gathers a group's values into a fixed number of arrays: each
value goes to the bucket that the MD5 of its text names (uniform whatever the
values look like, any type, and reproducible in SQL engines), so a hot group
is collected by several tasks.  Every group has the same number of rows,
whatever its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the row that sorts first on ``order`` (ties in
    ``order`` leave the pick arbitrary, so pass a total order)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def text_bucket(c):
    """A uniform 32-bit bucket of a value: the first 8 hex digits of the
    MD5 of its text."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")


def collect_lists(df: DataFrame, keys: list[str], value: str, *, buckets: int,
                  out: str = "values", bucket_col: str = "bucket") -> DataFrame:
    """``buckets`` rows per ``keys`` (NULL keys are a group like any other),
    each with the sorted list of the group's values in that bucket.  NULL
    values are left out, as in any collected list; an empty bucket is an empty
    list."""
    tagged = df.select(*keys, value, F.pmod(text_bucket(F.col(value)), F.lit(buckets)).cast("int").alias(bucket_col))
    every = df.select(*keys).distinct().select(
        *keys, F.lit(None).cast(df.schema[value].dataType).alias(value),
        F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias(bucket_col))
    return (tagged.where(F.col(value).isNotNull()).unionByName(every)
            .groupBy(*keys, bucket_col).agg(F.array_sort(F.collect_list(value)).alias(out)))
