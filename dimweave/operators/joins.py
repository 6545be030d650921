"""Join strategies with explicit choices.

``join_broadcast`` broadcasts the small side only when its counted rows
(filters included) are at most a limit; beyond it the join is left to the
planner (sort-merge with adaptive re-planning).
``join_bucketed`` reads two tables bucketed alike on the key, so that the join
needs no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows (of a few narrow columns) that are broadcast at most.
BROADCAST_ROWS = 500_000


def join_broadcast(big: DataFrame, small: DataFrame, on, how: str = "inner", *,
                   limit_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with ``small`` broadcast if it has at most ``limit_rows`` rows.  The
    count is a partial aggregate, and sees what filters leave."""
    few = small.count() <= limit_rows
    return big.join(F.broadcast(small) if few else small, on=on, how=how)


def join_sort_merge(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Force a shuffle sort-merge join regardless of size."""
    return left.join(right.hint("merge"), on=on, how=how)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   partition_by: list[str] | None = None, files_per_bucket: int = 1) -> None:
    """Save ``df`` as an external table at ``path``: hash-bucketed on ``key``
    (and sorted within files), optionally below partition columns.

    Rows are dealt by partition value and bucket, so each (partition, bucket) is
    written by one task, into one file, and there are as many tasks as such
    pairs, up to the session's shuffle partitions.  ``files_per_bucket`` deals
    each bucket by a salt from the whole row to so many tasks: a key with very
    many rows, or a table without partitions, is then not written by one task.
    A reader still sees one bucket."""
    parts = partition_by or []
    # The table's own bucket rule: the 32-bit hash of the key, modulo their number.
    deal = [*parts, F.pmod(F.hash(key), F.lit(buckets))]
    if files_per_bucket > 1:
        deal.append(F.pmod(F.xxhash64(*df.columns), F.lit(files_per_bucket)))
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets * files_per_bucket)
    w = df.repartition(tasks, *deal).write.mode("overwrite").option("path", path)
    if parts:
        w = w.partitionBy(*parts)
    w.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def join_bucketed(spark: SparkSession, left_table: str, right_table: str, on: str,
                  left_filter=None) -> DataFrame:
    """Merge join of two tables bucketed on ``on``: each task reads bucket i of
    both sides, so neither side is shuffled (the merge hint keeps the planner
    from swapping in a broadcast when one side looks small).  If one number of
    buckets is a multiple of the other, the side with more reads several as one,
    where the session allows it
    (``spark.sql.bucketing.coalesceBucketsInJoin.enabled``, as
    ``build_session`` does); else one side is shuffled."""
    left = spark.table(left_table)
    if left_filter is not None:
        left = left.where(left_filter)
    return left.join(spark.table(right_table).hint("merge"), on=on)
