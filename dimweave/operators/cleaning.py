"""Outlier removal, histograms and feature columns.

Column statistics are one-row global aggregates (partial aggregation on
every partition, one tiny final step) used as scalar subqueries: Spark
computes the value once and the filter reads it as a constant -- no join,
nothing that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_stats(df: DataFrame, col: str) -> Column:
    """One scalar (a struct: mean, sd, lo, hi) computed once over ``col``."""
    return df.select(F.struct(F.avg(col).alias("mean"), F.stddev_pop(col).alias("sd"),
                              F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()


def outlier_zscore(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Drop rows with |z| >= k (population deviation), then rows <= 0.
    NULL values are ignored in the statistics and dropped by the filter; a
    zero deviation gives NULL z, so every row is dropped."""
    st = column_stats(df, col)
    z = F.try_divide(F.col(col) - st["mean"], st["sd"])
    return df.where((F.abs(z) < k) & (F.col(col) > 0))


def outlier_stddev_cut(df: DataFrame, col: str, k: float = 3.0) -> DataFrame:
    """Keep 0 < v < k * sigma (sigma of the whole column, not centred)."""
    sd = column_stats(df, col)["sd"]
    return df.where((F.col(col) > 0) & (F.col(col) < sd * k))


def histogram_fixed_bins(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Row count per equal-width bin over [min, max]; the maximum belongs to
    the last bin.  Bins are numbered 1..bins and all of them are listed."""
    st = column_stats(df, col)
    lo, hi = st["lo"], st["hi"]
    width = hi - lo
    raw = F.floor((F.col(col) - lo) * bins / F.when(width != 0, width)) + 1
    b = F.least(F.coalesce(raw, F.lit(1)), F.lit(bins)).cast("int")
    counts = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("num_rows"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (lo + (F.col("bin") - 1) * (hi - lo) / bins).alias("bin_start"),
        F.coalesce("num_rows", F.lit(0)).alias("num_rows"))


def ratio(num: str, den: str):
    """num / den, NULL when den is 0 or NULL."""
    return F.try_divide(F.col(num), F.col(den))


def feature_ratio(df: DataFrame, out: str, num: str, den: str) -> DataFrame:
    return df.withColumn(out, ratio(num, den))
