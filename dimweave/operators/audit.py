"""Keys, audits, stage-audit-publish loads and a table of loads.

Audits are DataFrames of failing rows evaluated on the executors; only a
bounded number of failing rows is ever brought to the driver (to build the
error message).  Every write goes to a new path, which is handed out only
after its checks have passed, so a job that fails leaves the old data as they
are.  A loaded table is a directory of batches (rows carry their load id) and
an append-only log of the loads.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dimweave.operators.layout import drop_path


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows breaking a declared primary key: duplicate keys or a NULL key part."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_rows"))
            .where((F.col("num_rows") > 1) | any_null))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def set_comparison(df: DataFrame, col: str, expected: DataFrame) -> DataFrame:
    """Distinct values of ``col`` against an expected set (one column, any
    name): one row per value with where it was found."""
    got = df.select(F.col(col).alias("value")).distinct().withColumn("in_data", F.lit(True))
    exp = expected.select(F.col(expected.columns[0]).alias("value")).distinct() \
        .withColumn("in_expected", F.lit(True))
    j = got.join(exp, on="value", how="full_outer")
    return j.select("value", F.coalesce("in_data", F.lit(False)).alias("in_data"),
                    F.coalesce("in_expected", F.lit(False)).alias("in_expected"))


def audit_set_equal(df: DataFrame, col: str, expected: DataFrame) -> DataFrame:
    """Failing rows of a set-equality audit: values missing or unexpected.
    Real set equality (a same-size wrong set fails)."""
    cmp = set_comparison(df, col, expected)
    return cmp.where(F.col("in_data") != F.col("in_expected"))


def assert_no_rows(failures: DataFrame, what: str, show: int = 5) -> None:
    """Raise if an audit returned rows; only ``show`` rows reach the driver."""
    bad = failures.limit(show).collect()
    if bad:
        raise AssertionError(f"audit failed: {what}: {[r.asDict() for r in bad]}")


def staged_vs_published(staged: DataFrame, published: DataFrame, group: str) -> DataFrame:
    s = staged.groupBy(group).agg(F.count(F.lit(1)).alias("staged_count"))
    p = published.groupBy(group).agg(F.count(F.lit(1)).alias("published_count"))
    return s.join(p, on=group, how="full_outer")


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], partition_by: list[str] | None = None) -> dict:
    """Write ``df`` to the new ``path`` and return aggregates of the written rows
    that the write itself has observed, so that they cost no second read.  They
    are observed behind the shuffle, in the tasks that write."""
    if partition_by:
        # One task for each partition value, more where a value has many rows.
        df = df.hint("rebalance", *map(F.col, partition_by))
    seen = Observation()
    rows = df.observe(seen, *[c.alias(name) for name, c in metrics.items()]) if metrics else df
    (rows.write.partitionBy(*partition_by) if partition_by else rows.write).parquet(path)
    return seen.get if metrics else {}


@dataclass(frozen=True)
class Observed:
    """An audit by aggregates of the written rows: ``metrics`` (name -> aggregate)
    and ``failures``, from their values to what is wrong (nothing, if empty)."""

    metrics: dict[str, Column]
    failures: Callable[[dict], list]


def no_rows_where(condition: Column) -> Observed:
    """No row may meet the condition."""
    return Observed({"rows": F.count_if(condition)}, lambda got: [f"{got['rows']} rows"] if got["rows"] else [])


def values_equal(col: str, expected: list) -> Observed:
    """The column's distinct values are the expected ones (NULL is a value): no
    row has another one, and each is there."""
    is_one = reduce(lambda a, b: a | b, [F.col(col).eqNullSafe(F.lit(v)) for v in expected], F.lit(False))
    metrics = {"unexpected": F.count_if(~is_one)} | {f"v{k}": F.count_if(F.col(col).eqNullSafe(F.lit(v))) for k, v in enumerate(expected)}

    def failures(got: dict) -> list:
        missing = [v for k, v in enumerate(expected) if not got[f"v{k}"]]
        return ([f"{got['unexpected']} rows of other values"] if got["unexpected"] else []) + ([f"missing: {missing}"] if missing else [])

    return Observed(metrics, failures)


def write_audited(df: DataFrame, path: str, audits, partition_by: list[str] | None = None) -> str:
    """Write ``df`` to the new ``path`` and run each audit.  An ``Observed`` audit
    is judged by what the write has observed; any other one is a function from
    the written rows, which are read again, to the failing ones.  Returns the
    path if all pass; otherwise the copy is dropped and the error raised."""
    spark = df.sparkSession
    seen = {name: a for name, a in audits.items() if isinstance(a, Observed)}
    got = write_observed(df, path, {f"{k}.{m}": c for k, a in enumerate(seen.values()) for m, c in a.metrics.items()}, partition_by)
    try:
        for k, (name, audit) in enumerate(seen.items()):
            wrong = audit.failures({m: got[f"{k}.{m}"] for m in audit.metrics})
            if wrong:
                raise AssertionError(f"audit failed: {name}: {wrong}")
        for name, audit in audits.items():
            if name not in seen:
                assert_no_rows(audit(spark.read.schema(df.schema).parquet(path)), name)
    except AssertionError:
        drop_path(spark, path)
        raise
    return path


def write_keyed(df: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None) -> str:
    """Write ``df`` to the new ``path``; fails, leaving nothing, if the declared
    key is broken."""
    return write_audited(df, path, {f"key {keys}": lambda rows: key_violations(rows, keys)}, partition_by)


# ---------------------------------------------------------------- publishing

_POINTER = "path string, published_at timestamp"


def stage_audit_publish(spark: SparkSession, df: DataFrame, audits, root: str) -> DataFrame:
    """Write ``df`` to a new load path below ``root``, audit the staged copy and,
    only if all audits pass, publish it by adding its path to the table's
    pointer.  The data are written once, and with ``Observed`` audits never read
    for them; what was published before stays readable until the pointer moves."""
    path = write_audited(df, f"{root}/load-{uuid.uuid4().hex[:12]}", audits)
    spark.createDataFrame([(path,)], "path string").select("path", F.current_timestamp().alias("published_at")) \
        .coalesce(1).write.mode("append").parquet(f"{root}/_pointer")
    return published(spark, root)


def published(spark: SparkSession, root: str) -> DataFrame:
    """The data that the table's pointer names (one path)."""
    pointer = spark.read.schema(_POINTER).parquet(f"{root}/_pointer")
    return spark.read.parquet(pointer.orderBy(F.desc("published_at")).first()["path"])


# ---------------------------------------------------------------- loads


def append_loads(spark: SparkSession, root: str, df: DataFrame, load_col: str = "load_id") -> DataFrame:
    """Append the rows of one or more new loads (their ids in ``load_col``) as
    one batch, and log them: load_id, rows_added, committed_at (when the batch
    was complete).  A load that the log already has is refused, so an append
    that is tried again adds nothing.  Returns the log."""
    batch = f"{root}/data/batch=b{uuid.uuid4().hex[:12]}"  # never a number
    df.hint("rebalance", F.col(load_col)).write.partitionBy(load_col).parquet(batch)
    # Counting the partition column reads the new batch's file footers only.
    new = (spark.read.parquet(batch).groupBy(F.col(load_col).cast("int").alias("load_id"))
           .agg(F.count(F.lit(1)).alias("rows_added")))
    try:
        old = load_log(spark, root, missing_ok=True)
        if old is not None:
            assert_no_rows(new.join(old, "load_id", "left_semi"), "loads that were appended before")
    except AssertionError:
        drop_path(spark, batch)
        raise
    new.select("load_id", "rows_added", F.current_timestamp().alias("committed_at"), F.lit(batch).alias("batch")) \
        .write.mode("append").parquet(f"{root}/_log")
    return load_log(spark, root)


def load_log(spark: SparkSession, root: str, missing_ok: bool = False) -> DataFrame | None:
    """load_id, rows_added, committed_at and batch of every load."""
    schema = "load_id int, rows_added bigint, committed_at timestamp, batch string"
    try:
        return spark.read.schema(schema).parquet(f"{root}/_log")
    except AnalysisException:
        if missing_ok:
            return None
        raise


def read_as_of(spark: SparkSession, root: str, load_id: int, load_col: str = "load_id") -> DataFrame:
    """The table as it was after a load: the rows of the logged batches up to
    it.  One scan, whatever the number of appends: the load prunes directories,
    and the batches join the log, which leaves out batches that were never
    logged."""
    logged = load_log(spark, root).where(F.col("load_id") <= load_id).select(F.regexp_extract("batch", "batch=([^/]*)$", 1).alias("batch")).distinct()
    return spark.read.parquet(f"{root}/data").where(F.col(load_col) <= load_id).join(logged, "batch", "left_semi").drop("batch")


def load_retention(log: DataFrame, older_than, keep_last: int) -> DataFrame:
    """Which loads expire: committed before ``older_than`` (a Column or a
    timestamp's text) and not among the newest ``keep_last`` (a top-k, no
    global window)."""
    newest = log.orderBy(F.col("committed_at").desc(), F.col("load_id").desc()) \
        .limit(keep_last).select("load_id").withColumn("_kept", F.lit(True))
    j = log.join(F.broadcast(newest), on="load_id", how="left")  # at most keep_last rows
    cutoff = older_than if isinstance(older_than, Column) else F.to_timestamp(F.lit(str(older_than)))
    return j.select("load_id", "committed_at", (F.col("_kept").isNull() & (F.col("committed_at") < cutoff)).alias("expired"))
