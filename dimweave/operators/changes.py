"""Row-level change and schema evolution as DataFrame jobs.

Plain Parquet tables have no UPDATE / DELETE / MERGE / RENAME COLUMN, so each
change is a select-list or filter rewrite that produces the next version of
the table; ``upsert_table`` writes it back with dynamic partition overwrite
so only the touched partitions are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType)


def upsert_by_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert ``source`` rows; where a key already exists, the source row wins."""
    kept = target.join(source.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(source)


def upsert_table(spark, path: str, source: DataFrame, keys: list[str],
                 partition_cols: list[str]) -> DataFrame:
    """Upsert into a partitioned Parquet table at ``path``: only partitions
    present in ``source`` are rewritten (dynamic partition overwrite).

    The source is staged once and checked first: two rows with one key, or a
    key part that is NULL other than a partition column, are refused.  The
    partition columns must be part of the key; NULL partitions match NULL.
    The table is read with the source's types, so that a partition value such
    as '01' stays text.  The touched partitions are staged to a new path, since
    a path that is being read cannot be overwritten in the same job."""
    from dimweave.operators.audit import assert_no_rows, key_violations
    from dimweave.session import scratch_path

    if not set(partition_cols) <= set(keys):
        raise ValueError(f"partition columns {partition_cols} are not part of the key {keys}")
    staged = scratch_path(spark, "upsert-source")
    source.write.parquet(staged)
    fresh = spark.read.schema(source.schema).parquet(staged)
    own = [k for k in keys if k not in partition_cols]
    broken = key_violations(fresh, keys)
    null_own = F.lit(False)
    for k in own:
        null_own = null_own | F.col(k).isNull()
    assert_no_rows(broken.where((F.col("num_rows") > 1) | null_own), f"source keys {keys}")
    target = spark.read.schema(source.schema).parquet(path)
    touched = fresh.select(*partition_cols).distinct().toDF(*[f"{c}__new" for c in partition_cols])
    same = F.lit(True)
    for c in partition_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}__new"))
    current = target.join(touched, same, "left_semi")
    found = fresh.select(*[F.col(k).alias(f"{k}__new") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}__new"))
    merged = current.join(found, same, "left_anti").unionByName(fresh)
    stage = scratch_path(spark, "upsert-stage")
    merged.hint("rebalance", *map(F.col, partition_cols)).write.partitionBy(*partition_cols).parquet(stage)
    (spark.read.schema(source.schema).parquet(stage).hint("rebalance", *map(F.col, partition_cols)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))
    return spark.read.schema(source.schema).parquet(path)


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """Drop rows whose predicate is TRUE; rows where it is NULL stay."""
    return df.where(~F.coalesce(pred, F.lit(False)))


def update_set(df: DataFrame, col: str, value: Column) -> DataFrame:
    return df.withColumn(col, value)


def evolve_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


_WIDER = {
    ByteType: (ShortType, IntegerType, LongType, DoubleType),
    ShortType: (IntegerType, LongType, DoubleType),
    IntegerType: (LongType, DoubleType),
    LongType: (),
    FloatType: (DoubleType,),
}


def _is_widening(src: DataType, dst: DataType) -> bool:
    if type(src) is type(dst):
        if isinstance(src, DecimalType):
            return dst.precision >= src.precision and dst.scale == src.scale
        return True
    return isinstance(dst, _WIDER.get(type(src), ()))


def evolve_widen(df: DataFrame, col: str, to: DataType) -> DataFrame:
    """Widen a column's type; narrowing is refused."""
    src = df.schema[col].dataType
    if not _is_widening(src, to):
        raise ValueError(f"refusing to change {col} from {src.simpleString()} to {to.simpleString()}")
    return df.withColumn(col, F.col(col).cast(to))


def evolve_reorder(df: DataFrame, col: str, after: str) -> DataFrame:
    """Move ``col`` to directly after ``after``."""
    names = [c for c in df.columns if c != col]
    i = names.index(after)
    return df.select(*names[: i + 1], col, *names[i + 1:])


def evolve_add(df: DataFrame, col: str, dtype: str, after: str | None = None) -> DataFrame:
    """Add a nullable column, optionally right after ``after``."""
    out = df.withColumn(col, F.lit(None).cast(dtype))
    return evolve_reorder(out, col, after) if after else out


def union_by_name(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Stack a batch whose schema may add columns: missing ones become NULL."""
    return table.unionByName(batch, allowMissingColumns=True)
