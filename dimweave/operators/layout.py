"""Table layout: declared tables, partitioned / bucketed / sorted writes, and
file-level reports.

File reports read the file listing (the ``binaryFile`` source without its
content) and group by the hidden ``_metadata`` columns, so they are plain
distributed jobs.  Writes below a partition column are rebalanced first: one
task for each value, more where a value has many rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    return df.hint("rebalance", *map(F.col, cols))


def declare_table(spark: SparkSession, path: str, schema: StructType,
                  partition_by: list[str] | None = None) -> None:
    """Create an empty table with a declared schema and partitioning at ``path``.

    The declarations are a log beside the data: the newest names the folder
    that holds the rows, so declaring anew empties a table in one step, and a
    job that fails before leaves it as it was."""
    try:
        version = _declared(spark, path)["version"] + 1
    except AnalysisException:
        version = 0
    data = f"data-{version}-{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([], schema).write.parquet(f"{path}/{data}")
    declared = json.dumps({"version": version, "data": data, "schema": json.loads(schema.json()), "partition_by": partition_by or []})
    spark.createDataFrame([(declared,)], "value string").coalesce(1).write.mode("append").text(f"{path}/_declared")


def _declared(spark: SparkSession, path: str) -> dict:
    """The newest declaration (one row of text for each)."""
    version = F.get_json_object("value", "$.version").cast("int")
    return json.loads(spark.read.text(f"{path}/_declared").orderBy(version.desc()).first()[0])


def declaration(spark: SparkSession, path: str) -> tuple[StructType, list[str]]:
    found = _declared(spark, path)
    return StructType.fromJson(found["schema"]), found["partition_by"]


def data_path(spark: SparkSession, path: str) -> str:
    """The folder that holds a declared table's rows."""
    return f"{path}/{_declared(spark, path)['data']}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A declared table with its declared types and order, empty or not."""
    schema, _ = declaration(spark, path)
    return spark.read.schema(schema).parquet(data_path(spark, path)).select(*schema.names)


def truncate_table(spark: SparkSession, path: str) -> None:
    """Remove every row of the declared table at ``path`` but keep its schema and
    partitioning (the path-table form of TRUNCATE TABLE, which Spark refuses on
    external tables): a new, empty version is declared, then the old one's
    folder is dropped."""
    old = data_path(spark, path)
    declare_table(spark, path, *declaration(spark, path))
    drop_path(spark, old)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast a load to a declared schema, by name and in declared order;
    a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"load lacks declared columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_into(path: str, df: DataFrame) -> None:
    """Append a load to the declared table at ``path``."""
    schema, partition_by = declaration(df.sparkSession, path)
    load, data = conform(df, schema), data_path(df.sparkSession, path)
    if partition_by:
        rebalanced(load, *partition_by).write.mode("append").partitionBy(*partition_by).parquet(data)
    else:
        load.write.mode("append").parquet(data)


TIME_UNITS = {
    "year": lambda c: F.year(c),
    "month": lambda c: F.date_format(c, "yyyy-MM"),
    "day": lambda c: F.to_date(c),
    "hour": lambda c: F.date_trunc("hour", c).cast("timestamp_ntz"),
}


def partition_by(df: DataFrame, path: str, fields: dict[str, Column], many: bool = False) -> None:
    """Write with one or more partition fields (name -> value).  ``many``: there
    are many small partitions, so that the number of files counts, not of rows;
    they are dealt to all of the session's shuffle partitions."""
    tagged = df.withColumns(fields)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tagged.repartition(tasks, *fields) if many else rebalanced(tagged, *fields)
    dealt.write.mode("overwrite").partitionBy(*fields).parquet(path)


def partition_by_time(df: DataFrame, path: str, ts_col: str, unit: str,
                      name: str | None = None, also: list[str] | None = None) -> str:
    """Write with a derived partition column (year / month / day / hour), and
    below it by the columns ``also`` (a compound partitioning)."""
    name = name or f"{ts_col}_{unit}"
    partition_by(df, path, {name: TIME_UNITS[unit](F.col(ts_col)), **{c: F.col(c) for c in also or []}}, many=bool(also))
    return name


def partition_by_value(df: DataFrame, path: str, col: str) -> None:
    partition_by(df, path, {col: F.col(col)})


def sorted_write(df: DataFrame, path: str, part_col: str, sort_cols: list[str]) -> None:
    """Bring similar values together and sort inside each task (no global range
    sort), which helps the Parquet encodings and min/max pruning."""
    sort_within(df, part_col, sort_cols).write.mode("overwrite").parquet(path)


def sort_within(df: DataFrame, part_col: str, sort_cols: list[str]) -> DataFrame:
    return rebalanced(df, part_col).sortWithinPartitions(*sort_cols)


def plain_path(path: Column) -> Column:
    """file:///x and file:/x are one file."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_size) of the Parquet files below ``path``, those without
    rows included; no content is read.  Paths are URIs, as in every source's
    ``_metadata``, so that they can be joined whatever characters they hold."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(path))
    return files.select(plain_path(F.col("_metadata.file_path")).alias("file_path"), F.col("length").alias("file_size"))


def file_stats(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    """Per data file: size, rows, and per column null count, min and max."""
    df = spark.read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("record_count")]
    for c in cols or df.columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
                 F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    stats = df.groupBy(plain_path(F.col("_metadata.file_path")).alias("file_path")).agg(*aggs)
    return file_listing(spark, path).join(stats, "file_path", "left").withColumn(
        "record_count", F.coalesce("record_count", F.lit(0)))


def layout_report(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Total size and file count of several tables (name -> path) side by side."""
    out = None
    for name, path in tables.items():
        r = file_listing(spark, path).agg(F.sum("file_size").alias("total_bytes"),
                                          F.count(F.lit(1)).alias("num_files")) \
            .select(F.lit(name).alias("table_name"), "total_bytes", "num_files")
        out = r if out is None else out.unionByName(r)
    return out


def row_fingerprint_of(cols: list[str]) -> list[Column]:
    """Aggregates: row count and an order-independent content hash (sum of row hashes)."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("hash_sum")]


def row_fingerprint(df: DataFrame) -> DataFrame:
    return df.agg(*row_fingerprint_of(df.columns))


def partition_report(spark: SparkSession, path: str, month_col: str) -> DataFrame:
    """Rows and files for each value of a month partition of the stored table at
    ``path``, and rolled up to years.  Rows are counted once, by month."""
    rows = spark.read.parquet(path).groupBy(F.col(month_col).cast("string").alias("month")).agg(F.count(F.lit(1)).alias("num_rows"))
    files = file_listing(spark, path).groupBy(F.regexp_extract("file_path", f"/{month_col}=([^/]*)/", 1).alias("month")).agg(
        F.count(F.lit(1)).alias("num_files"))
    both = rows.join(files, "month", "left")
    each = F.explode(F.array(
        F.struct(F.lit("month").alias("partition_unit"), F.col("month").alias("partition_value")),
        F.struct(F.lit("year").alias("partition_unit"), F.substring("month", 1, 4).alias("partition_value"))))
    return (both.select(each.alias("unit"), "num_rows", "num_files").select("unit.*", "num_rows", "num_files")
            .groupBy("partition_unit", "partition_value").agg(F.sum("num_rows").alias("num_rows"), F.sum("num_files").alias("num_files")))
