"""Sources: CSV (inferred or all-text), multi-line JSON documents, stacked
monthly Parquet, pushed-down Parquet scans, and declared literal rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Header row, every column text, to be cast by hand."""
    return spark.read.option("header", True).csv(path)


#: Records in one multi-line document.
DOCUMENT_ROWS = 1000


def write_json_documents(df: DataFrame, path: str) -> None:
    """Write the rows as multi-line JSON documents (arrays of records, one record
    on some lines each), about DOCUMENT_ROWS records to a file.  A document
    cannot be split by its reader, so its size is bounded, not the table's."""
    columns = df.columns
    number = F.monotonically_increasing_id()  # only deals rows out, any numbers do
    docs = df.select(F.to_json(F.struct(*columns), {"pretty": "true"}).alias("record"),
                     F.floor(number / DOCUMENT_ROWS).alias("document"))
    text = docs.groupBy("document").agg(F.collect_list("record").alias("records")).select(
        "document", F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]")).alias("value"))
    text.write.mode("overwrite").partitionBy("document").text(path)


def read_json_multiline(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per file, spanning lines, types inferred."""
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).json(path)


def read_parquet_months(spark: SparkSession, root: str, pattern: str = "*",
                        part_col: str = "month") -> DataFrame:
    """Stack monthly Parquet directories (``root/part_col=YYYY-MM``) in one
    scan; ``pattern`` selects months by glob."""
    return (spark.read.option("basePath", root).parquet(f"{root}/{part_col}={pattern}")
            .withColumn(part_col, F.col(part_col).cast("string")))


def scan_pushdown(spark: SparkSession, path: str, predicate: Column, columns: list[str]) -> DataFrame:
    """Filter and projection at the source: Parquet receives PushedFilters and
    a pruned ReadSchema (see ``explain``)."""
    return spark.read.parquet(path).where(predicate).select(*columns)


def rows_declared(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small literal table under a declared schema; required fields are
    checked (a NULL in a non-nullable field raises)."""
    for r in rows:
        for f, v in zip(schema.fields, r):
            if v is None and not f.nullable:
                raise ValueError(f"required field {f.name} is NULL in {r}")
    return spark.createDataFrame(rows, schema)
