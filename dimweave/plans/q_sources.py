"""Registered queries: sources (CSV, multi-line JSON, monthly Parquet,
pushed-down scans, declared rows, temp views)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, StringType, StructField, StructType, TimestampNTZType)

from dimweave.operators.layout import partition_by_time
from dimweave.plans.q_cleaning import _T
from dimweave.plans.registry import query
from dimweave.session import scratch_path, table_path
from dimweave.sources import fixtures as fx
from dimweave.sources import readers as rd

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EVENT_COLS = "event_id, user_id, device_id, referrer, host, url, event_time"


def _events_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "events-csv")
    (fx.events(spark, sf_dir).write.option("header", True).option("timestampNTZFormat", TS_FMT)
     .csv(path))
    return path


@query("scan_csv_inferred", """
    SELECT CAST(event_id AS INTEGER) AS event_id, CAST(user_id AS INTEGER) AS user_id,
           CAST(device_id AS INTEGER) AS device_id, referrer, host, url, event_time
    FROM fx_events WHERE user_id IS NOT NULL""")
def q_scan_csv_inferred(spark, sf_dir):
    """Inferred types (ints come back as int); the time column is conformed
    to the declared timestamp type; rows without a key are dropped."""
    path = _events_csv(spark, sf_dir)
    df = (spark.read.option("header", True).option("inferSchema", True)
          .option("timestampNTZFormat", TS_FMT).option("timestampFormat", TS_FMT).csv(path))
    return (df.where(F.col("user_id").isNotNull())
            .withColumn("event_time", F.col("event_time").cast("timestamp_ntz")))


@query("scan_csv_strings", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
           CAST(device_id AS VARCHAR) AS device_id, referrer, host, url, event_time
    FROM fx_events""")
def q_scan_csv_strings(spark, sf_dir):
    """No inference: every column text; the time column is cast by hand."""
    df = rd.read_csv_strings(spark, _events_csv(spark, sf_dir))
    return df.withColumn("event_time", F.to_timestamp_ntz(F.col("event_time"), F.lit(TS_FMT)))


@query("scan_json_multiline", "SELECT permit_id, borough FROM fx_permits")
def q_scan_json_multiline(spark, sf_dir):
    path = scratch_path(spark, "permits-json")
    rd.write_json_documents(fx.permits(spark, sf_dir), path)
    return rd.read_json_multiline(spark, path).select("permit_id", "borough")


@query("scan_parquet_months", f"""
    SELECT {_T}, strftime(tpep_pickup_datetime, '%Y-%m') AS month FROM fx_taxis""")
def q_scan_parquet_months(spark, sf_dir):
    """Monthly files written once, then stacked by a single glob scan."""
    root = scratch_path(spark, "taxis-monthly")
    partition_by_time(fx.taxis(spark, sf_dir), root, "tpep_pickup_datetime", "month", name="month")
    return rd.read_parquet_months(spark, root)


@query("scan_pushdown", "SELECT event_id, props FROM events WHERE event_type = 'error'")
def q_scan_pushdown(spark, sf_dir):
    return rd.scan_pushdown(spark, table_path(sf_dir, "events"), F.col("event_type") == "error",
                            ["event_id", "props"])


LOG_SCHEMA = StructType([
    StructField("level", StringType(), False),
    StructField("event_time", TimestampNTZType(), False),
    StructField("message", StringType(), True),
    StructField("call_stack", ArrayType(StringType()), True),
])
# Declared rows appended to the log table (literal records, like a hand-built batch).
LOG_ROWS = [
    ("error", dt.datetime(2024, 1, 31, 9, 0, 0), "Unable to connect", ["connect", "open", "main"]),
    ("warn", dt.datetime(2024, 1, 31, 9, 5, 0), "Retrying", None),
    ("info", dt.datetime(2024, 1, 31, 9, 6, 0), None, []),
]


@query("rows_declared", """
    SELECT CASE WHEN event_type = 'error' THEN 'error' ELSE 'info' END AS level, ts AS event_time,
           event_type || ' event ' || CAST(event_id AS VARCHAR) AS message,
           CASE WHEN event_type = 'error' THEN ['handler', 'dispatch'] ELSE NULL END AS call_stack
    FROM events
    UNION ALL
    SELECT * FROM (VALUES
        ('error', TIMESTAMP '2024-01-31 09:00:00', 'Unable to connect', ['connect', 'open', 'main']),
        ('warn', TIMESTAMP '2024-01-31 09:05:00', 'Retrying', NULL),
        ('info', TIMESTAMP '2024-01-31 09:06:00', NULL, CAST([] AS VARCHAR[]))) v(level, event_time, message, call_stack)""")
def q_rows_declared(spark, sf_dir):
    """A log table derived from events, plus a batch of declared literal rows
    appended under the same schema."""
    ev = fx.base(spark, sf_dir, "events")
    logs = ev.select(
        F.when(F.col("event_type") == "error", "error").otherwise("info").alias("level"),
        F.col("ts").alias("event_time"),
        F.concat(F.col("event_type"), F.lit(" event "), F.col("event_id").cast("string")).alias("message"),
        F.when(F.col("event_type") == "error", F.array(F.lit("handler"), F.lit("dispatch")))
        .alias("call_stack"))
    return logs.unionByName(rd.rows_declared(spark, LOG_ROWS, LOG_SCHEMA))


@query("temp_view_scan", "SELECT host, COUNT(*) AS hits FROM fx_events GROUP BY host")
def q_temp_view_scan(spark, sf_dir):
    name = f"events_{uuid.uuid4().hex[:8]}"
    fx.events(spark, sf_dir).createOrReplaceTempView(name)
    return spark.sql(f"SELECT host, COUNT(*) AS hits FROM {name} GROUP BY host")
