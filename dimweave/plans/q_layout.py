"""Registered queries: writes, table layout and file reports.

Reports of file sizes and counts are rows-only checks; writes are compared
after reading back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from dimweave.operators import cumulative as cu
from dimweave.operators import layout as la
from dimweave.operators.compaction import compact_files
from dimweave.operators.enrich import enrich_events_devices
from dimweave.operators.joins import write_bucketed
from dimweave.plans.q_cleaning import _T, TAXI_COLS
from dimweave.plans.q_cumulative import PLAYERS_SQL, players
from dimweave.plans.registry import query
from dimweave.session import scratch_path
from dimweave.sources import fixtures as fx

PLAYERS_SCHEMA = (
    "player_name string, height string, college string, country string, draft_year string, "
    f"draft_round string, draft_number string, seasons array<{cu.SEASON_TYPE}>, "
    "scoring_class string, years_since_last_active int, is_active boolean, scoring_class_ord int, "
    "current_season int")


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


_EVENTS_SQL = """
    SELECT e.event_id, e.user_id, e.device_id, e.referrer, e.host, e.url, e.event_time,
           date_trunc('day', e.event_time) AS event_date,
           d.browser_type AS browser_family, d.os_type AS os_family, d.device_type
    FROM fx_events e LEFT JOIN fx_devices d ON e.device_id = d.device_id"""


def _events(spark, sf_dir):
    return enrich_events_devices(fx.events(spark, sf_dir), fx.devices(spark, sf_dir))


@query("table_declare", PLAYERS_SQL)
def q_table_declare(spark, sf_dir):
    """Declare the cumulative table (schema + partitioning), then load it."""
    path = scratch_path(spark, "players-declared")
    la.declare_table(spark, path, spark.createDataFrame([], PLAYERS_SCHEMA).schema, ["current_season"])
    la.load_into(path, players(spark, sf_dir))
    return la.read_table(spark, path)


@query("partition_by_time", """
    SELECT CAST(date_trunc('hour', event_time) AS TIMESTAMP) AS event_time_hour, host, COUNT(*) AS num_rows
    FROM fx_events GROUP BY ALL
    UNION ALL
    SELECT NULL, NULL, COUNT(*) FROM fx_taxis GROUP BY year(tpep_pickup_datetime)
    UNION ALL
    SELECT NULL, 'day', COUNT(*) FROM fx_events GROUP BY CAST(event_time AS DATE)""")
def q_partition_by_time(spark, sf_dir):
    """Rows of each partition: of trips by year, of events by day, and of events
    by hour and, below it, host (a compound partitioning)."""
    year, day, hour = (scratch_path(spark, f"by-{u}") for u in ("year", "day", "hour"))
    events = fx.events(spark, sf_dir)
    y = la.partition_by_time(fx.taxis(spark, sf_dir), year, "tpep_pickup_datetime", "year")
    d = la.partition_by_time(events, day, "event_time", "day")
    h = la.partition_by_time(events, hour, "event_time", "hour", also=["host"])
    n = F.count(F.lit(1)).alias("num_rows")
    none = F.lit(None).cast("timestamp_ntz").alias(h)
    by_hour = spark.read.parquet(hour).groupBy(F.col(h).cast("timestamp_ntz").alias(h), "host").agg(n)
    by_year = spark.read.parquet(year).groupBy(y).agg(n).select(none, F.lit(None).cast("string").alias("host"), "num_rows")
    by_day = spark.read.parquet(day).groupBy(d).agg(n).select(none, F.lit("day").alias("host"), "num_rows")
    return by_hour.unionByName(by_year).unionByName(by_day)


@query("partition_by_value", """SELECT "VendorID", COUNT(*) AS num_rows FROM fx_taxis GROUP BY ALL""")
def q_partition_by_value(spark, sf_dir):
    path = scratch_path(spark, "taxis-by-vendor")
    la.partition_by_value(fx.taxis(spark, sf_dir), path, "VendorID")
    return spark.read.parquet(path).groupBy("VendorID").agg(F.count(F.lit(1)).alias("num_rows"))


@query("bucketed_write")
def q_bucketed_write(spark, sf_dir):
    """16 hash buckets on match_id below the completion month; at most one file
    for each (month, bucket)."""
    name, path = _name("matches_bucketed"), scratch_path(spark, "matches-bucketed")
    m = fx.matches(spark, sf_dir).withColumn("completion_month", F.date_format("completion_date", "yyyy-MM"))
    write_bucketed(m, name, path, "match_id", 16, partition_by=["completion_month"])
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return la.file_listing(spark, path)


@query("sorted_write", _EVENTS_SQL)
def q_sorted_write(spark, sf_dir):
    path = scratch_path(spark, "events-sorted")
    la.sorted_write(_events(spark, sf_dir), path, "event_date", ["event_date", "host"])
    return spark.read.parquet(path)


@query("sort_within_partitions", _EVENTS_SQL)
def q_sort_within_partitions(spark, sf_dir):
    """Rebalance + local sort: one exchange, no range partitioning."""
    return la.sort_within(_events(spark, sf_dir), "event_date", ["event_date", "host"])


@query("layout_report")
def q_layout_report(spark, sf_dir):
    """The same tasks' rows written sorted and as they come."""
    ev = la.rebalanced(_events(spark, sf_dir), "event_date")
    p1, p2 = scratch_path(spark, "events-sorted"), scratch_path(spark, "events-unsorted")
    ev.sortWithinPartitions("event_date", "host").write.parquet(p1)
    ev.write.parquet(p2)
    return la.layout_report(spark, {"sorted": p1, "unsorted": p2})


@query("file_stats")
def q_file_stats(spark, sf_dir):
    """All columns' statistics for each file of a table that is partitioned by year."""
    path = scratch_path(spark, "taxis")
    la.partition_by_time(fx.taxis(spark, sf_dir), path, "tpep_pickup_datetime", "year")
    return la.file_stats(spark, path, [c.strip('"') for c in TAXI_COLS])


@query("compact_files", """
    SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year, COUNT(*) AS num_rows, CAST(SUM("VendorID") AS BIGINT) AS vendor_sum,
           MIN(tpep_pickup_datetime) AS first_pickup, MAX(tpep_dropoff_datetime) AS last_dropoff,
           TRUE AS content_equal, TRUE AS fewer_files
    FROM fx_taxis GROUP BY 1""")
def q_compact_files(spark, sf_dir):
    """Many small files below a year partition packed into files of a target
    size; the table is read after it, with what the report says."""
    path = scratch_path(spark, "taxis-small")
    t = fx.taxis(spark, sf_dir).withColumn("pickup_year", F.year("tpep_pickup_datetime"))
    t.repartition(16).write.partitionBy("pickup_year").parquet(path)
    report = compact_files(spark, path, target_bytes=512 * 1024, partition_cols=["pickup_year"])
    said = report.select((F.col("content_equal") & (F.col("rows_before") == F.col("rows_after"))).alias("content_equal"),
                         (F.col("files_after") < F.col("files_before")).alias("fewer_files"))
    return spark.read.parquet(path).groupBy("pickup_year").agg(
        F.count(F.lit(1)).alias("num_rows"), F.sum("VendorID").alias("vendor_sum"), F.min("tpep_pickup_datetime").alias("first_pickup"),
        F.max("tpep_dropoff_datetime").alias("last_dropoff")).crossJoin(F.broadcast(said))  # one row


@query("partition_report", """
    WITH m AS (SELECT strftime(tpep_pickup_datetime, '%Y-%m') AS month, COUNT(*) AS n FROM fx_taxis GROUP BY 1)
    SELECT 'month' AS partition_unit, month AS partition_value, n AS num_rows, 1 AS num_files FROM m
    UNION ALL
    SELECT 'year', month[1:4], CAST(sum(n) AS BIGINT), COUNT(*) FROM m GROUP BY month[1:4]""")
def q_partition_report(spark, sf_dir):
    """Rows and files for each partition value (here every month is one file)."""
    path = scratch_path(spark, "taxis-by-month")
    month = la.partition_by_time(fx.taxis(spark, sf_dir), path, "tpep_pickup_datetime", "month")
    return la.partition_report(spark, path, month)


@query("write_ctas", f"SELECT {_T} FROM fx_taxis")
def q_write_ctas(spark, sf_dir):
    """Create a table from a query result; the rows are read from its files."""
    name, path = _name("trips"), scratch_path(spark, "trips")
    fx.taxis(spark, sf_dir).write.option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.parquet(path)


@query("write_append", f"SELECT {_T} FROM fx_taxis")
def q_write_append(spark, sf_dir):
    path = scratch_path(spark, "taxis-append")
    t = fx.taxis(spark, sf_dir)
    odd = F.year("tpep_pickup_datetime") % 2 == 1
    t.where(odd).write.mode("overwrite").parquet(path)
    t.where(~odd).write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("write_overwrite", f"SELECT {_T} FROM fx_taxis")
def q_write_overwrite(spark, sf_dir):
    """A first version (the long trips), overwritten by the whole table."""
    path = scratch_path(spark, "taxis-overwrite")
    t = fx.taxis(spark, sf_dir)
    t.where(F.col("trip_distance") > 35).write.mode("overwrite").parquet(path)
    t.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("truncate_reload", f"SELECT {_T} FROM fx_taxis")
def q_truncate_reload(spark, sf_dir):
    """Empty a declared table (keeping schema and partitioning), then reload it."""
    path = scratch_path(spark, "taxis-truncate")
    t = fx.taxis(spark, sf_dir)
    la.declare_table(spark, path, t.schema, ["VendorID"])
    la.load_into(path, t)
    la.truncate_table(spark, path)
    la.load_into(path, t)
    return la.read_table(spark, path)
