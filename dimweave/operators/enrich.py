"""Event enrichment and per-user / per-device rollups.

Rollups aggregate before they join: per-user rollups read the (user,
device) aggregate only, so nothing fans out, and the reference's
fan-out multiplicity (each device repeated once per raw event of the user)
is carried as a count column instead of being materialised.  Lists that grow
with the data (users of a device) are collected in a fixed number of buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimweave.functions.picks import collect_lists
from dimweave.functions.text import DEFAULT_REFERRER
from dimweave.operators.layout import TIME_UNITS, rebalanced


def enrich_events_devices(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Events left-joined to devices on device_id, with a day column and the
    browser / OS columns renamed to families."""
    ev = events.withColumn("event_date",
                           F.date_trunc("day", F.col("event_time")).cast("timestamp_ntz"))
    return (ev.join(devices, on="device_id", how="left")
            .withColumnsRenamed({"browser_type": "browser_family", "os_type": "os_family"}))


def typed_enrich(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Events with both ids present, inner-joined to devices; referrer
    defaulted, browser upper-cased."""
    e = events.where(F.col("user_id").isNotNull() & F.col("device_id").isNotNull()).alias("e")
    d = devices.alias("d")
    j = e.join(d, F.col("e.device_id") == F.col("d.device_id"), "inner")
    return j.select(
        F.col("e.user_id").cast("bigint").alias("user_id"),
        F.col("d.device_id").alias("device_id"),
        F.upper(F.col("d.browser_type")).alias("browser_type"),
        F.col("d.os_type").alias("os_type"),
        F.col("d.device_type").alias("device_type"),
        F.coalesce(F.col("e.referrer"), F.lit(DEFAULT_REFERRER)).alias("referrer"),
        F.col("e.host").alias("host"), F.col("e.url").alias("url"),
        F.col("e.event_time").alias("event_time"))


def events_by_user_device(events: DataFrame) -> DataFrame:
    """Hits and distinct hosts per (user, device); rows without a user are
    dropped first."""
    return (events.where(F.col("user_id").isNotNull())
            .groupBy("user_id", "device_id")
            .agg(F.count(F.lit(1)).alias("event_counts"),
                 F.array_sort(F.collect_set("host")).alias("host_array")))


def user_totals(agg: DataFrame) -> DataFrame:
    """Per user: largest per-device hit count and ``raw_event_rows``, the number
    of raw events, which is how many times the reference's join repeats each
    device in its list."""
    return agg.groupBy("user_id").agg(F.max("event_counts").alias("total_hits"), F.sum("event_counts").alias("raw_event_rows"))


def user_device_rollup(agg: DataFrame, *, buckets: int) -> DataFrame:
    """Per user one row of totals (bucket NULL, no list) and ``buckets`` rows of
    device lists (totals NULL), so that a later sum counts each total once."""
    totals = user_totals(agg).withColumn("bucket", F.lit(None).cast("int")).withColumn(
        "devices", F.lit(None).cast(f"array<{agg.schema['device_id'].dataType.simpleString()}>"))
    lists = collect_lists(agg, ["user_id"], "device_id", buckets=buckets, out="devices")
    return totals.unionByName(lists, allowMissingColumns=True)


def device_user_list(devices: DataFrame, agg: DataFrame, *, buckets: int) -> DataFrame:
    """Per device (and its type, which may be NULL): the users seen on it."""
    j = devices.select("device_id", "device_type").join(agg.select("device_id", "user_id"), on="device_id")
    return collect_lists(j, ["device_id", "device_type"], "user_id", buckets=buckets, out="users")


def enrich_sql(spark, events: DataFrame, devices: DataFrame) -> DataFrame:
    """The enrichment join as SQL text over the two DataFrames."""
    return spark.sql(f"""
        SELECT ev.user_id, dv.device_id, upper(dv.browser_type) AS browser_type, dv.os_type, dv.device_type,
               coalesce(ev.referrer, '{DEFAULT_REFERRER}') AS referrer, ev.host, ev.url, ev.event_time
        FROM {{events}} ev JOIN {{devices}} dv USING (device_id)
        WHERE ev.user_id IS NOT NULL""", events=events, devices=devices)


def match_details_join(details: DataFrame, matches: DataFrame, day=None) -> DataFrame:
    m = matches
    if day is not None:
        m = m.where(F.to_date("completion_date") == F.lit(day).cast("date"))
    return details.join(m, on="match_id")


def store_details(details: DataFrame, matches: DataFrame, path: str, unit: str = "day") -> None:
    """Store the details below the completion day (or month, year) of their
    match; details without a match lie below a NULL partition."""
    when = matches.select("match_id", TIME_UNITS[unit](F.col("completion_date")).alias("completed"))
    rebalanced(details.join(when, "match_id", "left"), "completed").write.partitionBy("completed").parquet(path)


def stored_match_details(stored: DataFrame, matches: DataFrame, unit: str = "day") -> DataFrame:
    """Stored details joined to (filtered) matches, also on the partition column:
    whatever the filter on the matches is, only the partitions in which some
    match is left are read (dynamic partition pruning)."""
    m = matches.withColumn("completed", TIME_UNITS[unit](F.col("completion_date")))
    return stored.join(m, ["match_id", "completed"]).drop("completed")
