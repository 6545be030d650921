"""Registered queries: single primitives (literals, unnesting, casts, date
parts, bits, arrays, JSON) on the fixture views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dimweave.functions.bits import bits32_text, masked_count
from dimweave.operators import datelist as dl
from dimweave.operators import metric_arrays as ma
from dimweave.operators.graph import json_props
from dimweave.plans.params import ASOF, METRIC_DAY, MONTH_START
from dimweave.plans.q_datelist import _BACKFILL_SQL, _INT_SQL, _users
from dimweave.plans.q_metric_arrays import _BACKFILL_SQL as _ARR_SQL
from dimweave.plans.registry import query
from dimweave.sources import fixtures as fx


@query("project_literal", """
    SELECT user_id, day, 'site_hits' AS metric_name, 2001 AS current_season FROM fx_activity""")
def q_project_literal(spark, sf_dir):
    a = fx.activity(spark, sf_dir)
    return a.select("user_id", "day", F.lit("site_hits").alias("metric_name"),
                    F.lit(2001).alias("current_season"))


@query("lateral_unnest", f"""
    WITH b AS ({_ARR_SQL})
    SELECT user_id, CAST(generate_subscripts(metric_array, 1) - 1 AS INTEGER) AS pos,
           unnest(metric_array) AS value FROM b""")
def q_lateral_unnest(spark, sf_dir):
    """Each row joined to its own array's elements, with positions."""
    arr = ma.array_metric_backfill(fx.events(spark, sf_dir), MONTH_START, METRIC_DAY)
    return arr.select("user_id", F.posexplode("metric_array").alias("pos", "value"))


@query("agg_dedupe_groupby", """
    SELECT user_id, CAST(event_time AS DATE) AS day FROM fx_events
    WHERE user_id IS NOT NULL GROUP BY user_id, CAST(event_time AS DATE)""")
def q_agg_dedupe_groupby(spark, sf_dir):
    e = fx.events(spark, sf_dir).where(F.col("user_id").isNotNull())
    return e.select("user_id", F.to_date("event_time").alias("day")).distinct()


@query("fn_coalesce", """
    SELECT event_id, COALESCE(referrer, host) AS source, COALESCE(user_id, -1) AS user_or_unknown
    FROM fx_events""")
def q_fn_coalesce(spark, sf_dir):
    e = fx.events(spark, sf_dir)
    return e.select("event_id", F.coalesce("referrer", "host").alias("source"),
                    F.coalesce(F.col("user_id"), F.lit(-1).cast("bigint")).alias("user_or_unknown"))


@query("fn_cast", """
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_text, CAST(device_id AS INTEGER) AS device_int,
           CAST(device_id AS DOUBLE) AS device_real, CAST(event_time AS DATE) AS event_day,
           CAST(CAST(event_time AS DATE) AS TIMESTAMP) AS day_start,
           TRY_CAST(url AS INTEGER) AS url_as_int
    FROM fx_events""")
def q_fn_cast(spark, sf_dir):
    e = fx.events(spark, sf_dir)
    return e.select(
        "event_id", F.col("user_id").cast("string").alias("user_text"),
        F.col("device_id").cast("int").alias("device_int"),
        F.col("device_id").cast("double").alias("device_real"),
        F.col("event_time").cast("date").alias("event_day"),
        F.col("event_time").cast("date").cast("timestamp_ntz").alias("day_start"),
        F.col("url").try_cast("int").alias("url_as_int"))


@query("fn_date_parts", f"""
    SELECT event_id, CAST(event_time AS DATE) AS day,
           CAST(date_trunc('month', event_time) AS DATE) AS month_start,
           CAST(date_diff('day', CAST(event_time AS DATE), DATE '{ASOF}') AS INTEGER) AS days_before_asof,
           CAST(event_time AS DATE) + 1 AS next_day,
           date_trunc('day', event_time) AS day_ts
    FROM fx_events""")
def q_fn_date_parts(spark, sf_dir):
    e = fx.events(spark, sf_dir)
    day = F.to_date("event_time")
    return e.select(
        "event_id", day.alias("day"), F.trunc(day, "month").alias("month_start"),
        F.datediff(F.lit(dt.date.fromisoformat(ASOF)), day).alias("days_before_asof"),
        F.date_add(day, 1).alias("next_day"),
        F.date_trunc("day", "event_time").cast("timestamp_ntz").alias("day_ts"))


@query("fn_bits", f"""
    WITH i AS ({_INT_SQL})
    SELECT user_id, CAST(bit_count(datelist_int & 4261412864) AS INTEGER) AS days_active_last_week,
           lpad(bin(datelist_int & 4294967295), 32, '0') AS bits32
    FROM i""")
def q_fn_bits(spark, sf_dir):
    i = dl.datelist_int(_users(spark, sf_dir))
    return i.select("user_id", masked_count(F.col("datelist_int"), dl.WEEKLY_MASK).alias("days_active_last_week"),
                    bits32_text(F.col("datelist_int")).alias("bits32"))


@query("fn_array_build", f"""
    WITH u AS ({_BACKFILL_SQL})
    SELECT user_id,
           [dates_active[1], dates_active[len(dates_active)]] AS ends,
           list_append(dates_active, date) AS appended,
           list_prepend(date, dates_active) AS prepended,
           list_resize(CAST([] AS INTEGER[]), len(dates_active), 0) AS zeros,
           [struct_pack(user_id := user_id, date := date)] AS keyed
    FROM u""")
def q_fn_array_build(spark, sf_dir):
    u = _users(spark, sf_dir)
    d = F.col("dates_active")
    return u.select(
        "user_id",
        F.array(F.get(d, 0), F.try_element_at(d, F.lit(-1))).alias("ends"),
        F.array_append(d, F.col("date")).alias("appended"),
        F.array_prepend(d, F.col("date")).alias("prepended"),
        F.array_repeat(F.lit(0), F.size(d)).alias("zeros"),
        F.array(F.struct("user_id", "date")).alias("keyed"))


@query("fn_array_access", f"""
    WITH u AS ({_BACKFILL_SQL})
    SELECT user_id, dates_active[1] AS newest, dates_active[len(dates_active)] AS oldest,
           CAST(len(dates_active) AS INTEGER) AS n_days,
           list_contains(dates_active, DATE '{ASOF}') AS active_asof,
           dates_active[101] AS past_end
    FROM u""")
def q_fn_array_access(spark, sf_dir):
    """First, last, length, membership; an index past the end is NULL."""
    u = _users(spark, sf_dir)
    d = F.col("dates_active")
    return u.select("user_id", F.get(d, 0).alias("newest"),
                    F.try_element_at(d, F.lit(-1)).alias("oldest"),
                    F.size(d).alias("n_days"),
                    F.array_contains(d, F.lit(dt.date.fromisoformat(ASOF))).alias("active_asof"),
                    F.get(d, 100).alias("past_end"))


@query("fn_json_build", """
    SELECT event_id, CAST(json_object('event_id', event_id, 'host', host, 'referrer', referrer) AS VARCHAR)
           AS properties
    FROM fx_events""")
def q_fn_json_build(spark, sf_dir):
    """NULL fields are kept in the JSON text."""
    e = fx.events(spark, sf_dir)
    return e.select("event_id", json_props(F.col("event_id"), F.col("host"), F.col("referrer"))
                    .alias("properties"))


@query("fn_json_get", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_fn_json_get(spark, sf_dir):
    e = fx.base(spark, sf_dir, "events")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
