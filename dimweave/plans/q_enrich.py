"""Registered queries: event enrichment, rollups and join strategies."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from dimweave.functions.picks import collect_lists
from dimweave.functions.text import DEFAULT_REFERRER, first_word
from dimweave.operators import enrich as en
from dimweave.operators import joins as jn
from dimweave.plans.params import LIST_BUCKETS, MATCH_DAY
from dimweave.plans.registry import query
from dimweave.session import scratch_path
from dimweave.sources import fixtures as fx

_AGG_SQL = """agg AS (
    SELECT user_id, device_id, COUNT(*) AS event_counts, list_sort(list(DISTINCT host)) AS host_array
    FROM fx_events WHERE user_id IS NOT NULL GROUP BY user_id, device_id)"""


def _lists_sql(src: str, keys: str, value: str, out: str, buckets: int = LIST_BUCKETS) -> str:
    """DuckDB text of collect_lists over ``src`` (keys comma-separated)."""
    mine = f"CAST(('0x' || substr(md5(CAST({value} AS VARCHAR)), 1, 8)) AS BIGINT) % {buckets}"
    same = " AND ".join(f"a.{k.strip()} IS NOT DISTINCT FROM s.{k.strip()}" for k in keys.split(","))
    return f"""(SELECT {', '.join('a.' + k.strip() for k in keys.split(','))}, CAST(a.b AS INTEGER) AS bucket,
                coalesce(list({value} ORDER BY {value}) FILTER ({value} IS NOT NULL), []) AS {out}
         FROM (SELECT DISTINCT {keys}, unnest(range({buckets})) AS b FROM {src}) a
         LEFT JOIN {src} s ON {same} AND {mine} = a.b
         GROUP BY ALL)"""


_ROLLUP_SQL = f"""WITH {_AGG_SQL},
    ch AS {_lists_sql('agg', 'user_id', 'device_id', 'devices')}
    SELECT user_id, MAX(event_counts) AS total_hits, CAST(SUM(event_counts) AS BIGINT) AS raw_event_rows,
           CAST(NULL AS INTEGER) AS bucket, CAST(NULL AS BIGINT[]) AS devices
    FROM agg GROUP BY user_id
    UNION ALL SELECT user_id, NULL, NULL, bucket, devices FROM ch"""

_DEVICE_LIST_SQL = f"""WITH {_AGG_SQL},
    j AS (SELECT d.device_id, d.device_type, a.user_id FROM fx_devices d JOIN agg a ON d.device_id = a.device_id)
    SELECT * FROM {_lists_sql('j', 'device_id, device_type', 'user_id', 'users')}"""

_MATCH_SQL = f"""
    SELECT d.match_id, d.player_gamertag, d.player_total_kills, d.player_total_deaths,
           m.is_team_game, m.playlist_id, m.completion_date
    FROM fx_match_details d JOIN fx_matches m ON d.match_id = m.match_id
    WHERE CAST(m.completion_date AS DATE) = DATE '{MATCH_DAY}'"""


def _agg(spark, sf_dir):
    return en.events_by_user_device(fx.events(spark, sf_dir))


@query("enrich_events_devices", """
    SELECT e.event_id, e.user_id, e.device_id, e.referrer, e.host, e.url, e.event_time,
           date_trunc('day', e.event_time) AS event_date,
           d.browser_type AS browser_family, d.os_type AS os_family, d.device_type
    FROM fx_events e LEFT JOIN fx_devices d ON e.device_id = d.device_id""")
def q_enrich_events_devices(spark, sf_dir):
    return en.enrich_events_devices(fx.events(spark, sf_dir), fx.devices(spark, sf_dir))


@query("typed_enrich", f"""
    SELECT e.user_id, d.device_id, upper(d.browser_type) AS browser_type, d.os_type, d.device_type,
           COALESCE(e.referrer, '{DEFAULT_REFERRER}') AS referrer, e.host, e.url, e.event_time
    FROM fx_events e JOIN fx_devices d ON e.device_id = d.device_id
    WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""")
def q_typed_enrich(spark, sf_dir):
    return en.typed_enrich(fx.events(spark, sf_dir), fx.devices(spark, sf_dir))


@query("events_by_user_device", f"WITH {_AGG_SQL} SELECT * FROM agg")
def q_events_by_user_device(spark, sf_dir):
    return _agg(spark, sf_dir)


@query("user_device_rollup", _ROLLUP_SQL)
def q_user_device_rollup(spark, sf_dir):
    return en.user_device_rollup(_agg(spark, sf_dir), buckets=LIST_BUCKETS)


@query("device_user_list", _DEVICE_LIST_SQL)
def q_device_user_list(spark, sf_dir):
    return en.device_user_list(fx.devices(spark, sf_dir), _agg(spark, sf_dir), buckets=LIST_BUCKETS)


@query("cache_reuse", f"""
    SELECT 'user_device_rollup' AS pipeline, COUNT(*) AS num_rows FROM ({_ROLLUP_SQL})
    UNION ALL
    SELECT 'device_user_list' AS pipeline, COUNT(*) AS num_rows FROM ({_DEVICE_LIST_SQL})""")
def q_cache_reuse(spark, sf_dir):
    """Persist the (user, device) aggregate once, feed both rollups from it
    (each written out), then release it.  Memory-and-disk so an aggregate
    larger than executor memory spills instead of being recomputed."""
    agg = _agg(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out1 = scratch_path(spark, "rollup")
        out2 = scratch_path(spark, "device-list")
        en.user_device_rollup(agg, buckets=LIST_BUCKETS).write.parquet(out1)
        en.device_user_list(fx.devices(spark, sf_dir), agg, buckets=LIST_BUCKETS).write.parquet(out2)
    finally:
        agg.unpersist()
    r1 = spark.read.parquet(out1).agg(F.count(F.lit(1)).alias("num_rows")) \
        .select(F.lit("user_device_rollup").alias("pipeline"), "num_rows")
    r2 = spark.read.parquet(out2).agg(F.count(F.lit(1)).alias("num_rows")) \
        .select(F.lit("device_user_list").alias("pipeline"), "num_rows")
    return r1.unionByName(r2)


@query("agg_array_list", f"""
    WITH ev AS (SELECT host, user_id FROM fx_events WHERE user_id IS NOT NULL)
    SELECT * FROM {_lists_sql('ev', 'host', 'user_id', 'users')}""")
def q_agg_array_list(spark, sf_dir):
    """All values of a group (duplicates kept) as sorted lists, dealt into buckets."""
    ev = fx.events(spark, sf_dir).where(F.col("user_id").isNotNull()).select("host", "user_id")
    return collect_lists(ev, ["host"], "user_id", buckets=LIST_BUCKETS, out="users")


@query("match_details_join", _MATCH_SQL)
def q_match_details_join(spark, sf_dir):
    return en.match_details_join(fx.match_details(spark, sf_dir), fx.matches(spark, sf_dir),
                                 dt.date.fromisoformat(MATCH_DAY))


@query("join_broadcast", """
    SELECT d.match_id, d.player_gamertag, d.player_total_kills, d.player_total_deaths,
           m.is_team_game, m.playlist_id, m.completion_date
    FROM fx_match_details d JOIN fx_matches m ON d.match_id = m.match_id""")
def q_join_broadcast(spark, sf_dir):
    """All matches, broadcast if their counted rows are few enough."""
    return jn.join_broadcast(fx.match_details(spark, sf_dir), fx.matches(spark, sf_dir), on="match_id")


@query("join_sort_merge", """
    SELECT d.match_id, d.player_gamertag, d.player_total_kills, m.playlist_id
    FROM fx_match_details d JOIN fx_matches m ON d.match_id = m.match_id""")
def q_join_sort_merge(spark, sf_dir):
    d = fx.match_details(spark, sf_dir).select("match_id", "player_gamertag", "player_total_kills")
    m = fx.matches(spark, sf_dir).select("match_id", "playlist_id")
    return jn.join_sort_merge(d, m, on="match_id")


@query("join_bucketed", _MATCH_SQL)
def q_join_bucketed(spark, sf_dir):
    """Both sides bucketed into 16 buckets on match_id (matches also
    partitioned by completion month): the join reads matching buckets
    without an exchange; the month filter prunes partitions."""
    tag = uuid.uuid4().hex[:12]
    mt, dt_ = f"matches_b{tag}", f"match_details_b{tag}"
    m = fx.matches(spark, sf_dir).withColumn("completion_month", F.date_format("completion_date", "yyyy-MM"))
    jn.write_bucketed(m, mt, scratch_path(spark, "matches-bucketed"), "match_id", 16,
                      partition_by=["completion_month"])
    jn.write_bucketed(fx.match_details(spark, sf_dir), dt_, scratch_path(spark, "details-bucketed"),
                      "match_id", 16)
    day = dt.date.fromisoformat(MATCH_DAY)
    flt = (F.col("completion_month") == MATCH_DAY[:7]) & \
          (F.to_date("completion_date") == F.lit(day))
    j = jn.join_bucketed(spark, mt, dt_, "match_id", left_filter=flt)
    return j.select("match_id", "player_gamertag", "player_total_kills", "player_total_deaths",
                    "is_team_game", "playlist_id", "completion_date")


@query("join_left_using", """
    SELECT e.event_id, e.device_id, d.browser_type
    FROM fx_events e LEFT JOIN fx_devices d USING (device_id)""")
def q_join_left_using(spark, sf_dir):
    e = fx.events(spark, sf_dir).select("event_id", "device_id")
    return e.join(fx.devices(spark, sf_dir).select("device_id", "browser_type"), on="device_id", how="left")


@query("join_typed_pair", """
    SELECT struct_pack(event_id := e.event_id, user_id := e.user_id, device_id := e.device_id,
                       referrer := e.referrer, host := e.host) AS event,
           struct_pack(device_id := d.device_id, browser_type := d.browser_type, os_type := d.os_type,
                       device_type := d.device_type) AS device
    FROM fx_events e JOIN fx_devices d ON e.device_id = d.device_id
    WHERE e.user_id IS NOT NULL AND e.device_id IS NOT NULL""")
def q_join_typed_pair(spark, sf_dir):
    """``joinWith``: each match as a (left struct, right struct) pair."""
    e = fx.events(spark, sf_dir).where(F.col("user_id").isNotNull() & F.col("device_id").isNotNull())
    le = e.select(F.struct("event_id", "user_id", "device_id", "referrer", "host").alias("event"))
    rd = fx.devices(spark, sf_dir).select(
        F.struct("device_id", "browser_type", "os_type", "device_type").alias("device"))
    return le.join(rd, F.col("event.device_id") == F.col("device.device_id"))


@query("filter_not_null", """
    SELECT * FROM fx_events WHERE user_id IS NOT NULL AND device_id IS NOT NULL""")
def q_filter_not_null(spark, sf_dir):
    return fx.events(spark, sf_dir).where(F.col("user_id").isNotNull() & F.col("device_id").isNotNull())


@query("fn_upper_default", f"""
    SELECT event_id, upper(host) AS host_upper, COALESCE(referrer, '{DEFAULT_REFERRER}') AS referrer
    FROM fx_events""")
def q_fn_upper_default(spark, sf_dir):
    e = fx.events(spark, sf_dir)
    return e.select("event_id", F.upper("host").alias("host_upper"),
                    F.coalesce(F.col("referrer"), F.lit(DEFAULT_REFERRER)).alias("referrer"))


@query("fn_split_item", """
    SELECT match_id, split_part(CAST(completion_date AS VARCHAR), ' ', 1) AS completion_day FROM fx_matches""")
def q_fn_split_item(spark, sf_dir):
    m = fx.matches(spark, sf_dir)
    return m.select("match_id", first_word(F.col("completion_date").cast("string")).alias("completion_day"))
