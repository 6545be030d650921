"""Registered queries: monthly metric arrays."""

from __future__ import annotations

from dimweave.operators import changes as ch
from dimweave.operators import metric_arrays as ma
from dimweave.operators.audit import write_keyed
from dimweave.plans.params import METRIC_DAY, METRIC_DAY_PREV, MONTH_START
from dimweave.plans.registry import query
from dimweave.session import scratch_path
from dimweave.sources import fixtures as fx

KEY = ["user_id", "month_start", "metric_name"]

_BACKFILL_SQL = f"""
    WITH d AS (SELECT user_id, CAST(event_time AS DATE) AS date, COUNT(*) AS cnt
               FROM fx_events
               WHERE user_id IS NOT NULL
                 AND CAST(event_time AS DATE) BETWEEN DATE '{MONTH_START}' AND DATE '{METRIC_DAY}'
               GROUP BY 1, 2),
    u AS (SELECT DISTINCT user_id FROM d),
    g AS (SELECT u.user_id, CAST(s AS DATE) AS date
          FROM u, generate_series(TIMESTAMP '{MONTH_START}', TIMESTAMP '{METRIC_DAY}', INTERVAL 1 DAY) t(s))
    SELECT g.user_id, DATE '{MONTH_START}' AS month_start, 'site_hits' AS metric_name,
           list(CAST(COALESCE(d.cnt, 0) AS DOUBLE) ORDER BY g.date) AS metric_array
    FROM g LEFT JOIN d ON g.user_id = d.user_id AND g.date = d.date
    GROUP BY g.user_id"""

_POS_SQL = f"""
    WITH b AS ({_BACKFILL_SQL}),
    e AS (SELECT metric_name, month_start, generate_subscripts(metric_array, 1) AS pos,
                 unnest(metric_array) AS v FROM b)"""


def _arrays(spark, sf_dir):
    return ma.array_metric_backfill(fx.events(spark, sf_dir), MONTH_START, METRIC_DAY)


@query("array_metric_backfill", _BACKFILL_SQL)
def q_array_metric_backfill(spark, sf_dir):
    return _arrays(spark, sf_dir)


@query("array_metric_step", _BACKFILL_SQL)
def q_array_metric_step(spark, sf_dir):
    """One day's load over the stored arrays of the day before."""
    ev = fx.events(spark, sf_dir)
    yesterday = ma.array_metric_backfill(ev, MONTH_START, METRIC_DAY_PREV)
    path = write_keyed(yesterday, scratch_path(spark, "array-metrics"), KEY, ["month_start"])
    table = spark.read.schema(yesterday.schema).parquet(path)
    new = ma.array_metric_step(table, ma.daily_counts(ev, METRIC_DAY), METRIC_DAY)
    path = write_keyed(new, scratch_path(spark, "array-metrics-step"), KEY, ["month_start"])
    return spark.read.schema(new.schema).parquet(path)


@query("upsert_by_key", _BACKFILL_SQL)
def q_upsert_by_key(spark, sf_dir):
    """The metric table stored partitioned by month; today's step is upserted
    by (user, month, metric) with dynamic partition overwrite."""
    ev = fx.events(spark, sf_dir)
    path = scratch_path(spark, "array-metrics")
    ma.array_metric_backfill(ev, MONTH_START, METRIC_DAY_PREV).write.partitionBy("month_start").parquet(path)
    step = ma.array_metric_step(spark.read.parquet(path), ma.daily_counts(ev, METRIC_DAY), METRIC_DAY)
    return ch.upsert_table(spark, path, step, KEY, ["month_start"])


@query("array_metric_lengths", f"""
    WITH b AS ({_BACKFILL_SQL})
    SELECT CAST(len(metric_array) AS INTEGER) AS array_length, COUNT(*) AS num_arrays
    FROM b GROUP BY 1""")
def q_array_metric_lengths(spark, sf_dir):
    return ma.array_metric_lengths(_arrays(spark, sf_dir))


@query("array_elementwise_sum", f"""
    {_POS_SQL},
    s AS (SELECT metric_name, month_start, pos, SUM(v) AS v FROM e GROUP BY ALL)
    SELECT metric_name, month_start, list(v ORDER BY pos) AS summed_array
    FROM s GROUP BY metric_name, month_start""")
def q_array_elementwise_sum(spark, sf_dir):
    return ma.array_elementwise_sum(_arrays(spark, sf_dir))


@query("array_elementwise_explode", f"""
    {_POS_SQL}
    SELECT metric_name, CAST(month_start + CAST(pos - 1 AS INTEGER) AS DATE) AS date, SUM(v) AS value
    FROM e GROUP BY metric_name, month_start, pos""")
def q_array_elementwise_explode(spark, sf_dir):
    return ma.array_elementwise_explode(_arrays(spark, sf_dir))


@query("array_metric_daily", f"""
    {_POS_SQL}
    SELECT metric_name, CAST(month_start + CAST(pos - 1 AS INTEGER) AS DATE) AS date, v AS value
    FROM e""")
def q_array_metric_daily(spark, sf_dir):
    return ma.array_metric_daily(_arrays(spark, sf_dir))
