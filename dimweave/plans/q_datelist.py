"""Registered queries: active-date lists and their bit encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimweave.operators import datelist as dl
from dimweave.operators.audit import write_keyed
from dimweave.plans.params import ASOF, ASOF_PREV
from dimweave.plans.registry import query
from dimweave.session import scratch_path
from dimweave.sources import fixtures as fx

KEY = ["user_id", "date"]

#: The snapshot's day is the newest in the data, its window the 30 days up to it.
_ASOF = "(SELECT max(day) FROM fx_activity)"
_START = "(SELECT max(day) - 29 FROM fx_activity)"

_BACKFILL_SQL = f"""
    SELECT CAST(user_id AS VARCHAR) AS user_id,
           list(day ORDER BY day DESC) AS dates_active,
           {_ASOF} AS date
    FROM fx_activity WHERE user_id IS NOT NULL
    GROUP BY user_id"""

_USERS_CTE = f"users AS ({_BACKFILL_SQL})"

_INT_SQL = f"""
    WITH {_USERS_CTE},
    days AS (SELECT user_id, date_diff('day', d, date) AS ago
             FROM (SELECT user_id, date, unnest(dates_active) AS d FROM users))
    SELECT u.user_id,
           COALESCE((SELECT bit_or((CAST(1 AS BIGINT) << (32 - ago)) & 4294967295)
                     FROM days x WHERE x.user_id = u.user_id AND ago BETWEEN 0 AND 29),
                    CAST(0 AS BIGINT)) AS datelist_int
    FROM users u"""


def _users(spark, sf_dir):
    return dl.datelist_backfill(fx.activity(spark, sf_dir))


def _ints(spark, sf_dir):
    """The window's integers straight from the events."""
    return dl.datelist_state_int(dl.datelist_state(fx.visits(spark, sf_dir)))


@query("datelist_backfill", _BACKFILL_SQL)
def q_datelist_backfill(spark, sf_dir):
    return _users(spark, sf_dir)


@query("datelist_step", f"""
    SELECT CAST(user_id AS VARCHAR) AS user_id, list(day ORDER BY day DESC) AS dates_active, DATE '{ASOF}' AS date
    FROM fx_activity WHERE user_id IS NOT NULL AND day <= DATE '{ASOF}' GROUP BY user_id""")
def q_datelist_step(spark, sf_dir):
    """One day's load over the stored snapshot of the day before."""
    act = fx.activity(spark, sf_dir)
    yesterday = dl.datelist_backfill(act, ASOF_PREV)
    path = write_keyed(yesterday, scratch_path(spark, "users"), KEY, ["date"])
    table = spark.read.schema(yesterday.schema).parquet(path)
    before = table.where(F.col("date") == F.lit(ASOF_PREV).cast("date"))
    new = dl.datelist_step(before, dl.datelist_today(act, ASOF))
    path = write_keyed(new, scratch_path(spark, "users-step"), KEY, ["date"])
    return spark.read.schema(new.schema).parquet(path)


@query("datelist_int", _INT_SQL)
def q_datelist_int(spark, sf_dir):
    """The newest day's load over the stored state of the day before."""
    visits = fx.visits(spark, sf_dir)
    day = dl.last_day(visits)
    state = dl.datelist_state(visits.where(F.col("day") < day), F.date_sub(day, 1))
    path = write_keyed(state, scratch_path(spark, "user-state"), KEY)
    new = dl.datelist_state_step(spark.read.schema(state.schema).parquet(path), dl.datelist_today(visits, day), day)
    return dl.datelist_state_int(new)


@query("agg_bit_or", _INT_SQL)
def q_agg_bit_or(spark, sf_dir):
    bits = dl.datelist_bits_by_day(_users(spark, sf_dir), F.date_sub("date", 29), F.col("date"))
    return dl.bit_or_per_user(bits)


def _flags(v: str) -> str:
    return f"""
    bit_count({v}) > 0 AS dim_is_monthly_active,
    bit_count({v} & 4261412864) > 0 AS dim_is_weekly_active,
    bit_count({v} & 2147483648) > 0 AS dim_is_daily_active"""


@query("activity_flags", f"""
    WITH i AS ({_INT_SQL})
    SELECT user_id, datelist_int, {_flags('datelist_int')} FROM i""")
def q_activity_flags(spark, sf_dir):
    return dl.activity_flags(_ints(spark, sf_dir))


@query("active_day_count", f"""
    WITH i AS ({_INT_SQL})
    SELECT user_id, CAST(bit_count(datelist_int) AS INTEGER) AS active_days FROM i""")
def q_active_day_count(spark, sf_dir):
    return dl.active_day_count(_ints(spark, sf_dir))


@query("datelist_bits", f"""
    WITH seen AS (
        SELECT CAST(user_id AS VARCHAR) AS user_id, {_ASOF} - day AS ago
        FROM fx_activity WHERE user_id IS NOT NULL AND day >= {_START}
    ), named AS (
        -- a day at distance 1 .. 29 has a bit of its own; today's is out of range
        SELECT user_id, CASE WHEN ago > 0 THEN CAST(2 ** (32 - ago) AS BIGINT) ELSE 0 END AS v FROM seen
        UNION
        -- whoever missed a day of the window has a row without a bit
        SELECT CAST(user_id AS VARCHAR), 0 FROM fx_activity, (SELECT {_START} AS start) WHERE user_id IS NOT NULL
        GROUP BY 1 HAVING count(*) FILTER (day >= start) < 30
    )
    SELECT user_id, v AS placeholder_int_value, {_flags('v')} FROM named""")
def q_datelist_bits(spark, sf_dir):
    return dl.datelist_bits(_users(spark, sf_dir))


@query("join_cross", f"""
    WITH {_USERS_CTE}
    SELECT u.user_id, CAST(s AS DATE) AS series_date
    FROM users u CROSS JOIN generate_series(CAST({_START} AS TIMESTAMP), CAST({_ASOF} AS TIMESTAMP), INTERVAL 1 DAY) t(s)""")
def q_join_cross(spark, sf_dir):
    return dl.users_by_day(_users(spark, sf_dir), F.date_sub("date", 29), F.col("date")).select("user_id", "series_date")


@query("date_series", """
    WITH b AS (SELECT min(CAST(event_time AS DATE)) AS lo, max(CAST(event_time AS DATE)) AS hi FROM fx_events)
    SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS series_date
    FROM b""")
def q_date_series(spark, sf_dir):
    return dl.date_series(fx.events(spark, sf_dir), "event_time")


@query("join_full_outer_coalesce", f"""
    WITH y AS (SELECT CAST(user_id AS VARCHAR) AS user_id, list(day ORDER BY day DESC) AS dates_active
               FROM fx_activity WHERE user_id IS NOT NULL AND day <= DATE '{ASOF_PREV}' GROUP BY user_id),
    t AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id, day AS date_active
          FROM fx_activity WHERE user_id IS NOT NULL AND day = DATE '{ASOF}')
    SELECT COALESCE(t.user_id, y.user_id) AS user_id,
           y.dates_active AS previous_dates,
           t.date_active AS today
    FROM t FULL OUTER JOIN y ON t.user_id = y.user_id""")
def q_join_full_outer_coalesce(spark, sf_dir):
    act = fx.activity(spark, sf_dir)
    y = dl.datelist_backfill(act, ASOF_PREV).alias("y")
    t = dl.datelist_today(act, ASOF).alias("t")
    return (t.join(y, F.col("t.user_id") == F.col("y.user_id"), "full_outer")
            .select(F.coalesce("t.user_id", "y.user_id").alias("user_id"),
                    F.col("y.dates_active").alias("previous_dates"),
                    F.col("t.date_active").alias("today")))
