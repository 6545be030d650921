"""Monthly metric arrays ("reduced facts").

One row per (user, month, metric) holds the month's daily values as an
array, index 0 = the first day of the month.  ``array_metric_step`` appends
one day to yesterday's arrays (a full outer join, zero-filling users that
appear mid-month and users absent today); ``array_metric_backfill`` builds
the same arrays straight from the events in one aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _d(x) -> Column:
    return F.lit(dt.date.fromisoformat(x) if isinstance(x, str) else x)


def daily_counts(events: DataFrame, first_day, last_day=None, *, user_col: str = "user_id",
                 ts_col: str = "event_time") -> DataFrame:
    """(user_id, date, num_site_hits) for days in [first_day, last_day]."""
    last_day = first_day if last_day is None else last_day
    day = F.to_date(ts_col)
    return (events.where(F.col(user_col).isNotNull() & (day >= _d(first_day)) & (day <= _d(last_day)))
            .groupBy(F.col(user_col).alias("user_id"), day.alias("date"))
            .agg(F.count(F.lit(1)).alias("num_site_hits")))


def array_metric_backfill(events: DataFrame, month_start, day, *, metric_name: str = "site_hits",
                          user_col: str = "user_id", ts_col: str = "event_time") -> DataFrame:
    """The month's arrays as of ``day``: one slot per day from the month start,
    0 where the user had no events.  Equals the folded daily steps."""
    daily = daily_counts(events, month_start, day, user_col=user_col, ts_col=ts_col)
    per_user = daily.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("date", "num_site_hits"))).alias("m"))
    days = F.sequence(_d(month_start), _d(day), F.expr("interval 1 day"))
    arr = F.transform(days, lambda d: F.coalesce(F.try_element_at(F.col("m"), d), F.lit(0))
                      .cast("double"))
    return per_user.select("user_id", _d(month_start).alias("month_start"),
                           F.lit(metric_name).alias("metric_name"), arr.alias("metric_array"))


def array_metric_step(yesterday: DataFrame, day_agg: DataFrame, day, *,
                      metric_name: str = "site_hits") -> DataFrame:
    """Append one day (``day_agg``: user_id, date, num_site_hits, of ``day``) to
    yesterday's arrays of that month; other months' rows are left out.  Users
    new this month get zeros for the days before today."""
    month = F.trunc(_d(day), "month")
    da = day_agg.alias("da")
    ya = yesterday.where((F.col("month_start") == month) & (F.col("metric_name") == metric_name)).alias("ya")
    j = da.join(ya, F.col("da.user_id") == F.col("ya.user_id"), "full_outer")
    today_val = F.array(F.coalesce(F.col("da.num_site_hits"), F.lit(0)).cast("double"))
    fresh = F.concat(F.array_repeat(F.lit(0.0), F.datediff(_d(day), month)), today_val)
    arr = F.when(F.col("ya.metric_array").isNotNull(),
                 F.concat(F.col("ya.metric_array"), today_val)).otherwise(fresh)
    return j.select(
        F.coalesce(F.col("da.user_id"), F.col("ya.user_id")).alias("user_id"),
        month.alias("month_start"),
        F.lit(metric_name).alias("metric_name"),
        arr.alias("metric_array"),
    )


def array_metric_lengths(df: DataFrame) -> DataFrame:
    """How many arrays of each length: a load check."""
    return (df.groupBy(F.size("metric_array").cast("int").alias("array_length"))
            .agg(F.count(F.lit(1)).alias("num_arrays")))


def _position_sums(df: DataFrame, keys: list[str], arr: str) -> DataFrame:
    exploded = df.select(*keys, F.posexplode(arr).alias("pos", "value"))
    # Partial aggregation collapses every user's slot into one value per
    # (keys, pos) before the shuffle, so a month with many users is not hot.
    return exploded.groupBy(*keys, "pos").agg(F.sum("value").alias("value"))


def array_elementwise_sum(df: DataFrame, keys=("metric_name", "month_start"),
                          arr: str = "metric_array", out: str = "summed_array") -> DataFrame:
    """Per-position sums over all rows of a group, as an array of any length."""
    keys = list(keys)
    sums = _position_sums(df, keys, arr)
    return (sums.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("_s"))
            .select(*keys, F.transform("_s", lambda x: x["value"]).alias(out)))


def array_elementwise_explode(df: DataFrame, keys=("metric_name", "month_start"),
                              arr: str = "metric_array") -> DataFrame:
    """The same per-position sums as one row per position, dated."""
    keys = list(keys)
    sums = _position_sums(df, keys, arr)
    return sums.select("metric_name", F.date_add("month_start", F.col("pos")).alias("date"), "value")


def array_metric_daily(df: DataFrame, arr: str = "metric_array") -> DataFrame:
    """Each user's array back to one row per (metric, date) -- per user, so
    a date repeats once per user (no user column, as the reference returns)."""
    exploded = df.select("metric_name", "month_start", F.posexplode(arr).alias("pos", "value"))
    return exploded.select("metric_name", F.date_add("month_start", F.col("pos")).alias("date"),
                           "value")


def array_metric_fold(events: DataFrame, month_start, last_day, *, cut_every: int = 7,
                      metric_name: str = "site_hits") -> DataFrame:
    """The month's arrays at ``last_day`` by folding daily steps (with the
    upsert by key), checkpointing every ``cut_every`` days."""
    start = dt.date.fromisoformat(month_start) if isinstance(month_start, str) else month_start
    end = dt.date.fromisoformat(last_day) if isinstance(last_day, str) else last_day
    table = array_metric_backfill(events.limit(0), start, start, metric_name=metric_name)
    day = start
    i = 0
    while day <= end:
        table = array_metric_step(table, daily_counts(events, day), day, metric_name=metric_name)
        i += 1
        if cut_every and i % cut_every == 0:
            table = table.checkpoint(eager=True)
        day += dt.timedelta(days=1)
    return table
