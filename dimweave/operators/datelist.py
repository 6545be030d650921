"""Active-date lists and their 32-bit encodings.

A user's activity table holds, per snapshot date, the list of days the user
was active (newest first).  The daily job folds one day into yesterday's
snapshot (``datelist_step``); ``datelist_backfill`` builds any snapshot in one
pass straight from the activity facts.  From the list, each day in a 30-day
window becomes one bit of a 32-bit integer, newest day in the high bit, and
daily / weekly / monthly flags are bit tests on that integer.

Bit rule (kept as the reference computes it): a day ``d`` days before the
as-of date contributes ``2 ** (32 - d)`` truncated to 32 bits, so the as-of day
itself (d = 0) wraps to 0 and the high bit is *yesterday*.  ``include_today``
shifts by ``31 - d`` instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.bits import MASK32, day_bit

# The masks the reference writes as 30-character bit strings,
# zero-padded on the right to 32 bits.
WEEKLY_MASK = 0xFE000000   # '1111111' then zeros: days 1..7 before the as-of day
DAILY_MASK = 0x80000000    # '1' then zeros: the day before the as-of day
WINDOW_DAYS = 30


def _d(x) -> Column:
    return F.lit(dt.date.fromisoformat(x) if isinstance(x, str) else x)


def last_day(activity: DataFrame, day_col: str = "day") -> Column:
    """The newest day in the data: a scalar subquery of the plan that uses it."""
    return activity.agg(F.max(day_col)).scalar()


def datelist_backfill(activity: DataFrame, asof=None, *, user_col: str = "user_id",
                      day_col: str = "day", since=None) -> DataFrame:
    """The cumulated snapshot at ``asof`` (default: the data's last day): every user seen up to that day with
    the list of active days, newest first; rows without a user are left out, as
    in the daily step.  One aggregation, no fold.  The list grows with the
    history unless ``since`` cuts it."""
    asof = last_day(activity, day_col) if asof is None else asof
    cond = (F.col(day_col) <= _d(asof)) & F.col(user_col).isNotNull()
    if since is not None:
        cond = cond & (F.col(day_col) >= _d(since))
    return (activity.where(cond)
            .groupBy(F.col(user_col).cast("string").alias("user_id"))
            .agg(F.sort_array(F.collect_set(day_col), asc=False).alias("dates_active"))
            .select("user_id", "dates_active", _d(asof).alias("date")))


def datelist_today(activity: DataFrame, day, *, user_col: str = "user_id",
                   day_col: str = "day") -> DataFrame:
    """One day's distinct active users (the 'today' side of a step)."""
    return (activity.where((F.col(day_col) == _d(day)) & F.col(user_col).isNotNull())
            .select(F.col(user_col).cast("string").alias("user_id"),
                    F.col(day_col).alias("date_active"))
            .distinct())


def datelist_step(yesterday: DataFrame, today: DataFrame) -> DataFrame:
    """Fold one day into yesterday's snapshot: full outer join on the user,
    today's day prepended to the list; the snapshot date moves on by one."""
    y = yesterday.alias("y")
    t = today.alias("t")
    j = t.join(y, F.col("t.user_id") == F.col("y.user_id"), "full_outer")
    dates = (F.when(F.col("y.dates_active").isNull(), F.array(F.col("t.date_active")))
             .when(F.col("t.date_active").isNull(), F.col("y.dates_active"))
             .otherwise(F.array_prepend(F.col("y.dates_active"), F.col("t.date_active"))))
    return j.select(
        F.coalesce(F.col("t.user_id"), F.col("y.user_id")).alias("user_id"),
        dates.alias("dates_active"),
        F.coalesce(F.col("t.date_active"), F.date_add(F.col("y.date"), 1)).alias("date"),
    )


def _window_days(dates: Column, asof: Column, window: int) -> Column:
    """Days of the list inside the window (0 .. window-1 days before asof)."""
    return F.filter(dates, lambda d: (F.datediff(asof, d) >= 0) & (F.datediff(asof, d) < window))


def datelist_int(users: DataFrame, *, window: int = WINDOW_DAYS,
                 include_today: bool = False) -> DataFrame:
    """One 32-bit integer per user for the window ending at the snapshot
    date: the OR of every active day's bit.  Pure per-row array work; no
    join and no shuffle."""
    asof = F.col("date")
    days = _window_days(F.col("dates_active"), asof, window)
    bits = F.aggregate(days, F.lit(0).cast("bigint"),
                       lambda acc, d: acc.bitwiseOR(day_bit(F.datediff(asof, d), include_today)))
    return users.select("user_id", bits.alias("datelist_int"))


# A rolling state: one integer for each user in place of the list of days.  A day
# d days before the state's date is the bit 2 ** (32 - d), so that the state's own
# day is kept too (the 33rd bit); its size does not grow with the history.
TODAY_BIT = 1 << 32


def _kept(window: int) -> int:
    """The bits of the last ``window`` days."""
    return ((1 << window) - 1) << (33 - window)


def datelist_state(activity: DataFrame, asof=None, *, user_col: str = "user_id", day_col: str = "day",
                   window: int = WINDOW_DAYS) -> DataFrame:
    """The state at ``asof`` (default: the data's last day) straight from the
    activity (repeated rows do no harm): user_id, window_bits, date.  Users whose
    days lie before the window have no bits; rows without a user are left out.
    The bits are OR-ed before the shuffle, so no list is made anywhere."""
    asof = _d(last_day(activity, day_col) if asof is None else asof)
    ago = F.datediff(asof, F.col(day_col))
    bit = F.when(ago < window, F.call_function("shiftleft", F.lit(1).cast("bigint"), 32 - ago)).otherwise(F.lit(0).cast("bigint"))
    return (activity.where((F.col(day_col) <= asof) & F.col(user_col).isNotNull())
            .groupBy(F.col(user_col).cast("string").alias("user_id")).agg(F.bit_or(bit).alias("window_bits"))
            .select("user_id", "window_bits", asof.alias("date")))


def datelist_state_step(state: DataFrame, today: DataFrame, day, *, window: int = WINDOW_DAYS) -> DataFrame:
    """Move the state on to ``day`` and add its users (``today``: user_id).  The
    bits shift by the days that have passed since the state's date, one or more;
    loading a day again changes nothing, and an earlier day is an error."""
    seen = today.select("user_id", F.lit(TODAY_BIT).alias("seen")).distinct()
    passed = F.datediff(_d(day), F.col("date"))
    passed = F.when(passed < 0, F.raise_error(F.concat(F.lit("the state is newer: "), F.col("date").cast("string")))).otherwise(F.least(passed, F.lit(63)))
    moved = F.call_function("shiftright", F.col("window_bits"), passed.cast("int")).bitwiseAND(F.lit(_kept(window)))
    zero = F.lit(0).cast("bigint")
    return state.join(seen, "user_id", "full_outer").select(
        "user_id", F.when(F.col("date").isNull(), zero).otherwise(moved).bitwiseOR(F.coalesce("seen", zero)).alias("window_bits"),
        _d(day).cast("date").alias("date"))


def datelist_state_int(state: DataFrame, *, include_today: bool = False) -> DataFrame:
    """The 32-bit integer of each user's state, by the module's bit rule."""
    bits = F.call_function("shiftright", F.col("window_bits"), F.lit(1)) if include_today else F.col("window_bits").bitwiseAND(F.lit(MASK32))
    return state.select("user_id", bits.alias("datelist_int"))


def datelist_bits(users: DataFrame, *, window: int = WINDOW_DAYS,
                  include_today: bool = False) -> DataFrame:
    """The reference's literal result: per user, each *distinct* per-day value
    of the 30-day series (0 for inactive days and for the wrapped as-of day),
    with the three flags computed on that single value.

    The reference reaches this by crossing users with the day series; here
    the values come from the user's own list, so no cross join is needed:
    every active day gives its bit, and a 0 row exists whenever some day of
    the window is inactive or the as-of day itself is active (it wraps to 0).
    """
    asof = F.col("date")
    days = _window_days(F.col("dates_active"), asof, window)
    values = F.transform(days, lambda d: day_bit(F.datediff(asof, d), include_today))
    has_zero = (F.size(days) < window) | F.array_contains(values, F.lit(0).cast("bigint"))
    all_values = F.array_distinct(F.concat(
        values, F.when(has_zero, F.array(F.lit(0).cast("bigint")))
        .otherwise(F.array().cast("array<bigint>"))))
    exploded = users.select("user_id", F.explode(all_values).alias("placeholder_int_value"))
    return activity_flags(exploded, value_col="placeholder_int_value")


def activity_flags(df: DataFrame, *, value_col: str = "datelist_int") -> DataFrame:
    """Monthly / weekly / daily activity as bit tests on the window integer."""
    v = F.col(value_col)
    return df.select(
        "*",
        (F.bit_count(v) > 0).alias("dim_is_monthly_active"),
        (F.bit_count(v.bitwiseAND(F.lit(WEEKLY_MASK))) > 0).alias("dim_is_weekly_active"),
        (F.bit_count(v.bitwiseAND(F.lit(DAILY_MASK))) > 0).alias("dim_is_daily_active"),
    )


def active_day_count(df: DataFrame, *, value_col: str = "datelist_int") -> DataFrame:
    return df.select("user_id", F.bit_count(value_col).cast("int").alias("active_days"))


def date_series(df: DataFrame, ts_col: str, *, name: str = "series_date") -> DataFrame:
    """One row per day between the first and last day present in ``ts_col``,
    inclusive.  The bounds come from a global min/max (one row), so the
    series itself is generated by a single ``sequence`` explode."""
    bounds = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(name))


def users_by_day(users: DataFrame, start, end) -> DataFrame:
    """Every user paired with every day of [start, end] -- the reference's
    users x series cross join, produced per row by a bounded generator."""
    return users.select(
        "*", F.explode(F.sequence(_d(start), _d(end), F.expr("interval 1 day"))).alias("series_date"))


def datelist_bits_by_day(users: DataFrame, start, end, *, include_today: bool = False) -> DataFrame:
    """Per-day bit rows (user, series day, value) from the users x days grid."""
    grid = users_by_day(users, start, end)
    d = F.datediff(F.col("date"), F.col("series_date"))
    val = F.when(F.array_contains("dates_active", F.col("series_date")),
                 day_bit(d, include_today)).otherwise(F.lit(0).cast("bigint"))
    return grid.select("user_id", "series_date", val.alias("placeholder_int_value"))


def bit_or_per_user(bits: DataFrame, *, value_col: str = "placeholder_int_value") -> DataFrame:
    """Fold the per-day values into one integer per user (``bit_or``;
    bits are disjoint, so this equals the SUM the reference mentions)."""
    return bits.groupBy("user_id").agg(F.bit_or(value_col).alias("datelist_int"))


__all__ = [
    "MASK32", "WEEKLY_MASK", "DAILY_MASK", "last_day", "datelist_backfill", "datelist_today",
    "datelist_state", "datelist_state_step", "datelist_state_int",
    "datelist_step", "datelist_int", "datelist_bits", "activity_flags",
    "active_day_count", "date_series", "users_by_day", "datelist_bits_by_day",
    "bit_or_per_user",
]


def datelist_fold(activity: DataFrame, first_day, last_day, *, cut_every: int = 7) -> DataFrame:
    """The snapshot at ``last_day`` by folding daily steps from ``first_day``
    (the reference's daily load).  Lineage is cut with a reliable checkpoint
    every ``cut_every`` days so the plan stays bounded."""
    start = dt.date.fromisoformat(first_day) if isinstance(first_day, str) else first_day
    end = dt.date.fromisoformat(last_day) if isinstance(last_day, str) else last_day
    snap = datelist_backfill(activity.limit(0), start - dt.timedelta(days=1))
    day = start
    i = 0
    while day <= end:
        snap = datelist_step(snap, datelist_today(activity, day))
        i += 1
        if cut_every and i % cut_every == 0:
            snap = snap.checkpoint(eager=True)
        day += dt.timedelta(days=1)
    return snap
