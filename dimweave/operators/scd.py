"""Type-2 slowly changing dimensions from a cumulative table.

Change detection follows the reference's three-valued logic (rule R1):
``a <> previous`` is NULL on the first row and whenever either side is NULL,
and CASE turns NULL into "no change".  ``null_safe=True`` compares with
``eqNullSafe`` instead.

A key's history is kept as its list of runs of equal attributes.  One shuffle by
key gathers and cuts it; the runs, not the periods, then go through the change
rule in the same partitioning.  Run lists can be built in parts and merged, so
new periods are added without a rebuild (``merge_run_lists``), and so is a
history too long to be gathered at once.  ``scd2_incremental`` folds one new
period into the previous history with a single left join of the open rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _changed(a: Column, b: Column, null_safe: bool) -> Column:
    # null-safe: a change needs a previous row (the first row opens run 0).
    return (F.col("_has_prev") & ~a.eqNullSafe(b)) if null_safe else (a != b)


def scd_change_flags(players: DataFrame, upto: int, *, key: str = "player_name",
                     attrs=("scoring_class", "is_active"), period: str = "current_season",
                     null_safe: bool = False) -> DataFrame:
    """Per period: previous attribute values and one 0/1 change flag per attribute."""
    w = Window.partitionBy(key).orderBy(period)
    base = players.where(F.col(period) <= upto).select(
        key, period, *attrs, *[F.lag(a, 1).over(w).alias(f"previous_{a}") for a in attrs],
        F.lag(F.lit(True), 1).over(w).isNotNull().alias("_has_prev"))
    return base.select(*[c for c in base.columns if c != "_has_prev"], *[
        F.when(_changed(F.col(a), F.col(f"previous_{a}"), null_safe), 1).otherwise(0)
        .alias(f"{a}_change_indicator") for a in attrs])


def _runs(items: Column, attrs: list[str]) -> Column:
    """From a list of spans (start_season, end_season, attributes) in order, the
    list with neighbours of equal attributes joined.  Each span is held against
    its neighbour alone, so the work is linear."""
    def borders(off: int) -> Column:
        def stands_out(x: Column, k: Column) -> Column:
            other = F.get(items, k + off)
            return other.isNull() | ~reduce(lambda p, q: p & q, [x[a].eqNullSafe(other[a]) for a in attrs])
        return F.filter(items, stands_out)

    return F.transform(F.arrays_zip(borders(-1).alias("first"), borders(1).alias("last")), lambda z: F.struct(
        z["first"]["start_season"].alias("start_season"), z["last"]["end_season"].alias("end_season"),
        *[z["first"][a].alias(a) for a in attrs]))


def run_lists(players: DataFrame, upto: int | None = None, *, key: str = "player_name", attrs=("scoring_class", "is_active"),
              period: str = "current_season", chunk: int | None = None) -> DataFrame:
    """One row for each key: ``runs``, the list of its runs of equal attributes.

    With ``chunk`` a key's periods are first cut into spans of so many, whose
    run lists are built apart and then merged, so that a long history is never
    gathered period by period."""
    attrs = list(attrs)
    rows = players if upto is None else players.where(F.col(period) <= upto)
    span = F.struct(F.col(period).alias("start_season"), F.col(period).alias("end_season"), *attrs)

    def gathered(df: DataFrame, *keys) -> DataFrame:
        lists = df.groupBy(*keys).agg(F.array_sort(F.collect_list("span")).alias("spans"))
        return lists.withColumn("runs", _runs(F.col("spans"), attrs)).drop("spans")

    spans = rows.select(key, span.alias("span"))
    if chunk is None:
        return gathered(spans, key)
    parts = gathered(spans.withColumn("part", F.floor(F.col("span.start_season") / chunk)), key, "part")
    return gathered(parts.select(key, F.explode("runs").alias("span")), key)


def merge_run_lists(older: DataFrame, newer: DataFrame, *, key: str = "player_name", attrs=("scoring_class", "is_active")) -> DataFrame:
    """The run lists of two parts of a history as one: what has been loaded and
    the new periods (no period stands in both).  Only runs are read."""
    lists = older.unionByName(newer).groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("spans"))
    return lists.select(key, _runs(F.col("spans"), list(attrs)).alias("runs"))


def _streaks(lists: DataFrame, key: str, attrs: list[str], null_safe: bool) -> DataFrame:
    """key, streak_identifier, attributes, first and last period, from run lists.
    Rule R1 can leave several runs in one streak; equal ones are one row."""
    runs = lists.select(key, F.posexplode("runs").alias("k", "run")).select(key, "k", "run.*")
    if null_safe:  # neighbours differ, so each run is a streak
        return runs.select(key, F.col("k").cast("bigint").alias("streak_identifier"), *attrs, "start_season", "end_season")
    w = Window.partitionBy(key).orderBy("k")
    changed = reduce(lambda p, q: p | F.coalesce(q, F.lit(False)), [F.col(a) != F.lag(a, 1).over(w) for a in attrs], F.lit(False))
    flagged = runs.withColumn("changed", changed.cast("int"))
    return (flagged.withColumn("streak_identifier", F.sum("changed").over(w)).groupBy(key, "streak_identifier", *attrs)
            .agg(F.min("start_season").alias("start_season"), F.max("end_season").alias("end_season")))


def scd_streaks(players: DataFrame, upto: int, *, key: str = "player_name",
                attrs=("scoring_class", "is_active"), period: str = "current_season",
                null_safe: bool = False) -> DataFrame:
    """Runs of equal attributes: run number, first and last period."""
    attrs = list(attrs)
    s = _streaks(run_lists(players, upto, key=key, attrs=attrs, period=period), key, attrs, null_safe)
    return s.select(key, *attrs, "streak_identifier", "start_season", "end_season")


def scd2_from_runs(lists: DataFrame, upto: int | Column, *, key: str = "player_name",
                   attrs=("scoring_class", "is_active"), null_safe: bool = False) -> DataFrame:
    """Type-2 rows of stored or merged run lists, stamped with ``upto``."""
    attrs = list(attrs)
    return _streaks(lists, key, attrs, null_safe).select(
        key, *attrs, "start_season", "end_season", F.lit(upto).cast("int").alias("current_season"))


def scd2_full(players: DataFrame, upto: int, *, key: str = "player_name",
              attrs=("scoring_class", "is_active"), period: str = "current_season",
              null_safe: bool = False, chunk: int | None = None) -> DataFrame:
    """Type-2 history up to ``upto``: one row per run, stamped with ``upto``.
    ``chunk``: see ``run_lists``."""
    lists = run_lists(players, upto, key=key, attrs=attrs, period=period, chunk=chunk)
    return scd2_from_runs(lists, upto, key=key, attrs=attrs, null_safe=null_safe)


def scd2_incremental(scd: DataFrame, current: DataFrame, period: int, *,
                     key: str = "player_name", attrs=("scoring_class", "is_active")) -> DataFrame:
    """Next history from the previous one (stamped ``period - 1``) and the
    new period's rows: closed rows kept, unchanged open runs extended,
    changed runs closed plus a new run, new entities opened.

    Rule R2 is kept: a NULL attribute on either side puts a row in none of
    the branches, and an open entity absent from ``current`` is dropped.
    """
    attrs = list(attrs)
    prev = period - 1
    hist = (scd.where((F.col("current_season") == prev) & (F.col("end_season") < prev))
            .select(key, *attrs, "start_season", "end_season"))
    open_rows = scd.where((F.col("current_season") == prev) & (F.col("end_season") == prev))
    ts = current.select(key, *attrs).alias("ts")
    ls = open_rows.select(key, *attrs, "start_season", "end_season").alias("ls")
    j = ts.join(ls, F.col(f"ts.{key}") == F.col(f"ls.{key}"), "left")

    same = reduce(lambda a, b: a & b, [F.col(f"ts.{a}") == F.col(f"ls.{a}") for a in attrs])
    diff = reduce(lambda a, b: a | b, [F.col(f"ts.{a}") != F.col(f"ls.{a}") for a in attrs])
    p = F.lit(period).cast("int")

    def rec(src: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{src}.{a}").alias(a) for a in attrs],
                        start.cast("int").alias("start_season"), end.cast("int").alias("end_season"))

    rec_type = f"array<struct<{','.join(f'{a}:{ts.schema[a].dataType.simpleString()}' for a in attrs)},start_season:int,end_season:int>>"
    records = (F.when(F.col(f"ls.{key}").isNull(), F.array(rec("ts", p, p)))
               .when(F.coalesce(same, F.lit(False)), F.array(rec("ts", F.col("ls.start_season"), p)))
               .when(F.coalesce(diff, F.lit(False)),
                     F.array(rec("ls", F.col("ls.start_season"), F.col("ls.end_season")), rec("ts", p, p)))
               .otherwise(F.array().cast(rec_type)))
    moved = j.select(F.col(f"ts.{key}").alias(key), F.explode(records).alias("r")).select(key, "r.*")
    return hist.unionByName(moved).withColumn("current_season", p)


def scd2_open_vs_current(scd: DataFrame, current: DataFrame, period: int, *,
                         key: str = "player_name", attrs=("scoring_class", "is_active")) -> DataFrame:
    """This period's attributes next to the open run's (left join)."""
    prev = period - 1
    open_rows = scd.where((F.col("current_season") == prev) & (F.col("end_season") == prev))
    ls = open_rows.select(key, *[F.col(a).alias(f"open_{a}") for a in attrs])
    return current.select(key, *attrs).join(ls, on=key, how="left")


def scd2_as_of(scd: DataFrame, period: int) -> DataFrame:
    """Rows valid in ``period``: start <= period <= end."""
    return scd.where((F.col("start_season") <= period) & (F.col("end_season") >= period))
