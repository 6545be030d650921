"""Registered queries: type-2 history built from the cumulative table."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimweave.operators import scd
from dimweave.operators.audit import write_keyed
from dimweave.plans.params import AS_OF_PERIOD, SCD_BASE, SCD_NEXT
from dimweave.plans.q_cumulative import PLAYERS_SQL, players, snap
from dimweave.plans.registry import query
from dimweave.session import scratch_path

HISTORY_KEY = ["player_name", "start_season"]


def history(spark, sf_dir):
    """The stored type-2 history up to the base period."""
    full = scd.scd2_full(players(spark, sf_dir), SCD_BASE)
    path = write_keyed(full, scratch_path(spark, "history"), HISTORY_KEY)
    return spark.read.schema(full.schema).parquet(path)

# Snapshots follow one another without a gap, so the previous one is a join away,
# and a run of equal values is where the row number less the row number among
# equal rows stays the same.
_RUNS = f"""
    nums AS (SELECT player_name, current_season, scoring_class, is_active,
                    row_number() OVER (PARTITION BY player_name ORDER BY current_season)
                    - row_number() OVER (PARTITION BY player_name, scoring_class, is_active ORDER BY current_season) AS shift
             FROM ({PLAYERS_SQL}) WHERE current_season <= {{upto}}),
    runs AS (SELECT player_name, scoring_class, is_active, min(current_season) AS start_season,
                    max(current_season) AS end_season
             FROM nums GROUP BY player_name, scoring_class, is_active, shift)"""


def scd_full_sql(upto: int) -> str:
    return f"""WITH {_RUNS.format(upto=upto)}
    SELECT *, CAST({upto} AS INTEGER) AS current_season FROM runs"""


@query("scd_change_flags", f"""
    WITH p AS ({PLAYERS_SQL})
    SELECT now.player_name, now.current_season, now.scoring_class, now.is_active,
           old.scoring_class AS previous_scoring_class, old.is_active AS previous_is_active,
           CAST(coalesce(now.scoring_class <> old.scoring_class, FALSE) AS INTEGER) AS scoring_class_change_indicator,
           CAST(coalesce(now.is_active <> old.is_active, FALSE) AS INTEGER) AS is_active_change_indicator
    FROM p now LEFT JOIN p old ON old.player_name = now.player_name AND old.current_season = now.current_season - 1""")
def q_scd_change_flags(spark, sf_dir):
    return scd.scd_change_flags(players(spark, sf_dir), SCD_NEXT)


@query("scd_streaks", f"""WITH {_RUNS.format(upto=SCD_NEXT)}
    SELECT player_name, scoring_class, is_active, start_season, end_season,
           (SELECT count(*) FROM runs e WHERE e.player_name = r.player_name AND e.start_season < r.start_season)
               AS streak_identifier
    FROM runs r""")
def q_scd_streaks(spark, sf_dir):
    return scd.scd_streaks(players(spark, sf_dir), SCD_NEXT)


@query("scd2_full", scd_full_sql(SCD_NEXT))
def q_scd2_full(spark, sf_dir):
    return scd.scd2_full(players(spark, sf_dir), SCD_NEXT)


@query("scd2_incremental", scd_full_sql(SCD_NEXT))
def q_scd2_incremental(spark, sf_dir):
    """The new period's load: reads the stored history and one snapshot."""
    new = scd.scd2_incremental(history(spark, sf_dir), snap(spark, sf_dir, SCD_NEXT), SCD_NEXT)
    path = write_keyed(new, scratch_path(spark, "history-step"), HISTORY_KEY)
    return spark.read.schema(new.schema).parquet(path)


@query("scd2_open_vs_current", f"""
    WITH s AS ({scd_full_sql(SCD_BASE)}),
    ts AS (SELECT player_name, scoring_class, is_active FROM ({PLAYERS_SQL}) WHERE current_season = {SCD_NEXT}),
    ls AS (SELECT player_name, scoring_class AS open_scoring_class, is_active AS open_is_active
           FROM s WHERE current_season = {SCD_BASE} AND end_season = {SCD_BASE})
    SELECT ts.player_name, ts.scoring_class, ts.is_active, ls.open_scoring_class, ls.open_is_active
    FROM ts LEFT JOIN ls ON ts.player_name = ls.player_name""")
def q_scd2_open_vs_current(spark, sf_dir):
    return scd.scd2_open_vs_current(history(spark, sf_dir), snap(spark, sf_dir, SCD_NEXT), SCD_NEXT)


@query("scd2_as_of", f"""
    SELECT * FROM ({scd_full_sql(SCD_NEXT)})
    WHERE start_season <= {AS_OF_PERIOD} AND end_season >= {AS_OF_PERIOD}""")
def q_scd2_as_of(spark, sf_dir):
    return scd.scd2_as_of(scd.scd2_full(players(spark, sf_dir), SCD_NEXT), AS_OF_PERIOD)


@query("sort_multi", f"""
    SELECT * FROM ({scd_full_sql(SCD_NEXT)}) ORDER BY player_name, start_season DESC""")
def q_sort_multi(spark, sf_dir):
    """Global sort on two keys, one descending (a range-partitioned exchange)."""
    s = scd.scd2_full(players(spark, sf_dir), SCD_NEXT)
    return s.orderBy(F.col("player_name").asc(), F.col("start_season").desc())
