"""Registered queries: cumulative snapshot table and its history arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimweave.operators import cumulative as cu
from dimweave.operators.audit import write_keyed
from dimweave.plans.params import LAST_PERIOD, LOOKUP_PLAYER
from dimweave.plans.registry import query
from dimweave.session import scratch_path
from dimweave.sources import fixtures as fx

P = LAST_PERIOD

PLAYERS_SQL = """
    WITH ps AS (SELECT * FROM fx_player_seasons),
    f AS (SELECT player_name, min(season) AS first_season FROM ps GROUP BY player_name),
    g AS (SELECT f.*, CAST(unnest(range(first_season, (SELECT max(season) + 1 FROM ps))) AS INTEGER) AS current_season FROM f),
    h AS (SELECT g.player_name, g.current_season, max(s.season) AS last_season,
                 first(height ORDER BY s.season) FILTER (height IS NOT NULL) AS height,
                 first(college ORDER BY s.season) FILTER (college IS NOT NULL) AS college,
                 first(country ORDER BY s.season) FILTER (country IS NOT NULL) AS country,
                 first(draft_year ORDER BY s.season) FILTER (draft_year IS NOT NULL) AS draft_year,
                 first(draft_round ORDER BY s.season) FILTER (draft_round IS NOT NULL) AS draft_round,
                 first(draft_number ORDER BY s.season) FILTER (draft_number IS NOT NULL) AS draft_number,
                 list(struct_pack(season := s.season, pts := s.pts, ast := s.ast, reb := s.reb,
                                  weight := s.weight) ORDER BY s.season) AS seasons
          FROM g JOIN ps s ON s.player_name = g.player_name AND s.season <= g.current_season
          GROUP BY g.player_name, g.current_season)
    SELECT g.player_name, h.height, h.college, h.country, h.draft_year, h.draft_round, h.draft_number,
           h.seasons,
           CASE WHEN l.pts > 20 THEN 'star' WHEN l.pts > 15 THEN 'good'
                WHEN l.pts > 10 THEN 'average' ELSE 'bad' END AS scoring_class,
           CAST(CASE WHEN l.pts > 20 THEN 3 WHEN l.pts > 15 THEN 2 WHEN l.pts > 10 THEN 1 ELSE 0 END AS INTEGER)
               AS scoring_class_ord,
           CAST(g.current_season - h.last_season AS INTEGER) AS years_since_last_active,
           h.last_season = g.current_season AS is_active,
           g.current_season
    FROM g JOIN h ON g.player_name = h.player_name AND g.current_season = h.current_season
    JOIN ps l ON l.player_name = g.player_name AND l.season = h.last_season"""


def players_sql_at(period: int) -> str:
    return f"SELECT * FROM ({PLAYERS_SQL}) WHERE current_season = {period}"


def players(spark, sf_dir):
    return cu.cumulative_backfill(fx.player_seasons(spark, sf_dir))


KEY = ["player_name", "current_season"]


def stored(spark, sf_dir, periods):
    """The snapshots of some periods as a stored table: partitioned by period,
    handed out only if its declared key holds."""
    table = cu.cumulative_backfill(fx.player_seasons(spark, sf_dir), periods=periods)
    path = write_keyed(table, scratch_path(spark, "players"), KEY, ["current_season"])
    return spark.read.schema(table.schema).parquet(path)


def snap(spark, sf_dir, period=P):
    """One snapshot, read from its partition."""
    return cu.snapshot(stored(spark, sf_dir, [period]), period)


@query("cumulative_backfill", PLAYERS_SQL)
def q_cumulative_backfill(spark, sf_dir):
    return players(spark, sf_dir)


@query("cumulative_step", players_sql_at(P))
def q_cumulative_step(spark, sf_dir):
    """The load of the newest period: reads the stored previous snapshot and the
    new rows, and adds a partition to the table."""
    cur = fx.player_seasons(spark, sf_dir).where(F.col("season") == P)
    new = cu.cumulative_step(snap(spark, sf_dir, P - 1), cur)
    path = write_keyed(new, scratch_path(spark, "players-step"), KEY, ["current_season"])
    return spark.read.schema(new.schema).parquet(path)


@query("history_unnest", f"""
    SELECT player_name, season, pts, ast, reb, weight FROM fx_player_seasons WHERE season <= {P}""")
def q_history_unnest(spark, sf_dir):
    return cu.history_unnest(snap(spark, sf_dir))


@query("history_first_last", f"""
    SELECT player_name, seasons[1] AS first_season, seasons[len(seasons)] AS latest_season
    FROM ({players_sql_at(P)})""")
def q_history_first_last(spark, sf_dir):
    return cu.history_first_last(snap(spark, sf_dir))


_GROWTH_SQL = f"""
    SELECT player_name,
           struct_extract(seasons[len(seasons)], 'pts') /
           CASE WHEN struct_extract(seasons[1], 'pts') = 0 THEN 1
                ELSE struct_extract(seasons[1], 'pts') END AS growth
    FROM ({players_sql_at(P)})"""


@query("history_growth", _GROWTH_SQL)
def q_history_growth(spark, sf_dir):
    return cu.history_growth(snap(spark, sf_dir))


@query("limit_take", f"SELECT * FROM ({_GROWTH_SQL}) ORDER BY growth DESC, player_name LIMIT 20")
def q_limit_take(spark, sf_dir):
    """Top-k report: a sort + limit becomes TakeOrderedAndProject (per-partition
    top-k, then a merge of k rows per partition)."""
    g = cu.history_growth(snap(spark, sf_dir))
    return g.orderBy(F.col("growth").desc(), F.col("player_name")).limit(20)


@query("entity_lookup", f"""
    SELECT * FROM ({players_sql_at(P)}) WHERE player_name = '{LOOKUP_PLAYER}'""")
def q_entity_lookup(spark, sf_dir):
    """One entity at one period: the period prunes partitions, the key reaches
    the Parquet scan."""
    return cu.entity_lookup(stored(spark, sf_dir, [P - 1, P]), P, LOOKUP_PLAYER)


@query("project_struct_expand", f"""
    SELECT player_name, s.season, s.pts, s.ast, s.reb, s.weight
    FROM (SELECT player_name, seasons[len(seasons)] AS s FROM ({players_sql_at(P)}))""")
def q_project_struct_expand(spark, sf_dir):
    latest = snap(spark, sf_dir).select("player_name",
                                        F.try_element_at("seasons", F.lit(-1)).alias("latest"))
    return latest.select("player_name", "latest.*")


@query("filter_asof_partition", f"""
    SELECT player_name, scoring_class, years_since_last_active, is_active, current_season
    FROM ({players_sql_at(P)})""")
def q_filter_asof_partition(spark, sf_dir):
    """Write the table partitioned by period, read one snapshot back: the
    period filter prunes to one directory (PartitionFilters in the scan)."""
    t = stored(spark, sf_dir, None)
    return (t.where(F.col("current_season") == P)
            .select("player_name", "scoring_class", "years_since_last_active", "is_active", "current_season"))


@query("fn_case", """
    SELECT player_name, season,
           CASE WHEN pts > 20 THEN 'star' WHEN pts > 15 THEN 'good'
                WHEN pts > 10 THEN 'average' ELSE 'bad' END AS scoring_class
    FROM fx_player_seasons""")
def q_fn_case(spark, sf_dir):
    s = fx.player_seasons(spark, sf_dir)
    return s.select("player_name", "season", cu.scoring_class(F.col("pts")).alias("scoring_class"))


@query("win_lag", """
    SELECT player_name, season, pts,
           LAG(pts, 1) OVER (PARTITION BY player_name ORDER BY season) AS prev_pts
    FROM fx_player_seasons""")
def q_win_lag(spark, sf_dir):
    from pyspark.sql import Window
    w = Window.partitionBy("player_name").orderBy("season")
    s = fx.player_seasons(spark, sf_dir)
    return s.select("player_name", "season", "pts", F.lag("pts", 1).over(w).alias("prev_pts"))


@query("win_running_sum", """
    SELECT player_name, season,
           SUM(ast) OVER (PARTITION BY player_name ORDER BY season) AS running_ast
    FROM fx_player_seasons""")
def q_win_running_sum(spark, sf_dir):
    from pyspark.sql import Window
    w = Window.partitionBy("player_name").orderBy("season")  # default frame: RANGE to current row
    s = fx.player_seasons(spark, sf_dir)
    return s.select("player_name", "season", F.sum("ast").over(w).alias("running_ast"))


@query("union_all", f"""
    SELECT player_name, season, pts FROM fx_player_seasons WHERE season <= {P - 1}
    UNION ALL
    SELECT player_name, season, pts FROM fx_player_seasons WHERE season > {P - 1}""")
def q_union_all(spark, sf_dir):
    """The loaded seasons and the newer ones, stacked with duplicates kept."""
    s = fx.player_seasons(spark, sf_dir).select("player_name", "season", "pts")
    return s.where(F.col("season") <= P - 1).unionByName(s.where(F.col("season") > P - 1))


@query("join_anti", f"""
    SELECT t.player_name, t.season, t.pts FROM fx_player_seasons t
    WHERE t.season = {P}
      AND NOT EXISTS (SELECT 1 FROM fx_player_seasons l
                      WHERE l.season = {P - 1} AND l.player_name = t.player_name)""")
def q_join_anti(spark, sf_dir):
    s = fx.player_seasons(spark, sf_dir)
    this = s.where(F.col("season") == P).select("player_name", "season", "pts")
    last = s.where(F.col("season") == P - 1).select("player_name")
    return this.join(last, on="player_name", how="left_anti")
