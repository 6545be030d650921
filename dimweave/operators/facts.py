"""Fact tables from a duplicated detail feed.

Duplicates are found with a grouped count, removed with ``first_per_key``
(an aggregation, so partial aggregation absorbs a heavily duplicated key),
and the surviving rows get their dimension flags and parsed measures.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.picks import first_per_key
from dimweave.functions.text import minutes_from_text, substring_flag
from dimweave.operators.audit import key_violations, write_keyed

DEDUPE_KEYS = ["game_id", "team_id", "player_id"]
# A game has one date, so rows of one key need no date to be ordered; the order
# makes the pick repeatable.
DEDUPE_ORDER = ["line_no", "part_id", "price", "ship_ts", "start_position", "pts"]
STATS = ["fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk"]

FACT_SCHEMA = (
    "dim_game_date date, dim_season int, dim_team_id int, dim_player_id bigint, "
    "dim_player_name string, dim_start_position string, dim_is_playing_at_home boolean, "
    "dim_did_not_play boolean, dim_did_not_dress boolean, dim_not_with_team boolean, "
    "m_minutes double, m_fgm int, m_fga int, m_fg3m int, m_fg3a int, m_ftm int, m_fta int, "
    "m_oreb int, m_dreb int, m_reb int, m_ast int, m_stl int, m_blk int, m_turnovers int, "
    "m_pf int, m_pts int, m_plus_minus int")
FACT_KEY = ["dim_game_date", "dim_team_id", "dim_player_id"]


def fact_duplicates(details: DataFrame, keys=DEDUPE_KEYS) -> DataFrame:
    return (details.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_rows"))
            .where(F.col("num_rows") > 1))


def with_game(details: DataFrame, games: DataFrame, day=None) -> DataFrame:
    g = games.select("game_id", "game_date_est", "season", "home_team_id")
    if day is not None:
        g = g.where(F.col("game_date_est") == F.lit(dt.date.fromisoformat(day)))
    return details.join(g, on="game_id")


def pick_lines(lines: DataFrame) -> DataFrame:
    """First row per (game, player) of the raw lines.  A player has one team, so
    these are the (game, team, player) keys; picked here, a row is narrow when
    it is sorted, and only one of each key goes into the joins that describe it."""
    return first_per_key(lines, ["game_id", "player_id"], DEDUPE_ORDER)


def fact_dedupe(details: DataFrame, games: DataFrame, day=None, *, picked: bool = False,
                describe: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """First row per (game, team, player), with the game's date.  The pick comes
    before the join: its map-side limit then sees the raw rows, and only one
    row of each key travels on.  ``picked``: the rows come from ``pick_lines``.
    ``describe`` makes details of lines that are picked and have their game, so
    that only the narrow lines are sorted and shuffled."""
    first = with_game(details if picked else first_per_key(details, DEDUPE_KEYS, DEDUPE_ORDER), games, day)
    return first if describe is None else describe(first)


def _flags(markers: dict[str, str]) -> list[Column]:
    return [substring_flag(F.col("comment"), m).alias(name) for name, m in markers.items()]


def fact_features(details: DataFrame, games: DataFrame, day, markers: dict[str, str], *, picked: bool = False) -> DataFrame:
    """One day's deduplicated rows with home flag, comment flags and minutes."""
    d = fact_dedupe(details, games, day, picked=picked)
    return d.select(
        "game_date_est", "season", "team_id",
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        "player_id", "player_name", "start_position", *_flags(markers),
        minutes_from_text(F.col("min")).alias("minutes"),
        *STATS, F.col("TO").alias("turnovers"), "pf", "pts", "plus_minus")


def fact_build(details: DataFrame, games: DataFrame, markers: dict[str, str], *, picked: bool = False) -> DataFrame:
    """The full fact table, cast to its declared schema."""
    d = fact_dedupe(details, games, picked=picked)
    out = d.select(
        F.col("game_date_est").alias("dim_game_date"), F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"), F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        *_flags(markers),
        minutes_from_text(F.col("min")).alias("m_minutes"),
        *[F.col(s).alias(f"m_{s}") for s in STATS],
        F.col("TO").alias("m_turnovers"), F.col("pf").alias("m_pf"), F.col("pts").alias("m_pts"),
        F.col("plus_minus").alias("m_plus_minus"))
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string(FACT_SCHEMA)
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_fact(fact: DataFrame, path: str) -> tuple[str, str]:
    """Write the fact rows under their declared key to the new ``path`` and the
    rows that break it (a NULL part, or a key that stands more than once) whole
    to a second one, so that no row is lost and the loaded table keeps its key.
    Returns both paths; the loaded table is handed out only if the check of the
    written rows passes."""
    bad = key_violations(fact, FACT_KEY).select(*[F.col(k).alias(f"bad_{k}") for k in FACT_KEY])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"bad_{k}")) for k in FACT_KEY])
    rejects = f"{path}-rejected"
    fact.join(bad, same, "left_semi").write.parquet(rejects)
    return write_keyed(fact.join(bad, same, "left_anti"), path, FACT_KEY), rejects


def fact_bail_count(fact: DataFrame) -> DataFrame:
    return fact.groupBy("dim_player_name").agg(F.count_if("dim_not_with_team").alias("bailed_num"))


def fact_bail_rate(fact: DataFrame) -> DataFrame:
    bailed = F.count_if("dim_not_with_team")
    return fact.groupBy("dim_player_name").agg(
        F.count(F.lit(1)).alias("num_games"), bailed.alias("bailed_num"),
        (bailed.cast("double") / F.count(F.lit(1))).alias("bail_percent"))
