"""Fixture views: the reference's named inputs (player seasons, games, game
details, teams, web events, devices, matches, taxi trips, film permits)
derived from the driver's TPC-H-style Parquet tables.

Each view is a plain DataFrame built from scans of the base tables, so its
size grows with the data and Catalyst can push filters and column pruning
down into the Parquet reads.  The mapping is fixed by FIXTURES.md; the
DuckDB side of every view lives in ``dimweave.plans.fixture_sql`` and is
written independently so the oracle also checks these definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.operators.joins import join_broadcast
from dimweave.session import table_path


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table's scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, order year): the 'player season' grain."""
    orders = base(spark, sf_dir, "orders").select(
        "o_custkey",
        F.year("o_orderdate").alias("season"),
        F.floor(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        "o_orderpriority",
    )
    # One shuffle: partial aggregation on (customer, year) runs map-side, and
    # the distinct priorities are a set over a 5-value domain (a DISTINCT
    # count would add an Expand and a second shuffle).
    per_season = orders.groupBy("o_custkey", "season").agg(
        F.sum("cents").alias("cents"),
        F.count(F.lit(1)).alias("n_orders"),
        F.size(F.collect_set("o_orderpriority")).cast("bigint").alias("n_priorities"),
    )
    customer = base(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    nation = base(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (per_season
              .join(customer, per_season.o_custkey == customer.c_custkey)
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return joined.select(
        F.col("o_custkey").cast("string").alias("player_name"),
        F.concat(F.lit("6-"), (F.col("c_nationkey") % 12).cast("string")).alias("height"),
        F.col("c_mktsegment").alias("college"),
        F.col("n_name").alias("country"),
        (F.lit(1990) + F.col("c_nationkey") % 5).cast("string").alias("draft_year"),
        (F.lit(1) + F.col("c_custkey") % 2).cast("string").alias("draft_round"),
        (F.lit(1) + F.col("c_custkey") % 60).cast("string").alias("draft_number"),
        F.col("season").cast("int").alias("season"),
        (F.col("cents").cast("double") / F.lit(2500000.0)).alias("pts"),
        F.col("n_orders").cast("double").alias("ast"),
        F.col("n_priorities").cast("double").alias("reb"),
        F.col("c_nationkey").cast("int").alias("weight"),
    )


LINE_COLUMNS = ["game_id", "player_id", "line_no", "part_id", "price", "ship_ts", "start_position", "pts"]


def game_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One narrow row per line item: the keys of the box score, the columns that
    it is computed from, and tie-breakers that make row picks repeatable."""
    return base(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), F.col("l_suppkey").alias("player_id"),
        F.col("l_linenumber").alias("line_no"), F.col("l_partkey").alias("part_id"),
        F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("ship_ts"),
        F.col("l_returnflag").alias("start_position"), F.col("l_quantity").cast("int").alias("pts"))


def with_comments(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines whose part is known, with the part's name as the comment."""
    part = base(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("comment"))
    return lines.join(part, F.col("part_id") == F.col("p_partkey")).drop("p_partkey")


def described(lines: DataFrame, spark: SparkSession, sf_dir: str, comments: bool = False, *, once: bool = False) -> DataFrame:
    """The box score of ``game_lines`` rows: team and names by joins, and the
    comment (a join of its own) only where it is asked for and the lines do not
    have it.  Further columns of the lines stay, as the last.  ``once``: a player
    or team that is listed more than once gives no further rows of a line, a
    player with several teams one row for each team; the players are broadcast
    if they are counted to be few."""
    sup = base(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = base(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    further = [c for c in lines.columns if c not in (*LINE_COLUMNS, "comment")]
    if once:
        nation = nation.groupBy("n_nationkey").agg(F.min("n_name").alias("n_name"))
        sup = sup.groupBy("s_suppkey", "s_nationkey").agg(F.min("s_name").alias("s_name"))
        team = sup.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumnRenamed("s_suppkey", "player_id")
        j = join_broadcast(lines, team, "player_id")
    else:
        j = (lines.join(sup, lines.player_id == sup.s_suppkey)
             .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))
    if comments and "comment" not in lines.columns:
        j = with_comments(j, spark, sf_dir)
    q, ln = F.col("pts"), F.col("line_no")
    return j.select(
        "game_id", F.col("s_nationkey").cast("int").alias("team_id"), F.col("n_name").alias("team_abbreviation"),
        "player_id", F.col("s_name").alias("player_name"), "start_position",
        *(["comment"] if comments else []),
        F.concat(ln.cast("string"), F.lit(":"), F.lpad(q.cast("string"), 2, "0")).alias("min"),
        (q % 7).alias("fgm"), (q % 11).alias("fga"), (q % 3).alias("fg3m"),
        (q % 5).alias("fg3a"), (q % 4).alias("ftm"), (q % 6).alias("fta"),
        (ln % 3).alias("oreb"), (ln % 4).alias("dreb"), (ln % 3 + ln % 4).alias("reb"),
        (q % 9).alias("ast"), (q % 2).alias("stl"), (ln % 2).alias("blk"),
        (q % 8).alias("TO"), ln.alias("pf"), "pts", (q - 25).alias("plus_minus"),
        "line_no", "part_id", "price", "ship_ts", *further,
    )


def game_details(spark: SparkSession, sf_dir: str, comments: bool = False) -> DataFrame:
    """One row per line item: (game, team, player) with box-score columns.
    Contains duplicate (game, team, player) rows, like the reference input."""
    return described(game_lines(spark, sf_dir), spark, sf_dir, comments)


def large_games(spark: SparkSession, sf_dir: str, more_than: int) -> DataFrame:
    """game_id and n of the games with more than so many line items, which are
    at least as many as their players (one scan of one column)."""
    return (base(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("game_id")).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > more_than))


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = base(spark, sf_dir, "orders")
    cust = base(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    j = orders.join(cust, orders.o_custkey == cust.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").cast("int").alias("season"),
        F.col("c_nationkey").cast("int").alias("home_team_id"),
        (F.col("o_custkey") % 25).cast("int").alias("visitor_team_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("int").alias("home_team_wins"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("pts_home"),
        F.floor(F.col("o_totalprice") / 1500).cast("int").alias("pts_away"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier, so each team repeats (duplicates on purpose)."""
    sup = base(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = base(spark, sf_dir, "nation")
    j = sup.join(nation, sup.s_nationkey == nation.n_nationkey)
    return j.select(
        F.col("n_nationkey").cast("int").alias("team_id"),
        F.col("n_name").alias("abbreviation"),
        F.lower("n_name").alias("nickname"),
        (F.lit(1946) + F.col("n_regionkey")).cast("int").alias("yearfounded"),
        F.concat(F.lit("city_"), F.col("n_regionkey").cast("string")).alias("city"),
        F.col("s_name").alias("arena"),
        F.col("s_suppkey").alias("team_row"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web events with nullable user, device taken from the JSON props."""
    ev = base(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        F.when(F.col("event_id") % 97 == 0, F.lit(None)).otherwise(F.col("user_id"))
        .cast("bigint").alias("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("device_id"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type"))
        .alias("referrer"),
        F.col("event_type").alias("host"),
        F.concat(F.lit("/"), F.col("event_type")).alias("url"),
        F.col("ts").alias("event_time"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = events(spark, sf_dir).select("device_id").where(F.col("device_id") % 10 != 0).distinct()
    return k.select(
        "device_id",
        F.concat(F.lit("b"), (F.col("device_id") % 3).cast("string")).alias("browser_type"),
        F.concat(F.lit("o"), (F.col("device_id") % 4).cast("string")).alias("os_type"),
        F.concat(F.lit("d"), (F.col("device_id") % 5).cast("string")).alias("device_type"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, day) of every event; user_id may be NULL."""
    return events(spark, sf_dir).select("user_id", F.to_date("event_time").alias("day"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct (user_id, day) pairs of all events."""
    return visits(spark, sf_dir).distinct()


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = base(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        (F.col("o_orderstatus") == "F").alias("is_team_game"),
        F.col("o_orderpriority").alias("playlist_id"),
        F.col("o_orderdate").alias("completion_date"),
    )


def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = base(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("match_id"),
        F.col("l_suppkey").cast("string").alias("player_gamertag"),
        F.col("l_quantity").cast("int").alias("player_total_kills"),
        F.col("l_linenumber").alias("player_total_deaths"),
    )


def taxis(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = base(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_linenumber").alias("VendorID"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.expr("timestampadd(HOUR, l_linenumber, l_shipdate)").alias("tpep_dropoff_datetime"),
        (F.col("l_quantity") - 1).alias("trip_distance"),
        (F.col("l_extendedprice") / 1000).alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_discount") / 1000).alias("tip_amount"),
        (F.col("l_extendedprice") * (F.lit(0.05) - F.col("l_discount"))).alias("total_amount"),
    )


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = base(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("permit_id"), F.col("event_type").alias("borough"))
