"""A property graph kept as two tables: vertices(identifier, type,
properties) and edges(subject, subject_type, object, object_type, edge_type,
properties), with properties as compact JSON text.

Player-to-player edges come from pairs of (deduplicated) participation rows of
one game.  Their number is by definition quadratic in the game's players, so a
game with more than ``PAIR_BLOCK`` players is cut into blocks, and each two
blocks (or one with itself) are a cell.  A row goes to the cells of its block,
a cell is collected as one list, and each pair is made inside one cell.  No
task has to make more than a cell's pairs at a time, and no row is joined with
another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimweave.functions.picks import first_per_key

JSON_OPTS = {"ignoreNullFields": "false"}
#: Players of one game that are paired in one cell.
PAIR_BLOCK = 200
# Total order for picking one participation row per (player, game).
PICK_ORDER = ["line_no", "part_id", "price", "ship_ts", "start_position", "pts"]


def json_props(*cols: Column) -> Column:
    """Named fields -> JSON text, keeping NULL fields (as the reference's
    JSON builder does)."""
    return F.to_json(F.struct(*cols), JSON_OPTS)


def vertices_game(games: DataFrame) -> DataFrame:
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return games.select(
        F.col("game_id").alias("identifier"), F.lit("game").alias("type"),
        json_props(F.col("pts_home"), F.col("pts_away"), winner.alias("winning_team")).alias("properties"))


def player_totals(details: DataFrame) -> DataFrame:
    """Per player: name, rows, points and teams (as many as there are teams)."""
    return details.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"),
        F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"),
        F.array_sort(F.collect_set("team_id")).alias("teams"))


def vertices_player(details: DataFrame) -> DataFrame:
    return player_totals(details).select(
        F.col("player_id").alias("identifier"), F.lit("player").alias("type"),
        json_props(F.col("player_name"), F.col("number_of_games"), F.col("total_points"),
                   F.col("teams")).alias("properties"))


def vertices_team(teams: DataFrame) -> DataFrame:
    one = first_per_key(teams, ["team_id"], ["team_row"])
    return one.select(
        F.col("team_id").cast("bigint").alias("identifier"), F.lit("team").alias("type"),
        json_props(F.col("abbreviation"), F.col("nickname"), F.col("yearfounded").alias("year_founded"),
                   F.col("city"), F.col("arena")).alias("properties"))


def vertices(games: DataFrame, details: DataFrame, teams: DataFrame) -> DataFrame:
    return (vertices_game(games).unionByName(vertices_player(details))
            .unionByName(vertices_team(teams)))


def vertex_counts(v: DataFrame) -> DataFrame:
    return v.groupBy("type").agg(F.count(F.lit(1)).alias("num_vertices"))


def participations(details: DataFrame, cols: list[str] | None = None, picked: bool = False) -> DataFrame:
    """One row per (player, game), keeping ``cols`` (all columns if None).
    Only the needed columns enter the pick.  ``picked``: the rows are that
    already (the pick of the raw lines is narrower still)."""
    keys = ["player_id", "game_id"]
    if picked:
        return details if cols is None else details.select(*keys, *[c for c in cols if c not in keys])
    if cols is not None:
        keep = keys + [c for c in cols if c not in keys] + [c for c in PICK_ORDER if c not in cols]
        details = details.select(*keep)
    return first_per_key(details, keys, PICK_ORDER)


def edges_plays_in(details: DataFrame, picked: bool = False) -> DataFrame:
    p = participations(details, ["start_position", "pts", "team_id", "team_abbreviation"], picked)
    return p.select(
        F.col("player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("game_id").alias("object_identifier"), F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        json_props(F.col("start_position"), F.col("pts"), F.col("team_id"),
                   F.col("team_abbreviation")).alias("properties"))


def game_sizes(details: DataFrame) -> DataFrame:
    """game_id and its rows, where they are more than a block."""
    return details.groupBy("game_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PAIR_BLOCK)


def paired_rows(details: DataFrame, sizes: DataFrame | None = None, picked: bool = False) -> DataFrame:
    """Per game, each unordered pair of distinct players once: game_id and the
    two participation rows as structs, ``subject`` the one with the larger id.

    ``sizes`` (game_id, n) names the games of more than a block, ``n`` being at
    least their number of players; without it the rows of ``details`` are
    counted.  A row goes once to each cell of its block; a cell is collected as
    one list, of two blocks at most, and paired inside."""
    cols = ["player_id", "player_name", "team_abbreviation", "pts"]
    p = participations(details, ["game_id", *cols], picked).select("game_id", F.struct(*cols).alias("row"))
    large = (game_sizes(details) if sizes is None else sizes).select("game_id", F.ceil(F.col("n") / PAIR_BLOCK).alias("blocks"))
    dealt = p.join(large, "game_id", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("bigint")))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("row.player_id"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    placed = dealt.select("game_id", "own", "row", other).select(
        "game_id", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.struct("own", "row").alias("member"))
    # A fixed number of tasks: the cells' rows are few, their pairs are not.
    tasks = int(details.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = ["game_id", "i", "j"]
    squads = placed.repartition(tasks, *cell).groupBy(*cell).agg(F.collect_list("member").alias("squad"))
    one = squads.select("game_id", (F.col("i") == F.col("j")).alias("alone"), "squad", F.explode("squad").alias("one"))
    partners = F.filter("squad", lambda two: (
        (two["row"]["player_id"] < F.col("one.row.player_id")) & (two["row"]["player_name"] != F.col("one.row.player_name"))
        & (F.col("alone") | (two["own"] != F.col("one.own")))))
    return one.select("game_id", F.col("one.row").alias("subject"), F.explode(partners).alias("two")).select(
        "game_id", "subject", F.col("two.row").alias("object"))


def pair_type() -> Column:
    return (F.when(F.col("subject.team_abbreviation") == F.col("object.team_abbreviation"), "shares_team")
            .otherwise("plays_against"))


def player_pairs(details: DataFrame, sizes: DataFrame | None = None, picked: bool = False) -> DataFrame:
    """Per game, each pair of players once, with the edge type (same team or
    not) and both players' points."""
    return paired_rows(details, sizes, picked).select(
        "game_id",
        F.col("subject.player_id").alias("subject_player_id"), F.col("object.player_id").alias("object_player_id"),
        pair_type().alias("edge_type"),
        F.col("subject.player_name").alias("subject_player_name"), F.col("object.player_name").alias("object_player_name"),
        F.col("subject.pts").alias("subject_pts"), F.col("object.pts").alias("object_pts"))


def pair_totals(details: DataFrame, sizes: DataFrame | None = None, picked: bool = False) -> DataFrame:
    """Per pair and edge type: games and points, as typed columns."""
    return player_pairs(details, sizes, picked).groupBy("subject_player_id", "object_player_id", "edge_type").agg(
        F.count(F.lit(1)).alias("num_games"),
        F.sum("subject_pts").alias("subject_points"),
        F.sum("object_pts").alias("object_points"))


def edges_player_pairs(details: DataFrame, sizes: DataFrame | None = None, picked: bool = False) -> DataFrame:
    return pair_totals(details, sizes, picked).select(
        F.col("subject_player_id").alias("subject_identifier"), F.lit("player").alias("subject_type"),
        F.col("object_player_id").alias("object_identifier"), F.lit("player").alias("object_type"),
        "edge_type",
        json_props(F.col("num_games"), F.col("subject_points"), F.col("object_points")).alias("properties"))


def graph_join_view(v: DataFrame, e: DataFrame) -> DataFrame:
    """Vertices joined to their outgoing edges on (identifier, type)."""
    return v.join(e, (v.identifier == e.subject_identifier) & (v.type == e.subject_type)).select(
        v.identifier, v.type, v.properties.alias("vertex_properties"),
        e.object_identifier, e.object_type, e.edge_type, e.properties.alias("edge_properties"))


def graph_max_points(v: DataFrame, e: DataFrame) -> DataFrame:
    """Highest points in one game per player name (pair edges carry no
    'pts' and drop out of the MAX)."""
    j = graph_join_view(v, e)
    return (j.groupBy(F.get_json_object("vertex_properties", "$.player_name").alias("player_name"))
            .agg(F.max(F.get_json_object("edge_properties", "$.pts").cast("int")).alias("max_pts")))


def graph_pair_averages(players: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per pair edge: both players' points (as text, like the reference) and
    points per game, from ``player_totals`` and ``pair_totals``: columns stay
    typed until this projection.  Sort by ``CAST(num_games AS INT)`` when
    ordering: the text column sorts '9' before '10'."""
    j = pairs.join(players.select(F.col("player_id").alias("subject_player_id"), "player_name"), "subject_player_id")
    games = F.col("num_games").cast("double")
    return j.select(
        F.col("player_name").alias("player_1"),
        F.col("subject_points").cast("string").alias("player1_pts"),
        F.col("object_player_id").alias("player_2"),
        F.col("object_points").cast("string").alias("player2_pts"),
        F.col("num_games").cast("string").alias("num_games"),
        (F.col("subject_points").cast("double") / games).alias("player1_games_avg"),
        (F.col("object_points").cast("double") / games).alias("player2_games_avg"),
    ).distinct()
