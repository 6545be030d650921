"""DuckDB text of the fixture views, for the oracle statements.

Written separately from the Spark builders in ``dimweave.sources.fixtures``
so a mistake on either side shows up as an oracle mismatch.
"""

from __future__ import annotations

import re

FIXTURE_SQL: dict[str, str] = {
    "fx_player_seasons": """
        SELECT CAST(p.o_custkey AS VARCHAR) AS player_name,
               '6-' || CAST(c.c_nationkey % 12 AS VARCHAR) AS height,
               c.c_mktsegment AS college,
               n.n_name AS country,
               CAST(1990 + c.c_nationkey % 5 AS VARCHAR) AS draft_year,
               CAST(1 + c.c_custkey % 2 AS VARCHAR) AS draft_round,
               CAST(1 + c.c_custkey % 60 AS VARCHAR) AS draft_number,
               CAST(p.season AS INTEGER) AS season,
               CAST(p.cents AS DOUBLE) / 2500000.0 AS pts,
               CAST(p.n_orders AS DOUBLE) AS ast,
               CAST(p.n_priorities AS DOUBLE) AS reb,
               CAST(c.c_nationkey AS INTEGER) AS weight
        FROM (SELECT o_custkey, year(o_orderdate) AS season,
                     SUM(CAST(FLOOR(o_totalprice * 100) AS BIGINT)) AS cents,
                     COUNT(*) AS n_orders,
                     COUNT(DISTINCT o_orderpriority) AS n_priorities
              FROM orders GROUP BY o_custkey, year(o_orderdate)) p
        JOIN customer c ON p.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "fx_game_details": """
        SELECT l.l_orderkey AS game_id,
               CAST(s.s_nationkey AS INTEGER) AS team_id,
               n.n_name AS team_abbreviation,
               l.l_suppkey AS player_id,
               s.s_name AS player_name,
               l.l_returnflag AS start_position,
               p.p_name AS comment,
               CAST(l.l_linenumber AS VARCHAR) || ':' || lpad(CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR), 2, '0') AS "min",
               CAST(l.l_quantity AS INTEGER) % 7 AS fgm,
               CAST(l.l_quantity AS INTEGER) % 11 AS fga,
               CAST(l.l_quantity AS INTEGER) % 3 AS fg3m,
               CAST(l.l_quantity AS INTEGER) % 5 AS fg3a,
               CAST(l.l_quantity AS INTEGER) % 4 AS ftm,
               CAST(l.l_quantity AS INTEGER) % 6 AS fta,
               l.l_linenumber % 3 AS oreb,
               l.l_linenumber % 4 AS dreb,
               l.l_linenumber % 3 + l.l_linenumber % 4 AS reb,
               CAST(l.l_quantity AS INTEGER) % 9 AS ast,
               CAST(l.l_quantity AS INTEGER) % 2 AS stl,
               l.l_linenumber % 2 AS blk,
               CAST(l.l_quantity AS INTEGER) % 8 AS "TO",
               l.l_linenumber AS pf,
               CAST(l.l_quantity AS INTEGER) AS pts,
               CAST(l.l_quantity AS INTEGER) - 25 AS plus_minus,
               l.l_linenumber AS line_no,
               l.l_partkey AS part_id,
               l.l_extendedprice AS price,
               l.l_shipdate AS ship_ts
        FROM lineitem l
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN part p ON l.l_partkey = p.p_partkey""",
    "fx_games": """
        SELECT o.o_orderkey AS game_id,
               CAST(o.o_orderdate AS DATE) AS game_date_est,
               CAST(year(o.o_orderdate) AS INTEGER) AS season,
               CAST(c.c_nationkey AS INTEGER) AS home_team_id,
               CAST(o.o_custkey % 25 AS INTEGER) AS visitor_team_id,
               CAST(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS home_team_wins,
               CAST(FLOOR(o.o_totalprice / 1000) AS INTEGER) AS pts_home,
               CAST(FLOOR(o.o_totalprice / 1500) AS INTEGER) AS pts_away
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "fx_teams": """
        SELECT CAST(n.n_nationkey AS INTEGER) AS team_id,
               n.n_name AS abbreviation,
               lower(n.n_name) AS nickname,
               CAST(1946 + n.n_regionkey AS INTEGER) AS yearfounded,
               'city_' || CAST(n.n_regionkey AS VARCHAR) AS city,
               s.s_name AS arena,
               s.s_suppkey AS team_row
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "fx_events": """
        SELECT event_id,
               CAST(CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS BIGINT) AS user_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS device_id,
               CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS referrer,
               event_type AS host,
               '/' || event_type AS url,
               ts AS event_time
        FROM events""",
    "fx_devices": """
        SELECT device_id,
               'b' || CAST(device_id % 3 AS VARCHAR) AS browser_type,
               'o' || CAST(device_id % 4 AS VARCHAR) AS os_type,
               'd' || CAST(device_id % 5 AS VARCHAR) AS device_type
        FROM (SELECT DISTINCT device_id FROM fx_events WHERE device_id % 10 <> 0) k""",
    "fx_activity": """
        SELECT DISTINCT user_id, CAST(event_time AS DATE) AS day FROM fx_events""",
    "fx_matches": """
        SELECT CAST(o_orderkey AS VARCHAR) AS match_id,
               o_orderstatus = 'F' AS is_team_game,
               o_orderpriority AS playlist_id,
               o_orderdate AS completion_date
        FROM orders""",
    "fx_match_details": """
        SELECT CAST(l_orderkey AS VARCHAR) AS match_id,
               CAST(l_suppkey AS VARCHAR) AS player_gamertag,
               CAST(l_quantity AS INTEGER) AS player_total_kills,
               l_linenumber AS player_total_deaths
        FROM lineitem""",
    "fx_taxis": """
        SELECT l_linenumber AS "VendorID",
               l_shipdate AS tpep_pickup_datetime,
               l_shipdate + to_hours(l_linenumber) AS tpep_dropoff_datetime,
               l_quantity - 1 AS trip_distance,
               l_extendedprice / 1000 AS fare_amount,
               l_extendedprice * l_discount / 1000 AS tip_amount,
               l_extendedprice * (0.05 - l_discount) AS total_amount
        FROM lineitem""",
    "fx_permits": """
        SELECT event_id AS permit_id, event_type AS borough FROM events""",
}

# Views that other fixture views read.
_DEPENDS = {"fx_devices": ["fx_events"], "fx_activity": ["fx_events"]}
_NAME = re.compile(r"\bfx_[a-z_]+\b")


def with_fixtures(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every fixture view it mentions.

    ``sql`` may itself start with ``WITH``; its CTEs are appended after the
    fixture CTEs.
    """
    needed: list[str] = []

    def add(name: str) -> None:
        for dep in _DEPENDS.get(name, []):
            add(dep)
        if name not in needed:
            needed.append(name)

    for name in _NAME.findall(sql):
        if name in FIXTURE_SQL:
            add(name)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in needed)
    body = sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
