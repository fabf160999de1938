"""SQL text of the stand-in inputs, for the DuckDB oracle (same rows as ``fulltime.sources.testdata``).

``with_fixtures(["fx_event", "fx_match"], body)`` prefixes ``body`` with the needed CTEs
(dependencies are added automatically). ``body`` may itself start with further CTEs
written as ``name AS (...), ... SELECT``; pass those through ``ctes=``.
"""

from __future__ import annotations

from fulltime.sources.event_columns import EXTRA, RARE_TYPE_SQL

FX = {}
DEPS = {
    "fx_event": [], "fx_match": ["fx_event"], "fx_frame": ["fx_event"], "fx_result": [], "fx_rating": [],
    "fx_form": [], "fx_market": [], "fx_odds": [], "fx_weather": [],
}

FX["fx_event"] = """
WITH b AS (
  SELECT event_id, user_id, value,
         CAST(floor(event_id / 100) AS BIGINT) AS match_id,
         event_id % 100 AS event_index,
         (event_id * 7 + user_id * 3) % 20 AS tk,
         (event_id + user_id) % 5 AS ok
  FROM events
), t AS (
  SELECT *, match_id % 32 AS home_team_id,
         (match_id % 32 + 1 + (match_id * 7 + CAST(floor(match_id / 32) AS BIGINT)) % 31) % 32 AS away_team_id
  FROM b
), p AS (
  SELECT *, CASE WHEN (event_id * 13 + user_id) % 2 = 0 THEN home_team_id ELSE away_team_id END AS team_id,
         CASE WHEN tk < 8 THEN 'Pass' WHEN tk < 12 THEN 'Carry' WHEN tk < 14 THEN 'Pressure'
              WHEN tk = 14 THEN 'Duel' WHEN tk = 15 THEN 'Interception' WHEN tk = 16 THEN 'Clearance'
              WHEN tk < 19 THEN 'Shot' ELSE """ + RARE_TYPE_SQL + """ END AS type_name
  FROM t
), e AS (
SELECT event_id, match_id, event_index,
       CASE WHEN event_index < 50 THEN 1 ELSE 2 END AS period,
       CAST(floor(event_index * 9 / 10) AS BIGINT) AS minute,
       (event_id * 37) % 60 AS second,
       type_name, team_id, concat('Team ', CAST(team_id AS STRING)) AS team_name,
       team_id * 1000 + user_id % 11 AS player_id,
       concat('Player ', CAST(team_id * 1000 + user_id % 11 AS STRING)) AS player_name,
       CASE WHEN (event_id * 17) % 50 = 0 THEN NULL ELSE ((event_id * 7919 + user_id * 104729) % 1201) / 10.0e0 END AS loc_x,
       CASE WHEN (event_id * 17) % 50 = 0 THEN NULL ELSE ((event_id * 6101 + user_id * 7907) % 801) / 10.0e0 END AS loc_y,
       ((event_id * 3571 + user_id * 2711) % 1201) / 10.0e0 AS end_x,
       ((event_id * 1543 + user_id * 3307) % 801) / 10.0e0 AS end_y,
       (event_id % 3) = 0 AS under_pressure,
       (event_id % 4) = 0 AS counterpress,
       CASE WHEN type_name = 'Shot' THEN ((event_id * 53 + user_id) % 100) / 100.0e0 END AS shot_xg,
       CASE WHEN type_name = 'Shot' THEN CASE ok WHEN 0 THEN 'Goal' WHEN 1 THEN 'Saved' WHEN 2 THEN 'Blocked' ELSE 'Off T' END END AS shot_outcome,
       CASE WHEN type_name = 'Shot' THEN CASE WHEN event_id % 11 = 0 THEN 'Penalty' ELSE 'Open Play' END END AS shot_type,
       CASE WHEN type_name = 'Shot' THEN CASE event_id % 3 WHEN 0 THEN 'Head' WHEN 1 THEN 'Left Foot' ELSE 'Right Foot' END END AS shot_body_part,
       CASE WHEN type_name = 'Pass' AND ok IN (3, 4) THEN 'Incomplete' END AS pass_outcome,
       CASE WHEN type_name = 'Pass' THEN CASE event_id % 13 WHEN 0 THEN 'Corner' WHEN 1 THEN 'Free Kick' END END AS pass_type,
       type_name = 'Pass' AND event_id % 9 = 0 AS pass_shot_assist,
       type_name = 'Pass' AND event_id % 27 = 0 AS pass_goal_assist,
       type_name = 'Pass' AND event_id % 7 = 0 AS pass_cross,
       CASE WHEN type_name = 'Duel' THEN CASE ok WHEN 0 THEN 'Won' WHEN 1 THEN 'Success' ELSE 'Lost' END END AS duel_outcome,
       CASE WHEN type_name = 'Duel' THEN CASE event_id % 2 WHEN 0 THEN 'Tackle' ELSE 'Aerial Lost' END END AS duel_type,
       value AS duration
FROM p)
SELECT *,
       CASE WHEN type_name = 'Pass' THEN end_x END AS pass_end_x,
       CASE WHEN type_name = 'Pass' THEN end_y END AS pass_end_y,
       CASE WHEN type_name = 'Carry' THEN end_x END AS carry_end_x,
       CASE WHEN type_name = 'Carry' THEN end_y END AS carry_end_y,
       CASE WHEN type_name = 'Pass' THEN sqrt((end_x - loc_x) * (end_x - loc_x) + (end_y - loc_y) * (end_y - loc_y)) END AS pass_length,
       """ + ", ".join(f"{c.sql} AS {c.name}" for c in EXTRA) + """
FROM e
"""

FX["fx_match"] = """
WITH m AS (SELECT DISTINCT CAST(floor(event_id / 100) AS BIGINT) AS match_id FROM events),
t AS (SELECT match_id, match_id % 32 AS home_team_id,
             (match_id % 32 + 1 + (match_id * 7 + CAST(floor(match_id / 32) AS BIGINT)) % 31) % 32 AS away_team_id
      FROM m),
g AS (SELECT match_id, team_id, count(*) AS goals FROM fx_event
      WHERE type_name = 'Shot' AND shot_outcome = 'Goal' GROUP BY match_id, team_id)
SELECT t.match_id, DATE '2022-01-01' + CAST(t.match_id AS INT) AS match_date,
       CASE t.match_id % 3 WHEN 0 THEN 43 WHEN 1 THEN 55 ELSE 223 END AS competition_id,
       CASE CAST(floor(t.match_id / 3) AS BIGINT) % 2 WHEN 0 THEN 106 ELSE 3 END AS season_id,
       CASE CAST(floor(t.match_id / 6) AS BIGINT) % 7
         WHEN 0 THEN 'Group Stage' WHEN 1 THEN 'Round of 32' WHEN 2 THEN 'Round of 16'
         WHEN 3 THEN 'Quarter-finals' WHEN 4 THEN 'Semi-finals' WHEN 5 THEN '3rd Place Final' ELSE 'Final' END AS stage_name,
       t.home_team_id, concat('Team ', CAST(t.home_team_id AS STRING)) AS home_team_name,
       t.away_team_id, concat('Team ', CAST(t.away_team_id AS STRING)) AS away_team_name,
       coalesce(h.goals, 0) AS home_score, coalesce(a.goals, 0) AS away_score
FROM t LEFT JOIN g h ON h.match_id = t.match_id AND h.team_id = t.home_team_id
       LEFT JOIN g a ON a.match_id = t.match_id AND a.team_id = t.away_team_id
"""

FX["fx_frame"] = """
WITH n(i) AS (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10))
SELECT e.event_id, e.match_id,
       ((e.event_id * 977 + n.i * 1709) % 1201) / 10.0e0 AS loc_x,
       ((e.event_id * 613 + n.i * 911) % 801) / 10.0e0 AS loc_y,
       n.i <= 4 AS is_teammate, n.i = 0 AS is_actor, n.i IN (1, 10) AS is_keeper
FROM fx_event e CROSS JOIN n
WHERE e.type_name = 'Shot' AND e.match_id % 3 <> 2
"""

FX["fx_result"] = """
SELECT CAST(floor(o_orderkey / 64) AS BIGINT) AS pool_id, o_orderkey AS match_num,
       CAST(o_orderdate AS DATE) AS match_date,
       concat('T', CAST(o_custkey % 16 AS STRING)) AS home_team,
       concat('T', CAST((o_custkey % 16 + 1 + CAST(floor(o_custkey / 16) AS BIGINT) % 15) % 16 AS STRING)) AS away_team,
       CASE WHEN o_orderkey % 41 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 5 END AS home_score,
       CASE WHEN o_orderkey % 41 <> 0 THEN CAST(floor(o_totalprice / 7) AS BIGINT) % 4 END AS away_score,
       CASE WHEN o_orderkey % 64 < 48 THEN 'Group A' WHEN o_orderkey % 64 < 56 THEN 'Round of 16'
            WHEN o_orderkey % 64 < 60 THEN 'Quarter-finals' WHEN o_orderkey % 64 < 62 THEN 'Semi-finals'
            WHEN o_orderkey % 64 = 62 THEN 'Match for third place' ELSE 'Final' END AS round
FROM orders
"""

FX["fx_rating"] = """
SELECT c_custkey AS player_id, c_nationkey AS team_id,
       55 + (c_custkey * 7) % 40 AS overall, 55 + (c_custkey * 7) % 40 + c_custkey % 6 AS potential,
       17 + (c_custkey * 5) % 23 AS age,
       CASE c_custkey % 9 WHEN 0 THEN 'GK' WHEN 1 THEN 'CB' WHEN 2 THEN 'LB' WHEN 3 THEN 'CDM' WHEN 4 THEN 'CAM'
            WHEN 5 THEN 'RW' WHEN 6 THEN 'ST' WHEN 7 THEN 'FW' ELSE 'RWB' END AS position
FROM customer
"""

FX["fx_form"] = """
WITH g AS (
  SELECT c.c_nationkey AS team_id, o.o_orderkey AS match_num, CAST(o.o_orderdate AS DATE) AS match_date,
         CAST(floor(o.o_totalprice) AS BIGINT) % 5 AS goals_for,
         CAST(floor(o.o_totalprice / 7) AS BIGINT) % 4 AS goals_against,
         (CAST(floor(o.o_totalprice) AS BIGINT) % 400) / 100.0e0 AS xg_for,
         (CAST(floor(o.o_totalprice / 3) AS BIGINT) % 300) / 100.0e0 AS xg_against
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)
SELECT *, CASE WHEN goals_for > goals_against THEN 'W' WHEN goals_for = goals_against THEN 'D' ELSE 'L' END AS result
FROM g
"""

FX["fx_market"] = """
WITH v AS (SELECT s_nationkey AS team_id, CAST(floor(s_acctbal) AS BIGINT) + 1001 AS value_m,
                  row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rn FROM supplier)
SELECT team_id, CAST(sum(value_m) AS BIGINT) AS total_squad_value_m,
       CAST(sum(CASE WHEN rn <= 3 THEN value_m ELSE 0 END) AS BIGINT) AS top3_value_m,
       count(*) AS n_players, CAST(sum(CASE WHEN value_m > 5000 THEN 1 ELSE 0 END) AS BIGINT) AS n_players_over_50m
FROM v GROUP BY team_id
"""

FX["fx_odds"] = """
SELECT event_id AS snapshot_id, CAST(floor(event_id / 100) AS BIGINT) AS match_id, event_id % 100 AS minute, ts AS ingested_at,
       1.2e0 + ((event_id * 31 + user_id) % 400) / 100.0e0 AS odd_home,
       2.5e0 + ((event_id * 17 + user_id) % 200) / 100.0e0 AS odd_draw,
       1.2e0 + ((event_id * 43 + user_id) % 500) / 100.0e0 AS odd_away,
       (event_id * 3) % 4 AS goals_so_far
FROM events
"""

FX["fx_weather"] = """
SELECT event_id AS weather_id, user_id % 15 AS venue_id, ts AS collected_at,
       value AS wind_speed_kmh, ((event_id * 45) % 1441) / 4.0e0 AS wind_direction_deg,
       CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 45 WHEN 3 THEN 61 WHEN 4 THEN 95 ELSE 12 END AS weather_code
FROM events
"""


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def add(n: str) -> None:
        for d in DEPS[n]:
            add(d)
        if n not in out:
            out.append(n)

    for n in names:
        add(n)
    return out


def expand_sround(sql: str) -> str:
    """Rewrite ``sround(expr, d)`` into the rounding the Spark side uses (``fulltime.functions.common.rnd``):
    round to 9 places to drop floating noise, then half-up (away from zero) on the decimal value."""
    key = "sround("
    while True:
        i = sql.find(key)
        if i < 0:
            return sql
        j, depth, comma = i + len(key), 1, -1
        while depth:
            ch = sql[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = j
            j += 1
        expr, digits = sql[i + len(key):comma], sql[comma + 1:j - 1].strip()
        repl = f"CAST(round(CAST(round({expr}, 9) AS DECIMAL(38, 9)), {digits}) AS DOUBLE)"
        sql = sql[:i] + repl + sql[j:]


def with_fixtures(names: list[str], body: str, ctes: str = "", recursive: bool = False) -> str:
    """``WITH <fixture CTEs>[, <ctes>] <body>``."""
    parts = [f"{n} AS ({FX[n].strip()})" for n in _closure(names)]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    head = "WITH RECURSIVE " if recursive or "RECURSIVE_CTE" in ctes else "WITH "
    return expand_sround(head + ",\n".join(parts) + "\n" + body.strip())
