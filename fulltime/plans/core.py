"""Core keys: timeline, player and team measures, serving tables (scorers, style, standings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fulltime.functions import football as fb
from fulltime.operators import gold, players, teams, timeline
from fulltime.plans.fixture_sql import with_fixtures
from fulltime.plans.registry import query
from fulltime.plans.sql_blocks import PLAYER_STATS, TEAM_PERF, TIMELINE
from fulltime.sources import testdata as td

EM = ["fx_event", "fx_match"]


@td.memo_plan("timeline")
def tl_frame(spark, sf):
    return timeline.match_timeline(td.fx_event(spark, sf), td.fx_match(spark, sf))


@td.memo_plan("timeline_base")
def tl_base(spark, sf):
    """The timeline without the running score (player and team measures do not read it)."""
    return timeline.match_timeline(td.fx_event(spark, sf), td.fx_match(spark, sf), with_score=False)


@td.memo_plan("player_match_stats")
def pms_frame(spark, sf):
    return players.player_match_stats(tl_base(spark, sf))


@td.memo_plan("team_performance")
def tp_frame(spark, sf):
    return teams.team_performance(tl_base(spark, sf), td.fx_match(spark, sf))


# ---------------------------------------------------------------- timeline (PRJ-01..03, JN-01, WIN-01)

@query("timeline_filter", with_fixtures(EM, """
SELECT type_name, count(*) AS n_events, count(DISTINCT match_id) AS n_matches FROM tl0 GROUP BY type_name""",
                                        TIMELINE))
def q_timeline_filter(spark, sf):
    return (timeline.keep_types(td.fx_event(spark, sf)).groupBy("type_name")
            .agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("match_id").alias("n_matches")))


@query("events_with_match", with_fixtures(EM, """
SELECT e.event_id, e.match_id, e.team_id, m.home_team_id, m.away_team_id, m.stage_name, m.match_date,
       m.home_score AS match_home_score_ft, m.away_score AS match_away_score_ft
FROM fx_event e LEFT JOIN fx_match m ON e.match_id = m.match_id"""))
def q_events_with_match(spark, sf):
    j = timeline.attach_match(td.fx_event(spark, sf), td.fx_match(spark, sf))
    return j.select("event_id", "match_id", "team_id", "home_team_id", "away_team_id", "stage_name", "match_date",
                    "match_home_score_ft", "match_away_score_ft")


@query("match_timeline", with_fixtures(EM, "SELECT * FROM tl", TIMELINE))
def q_match_timeline(spark, sf):
    return tl_frame(spark, sf)


_NAMES = {
    "competition_name": "concat('Competition ', CAST(competition_id AS STRING))", "season_name": "concat('Season ', CAST(season_id AS STRING))",
    "competition_label": "concat(CAST(competition_id AS STRING), '_', CAST(season_id AS STRING))",
    "stadium_name": "CASE WHEN match_id % 10 <> 3 THEN concat('Stadium ', CAST(match_id % 12 AS STRING)) END",
}
_GAPS = {"event_index": "CASE WHEN event_id % 61 <> 0 THEN event_index END", "match_id": "CASE WHEN event_id % 97 <> 0 THEN match_id END"}


def _gaps_sql() -> str:
    score = ", ".join(f"""CAST(sum(CASE WHEN type_name = 'Shot' AND shot_outcome = 'Goal' AND {own} THEN 1 ELSE 0 END)
           OVER (PARTITION BY match_id ORDER BY event_index NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS score_{side}_at_event"""
                      for side, own in (("home", "is_home_team"), ("away", "NOT is_home_team")))
    types = ", ".join(f"'{t}'" for t in fb.TIMELINE_TYPES)
    return f"""
SELECT event_id, match_id, event_index, match_date, {', '.join(_NAMES)}, is_home_team, {score} FROM (
  SELECT e.event_id, e.match_id, e.event_index, e.type_name, e.shot_outcome, m.match_date, {', '.join(f'm.{c}' for c in _NAMES)},
         coalesce(e.team_id = m.home_team_id, false) AS is_home_team
  FROM (SELECT * REPLACE ({', '.join(f'{x} AS {c}' for c, x in _GAPS.items())}) FROM fx_event) e
  LEFT JOIN (SELECT *, {', '.join(f'{x} AS {c}' for c, x in _NAMES.items())} FROM fx_match) m ON e.match_id = m.match_id
  WHERE e.type_name IN ({types}))"""


@query("timeline_gaps", with_fixtures(EM, _gaps_sql()))
def q_timeline_gaps(spark, sf):
    """The timeline of events of which some have no index and some no match, with the names of competition, season
    and stadium: every event stays, with its match's attributes and the score at it."""
    e = td.fx_event(spark, sf)
    gaps = e.selectExpr(*[f"{_GAPS[c]} AS {c}" if c in _GAPS else f"`{c}`" for c in e.columns])
    tl = timeline.match_timeline(gaps, td.fx_match(spark, sf).selectExpr("*", *[f"{x} AS {c}" for c, x in _NAMES.items()]))
    return tl.select("event_id", "match_id", "event_index", "match_date", *_NAMES, "is_home_team", "score_home_at_event", "score_away_at_event")


@query("running_score", with_fixtures(EM, """
SELECT match_id, event_index, score_home_at_event, score_away_at_event, score_diff_at_event FROM tl""", TIMELINE))
def q_running_score(spark, sf):
    return tl_frame(spark, sf).select("match_id", "event_index", "score_home_at_event", "score_away_at_event",
                                      "score_diff_at_event")


@query("running_score_before", with_fixtures(EM, """
SELECT match_id, event_index,
  CAST(coalesce(sum(CASE WHEN type_name = 'Shot' AND shot_outcome = 'Goal' AND team_id = home_team_id THEN 1 ELSE 0 END)
       OVER (PARTITION BY match_id ORDER BY event_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS score_home_at_event,
  CAST(coalesce(sum(CASE WHEN type_name = 'Shot' AND shot_outcome = 'Goal' AND NOT coalesce(team_id = home_team_id, false) THEN 1 ELSE 0 END)
       OVER (PARTITION BY match_id ORDER BY event_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS score_away_at_event
FROM tl0""", TIMELINE))
def q_running_score_before(spark, sf):
    tl = timeline.match_timeline(td.fx_event(spark, sf), td.fx_match(spark, sf), inclusive=False)
    return tl.select("match_id", "event_index", "score_home_at_event", "score_away_at_event")


@query("shots_only", with_fixtures(EM, """
SELECT event_id, match_id, player_id, team_id, shot_xg, shot_outcome, distance_to_goal, angle_to_goal, pitch_zone,
       score_diff_at_event FROM tl WHERE type_name = 'Shot' AND shot_xg IS NOT NULL""", TIMELINE))
def q_shots_only(spark, sf):
    s = timeline.shots(tl_frame(spark, sf))
    return s.select("event_id", "match_id", "player_id", "team_id", "shot_xg", "shot_outcome",
                    "distance_to_goal", "angle_to_goal", "pitch_zone", "score_diff_at_event")


# ---------------------------------------------------------------- players (AGG-01..07, JN-03/04)

@query("player_match_stats", with_fixtures(EM, "SELECT * FROM pms", TIMELINE + "," + PLAYER_STATS))
def q_player_match_stats(spark, sf):
    return pms_frame(spark, sf)


# ---------------------------------------------------------------- teams (AGG-08..14, JN-07..10)

@query("team_performance", with_fixtures(EM, "SELECT * FROM tp", TIMELINE + "," + TEAM_PERF))
def q_team_performance(spark, sf):
    return tp_frame(spark, sf)


# ---------------------------------------------------------------- gold (AGG-25..30, WIN-04, WIN-06, JN-15)

TOP_SCORERS_SQL = """
SELECT *,
  CASE WHEN minutes_approx > 0 THEN sround(goals / minutes_approx * 90, 3) END AS goals_per_90,
  CASE WHEN minutes_approx > 0 THEN sround(xg_total / minutes_approx * 90, 3) END AS xg_per_90,
  CASE WHEN shots_total > 0 THEN sround(goals / shots_total * 100, 1) END AS shot_conversion_pct,
  CASE WHEN shots_total > 0 THEN sround(shots_on_target / shots_total * 100, 1) END AS shots_on_target_pct,
  rank() OVER (PARTITION BY competition_id, season_id ORDER BY goals DESC, xg_total DESC) AS rank_in_competition
FROM (
  SELECT player_id, player_name, team_name, competition_id, season_id,
    CAST(sum(goals) AS BIGINT) AS goals, sround(sum(xg_total), 3) AS xg_total,
    sround(sum(goals) - sum(xg_total), 3) AS goals_minus_xg,
    CAST(sum(assists) AS BIGINT) AS assists, sum(xa_total) AS xa_total, CAST(sum(key_passes) AS BIGINT) AS key_passes,
    CAST(sum(shots_total) AS BIGINT) AS shots_total, CAST(sum(shots_on_target) AS BIGINT) AS shots_on_target,
    CAST(sum(headed_shots) AS BIGINT) AS headed_shots, CAST(sum(penalties_scored) AS BIGINT) AS penalties_scored,
    CAST(sum(penalties_taken) AS BIGINT) AS penalties_taken, CAST(sum(last_minute_seen) AS BIGINT) AS minutes_approx,
    count(DISTINCT match_id) AS matches_played
  FROM pms GROUP BY player_id, player_name, team_name, competition_id, season_id)"""


@query("top_scorers", with_fixtures(EM, TOP_SCORERS_SQL, TIMELINE + "," + PLAYER_STATS))
def q_top_scorers(spark, sf):
    return gold.top_scorers(pms_frame(spark, sf))


@query("top_scorers_cross", with_fixtures(EM, """
SELECT *, goals_total + assists_total AS goal_contributions,
  sround(goals_total / total_matches, 3) AS goals_per_match, sround(xg_total / total_matches, 3) AS xg_per_match
FROM (
  SELECT player_id, player_name, team_name,
    CAST(sum(goals) AS BIGINT) AS goals_total, sround(sum(xg_total), 3) AS xg_total,
    CAST(sum(assists) AS BIGINT) AS assists_total, count(DISTINCT match_id) AS total_matches,
    count(DISTINCT competition_id) AS competitions_played,
    count(DISTINCT (competition_id, season_id)) AS editions_played,
    list_sort(list(DISTINCT CAST(competition_id AS VARCHAR) || '/' || CAST(season_id AS VARCHAR))) AS competitions
  FROM pms GROUP BY player_id, player_name, team_name)""", TIMELINE + "," + PLAYER_STATS))
def q_top_scorers_cross(spark, sf):
    return gold.top_scorers_cross(pms_frame(spark, sf))


TEAM_STYLE_SQL = """
SELECT *,
  CASE WHEN avg_ppda < 8 AND avg_possession_pct > 50 THEN 'PRESSING_ALTO'
       WHEN avg_possession_pct >= 58 AND progressive_passes_per_game >= 20 THEN 'POSSE_DOMINANTE'
       WHEN avg_possession_pct < 45 AND xg_per_game >= 1.2 THEN 'CONTRA_ATAQUE'
       WHEN avg_ppda > 14 AND avg_defensive_line_x IS NOT NULL AND avg_defensive_line_x < 45 THEN 'BLOCO_BAIXO'
       ELSE 'EQUILIBRADO' END AS tactical_profile,
  sround(xg_diff_per_game * 0.4 + (avg_possession_pct - 50) * 0.02
        + CASE WHEN avg_ppda IS NOT NULL THEN (20 - avg_ppda) * 0.03 ELSE 0 END, 3) AS dominance_score
FROM (
  SELECT *, sround(xg_diff_total / matches_played, 3) AS xg_diff_per_game, wins * 3 + draws AS points,
         sround(wins / matches_played * 100, 1) AS win_pct
  FROM (
    SELECT team_id, team_name, competition_id, season_id, count(*) AS matches_played,
      count(*) FILTER (WHERE result = 'W') AS wins, count(*) FILTER (WHERE result = 'D') AS draws,
      count(*) FILTER (WHERE result = 'L') AS losses,
      sround(avg(xg), 3) AS xg_per_game, sround(sum(xg), 3) AS xg_total,
      sround(avg(shots_total), 2) AS shots_per_game, sround(avg(shots_on_target), 2) AS shots_on_target_per_game,
      sround(avg(goals_scored), 2) AS goals_per_game, sround(avg(avg_shot_distance), 2) AS avg_shot_distance,
      sround(avg(xga), 3) AS xga_per_game, sround(sum(xga), 3) AS xga_total,
      sround(avg(goals_conceded), 2) AS goals_conceded_per_game, sround(avg(clearances), 2) AS clearances_per_game,
      sround(avg(avg_defensive_line_x), 2) AS avg_defensive_line_x, sround(avg(possession_pct), 2) AS avg_possession_pct,
      sround(avg(progressive_passes), 2) AS progressive_passes_per_game,
      sround(avg(progressive_carries), 2) AS progressive_carries_per_game,
      sround(avg(avg_pass_length), 2) AS avg_pass_length, sround(avg(crosses), 2) AS crosses_per_game,
      sround(avg(ppda), 2) AS avg_ppda, sround(sum(xg) - sum(xga), 3) AS xg_diff_total
    FROM tp GROUP BY team_id, team_name, competition_id, season_id))"""


@query("team_style", with_fixtures(EM, TEAM_STYLE_SQL, TIMELINE + "," + TEAM_PERF))
def q_team_style(spark, sf):
    return gold.team_style(tp_frame(spark, sf))


STYLE_OVERALL_SQL = """
SELECT *, sround((overall_xg_per_game - overall_xga_per_game) * 0.4 + (overall_possession_pct - 50) * 0.02
        + CASE WHEN overall_ppda IS NOT NULL THEN (20 - overall_ppda) * 0.03 ELSE 0 END, 3) AS overall_dominance_score
FROM (
  SELECT team_id, team_name, count(*) AS total_matches, sround(avg(xg), 3) AS overall_xg_per_game,
    sround(avg(xga), 3) AS overall_xga_per_game, sround(avg(ppda), 2) AS overall_ppda,
    sround(avg(possession_pct), 2) AS overall_possession_pct, sround(avg(progressive_passes), 2) AS overall_prog_passes,
    sround(avg(avg_defensive_line_x), 2) AS overall_defensive_line_x, sround(sum(xg) - sum(xga), 3) AS overall_xg_diff,
    list_sort(list(DISTINCT CAST(competition_id AS VARCHAR) || '/' || CAST(season_id AS VARCHAR))) AS competitions_included
  FROM tp GROUP BY team_id, team_name)"""


@query("team_style_overall", with_fixtures(EM, STYLE_OVERALL_SQL, TIMELINE + "," + TEAM_PERF))
def q_team_style_overall(spark, sf):
    return gold.team_style_overall(tp_frame(spark, sf))


STANDINGS_SQL = """
SELECT *, sround(points - xg_points, 1) AS luck_index,
  rank() OVER (PARTITION BY competition_id, season_id ORDER BY points DESC, goal_diff DESC, goals_for DESC, xg_diff DESC) AS rank_overall
FROM (
  SELECT *, wins * 3 + draws AS points, goals_for - goals_against AS goal_diff,
    sround(xg_for - xga_against, 3) AS xg_diff,
    sround(CASE WHEN xg_for + xga_against <> 0 THEN xg_for / (xg_for + xga_against) END * matches_played * 3, 1) AS xg_points,
    CASE max_stage_ordinal WHEN 7 THEN 'Final' WHEN 6 THEN '3rd Place' WHEN 5 THEN 'Semi-finals'
      WHEN 4 THEN 'Quarter-finals' WHEN 3 THEN 'Round of 16' WHEN 2 THEN 'Round of 32' ELSE 'Group Stage' END AS furthest_stage
  FROM (
    SELECT team_id, team_name, competition_id, season_id, count(*) AS matches_played,
      count(*) FILTER (WHERE result = 'W') AS wins, count(*) FILTER (WHERE result = 'D') AS draws,
      count(*) FILTER (WHERE result = 'L') AS losses,
      CAST(sum(goals_scored) AS BIGINT) AS goals_for, CAST(sum(goals_conceded) AS BIGINT) AS goals_against,
      sround(sum(xg), 3) AS xg_for, sround(sum(xga), 3) AS xga_against,
      sround(avg(possession_pct), 1) AS avg_possession, sround(avg(ppda), 2) AS avg_ppda,
      sround(avg(shots_total), 1) AS avg_shots, CAST(sum(progressive_passes) AS BIGINT) AS total_prog_passes,
      max(CASE WHEN stage_name LIKE '%Final%' AND stage_name NOT LIKE '%3rd%' THEN 7 WHEN stage_name LIKE '%3rd%' THEN 6
               WHEN stage_name LIKE '%Semi%' THEN 5 WHEN stage_name LIKE '%Quarter%' THEN 4
               WHEN stage_name LIKE '%16%' THEN 3 WHEN stage_name LIKE '%32%' THEN 2 ELSE 1 END) AS max_stage_ordinal
    FROM tp GROUP BY team_id, team_name, competition_id, season_id))"""


@query("standings", with_fixtures(EM, STANDINGS_SQL, TIMELINE + "," + TEAM_PERF))
def q_standings(spark, sf):
    return gold.standings(tp_frame(spark, sf))
