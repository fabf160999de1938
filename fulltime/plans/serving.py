"""Serving views (SNK-07, SNK-09) and dashboard measures (AGG-46) over the serving tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fulltime.functions.common import rnd
from fulltime.operators import gold
from fulltime.operators.measures import measures_scorers, measures_style
from fulltime.plans.core import EM, TEAM_STYLE_SQL, TOP_SCORERS_SQL, pms_frame, tp_frame
from fulltime.plans.fixture_sql import with_fixtures
from fulltime.plans.registry import query
from fulltime.plans.sql_blocks import PLAYER_STATS, TEAM_PERF, TIMELINE

SCORERS = TIMELINE + "," + PLAYER_STATS + ", ts AS (" + TOP_SCORERS_SQL + ")"
STYLE = TIMELINE + "," + TEAM_PERF + ", st AS (" + TEAM_STYLE_SQL + ")"


@query("v_scorers", with_fixtures(EM, """
SELECT player_name, team_name, CAST(competition_id AS VARCHAR) || '/' || CAST(season_id AS VARCHAR) AS competition,
       goals, xg_total, sround(goals - xg_total, 2) AS goals_above_xg, assists, shots_total, shot_conversion_pct,
       goals_per_90, rank_in_competition
FROM ts WHERE goals >= 1""", SCORERS))
def q_v_scorers(spark, sf):
    s = gold.top_scorers(pms_frame(spark, sf))
    return s.filter(F.col("goals") >= 1).select(
        "player_name", "team_name", gold.competition_label().alias("competition"), "goals", "xg_total",
        rnd(F.col("goals") - F.col("xg_total"), 2).alias("goals_above_xg"), "assists", "shots_total",
        "shot_conversion_pct", "goals_per_90", "rank_in_competition")


@query("v_styles", with_fixtures(EM, """
SELECT team_name, CAST(competition_id AS VARCHAR) || '/' || CAST(season_id AS VARCHAR) AS competition, tactical_profile,
       avg_possession_pct, avg_ppda, xg_per_game, xga_per_game, xg_diff_per_game, dominance_score, matches_played,
       wins, draws, losses, win_pct
FROM st""", STYLE))
def q_v_styles(spark, sf):
    s = gold.team_style(tp_frame(spark, sf))
    return s.select("team_name", gold.competition_label().alias("competition"), "tactical_profile",
                    "avg_possession_pct", "avg_ppda", "xg_per_game", "xga_per_game", "xg_diff_per_game",
                    "dominance_score", "matches_played", "wins", "draws", "losses", "win_pct")


@query("measures_scorers", with_fixtures(EM, """
SELECT CAST(sum(goals) AS BIGINT) AS total_goals, sround(sum(xg_total), 2) AS total_xg,
       sround(sum(goals) - sround(sum(xg_total), 2), 2) AS goals_above_xg,
       coalesce(sum(goals) / nullif(sum(shots_total), 0), 0) * 100 AS conversion_pct,
       count(DISTINCT player_name) FILTER (WHERE goals >= 1) AS scorers_with_goals
FROM ts""", SCORERS))
def q_measures_scorers(spark, sf):
    return measures_scorers(gold.top_scorers(pms_frame(spark, sf)))


@query("measures_style", with_fixtures(EM, """
SELECT avg(avg_ppda) AS mean_ppda,
       count(DISTINCT team_name) FILTER (WHERE tactical_profile = 'PRESSING_ALTO') AS high_press_teams,
       avg(xg_diff_per_game) AS mean_xg_diff, max(xg_diff_per_game) AS best_xg_diff
FROM st""", STYLE))
def q_measures_style(spark, sf):
    return measures_style(gold.team_style(tp_frame(spark, sf)))
