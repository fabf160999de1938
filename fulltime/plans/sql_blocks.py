"""Reusable oracle CTEs (DuckDB dialect) for the conformed layers.

These follow the straightforward formulation (one aggregate per event family, then left
joins), so the oracle checks the fused single-aggregate plans the library runs on Spark.
"""

from __future__ import annotations

from fulltime.functions.football import TIMELINE_TYPES

_TYPES = ", ".join(f"'{t}'" for t in TIMELINE_TYPES)

TIMELINE = f"""
tl0 AS (
  SELECT e.*, m.match_date, m.competition_id, m.season_id, m.stage_name, m.home_team_id, m.home_team_name,
         m.away_team_id, m.away_team_name, m.home_score AS match_home_score_ft, m.away_score AS match_away_score_ft,
         CASE WHEN e.loc_x IS NOT NULL AND e.loc_y IS NOT NULL
              THEN sqrt(pow(120.0 - e.loc_x, 2) + pow(40.0 - e.loc_y, 2)) END AS distance_to_goal,
         CASE WHEN e.loc_x IS NOT NULL AND e.loc_y IS NOT NULL
              THEN degrees(atan2(abs(40.0 - e.loc_y), abs(120.0 - e.loc_x))) END AS angle_to_goal,
         CASE WHEN e.loc_x < 40 THEN 'defensive_third' WHEN e.loc_x < 80 THEN 'middle_third'
              WHEN e.loc_x >= 80 THEN 'attacking_third' END AS pitch_zone,
         coalesce(e.team_id = m.home_team_id, false) AS is_home_team
  FROM fx_event e LEFT JOIN fx_match m ON e.match_id = m.match_id
  WHERE e.type_name IN ({_TYPES})
),
tl AS (
  SELECT *, score_home_at_event - score_away_at_event AS score_diff_at_event FROM (
    SELECT *,
      CAST(coalesce(sum(CASE WHEN type_name = 'Shot' AND shot_outcome = 'Goal' AND team_id = home_team_id THEN 1 ELSE 0 END)
           OVER (PARTITION BY match_id ORDER BY event_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS INTEGER)
        AS score_home_at_event,
      CAST(coalesce(sum(CASE WHEN type_name = 'Shot' AND shot_outcome = 'Goal' AND NOT coalesce(team_id = home_team_id, false) THEN 1 ELSE 0 END)
           OVER (PARTITION BY match_id ORDER BY event_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS INTEGER)
        AS score_away_at_event
    FROM tl0)
)
"""

PLAYER_STATS = """
pbase AS (
  SELECT DISTINCT match_id, player_id, player_name, team_id, team_name, competition_id, season_id, match_date,
         stage_name, home_team_name, away_team_name, is_home_team, match_home_score_ft, match_away_score_ft
  FROM tl WHERE player_id IS NOT NULL),
psh AS (
  SELECT match_id, player_id, count(*) AS shots_total,
         count(*) FILTER (WHERE shot_outcome = 'Goal') AS goals,
         count(*) FILTER (WHERE shot_outcome IN ('Goal', 'Saved')) AS shots_on_target,
         sum(shot_xg) AS xg_total, avg(shot_xg) AS xg_per_shot,
         count(*) FILTER (WHERE shot_first_time) AS shots_first_time, count(*) FILTER (WHERE shot_one_on_one) AS shots_one_on_one,
         count(*) FILTER (WHERE shot_body_part = 'Head') AS headed_shots,
         count(*) FILTER (WHERE shot_type = 'Penalty') AS penalties_taken,
         count(*) FILTER (WHERE shot_type = 'Penalty' AND shot_outcome = 'Goal') AS penalties_scored,
         avg(distance_to_goal) AS avg_shot_distance, avg(angle_to_goal) AS avg_shot_angle
  FROM tl WHERE type_name = 'Shot' GROUP BY match_id, player_id),
ppa AS (
  SELECT match_id, player_id, count(*) AS passes_total,
         count(*) FILTER (WHERE pass_outcome IS NULL) AS passes_complete,
         sum(pass_xa) AS xa_total,
         count(*) FILTER (WHERE pass_shot_assist) AS key_passes,
         count(*) FILTER (WHERE pass_goal_assist) AS assists,
         count(*) FILTER (WHERE pass_cross) AS crosses,
         count(*) FILTER (WHERE pass_switch) AS switches, count(*) FILTER (WHERE pass_through_ball) AS through_balls,
         count(*) FILTER (WHERE pass_type = 'Corner') AS corners,
         count(*) FILTER (WHERE pass_type = 'Free Kick') AS free_kicks,
         count(*) FILTER (WHERE pass_end_x - loc_x >= 10 AND pass_end_x > 60) AS progressive_passes,
         avg(pass_length) AS avg_pass_length
  FROM tl WHERE type_name = 'Pass' GROUP BY match_id, player_id),
ppr AS (
  SELECT match_id, player_id, count(*) AS pressures_total,
         count(*) FILTER (WHERE pitch_zone = 'attacking_third') AS pressures_high,
         count(*) FILTER (WHERE counterpress) AS counterpresses
  FROM tl WHERE type_name = 'Pressure' GROUP BY match_id, player_id),
pca AS (
  SELECT match_id, player_id, count(*) AS carries_total,
         count(*) FILTER (WHERE carry_end_x - loc_x >= 5 AND carry_end_x > 60) AS progressive_carries,
         sum(sqrt(pow(carry_end_x - loc_x, 2) + pow(carry_end_y - loc_y, 2))) AS carry_distance_total
  FROM tl WHERE type_name = 'Carry' GROUP BY match_id, player_id),
pdu AS (
  SELECT match_id, player_id, count(*) AS duels_total,
         count(*) FILTER (WHERE duel_outcome IN ('Won', 'Success')) AS duels_won,
         count(*) FILTER (WHERE duel_type = 'Tackle') AS tackles
  FROM tl WHERE type_name = 'Duel' GROUP BY match_id, player_id),
pmi AS (
  SELECT match_id, player_id,
         count(*) FILTER (WHERE type_name = 'Interception') AS interceptions,
         count(*) FILTER (WHERE type_name = 'Foul Committed') AS fouls_committed,
         count(*) FILTER (WHERE type_name = 'Foul Won') AS fouls_won,
         count(*) FILTER (WHERE foul_card = 'Yellow Card') AS yellow_cards,
         count(*) FILTER (WHERE foul_card IN ('Red Card', 'Second Yellow')) AS red_cards
  FROM tl WHERE type_name IN ('Interception', 'Foul Committed', 'Foul Won') GROUP BY match_id, player_id),
pmin AS (SELECT match_id, player_id, max(minute) AS last_minute_seen FROM tl WHERE player_id IS NOT NULL GROUP BY match_id, player_id),
pms AS (
  SELECT b.*,
    coalesce(s.shots_total, 0) AS shots_total, coalesce(s.goals, 0) AS goals, coalesce(s.shots_on_target, 0) AS shots_on_target,
    coalesce(s.xg_total, 0.0) AS xg_total, s.xg_per_shot, s.shots_first_time, s.shots_one_on_one, s.headed_shots,
    s.penalties_taken, s.penalties_scored, s.avg_shot_distance, s.avg_shot_angle,
    coalesce(p.passes_total, 0) AS passes_total, coalesce(p.passes_complete, 0) AS passes_complete,
    coalesce(p.xa_total, 0.0) AS xa_total, coalesce(p.key_passes, 0) AS key_passes, coalesce(p.assists, 0) AS assists,
    p.crosses, p.switches, p.through_balls, p.corners, p.free_kicks, p.progressive_passes, p.avg_pass_length,
    CASE WHEN p.passes_total > 0 THEN sround(p.passes_complete / p.passes_total * 100, 1) END AS pass_completion_pct,
    coalesce(r.pressures_total, 0) AS pressures_total, coalesce(r.pressures_high, 0) AS pressures_high,
    coalesce(r.counterpresses, 0) AS counterpresses,
    CASE WHEN r.pressures_total > 0 THEN sround(r.pressures_high / r.pressures_total * 100, 1) END AS pressure_high_pct,
    coalesce(c.carries_total, 0) AS carries_total, coalesce(c.progressive_carries, 0) AS progressive_carries,
    c.carry_distance_total,
    coalesce(d.duels_total, 0) AS duels_total, coalesce(d.duels_won, 0) AS duels_won, coalesce(d.tackles, 0) AS tackles,
    CASE WHEN d.duels_total > 0 THEN sround(d.duels_won / d.duels_total * 100, 1) END AS duel_win_pct,
    coalesce(i.interceptions, 0) AS interceptions, coalesce(i.fouls_committed, 0) AS fouls_committed,
    coalesce(i.fouls_won, 0) AS fouls_won, coalesce(i.yellow_cards, 0) AS yellow_cards, coalesce(i.red_cards, 0) AS red_cards,
    mn.last_minute_seen
  FROM pbase b
  LEFT JOIN psh s USING (match_id, player_id) LEFT JOIN ppa p USING (match_id, player_id)
  LEFT JOIN ppr r USING (match_id, player_id) LEFT JOIN pca c USING (match_id, player_id)
  LEFT JOIN pdu d USING (match_id, player_id) LEFT JOIN pmi i USING (match_id, player_id)
  LEFT JOIN pmin mn USING (match_id, player_id))
"""

TEAM_PERF = """
tsh AS (
  SELECT match_id, team_id, count(*) AS shots_total,
         count(*) FILTER (WHERE shot_outcome IN ('Goal', 'Saved')) AS shots_on_target,
         count(*) FILTER (WHERE shot_outcome = 'Goal') AS goals_scored,
         sum(shot_xg) AS xg, avg(shot_xg) AS xg_per_shot, avg(distance_to_goal) AS avg_shot_distance,
         count(*) FILTER (WHERE pitch_zone = 'attacking_third') AS shots_from_att_third,
         count(*) FILTER (WHERE shot_type = 'Penalty') AS penalties,
         count(*) FILTER (WHERE shot_body_part = 'Head') AS headers
  FROM tl WHERE type_name = 'Shot' GROUP BY match_id, team_id),
tpo AS (
  SELECT match_id, team_id, count(*) AS n FROM tl
  WHERE type_name IN ('Pass', 'Carry', 'Dribble', 'Shot', 'Ball Recovery') GROUP BY match_id, team_id),
tpt AS (SELECT match_id, sum(n) AS total FROM tpo GROUP BY match_id),
tpass AS (SELECT match_id, team_id, count(*) AS n FROM tl WHERE type_name = 'Pass' GROUP BY match_id, team_id),
tdef AS (
  SELECT match_id, team_id, count(*) AS n FROM tl
  WHERE type_name IN ('Pressure', 'Interception', 'Tackle', 'Block') AND loc_x > 40 GROUP BY match_id, team_id),
tprog AS (
  SELECT match_id, team_id,
         count(*) FILTER (WHERE type_name = 'Pass' AND pass_end_x - loc_x >= 10 AND pass_end_x > 60) AS progressive_passes,
         count(*) FILTER (WHERE type_name = 'Carry' AND carry_end_x - loc_x >= 5 AND carry_end_x > 60) AS progressive_carries,
         count(*) FILTER (WHERE pass_cross) AS crosses, avg(pass_length) AS avg_pass_length
  FROM tl WHERE type_name IN ('Pass', 'Carry') GROUP BY match_id, team_id),
tcl AS (
  SELECT match_id, team_id, avg(loc_x) AS avg_defensive_line_x, count(*) AS clearances
  FROM tl WHERE type_name = 'Clearance' GROUP BY match_id, team_id),
tside AS (
  SELECT match_id, match_date, competition_id, season_id, stage_name, home_team_id, home_team_name, away_team_id,
         away_team_name, home_team_id AS team_id, home_team_name AS team_name, away_team_id AS opp_id, true AS is_home
  FROM fx_match
  UNION ALL
  SELECT match_id, match_date, competition_id, season_id, stage_name, home_team_id, home_team_name, away_team_id,
         away_team_name, away_team_id, away_team_name, home_team_id, false FROM fx_match),
tp0 AS (
  SELECT s.match_id, s.match_date, s.competition_id, s.season_id, s.stage_name, s.home_team_id, s.home_team_name,
         s.away_team_id, s.away_team_name, s.team_id, s.team_name, s.is_home,
         coalesce(a.shots_total, 0) AS shots_total, coalesce(a.shots_on_target, 0) AS shots_on_target,
         coalesce(a.goals_scored, 0) AS goals_scored, coalesce(a.xg, 0.0) AS xg, a.xg_per_shot, a.avg_shot_distance,
         coalesce(a.shots_from_att_third, 0) AS shots_from_att_third, coalesce(a.penalties, 0) AS penalties,
         coalesce(a.headers, 0) AS headers,
         coalesce(o.xg, 0.0) AS xga, coalesce(o.goals_scored, 0) AS goals_conceded,
         sround(po.n / pt.total * 100, 1) AS possession_pct,
         CASE WHEN d.n > 0 THEN sround(op.n / d.n, 2) END AS ppda_raw, op.n AS opp_passes,
         pr.progressive_passes, pr.progressive_carries, pr.crosses, pr.avg_pass_length,
         c.avg_defensive_line_x, c.clearances
  FROM tside s
  LEFT JOIN tsh a ON a.match_id = s.match_id AND a.team_id = s.team_id
  LEFT JOIN tsh o ON o.match_id = s.match_id AND o.team_id = s.opp_id
  LEFT JOIN tpo po ON po.match_id = s.match_id AND po.team_id = s.team_id
  LEFT JOIN tpt pt ON pt.match_id = s.match_id
  LEFT JOIN tpass op ON op.match_id = s.match_id AND op.team_id = s.opp_id
  LEFT JOIN tdef d ON d.match_id = s.match_id AND d.team_id = s.team_id
  LEFT JOIN tprog pr ON pr.match_id = s.match_id AND pr.team_id = s.team_id
  LEFT JOIN tcl c ON c.match_id = s.match_id AND c.team_id = s.team_id),
tp AS (
  SELECT * EXCLUDE (ppda_raw, opp_passes),
         CASE WHEN opp_passes IS NOT NULL THEN ppda_raw END AS ppda,
         CASE WHEN goals_scored > goals_conceded THEN 'W' WHEN goals_scored = goals_conceded THEN 'D' ELSE 'L' END AS result
  FROM tp0)
"""
