"""Shot context keys (frames) and rating keys (ordered fold, snapshots, as-of, alias lookup)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fulltime.operators import frames, ratings
from fulltime.operators.reports import report_by, report_over_performers
from fulltime.plans.core import tl_base, tl_frame
from fulltime.plans.fixture_sql import with_fixtures
from fulltime.plans.registry import query
from fulltime.plans.sql_blocks import TIMELINE
from fulltime.session import materialize
from fulltime.sources import testdata as td

EMF = ["fx_event", "fx_match", "fx_frame"]


@td.memo_plan("shot_map")
def shot_map_frame(spark, sf):
    return frames.shot_map(tl_frame(spark, sf), td.fx_frame(spark, sf))


SHOT_MAP = TIMELINE + """,
sh AS (
  SELECT event_id, match_id, minute, second, period, player_id, player_name, team_id, team_name, loc_x, loc_y,
         shot_xg, shot_outcome, shot_technique, shot_body_part, shot_type, shot_first_time, shot_one_on_one, distance_to_goal, angle_to_goal, pitch_zone,
         under_pressure, score_home_at_event, score_away_at_event, score_diff_at_event, is_home_team, match_date,
         stage_name, competition_id, season_id
  FROM tl WHERE type_name = 'Shot' AND shot_xg IS NOT NULL),
nd AS (SELECT event_id, match_id, loc_x AS def_x, loc_y AS def_y, is_keeper FROM fx_frame
       WHERE NOT is_teammate AND NOT is_actor),
swd AS (SELECT s.event_id, s.match_id, s.loc_x, s.loc_y, d.def_x, d.def_y, d.is_keeper,
               sqrt(pow(s.loc_x - d.def_x, 2) + pow(s.loc_y - d.def_y, 2)) AS def_dist
        FROM sh s LEFT JOIN nd d USING (event_id, match_id)),
mdd AS (SELECT event_id, match_id, min(def_dist) AS distance_nearest_defender FROM swd WHERE NOT is_keeper
        GROUP BY event_id, match_id),
gk AS (SELECT event_id, match_id, min(def_dist) AS gk_distance_to_shooter,
              avg(abs(120.0 - def_x)) AS gk_distance_to_goalline FROM swd WHERE is_keeper GROUP BY event_id, match_id),
cone AS (SELECT event_id, match_id, count(*) AS defenders_in_cone FROM swd
         WHERE NOT is_keeper AND def_x > loc_x AND def_x <= 120.0 AND def_y >= 34.0 AND def_y <= 46.0
         GROUP BY event_id, match_id),
tm AS (SELECT event_id, match_id, count(*) AS teammates_visible FROM fx_frame WHERE is_teammate AND NOT is_actor
       GROUP BY event_id, match_id),
tv AS (SELECT event_id, match_id, count(*) AS total_players_visible FROM fx_frame GROUP BY event_id, match_id),
smap AS (
  SELECT s.*, mdd.distance_nearest_defender, gk.gk_distance_to_shooter, gk.gk_distance_to_goalline,
         coalesce(cone.defenders_in_cone, 0) AS defenders_in_cone, coalesce(tm.teammates_visible, 0) AS teammates_visible,
         coalesce(tv.total_players_visible, 0) AS total_players_visible,
         mdd.distance_nearest_defender IS NOT NULL AS has_360_data, coalesce(s.shot_outcome = 'Goal', false) AS is_goal
  FROM sh s LEFT JOIN mdd USING (event_id, match_id) LEFT JOIN gk USING (event_id, match_id)
  LEFT JOIN cone USING (event_id, match_id) LEFT JOIN tm USING (event_id, match_id)
  LEFT JOIN tv USING (event_id, match_id))
"""


@query("shot_map", with_fixtures(EMF, "SELECT * FROM smap", SHOT_MAP))
def q_shot_map(spark, sf):
    return shot_map_frame(spark, sf)


@query("shot_frame_measures", with_fixtures(EMF, """
SELECT event_id, match_id, distance_nearest_defender, gk_distance_to_shooter, gk_distance_to_goalline,
       defenders_in_cone, teammates_visible, total_players_visible
FROM smap WHERE total_players_visible > 0""", SHOT_MAP))
def q_shot_frame_measures(spark, sf):
    s = frames.shots(tl_base(spark, sf))
    return frames.frame_measures(frames.shot_frames(s, td.fx_frame(spark, sf)))


@query("shot_defenders", with_fixtures(EMF, """
SELECT event_id, match_id, def_x, def_y, is_keeper, def_dist FROM swd""", SHOT_MAP))
def q_shot_defenders(spark, sf):
    """Shot x visible opponents (one-to-many left join): every opponent's distance to the shooter."""
    s = frames.shots(tl_base(spark, sf)).select("event_id", "match_id", "loc_x", "loc_y")
    opp = td.fx_frame(spark, sf).filter(~F.col("is_teammate") & ~F.col("is_actor")).select(
        "event_id", "match_id", F.col("loc_x").alias("def_x"), F.col("loc_y").alias("def_y"), "is_keeper")
    j = s.join(opp, ["event_id", "match_id"], "left")
    return j.select("event_id", "match_id", "def_x", "def_y", "is_keeper",
                    F.sqrt((F.col("loc_x") - F.col("def_x")) ** 2 + (F.col("loc_y") - F.col("def_y")) ** 2).alias("def_dist"))


@query("frames_of", with_fixtures(EMF, """
SELECT f.* FROM fx_frame f SEMI JOIN (
  SELECT event_id, match_id FROM tl WHERE type_name = 'Shot' AND shot_xg IS NOT NULL
  ORDER BY shot_xg DESC, event_id LIMIT 10) k USING (event_id, match_id)""", TIMELINE))
def q_frames_of(spark, sf):
    """Frames of the ten highest-xG shots (the limit is the report), by semi join."""
    top = frames.shots(tl_base(spark, sf)).orderBy(F.col("shot_xg").desc(), F.col("event_id")).limit(10)
    return frames.frames_of(td.fx_frame(spark, sf), top)


@query("report_zone", with_fixtures(EMF, """
SELECT pitch_zone, count(*) AS shots, CAST(sum(CAST(is_goal AS INTEGER)) AS BIGINT) AS goals,
       avg(shot_xg) AS xg_mean, sum(shot_xg) AS xg_total,
       sround(CAST(sum(CAST(is_goal AS INTEGER)) AS DOUBLE) / count(*) * 100, 1) AS conversion_pct
FROM smap GROUP BY pitch_zone""", SHOT_MAP))
def q_report_zone(spark, sf):
    return report_by(shot_map_frame(spark, sf), "pitch_zone")


@query("report_technique", with_fixtures(EMF, """
SELECT shot_technique, count(*) AS shots, CAST(sum(CAST(is_goal AS INTEGER)) AS BIGINT) AS goals,
       avg(shot_xg) AS xg_mean, sum(shot_xg) AS xg_total,
       sround(CAST(sum(CAST(is_goal AS INTEGER)) AS DOUBLE) / count(*) * 100, 1) AS conversion_pct,
       avg(distance_to_goal) AS avg_distance
FROM smap GROUP BY shot_technique HAVING count(*) >= 20""", SHOT_MAP))
def q_report_technique(spark, sf):
    """xG against goals by shot technique."""
    return report_by(shot_map_frame(spark, sf), "shot_technique", min_shots=20, with_distance=True)


@query("report_over", with_fixtures(EMF, """
SELECT competition_id, season_id, player_name, team_name,
       CAST(sum(CAST(is_goal AS INTEGER)) AS BIGINT) AS goals, sum(shot_xg) AS xg_expected, count(*) AS shots,
       sround(sum(CAST(is_goal AS INTEGER)) - sum(shot_xg), 2) AS goals_above_xg
FROM smap GROUP BY competition_id, season_id, player_name, team_name
HAVING sum(CAST(is_goal AS INTEGER)) >= 2""", SHOT_MAP))
def q_report_over(spark, sf):
    return report_over_performers(shot_map_frame(spark, sf), min_goals=2)


# ---------------------------------------------------------------- ratings (WIN-07..09, JN-17, JN-18, FN-11/12)

ELO = """
-- RECURSIVE_CTE
seq AS (SELECT *, row_number() OVER (PARTITION BY pool_id ORDER BY match_date, match_num) AS sq FROM fx_result
        WHERE home_score IS NOT NULL AND away_score IS NOT NULL),
rec AS (
  SELECT pool_id, CAST(0 AS BIGINT) AS sq, CAST(MAP([], []) AS MAP(VARCHAR, DOUBLE)) AS r,
         CAST(NULL AS BIGINT) AS match_num, CAST(NULL AS DOUBLE) AS rh, CAST(NULL AS DOUBLE) AS ra,
         CAST(NULL AS DOUBLE) AS nh, CAST(NULL AS DOUBLE) AS na, CAST(NULL AS DOUBLE) AS we
  FROM (SELECT DISTINCT pool_id FROM fx_result)
  UNION ALL
  SELECT pool_id, sq, map_concat(r, MAP([home_team, away_team], [nh, na])), match_num, rh, ra, nh, na, we FROM (
    SELECT *, rh + k * (w - we) AS nh, ra + k * ((1 - w) - (1 - we)) AS na FROM (
      SELECT *, 1.0 / (1.0 + pow(10.0, (ra - rh) / 400.0)) AS we FROM (
        SELECT s.pool_id, s.sq, rec.r, s.match_num, s.home_team, s.away_team,
               coalesce(rec.r[s.home_team], 1000.0) AS rh, coalesce(rec.r[s.away_team], 1000.0) AS ra,
               CASE WHEN s.home_score > s.away_score THEN 1.0 WHEN s.home_score = s.away_score THEN 0.5 ELSE 0.0 END AS w,
               CASE WHEN regexp_matches(lower(s.round), 'final|semi|third|quarter') THEN 60
                    WHEN regexp_matches(lower(s.round), 'round of 16|round of 32|last 16') THEN 55 ELSE 50 END AS k
        FROM rec JOIN seq s ON s.pool_id = rec.pool_id AND s.sq = rec.sq + 1)))
),
elo AS (
  SELECT s.pool_id, s.match_num, s.match_date, s.home_team, s.away_team, s.home_score, s.away_score, s.round,
         sround(rec.rh, 1) AS elo_home_before, sround(rec.ra, 1) AS elo_away_before,
         sround(rec.nh, 1) AS elo_home_after, sround(rec.na, 1) AS elo_away_after,
         sround(rec.rh - rec.ra, 1) AS elo_diff, sround(rec.we, 4) AS we_home, sround(1 - rec.we, 4) AS we_away,
         CASE WHEN regexp_matches(lower(s.round), 'final|semi|third|quarter') THEN 60
              WHEN regexp_matches(lower(s.round), 'round of 16|round of 32|last 16') THEN 55 ELSE 50 END AS k_factor
  FROM rec JOIN seq s ON s.pool_id = rec.pool_id AND s.match_num = rec.match_num),
sides AS (
  SELECT pool_id, home_team AS team, match_date, match_num, elo_home_after AS rating FROM elo
  UNION ALL SELECT pool_id, away_team, match_date, match_num, elo_away_after FROM elo)
"""


@td.memo_plan("elo_ratings")
def elo_frame(spark, sf):
    return ratings.elo_ratings(td.fx_result(spark, sf))


@query("elo_ratings", with_fixtures(["fx_result"], "SELECT * FROM elo", ELO))
def q_elo_ratings(spark, sf):
    return elo_frame(spark, sf)


@query("elo_snapshot", with_fixtures(["fx_result"], """
SELECT pool_id, team, rating AS elo_rating FROM (
  SELECT *, row_number() OVER (PARTITION BY pool_id, team ORDER BY match_date DESC, match_num DESC) AS rn FROM sides)
WHERE rn = 1""", ELO))
def q_elo_snapshot(spark, sf):
    return ratings.elo_snapshot(elo_frame(spark, sf))


@query("elo_latest", with_fixtures(["fx_result"], """
SELECT team, rating AS elo_rating FROM (
  SELECT *, row_number() OVER (PARTITION BY team ORDER BY match_date DESC, match_num DESC, pool_id DESC) AS rn FROM sides)
WHERE rn = 1""", ELO))
def q_elo_latest(spark, sf):
    return ratings.elo_latest(elo_frame(spark, sf))


@query("elo_asof", with_fixtures(["fx_result"], """
SELECT l.pool_id, l.team, l.match_date, l.match_num, r.rating AS elo_rating
FROM (SELECT pool_id, team, match_date, match_num FROM sides) l
ASOF LEFT JOIN (
  SELECT pool_id, team, match_date, rating FROM (
    SELECT *, row_number() OVER (PARTITION BY pool_id, team, match_date ORDER BY match_num DESC) AS rn FROM sides)
  WHERE rn = 1) r
ON l.pool_id = r.pool_id AND l.team = r.team AND l.match_date > r.match_date""", ELO))
def q_elo_asof(spark, sf):
    """Each team's rating valid strictly before each of its matches (ratings of earlier days only)."""
    # stored once: the fold runs once, and both sides and the daily ratings are read from the copy
    sides = ratings.team_sides(materialize(elo_frame(spark, sf)))
    daily = ratings.latest_by(sides, ["pool_id", "team", "match_date"], ["match_num"], ["rating"])
    left = sides.select("pool_id", "team", "match_date", "match_num")
    out = ratings.asof_join(left, daily, ["pool_id", "team"], "match_date", ["rating"])
    return out.withColumnRenamed("rating", "elo_rating")


@query("alias_lookup", with_fixtures(["fx_result", "fx_event", "fx_match"], """
SELECT n.team_name, coalesce(v1.elo_rating, v2.elo_rating, 1050.0) AS elo_rating
FROM (SELECT DISTINCT home_team_name AS team_name FROM fx_match UNION SELECT DISTINCT away_team_name FROM fx_match) n
LEFT JOIN lat v1 ON v1.team = n.team_name
LEFT JOIN (SELECT DISTINCT home_team_name AS alias_from, 'T' || CAST(home_team_id AS VARCHAR) AS alias_to
           FROM fx_match WHERE home_team_id < 16) a ON a.alias_from = n.team_name
LEFT JOIN lat v2 ON v2.team = a.alias_to""", ELO + """,
lat AS (SELECT team, rating AS elo_rating FROM (
  SELECT *, row_number() OVER (PARTITION BY team ORDER BY match_date DESC, match_num DESC, pool_id DESC) AS rn FROM sides)
  WHERE rn = 1)"""))
def q_alias_lookup(spark, sf):
    """Rating per match-table team: by name, else through an alias table, else the default of the lookup."""
    return team_ratings(spark, sf, UNRATED)


#: Rating taken for a team without history where a rating must be given.
UNRATED = 1050.0


def team_ratings(spark, sf, default: float | None = None):
    """Rating per match-table team: by name, else through an alias table, else ``default``."""
    m = td.fx_match(spark, sf)
    names = m.select(F.col("home_team_name").alias("team_name")).union(
        m.select(F.col("away_team_name").alias("team_name"))).distinct()
    aliases = m.filter(F.col("home_team_id") < 16).select(
        F.col("home_team_name").alias("alias_from"),
        F.concat(F.lit("T"), F.col("home_team_id").cast("string")).alias("alias_to")).distinct()
    latest = ratings.elo_latest(elo_frame(spark, sf))
    return ratings.lookup_with_alias(names, "team_name", latest, "team", "elo_rating", aliases, "alias_from",
                                     "alias_to", default)
