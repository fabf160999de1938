"""Scalar-function keys (FN), set and sort keys (SET, SRT), projection keys (PRJ) and reports (AGG-31..45)."""

from __future__ import annotations

from pyspark.sql import functions as F

from fulltime.functions import football as fb
from fulltime.functions import markets as mk
from fulltime.functions.common import pct, slug
from fulltime.operators import reports, timeline
from fulltime.operators.ranking import top_k_per_group
from fulltime.plans.core import EM, TEAM_STYLE_SQL, pms_frame, tl_base, tl_frame, tp_frame
from fulltime.plans.fixture_sql import with_fixtures
from fulltime.plans.registry import query
from fulltime.plans.shots_ratings import ELO, elo_frame
from fulltime.plans.sql_blocks import PLAYER_STATS, TEAM_PERF, TIMELINE
from fulltime.sources import testdata as td

# ---------------------------------------------------------------- FN-01..03 geometry


@query("pitch_geometry", with_fixtures(["fx_event"], """
SELECT event_id, sqrt(pow(120.0 - loc_x, 2) + pow(40.0 - loc_y, 2)) AS distance_to_goal,
       degrees(atan2(abs(40.0 - loc_y), abs(120.0 - loc_x))) AS angle_to_goal,
       CASE WHEN loc_x < 40 THEN 'defensive_third' WHEN loc_x < 80 THEN 'middle_third'
            WHEN loc_x >= 80 THEN 'attacking_third' END AS pitch_zone
FROM fx_event"""))
def q_pitch_geometry(spark, sf):
    e = td.fx_event(spark, sf)
    return e.select("event_id", fb.distance_to_goal().alias("distance_to_goal"),
                    fb.angle_to_goal().alias("angle_to_goal"), fb.pitch_zone().alias("pitch_zone"))


@query("safe_pct", with_fixtures(EM, """
SELECT match_id, player_id,
       CASE WHEN shots_total > 0 THEN sround(goals / shots_total * 100, 1) END AS conversion_pct,
       CASE WHEN carries_total > 0 THEN sround(progressive_carries / carries_total * 100, 1) END AS prog_carry_pct
FROM pms""", TIMELINE + "," + PLAYER_STATS))
def q_safe_pct(spark, sf):
    p = pms_frame(spark, sf)
    return p.select("match_id", "player_id", pct("goals", "shots_total").alias("conversion_pct"),
                    pct("progressive_carries", "carries_total").alias("prog_carry_pct"))


@query("casts", with_fixtures(["fx_result"], """
SELECT match_num, CAST(CAST(match_date AS VARCHAR) AS DATE) AS date_roundtrip,
       strftime(match_date, '%Y-%m') AS month_label, CAST(year(match_date) AS INTEGER) AS year,
       TRY_CAST(substr(home_team, 2) AS INTEGER) AS home_code, TRY_CAST(home_team AS INTEGER) AS bad_cast
FROM fx_result"""))
def q_casts(spark, sf):
    r = td.fx_result(spark, sf)
    return r.select("match_num", F.col("match_date").cast("string").cast("date").alias("date_roundtrip"),
                    F.date_format("match_date", "yyyy-MM").alias("month_label"), F.year("match_date").alias("year"),
                    F.expr("try_cast(substr(home_team, 2) AS INT)").alias("home_code"),
                    F.expr("try_cast(home_team AS INT)").alias("bad_cast"))


@query("str_match", with_fixtures(EM, """
SELECT match_id, stage_name, contains(stage_name, 'Final') AS has_final,
       regexp_matches(stage_name, '(?i)semi|quarter') AS late_knockout FROM fx_match"""))
def q_str_match(spark, sf):
    m = td.fx_match(spark, sf)
    return m.select("match_id", "stage_name", F.col("stage_name").contains("Final").alias("has_final"),
                    F.col("stage_name").rlike("(?i)semi|quarter").alias("late_knockout"))


@query("position_class", with_fixtures(["fx_rating"], """
SELECT player_id, position,
       CASE WHEN position LIKE '%GK%' THEN 'GK' WHEN regexp_matches(position, 'CB|RB|LB|WB|RWB|LWB|DEF') THEN 'DEF'
            WHEN regexp_matches(position, 'CDM|CM|CAM|RM|LM|MID') THEN 'MID'
            WHEN regexp_matches(position, 'RW|LW|CF|ST|ATT') THEN 'ATT' ELSE 'MID' END AS position_class
FROM fx_rating"""))
def q_position_class(spark, sf):
    return td.fx_rating(spark, sf).select("player_id", "position", fb.position_class().alias("position_class"))


@query("stage_ordinal", with_fixtures(EM, """
SELECT match_id,
  CASE WHEN stage_name = 'Group Stage' THEN 1 WHEN stage_name LIKE '%32%' THEN 2 WHEN stage_name LIKE '%16%' THEN 3
       WHEN stage_name LIKE '%Quarter%' THEN 4 WHEN stage_name LIKE '%Semi%' THEN 5 WHEN stage_name LIKE '%3rd%' THEN 6
       WHEN stage_name LIKE '%Final%' THEN 7 ELSE 1 END AS stage_ordinal,
  CASE WHEN stage_name LIKE '%Final%' AND stage_name NOT LIKE '%3rd%' THEN 7 WHEN stage_name LIKE '%3rd%' THEN 6
       WHEN stage_name LIKE '%Semi%' THEN 5 WHEN stage_name LIKE '%Quarter%' THEN 4 WHEN stage_name LIKE '%16%' THEN 3
       WHEN stage_name LIKE '%32%' THEN 2 ELSE 1 END AS stage_reached
FROM fx_match"""))
def q_stage_ordinal(spark, sf):
    m = td.fx_match(spark, sf)
    return m.select("match_id", fb.stage_ordinal().alias("stage_ordinal"), fb.stage_reached().alias("stage_reached"))


@query("outcome", with_fixtures(["fx_result"], """
SELECT match_num,
  CASE WHEN home_score > away_score THEN 1 WHEN home_score = away_score THEN 0 ELSE -1 END AS result_sign,
  CASE WHEN home_score > away_score THEN 'W' WHEN home_score = away_score THEN 'D' ELSE 'L' END AS result_home,
  CASE WHEN home_score > away_score THEN 3 WHEN home_score = away_score THEN 1 ELSE 0 END AS points_home,
  away_score = 0 AS clean_sheet_home
FROM fx_result"""))
def q_outcome(spark, sf):
    r = td.fx_result(spark, sf)
    res = fb.outcome_letter("home_score", "away_score")
    return r.select("match_num", fb.outcome_sign("home_score", "away_score").alias("result_sign"),
                    res.alias("result_home"), fb.points(res).alias("points_home"),
                    (F.col("away_score") == 0).alias("clean_sheet_home"))


@query("elo_wdl", with_fixtures(["fx_result"], """
SELECT pool_id, match_num, p * (1 - d) AS p_home_win, d AS p_draw, (1 - p) * (1 - d) AS p_away_win FROM (
  SELECT pool_id, match_num, p, greatest(0.15, least(0.30, 0.26 * (1.0 - abs(p - 0.5) * 1.5))) AS d FROM (
    SELECT pool_id, match_num, 1.0 / (1.0 + pow(10.0, -(elo_home_before - elo_away_before) / 400.0)) AS p FROM elo))""",
                                ELO))
def q_elo_wdl(spark, sf):
    e = elo_frame(spark, sf)
    h, d, a = fb.elo_wdl("elo_home_before", "elo_away_before")
    return e.select("pool_id", "match_num", h.alias("p_home_win"), d.alias("p_draw"), a.alias("p_away_win"))


# Confederation of each test-data region.
REGION_CONFEDERATION = {"AFRICA": "CAF", "AMERICA": "CONMEBOL", "ASIA": "AFC", "EUROPE": "UEFA", "MIDDLE EAST": "AFC"}


def confederation(region_name):
    m = F.create_map(*[x for k, v in REGION_CONFEDERATION.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, region_name), F.lit("OTHER"))


_CONF_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in REGION_CONFEDERATION.items())


@query("confederation", f"""
SELECT n.n_nationkey AS team_id, n.n_name AS team_name, CASE r.r_name {_CONF_SQL} ELSE 'OTHER' END AS confederation
FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def q_confederation(spark, sf):
    n = td.table(spark, sf, "nation")
    r = td.table(spark, sf, "region")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return j.select(F.col("n_nationkey").alias("team_id"), F.col("n_name").alias("team_name"),
                    confederation(F.col("r_name")).alias("confederation"))


#: Names of the test data's nations that differ from those of the list.
_RENAMED = {"UNITED STATES": "USA", "UNITED KINGDOM": "England"}
_COUNTRY_SQL = "CASE n_name " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _RENAMED.items()) + \
    " ELSE array_to_string([upper(w[1:1]) || lower(w[2:]) FOR w IN string_split(n_name, ' ')], ' ') END"


@query("confederation_by_country", f"""
SELECT team_id, country, CASE {' '.join(f"WHEN country IN ({', '.join(repr(c) for c in cs)}) THEN '{k}'" for k, cs in fb.CONFEDERATIONS.items())}
  ELSE 'OTHER' END AS confederation
FROM (SELECT n_nationkey AS team_id, {_COUNTRY_SQL} AS country FROM nation)""")
def q_confederation_by_country(spark, sf):
    """Confederation of every country by its name."""
    n = td.table(spark, sf, "nation")
    country = F.initcap("n_name")
    for a, b in _RENAMED.items():
        country = F.when(F.col("n_name") == a, b).otherwise(country)
    return n.select(F.col("n_nationkey").alias("team_id"), country.alias("country"), fb.confederation_of(country).alias("confederation"))


@query("opening_odds", with_fixtures(EM, """
SELECT match_id, round(1.07 / ph, 2) AS odd_home, round(1.07 / pd, 2) AS odd_draw, round(1.07 / (1 - ph - pd), 2) AS odd_away
FROM (SELECT match_id, 1.0 / (1.0 + exp(-(away_team_id - home_team_id) * 0.04)) AS ph,
             greatest(0.18, least(0.30, 0.26 - abs(away_team_id - home_team_id) * 0.003)) AS pd FROM fx_match)"""))
def q_opening_odds(spark, sf):
    """Opening 1X2 prices with team ids standing in for world ranks."""
    m = td.fx_match(spark, sf)
    h, d, a = mk.opening_odds(F.col("home_team_id"), F.col("away_team_id"))
    return m.select("match_id", h.alias("odd_home"), d.alias("odd_draw"), a.alias("odd_away"))


@query("implied_probs", with_fixtures(["fx_odds"], """
SELECT snapshot_id, round(1 / odd_home / t, 4) AS ip_home, round(1 / odd_draw / t, 4) AS ip_draw,
       round(1 / odd_away / t, 4) AS ip_away, round(t - 1, 4) AS margin
FROM (SELECT *, 1 / odd_home + 1 / odd_draw + 1 / odd_away AS t FROM fx_odds)"""))
def q_implied_probs(spark, sf):
    o = td.fx_odds(spark, sf)
    h, d, a, m = mk.implied_probs("odd_home", "odd_draw", "odd_away")
    return o.select("snapshot_id", h.alias("ip_home"), d.alias("ip_draw"), a.alias("ip_away"), m.alias("margin"))


@query("over_under", with_fixtures(["fx_odds"], """
SELECT snapshot_id, p AS p_over, round(1.05e0 / p, 2) AS odd_over, round(1.05e0 / (1 - p), 2) AS odd_under
FROM (SELECT snapshot_id, least(0.95e0, greatest(0.05e0, 0.45e0 + goals_so_far * 0.18e0 - (90 - minute) * 0.003e0)) AS p
      FROM fx_odds)"""))
def q_over_under(spark, sf):
    o = td.fx_odds(spark, sf)
    p, ov, un = mk.over_under("goals_so_far", "minute")
    return o.select("snapshot_id", p.alias("p_over"), ov.alias("odd_over"), un.alias("odd_under"))


_COMPASS_SQL = "[" + ", ".join(f"'{p}'" for p in mk.COMPASS_POINTS) + "]"
_WEATHER_SQL = " ".join(f"WHEN {k} THEN '{v}'" for k, v in mk.WEATHER_CODES.items())


@query("compass", with_fixtures(["fx_weather"], f"""
SELECT weather_id, wind_direction_deg,
       {_COMPASS_SQL}[CAST(((CAST(round_even(wind_direction_deg / 22.5, 0) AS INTEGER) % 16) + 16) % 16 AS INTEGER) + 1] AS compass
FROM fx_weather"""))
def q_compass(spark, sf):
    w = td.fx_weather(spark, sf)
    return w.select("weather_id", "wind_direction_deg", mk.compass("wind_direction_deg").alias("compass"))


@query("weather_text", with_fixtures(["fx_weather"], f"""
SELECT weather_id, weather_code, CASE weather_code {_WEATHER_SQL} ELSE 'Unknown' END AS weather_desc FROM fx_weather"""))
def q_weather_text(spark, sf):
    w = td.fx_weather(spark, sf)
    return w.select("weather_id", "weather_code", mk.weather_text("weather_code").alias("weather_desc"))


@query("normalise_live", """
SELECT event_id, coalesce(replace(lower(upper(event_type) || ' event'), ' ', '_'), 'unknown') AS event_type,
       nullif(CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END, '') AS player_id
FROM events""")
def q_normalise_live(spark, sf):
    """Live-feed clean-up on raw event rows: type to snake case (from a display label), empty ids to null."""
    e = td.table(spark, sf, "events")
    label = F.concat(F.upper("event_type"), F.lit(" event"))
    raw_id = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("user_id").cast("string"))
    return e.select("event_id", mk.normalise_event_type(label).alias("event_type"),
                    mk.empty_to_null(raw_id).alias("player_id"))


@query("array_fns", with_fixtures(EM, """
SELECT match_id, count(*) AS n_events, max(len(loc)) AS max_len, avg(loc[1]) AS mean_x, avg(loc[2]) AS mean_y,
       list_sort(list(DISTINCT type_name)) AS types
FROM (SELECT match_id, type_name, CASE WHEN loc_x IS NOT NULL THEN [loc_x, loc_y] END AS loc FROM fx_event)
GROUP BY match_id"""))
def q_array_fns(spark, sf):
    """Location as an array, safe element access, size and a sorted distinct set per match."""
    e = td.fx_event(spark, sf).select(
        "match_id", "type_name", F.when(F.col("loc_x").isNotNull(), F.array("loc_x", "loc_y")).alias("loc"))
    return e.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.max(F.size("loc")).cast("bigint").alias("max_len"),
        F.avg(F.get("loc", 0)).alias("mean_x"), F.avg(F.get("loc", 1)).alias("mean_y"),
        F.sort_array(F.collect_set("type_name")).alias("types"))


@query("json_fns", """
SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum,
       count(*) FILTER (WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50) AS k_high,
       min(to_json({'t': event_type})::VARCHAR) AS encoded
FROM events GROUP BY event_type""")
def q_json_fns(spark, sf):
    """JSON decode (path lookup and schema parse) and encode on the raw event properties."""
    e = td.table(spark, sf, "events").select("event_type", "props")
    k = F.get_json_object("props", "$.k").cast("bigint")
    parsed = F.from_json("props", "k long").getField("k")
    return e.groupBy("event_type").agg(
        F.sum(k).alias("k_sum"), F.count_if(parsed >= 50).alias("k_high"),
        F.min(F.to_json(F.struct(F.col("event_type").alias("t")))).alias("encoded"))


@query("slug", with_fixtures(EM, """
SELECT DISTINCT home_team_name AS team_name, regexp_replace(lower(trim(home_team_name)), '\\s+', '_', 'g') AS team_slug
FROM fx_match"""))
def q_slug(spark, sf):
    m = td.fx_match(spark, sf)
    return m.select(F.col("home_team_name").alias("team_name"), slug("home_team_name").alias("team_slug")).distinct()


@query("iso_ts", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
       CAST(strptime(strftime(ts, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS parsed,
       CAST(ts AS DATE) AS event_date
FROM events""")
def q_iso_ts(spark, sf):
    e = td.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return e.select("event_id", iso.alias("iso"), F.to_timestamp_ntz(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("parsed"),
                    F.to_date("ts").alias("event_date"))


@query("math_fns", with_fixtures(["fx_market"], """
SELECT team_id, ln(total_squad_value_m + 1) AS log_value, round(total_squad_value_m / 3.0, 2) AS third_value,
       abs(top3_value_m - total_squad_value_m) AS gap, greatest(top3_value_m, 5000) AS floor_top3,
       least(n_players, 10) AS capped_players
FROM fx_market"""))
def q_math_fns(spark, sf):
    m = td.fx_market(spark, sf)
    return m.select("team_id", F.log(F.col("total_squad_value_m") + 1).alias("log_value"),
                    F.round(F.col("total_squad_value_m") / 3.0, 2).alias("third_value"),
                    F.abs(F.col("top3_value_m") - F.col("total_squad_value_m")).alias("gap"),
                    F.greatest("top3_value_m", F.lit(5000)).alias("floor_top3"),
                    F.least("n_players", F.lit(10)).alias("capped_players"))


# ---------------------------------------------------------------- PRJ, SET, SRT


@query("team_history", with_fixtures(["fx_result"], """
SELECT pool_id, match_num, home_team AS team, home_score AS goals_for, away_score AS goals_against, true AS is_home
FROM fx_result
UNION ALL
SELECT pool_id, match_num, away_team, away_score, home_score, false FROM fx_result"""))
def q_team_history(spark, sf):
    """Every team's matches with side-dependent goals (the per-team disjunctive filter, for all teams at once)."""
    from fulltime.operators.sets import stack_sides

    return stack_sides(td.fx_result(spark, sf), ["pool_id", "match_num"],
                       {"team": ("home_team", "away_team"), "goals_for": ("home_score", "away_score"),
                        "goals_against": ("away_score", "home_score")})


@query("union_editions", with_fixtures(EM, """
SELECT match_id, competition_id, season_id, home_team_id, away_team_id FROM fx_match"""))
def q_union_editions(spark, sf):
    """One frame per edition, put back together by name (columns in different orders)."""
    from fulltime.operators.sets import editions, union_by_name

    m = td.fx_match(spark, sf)
    parts = []
    for i, (comp, season) in enumerate(editions(m)):
        cols = ["match_id", "competition_id", "season_id", "home_team_id", "away_team_id"]
        part = m.filter((F.col("competition_id") == comp) & (F.col("season_id") == season))
        parts.append(part.select(*(cols if i % 2 == 0 else list(reversed(cols)))))
    return union_by_name(parts)


@query("stack_sides", with_fixtures(EM, """
SELECT match_id, home_team_id AS team_id, home_score AS goals, 'home' AS side FROM fx_match
UNION ALL SELECT match_id, away_team_id, away_score, 'away' FROM fx_match"""))
def q_stack_sides(spark, sf):
    from fulltime.operators.sets import stack_sides

    return stack_sides(td.fx_match(spark, sf), ["match_id"],
                       {"team_id": ("home_team_id", "away_team_id"), "goals": ("home_score", "away_score")},
                       side_col="side")


@query("all_keys", with_fixtures(["fx_rating", "fx_form", "fx_market"], """
SELECT team_id FROM fx_rating UNION SELECT team_id FROM fx_form UNION SELECT team_id FROM fx_market"""))
def q_all_keys(spark, sf):
    from fulltime.operators.sets import distinct_keys

    return distinct_keys([td.fx_rating(spark, sf), td.fx_form(spark, sf), td.fx_market(spark, sf)], ["team_id"])


@query("dedup_keys", with_fixtures(EM, """
SELECT match_id, player_id, first_event FROM (
  SELECT match_id, player_id, event_id AS first_event,
         row_number() OVER (PARTITION BY match_id, player_id ORDER BY event_index, event_id) AS rn FROM fx_event)
WHERE rn = 1"""))
def q_dedup_keys(spark, sf):
    """One row per (match, player): the first event, chosen deterministically (min_by, partial aggregation)."""
    e = td.fx_event(spark, sf)
    return e.groupBy("match_id", "player_id").agg(
        F.min_by("event_id", F.struct("event_index", "event_id")).alias("first_event"))


@query("topk_shots", with_fixtures(EM, """
SELECT event_id, match_id, player_name, shot_xg, distance_to_goal FROM tl
WHERE type_name = 'Shot' AND shot_xg IS NOT NULL
ORDER BY shot_xg DESC, distance_to_goal ASC NULLS LAST, event_id LIMIT 20""", TIMELINE))
def q_topk_shots(spark, sf):
    """Top 20 shots by xG, nearest first on ties, event id as the final tie-break (TakeOrderedAndProject)."""
    s = timeline.shots(tl_base(spark, sf))
    return s.orderBy(F.col("shot_xg").desc(), F.col("distance_to_goal").asc_nulls_last(), "event_id").limit(20) \
        .select("event_id", "match_id", "player_name", "shot_xg", "distance_to_goal")


@query("top1_value", with_fixtures(EM, """
SELECT competition_id, season_id, arg_max(team_name, (xg_diff_per_game, -team_id)) AS best_team,
       max(xg_diff_per_game) AS best_xg_diff_per_game
FROM (""" + TEAM_STYLE_SQL + """) s
GROUP BY competition_id, season_id""", TIMELINE + "," + TEAM_PERF))
def q_top1_value(spark, sf):
    """Value at the top-1 row per edition (team with the best xG difference per game), by max_by."""
    from fulltime.operators import gold

    s = gold.team_style(tp_frame(spark, sf))
    return s.groupBy("competition_id", "season_id").agg(
        F.max_by("team_name", F.struct("xg_diff_per_game", (-F.col("team_id")).alias("t"))).alias("best_team"),
        F.max("xg_diff_per_game").alias("best_xg_diff_per_game"))


@query("having_pressers", with_fixtures(EM, """
SELECT player_name, team_name, competition_id, season_id, CAST(sum(pressures_high) AS BIGINT) AS high_pressures
FROM pms GROUP BY player_name, team_name, competition_id, season_id HAVING sum(pressures_high) >= 10""",
                                        TIMELINE + "," + PLAYER_STATS))
def q_having_pressers(spark, sf):
    p = pms_frame(spark, sf)
    g = p.groupBy("player_name", "team_name", "competition_id", "season_id").agg(
        F.sum("pressures_high").alias("high_pressures"))
    return g.filter(F.col("high_pressures") >= 10)


@query("report_scorers", with_fixtures(EM, """
SELECT competition_id, season_id, player_name, team_name, CAST(sum(goals) AS BIGINT) AS goals, sum(xg_total) AS xg,
       CAST(sum(assists) AS BIGINT) AS assists, CAST(sum(shots_total) AS BIGINT) AS shots,
       sround(sum(goals) - sum(xg_total), 2) AS goals_minus_xg
FROM pms GROUP BY competition_id, season_id, player_name, team_name HAVING sum(goals) >= 1""",
                                       TIMELINE + "," + PLAYER_STATS))
def q_report_scorers(spark, sf):
    from fulltime.functions.common import rnd

    p = pms_frame(spark, sf)
    g = p.groupBy("competition_id", "season_id", "player_name", "team_name").agg(
        F.sum("goals").alias("goals"), F.sum("xg_total").alias("xg"), F.sum("assists").alias("assists"),
        F.sum("shots_total").alias("shots"))
    return g.filter(F.col("goals") >= 1).withColumn("goals_minus_xg", rnd(F.col("goals") - F.col("xg"), 2))


@query("goals_by_edition", with_fixtures(EM, """
SELECT competition_id, season_id, count(*) FILTER (WHERE type_name = 'Shot' AND shot_outcome = 'Goal') AS goals,
       sum(shot_xg) AS xg FROM tl GROUP BY competition_id, season_id""", TIMELINE))
def q_goals_by_edition(spark, sf):
    t = tl_base(spark, sf)
    return t.groupBy("competition_id", "season_id").agg(
        F.count_if((F.col("type_name") == "Shot") & (F.col("shot_outcome") == "Goal")).alias("goals"),
        F.sum("shot_xg").alias("xg"))


@query("report_pressing", with_fixtures(EM, """
SELECT competition_id, season_id, team_name, sround(avg(ppda), 2) AS avg_ppda, sround(avg(possession_pct), 1) AS avg_possession,
       count(*) AS matches FROM tp GROUP BY competition_id, season_id, team_name""", TIMELINE + "," + TEAM_PERF))
def q_report_pressing(spark, sf):
    from fulltime.functions.common import rnd

    t = tp_frame(spark, sf)
    return t.groupBy("competition_id", "season_id", "team_name").agg(
        rnd(F.avg("ppda"), 2).alias("avg_ppda"), rnd(F.avg("possession_pct"), 1).alias("avg_possession"),
        F.count(F.lit(1)).alias("matches"))


@query("report_xg_diff", with_fixtures(EM, """
SELECT competition_id, season_id, team_name, sround(sum(xg), 2) AS xg_for, sround(sum(xga), 2) AS xg_against,
       sround(sum(xg) - sum(xga), 2) AS xg_diff FROM tp GROUP BY competition_id, season_id, team_name""",
                                       TIMELINE + "," + TEAM_PERF))
def q_report_xg_diff(spark, sf):
    from fulltime.functions.common import rnd

    t = tp_frame(spark, sf)
    return t.groupBy("competition_id", "season_id", "team_name").agg(
        rnd(F.sum("xg"), 2).alias("xg_for"), rnd(F.sum("xga"), 2).alias("xg_against"),
        rnd(F.sum("xg") - F.sum("xga"), 2).alias("xg_diff"))


# ---------------------------------------------------------------- reports AGG-31..35, 40, 41, 45


@query("profile_counts", with_fixtures(EM, """
SELECT competition_id, season_id, type_name, count(*) AS n FROM tl GROUP BY competition_id, season_id, type_name""",
                                       TIMELINE))
def q_profile_counts(spark, sf):
    return reports.profile_counts(tl_base(spark, sf), ["competition_id", "season_id", "type_name"])


@query("profile_distinct", with_fixtures(EM, """
SELECT competition_id, season_id, count(DISTINCT player_id) AS distinct_player_id,
       count(DISTINCT match_id) AS distinct_match_id, count(DISTINCT team_id) AS distinct_team_id, count(*) AS rows
FROM tl GROUP BY competition_id, season_id""", TIMELINE))
def q_profile_distinct(spark, sf):
    return reports.profile_distinct(tl_base(spark, sf), ["competition_id", "season_id"],
                                    ["player_id", "match_id", "team_id"])


@query("avg_visible", with_fixtures(["fx_event", "fx_frame"], """
SELECT avg(n) AS avg_visible, count(*) AS events_with_frames, CAST(sum(n) AS BIGINT) AS frames
FROM (SELECT event_id, count(*) AS n FROM fx_frame GROUP BY event_id)"""))
def q_avg_visible(spark, sf):
    per_event = td.fx_frame(spark, sf).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return per_event.agg(F.avg("n").alias("avg_visible"), F.count(F.lit(1)).alias("events_with_frames"),
                         F.sum("n").alias("frames"))


@query("xg_summary", with_fixtures(["fx_event"], """
SELECT count(shot_xg) AS shots_with_xg, sum(shot_xg) AS xg_total, avg(shot_xg) AS xg_mean, max(shot_xg) AS xg_max
FROM fx_event WHERE type_name = 'Shot'"""))
def q_xg_summary(spark, sf):
    s = td.fx_event(spark, sf).filter(F.col("type_name") == "Shot")
    return s.agg(F.count("shot_xg").alias("shots_with_xg"), F.sum("shot_xg").alias("xg_total"),
                 F.avg("shot_xg").alias("xg_mean"), F.max("shot_xg").alias("xg_max"))


@query("results_by_year", with_fixtures(["fx_result"], """
SELECT CAST(year(match_date) AS INTEGER) AS year, count(*) AS matches,
       CAST(sum(home_score + away_score) AS BIGINT) AS goals, avg(home_score + away_score) AS goals_per_match
FROM fx_result GROUP BY year(match_date)"""))
def q_results_by_year(spark, sf):
    r = td.fx_result(spark, sf)
    g = F.col("home_score") + F.col("away_score")
    return r.groupBy(F.year("match_date").alias("year")).agg(
        F.count(F.lit(1)).alias("matches"), F.sum(g).alias("goals"), F.avg(g).alias("goals_per_match"))


@query("summary_stats", with_fixtures(EM, """
SELECT 'xg' AS "column", count(xg) AS count, avg(xg) AS mean, stddev_samp(xg) AS stddev, min(xg) AS min,
       quantile_disc(xg, 0.25) AS p25, quantile_disc(xg, 0.5) AS p50, quantile_disc(xg, 0.75) AS p75, max(xg) AS max
FROM tp
UNION ALL
SELECT 'possession_pct', count(possession_pct), avg(possession_pct), stddev_samp(possession_pct), min(possession_pct),
       quantile_disc(possession_pct, 0.25), quantile_disc(possession_pct, 0.5), quantile_disc(possession_pct, 0.75),
       max(possession_pct) FROM tp
UNION ALL
SELECT 'shots_total', count(shots_total), avg(shots_total), stddev_samp(shots_total), min(shots_total),
       quantile_disc(shots_total, 0.25), quantile_disc(shots_total, 0.5), quantile_disc(shots_total, 0.75),
       max(shots_total) FROM tp""", TIMELINE + "," + TEAM_PERF))
def q_summary_stats(spark, sf):
    return reports.summary_stats(tp_frame(spark, sf), ["xg", "possession_pct", "shots_total"])


@query("corr_rating_result", with_fixtures(EM, """
SELECT 'xg' AS col_a, 'goals_scored' AS col_b, corr(xg, goals_scored) AS corr FROM tp
UNION ALL SELECT 'xg', 'possession_pct', corr(xg, possession_pct) FROM tp
UNION ALL SELECT 'goals_scored', 'possession_pct', corr(goals_scored, possession_pct) FROM tp""",
                                           TIMELINE + "," + TEAM_PERF))
def q_corr_rating_result(spark, sf):
    return reports.corr_pairs(tp_frame(spark, sf), ["xg", "goals_scored", "possession_pct"])


@query("null_audit", with_fixtures(EM, """
SELECT count(*) AS rows, count(*) FILTER (WHERE match_date IS NULL) AS nulls_match_date,
       count(*) FILTER (WHERE home_team_name IS NULL) AS nulls_home_team_name,
       count(*) FILTER (WHERE away_team_name IS NULL) AS nulls_away_team_name,
       count(*) FILTER (WHERE stage_name IS NULL) AS nulls_stage_name,
       count(*) FILTER (WHERE loc_x IS NULL) AS nulls_loc_x, count(*) FILTER (WHERE shot_xg IS NULL) AS nulls_shot_xg
FROM tl""", TIMELINE))
def q_null_audit(spark, sf):
    return reports.null_audit(tl_base(spark, sf), ["match_date", "home_team_name", "away_team_name", "stage_name",
                                                    "loc_x", "shot_xg"])


@query("expect_total", with_fixtures(EM, """
SELECT g.competition_id, g.season_id, g.goals, CAST(m.goals AS BIGINT) AS goals_in_results, g.goals = m.goals AS matches_expected
FROM (SELECT competition_id, season_id, count(*) FILTER (WHERE type_name = 'Shot' AND shot_outcome = 'Goal') AS goals
      FROM tl GROUP BY competition_id, season_id) g
JOIN (SELECT competition_id, season_id, sum(home_score + away_score) AS goals FROM fx_match
      GROUP BY competition_id, season_id) m USING (competition_id, season_id)""", TIMELINE))
def q_expect_total(spark, sf):
    """Goals counted from the timeline against the totals the match table expects, per edition."""
    t = tl_base(spark, sf)
    g = t.groupBy("competition_id", "season_id").agg(
        F.count_if((F.col("type_name") == "Shot") & (F.col("shot_outcome") == "Goal")).alias("goals"))
    m = td.fx_match(spark, sf).groupBy("competition_id", "season_id").agg(
        F.sum(F.col("home_score") + F.col("away_score")).alias("goals_in_results"))
    return g.join(m, ["competition_id", "season_id"]).withColumn(
        "matches_expected", F.col("goals") == F.col("goals_in_results"))


@query("last_n_shots", with_fixtures(EM, """
SELECT player_id, event_id, shot_xg FROM (
  SELECT player_id, event_id, shot_xg, row_number() OVER (PARTITION BY player_id ORDER BY match_id DESC, event_index DESC) AS rn
  FROM tl WHERE type_name = 'Shot') WHERE rn <= 3""", TIMELINE))
def q_last_n_shots(spark, sf):
    """Each player's three latest shots, by the split top-k (a prolific player is sorted by many tasks)."""
    s = tl_base(spark, sf).filter(F.col("type_name") == "Shot")
    return top_k_per_group(s, ["player_id"], [F.col("match_id").desc(), F.col("event_index").desc()], 3, "event_id") \
        .select("player_id", "event_id", "shot_xg")


# ---------------------------------------------------------------- profiles (AGG-31, AGG-32)


@query("profile_types", with_fixtures(EM, """
SELECT m.competition_id, m.season_id, e.type_name, count(*) AS n
FROM fx_event e JOIN fx_match m USING (match_id) GROUP BY ALL"""))
def q_profile_types(spark, sf):
    """Events by edition and type."""
    j = td.fx_event(spark, sf).join(td.fx_match(spark, sf).select("match_id", "competition_id", "season_id"), "match_id")
    return reports.profile_counts(j, ["competition_id", "season_id", "type_name"])


@query("profile_editions", with_fixtures(EM, "SELECT competition_id, season_id, count(*) AS n FROM fx_match GROUP BY ALL"))
def q_profile_editions(spark, sf):
    """Matches by edition."""
    return reports.profile_counts(td.fx_match(spark, sf), ["competition_id", "season_id"])


@query("profile_styles", with_fixtures(EM, "SELECT tactical_profile, count(*) AS n FROM (" + TEAM_STYLE_SQL + ") GROUP BY ALL", TIMELINE + "," + TEAM_PERF))
def q_profile_styles(spark, sf):
    """Team editions by tactical profile."""
    from fulltime.operators import gold

    return reports.profile_counts(gold.team_style(tp_frame(spark, sf)), ["tactical_profile"])


@query("profile_results", with_fixtures(EM, "SELECT result, count(*) AS n FROM tp GROUP BY ALL", TIMELINE + "," + TEAM_PERF))
def q_profile_results(spark, sf):
    """Team matches by result."""
    return reports.profile_counts(tp_frame(spark, sf), ["result"])


@query("profile_positions", with_fixtures(["fx_event"], "SELECT position_name, count(*) AS n FROM (SELECT DISTINCT match_id, player_id, position_name FROM fx_event) GROUP BY ALL"))
def q_profile_positions(spark, sf):
    """Player matches by position."""
    return reports.profile_counts(td.fx_event(spark, sf).select("match_id", "player_id", "position_name").distinct(), ["position_name"])


@query("profile_frames", with_fixtures(["fx_event", "fx_match", "fx_frame"], """
SELECT m.competition_id, m.season_id, count(DISTINCT f.event_id) AS distinct_event_id, count(DISTINCT f.match_id) AS distinct_match_id, count(*) AS rows
FROM fx_frame f JOIN fx_match m USING (match_id) GROUP BY m.competition_id, m.season_id"""))
def q_profile_frames(spark, sf):
    """Frames, and events and matches that have any, by edition."""
    j = td.fx_frame(spark, sf).join(td.fx_match(spark, sf).select("match_id", "competition_id", "season_id"), "match_id")
    return reports.profile_distinct(j, ["competition_id", "season_id"], ["event_id", "match_id"])


@query("profile_players", with_fixtures(EM, """
SELECT m.competition_id, m.season_id, count(DISTINCT e.player_id) AS distinct_player_id, count(DISTINCT e.match_id) AS distinct_match_id,
       count(DISTINCT e.team_id) AS distinct_team_id, count(*) AS rows
FROM fx_event e JOIN fx_match m USING (match_id) GROUP BY m.competition_id, m.season_id"""))
def q_profile_players(spark, sf):
    """Players, matches and teams by edition."""
    j = td.fx_event(spark, sf).join(td.fx_match(spark, sf).select("match_id", "competition_id", "season_id"), "match_id")
    return reports.profile_distinct(j, ["competition_id", "season_id"], ["player_id", "match_id", "team_id"])
