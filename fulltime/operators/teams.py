"""Team x match performance from ONE per-match aggregate.

Every measure is taken for both sides in the same ``groupBy(match_id)`` (home and away columns),
then the row is stacked into two team rows. Opponent values (xG against, goals conceded,
passes allowed for PPDA) are simply the other side's columns: no self-join and no second scan.
The spine is the match table x {home, away}, so teams without a shot still get a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulltime.functions import football as fb
from fulltime.functions.common import rnd, with_optional

SIDES = ("home", "away")


def _side_measures(side: str, include_tackle_duels: bool = False) -> list[Column]:
    own = F.col("team_id") == F.col(f"{side}_team_id")
    ty = F.col("type_name")
    shot = own & (ty == "Shot")
    pas, car = own & (ty == "Pass"), own & (ty == "Carry")
    poss = own & ty.isin(*fb.POSSESSION_TYPES)
    def_types = ty.isin(*fb.PPDA_TYPES)
    if include_tackle_duels:
        def_types = def_types | ((ty == "Duel") & (F.col("duel_type") == "Tackle"))
    dfa = own & def_types & (F.col("loc_x") > 40)
    clear = own & (ty == "Clearance")
    out = F.col("shot_outcome")
    s = f"{side}_"
    return [
        F.count_if(shot).alias(s + "shots_total"),
        F.count_if(shot & out.isin("Goal", "Saved")).alias(s + "shots_on_target"),
        F.count_if(shot & (out == "Goal")).alias(s + "goals_scored"),
        F.sum(F.when(shot, F.col("shot_xg"))).alias(s + "xg"),
        F.avg(F.when(shot, F.col("shot_xg"))).alias(s + "xg_per_shot"),
        F.avg(F.when(shot, F.col("distance_to_goal"))).alias(s + "avg_shot_distance"),
        F.count_if(shot & (F.col("pitch_zone") == "attacking_third")).alias(s + "shots_from_att_third"),
        F.count_if(shot & (F.col("shot_type") == "Penalty")).alias(s + "penalties"),
        F.count_if(shot & (F.col("shot_body_part") == "Head")).alias(s + "headers"),
        F.count_if(poss).alias(s + "poss_events"),
        F.count_if(pas).alias(s + "passes"),
        F.count_if(dfa).alias(s + "def_actions_high"),
        F.count_if(pas | car).alias(s + "prog_actions"),
        F.count_if(pas & (F.col("pass_end_x") - F.col("loc_x") >= 10) & (F.col("pass_end_x") > 60)).alias(s + "prog_passes"),
        F.count_if(car & (F.col("carry_end_x") - F.col("loc_x") >= 5) & (F.col("carry_end_x") > 60)).alias(s + "prog_carries"),
        F.count_if((pas | car) & fb.is_true("pass_cross")).alias(s + "crosses"),
        F.avg(F.when(pas | car, F.col("pass_length"))).alias(s + "avg_pass_length"),
        F.avg(F.when(clear, F.col("loc_x"))).alias(s + "avg_defensive_line_x"),
        F.count_if(clear).alias(s + "clearances"),
    ]


def match_side_measures(timeline: DataFrame, include_tackle_duels: bool = False) -> DataFrame:
    """One row per match with every measure for the home and the away side."""
    t = with_optional(timeline, {"pass_cross": "boolean", "pass_length": "double", "pass_end_x": "double",
                                 "carry_end_x": "double", "duel_type": "string"})
    return t.groupBy("match_id").agg(
        *_side_measures("home", include_tackle_duels), *_side_measures("away", include_tackle_duels)
    )


def _team_row(side: str, other: str) -> Column:
    s, o = f"{side}_", f"{other}_"

    def m(name: str, prefix: str = s) -> Column:
        return F.col(prefix + name)

    def z(col: Column) -> Column:
        return F.coalesce(col, F.lit(0))

    poss_total = z(m("poss_events")) + z(m("poss_events", o))
    fields = [
        m("team_id").alias("team_id"), m("team_name").alias("team_name"),
        z(m("shots_total")).alias("shots_total"),
        z(m("shots_on_target")).alias("shots_on_target"),
        z(m("goals_scored")).alias("goals_scored"),
        F.coalesce(m("xg"), F.lit(0.0)).alias("xg"),
        m("xg_per_shot").alias("xg_per_shot"),
        m("avg_shot_distance").alias("avg_shot_distance"),
        z(m("shots_from_att_third")).alias("shots_from_att_third"),
        z(m("penalties")).alias("penalties"),
        z(m("headers")).alias("headers"),
        F.coalesce(m("xg", o), F.lit(0.0)).alias("xga"),
        z(m("goals_scored", o)).alias("goals_conceded"),
        F.when(z(m("poss_events")) > 0, rnd(m("poss_events") / poss_total * 100, 1)).alias("possession_pct"),
        F.when((z(m("passes", o)) > 0) & (z(m("def_actions_high")) > 0),
               rnd(m("passes", o) / m("def_actions_high"), 2)).alias("ppda"),
        F.when(z(m("prog_actions")) > 0, m("prog_passes")).alias("progressive_passes"),
        F.when(z(m("prog_actions")) > 0, m("prog_carries")).alias("progressive_carries"),
        F.when(z(m("prog_actions")) > 0, m("crosses")).alias("crosses"),
        m("avg_pass_length").alias("avg_pass_length"),
        m("avg_defensive_line_x").alias("avg_defensive_line_x"),
        F.when(z(m("clearances")) > 0, m("clearances")).alias("clearances"),
        F.lit(side == "home").alias("is_home"),
    ]
    return F.struct(*fields)


def team_performance(timeline: DataFrame, matches: DataFrame, include_tackle_duels: bool = False) -> DataFrame:
    """One row per (match, team) for both teams of every match, with W/D/L."""
    per_match = match_side_measures(timeline, include_tackle_duels)
    spine = matches.select(
        "match_id", "match_date", "competition_id", "season_id", "stage_name",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
    ).withColumnsRenamed({"home_team_name": "home_team_name_", "away_team_name": "away_team_name_"})
    j = spine.join(per_match, "match_id", "left").withColumnsRenamed(
        {"home_team_name_": "home_team_name", "away_team_name_": "away_team_name"}
    )
    ctx = ["match_id", "match_date", "competition_id", "season_id", "stage_name",
           "home_team_id", "home_team_name", "away_team_id", "away_team_name"]
    stacked = j.select(*ctx, F.explode(F.array(_team_row("home", "away"), _team_row("away", "home"))).alias("t"))
    out = stacked.select(*ctx, "t.*")
    return out.withColumn("result", fb.outcome_letter("goals_scored", "goals_conceded"))
