"""Player x match statistics as ONE conditional aggregate over the timeline.

Shots, passes, pressures, carries, duels, discipline and minutes are measured in a single
``groupBy``: one scan and one shuffle (none when the timeline is already partitioned by match),
instead of one aggregate per event family joined back together.

Null convention: a family's counts are 0 for a player without events of that family only for
the 22 zero-filled measures; means, percentages and the other counts stay null, as before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulltime.functions import football as fb
from fulltime.functions.common import pct, with_optional

# Optional event columns: absent ones are read as typed nulls (flags then count as false).
OPTIONAL_EVENT_COLUMNS = {
    "shot_first_time": "boolean", "shot_one_on_one": "boolean", "shot_technique": "string",
    "pass_switch": "boolean", "pass_through_ball": "boolean", "pass_xa": "double", "pass_cross": "boolean",
    "pass_shot_assist": "boolean", "pass_goal_assist": "boolean", "pass_type": "string", "pass_length": "double",
    "pass_end_x": "double", "carry_end_x": "double", "carry_end_y": "double", "foul_card": "string",
    "counterpress": "boolean", "duel_type": "string", "duel_outcome": "string", "position_name": "string",
}

PLAYER_KEYS = ("match_id", "player_id", "player_name", "team_id", "team_name", "competition_id", "season_id")
PLAYER_CONTEXT = (
    "match_date", "stage_name", "home_team_name", "away_team_name", "is_home_team",
    "match_home_score_ft", "match_away_score_ft",
)


def _n(cond: Column) -> Column:
    return F.count_if(cond)


def player_match_stats(timeline: DataFrame) -> DataFrame:
    """One row per (match, player): 40+ measures from a single grouped aggregate."""
    t = with_optional(timeline, OPTIONAL_EVENT_COLUMNS).filter(F.col("player_id").isNotNull())
    ty = F.col("type_name")
    shot, pas, prs, car, duel = (ty == "Shot"), (ty == "Pass"), (ty == "Pressure"), (ty == "Carry"), (ty == "Duel")
    misc = ty.isin("Interception", "Foul Committed", "Foul Won")
    out = F.col("shot_outcome")
    prog_pass = pas & (F.col("pass_end_x") - F.col("loc_x") >= 10) & (F.col("pass_end_x") > 60)
    prog_carry = car & (F.col("carry_end_x") - F.col("loc_x") >= 5) & (F.col("carry_end_x") > 60)
    carry_dist = fb.euclid("loc_x", "loc_y", "carry_end_x", "carry_end_y")
    keys = [k for k in PLAYER_KEYS + PLAYER_CONTEXT if k in t.columns]
    agg = t.groupBy(*keys).agg(
        _n(shot).alias("shots_total"),
        _n(shot & (out == "Goal")).alias("goals"),
        _n(shot & out.isin("Goal", "Saved")).alias("shots_on_target"),
        F.coalesce(F.sum(F.when(shot, F.col("shot_xg"))), F.lit(0.0)).alias("xg_total"),
        F.avg(F.when(shot, F.col("shot_xg"))).alias("xg_per_shot"),
        _n(shot & fb.is_true("shot_first_time")).alias("_first_time"),
        _n(shot & fb.is_true("shot_one_on_one")).alias("_one_on_one"),
        _n(shot & (F.col("shot_body_part") == "Head")).alias("_head"),
        _n(shot & (F.col("shot_type") == "Penalty")).alias("_pen"),
        _n(shot & (F.col("shot_type") == "Penalty") & (out == "Goal")).alias("_pen_goal"),
        F.avg(F.when(shot, F.col("distance_to_goal"))).alias("avg_shot_distance"),
        F.avg(F.when(shot, F.col("angle_to_goal"))).alias("avg_shot_angle"),
        _n(pas).alias("passes_total"),
        _n(pas & F.col("pass_outcome").isNull()).alias("passes_complete"),
        F.coalesce(F.sum(F.when(pas, F.col("pass_xa"))), F.lit(0.0)).alias("xa_total"),
        _n(pas & fb.is_true("pass_shot_assist")).alias("key_passes"),
        _n(pas & fb.is_true("pass_goal_assist")).alias("assists"),
        _n(pas & fb.is_true("pass_cross")).alias("_crosses"),
        _n(pas & fb.is_true("pass_switch")).alias("_switches"),
        _n(pas & fb.is_true("pass_through_ball")).alias("_through"),
        _n(pas & (F.col("pass_type") == "Corner")).alias("_corners"),
        _n(pas & (F.col("pass_type") == "Free Kick")).alias("_free_kicks"),
        _n(prog_pass).alias("_prog_passes"),
        F.avg(F.when(pas, F.col("pass_length"))).alias("avg_pass_length"),
        _n(prs).alias("pressures_total"),
        _n(prs & (F.col("pitch_zone") == "attacking_third")).alias("pressures_high"),
        _n(prs & fb.is_true("counterpress")).alias("counterpresses"),
        _n(car).alias("carries_total"),
        _n(prog_carry).alias("progressive_carries"),
        F.sum(F.when(car, carry_dist)).alias("carry_distance_total"),
        _n(duel).alias("duels_total"),
        _n(duel & F.col("duel_outcome").isin("Won", "Success")).alias("duels_won"),
        _n(duel & (F.col("duel_type") == "Tackle")).alias("tackles"),
        _n(ty == "Interception").alias("interceptions"),
        _n(ty == "Foul Committed").alias("fouls_committed"),
        _n(ty == "Foul Won").alias("fouls_won"),
        _n(misc & (F.col("foul_card") == "Yellow Card")).alias("yellow_cards"),
        _n(misc & F.col("foul_card").isin("Red Card", "Second Yellow")).alias("red_cards"),
        F.max("minute").alias("last_minute_seen"),
    )

    def when_any(total: str, col: str) -> Column:
        return F.when(F.col(total) > 0, F.col(col))

    return agg.select(
        *keys,
        "shots_total", "goals", "shots_on_target", "xg_total", "xg_per_shot",
        when_any("shots_total", "_first_time").alias("shots_first_time"),
        when_any("shots_total", "_one_on_one").alias("shots_one_on_one"),
        when_any("shots_total", "_head").alias("headed_shots"),
        when_any("shots_total", "_pen").alias("penalties_taken"),
        when_any("shots_total", "_pen_goal").alias("penalties_scored"),
        "avg_shot_distance", "avg_shot_angle",
        "passes_total", "passes_complete", "xa_total", "key_passes", "assists",
        when_any("passes_total", "_crosses").alias("crosses"),
        when_any("passes_total", "_switches").alias("switches"),
        when_any("passes_total", "_through").alias("through_balls"),
        when_any("passes_total", "_corners").alias("corners"),
        when_any("passes_total", "_free_kicks").alias("free_kicks"),
        when_any("passes_total", "_prog_passes").alias("progressive_passes"),
        "avg_pass_length",
        pct("passes_complete", "passes_total").alias("pass_completion_pct"),
        "pressures_total", "pressures_high", "counterpresses",
        pct("pressures_high", "pressures_total").alias("pressure_high_pct"),
        "carries_total", "progressive_carries", "carry_distance_total",
        "duels_total", "duels_won", "tackles",
        pct("duels_won", "duels_total").alias("duel_win_pct"),
        "interceptions", "fouls_committed", "fouls_won", "yellow_cards", "red_cards",
        "last_minute_seen",
    )


def attach_lineup(stats: DataFrame, lineups: DataFrame) -> DataFrame:
    """Position and shirt number from line-ups, one row per (match, player) kept deterministically."""
    from fulltime.operators.ranking import top_k_per_group

    cols = [x for x in ("position_name", "jersey_number", "country_name") if x in lineups.columns]
    one = top_k_per_group(
        lineups.select("match_id", "player_id", *cols), ["match_id", "player_id"],
        [F.col(x).asc_nulls_last() for x in cols] or [F.col("player_id")], 1, ["match_id", "player_id"],
    )
    return stats.drop(*[x for x in cols if x in stats.columns]).join(one, ["match_id", "player_id"], "left")


def attach_club_stats(stats: DataFrame, club: DataFrame, name_col: str = "player_name",
                      fold_accents: bool = False) -> DataFrame:
    """Best-effort name join to club season stats; the club row kept per name is the one with most minutes.

    Ties go by club, league, spelling and all other columns in turn, so the row doesn't hang on the input's order.
    A name with very many rows is split over all of these."""
    from fulltime.operators.ranking import top_k_per_group

    def norm(col: Column) -> Column:
        x = F.lower(F.trim(col))
        if fold_accents:
            x = F.translate(x, "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")
        return x

    order = [F.col("minutes").desc_nulls_last()] if "minutes" in club.columns else []
    first = [c for c in ("club", "league", name_col) if c in club.columns]
    rest = first + [c for c in club.columns if c not in (*first, "minutes")]
    c2 = club.withColumn("_name_key", norm(F.col(name_col)))
    best = top_k_per_group(c2, ["_name_key"], order + [F.col(c).asc_nulls_last() for c in rest], 1, rest + ["minutes"] * bool(order))
    best = best.drop(name_col)
    return stats.withColumn("_name_key", norm(F.col("player_name"))).join(best, "_name_key", "left").drop("_name_key")
