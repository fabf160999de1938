"""Shot context from freeze frames: nearest defender, keeper position, shooting cone, visible players.

Frames are the largest table (one row per visible player per event). Only frames of shots are
kept (inner join on the shot key, which also brings the shooter's location), and every frame
measure comes out of ONE aggregate by shot, joined back to the shots once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.functions import football as fb
from fulltime.operators.timeline import shots

SHOT_KEY = ["event_id", "match_id"]
SHOT_COLUMNS = (
    "event_id", "match_id", "minute", "second", "period", "player_id", "player_name", "team_id", "team_name",
    "loc_x", "loc_y", "shot_xg", "shot_outcome", "shot_technique", "shot_body_part", "shot_type", "shot_first_time",
    "shot_one_on_one", "distance_to_goal",
    "angle_to_goal", "pitch_zone", "under_pressure", "score_home_at_event", "score_away_at_event",
    "score_diff_at_event", "is_home_team", "match_date", "stage_name", "competition_id", "season_id",
)


def shot_frames(shot_rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Frames of the given shots with the shooter location attached (one-to-many)."""
    loc = shot_rows.select(*SHOT_KEY, F.col("loc_x").alias("shot_x"), F.col("loc_y").alias("shot_y"))
    f = frames.select(*SHOT_KEY, F.col("loc_x").alias("ff_x"), F.col("loc_y").alias("ff_y"),
                      "is_teammate", "is_actor", "is_keeper")
    return f.join(loc, SHOT_KEY)


def frame_measures(sf: DataFrame) -> DataFrame:
    """Per shot: nearest outfield opponent, keeper distances, cone count, visible team-mates and players."""
    opp = ~fb.is_true("is_teammate") & ~fb.is_true("is_actor")
    keeper = fb.is_true("is_keeper")
    dist = fb.euclid("shot_x", "shot_y", "ff_x", "ff_y")
    in_cone = (
        opp & ~keeper & (F.col("ff_x") > F.col("shot_x")) & (F.col("ff_x") <= fb.GOAL_X)
        & (F.col("ff_y") >= fb.POST_LEFT_Y - 2) & (F.col("ff_y") <= fb.POST_RIGHT_Y + 2)
    )
    return sf.groupBy(*SHOT_KEY).agg(
        F.min(F.when(opp & ~keeper, dist)).alias("distance_nearest_defender"),
        F.min(F.when(opp & keeper, dist)).alias("gk_distance_to_shooter"),
        F.avg(F.when(opp & keeper, F.abs(F.lit(fb.GOAL_X) - F.col("ff_x")))).alias("gk_distance_to_goalline"),
        F.count_if(in_cone).alias("defenders_in_cone"),
        F.count_if(fb.is_true("is_teammate") & ~fb.is_true("is_actor")).alias("teammates_visible"),
        F.count(F.lit(1)).alias("total_players_visible"),
    )


def shot_map(timeline: DataFrame, frames: DataFrame) -> DataFrame:
    """Every shot with provider xG, its frame context (zero counts without frames) and flags."""
    s = shots(timeline)
    s = s.select(*[x for x in SHOT_COLUMNS if x in s.columns])
    m = frame_measures(shot_frames(s, frames))
    out = s.join(m, SHOT_KEY, "left")
    out = out.fillna(0, subset=["defenders_in_cone", "teammates_visible", "total_players_visible"])
    return out.select(
        "*",
        F.col("distance_nearest_defender").isNotNull().alias("has_360_data"),
        F.coalesce(F.col("shot_outcome") == "Goal", F.lit(False)).alias("is_goal"),
    )


def frames_of(frames: DataFrame, keys: DataFrame) -> DataFrame:
    """Frames whose (event, match) key is in ``keys`` (semi join; no driver loop over keys)."""
    return frames.join(keys.select(*SHOT_KEY), SHOT_KEY, "left_semi")
