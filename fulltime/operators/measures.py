"""Dashboard measures as single-pass aggregates: sums, safe ratios, filtered distinct counts, top-1 values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.functions.common import rnd


def measures_scorers(scorers: DataFrame) -> DataFrame:
    """Total goals and xG, goals above xG, conversion % (0 when no shots), players with a goal."""
    g = scorers.agg(
        F.sum("goals").alias("total_goals"),
        rnd(F.sum("xg_total"), 2).alias("total_xg"),
        F.sum("shots_total").alias("_shots"),
        F.count_distinct(F.when(F.col("goals") >= 1, F.col("player_name"))).alias("scorers_with_goals"),
    )
    return g.select(
        "total_goals", "total_xg", rnd(F.col("total_goals") - F.col("total_xg"), 2).alias("goals_above_xg"),
        (F.coalesce(F.try_divide(F.col("total_goals").cast("double"), F.col("_shots")), F.lit(0.0)) * 100)
        .alias("conversion_pct"),
        "scorers_with_goals")


def measures_style(style: DataFrame) -> DataFrame:
    """Mean PPDA, teams with the high-press profile, mean and best xG difference per game."""
    return style.agg(
        F.avg("avg_ppda").alias("mean_ppda"),
        F.count_distinct(F.when(F.col("tactical_profile") == "PRESSING_ALTO", F.col("team_name"))).alias("high_press_teams"),
        F.avg("xg_diff_per_game").alias("mean_xg_diff"),
        F.max("xg_diff_per_game").alias("best_xg_diff"),
    )


def measures_xg(predictions: DataFrame, own: str = "our_xg", provider: str = "shot_xg") -> DataFrame:
    """Shots, mean own xG, agreement 1 - MAE with the provider, observed goal rate."""
    return predictions.agg(
        F.count("event_id").alias("total_shots"),
        F.avg(own).alias("mean_xg"),
        (F.lit(1.0) - F.avg(F.abs(F.col(own) - F.col(provider)))).alias("agreement"),
        F.try_divide(F.count_if(F.col("is_goal")).cast("double"), F.count("event_id")).alias("goal_rate"),
    )


def measures_predictor(predictions: DataFrame) -> DataFrame:
    """Accuracy, correct count, total matches, mean predicted home-win probability."""
    return predictions.agg(
        F.avg(F.col("correct").cast("double")).alias("accuracy"),
        F.count_if(F.col("correct") == 1).alias("correct_matches"),
        F.count("match_id").alias("total_matches"),
        F.avg("p_home_win").alias("mean_p_home_win"),
    )
