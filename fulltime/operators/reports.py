"""Sanity and analysis reports: grouped counts, HAVING filters and ordered top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.functions.common import rnd
from fulltime.operators.quantiles import exact_quantiles


def report_by(shot_map: DataFrame, key: str, min_shots: int = 0, with_distance: bool = False) -> DataFrame:
    """Shots, goals, mean and total xG and conversion % per value of ``key`` (HAVING shots >= min)."""
    goals = F.sum(F.col("is_goal").cast("int")).cast("bigint")
    aggs = [F.count(F.lit(1)).alias("shots"), goals.alias("goals"), F.avg("shot_xg").alias("xg_mean"),
            F.sum("shot_xg").alias("xg_total")]
    if with_distance:
        aggs.append(F.avg("distance_to_goal").alias("avg_distance"))
    g = shot_map.groupBy(key).agg(*aggs)
    if min_shots:
        g = g.filter(F.col("shots") >= min_shots)
    return g.withColumn("conversion_pct", rnd(F.col("goals") / F.col("shots") * 100, 1))


def report_over_performers(shot_map: DataFrame, min_goals: int = 2) -> DataFrame:
    """Players whose goals exceed their summed xG, per edition, with at least ``min_goals`` goals."""
    g = shot_map.groupBy("competition_id", "season_id", "player_name", "team_name").agg(
        F.sum(F.col("is_goal").cast("int")).cast("bigint").alias("goals"),
        F.sum("shot_xg").alias("xg_expected"),
        F.count(F.lit(1)).alias("shots"),
    )
    return g.filter(F.col("goals") >= min_goals).withColumn(
        "goals_above_xg", rnd(F.col("goals") - F.col("xg_expected"), 2))


def profile_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row count per value combination."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def profile_distinct(df: DataFrame, by: Sequence[str], cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values of each column per group (exact, or HyperLogLog when ``approx``)."""
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    aggs = [f(c).alias(f"distinct_{c}") for c in cols] + [F.count(F.lit(1)).alias("rows")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def null_audit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and null count of every column in ONE pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols])


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min, quartiles and max per column, one row per column; quartiles are exact."""
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    quartiles = exact_quantiles(x, {c: (0.25, 0.5, 0.75) for c in cols})
    parts = [F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"), F.min(c).alias("min"),
                      *[F.lit(quartiles[c, q]).cast("double").alias(f"p{100 * q:.0f}") for q in (0.25, 0.5, 0.75)], F.max(c).alias("max")) for c in cols]
    return x.agg(F.array(*parts).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns (rows with a null in either column skipped), one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs]
    wide = df.agg(*aggs)
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                           F.col(f"{a}__{b}").alias("corr")) for a, b in pairs]))
    return wide.select(stacked.alias("p")).select("p.*")
