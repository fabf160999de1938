"""Event timeline: type filter, match attributes, per-event geometry and running score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fulltime.functions import football as fb

# Match attributes carried onto every event (those that the match table has).
MATCH_ATTRS = (
    "match_id", "match_date", "competition_id", "competition_name", "competition_label", "season_id", "season_name", "stage_name", "stadium_name",
    "home_team_id", "home_team_name", "away_team_id", "away_team_name", "home_score", "away_score",
)


def keep_types(events: DataFrame, types: Sequence[str] = fb.TIMELINE_TYPES) -> DataFrame:
    """Keep the analytically significant event types (drops camera, stoppage and receipt rows)."""
    return events.filter(F.col("type_name").isin(list(types)))


def shots(df: DataFrame, with_xg: bool = True) -> DataFrame:
    """Shot events, by default only those that carry a provider xG."""
    cond = F.col("type_name") == "Shot"
    if with_xg:
        cond = cond & F.col("shot_xg").isNotNull()
    return df.filter(cond)


def goals(df: DataFrame) -> DataFrame:
    return df.filter((F.col("type_name") == "Shot") & (F.col("shot_outcome") == "Goal"))


def attach_match(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Left join of events to match attributes on ``match_id``.

    No broadcast hint: the match table grows with the data, so Spark decides from its size
    statistics (and AQE from the runtime size) whether the build side is small enough.
    """
    m = matches.select(*[x for x in MATCH_ATTRS if x in matches.columns])
    m = m.withColumnsRenamed({"home_score": "match_home_score_ft", "away_score": "match_away_score_ft"})
    ev = events.drop(*[x for x in m.columns if x != "match_id" and x in events.columns])
    return ev.join(m, "match_id", "left")


RUNNING_CHUNK = 50_000  # events per chunk of the running-score prefix sum
#: Chunk of the events without an index.
NO_INDEX = -(2**62)


def _chunk_of(order: str, chunk: int) -> Column:
    return F.coalesce(F.floor(F.col(order) / chunk), F.lit(NO_INDEX))


def _in_chunk(df: DataFrame, order: str, inclusive: bool) -> WindowSpec:
    """Rows of a chunk up to the current one: by index, those without one first and by event id."""
    by = [order, *(["event_id"] if "event_id" in df.columns else [])]
    return Window.partitionBy("match_id", "_chunk").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)


def _same_chunk(events: DataFrame, context: DataFrame, how: str) -> DataFrame:
    """Events joined to what their (match, chunk) has; a null match is a match like any other."""
    c = context.withColumnsRenamed({"match_id": "_match", "_chunk": "_of"})
    return events.join(c, F.col("match_id").eqNullSafe(F.col("_match")) & (F.col("_chunk") == F.col("_of")), how).drop("_match", "_of")


def running_score(df: DataFrame, inclusive: bool = True, order: str = "event_index",
                  chunk: int = RUNNING_CHUNK) -> DataFrame:
    """Score of both sides at every event, in event order within the match.

    ``inclusive=True`` counts the current event's goal; ``inclusive=False`` gives the state
    before the event (what a model may use without seeing its target).

    A chunked prefix sum, so one very long match is not one window buffer: events are cut into
    chunks of ``chunk`` consecutive indexes; the running sum inside (match, chunk) is added to the
    goals of the match's earlier chunks, which come from a small per-chunk aggregate.

    Every event stays: those without an index come first in their match (by event id), those without a match
    are one group.
    """
    goal = (F.col("type_name") == "Shot") & (F.col("shot_outcome") == "Goal")
    is_home = F.coalesce(F.col("team_id") == F.col("home_team_id"), F.lit(False))
    d = df.select("*", F.when(goal & is_home, 1).otherwise(0).alias("_hg"),
                  F.when(goal & ~is_home, 1).otherwise(0).alias("_ag"),
                  _chunk_of(order, chunk).alias("_chunk"))
    totals = d.groupBy("match_id", "_chunk").agg(F.sum("_hg").alias("_ch"), F.sum("_ag").alias("_ca"))
    before = Window.partitionBy("match_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("match_id", "_chunk", F.coalesce(F.sum("_ch").over(before), F.lit(0)).alias("_oh"),
                            F.coalesce(F.sum("_ca").over(before), F.lit(0)).alias("_oa"))
    w = _in_chunk(d, order, inclusive)
    j = _same_chunk(d, offsets, "inner")
    home = (F.col("_oh") + F.coalesce(F.sum("_hg").over(w), F.lit(0))).cast("int")
    away = (F.col("_oa") + F.coalesce(F.sum("_ag").over(w), F.lit(0))).cast("int")
    return (
        j.withColumn("score_home_at_event", home)
        .withColumn("score_away_at_event", away)
        .withColumn("score_diff_at_event", F.col("score_home_at_event") - F.col("score_away_at_event"))
        .drop("_hg", "_ag", "_chunk", "_oh", "_oa")
    )


def with_geometry(df: DataFrame) -> DataFrame:
    """Distance and angle to goal and pitch third, null where the event has no location."""
    has_loc = F.col("loc_x").isNotNull() & F.col("loc_y").isNotNull()
    return df.select(
        "*",
        F.when(has_loc, fb.distance_to_goal()).alias("distance_to_goal"),
        F.when(has_loc, fb.angle_to_goal()).alias("angle_to_goal"),
        fb.pitch_zone().alias("pitch_zone"),
    )


def _chunk_context(events: DataFrame, matches: DataFrame, chunk: int, order: str) -> DataFrame:
    """Per (match, chunk of events): match attributes and both sides' goals in the match's earlier chunks.

    One pass over five event columns counts goals by (match, chunk, team); what follows is small.
    """
    goal = (F.col("type_name") == "Shot") & (F.col("shot_outcome") == "Goal")
    by_team = events.groupBy("match_id", _chunk_of(order, chunk).alias("_chunk"), "team_id").agg(F.count_if(goal).alias("_goals"))
    home = F.coalesce(F.col("team_id") == F.col("home_team_id"), F.lit(False))
    sides = by_team.join(matches.select("match_id", "home_team_id"), "match_id", "left").groupBy("match_id", "_chunk").agg(
        F.sum(F.when(home, F.col("_goals")).otherwise(0)).alias("_h"), F.sum(F.when(~home, F.col("_goals")).otherwise(0)).alias("_a"))
    before = Window.partitionBy("match_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sides.select("match_id", "_chunk", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_o{c}") for c in ("_h", "_a")])
    return attach_match(sums, matches)


def _scored(events: DataFrame, matches: DataFrame, inclusive: bool, chunk: int = RUNNING_CHUNK, order: str = "event_index") -> DataFrame:
    """Events with match attributes and the running score, in ONE shuffle of the events, by (match, chunk).

    The match side is spread over its chunks before the join, so a match with very many events is many
    groups, and the window inside a chunk needs no shuffle of its own.
    """
    context = _chunk_context(events, matches, chunk, order)
    ev = events.drop(*[c for c in context.columns if c != "match_id" and c in events.columns])
    j = _same_chunk(ev.withColumn("_chunk", _chunk_of(order, chunk)), context, "left")
    goal = (F.col("type_name") == "Shot") & (F.col("shot_outcome") == "Goal")
    home = F.coalesce(F.col("team_id") == F.col("home_team_id"), F.lit(False))
    w = _in_chunk(j, order, inclusive)
    score = {f"score_{side}_at_event": (F.coalesce(F.col(f"_o_{side[0]}"), F.lit(0)) + F.coalesce(
        F.sum(F.when(goal & own, 1).otherwise(0)).over(w), F.lit(0))).cast("int") for side, own in (("home", home), ("away", ~home))}
    return (j.withColumns(score).withColumn("score_diff_at_event", F.col("score_home_at_event") - F.col("score_away_at_event"))
            .drop("_chunk", "_o_h", "_o_a"))


def match_timeline(events: DataFrame, matches: DataFrame, inclusive: bool = True, with_score: bool = True) -> DataFrame:
    """Conformed event timeline: kept types, match context, geometry, home flag, running score
    (``with_score=False`` skips the running score for consumers that do not read it)."""
    kept = keep_types(events)
    tl = _scored(kept, matches, inclusive) if with_score else attach_match(kept, matches)
    return with_geometry(tl).withColumn("is_home_team", F.coalesce(F.col("team_id") == F.col("home_team_id"), F.lit(False)))
