"""Football column expressions: pitch geometry, classifications, results and rating formulas.

Pitch is 120 x 80 with the attacked goal at (120, 40) and posts at y = 36 and y = 44.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fulltime.functions.common import c, rnd

# Fixed values that results depend on (pitch geometry).
GOAL_X = 120.0
GOAL_Y = 40.0
POST_LEFT_Y = 36.0
POST_RIGHT_Y = 44.0

# Event types kept in the timeline.
TIMELINE_TYPES = (
    "Pass", "Shot", "Carry", "Pressure", "Duel", "Interception", "Clearance", "Block", "Goal Keeper",
    "Foul Committed", "Foul Won", "Dribble", "Dispossessed", "Miscontrol", "Ball Recovery", "Substitution",
    "Tactical Shift", "Starting XI", "Offside", "Shield",
)

# Event types that count as a ball action for possession share.
POSSESSION_TYPES = ("Pass", "Carry", "Dribble", "Shot", "Ball Recovery")

# Defensive actions counted for PPDA (Tackle is a duel type, not an event type).
PPDA_TYPES = ("Pressure", "Interception", "Tackle", "Block")


def distance_to_goal(x: str | Column = "loc_x", y: str | Column = "loc_y") -> Column:
    """Euclidean distance to the centre of the attacked goal; null without a location."""
    return F.sqrt((F.lit(GOAL_X) - c(x)) ** 2 + (F.lit(GOAL_Y) - c(y)) ** 2)


def angle_to_goal(x: str | Column = "loc_x", y: str | Column = "loc_y") -> Column:
    """Angle in degrees between the goal line normal and the line to the goal centre."""
    return F.degrees(F.atan2(F.abs(F.lit(GOAL_Y) - c(y)), F.abs(F.lit(GOAL_X) - c(x))))


def pitch_zone(x: str | Column = "loc_x") -> Column:
    """Thirds split at x = 40 and x = 80; null location gives null."""
    x = c(x)
    return (
        F.when(x < 40, "defensive_third").when(x < 80, "middle_third").when(x >= 80, "attacking_third")
    )


def euclid(x1: str | Column, y1: str | Column, x2: str | Column, y2: str | Column) -> Column:
    return F.sqrt((c(x2) - c(x1)) ** 2 + (c(y2) - c(y1)) ** 2)


def is_true(col: str | Column) -> Column:
    """Flag test where an absent (null) flag means false."""
    return F.coalesce(c(col), F.lit(False))


def position_class(position: str | Column = "position") -> Column:
    """GK / DEF / MID / ATT from a position code; anything unmatched falls to MID."""
    p = c(position)
    return (
        F.when(p.contains("GK"), "GK")
        .when(p.rlike("CB|RB|LB|WB|RWB|LWB|DEF"), "DEF")
        .when(p.rlike("CDM|CM|CAM|RM|LM|MID"), "MID")
        .when(p.rlike("RW|LW|CF|ST|ATT"), "ATT")
        .otherwise("MID")
    )


def stage_ordinal(stage: str | Column = "stage_name") -> Column:
    """Stage to 1..7 as used by match features (exact group label first, then substrings)."""
    s = c(stage)
    return (
        F.when(s == "Group Stage", 1).when(s.contains("32"), 2).when(s.contains("16"), 3)
        .when(s.contains("Quarter"), 4).when(s.contains("Semi"), 5).when(s.contains("3rd"), 6)
        .when(s.contains("Final"), 7).otherwise(1)
    )


def stage_reached(stage: str | Column = "stage_name") -> Column:
    """Stage to 1..7 as used by standings (Final first, excluding the third-place final)."""
    s = c(stage)
    return (
        F.when(s.contains("Final") & ~s.contains("3rd"), 7).when(s.contains("3rd"), 6).when(s.contains("Semi"), 5)
        .when(s.contains("Quarter"), 4).when(s.contains("16"), 3).when(s.contains("32"), 2).otherwise(1)
    )


# Label of each stage ordinal.
STAGE_LABELS = {7: "Final", 6: "3rd Place", 5: "Semi-finals", 4: "Quarter-finals", 3: "Round of 16",
                2: "Round of 32", 1: "Group Stage"}


def stage_label(ordinal: str | Column) -> Column:
    o = c(ordinal)
    expr = F.when(o == 7, STAGE_LABELS[7])
    for k in (6, 5, 4, 3, 2):
        expr = expr.when(o == k, STAGE_LABELS[k])
    return expr.otherwise(STAGE_LABELS[1])


def outcome_sign(gf: str | Column, ga: str | Column) -> Column:
    """1 win, 0 draw, -1 loss."""
    return F.when(c(gf) > c(ga), 1).when(c(gf) == c(ga), 0).otherwise(-1)


def outcome_letter(gf: str | Column, ga: str | Column) -> Column:
    return F.when(c(gf) > c(ga), "W").when(c(gf) == c(ga), "D").otherwise("L")


def points(result: str | Column) -> Column:
    r = c(result)
    return F.when(r == "W", 3).when(r == "D", 1).otherwise(0)


def expected_score(r_self: str | Column, r_other: str | Column) -> Column:
    """Rating win expectancy ``1 / (1 + 10^((other - self) / 400))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), (c(r_other) - c(r_self)) / F.lit(400.0)))


def k_factor(round_name: str | Column) -> Column:
    """K = 60 for final/semi/third/quarter rounds (any round containing "final"), 55 for last 32/16, else 50."""
    r = F.lower(c(round_name))
    return F.when(r.rlike("final|semi|third|quarter"), 60).when(r.rlike("round of 16|round of 32|last 16"), 55).otherwise(50)


def elo_wdl(r_home: str | Column, r_away: str | Column) -> tuple[Column, Column, Column]:
    """(home win, draw, away win) probabilities from two ratings; draw clamped to [0.15, 0.30]."""
    p = F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(10.0), -(c(r_home) - c(r_away)) / F.lit(400.0)))
    draw = F.greatest(F.lit(0.15), F.least(F.lit(0.30), F.lit(0.26) * (F.lit(1.0) - F.abs(p - 0.5) * 1.5)))
    return p * (F.lit(1.0) - draw), draw, (F.lit(1.0) - p) * (F.lit(1.0) - draw)


def tactical_profile(ppda: str | Column, possession: str | Column, prog_passes: str | Column,
                     xg_per_game: str | Column, line_x: str | Column) -> Column:
    """Five-way ordered style rule; the first matching rule wins."""
    ppda, poss, prog, xg, line = c(ppda), c(possession), c(prog_passes), c(xg_per_game), c(line_x)
    return (
        F.when((ppda < 8) & (poss > 50), "PRESSING_ALTO")
        .when((poss >= 58) & (prog >= 20), "POSSE_DOMINANTE")
        .when((poss < 45) & (xg >= 1.2), "CONTRA_ATAQUE")
        .when((ppda > 14) & line.isNotNull() & (line < 45), "BLOCO_BAIXO")
        .otherwise("EQUILIBRADO")
    )


def dominance(xg_diff_per_game: str | Column, possession: str | Column, ppda: str | Column) -> Column:
    """``0.4 xG diff + 0.02 (possession - 50) + 0.03 (20 - PPDA)`` (PPDA term 0 when unknown), 3 decimals."""
    ppda = c(ppda)
    return rnd(
        c(xg_diff_per_game) * 0.4 + (c(possession) - 50) * 0.02
        + F.when(ppda.isNotNull(), (20 - ppda) * 0.03).otherwise(F.lit(0)),
        3,
    )


def xg_points(xg_for: str | Column, xg_against: str | Column, matches: str | Column) -> Column:
    """Points a team deserved by xG share: ``xGf / (xGf + xGa) * n * 3``, 1 decimal."""
    return rnd(F.try_divide(c(xg_for), c(xg_for) + c(xg_against)) * c(matches) * 3, 1)


def squad_risk(veteran_pct: str | Column, avg_overall: str | Column, form_ppg: str | Column) -> Column:
    """``0.3 veteran% + 0.4 (100 - overall) + 3 (3 - ppg)`` with defaults 75 and 1.5, 2 decimals."""
    return rnd(
        c(veteran_pct) * 0.3 + (100 - F.coalesce(c(avg_overall), F.lit(75))) * 0.4
        + (3 - F.coalesce(c(form_ppg), F.lit(1.5))) * 10 * 0.3,
        2,
    )


# Confederations of countries by name.
CONFEDERATIONS = {
    "CONMEBOL": ("Brazil", "Argentina", "Uruguay", "Colombia", "Ecuador", "Chile", "Peru", "Bolivia", "Venezuela", "Paraguay"),
    "UEFA": ("France", "England", "Spain", "Germany", "Portugal", "Netherlands", "Belgium", "Italy", "Croatia", "Denmark", "Switzerland", "Poland",
             "Serbia", "Austria", "Czech Republic", "Romania"),
    "CONCACAF": ("USA", "Mexico", "Canada", "Honduras", "Panama"),
    "CAF": ("Morocco", "Senegal", "Nigeria", "Cameroon", "Egypt", "Ghana", "Algeria", "Ivory Coast"),
    "AFC": ("Japan", "South Korea", "Saudi Arabia", "Iran", "Australia", "Iraq", "Jordan", "Qatar"),
}


def confederation_of(country: Column) -> Column:
    """Confederation of a country by name, OTHER for one that isn't listed (or null)."""
    out = F.lit("OTHER")
    for name, countries in CONFEDERATIONS.items():
        out = F.when(country.isin(*countries), name).otherwise(out)
    return out
