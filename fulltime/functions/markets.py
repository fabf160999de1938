"""Betting-market, weather and live-feed column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fulltime.functions.common import c

# Bookmaker margin applied to opening prices.
BOOK_MARGIN = 1.07

# WMO weather code -> description.
WEATHER_CODES = {
    0: "Clear sky", 1: "Mainly clear", 2: "Partly cloudy", 3: "Overcast",
    45: "Fog", 48: "Icy fog",
    51: "Light drizzle", 53: "Moderate drizzle", 55: "Dense drizzle",
    61: "Slight rain", 63: "Moderate rain", 65: "Heavy rain",
    71: "Slight snow", 73: "Moderate snow", 75: "Heavy snow",
    80: "Slight showers", 81: "Moderate showers", 82: "Violent showers",
    95: "Thunderstorm", 96: "Thunderstorm + hail", 99: "Thunderstorm + heavy hail",
}

# 16-point compass, clockwise from north.
COMPASS_POINTS = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE", "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]


def opening_odds(home_rank: str | Column, away_rank: str | Column) -> tuple[Column, Column, Column]:
    """1X2 opening prices from two world ranks: logistic home chance, clamped draw, 7 % margin."""
    diff = c(away_rank) - c(home_rank)
    p_home = F.lit(1.0) / (F.lit(1.0) + F.exp(-diff * 0.04))
    p_draw = F.greatest(F.lit(0.18), F.least(F.lit(0.30), F.lit(0.26) - F.abs(diff) * 0.003))
    p_away = F.lit(1.0) - p_home - p_draw
    return (F.round(F.lit(BOOK_MARGIN) / p_home, 2), F.round(F.lit(BOOK_MARGIN) / p_draw, 2),
            F.round(F.lit(BOOK_MARGIN) / p_away, 2))


def implied_probs(odd_h: str | Column, odd_d: str | Column, odd_a: str | Column) -> tuple[Column, Column, Column, Column]:
    """Probabilities normalised by the overround (4 decimals) and the margin itself."""
    inv_h, inv_d, inv_a = F.lit(1.0) / c(odd_h), F.lit(1.0) / c(odd_d), F.lit(1.0) / c(odd_a)
    total = inv_h + inv_d + inv_a
    return (F.round(inv_h / total, 4), F.round(inv_d / total, 4), F.round(inv_a / total, 4),
            F.round(total - 1, 4))


def over_under(goals_so_far: str | Column, minute: str | Column) -> tuple[Column, Column, Column]:
    """Over/under 2.5 goals: p_over from goals so far and minutes left, clamped to [0.05, 0.95]."""
    remaining = F.lit(90) - c(minute)
    p_over = F.least(F.lit(0.95), F.greatest(F.lit(0.05), F.lit(0.45) + c(goals_so_far) * 0.18 - remaining * 0.003))
    return p_over, F.round(F.lit(1.05) / p_over, 2), F.round(F.lit(1.05) / (F.lit(1.0) - p_over), 2)


def compass(degrees: str | Column) -> Column:
    """Degrees to a 16-point compass label; ``degrees / 22.5`` rounded half to even."""
    idx = F.pmod(F.bround(c(degrees) / 22.5, 0).cast("int"), F.lit(16))
    return F.element_at(F.array(*[F.lit(p) for p in COMPASS_POINTS]), idx + 1)


def weather_text(code: str | Column) -> Column:
    """Weather code description, "Unknown" when the code is not listed."""
    m = F.create_map(*[x for k, v in WEATHER_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, c(code).cast("int")), F.lit("Unknown"))


def normalise_event_type(raw: str | Column) -> Column:
    """Live feed event type: lower case, spaces to underscores, "unknown" when missing."""
    return F.coalesce(F.replace(F.lower(c(raw)), F.lit(" "), F.lit("_")), F.lit("unknown"))


def empty_to_null(col: str | Column) -> Column:
    return F.nullif(c(col), F.lit(""))
