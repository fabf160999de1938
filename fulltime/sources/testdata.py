"""Match-shaped stand-ins derived from the TPC-H-style test tables.

Each builder reads the given parquet tables and derives, with Spark SQL expressions
(``selectExpr``: one call parses a whole projection on the JVM side), the conformed inputs the
analytics expect: events, matches, freeze frames, historical results, squad ratings, form,
market values, odds and weather. They produce the same rows as the SQL views in
``fulltime.plans.fixture_sql``, so the DuckDB oracle sees the same inputs.

Nothing here shuffles except ``fx_match`` (one aggregate by match), ``fx_form`` (a join of
orders to customers; Spark picks the strategy from sizes) and ``fx_market`` (a split top-3).
Built plans are memoised per (session, folder): they are lazy plan objects, not cached data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulltime.operators.ranking import top_k_per_group
from fulltime.sources.event_columns import EXTRA, RARE_TYPE_SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_MEMO: dict[tuple, DataFrame] = {}


def session_key(spark: SparkSession) -> tuple:
    """Identity of a live session: a new session (or a restarted context) never reuses old plans."""
    return (id(spark), spark.sparkContext.applicationId)


def contents(spark: SparkSession, sf_dir: str) -> tuple:
    """What the files of a folder's tables are just now: names, sizes and times. New files are new contents."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(sf_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for name in TABLES:
        root = fs_path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        if fs.exists(root):
            out += [(str(f.getPath()), f.getLen(), f.getModificationTime()) for f in fs.listStatus(root)]
    return tuple(sorted(out))


def _memo(name: str):
    def deco(fn):
        def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (*session_key(spark), sf_dir.rstrip("/"), name)
            if key not in _MEMO:
                _MEMO[key] = fn(spark, sf_dir.rstrip("/"))
            return _MEMO[key]

        wrapper.__name__ = fn.__name__
        wrapper.__doc__ = fn.__doc__
        return wrapper

    return deco


def memo_plan(name: str):
    """Memoise a plan builder ``fn(spark, sf_dir)`` per (session, folder). Plans are lazy and
    immutable, so sharing one object between the queries of a session only saves building time."""
    return _memo(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (*session_key(spark), sf_dir.rstrip("/"), f"table:{name}")
    if key not in _MEMO:
        _MEMO[key] = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return _MEMO[key]


HOME = "match_id % 32"
AWAY = "(match_id % 32 + 1 + (match_id * 7 + CAST(floor(match_id / 32) AS BIGINT)) % 31) % 32"


@_memo("fx_event")
def fx_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed event stream: 100 events per match; passes, carries, pressures, duels, shots and all other types."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    b = e.selectExpr(
        "event_id", "user_id", "value", "CAST(floor(event_id / 100) AS BIGINT) AS match_id",
        "event_id % 100 AS event_index", "(event_id * 7 + user_id * 3) % 20 AS tk", "(event_id + user_id) % 5 AS ok",
    ).selectExpr("*", f"{HOME} AS home_team_id", f"{AWAY} AS away_team_id")
    p = b.selectExpr(
        "*",
        "CASE WHEN (event_id * 13 + user_id) % 2 = 0 THEN home_team_id ELSE away_team_id END AS team_id",
        """CASE WHEN tk < 8 THEN 'Pass' WHEN tk < 12 THEN 'Carry' WHEN tk < 14 THEN 'Pressure'
                WHEN tk = 14 THEN 'Duel' WHEN tk = 15 THEN 'Interception' WHEN tk = 16 THEN 'Clearance'
                WHEN tk < 19 THEN 'Shot' ELSE """ + RARE_TYPE_SQL + " END AS type_name",
    )
    out = p.selectExpr(
        "event_id", "match_id", "event_index",
        "CASE WHEN event_index < 50 THEN 1 ELSE 2 END AS period",
        "CAST(floor(event_index * 9 / 10) AS BIGINT) AS minute",
        "(event_id * 37) % 60 AS second",
        "type_name", "team_id", "concat('Team ', CAST(team_id AS STRING)) AS team_name",
        "team_id * 1000 + user_id % 11 AS player_id",
        "concat('Player ', CAST(team_id * 1000 + user_id % 11 AS STRING)) AS player_name",
        "CASE WHEN (event_id * 17) % 50 = 0 THEN NULL ELSE ((event_id * 7919 + user_id * 104729) % 1201) / 10.0D END AS loc_x",
        "CASE WHEN (event_id * 17) % 50 = 0 THEN NULL ELSE ((event_id * 6101 + user_id * 7907) % 801) / 10.0D END AS loc_y",
        "((event_id * 3571 + user_id * 2711) % 1201) / 10.0D AS end_x",
        "((event_id * 1543 + user_id * 3307) % 801) / 10.0D AS end_y",
        "(event_id % 3) = 0 AS under_pressure",
        "(event_id % 4) = 0 AS counterpress",
        "CASE WHEN type_name = 'Shot' THEN ((event_id * 53 + user_id) % 100) / 100.0D END AS shot_xg",
        """CASE WHEN type_name = 'Shot' THEN CASE ok WHEN 0 THEN 'Goal' WHEN 1 THEN 'Saved' WHEN 2 THEN 'Blocked'
                ELSE 'Off T' END END AS shot_outcome""",
        "CASE WHEN type_name = 'Shot' THEN CASE WHEN event_id % 11 = 0 THEN 'Penalty' ELSE 'Open Play' END END AS shot_type",
        """CASE WHEN type_name = 'Shot' THEN CASE event_id % 3 WHEN 0 THEN 'Head' WHEN 1 THEN 'Left Foot'
                ELSE 'Right Foot' END END AS shot_body_part""",
        "CASE WHEN type_name = 'Pass' AND ok IN (3, 4) THEN 'Incomplete' END AS pass_outcome",
        "CASE WHEN type_name = 'Pass' THEN CASE event_id % 13 WHEN 0 THEN 'Corner' WHEN 1 THEN 'Free Kick' END END AS pass_type",
        "type_name = 'Pass' AND event_id % 9 = 0 AS pass_shot_assist",
        "type_name = 'Pass' AND event_id % 27 = 0 AS pass_goal_assist",
        "type_name = 'Pass' AND event_id % 7 = 0 AS pass_cross",
        "CASE WHEN type_name = 'Duel' THEN CASE ok WHEN 0 THEN 'Won' WHEN 1 THEN 'Success' ELSE 'Lost' END END AS duel_outcome",
        "CASE WHEN type_name = 'Duel' THEN CASE event_id % 2 WHEN 0 THEN 'Tackle' ELSE 'Aerial Lost' END END AS duel_type",
        "value AS duration",
    )
    # Type-specific end locations and pass length, as the conformed event table carries them.
    return out.selectExpr(
        "*",
        "CASE WHEN type_name = 'Pass' THEN end_x END AS pass_end_x",
        "CASE WHEN type_name = 'Pass' THEN end_y END AS pass_end_y",
        "CASE WHEN type_name = 'Carry' THEN end_x END AS carry_end_x",
        "CASE WHEN type_name = 'Carry' THEN end_y END AS carry_end_y",
        "CASE WHEN type_name = 'Pass' THEN sqrt((end_x - loc_x) * (end_x - loc_x) + (end_y - loc_y) * (end_y - loc_y)) END AS pass_length",
        *[f"{c.sql} AS {c.name}" for c in EXTRA],
    )


@_memo("fx_match")
def fx_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match dimension: ONE aggregate of the events by match gives the ids and both final scores."""
    goal = "type_name = 'Shot' AND shot_outcome = 'Goal'"
    g = (
        fx_event(spark, sf_dir).select("match_id", "team_id", "type_name", "shot_outcome")
        .groupBy("match_id")
        .agg(F.expr(f"count_if({goal} AND team_id = {HOME})").alias("home_score"),
             F.expr(f"count_if({goal} AND team_id = {AWAY})").alias("away_score"))
    )
    return g.selectExpr(
        "match_id", "date_add(DATE '2022-01-01', CAST(match_id AS INT)) AS match_date",
        "CASE match_id % 3 WHEN 0 THEN 43 WHEN 1 THEN 55 ELSE 223 END AS competition_id",
        "CASE CAST(floor(match_id / 3) AS BIGINT) % 2 WHEN 0 THEN 106 ELSE 3 END AS season_id",
        """CASE CAST(floor(match_id / 6) AS BIGINT) % 7
             WHEN 0 THEN 'Group Stage' WHEN 1 THEN 'Round of 32' WHEN 2 THEN 'Round of 16'
             WHEN 3 THEN 'Quarter-finals' WHEN 4 THEN 'Semi-finals' WHEN 5 THEN '3rd Place Final' ELSE 'Final' END
           AS stage_name""",
        f"{HOME} AS home_team_id", f"concat('Team ', CAST({HOME} AS STRING)) AS home_team_name",
        f"{AWAY} AS away_team_id", f"concat('Team ', CAST({AWAY} AS STRING)) AS away_team_name",
        "home_score", "away_score",
    )


@_memo("fx_frame")
def fx_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freeze frames: 11 visible players per shot, generated per row (a generator, no join)."""
    ev = fx_event(spark, sf_dir).filter("type_name = 'Shot' AND match_id % 3 <> 2")
    return ev.selectExpr("event_id", "match_id", "explode(sequence(0, 10)) AS i").selectExpr(
        "event_id", "match_id",
        "((event_id * 977 + i * 1709) % 1201) / 10.0D AS loc_x",
        "((event_id * 613 + i * 911) % 801) / 10.0D AS loc_y",
        "i <= 4 AS is_teammate", "i = 0 AS is_actor", "i IN (1, 10) AS is_keeper",
    )


@_memo("fx_result")
def fx_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical results: independent pools of 64 matches among 16 teams."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return o.selectExpr(
        "CAST(floor(o_orderkey / 64) AS BIGINT) AS pool_id", "o_orderkey AS match_num",
        "CAST(o_orderdate AS DATE) AS match_date",
        "concat('T', CAST(o_custkey % 16 AS STRING)) AS home_team",
        "concat('T', CAST((o_custkey % 16 + 1 + CAST(floor(o_custkey / 16) AS BIGINT) % 15) % 16 AS STRING)) AS away_team",
        # one match in 41 is not played yet: it has no score
        "CASE WHEN o_orderkey % 41 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) % 5 END AS home_score",
        "CASE WHEN o_orderkey % 41 <> 0 THEN CAST(floor(o_totalprice / 7) AS BIGINT) % 4 END AS away_score",
        """CASE WHEN o_orderkey % 64 < 48 THEN 'Group A' WHEN o_orderkey % 64 < 56 THEN 'Round of 16'
                WHEN o_orderkey % 64 < 60 THEN 'Quarter-finals' WHEN o_orderkey % 64 < 62 THEN 'Semi-finals'
                WHEN o_orderkey % 64 = 62 THEN 'Match for third place' ELSE 'Final' END AS round""",
    )


@_memo("fx_rating")
def fx_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squad player ratings: one row per player (customer), team = nation."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.selectExpr(
        "c_custkey AS player_id", "c_nationkey AS team_id",
        "55 + (c_custkey * 7) % 40 AS overall", "55 + (c_custkey * 7) % 40 + c_custkey % 6 AS potential",
        "17 + (c_custkey * 5) % 23 AS age",
        """CASE c_custkey % 9 WHEN 0 THEN 'GK' WHEN 1 THEN 'CB' WHEN 2 THEN 'LB' WHEN 3 THEN 'CDM' WHEN 4 THEN 'CAM'
             WHEN 5 THEN 'RW' WHEN 6 THEN 'ST' WHEN 7 THEN 'FW' ELSE 'RWB' END AS position""",
    )


@_memo("fx_form")
def fx_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National-team results: orders joined to their customer's nation (shuffle join at scale)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    g = o.join(c, o.o_custkey == c.c_custkey).selectExpr(
        "c_nationkey AS team_id", "o_orderkey AS match_num", "CAST(o_orderdate AS DATE) AS match_date",
        "CAST(floor(o_totalprice) AS BIGINT) % 5 AS goals_for",
        "CAST(floor(o_totalprice / 7) AS BIGINT) % 4 AS goals_against",
        "(CAST(floor(o_totalprice) AS BIGINT) % 400) / 100.0D AS xg_for",
        "(CAST(floor(o_totalprice / 3) AS BIGINT) % 300) / 100.0D AS xg_against",
    )
    return g.selectExpr(
        "*", "CASE WHEN goals_for > goals_against THEN 'W' WHEN goals_for = goals_against THEN 'D' ELSE 'L' END AS result")


@_memo("fx_market")
def fx_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market values per team: totals in one aggregate, the top-3 sum through a split top-k."""
    s = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey", "s_nationkey AS team_id", "CAST(floor(s_acctbal) AS BIGINT) + 1001 AS value_m", "s_acctbal")
    totals = s.groupBy("team_id").agg(
        F.expr("CAST(sum(value_m) AS BIGINT)").alias("total_squad_value_m"),
        F.expr("count(1)").alias("n_players"),
        F.expr("count_if(value_m > 5000)").alias("n_players_over_50m"),
    )
    top3 = (
        top_k_per_group(s, ["team_id"], [F.col("s_acctbal").desc(), F.col("s_suppkey").asc()], 3, "s_suppkey")
        .groupBy("team_id").agg(F.expr("CAST(sum(value_m) AS BIGINT)").alias("top3_value_m"))
    )
    return totals.join(top3, "team_id", "left").selectExpr(
        "team_id", "total_squad_value_m", "CAST(coalesce(top3_value_m, 0) AS BIGINT) AS top3_value_m",
        "n_players", "n_players_over_50m",
    )


@_memo("fx_odds")
def fx_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return e.selectExpr(
        "event_id AS snapshot_id", "CAST(floor(event_id / 100) AS BIGINT) AS match_id", "event_id % 100 AS minute",
        "ts AS ingested_at",
        "1.2D + ((event_id * 31 + user_id) % 400) / 100.0D AS odd_home",
        "2.5D + ((event_id * 17 + user_id) % 200) / 100.0D AS odd_draw",
        "1.2D + ((event_id * 43 + user_id) % 500) / 100.0D AS odd_away",
        "(event_id * 3) % 4 AS goals_so_far",
    )


@_memo("fx_weather")
def fx_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return e.selectExpr(
        "event_id AS weather_id", "user_id % 15 AS venue_id", "ts AS collected_at", "value AS wind_speed_kmh",
        "((event_id * 45) % 1441) / 4.0D AS wind_direction_deg",
        """CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 45 WHEN 3 THEN 61 WHEN 4 THEN 95 ELSE 12 END
           AS weather_code""",
    )
