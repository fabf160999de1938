"""Streaming keys (STR-01..06). Each replays its input from the test tables in order of event time through
the shared checkpoint folder (a few deliveries, about one in each micro-batch) and returns the sink table;
the oracle is the equivalent batch query (nothing is late: deliveries follow event time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fulltime.plans.fixture_sql import with_fixtures
from fulltime.plans.registry import query
from fulltime.session import scratch_dir
from fulltime.sources import testdata as td
from fulltime.sources.layer import Layer
from fulltime.streaming import live

# Payload layouts of the feeds.
ODDS_SCHEMA = (
    "snapshot_id bigint, match_id bigint, minute bigint, ingested_at timestamp, "
    "market_1x2 struct<odd_home: double, odd_draw: double, odd_away: double>, goals_so_far bigint")
WEATHER_SCHEMA = (
    "weather_id bigint, venue_id bigint, collected_at timestamp, wind struct<speed_kmh: double, direction_deg: double>, weather_code int")
EVENT_SCHEMA = (
    "delivery bigint, match_id bigint, event_type string, minute bigint, player struct<id: bigint>, ts timestamp")


def _odds(spark, sf):
    return td.fx_odds(spark, sf).withColumn("ingested_at", F.col("ingested_at").cast("timestamp"))


def _weather(spark, sf):
    return td.fx_weather(spark, sf).withColumn("collected_at", F.col("collected_at").cast("timestamp"))


def _parsed(spark, payloads: DataFrame, schema: str, name: str, *columns) -> DataFrame:
    """Replays payloads (value, ts) through the parser; typed rows and rejects in one table."""
    root = scratch_dir(spark, f"stream-{name}")

    def run(source: DataFrame):
        flat = live.parse_with_rejects(source, StructType.fromDDL(schema)).select(*columns, F.col("_reject").alias("reject"))
        return live.to_files(flat, f"{root}/sink", f"{root}/checkpoint")

    live.replay(payloads, "ts", root, run)
    return spark.read.parquet(f"{root}/sink")


def _damaged(payload, key: str, every: int):
    """The payload, cut off in every ``every``-th row: the feed's damaged deliveries."""
    return F.when(F.col(key) % every == 0, F.substring(payload, 1, 20)).otherwise(payload)


@query("stream_parse", with_fixtures(["fx_odds"], """
SELECT CASE WHEN ok THEN snapshot_id END AS snapshot_id, CASE WHEN ok THEN match_id END AS match_id, CASE WHEN ok THEN minute END AS minute,
       CASE WHEN ok THEN odd_home END AS odd_home, CASE WHEN ok THEN odd_draw END AS odd_draw, CASE WHEN ok THEN odd_away END AS odd_away,
       CASE WHEN ok THEN goals_so_far END AS goals_so_far,
       CASE WHEN NOT ok THEN substr('{"snapshot_id":' || snapshot_id || ',"match_id":' || match_id, 1, 20) END AS reject
FROM (SELECT *, snapshot_id % 97 <> 0 AS ok FROM fx_odds)"""))
def q_stream_parse(spark, sf):
    """Odds payloads (JSON) parsed on a stream; damaged ones are kept as rejects."""
    payload = F.to_json(F.struct("snapshot_id", "match_id", "minute", "ingested_at",
                                 F.struct("odd_home", "odd_draw", "odd_away").alias("market_1x2"), "goals_so_far"))
    raw = _odds(spark, sf).select(_damaged(payload, "snapshot_id", 97).alias("value"), F.col("ingested_at").alias("ts"))
    return _parsed(spark, raw, ODDS_SCHEMA, "parse", "snapshot_id", "match_id", "minute", "market_1x2.odd_home", "market_1x2.odd_draw",
                  "market_1x2.odd_away", "goals_so_far")


@query("stream_parse_weather", with_fixtures(["fx_weather"], """
SELECT CASE WHEN ok THEN weather_id END AS weather_id, CASE WHEN ok THEN venue_id END AS venue_id,
       CASE WHEN ok THEN wind_speed_kmh END AS speed_kmh, CASE WHEN ok THEN wind_direction_deg END AS direction_deg,
       CASE WHEN ok THEN weather_code END AS weather_code,
       CASE WHEN NOT ok THEN substr('{"weather_id":' || weather_id || ',"venue_id":' || venue_id, 1, 20) END AS reject
FROM (SELECT *, weather_id % 89 <> 0 AS ok FROM fx_weather)"""))
def q_stream_parse_weather(spark, sf):
    """Weather payloads parsed on a stream, damaged ones kept as rejects."""
    payload = F.to_json(F.struct("weather_id", "venue_id", "collected_at", F.struct(
        F.col("wind_speed_kmh").alias("speed_kmh"), F.col("wind_direction_deg").alias("direction_deg")).alias("wind"), "weather_code"))
    raw = _weather(spark, sf).select(_damaged(payload, "weather_id", 89).alias("value"), F.col("collected_at").alias("ts"))
    return _parsed(spark, raw, WEATHER_SCHEMA, "parse-weather", "weather_id", "venue_id", "wind.speed_kmh", "wind.direction_deg", "weather_code")


def _live_events(spark, sf):
    return td.table(spark, sf, "events").selectExpr(
        "event_id AS delivery", "CAST(floor(event_id / 100) AS BIGINT) AS match_id", "event_type",
        "CAST(floor((event_id % 100) / 10) AS BIGINT) AS minute", "user_id % 11 AS player_id", "CAST(ts AS TIMESTAMP) AS ts")


@query("stream_parse_events", """
SELECT CASE WHEN ok THEN event_id END AS delivery, CASE WHEN ok THEN CAST(floor(event_id / 100) AS BIGINT) END AS match_id,
       CASE WHEN ok THEN event_type END AS event_type, CASE WHEN ok THEN CAST(floor((event_id % 100) / 10) AS BIGINT) END AS minute,
       CASE WHEN ok THEN user_id % 11 END AS player_id,
       CASE WHEN NOT ok THEN substr('{"delivery":' || event_id || ',"match_id":' || CAST(floor(event_id / 100) AS BIGINT), 1, 20) END AS reject
FROM (SELECT *, event_id % 83 <> 0 AS ok FROM events)""")
def q_stream_parse_events(spark, sf):
    """Live match-event payloads parsed on a stream, damaged ones kept as rejects."""
    payload = F.to_json(F.struct("delivery", "match_id", "event_type", "minute", F.struct(F.col("player_id").alias("id")).alias("player"), "ts"))
    raw = _live_events(spark, sf).select(_damaged(payload, "delivery", 83).alias("value"), "ts")
    return _parsed(spark, raw, EVENT_SCHEMA, "parse-events", "delivery", "match_id", "event_type", "minute", F.col("player.id").alias("player_id"))


#: Columns that tell a live event, whatever its delivery is called.
NATURAL = ["match_id", "event_type", "minute", "player_id", "ts"]


def redelivered(events: DataFrame) -> DataFrame:
    """Every event delivered one to three times, four to seven minutes apart, each time under a fresh id."""
    again = F.sequence(F.lit(0), F.pmod(F.xxhash64("delivery"), F.lit(3)).cast("int"))
    each = events.select("*", F.explode(again).alias("k"), (F.pmod("delivery", F.lit(4)) + 4).alias("apart"))
    at = (F.col("ts").cast("double") + 60 * F.col("k") * F.col("apart")).cast("timestamp")
    return each.select(F.expr("uuid()").alias("delivery_id"), *NATURAL, at.alias("delivered_at"))


@query("stream_dedup", """
SELECT DISTINCT CAST(floor(event_id / 100) AS BIGINT) AS match_id, event_type, CAST(floor((event_id % 100) / 10) AS BIGINT) AS minute,
       user_id % 11 AS player_id, CAST(ts AS TIMESTAMP) AS ts
FROM events""")
def q_stream_dedup(spark, sf):
    """Live events re-delivered minutes later under fresh ids: one row per natural key, state of an hour's events."""
    root = scratch_dir(spark, "stream-dedup")

    def run(source: DataFrame):
        s = live.dedup_stream(source, NATURAL, "delivered_at")
        return live.to_files(s.select(*NATURAL[:-1], F.col("ts").cast("timestamp_ntz").alias("ts")), f"{root}/sink", f"{root}/checkpoint")

    live.replay(redelivered(_live_events(spark, sf)), "delivered_at", root, run)
    return spark.read.parquet(f"{root}/sink")


def _windows(spark, df: DataFrame, ts: str, name: str, keys: list[str], windows) -> DataFrame:
    root = scratch_dir(spark, f"stream-{name}")
    layer = Layer(spark, f"{root}/sink")
    live.replay(df, ts, root, lambda source: live.to_table(windows(source), layer, name, keys, f"{root}/checkpoint"))
    return layer.read(name)


@query("stream_odds", with_fixtures(["fx_odds"], """
SELECT match_id, CAST(date_trunc('day', ingested_at) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('day', ingested_at) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end, count(*) AS snapshots,
       arg_max(odd_home, ingested_at) AS last_odd_home, arg_max(odd_draw, ingested_at) AS last_odd_draw,
       arg_max(odd_away, ingested_at) AS last_odd_away, avg(odd_home) AS mean_odd_home
FROM fx_odds GROUP BY 1, 2, 3"""))
def q_stream_odds(spark, sf):
    return _windows(spark, _odds(spark, sf), "ingested_at", "odds_windows", ["match_id", "window_start"], live.odds_windows)


@query("stream_odds_sliding", with_fixtures(["fx_odds"], """
SELECT match_id, w AS window_start, CAST(w + INTERVAL 2 DAY AS TIMESTAMP) AS window_end, count(*) AS snapshots,
       arg_max(odd_home, ingested_at) AS last_odd_home, arg_max(odd_draw, ingested_at) AS last_odd_draw,
       arg_max(odd_away, ingested_at) AS last_odd_away, avg(odd_home) AS mean_odd_home
FROM (SELECT *, CAST(date_trunc('day', ingested_at) - CAST(k AS INTEGER) * INTERVAL 1 DAY AS TIMESTAMP) AS w
      FROM fx_odds, (VALUES (0), (1)) v(k))
GROUP BY 1, 2, 3"""))
def q_stream_odds_sliding(spark, sf):
    """Odds per match in windows of two days, a new one every day."""
    return _windows(spark, _odds(spark, sf), "ingested_at", "odds_sliding", ["match_id", "window_start"],
                    lambda s: live.odds_windows(s, window="2 days", slide="1 day"))


@query("stream_weather", with_fixtures(["fx_weather"], """
SELECT venue_id, CAST(date_trunc('hour', collected_at) AS TIMESTAMP) AS window_start, count(*) AS readings,
       avg(wind_speed_kmh) AS mean_wind_kmh, max(wind_speed_kmh) AS max_wind_kmh
FROM fx_weather GROUP BY 1, 2"""))
def q_stream_weather(spark, sf):
    return _windows(spark, _weather(spark, sf), "collected_at", "weather_hourly", ["venue_id", "window_start"], live.weather_windows)


@query("stream_score", with_fixtures(["fx_event"], """
SELECT match_id, team_id, count(*) AS goals FROM fx_event WHERE type_name = 'Shot' AND shot_outcome = 'Goal'
GROUP BY match_id, team_id"""))
def q_stream_score(spark, sf):
    """Live scoreboard: goals per match and team as a stateful streaming count (update mode)."""
    ts = td.table(spark, sf, "events").selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS ts")
    goals = td.fx_event(spark, sf).filter("type_name = 'Shot' AND shot_outcome = 'Goal'") \
        .select("event_id", "match_id", "team_id").join(ts, "event_id")
    return _windows(spark, goals, "ts", "scoreboard", ["match_id", "team_id"],
                    lambda s: s.groupBy("match_id", "team_id").agg(F.count(F.lit(1)).alias("goals")))


@query("stream_upsert", with_fixtures(["fx_odds"], """
SELECT match_id, arg_max(snapshot_id, ingested_at) AS snapshot_id, max(ingested_at) AS ingested_at,
       arg_max(odd_home, ingested_at) AS odd_home, arg_max(odd_draw, ingested_at) AS odd_draw,
       arg_max(odd_away, ingested_at) AS odd_away
FROM fx_odds GROUP BY match_id"""))
def q_stream_upsert(spark, sf):
    """Newest odds per match kept in a stored table by upserting every micro-batch (foreachBatch)."""
    odds = _odds(spark, sf).select("snapshot_id", "match_id", "ingested_at", "odd_home", "odd_draw", "odd_away")
    root = scratch_dir(spark, "stream-upsert")
    layer, name, keys = Layer(spark, f"{root}/sink"), "latest_odds", ["match_id"]

    def newest(rows: DataFrame) -> DataFrame:
        at = F.col("ingested_at")
        return rows.groupBy("match_id").agg(*[F.max_by(c, at).alias(c) for c in ("snapshot_id", "odd_home", "odd_draw", "odd_away")],
                                            F.max(at).alias("ingested_at"))

    def apply(batch: DataFrame, epoch_id: int) -> None:
        latest = newest(batch)
        if layer.exists(name):
            latest = newest(layer.read(name).join(latest.select("match_id"), "match_id", "left_semi").unionByName(latest))
        layer.upsert(latest, name, keys, parts=8)

    live.replay(odds, "ingested_at", root,
                lambda source: source.writeStream.foreachBatch(apply).option("checkpointLocation", f"{root}/checkpoint"))
    return layer.read(name)
