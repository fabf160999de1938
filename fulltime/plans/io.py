"""Source and sink keys (SRC, SNK): provider-shaped files are written from the test tables into the
shared scratch folder, read back with explicit schemas and conformed; stored-table keys write,
replace, upsert and export through ``Layer`` and read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from fulltime.operators import gold, players
from fulltime.operators.numbering import numbered
from fulltime.plans.core import EM, STANDINGS_SQL, pms_frame, tl_base, tl_frame, tp_frame
from fulltime.plans.fixture_sql import with_fixtures
from fulltime.plans.registry import query
from fulltime.plans.sql_blocks import PLAYER_STATS, TEAM_PERF, TIMELINE
from fulltime.session import scratch_dir
from fulltime.sources import raw
from fulltime.sources import testdata as td
from fulltime.sources.event_columns import FAMILIES
from fulltime.sources.layer import Layer, dealt_by, with_audit


#: Event family that each part of a provider event belongs to; other parts stand in every event.
PARTS = FAMILIES | {"carry": "Carry", "duel": "Duel"}


def _provider_event(e) -> list:
    """The flat event columns nested as a provider file has them."""
    tree: dict = {}
    for name, _, path in raw.EVENT_FIELDS:
        field, _, place = path.partition("[")
        *parts, last = field.split(".")
        at = tree
        for p in parts:
            at = at.setdefault(p, {})
        if place:
            at.setdefault(last, []).append(name)
        else:
            at[last] = name

    def column(node):
        if isinstance(node, str):
            return F.col(node)
        if isinstance(node, list):
            return F.when(F.col(node[0]).isNotNull(), F.array(*node))
        return F.struct(*[column(v).alias(k) for k, v in node.items()])

    return [(F.when(F.col("type_name") == PARTS[k], column(v)) if k in PARTS else column(v)).alias(k) for k, v in tree.items()]


def _per_match(df):
    """A writer of files by match: a match's rows come from one task (a very large match's from some), and tasks put
    their files in place themselves, as there are too many of them for the driver to move one by one."""
    return dealt_by(df, ["match_id"]).option("mapreduce.fileoutputcommitter.algorithm.version", "2")


def _stage_events(spark, sf):
    e = td.fx_event(spark, sf)
    path = scratch_dir(spark, "raw-events")
    _per_match(e.select("match_id", *_provider_event(e))).json(path)
    return path


_INGESTED = ", ".join(
    f"CASE WHEN type_name = '{PARTS[path.partition('.')[0]]}' THEN {name} END AS {name}" if path.partition(".")[0] in PARTS else name
    for name, _, path in raw.EVENT_FIELDS)


@query("ingest_events", with_fixtures(["fx_event"], f"SELECT match_id, {_INGESTED} FROM fx_event"))
def q_ingest_events(spark, sf):
    """Per-match provider event files (type-nested JSON) read with an explicit schema and conformed;
    the match id comes from the file path."""
    path = _stage_events(spark, sf)
    docs = raw.read_json_docs(spark, path, raw.RAW_EVENT_SCHEMA, keep_corrupt=False)
    return raw.conform_events(docs, raw.key_from_path(r"match_id=(\d+)").cast("bigint"))


@query("ingest_frames", with_fixtures(["fx_event", "fx_frame"], "SELECT *, [loc_x, loc_y, 120.0e0, 80.0e0] AS visible_area FROM fx_frame"))
def q_ingest_frames(spark, sf):
    f = td.fx_frame(spark, sf).select(
        F.col("event_id").alias("event_uuid"), "match_id", F.array("loc_x", "loc_y").alias("location"),
        F.col("is_teammate").alias("teammate"), F.col("is_actor").alias("actor"),
        F.when(F.col("is_keeper"), F.lit(True)).alias("keeper"), F.array("loc_x", "loc_y", F.lit(120.0), F.lit(80.0)).alias("visible_area"))
    path = scratch_dir(spark, "raw-frames")
    f.write.json(path)
    return raw.conform_frames(raw.read_json_docs(spark, path, raw.FRAME_SCHEMA, keep_corrupt=False))


#: Match attributes that the stand-in adds to its match table, as SQL over it.
MATCH_EXTRA = {
    "kick_off": "concat(CAST(12 + match_id % 9 AS STRING), ':00:00.000')", "match_week": "CAST(1 + match_id % 30 AS INTEGER)",
    "match_status": "CASE WHEN match_id % 50 = 0 THEN 'scheduled' ELSE 'available' END",
    "competition_name": "concat('Competition ', CAST(competition_id AS STRING))", "competition_country": "concat('Country ', CAST(competition_id % 5 AS STRING))",
    "season_name": "concat('Season ', CAST(season_id AS STRING))", "home_team_country": "concat('Country ', CAST(home_team_id % 25 AS STRING))",
    "away_team_country": "concat('Country ', CAST(away_team_id % 25 AS STRING))", "stage_id": "CAST(match_id % 7 AS INTEGER)",
    "stadium_id": "CAST(CASE WHEN match_id % 10 <> 3 THEN match_id % 12 END AS INTEGER)",
    "stadium_name": "CASE WHEN match_id % 10 <> 3 THEN concat('Stadium ', CAST(match_id % 12 AS STRING)) END",
    "stadium_country": "CASE WHEN match_id % 10 <> 3 THEN concat('Country ', CAST(match_id % 12 AS STRING)) END",
    "referee_id": "CAST(match_id % 40 AS INTEGER)", "referee_name": "concat('Referee ', CAST(match_id % 40 AS STRING))",
}


@query("conform_matches", with_fixtures(EM, f"""
SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in MATCH_EXTRA.items())} FROM fx_match"""))
def q_conform_matches(spark, sf):
    """Match files in two provider shapes (flat and nested) conformed to one schema and unioned."""
    m = td.fx_match(spark, sf).selectExpr("*", *[f"{sql} AS {name}" for name, sql in MATCH_EXTRA.items()])
    m = m.withColumn("match_date", F.col("match_date").cast("string"))
    flat_path, nested_path = scratch_dir(spark, "raw-matches-flat"), scratch_dir(spark, "raw-matches-nested")
    m.filter("match_id % 2 = 0").select(*[F.col(name).alias(flat) for name, _, flat, _ in raw.MATCH_FIELDS]).write.json(flat_path)
    m.filter("match_id % 2 = 1").select(*_nested({path: name for name, _, _, path in raw.MATCH_FIELDS})).write.json(nested_path)
    schemas = [", ".join(f"{flat} {'string' if kind == 'date' else kind}" for _, kind, flat, _ in raw.MATCH_FIELDS),
               raw._ddl(raw._tree([(n, "string" if kind == "date" else kind, path) for n, kind, _, path in raw.MATCH_FIELDS]))]
    flat, nested = [raw.conform_matches(raw.read_json_docs(spark, p, s, keep_corrupt=False)) for p, s in zip((flat_path, nested_path), schemas)]
    return flat.unionByName(nested)


def _nested(columns: dict[str, str]) -> list:
    """Columns by path, put together as structs."""
    tree: dict = {}
    for path, name in columns.items():
        *parts, last = path.split(".")
        at = tree
        for p in parts:
            at = at.setdefault(p, {})
        at[last] = name

    def column(node):
        return F.col(node) if isinstance(node, str) else F.struct(*[column(v).alias(k) for k, v in node.items()])

    return [column(v).alias(k) for k, v in tree.items()]


def _lineups(spark, sf):
    """Line-up files (one object per match, keyed by team name), read and exploded."""
    e = td.fx_event(spark, sf).select("match_id", "team_name", "player_id", "player_name").distinct()
    n = F.col("player_id")
    at = lambda k: F.concat(F.lit("P"), ((n + k) % 11).cast("string"))
    position = lambda k, start, end: F.struct(((n + k) % 11).cast("int").alias("position_id"), at(k).alias("position"), F.lit(start).alias("from"),
                                              F.lit(end).alias("to"))
    cards = F.when(n % 6 == 0, F.array(F.struct(F.lit("30:00").alias("time"), F.lit("Yellow Card").alias("card_type")))).otherwise(F.array())
    player = F.struct(
        "player_id", "player_name", F.when(n % 2 == 0, F.concat(F.lit("Nick "), n.cast("string"))).alias("player_nickname"),
        (n % 100).cast("int").alias("jersey_number"),
        F.struct((n % 25).alias("id"), F.concat(F.lit("Country "), (n % 25).cast("string")).alias("name")).alias("country"), cards.alias("cards"),
        F.when(n % 4 == 0, F.array(position(0, "00:00", "60:00"), position(1, "60:00", None)))
        .otherwise(F.array(position(0, "00:00", None))).alias("positions"))
    per_team = e.groupBy("match_id", "team_name").agg(F.collect_list(player).alias("players"))
    docs = per_team.groupBy("match_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("team_name", "players")))).alias("value"))
    path = scratch_dir(spark, "raw-lineups")
    _per_match(docs).text(path)
    return raw.explode_lineups(spark.read.text(path), raw.key_from_path(r"match_id=(\d+)").cast("bigint"))


LINEUP_SQL = """
lu AS (
  SELECT DISTINCT match_id, team_name, player_id, player_name,
         CASE WHEN player_id % 2 = 0 THEN 'Nick ' || CAST(player_id AS VARCHAR) END AS player_nickname,
         CAST(player_id % 100 AS INTEGER) AS jersey_number, player_id % 25 AS country_id, 'Country ' || CAST(player_id % 25 AS VARCHAR) AS country_name,
         CAST(player_id % 11 AS INTEGER) AS position_id, 'P' || CAST(player_id % 11 AS VARCHAR) AS position_name, '00:00' AS position_from,
         CASE WHEN player_id % 4 = 0 THEN '60:00' END AS position_to, CASE WHEN player_id % 4 = 0 THEN 2 ELSE 1 END AS n_positions,
         CASE WHEN player_id % 6 = 0 THEN 1 ELSE 0 END AS n_cards
  FROM fx_event WHERE player_id IS NOT NULL)"""


@query("explode_lineups", with_fixtures(["fx_event"], """
SELECT *, CASE WHEN player_id % 4 = 0 THEN '[{"position_id":' || position_id || ',"position":"' || position_name || '","from":"00:00","to":"60:00"},'
              || '{"position_id":' || (player_id + 1) % 11 || ',"position":"P' || (player_id + 1) % 11 || '","from":"60:00"}]'
            ELSE '[{"position_id":' || position_id || ',"position":"' || position_name || '","from":"00:00"}]' END AS positions_json,
       CASE WHEN n_cards = 1 THEN '[{"time":"30:00","card_type":"Yellow Card"}]' ELSE '[]' END AS cards_json
FROM lu""", LINEUP_SQL))
def q_explode_lineups(spark, sf):
    """Line-up files -> (match, team, player) rows."""
    return _lineups(spark, sf)


@query("attach_lineup", with_fixtures(EM, """
SELECT p.match_id, p.player_id, p.player_name, p.goals, l.position_name, l.jersey_number, l.country_name
FROM pms p LEFT JOIN lu l ON l.match_id = p.match_id AND l.player_id = p.player_id""", TIMELINE + "," + PLAYER_STATS + "," + LINEUP_SQL))
def q_attach_lineup(spark, sf):
    """Player statistics with position, shirt number and country from the line-ups."""
    stats = pms_frame(spark, sf).select("match_id", "player_id", "player_name", "goals")
    return players.attach_lineup(stats, _lineups(spark, sf))


def _stage_results(spark, sf):
    r = td.fx_result(spark, sf)
    h, a = F.col("home_score"), F.col("away_score")
    goals = F.when(h + a > 0, F.transform(
        F.sequence(F.lit(1), (h + a).cast("int")),
        lambda k: F.struct(F.concat(F.lit("P"), k.cast("string")).alias("name"),
                           F.when(k <= h, 1).otherwise(2).alias("team"),
                           ((F.col("match_num") * 7 + k * 13) % 90).cast("int").alias("minute")))).otherwise(F.array())
    match = F.struct(F.col("match_num").alias("num"), F.col("match_date").cast("string").alias("date"),
                     F.struct(F.col("home_team").alias("name")).alias("team1"),
                     F.struct(F.col("away_team").alias("name")).alias("team2"),
                     F.struct(F.array(h, a).alias("ft"), F.array(F.floor(h / 2), F.floor(a / 2)).alias("ht")).alias("score"),
                     goals.alias("goals"))
    rounds = r.groupBy("pool_id", "round").agg(F.collect_list(match).alias("matches"))
    docs = rounds.groupBy("pool_id").agg(F.collect_list(F.struct(F.col("round").alias("name"), "matches")).alias("rounds")) \
        .select(F.concat(F.lit("Pool "), F.col("pool_id").cast("string")).alias("name"), "rounds")
    path = scratch_dir(spark, "raw-results")
    docs.write.json(path)
    return raw.read_json_docs(spark, path, raw.RESULTS_SCHEMA, keep_corrupt=False)


@query("historical_results", with_fixtures(["fx_result"], """
SELECT 'Pool ' || CAST(pool_id AS VARCHAR) AS edition, round, match_num, match_date, home_team, away_team,
       home_score, away_score, CAST(floor(home_score / 2) AS BIGINT) AS home_score_ht,
       CAST(floor(away_score / 2) AS BIGINT) AS away_score_ht,
       CASE WHEN home_score > away_score THEN 'H' WHEN home_score = away_score THEN 'D' WHEN home_score < away_score THEN 'A' END AS result,
       CAST(coalesce(home_score + away_score, 0) AS INTEGER) AS n_goals
FROM fx_result"""))
def q_historical_results(spark, sf):
    """Edition documents (rounds of matches with score arrays) flattened to one row per match."""
    return raw.flatten_results(_stage_results(spark, sf)).drop("goals_json")


@query("goal_rows", with_fixtures(["fx_result"], """
SELECT match_num, 'P' || CAST(k AS VARCHAR) AS scorer, CASE WHEN k <= home_score THEN 1 ELSE 2 END AS team_side,
       CAST((match_num * 7 + k * 13) % 90 AS INTEGER) AS minute
FROM fx_result, range(1, home_score + away_score + 1) t(k)
UNION ALL
SELECT match_num, NULL, NULL, NULL FROM fx_result WHERE coalesce(home_score + away_score, 0) = 0"""))
def q_goal_rows(spark, sf):
    """The goals stored as JSON per match exploded to one row per goal (goalless matches kept once)."""
    return raw.explode_goals(raw.flatten_results(_stage_results(spark, sf)))


@query("regroup_results", with_fixtures(["fx_result"], """
SELECT match_num AS num, CASE WHEN round LIKE 'Group%' THEN round ELSE round END AS round_label,
       CAST(coalesce(home_score + away_score, 0) AS INTEGER) AS n_goals FROM fx_result"""))
def q_regroup_results(spark, sf):
    """Upstream match lists (group or round label, goals per side) regrouped into the stored form."""
    r = td.fx_result(spark, sf)
    goal = lambda n: F.when(F.col(n) > 0, F.transform(F.sequence(F.lit(1), F.col(n).cast("int")),
                                                      lambda k: F.struct(F.concat(F.lit("P"), k.cast("string")).alias("name"),
                                                                         k.alias("minute")))).otherwise(F.array())
    flat = r.select(F.col("match_num").alias("num"),
                    F.when(F.col("round").startswith("Group"), F.col("round")).alias("group"),
                    F.when(~F.col("round").startswith("Group"), F.col("round")).alias("round"),
                    goal("home_score").alias("goals1"), goal("away_score").alias("goals2"))
    return raw.regroup_results(flat).select("num", "round_label", F.size("goals").alias("n_goals"))


@query("regroup_rounds", with_fixtures(["fx_result"], """
SELECT edition, round_label, dense_rank() OVER (PARTITION BY edition ORDER BY first) AS round_place, num, team1, team2, goals FROM (
  SELECT *, min(num) OVER (PARTITION BY edition, round_label) AS first FROM (
    SELECT pool_id AS edition, coalesce(round, 'Unknown') AS round_label,
           row_number() OVER (PARTITION BY pool_id ORDER BY match_date NULLS FIRST, match_num) AS num, home_team AS team1, away_team AS team2,
           array_to_string(list_concat(
             ['P' || k || '/' || home_team || '/' || (match_num * 7 + k * 13) % 90 FOR k IN range(1, coalesce(home_score, 0) + 1)],
             ['P' || k || '/' || away_team || '/' || (match_num * 7 + k * 13) % 90 FOR k IN range(1, coalesce(away_score, 0) + 1)]), ';') AS goals
    FROM fx_result))"""))
def q_regroup_rounds(spark, sf):
    """Upstream match lists regrouped by round: running numbers, rounds in order of appearance, goals by team."""
    r = td.fx_result(spark, sf)
    goal = lambda n: F.when(F.col(n) > 0, F.transform(F.sequence(F.lit(1), F.col(n).cast("int")), lambda k: F.struct(
        F.concat(F.lit("P"), k.cast("string")).alias("name"), ((F.col("match_num") * 7 + k * 13) % 90).cast("int").alias("minute"))))
    in_group = F.col("round").startswith("Group")
    flat = r.select(F.col("pool_id").alias("edition"), "match_num", F.when(in_group, F.col("round")).alias("group"),
                    F.when(~in_group, F.col("round")).alias("round"), F.col("match_date").alias("date"), F.col("home_team").alias("team1"),
                    F.col("away_team").alias("team2"), goal("home_score").alias("goals1"), goal("away_score").alias("goals2"))
    out = raw.regroup_rounds(flat, ["date", "match_num"])
    shown = F.array_join(F.transform("goals", lambda g: F.concat_ws("/", g["name"], g["team"], g["minute"].cast("string"))), ";")
    return out.select("edition", "round_label", "round_place", "num", "team1", "team2", shown.alias("goals"))


#: Stand-in league files: the two header lines and the columns under them.
LEAGUES = {
    "L0": (",,Performance,,Expected", "Team,Match,GF,GA,xG", ["team_id", "match_num", "goals_for", "goals_against", "xg_for"]),
    "L1": (",,Performance,Expected,", "Team,Match,GF,xG,xGA", ["team_id", "match_num", "goals_for", "xg_for", "xg_against"]),
    "L2": ("Unnamed: 0_level_0,Expected,,Unnamed: 3_level_0,Performance", "Team,xG,xGA,Match,GA", ["team_id", "xg_for", "xg_against", "match_num", "goals_against"]),
}


@query("two_level_headers", with_fixtures(["fx_form"], """
SELECT 'L' || CAST(team_id % 3 AS VARCHAR) AS league, CAST(team_id AS VARCHAR) AS "Team", CAST(match_num AS DOUBLE) AS "Match",
       CASE WHEN team_id % 3 < 2 THEN CAST(goals_for AS DOUBLE) END AS "Performance_GF",
       CASE WHEN team_id % 3 <> 1 THEN CAST(goals_against AS DOUBLE) END AS "Performance_GA",
       CAST(xg_for AS DOUBLE) AS "Expected_xG", CASE WHEN team_id % 3 > 0 THEN CAST(xg_against AS DOUBLE) END AS "Expected_xGA"
FROM fx_form"""))
def q_two_level_headers(spark, sf):
    """League files of two header lines each, with different columns: flattened names, one table by name."""
    f = td.fx_form(spark, sf)
    paths = {}
    for k, (league, (upper, lower, cols)) in enumerate(LEAGUES.items()):
        lines = f.where(F.col("team_id") % 3 == k).select("team_id", F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]).alias("line"))
        # some teams to a file, each file with its header lines
        files = lines.groupBy(F.pmod("team_id", F.lit(16))).agg(F.array_join(F.concat(F.array(F.lit(upper), F.lit(lower)), F.collect_list("line")), "\n").alias("value"))
        paths[league] = scratch_dir(spark, f"two-level-{league}")
        files.select("value").write.text(paths[league])
    return raw.read_leagues(spark, paths, text=["Team"])


def _seed(spark, name: str, rows):
    """A seed list written by all tasks and read with its schema."""
    path = scratch_dir(spark, f"raw-seed-{name}")
    rows.write.json(path)
    return raw.read_seed(spark, path, name)


@query("read_seed", """
SELECT n_nationkey AS id, n_name AS team, n_regionkey AS region_id FROM nation""")
def q_read_seed(spark, sf):
    """The teams seed."""
    return _seed(spark, "teams", td.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("team"), F.col("n_regionkey").alias("region_id")))


@query("seed_rankings", """
SELECT CAST(row_number() OVER (ORDER BY points DESC, team) AS INTEGER) AS rank, team, id, points, 'OTHER' AS confederation
FROM (SELECT n_name AS team, n_name[1:3] AS id, CAST(count(c_custkey) + n_nationkey / 100.0 AS DOUBLE) AS points
      FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name)""")
def q_seed_rankings(spark, sf):
    """The rankings seed: rank, points and confederation by team (customers of a nation stand in for points)."""
    n, c = td.table(spark, sf, "nation"), td.table(spark, sf, "customer").groupBy("c_nationkey").count()
    points = (F.coalesce("count", F.lit(0)) + F.col("n_nationkey") / 100.0).alias("points")
    t = n.join(c, n.n_nationkey == c.c_nationkey, "left").select(F.col("n_name").alias("team"), F.substring("n_name", 1, 3).alias("id"), points)
    ranked = numbered(t, [F.col("points").desc(), F.col("team")], "rank", first=1)
    return _seed(spark, "rankings", ranked.select("rank", "team", "id", "points", F.lit("OTHER").alias("confederation")))


@query("seed_history", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'Host ' || year(o_orderdate) % 25 AS host, 'Team ' || max(o_custkey) AS champion,
       'Team ' || min(o_custkey) AS runner_up, count(*) AS matches, CAST(sum(o_orderkey % 7) AS BIGINT) AS goals
FROM orders GROUP BY year(o_orderdate)""")
def q_seed_history(spark, sf):
    """The history seed: host, champion, runner-up, matches and goals by edition."""
    year = F.year("o_orderdate")
    name = lambda f: F.concat(F.lit("Team "), f("o_custkey").cast("string"))
    h = td.table(spark, sf, "orders").groupBy(year.alias("year")).agg(
        name(F.max).alias("champion"), name(F.min).alias("runner_up"), F.count("*").alias("matches"), F.sum(F.col("o_orderkey") % 7).alias("goals"))
    return _seed(spark, "history", h.withColumn("host", F.concat(F.lit("Host "), (F.col("year") % 25).cast("string"))))


@query("seed_editions", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'Edition ' || year(o_orderdate) AS name, count(*) AS matches FROM orders GROUP BY year(o_orderdate)""")
def q_seed_editions(spark, sf):
    """The index of editions."""
    e = td.table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("matches"))
    return _seed(spark, "editions", e.withColumn("name", F.concat(F.lit("Edition "), F.col("year").cast("string"))))


@query("seed_squads", """
SELECT n_name AS team, 'Coach ' || n_nationkey AS coach, CAST(s_suppkey % 99 AS INTEGER) AS number, s_name AS name,
       CASE s_suppkey % 4 WHEN 0 THEN 'GK' WHEN 1 THEN 'DF' WHEN 2 THEN 'MF' ELSE 'FW' END AS position
FROM supplier JOIN nation ON n_nationkey = s_nationkey""")
def q_seed_squads(spark, sf):
    """The squads seed, a document a team, exploded to players."""
    k = F.col("s_suppkey") % 4
    player = F.struct((F.col("s_suppkey") % 99).cast("int").alias("number"), F.col("s_name").alias("name"),
                      F.when(k == 0, "GK").when(k == 1, "DF").when(k == 2, "MF").otherwise("FW").alias("position"))
    s = td.table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.collect_list(player).alias("players"))
    n = td.table(spark, sf, "nation")
    docs = n.join(s, n.n_nationkey == s.s_nationkey).select(
        F.col("n_name").alias("team"), F.concat(F.lit("Coach "), F.col("n_nationkey").cast("string")).alias("coach"), "players")
    return raw.squad_players(_seed(spark, "squads", docs))


@query("read_csv_table", with_fixtures(EM, """
SELECT team_id, team_name, competition_id, season_id, points, goal_diff, xg_for, rank_overall FROM (""" + STANDINGS_SQL + ")",
                                       TIMELINE + "," + TEAM_PERF))
def q_read_csv_table(spark, sf):
    """Standings exported as CSV with a header and read back with an explicit schema."""
    s = gold.standings(tp_frame(spark, sf)).select("team_id", "team_name", "competition_id", "season_id", "points",
                                                   "goal_diff", "xg_for", "rank_overall")
    path = scratch_dir(spark, "csv-standings")
    s.write.option("header", True).csv(path)
    schema = ("team_id long, team_name string, competition_id int, season_id int, points long, goal_diff long, "
              "xg_for double, rank_overall long")
    return raw.read_csv_table(spark, path, schema)


@query("concat_sources", with_fixtures(["fx_form"], """
SELECT team_id, match_num, goals_for, CASE WHEN team_id % 3 = 1 THEN NULL ELSE goals_against END AS goals_against,
       xg_for, CASE WHEN team_id % 3 = 0 THEN NULL ELSE xg_against END AS xg_against,
       'L' || CAST(team_id % 3 AS VARCHAR) AS league
FROM fx_form"""))
def q_concat_sources(spark, sf):
    """Per-league frames with different columns put together by name, with a provenance label."""
    f = td.fx_form(spark, sf).select("team_id", "match_num", "goals_for", "goals_against", "xg_for", "xg_against")
    frames = {"L0": f.filter("team_id % 3 = 0").drop("xg_against"),
              "L1": f.filter("team_id % 3 = 1").drop("goals_against"),
              "L2": f.filter("team_id % 3 = 2")}
    return raw.concat_sources(frames)


def _club_files(spark, sf):
    """Club season files per category, with two-level headers flattened to 'Group_Stat' names."""
    p = pms_frame(spark, sf).groupBy("player_name", "team_name").agg(
        F.sum("goals").alias("Performance_Gls"), F.sum("shots_total").alias("Standard_Sh"),
        F.round(F.sum("xg_total"), 2).alias("Expected_xG"),
        F.round(F.sum(F.when(F.col("penalties_taken").isNull(), F.col("xg_total"))
                      .otherwise(F.col("xg_total") - F.col("penalties_taken") * 0.76)), 2).alias("Expected_npxG"),
        F.sum("passes_complete").alias("Total_Cmp"), F.sum("passes_total").alias("Total_Att"),
        F.sum("assists").alias("Ast"), F.sum("last_minute_seen").alias("Playing Time_Min"))
    base = p.withColumnsRenamed({"player_name": "Player", "team_name": "Squad"})
    shooting = scratch_dir(spark, "club-shooting")
    passing = scratch_dir(spark, "club-passing")
    base.select("Player", "Squad", "Performance_Gls", "Standard_Sh", "Expected_xG", "Expected_npxG",
                "Playing Time_Min").write.parquet(shooting)
    base.select("Player", "Total_Cmp", "Total_Att", "Ast").write.parquet(passing)
    return raw.read_categories(spark, {"shooting": shooting, "passing": passing,
                                       "defense": scratch_dir(spark, "club-defense-missing")}, optional=True)


CLUB_SQL = """
club AS (
  SELECT player_name, team_name, CAST(sum(goals) AS DOUBLE) AS goals, CAST(sum(shots_total) AS DOUBLE) AS shots,
         CAST(round(sum(xg_total), 2) AS DOUBLE) AS xg, CAST(sum(passes_complete) AS DOUBLE) AS total_cmp,
         CAST(sum(passes_total) AS DOUBLE) AS total_att, CAST(sum(last_minute_seen) AS DOUBLE) AS minutes
  FROM pms GROUP BY player_name, team_name)"""


@query("club_stats", with_fixtures(EM, "SELECT * FROM club", TIMELINE + "," + PLAYER_STATS + "," + CLUB_SQL))
def q_club_stats(spark, sf):
    """Category files read (a missing category skipped), columns resolved by name (exact, then suffix:
    'xg' binds Expected_xG, not Expected_npxG) and keyword-selected, joined per player."""
    cats = _club_files(spark, sf)
    sh, pa = cats["shooting"], cats["passing"]
    s = sh.select(F.col("Player").alias("player_name"), F.col("Squad").alias("team_name"),
                  raw.resolve_col(sh, ["gls", "goals"], "goals"), raw.resolve_col(sh, ["sh", "shots"], "shots"),
                  raw.resolve_col(sh, ["xg"], "xg"), raw.resolve_col(sh, ["min", "minutes"], "minutes"))
    p = raw.select_matching(pa, ["cmp", "att"], keep=["Player"]).withColumnRenamed("Player", "player_name")
    return s.join(p, "player_name", "left")


@query("name_join", with_fixtures(EM, """
SELECT p.match_id, p.player_id, p.player_name, c.goals AS club_goals, c.xg AS club_xg
FROM pms p LEFT JOIN club c ON lower(trim(c.player_name)) = lower(trim(p.player_name))""",
                                  TIMELINE + "," + PLAYER_STATS + "," + CLUB_SQL))
def q_name_join(spark, sf):
    """Best-effort name join of player-match stats to club season stats (one club row kept per name)."""
    club = q_club_stats(spark, sf).select("player_name", F.col("goals").alias("club_goals"),
                                          F.col("xg").alias("club_xg"), "minutes")
    j = players.attach_club_stats(pms_frame(spark, sf).select("match_id", "player_id", "player_name"), club)
    return j.select("match_id", "player_id", "player_name", "club_goals", "club_xg")


# ---------------------------------------------------------------- stored tables (SNK-01..06, 11, 12)


@query("upsert_timeline", with_fixtures(EM, "SELECT * FROM tl", TIMELINE))
def q_upsert_timeline(spark, sf):
    """Keyed upsert: first-half events loaded, then the full timeline upserted twice (the second run
    changes nothing); matched rows take the new values, the rest are inserted."""
    tl = tl_frame(spark, sf)
    layer = Layer(spark, scratch_dir(spark, "layer-upsert"))
    keys = ["event_id", "match_id"]
    layer.upsert(tl.filter(F.col("period") == 1).withColumn("duration", F.lit(-1.0)), "timeline", keys)
    layer.upsert(tl, "timeline", keys)
    layer.upsert(tl, "timeline", keys)
    return layer.read("timeline")


def _halves(spark, sf):
    """First and second half of the timeline's rows by event id, the second with a column of its own."""
    tl = tl_frame(spark, sf)
    return tl, tl.filter(F.col("event_id") % 2 == 0), tl.filter(F.col("event_id") % 2 == 1)


@query("append_merge", with_fixtures(EM, """
SELECT event_id, match_id, type_name, period, CASE WHEN event_id % 2 = 1 THEN 'late' END AS batch FROM tl""", TIMELINE))
def q_append_merge(spark, sf):
    """Rows appended with a new column: earlier rows read it as null (schema merge)."""
    _, even, odd = _halves(spark, sf)
    cols = ["event_id", "match_id", "type_name", "period"]
    layer = Layer(spark, scratch_dir(spark, "layer-append"))
    layer.append(even.select(*cols), "events")
    layer.append(odd.select(*cols, F.lit("late").alias("batch")), "events")
    return layer.read("events", merge_schema=True)


@query("upsert_after_overwrite", with_fixtures(EM, """
SELECT event_id, match_id, type_name, CASE WHEN event_id % 2 = 1 THEN -1 ELSE period END AS period FROM tl""", TIMELINE))
def q_upsert_after_overwrite(spark, sf):
    """A plain table that is upserted keeps the rows the source doesn't name."""
    tl, _, odd = _halves(spark, sf)
    cols = ["event_id", "match_id", "type_name", "period"]
    layer = Layer(spark, scratch_dir(spark, "layer-over"))
    layer.overwrite(tl.select(*cols), "events")
    layer.upsert(odd.select(*cols).withColumn("period", F.lit(-1).cast(tl.schema["period"].dataType)), "events", ["event_id", "match_id"])
    return layer.read("events")


@query("upsert_then_append", with_fixtures(EM, "SELECT event_id, match_id, type_name, period FROM tl", TIMELINE))
def q_upsert_then_append(spark, sf):
    """Rows appended to a keyed table are read with the others, and matched by the next upsert."""
    _, even, odd = _halves(spark, sf)
    cols = ["event_id", "match_id", "type_name", "period"]
    layer = Layer(spark, scratch_dir(spark, "layer-then"))
    layer.upsert(even.select(*cols), "events", ["event_id", "match_id"])
    layer.append(odd.select(*cols), "events")
    layer.upsert(odd.select(*cols), "events", ["event_id", "match_id"])
    return layer.read("events")


@query("layer_roundtrip", with_fixtures(EM, "SELECT * FROM tp", TIMELINE + "," + TEAM_PERF))
def q_layer_roundtrip(spark, sf):
    """Overwrite partitioned by edition, replace one season's partitions (dynamic), read back."""
    tp = tp_frame(spark, sf)
    layer = Layer(spark, scratch_dir(spark, "layer-tp"))
    layer.overwrite(tp, "team_performance", ["competition_id", "season_id"])
    layer.replace_partitions(tp.filter(F.col("season_id") == 106), "team_performance", ["competition_id", "season_id"])
    out = layer.read("team_performance")
    return out.select(*tp.columns)


@query("export_table", with_fixtures(EM, "SELECT *, 'standings' AS _source_table FROM (" + STANDINGS_SQL + ")",
                                     TIMELINE + "," + TEAM_PERF))
def q_export_table(spark, sf):
    """Serving export (audit columns dropped, one file) loaded back with its source name."""
    s = with_audit(gold.standings(tp_frame(spark, sf)), "team_performance")
    layer = Layer(spark, scratch_dir(spark, "layer-export"))
    layer.export(s, "standings")
    return layer.load_export("standings").drop("_loaded_at")


@query("audit_on_write", with_fixtures(EM, """
SELECT count(*) AS rows, count(*) FILTER (WHERE match_date IS NULL) AS nulls_match_date, count(*) FILTER (WHERE loc_x IS NULL) AS nulls_loc_x,
       count(*) FILTER (WHERE shot_xg IS NULL) AS nulls_shot_xg, count(*) FILTER (WHERE pass_type IS NULL) AS nulls_pass_type
FROM tl""", TIMELINE))
def q_audit_on_write(spark, sf):
    """Rows and nulls of the timeline, counted by the job that writes it."""
    layer = Layer(spark, scratch_dir(spark, "layer-audit"))
    return layer.overwrite_audited(tl_base(spark, sf), "timeline", ["match_date", "loc_x", "shot_xg", "pass_type"])


@query("table_stats")
def q_table_stats(spark, sf):
    """Files, bytes and rows of a stored table (from file metadata)."""
    layer = Layer(spark, scratch_dir(spark, "layer-stats"))
    layer.overwrite(tl_base(spark, sf), "timeline", ["competition_id"])
    return layer.table_stats("timeline")


@query("list_tables")
def q_list_tables(spark, sf):
    """Serving tables stored, registered as views and listed by a name pattern (catalog listing)."""
    layer = Layer(spark, scratch_dir(spark, "layer-catalog"))
    tp = tp_frame(spark, sf)
    for name, df in (("gold_standings", gold.standings(tp)), ("gold_team_style", gold.team_style(tp)),
                     ("silver_team_performance", tp)):
        layer.overwrite(df, name)
        layer.register(name)
    return layer.list("gold_*")
