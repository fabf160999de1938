"""Readers and conformers for raw provider files: JSON documents with explicit schemas, flat or
nested match documents, type-nested events, line-ups keyed by team name, freeze frames,
historical results in rounds, category files with two-level headers, CSV and seed lists."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fulltime.functions.common import sanitise_name
from fulltime.operators.numbering import numbered
from fulltime.sources.event_columns import EXTRA


def read_json_docs(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False,
                   keep_corrupt: bool = True) -> DataFrame:
    """JSON files with an explicit schema (no inference pass); malformed records are kept in
    ``_corrupt_record``, or fail the job where ``keep_corrupt`` is off. ``multiline`` reads one document (or array) per file."""
    s = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    s = StructType([*s.fields, StructField("_corrupt_record", StringType())] if keep_corrupt else s.fields)
    r = spark.read.schema(s).option("mode", "PERMISSIVE" if keep_corrupt else "FAILFAST")
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", "_corrupt_record")
    return r.option("multiLine", multiline).json(path)


def key_from_path(pattern: str, group: int = 1) -> Column:
    """A key taken from the source file name (for example the match id of a per-match file)."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)


def col_or_null(df: DataFrame, path: str, dtype: str = "string") -> Column:
    """Nested or flat column when present in the schema, else a typed null (optional provider fields)."""
    head, *rest = path.split(".")
    if head not in df.columns:
        return F.lit(None).cast(dtype)
    t = df.schema[head].dataType
    for part in rest:
        if not isinstance(t, StructType) or part not in t.fieldNames():
            return F.lit(None).cast(dtype)
        t = t[part].dataType
    return F.col(path).cast(dtype)


def _team(side: str) -> tuple:
    return ((f"{side}_team_id", "bigint", f"{side}_team_id", f"{side}_team.{side}_team_id"),
            (f"{side}_team_name", "string", f"{side}_team", f"{side}_team.{side}_team_name"),
            (f"{side}_team_country", "string", f"{side}_team_country_name", f"{side}_team.country.name"),
            (f"{side}_score", "bigint", f"{side}_score", f"{side}_score"))


#: Match fields: column, type, name in a flat document, path in a nested one.
MATCH_FIELDS = (
    ("match_id", "bigint", "match_id", "match_id"), ("match_date", "date", "match_date", "match_date"), ("kick_off", "string", "kick_off", "kick_off"),
    ("match_week", "int", "match_week", "match_week"), ("match_status", "string", "match_status", "match_status"),
    ("competition_id", "int", "competition_id", "competition.competition_id"),
    ("competition_name", "string", "competition_name", "competition.competition_name"),
    ("competition_country", "string", "competition_country_name", "competition.country_name"),
    ("season_id", "int", "season_id", "season.season_id"), ("season_name", "string", "season", "season.season_name"), *_team("home"), *_team("away"),
    ("stage_id", "int", "competition_stage_id", "competition_stage.id"), ("stage_name", "string", "competition_stage", "competition_stage.name"),
    ("stadium_id", "int", "stadium_id", "stadium.id"), ("stadium_name", "string", "stadium", "stadium.name"),
    ("stadium_country", "string", "stadium_country_name", "stadium.country.name"),
    ("referee_id", "int", "referee_id", "referee.id"), ("referee_name", "string", "referee", "referee.name"),
)


def conform_matches(df: DataFrame) -> DataFrame:
    """Flat or nested match documents projected to one schema; fields a document doesn't have are typed nulls.

    A document is nested where its competition is an object."""
    nested = "competition" in df.columns and isinstance(df.schema["competition"].dataType, StructType)
    return df.select(*[col_or_null(df, path if nested else flat, kind).alias(name) for name, kind, flat, path in MATCH_FIELDS])


#: Core fields of a provider event: column, type, path.
CORE_EVENT = (
    ("event_id", "bigint", "id"), ("event_index", "bigint", "index"), ("period", "int", "period"), ("minute", "bigint", "minute"),
    ("second", "bigint", "second"), ("duration", "double", "duration"), ("type_name", "string", "type.name"), ("team_id", "bigint", "team.id"),
    ("team_name", "string", "team.name"), ("player_id", "bigint", "player.id"), ("player_name", "string", "player.name"),
    ("loc_x", "double", "location[0]"), ("loc_y", "double", "location[1]"), ("under_pressure", "boolean", "under_pressure"),
    ("counterpress", "boolean", "counterpress"), ("shot_xg", "double", "shot.statsbomb_xg"), ("shot_outcome", "string", "shot.outcome.name"),
    ("shot_type", "string", "shot.type.name"), ("shot_body_part", "string", "shot.body_part.name"), ("pass_outcome", "string", "pass.outcome.name"),
    ("pass_type", "string", "pass.type.name"), ("pass_shot_assist", "boolean", "pass.shot_assist"), ("pass_goal_assist", "boolean", "pass.goal_assist"),
    ("pass_cross", "boolean", "pass.cross"), ("duel_outcome", "string", "duel.outcome.name"), ("duel_type", "string", "duel.type.name"),
    ("pass_end_x", "double", "pass.end_location[0]"), ("pass_end_y", "double", "pass.end_location[1]"),
    ("carry_end_x", "double", "carry.end_location[0]"), ("carry_end_y", "double", "carry.end_location[1]"), ("pass_length", "double", "pass.length"),
)

EVENT_FIELDS = (*CORE_EVENT, *[(c.name, c.type, c.path) for c in EXTRA])


def _tree(fields) -> dict:
    """Nested fields by path; a leaf is its type, a place in an array makes an array of doubles."""
    out: dict = {}
    for _, kind, path in fields:
        *parts, last = path.split(".")
        at = out
        for p in parts:
            at = at.setdefault(p, {})
        at[last.partition("[")[0]] = "array<double>" if "[" in last else kind
    return out


def _ddl(tree: dict) -> str:
    return ", ".join(f"`{k}`: {v if isinstance(v, str) else f'struct<{_ddl(v)}>'}" for k, v in tree.items())


#: Schema of a provider event file: the fields that are read, nested as the provider nests them.
RAW_EVENT_SCHEMA = _ddl(_tree(EVENT_FIELDS))


def conform_events(raw: DataFrame, match_id: Column) -> DataFrame:
    """Type-nested provider events -> the flat event table (arrays to x/y, nested names to columns).

    Fields that a file doesn't have are typed nulls.
    """
    def column(kind: str, path: str) -> Column:
        field, _, place = path.partition("[")
        return F.get(col_or_null(raw, field, "array<double>"), int(place[:-1])) if place else col_or_null(raw, field, kind)

    return raw.select(match_id.alias("match_id"), *[column(kind, path).alias(name) for name, kind, path in EVENT_FIELDS])


LINEUP_TYPE = (
    "map<string, array<struct<player_id: long, player_name: string, player_nickname: string, jersey_number: int, "
    "country: struct<id: long, name: string>, cards: array<struct<time: string, card_type: string, reason: string>>, "
    "positions: array<struct<position_id: int, position: string, from: string, to: string, start_reason: string, end_reason: string>>>>>"
)


def explode_lineups(text: DataFrame, match_id: Column) -> DataFrame:
    """Line-up documents keyed by team name -> one row per (match, team, player): first position with its times,
    country, numbers of positions and cards, and both lists as JSON."""
    doc = text.select(match_id.alias("match_id"), F.from_json("value", LINEUP_TYPE).alias("doc"))
    teams = doc.select("match_id", F.explode("doc").alias("team_name", "players"))
    p = teams.select("match_id", "team_name", F.explode("players").alias("p"))
    first = F.get("p.positions", 0)
    return p.select(
        "match_id", "team_name", "p.player_id", "p.player_name", "p.player_nickname", "p.jersey_number",
        F.col("p.country.id").alias("country_id"), F.col("p.country.name").alias("country_name"),
        first.getField("position_id").alias("position_id"), first.getField("position").alias("position_name"),
        first.getField("from").alias("position_from"), first.getField("to").alias("position_to"),
        F.size("p.positions").alias("n_positions"), F.coalesce(F.size("p.cards"), F.lit(0)).alias("n_cards"),
        F.to_json("p.positions").alias("positions_json"), F.to_json("p.cards").alias("cards_json"))


FRAME_SCHEMA = ("event_uuid long, match_id long, location array<double>, teammate boolean, actor boolean, keeper boolean, "
                "visible_area array<double>")


def conform_frames(raw: DataFrame) -> DataFrame:
    """Freeze-frame rows: location array to x/y, flags to booleans (absent = false), the visible area as it is."""
    return raw.select(F.col("event_uuid").alias("event_id"), "match_id",
                      F.get("location", 0).cast("double").alias("loc_x"), F.get("location", 1).cast("double").alias("loc_y"),
                      F.coalesce("teammate", F.lit(False)).alias("is_teammate"),
                      F.coalesce("actor", F.lit(False)).alias("is_actor"),
                      F.coalesce("keeper", F.lit(False)).alias("is_keeper"), "visible_area")


RESULTS_SCHEMA = (
    "name string, rounds array<struct<name: string, matches: array<struct<num: long, date: string, "
    "team1: struct<name: string>, team2: struct<name: string>, score: struct<ft: array<long>, ht: array<long>>, "
    "goals: array<struct<name: string, team: int, minute: int>>>>>>"
)


def flatten_results(docs: DataFrame) -> DataFrame:
    """Edition documents -> one row per match: split full/half-time scores, result, goal count, goals as JSON."""
    r = docs.select("name", F.explode("rounds").alias("r"))
    m = r.select("name", F.col("r.name").alias("round"), F.explode("r.matches").alias("m"))
    h, a = F.get("m.score.ft", 0), F.get("m.score.ft", 1)
    return m.select(
        F.col("name").alias("edition"), "round", F.col("m.num").alias("match_num"),
        F.to_date("m.date").alias("match_date"), F.col("m.team1.name").alias("home_team"),
        F.col("m.team2.name").alias("away_team"), h.alias("home_score"), a.alias("away_score"),
        F.get("m.score.ht", 0).alias("home_score_ht"), F.get("m.score.ht", 1).alias("away_score_ht"),
        F.when(h > a, "H").when(h == a, "D").when(h < a, "A").alias("result"),
        F.size("m.goals").alias("n_goals"), F.to_json("m.goals").alias("goals_json"))


def explode_goals(results: DataFrame) -> DataFrame:
    """The goals JSON of each match -> one row per goal (matches without goals keep one null row)."""
    g = results.select("match_num", F.explode_outer(F.from_json("goals_json", "array<struct<name: string, team: int, "
                                                                              "minute: int>>")).alias("g"))
    return g.select("match_num", F.col("g.name").alias("scorer"), F.col("g.team").alias("team_side"),
                    F.col("g.minute").alias("minute"))


def regroup_results(flat: DataFrame) -> DataFrame:
    """Upstream shape (a match list with round/group labels and goals per side) -> round-grouped form:
    a label per match (group, else round, else 'Unknown') and one goal list tagged with the side."""
    label = F.coalesce(F.col("group"), F.col("round"), F.lit("Unknown"))
    g1 = F.transform(F.coalesce("goals1", F.array()), lambda g: F.struct(g.getField("name").alias("name"),
                                                                          F.lit(1).alias("team"),
                                                                          g.getField("minute").alias("minute")))
    g2 = F.transform(F.coalesce("goals2", F.array()), lambda g: F.struct(g.getField("name").alias("name"),
                                                                          F.lit(2).alias("team"),
                                                                          g.getField("minute").alias("minute")))
    return flat.select("num", label.alias("round_label"), F.concat(g1, g2).alias("goals"))


def regroup_rounds(matches: DataFrame, order: Sequence[str]) -> DataFrame:
    """Upstream match lists in file order -> matches of the stored form, numbered and placed in their round.

    ``matches`` has edition, group, round, date, team1, team2, goals1, goals2 (arrays of name and minute) and the
    columns of ``order``, which give the order in the edition's list. A match gets its running number in the
    edition (``num``, from 1), its round's label (group, else round, else 'Unknown') and the place of that round in
    order of first appearance (``round_place``, from 1); each goal names the team that scored it, the first
    team's goals before the second's.

    Numbers come from range partitions and offsets, and an edition's first number is one aggregate, so no
    window holds all matches, nor an edition's; the place is a window over the rounds of an edition.
    """
    def goals(list_: str, team: str) -> Column:
        return F.transform(F.coalesce(list_, F.array()), lambda g: F.struct(
            F.coalesce(g.getField("name"), F.lit("")).alias("name"), F.coalesce(F.col(team), F.lit("")).alias("team"),
            F.coalesce(g.getField("minute"), F.lit(0)).alias("minute")))

    flat = matches.select("*", F.coalesce("group", "round", F.lit("Unknown")).alias("round_label"))
    placed = numbered(flat, ["edition", *order], "_n", first=1)
    rounds = placed.groupBy("edition", "round_label").agg(F.min("_n").alias("_first"))
    edition = Window.partitionBy("edition")  # the rounds of an edition
    rounds = rounds.select(F.col("edition").alias("_e"), F.col("round_label").alias("_r"), (F.min("_first").over(edition) - 1).alias("_before"),
                           F.row_number().over(edition.orderBy("_first")).alias("round_place"))
    return placed.join(rounds, F.col("edition").eqNullSafe(F.col("_e")) & (F.col("round_label") == F.col("_r"))).select(
        "edition", "round_label", "round_place", (F.col("_n") - F.col("_before")).alias("num"), "date", "team1", "team2",
        F.concat(goals("goals1", "team1"), goals("goals2", "team2")).alias("goals"))


def header_names(upper: Sequence[str], lower: Sequence[str]) -> list[str]:
    """Column names of a two-line header: the upper label goes on to the right until the next one (``Unnamed...`` is
    a group without label), and is put before the lower one; repeated names are numbered from the second on."""
    out: list[str] = []
    group = ""
    for i in range(max(len(upper), len(lower))):
        over = upper[i].strip() if i < len(upper) else ""
        group = "" if over.startswith("Unnamed") else over or group
        under = lower[i].strip() if i < len(lower) else ""
        name = "_".join(x for x in (group, "" if under.startswith("Unnamed") else under) if x) or f"column_{i + 1}"
        seen = sum(o == name or o.startswith(f"{name}__") for o in out)
        out.append(f"{name}__{seen + 1}" if seen else name)
    return out


def read_two_level(spark: SparkSession, path: str, text: Sequence[str] = ()) -> DataFrame:
    """A delimited file whose first two lines are a header of groups and names (as statistics pages export them).

    Columns are named by ``header_names``; those of ``text`` stay strings, the others are numbers (null where the
    field is none). Lines that repeat a header line are no rows: such exports repeat them within the table. The
    driver sees the two header lines only. A field has no line end in it.
    """
    lines = spark.read.text(path)
    head = [r[0] for r in lines.where(F.col("_metadata.file_block_start") == 0).select("value").take(2)]
    if len(head) < 2:
        raise ValueError(f"{path} has no header of two lines")
    names = header_names(*csv.reader(head))
    rows = lines.where(~F.col("value").isin(head) & (F.trim("value") != ""))
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(len(names))), {"mode": "PERMISSIVE"})
    return rows.select(fields.alias("f")).select(*[
        (F.nullif(F.col(f"f.c{i}"), F.lit("")) if n in text else F.expr(f"try_cast(f.c{i} AS double)")).alias(n) for i, n in enumerate(names)])


def read_leagues(spark: SparkSession, paths: dict[str, str], text: Sequence[str] = (), label_col: str = "league") -> DataFrame:
    """Two-level files by league, each with its own columns, put together by name with the league beside."""
    return concat_sources({league: read_two_level(spark, path, text) for league, path in paths.items()}, label_col)


#: Seed lists: what each holds.
SEEDS = {
    "teams": "id int, team string, region_id int",
    "rankings": "rank int, team string, id string, points double, confederation string",
    "history": "year int, host string, champion string, runner_up string, matches long, goals long",
    "editions": "year int, name string, matches long",
    "squads": "team string, coach string, players array<struct<number: int, name: string, position: string>>",
}


def read_seed(spark: SparkSession, path: str, name: str, lines: bool = True) -> DataFrame:
    """A seed list with its explicit schema: rows as JSON lines, or whole files of one JSON array (``lines=False``)."""
    return read_json_docs(spark, path, SEEDS[name], multiline=not lines, keep_corrupt=False)


def squad_players(squads: DataFrame) -> DataFrame:
    """One row for each player of the squads seed."""
    return squads.select("team", "coach", F.explode("players").alias("p")).select("team", "coach", "p.*")


def read_categories(spark: SparkSession, paths: dict[str, str], optional: bool = False) -> dict[str, DataFrame]:
    """Category files by name; a missing path fails unless ``optional``, any other failure always does."""
    from fulltime.sources.layer import Layer

    there = {name: path for name, path in paths.items() if not optional or Layer(spark, path.rpartition("/")[0]).exists(path.rpartition("/")[2])}
    return {name: spark.read.parquet(path) for name, path in there.items()}


def resolve_col(df: DataFrame, candidates: Sequence[str], alias: str, dtype: str = "double") -> Column:
    """First candidate that names a column, case-insensitive: exact name, then name suffix, then substring."""
    cols = df.columns
    low = {c.lower(): c for c in cols}
    for cand in candidates:
        if cand.lower() in low:
            return F.col(f"`{low[cand.lower()]}`").cast(dtype).alias(alias)
    for cand in candidates:
        hits = [c for c in cols if c.lower().endswith("_" + cand.lower())]
        if hits:
            return F.col(f"`{hits[0]}`").cast(dtype).alias(alias)
    for cand in candidates:
        hits = [c for c in cols if cand.lower() in c.lower()]
        if hits:
            return F.col(f"`{hits[0]}`").cast(dtype).alias(alias)
    return F.lit(None).cast(dtype).alias(alias)


def select_matching(df: DataFrame, keywords: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keep ``keep`` plus every column whose name contains a keyword, renamed to a safe name, as double."""
    rx = re.compile("|".join(re.escape(k.lower()) for k in keywords))
    picked = [c for c in df.columns if c not in keep and rx.search(c.lower())]
    return df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(sanitise_name(c)) for c in picked])


def concat_sources(frames: dict[str, DataFrame], label_col: str = "league") -> DataFrame:
    """Frames with different columns unioned by name (missing columns null) with a provenance label."""
    out = None
    for label, df in frames.items():
        d = df.withColumn(label_col, F.lit(label))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and an explicit schema; empty fields read as null."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "").csv(path)
