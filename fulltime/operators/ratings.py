"""Sequential team ratings, snapshots, latest values and as-of lookups.

A rating update couples the two teams of a match, so a match depends on the previous match of either team;
matches without such a bond, and those of different pools (independent competition histories), don't. Two ways
give the same ratings, both in column expressions only:

* ``_by_pool``: a pool's matches are one sorted array, folded by ``aggregate`` over an array of ratings. For
  pools of a bounded size (``POOL_MATCHES`` matches, ``POOL_STEPS`` matches times teams).
* ``_by_level``: larger pools are spread over tasks by dependency level. Each team waits for its next match; a
  match both of whose teams wait for it can be rated, all such matches at once, and its teams then wait for
  their next ones. A round works on one row a team, its state is a stored table, and the rounds are as many as
  the longest chain of matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulltime.functions import football as fb
from fulltime.functions.common import rnd
from fulltime.operators.numbering import numbered
from fulltime.session import scratch_dir, stored

START_RATING = 1000.0

RESULT_COLUMNS = ["pool_id", "match_num", "match_date", "home_team", "away_team", "home_score", "away_score", "round"]
#: Largest pool that is folded as one array: matches, and matches times teams (a step copies the teams' ratings).
POOL_MATCHES = 1 << 18
POOL_STEPS = 1 << 28
#: Matches of an inner array: a step copies the references of those before it.
RUN = 512

_BEFORE = ("rh", "ra")
#: Expected score of the home side.
_EXPECTED = "1D / (1D + power(10D, (ra - rh) / 400D))"


def _won() -> Column:
    return F.when(F.col("home_score") > F.col("away_score"), 1.0).when(F.col("home_score") == F.col("away_score"), 0.5).otherwise(0.0)


def _after(rated: DataFrame) -> DataFrame:
    """nh and na, the ratings after a match, from those before it and the expected score e."""
    gain = F.col("k_factor") * (_won() - F.col("e"))
    return rated.select("*", (F.col("rh") + gain).alias("nh"), (F.col("ra") - gain).alias("na"))


def _by_pool(matches: DataFrame) -> DataFrame:
    """``matches`` with rh, ra, nh, na (ratings before and after) and e, folded pool by pool in one array each."""
    order = [F.col("match_date").isNotNull().alias("dated"), "match_date", F.col("match_num").isNotNull().alias("numbered"), "match_num"]
    rest = [c for c in matches.columns if c not in ("pool_id", "match_date", "match_num")]
    pools = matches.groupBy("pool_id").agg(
        F.sort_array(F.collect_list(F.struct(*order, *rest, _won().alias("won")))).alias("ms"),
        F.array_union(F.collect_set("home_team"), F.collect_set("away_team")).alias("teams"))
    # a step's input: its teams' places among the ratings, what the match weighs and how it ended
    steps = """transform(ms, m -> named_struct('h', cast(array_position(teams, m.home_team) - 1 as int),
                                               'a', cast(array_position(teams, m.away_team) - 1 as int), 'k', m.k_factor, 'won', m.won))"""
    out = "array<struct<rh: double, ra: double, e: double>>"

    def let(value: str, name: str, body: str) -> str:
        return f"transform(array({value}), {name} -> {body})[0]"

    step = """named_struct(
      'r', transform(t.r, (x, i) -> CASE WHEN i = m.a THEN x_ra - m.k * (m.won - e) WHEN i = m.h THEN x_rh + m.k * (m.won - e) ELSE x END),
      'out', concat(t.out, array(named_struct('rh', x_rh, 'ra', x_ra, 'e', e))))""".replace("x_ra", "t.r[m.a]").replace("x_rh", "t.r[m.h]")
    step = let(_EXPECTED.replace("rh", "t.r[m.h]").replace("ra ", "t.r[m.a] "), "e", step)
    run = f"aggregate(run, named_struct('r', s.r, 'out', cast(array() as {out})), (t, m) -> {step})"
    folded = f"""aggregate(
      transform(sequence(0, (size(steps) - 1) div {RUN}), i -> slice(steps, cast(i * {RUN} + 1 as int), {RUN})),
      named_struct('r', transform(teams, x -> {START_RATING}D), 'outs', cast(array() as array<{out}>)),
      (s, run) -> {let(run, "d", "named_struct('r', d.r, 'outs', concat(s.outs, array(d.out)))")},
      s -> flatten(s.outs))"""
    held = pools.select("*", F.expr(steps).alias("steps")).select("pool_id", "ms", F.expr(folded).alias("out"))
    each = held.select("pool_id", F.explode(F.arrays_zip("ms", "out")).alias("z"))
    return _after(each.select(*[F.col("pool_id") if c == "pool_id" else F.col(f"z.ms.{c}") for c in matches.columns],
                              *[F.col(f"z.out.{c}") for c in (*_BEFORE, "e")]))


def _by_level(matches: DataFrame) -> DataFrame:
    """The same, all matches at once whose teams have no earlier match left to rate."""
    spark = matches.sparkSession
    # the number is the place in the order of pools; a team's side of a match knows its team's next match
    placed = numbered(matches.withColumn("_tie", F.xxhash64(*matches.columns)), ["pool_id", "match_date", "match_num", "_tie"], "_n").drop("_tie")
    sides = placed.select("pool_id", "_n", F.explode(F.array_distinct(F.array("home_team", "away_team"))).alias("team"))
    following = F.lead("_n").over(Window.partitionBy("pool_id", "team").orderBy("_n"))
    nexts = sides.select("pool_id", "team", "_n", following.alias("next"))
    nexts = stored(nexts, "sides")
    first = nexts.groupBy("pool_id", "team").agg(F.min("_n").alias("waits"))
    home, away = (nexts.select(F.col("_n"), F.col("team").alias(f"{s}_team"), F.col("next").alias(f"{s}_next")) for s in ("home", "away"))
    # in order of the numbers, so a round reads the row groups around its matches only
    todo = stored(placed.join(home, ["_n", "home_team"]).join(away, ["_n", "away_team"]).repartitionByRange("_n").sortWithinPartitions("_n"), "matches")
    waiting = stored(first.select("pool_id", "team", "waits", F.lit(START_RATING).alias("r")), "waiting")
    path = scratch_dir(spark, "rated")
    while True:
        ready = waiting.groupBy("waits").agg(F.count("*").alias("here"))
        pair = todo.join(ready, todo["_n"] == ready["waits"]).where(
            F.col("here") == F.when(F.col("home_team") == F.col("away_team"), 1).otherwise(2)).drop("waits", "here")
        span = waiting.agg(F.min("waits"), F.max("waits")).first()
        if span[0] is None:
            break
        pair = pair.where(F.col("_n").between(span[0], span[1]))
        rating = [waiting.select(F.col("waits").alias("_n"), F.col("team").alias(f"{s}_team"), F.col("r").alias(c)) for s, c in zip(("home", "away"), _BEFORE)]
        now = pair.join(rating[0], ["_n", "home_team"]).join(rating[1], ["_n", "away_team"]).withColumn("e", F.expr(_EXPECTED))
        now = stored(_after(now), "level")
        now.select(*matches.columns, *_BEFORE, "e", "nh", "na").write.mode("append").parquet(path)
        moved = now.select("pool_id", F.explode(F.array_distinct(F.array(  # of a team against itself, the away side counts
            F.struct(F.when(F.col("home_team") == F.col("away_team"), F.col("away_team")).otherwise(F.col("home_team")).alias("team"),
                     F.when(F.col("home_team") == F.col("away_team"), F.col("away_next")).otherwise(F.col("home_next")).alias("waits"),
                     F.when(F.col("home_team") == F.col("away_team"), F.col("na")).otherwise(F.col("nh")).alias("r")),
            F.struct(F.col("away_team").alias("team"), F.col("away_next").alias("waits"), F.col("na").alias("r"))))).alias("m")).select("pool_id", "m.*")
        done = now.select(F.col("_n").alias("waits"))
        waiting = stored(waiting.join(done, "waits", "left_anti").unionByName(moved.where("waits is not null")), "waiting")
    rated = matches.select("*", *[F.lit(0.0).alias(c) for c in (*_BEFORE, "e", "nh", "na")]).schema
    return spark.read.schema(rated).parquet(path)


def elo_ratings(results: DataFrame) -> DataFrame:
    """Before/after ratings of every scored match, in (match_date, match_num) order within its ``pool_id``.

    ``results`` needs pool_id, match_num, match_date, home_team, away_team, home_score, away_score, round.
    Matches without both scores or a team are not rated and not returned. Rows of null pool are a pool of their
    own, matches of null date (and number) come before the others; a team's rating starts at 1000 in every pool.
    """
    types = ("long", "long", "date", "string", "string", "long", "long", "string")
    known = [F.col(c).isNotNull() for c in ("home_score", "away_score", "home_team", "away_team")]
    r = results.where(known[0] & known[1] & known[2] & known[3])
    r = r.select(*[F.col(c).cast(t) for c, t in zip(RESULT_COLUMNS, types)], fb.k_factor("round").alias("k_factor"))
    sizes = r.groupBy("pool_id").agg(F.count("*").alias("n"), F.approx_count_distinct("home_team").alias("t"))
    large = sizes.where((F.col("n") > POOL_MATCHES) | (F.col("n") * F.col("t") > POOL_STEPS)).select(F.col("pool_id").alias("_large"))
    if large.isEmpty():
        out = _by_pool(r)
    else:
        same = F.col("pool_id").eqNullSafe(F.col("_large"))
        out = _by_pool(r.join(large, same, "left_anti")).unionByName(_by_level(r.join(large, same, "left_semi")))
    return out.select(
        *RESULT_COLUMNS, *[rnd(c, 1).alias(f"elo_{s}_{t}") for t, cs in (("before", ("rh", "ra")), ("after", ("nh", "na"))) for s, c in zip(("home", "away"), cs)],
        rnd(F.col("rh") - F.col("ra"), 1).alias("elo_diff"),
        rnd("e", 4).alias("we_home"), rnd(F.lit(1.0) - F.col("e"), 4).alias("we_away"), "k_factor",
    )


def team_sides(ratings: DataFrame, value: str = "after") -> DataFrame:
    """Both sides of every rated match as (pool_id, team, match_date, match_num, rating) rows, in one scan."""
    sides = F.explode(F.array(
        F.struct(F.col("home_team").alias("team"), F.col(f"elo_home_{value}").alias("rating")),
        F.struct(F.col("away_team").alias("team"), F.col(f"elo_away_{value}").alias("rating")),
    ))
    return ratings.select("pool_id", "match_date", "match_num", sides.alias("s")).select(
        "pool_id", "s.team", "match_date", "match_num", "s.rating")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Value of the row with the greatest ``order`` tuple per key (deterministic; partial aggregation)."""
    o = F.struct(*[F.col(x) for x in order])
    return df.groupBy(*keys).agg(*[F.max_by(F.col(v), o).alias(v) for v in values])


def elo_snapshot(ratings: DataFrame) -> DataFrame:
    """Final rating of every team in every pool."""
    return latest_by(team_sides(ratings), ["pool_id", "team"], ["match_date", "match_num"], ["rating"]) \
        .withColumnRenamed("rating", "elo_rating")


def elo_latest(ratings: DataFrame) -> DataFrame:
    """Most recent rating per team name across all pools."""
    return latest_by(team_sides(ratings), ["team"], ["match_date", "match_num", "pool_id"], ["rating"]) \
        .withColumnRenamed("rating", "elo_rating")


ASOF_BUCKET_SECONDS = 30 * 86400  # time buckets of the as-of join (30 days)


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], ts: str, values: Sequence[str],
              strict: bool = True, bucket_seconds: int = ASOF_BUCKET_SECONDS) -> DataFrame:
    """For each left row, the ``values`` of the latest right row with the same keys and an earlier ``ts``.

    The right side must be unique per (keys, ts); null right values are skipped. Both sides are
    unioned with a tag and cut into time buckets: ``last(ignorenulls)`` runs inside (keys, bucket)
    in (ts, tag) order (with ``strict`` left rows sort before right rows of the same instant, so only
    strictly earlier values count), and a left row with nothing earlier in its bucket takes the
    value carried in from the key's earlier buckets (per-bucket last values, then a window over
    buckets). One key with a third of all rows is therefore spread over its buckets.
    """
    lt, rt = (0, 1) if strict else (1, 0)
    lcols = left.columns
    bucket = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / bucket_seconds)
    l2 = left.select(*[F.col(c) for c in lcols], *[F.lit(None).cast(right.schema[v].dataType).alias(f"_r_{v}") for v in values],
                     F.lit(lt).alias("_tag"), F.lit(True).alias("_is_left"))
    r2 = right.select(*[F.col(k) for k in on], F.col(ts),
                      *[F.col(v).alias(f"_r_{v}") for v in values], F.lit(rt).alias("_tag"), F.lit(False).alias("_is_left"))
    u = l2.unionByName(r2, allowMissingColumns=True).withColumn("_bucket", bucket)
    w = Window.partitionBy(*on, "_bucket").orderBy(F.col(ts), F.col("_tag")).rowsBetween(Window.unboundedPreceding, 0)
    inside = u.select("*", *[F.last(F.col(f"_r_{v}"), ignorenulls=True).over(w).alias(f"_in_{v}") for v in values])
    per_bucket = r2.withColumn("_bucket", bucket).groupBy(*on, "_bucket").agg(
        *[F.max_by(F.col(f"_r_{v}"), F.when(F.col(f"_r_{v}").isNotNull(), F.col(ts))).alias(f"_b_{v}") for v in values])
    earlier = Window.partitionBy(*on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(*on, "_bucket", *[F.last(F.col(f"_b_{v}"), ignorenulls=True).over(earlier).alias(f"_c_{v}")
                                                for v in values])
    lefts = inside.filter(F.col("_is_left")).join(carry, [*on, "_bucket"], "left")
    return lefts.select(*lcols, *[F.coalesce(F.col(f"_in_{v}"), F.col(f"_c_{v}")).alias(v) for v in values])


def lookup_with_alias(names: DataFrame, name_col: str, values: DataFrame, key_col: str, value_col: str,
                      aliases: DataFrame, alias_from: str, alias_to: str, default: float | None = None) -> DataFrame:
    """Value by name, else by the name's alias, else ``default`` (null, if None): two left joins + coalesce."""
    v1 = values.select(F.col(key_col).alias("_k1"), F.col(value_col).alias("_v1"))
    v2 = values.select(F.col(key_col).alias("_k2"), F.col(value_col).alias("_v2"))
    a = aliases.select(F.col(alias_from).alias("_af"), F.col(alias_to).alias("_k2"))
    j = (names.join(v1, names[name_col] == v1["_k1"], "left")
         .join(a, names[name_col] == a["_af"], "left")
         .join(v2, "_k2", "left"))
    found = [F.col("_v1"), F.col("_v2"), *([F.lit(default)] if default is not None else [])]
    return j.select(*names.columns, F.coalesce(*found).alias(value_col))
