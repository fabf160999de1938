"""Results that must not change with size, incomplete data, hot groups, and the span of a stream."""

import datetime as dt
import decimal as dc
import random
import struct

import pytest
from pyspark.sql import functions as F

from fulltime.operators import quantiles, ratings, sets
from fulltime.operators.players import attach_club_stats

RESULT = "pool_id long, match_num long, match_date date, home_team string, away_team string, home_score long, away_score long, round string"


def _ordered(x):
    return (x != x, 0 if x != x else x)


@pytest.mark.parametrize("n", [1, 7, 1500])
def test_exact_quantiles(spark, n):
    r = random.Random(n)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"),
           float("-inf"), float("nan"), 1.0, 2.0, 4.0, 0.5, 2.0**-1022, 2.0**1023, 2.0**52, 2.0**53 - 1, 1 - 2.0**-53, -1 - 2.0**-52]
    data = {"a": [r.gauss(0, 1) for _ in range(n)], "b": [float(r.randrange(4)) for _ in range(n)], "c": [7.0] * min(n, 3) + [None] * (n - 3), "d": [None] * n,
            "e": [r.choice(odd) for _ in range(n)], "f": [r.uniform(-1, 1) * 10.0 ** r.randrange(-320, 308) for _ in range(n)],
            "g": [r.choice([-2**63, 2**63 - 1, 0, -1, r.randrange(-2**62, 2**62)]) for _ in range(n)],
            "h": [dc.Decimal(r.randrange(-10**11, 10**11)).scaleb(-2) for _ in range(n)]}
    kind = "a double, b double, c double, d double, e double, f double, g long, h decimal(12,2)"
    df = spark.createDataFrame(list(zip(*data.values())), kind).repartition(5)
    qs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = quantiles.exact_quantiles(df, {c: qs for c in data})
    for c, values in data.items():
        known = sorted((v for v in values if v is not None), key=_ordered)
        for q in qs:
            want = known[max(1, -(-int(q * 1000) * len(known) // 1000)) - 1] if known else None
            assert got[c, q] == want or (want != want and got[c, q] != got[c, q]), (c, q, got[c, q], want)


def test_every_double_keeps_its_order_and_value(spark):
    r = random.Random(2)
    bits = [r.randrange(2047 << 52) for _ in range(4000)] + [2**k for k in range(63) if 2**k < 2047 << 52] + [2**k - 1 for k in range(63) if 2**k < 2047 << 52]
    values = [struct.unpack("<d", struct.pack("<q", b))[0] for b in bits]
    df = quantiles._with_key(spark.createDataFrame([(v,) for v in values], "x double"), "x", "k")
    df = quantiles._with_key(df.withColumn("y", -F.col("x")), "y", "m")
    for row, b in zip(sorted(map(tuple, df.select("x", "k", "m").collect())), sorted(bits)):
        assert (row[1], row[2]) == (b, -b) and quantiles._double_of(b) == row[0] and quantiles._double_of(-b) == -row[0]


def test_quantiles_take_four_passes_at_any_size(spark):
    jobs = {}
    for n in (50, 60_000):
        df = spark.range(n).select((F.rand(n) * 1e6).alias("x"), F.col("id").alias("y")).repartition(4)
        spark.sparkContext.setJobGroup(f"quantiles-{n}", "")
        try:
            quantiles.exact_quantiles(df, {"x": (0.1, 0.5, 0.9), "y": (0.5,)})
            jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"quantiles-{n}"))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[50] == jobs[60_000]


def test_quantiles_read_the_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(row):
        read.add(1)
        return row

    rows = [(float(i % 50), i, None if i % 3 else i * 0.5) for i in range(600)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 1).map(seen), "x double, y long, z double")
    assert quantiles.exact_quantiles(df, {"x": (0.5,), "y": (0.25, 1.0), "z": (0.5,)}) == {("x", 0.5): 24.0, ("y", 0.25): 149, ("y", 1.0): 599, ("z", 0.5): 148.5}
    assert read.value == 600


def brute_ratings(rows):
    state, out = {}, {}
    for pool, num, day, home, away, hs, as_, _ in sorted((r for r in rows if r[5] is not None and r[6] is not None),
                                                         key=lambda r: (r[0] is not None, r[0] or 0, r[2] is not None, r[2] or dt.date.min, r[1])):
        a, b = state.get((pool, home), 1000.0), state.get((pool, away), 1000.0)
        gain = 50 * ((hs > as_) + 0.5 * (hs == as_) - 1 / (1 + 10 ** ((b - a) / 400)))
        state[pool, home], state[pool, away] = a + gain, b - gain
        out[pool, num] = round(a + gain, 1)
    return out


def test_ratings_of_incomplete_results(spark):
    r = random.Random(3)
    rows = [(None if i % 9 == 4 else i % 3, i, None if i % 7 == 2 else dt.date(2020, 1, 1) + dt.timedelta(r.randrange(300)), f"T{r.randrange(6)}",
             f"U{r.randrange(6)}", None if i % 11 == 0 else r.randrange(4), None if i % 13 == 0 else r.randrange(4), "Group A") for i in range(200)]
    got = {(x["pool_id"], x["match_num"]): x["elo_home_after"] for x in ratings.elo_ratings(spark.createDataFrame(rows, RESULT)).collect()}
    want = brute_ratings(rows)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=0.11) for k in want)


def test_a_pool_with_a_third_of_all_matches_is_rated_by_levels(spark, monkeypatch):
    r = random.Random(8)
    pool = lambda i: 0 if i % 3 == 0 else None if i % 3 == 1 and i % 2 else 1 + i % 40
    rows = [(pool(i), i, None if i % 50 == 7 else dt.date(2020, 1, 1) + dt.timedelta(i // 9), f"T{r.randrange(70)}", f"T{r.randrange(70)}",
             r.randrange(4), r.randrange(4), "Group A") for i in range(600)]
    df = spark.createDataFrame(rows, RESULT).repartition(4)
    whole = {tuple(x) for x in ratings.elo_ratings(df).collect()}
    monkeypatch.setattr(ratings, "POOL_MATCHES", 60)
    levels = ratings.elo_ratings(df)
    assert {tuple(x) for x in levels.collect()} == whole and len(whole) == 600
    got = {(x[0], x[1]): x[10] for x in whole}
    want = brute_ratings(rows)
    assert all(got[k] == pytest.approx(want[k], abs=0.11) for k in want)
    assert not any(w in levels._jdf.queryExecution().toString() for w in ("Python", "InPandas", "InArrow"))


def test_a_seventh_edition_is_not_lost(spark):
    df = spark.createDataFrame([(i, i % 7, 2000 + i % 2) for i in range(56)], "match_id long, competition_id int, season_id int")
    assert len(sets.editions(df)) == 14


def test_name_join_does_not_hang_on_order(spark):
    stats = spark.createDataFrame([(1, "José Pérez ")], "match_id long, player_name string")
    club = [("jose perez", "X", 90.0, 1), ("jose perez", "Y", 90.0, 2), ("jose perez", "X", 90.0, 3)]
    kind = "player_name string, club string, minutes double, goals int"
    got = {tuple(attach_club_stats(stats, spark.createDataFrame(rows, kind).repartition(n), fold_accents=True).select("club", "goals").first())
           for n, rows in ((1, club), (3, club[::-1]), (2, club[1:] + club[:1]))}
    assert got == {("X", 1)}


def test_streams_keep_rows_of_ninety_days(spark):
    from fulltime.session import scratch_dir
    from fulltime.sources.layer import Layer
    from fulltime.streaming import live

    start = dt.datetime(2024, 1, 1)
    rows = [(i, i % 4, start + dt.timedelta(hours=6 * i), float(i % 9)) for i in range(360)]
    df = spark.createDataFrame(rows, "reading long, venue_id long, collected_at timestamp, wind_speed_kmh double").repartition(4)
    root = scratch_dir(spark, "ninety")
    layer = Layer(spark, f"{root}/sink")
    live.replay(df, "collected_at", root, lambda s: live.to_table(live.weather_windows(s), layer, "w", ["venue_id", "window_start"], f"{root}/checkpoint"))
    assert layer.read("w").count() == 360 and layer.read("w").agg(F.sum("readings")).first()[0] == 360


def test_state_of_redelivered_events_stops_growing(spark):
    from fulltime.plans.streams import NATURAL, redelivered
    from fulltime.session import scratch_dir
    from fulltime.streaming import live

    start = dt.datetime(2024, 1, 1)
    rows = [(i, i // 9, "Pass", i % 5, i % 7, start + dt.timedelta(minutes=90 * i)) for i in range(1440)]  # 90 days
    events = spark.createDataFrame(rows, "delivery long, match_id long, event_type string, minute long, player_id long, ts timestamp")
    root = scratch_dir(spark, "redelivered")
    again = redelivered(events).repartition(4)
    progress = live.replay(again, "delivered_at", root, lambda s: live.to_files(
        live.dedup_stream(s, NATURAL, "delivered_at"), f"{root}/sink", f"{root}/checkpoint"), deliveries=12)
    sink = spark.read.parquet(f"{root}/sink")
    assert again.count() > 2000 and sink.count() == 1440 and sink.select(NATURAL).distinct().count() == 1440
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    # a span holds 120 events; state is that of one span at most, from the first to the last
    assert len(held) >= 12 and max(held[len(held) // 2:]) <= 2 * 120 and held[-1] < 120


def test_a_match_with_a_third_of_all_events(spark):
    from fulltime.operators import timeline

    rows = [(i, 1 if i < 3000 else 2 + i % 60, i, "Shot" if i % 10 == 0 else "Pass", "Goal" if i % 50 == 0 else None, 1 + i % 2) for i in range(9000)]
    d = spark.createDataFrame(rows, "event_id long, match_id long, event_index long, type_name string, shot_outcome string, team_id long")
    d = d.withColumn("home_team_id", F.lit(1)).withColumn("away_team_id", F.lit(2))
    got = {r["event_id"]: (r["score_home_at_event"], r["score_away_at_event"]) for r in timeline.running_score(d, chunk=100).collect()}
    score = {}
    for i, m, _, _, outcome, team in rows:
        h, a = score.get(m, (0, 0))
        score[m] = (h + (outcome == "Goal" and team == 1), a + (outcome == "Goal" and team == 2))
        assert got[i] == score[m]
    # the timeline's own form: the same scores, one shuffle of the events
    matches = d.select("match_id", "home_team_id", "away_team_id").distinct()
    events = d.drop("home_team_id", "away_team_id")
    scored = timeline._scored(events, matches, True, chunk=100)
    assert {r["event_id"]: (r["score_home_at_event"], r["score_away_at_event"]) for r in scored.collect()} == got
    before = {r["event_id"]: r["score_home_at_event"] for r in timeline._scored(events, matches, False, chunk=7).collect()}
    assert all(before[i] == got[i][0] - (o == "Goal" and t == 1) for i, _, _, _, o, t in rows)


def test_events_without_index_or_match_stay(spark):
    from fulltime.operators import timeline

    kind = "event_id long, match_id long, event_index long, type_name string, shot_outcome string, team_id long"
    rows = [(1, 7, None, "Shot", "Goal", 1), (2, 7, 0, "Pass", None, 1), (3, 7, 5, "Shot", "Goal", 2), (4, None, 3, "Shot", "Goal", 1), (5, None, None, "Pass", None, 2),
            (6, 8, None, "Pass", None, 1)]
    events = spark.createDataFrame(rows, kind)
    matches = spark.createDataFrame([(7, "C", 1, 2), (8, "D", 1, 2)], "match_id long, competition_name string, home_team_id long, away_team_id long")
    for chunk in (1, 100):
        tl = timeline._scored(events, matches, True, chunk=chunk)
        got = {r["event_id"]: (r["competition_name"], r["score_home_at_event"], r["score_away_at_event"]) for r in tl.collect()}
        assert got == {1: ("C", 1, 0), 2: ("C", 1, 0), 3: ("C", 1, 1), 4: (None, 0, 1), 5: (None, 0, 0), 6: ("D", 0, 0)}
        again = timeline.running_score(timeline.attach_match(events, matches), chunk=chunk)
        assert {r["event_id"]: (r["competition_name"], r["score_home_at_event"], r["score_away_at_event"]) for r in again.collect()} == got
