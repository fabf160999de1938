"""Stored models score as the fitted ones do; folds fitted side by side predict what a loop does."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from fulltime.operators import models
from fulltime.operators.model_store import ModelStore, fingerprint


def matches(spark, n=240, seed=1):
    r = random.Random(seed)
    cols = ["elo_diff", "xg_diff", "stage_ordinal"]
    rows = []
    for i in range(n):
        elo = r.gauss(0, 100)
        rows.append((i, None if i % 60 == 59 else i % 4, 2000 + i % 4 // 2, None if i % 17 == 0 else elo, r.gauss(0, 1), i % 5,
                     None if i % 31 == 0 else (elo + r.gauss(0, 60) > 40) - (elo + r.gauss(0, 60) < -40)))
    kind = "match_id long, competition_id int, season_id int, elo_diff double, xg_diff double, stage_ordinal int, result_home int"
    return spark.createDataFrame(rows, kind).repartition(3), cols


def test_a_stored_model_scores_as_the_fitted_one(spark, tmp_path):
    df, cols = matches(spark)
    steps = models.match_preparation(models.labelled_matches(df), cols)
    train = steps.transform(models.labelled_matches(df))
    fitted = models.fit_match_model(train, trees=10, depth=3)
    store = ModelStore(spark, str(tmp_path))
    whole = PipelineModel(stages=[*steps.stages, *fitted.stages])
    assert store.versions("m") == [] and store.save("m", whole, "forest", cols, cols, {"a": 1}, models.labelled_matches(df)) == 1
    # a save that failed before its card was written is no version, and its number isn't used again
    whole.write().save(f"{tmp_path}/m/000002/pipeline")
    assert store.save("m", whole, "forest", cols, cols, {}, models.labelled_matches(df), params={"trees": 10}) == 3
    again = ModelStore(spark, str(tmp_path))
    assert again.versions("m") == [1, 3] and again.load("m").card["version"] == 3 and again.load("m", 1).card["metrics"] == {"a": 1.0}
    new = df.drop("result_home").withColumn("elo_diff", F.when(F.col("match_id") % 5 > 0, F.col("elo_diff")))
    got = models.outcome_probabilities(again.load("m").score(new))
    want = models.outcome_probabilities(fitted.transform(steps.transform(new)))
    pick = ["match_id", "p_home_win", "p_draw", "p_away_win", "prediction"]
    assert {tuple(r) for r in got.select(pick).collect()} == {tuple(r) for r in want.select(pick).collect()} and got.count() == 240
    with pytest.raises(ValueError, match="xg_diff"):
        again.load("m").score(new.drop("xg_diff"))
    with pytest.raises(LookupError):
        again.load("other")
    assert again.cards("m").count() == 2


def test_training_rows_stand_in_as_many_partitions_as_they_need(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("x"), F.lit("not read").alias("more")).repartition(40)
    for rows, parts in ((1000, 1), (250, 4)):
        got = models.gathered(df, ["id", "x"], rows)
        assert got.columns == ["id", "x"] and got.rdd.getNumPartitions() <= parts and got.count() == got.distinct().count() == 1000
    assert models.gathered(df.limit(0), ["id"], 10).count() == 0


def test_training_rows_are_spread_from_fewer_partitions(spark):
    # a narrow stored table comes in one partition: each fit's job had one task then, whatever its rows
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("x")).coalesce(1)
    got = models.gathered(df, ["id", "x"], 250)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert got.rdd.getNumPartitions() == 4 and len(sizes) == 4 and max(sizes) <= 260 and got.distinct().count() == 1000
    assert [models.partitions_for(n, 10) for n in (0, 1, 10, 11, 120, 121, 960, 961, 9600)] == [1, 1, 1, 2, 12, 12, 12, 13, 120]


def test_fingerprints_tell_rows_not_their_order(spark):
    df, cols = matches(spark)
    one = fingerprint(df, cols)
    assert fingerprint(df.repartition(7, "xg_diff"), cols) == one and one[0] == 240
    assert fingerprint(df.where("match_id > 0"), cols) != one
    assert fingerprint(df.union(df.limit(1)), cols)[1] != one[1]
    assert fingerprint(df.limit(0), cols) == (0, "0" * 32)


def test_folds_side_by_side_predict_what_a_loop_does(spark):
    df, cols = matches(spark)
    prepared = models.prepare_matches(df, cols)
    groups = [(c, s) for c in range(4) for s in (2000, 2001)] + [(9, 9)]
    with pytest.warns(UserWarning, match="9, 9"):
        side = models.leave_one_group_out(prepared, groups, trees=8, depth=3, fits=4)
    with pytest.warns(UserWarning):
        loop = models.leave_one_group_out(prepared, groups, trees=8, depth=3, fits=1)
    assert sorted(map(tuple, side.collect())) == sorted(map(tuple, loop.collect()))
    scored = {r["match_id"] for r in side.collect()}
    assert scored == {r["match_id"] for r in prepared.where("competition_id is not null").collect()}


def test_no_test_edition_is_an_error(spark):
    df, _ = matches(spark)
    with pytest.raises(ValueError, match="43"):
        models.split_by_group(df, [(43, 106)])
    train, test = models.split_by_group(df, [(1, 2000)])
    assert train.count() + test.count() == 240
