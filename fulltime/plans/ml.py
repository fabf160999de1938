"""Model keys (ML-01..14), model reports (AGG-42, AGG-43), model measures and the shot view (SNK-10).

Fitted-model outputs have no SQL oracle (rows-only check); encoding, imputation, the split,
provider-xG metrics and fixture features are compared with DuckDB.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from fulltime.operators import models
from fulltime.operators.features import fixture_features, match_features_v2
from fulltime.operators.measures import measures_predictor, measures_xg
from fulltime.operators.model_store import ModelStore
from fulltime.operators.sets import editions
from fulltime.plans.core import tp_frame
from fulltime.plans.fixture_sql import with_fixtures
from fulltime.plans.registry import query
from fulltime.plans.shots_ratings import SHOT_MAP, shot_map_frame, team_ratings
from fulltime.plans.squads_features import MF_V1, mf_v1_frame
from fulltime.session import materialize, scratch_dir
from fulltime.sources import testdata as td
from fulltime.sources.layer import Layer

TEST_EDITIONS = [(43, 106), (55, 106)]
EMF = ["fx_event", "fx_match", "fx_frame"]


class _Shots:
    """Shot-model stages of one session/folder, each built on first use."""

    def __init__(self, spark, sf):
        self.spark, self.sf = spark, sf

        self.root = scratch_dir(spark, "shot-model")

    @cached_property
    def shots(self):
        return materialize(shot_map_frame(self.spark, self.sf))

    @cached_property
    def preparation(self):
        return models.shot_preparation(self.shots)

    @cached_property
    def prepared(self):
        return materialize(models.labelled_shots(self.preparation.transform(self.shots)))

    @cached_property
    def split(self):
        return models.split_by_group(self.prepared, TEST_EDITIONS)

    @cached_property
    def fitted(self):
        train, test = self.split
        out = {}
        for kind, feats in (("lr", models.BASE_FEATURES), ("gbt", models.FULL_FEATURES)):
            m = models.fit_shot_model(train, kind, feats)
            out[kind] = (m, feats, models.score_metrics(models.score(m, test), "our_xg"))
        return out

    @cached_property
    def best(self):
        kind = max(self.fitted, key=lambda k: self.fitted[k][2]["auc"])
        return kind, self.fitted[kind][0]

    @cached_property
    def version(self):
        """The better model, stored with the steps before it: raw shots go in."""
        kind, m = self.best
        _, feats, metrics = self.fitted[kind]
        return ModelStore(self.spark, self.root).save(
            "xg", PipelineModel(stages=[*self.preparation.stages, *m.stages]), kind, feats, models.SHOT_INPUTS, metrics, self.split[0],
            params={"test_editions": TEST_EDITIONS})

    @cached_property
    def predictions(self):
        """All shots scored by the model read back from its folder, kept as a stored table."""
        version = self.version
        model = ModelStore(self.spark, self.root).load("xg")
        p = models.goal_probability(model.score(self.shots)).select(
            "event_id", "match_id", "competition_id", "season_id", "player_name", "team_name", "shot_type",
            "shot_body_part", "distance_to_goal", "angle_to_goal", "shot_xg", "our_xg", "is_goal",
            F.lit(model.card["kind"]).alias("model"), F.lit(version).alias("model_version"))
        layer = Layer(self.spark, self.root)
        layer.overwrite(p, "xg_predictions")
        return layer.read("xg_predictions")


_SHOTS: dict = {}


def shots_run(spark, sf) -> _Shots:
    key = (*td.session_key(spark), sf, td.contents(spark, sf))
    if key not in _SHOTS:
        _SHOTS[key] = _Shots(spark, sf)
    return _SHOTS[key]


_ENC = """
SELECT event_id,
  CAST(dense_rank() OVER (ORDER BY coalesce(shot_body_part, 'Unknown')) - 1 AS DOUBLE) AS shot_body_part_enc,
  CAST(dense_rank() OVER (ORDER BY coalesce(shot_technique, 'Unknown')) - 1 AS DOUBLE) AS shot_technique_enc,
  CAST(dense_rank() OVER (ORDER BY coalesce(shot_type, 'Unknown')) - 1 AS DOUBLE) AS shot_type_enc,
  CAST(dense_rank() OVER (ORDER BY coalesce(pitch_zone, 'Unknown')) - 1 AS DOUBLE) AS pitch_zone_enc
FROM smap"""


@query("encode_cat", with_fixtures(EMF, _ENC, SHOT_MAP))
def q_encode_cat(spark, sf):
    return shots_run(spark, sf).prepared.select("event_id", "shot_body_part_enc", "shot_technique_enc", "shot_type_enc", "pitch_zone_enc")


_NUM = list(models.SHOT_NUMERIC + models.SHOT_FRAME_NUMERIC)


@query("impute_features", with_fixtures(EMF, "SELECT event_id, " + ", ".join(
    f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM smap)) AS {c}" for c in _NUM)
    + "".join(f", CAST(coalesce({c}, false) AS INTEGER) AS {c}_int" for c in models.SHOT_FLAGS) + " FROM smap", SHOT_MAP))
def q_impute_features(spark, sf):
    return shots_run(spark, sf).prepared.select("event_id", *_NUM, *[f"{c}_int" for c in models.SHOT_FLAGS])


@query("split_by_group", with_fixtures(EMF, """
SELECT CASE WHEN (competition_id = 43 AND season_id = 106) OR (competition_id = 55 AND season_id = 106)
            THEN 'test' ELSE 'train' END AS split, count(*) AS shots, count(*) FILTER (WHERE is_goal) AS goals
FROM smap GROUP BY 1""", SHOT_MAP))
def q_split_by_group(spark, sf):
    train, test = shots_run(spark, sf).split

    def summary(d, name):
        return d.agg(F.count(F.lit(1)).alias("shots"), F.count_if(F.col("is_goal")).alias("goals")) \
            .select(F.lit(name).alias("split"), "shots", "goals")

    return summary(train, "train").unionByName(summary(test, "test"))


@query("xg_provider_metrics", with_fixtures(EMF, """
SELECT (sum(ar) FILTER (WHERE label = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0) AS auc, avg(pow(shot_xg - label, 2)) AS brier,
       -avg(label * ln(least(greatest(shot_xg, 1e-15), 1 - 1e-15))
            + (1 - label) * ln(1 - least(greatest(shot_xg, 1e-15), 1 - 1e-15))) AS log_loss, count(*) AS n
FROM (SELECT *, count(*) FILTER (WHERE label = 1) OVER () AS n1, count(*) FILTER (WHERE label = 0) OVER () AS n0,
             rank() OVER (ORDER BY shot_xg) + (count(*) OVER (PARTITION BY shot_xg) - 1) / 2.0 AS ar
      FROM (SELECT shot_xg, CAST(is_goal AS DOUBLE) AS label FROM smap))
GROUP BY n1, n0""", SHOT_MAP))
def q_xg_provider_metrics(spark, sf):
    """ROC-AUC, Brier and log loss of the provider's xG against the observed goals."""
    d = shots_run(spark, sf).prepared
    m = models.score_metrics(d, "shot_xg")
    return spark.createDataFrame([(m["auc"], m["brier"], m["log_loss"], m["n"])],
                                 "auc double, brier double, log_loss double, n long")


@query("shot_models")
def q_shot_models(spark, sf):
    """Held-out metrics of the logistic baseline and the boosted trees (and which one is kept)."""
    s = shots_run(spark, sf)
    best = s.best[0]
    rows = [(k, v[2]["auc"], v[2]["brier"], v[2]["log_loss"], v[2]["n"], k == best) for k, v in s.fitted.items()]
    return spark.createDataFrame(rows, "model string, auc double, brier double, log_loss double, n long, kept boolean")


@query("feature_importances")
def q_feature_importances(spark, sf):
    s = shots_run(spark, sf)
    rows = [(k, f, float(v)) for k, (m, feats, _) in s.fitted.items() for f, v in models.feature_importances(m, feats)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


@query("stored_model")
def q_stored_model(spark, sf):
    """The card of the stored shot model, and how far it, read back, is from the fitted one over all shots."""
    s = shots_run(spark, sf)
    kept = models.score(s.best[1], s.prepared).select("event_id", F.col("our_xg").alias("fitted_xg"))
    apart = s.predictions.join(kept, "event_id", "full").agg(
        F.count("*").alias("shots"), F.count_if(~F.col("our_xg").eqNullSafe(F.col("fitted_xg"))).alias("scored_apart"))
    cards = ModelStore(spark, s.root).cards("xg")
    return cards.crossJoin(F.broadcast(apart)).select(
        "name", "version", "kind", F.size("features").alias("features"), "trained_rows", "fingerprint", F.col("metrics")["auc"].alias("auc"),
        "shots", "scored_apart")


@query("xg_predictions")
def q_xg_predictions(spark, sf):
    return shots_run(spark, sf).predictions


@query("xg_agreement")
def q_xg_agreement(spark, sf):
    p = shots_run(spark, sf).predictions
    return p.agg(F.avg(F.abs(F.col("our_xg") - F.col("shot_xg"))).alias("mae"),
                 F.corr("our_xg", "shot_xg").alias("corr"), F.count(F.lit(1)).alias("shots"))


@query("report_xg_type")
def q_report_xg_type(spark, sf):
    p = shots_run(spark, sf).predictions
    return p.groupBy("shot_type").agg(
        F.count(F.lit(1)).alias("shots"), F.avg("our_xg").alias("our_xg_mean"), F.avg("shot_xg").alias("provider_xg_mean"),
        F.avg(F.col("is_goal").cast("double")).alias("goal_rate"))


@query("measures_xg")
def q_measures_xg(spark, sf):
    return measures_xg(shots_run(spark, sf).predictions)


@query("v_shots")
def q_v_shots(spark, sf):
    p = shots_run(spark, sf).predictions
    return p.select(F.concat_ws("/", F.col("competition_id").cast("string"), F.col("season_id").cast("string"))
                    .alias("competition"), "player_name", "team_name", "shot_type", "shot_body_part",
                    "distance_to_goal", "angle_to_goal", "our_xg", F.col("shot_xg").alias("provider_xg"),
                    F.col("is_goal").cast("int").alias("is_goal"))


# ---------------------------------------------------------------- match outcome model


class _Matches:
    def __init__(self, spark, sf, v2: bool = False):
        self.spark, self.sf, self.v2 = spark, sf, v2
        self.root = scratch_dir(spark, "outcome-model")

    @cached_property
    def cols(self):
        return models.MATCH_FEATURES_V2 if self.v2 else models.MATCH_FEATURES

    @cached_property
    def features(self):
        """Feature rows of the played matches, stored."""
        f = mf_v1_frame(self.spark, self.sf)
        if self.v2:
            from fulltime.operators import squads

            sq = squads.squad_features(td.fx_rating(self.spark, self.sf), td.fx_form(self.spark, self.sf),
                                       td.fx_market(self.spark, self.sf))
            f = match_features_v2(f, sq)
        return materialize(f.where(F.col("result_home").isNotNull()))

    @cached_property
    def preparation(self):
        return models.match_preparation(self.features, self.cols)

    @cached_property
    def prepared(self):
        return models.labelled_matches(self.preparation.transform(self.features))

    @cached_property
    def oof(self):
        p = models.leave_one_group_out(self.prepared, editions(self.features))
        layer = Layer(self.spark, self.root)
        layer.overwrite(p, "match_predictions")
        return layer.read("match_predictions")

    @cached_property
    def fitted(self):
        return models.fit_match_model(self.prepared)

    @cached_property
    def version(self):
        """The model of all matches, stored with the steps before it: feature rows go in."""
        p = self.oof
        seen = p.agg(F.avg("correct").alias("accuracy"), F.count("*").alias("matches")).first()
        return ModelStore(self.spark, self.root).save(
            "outcome", PipelineModel(stages=[*self.preparation.stages, *self.fitted.stages]), "forest", self.cols, self.cols,
            {"accuracy": seen["accuracy"], "matches": seen["matches"]} if seen["matches"] else {},
            models.labelled_matches(self.features))


_MATCHES: dict = {}


def matches_run(spark, sf, v2=False) -> _Matches:
    key = (*td.session_key(spark), sf, td.contents(spark, sf), v2)
    if key not in _MATCHES:
        _MATCHES[key] = _Matches(spark, sf, v2)
    return _MATCHES[key]


@query("match_predictions")
def q_match_predictions(spark, sf):
    """Out-of-fold class probabilities, predicted and actual outcome per match (leave one edition out)."""
    return matches_run(spark, sf).oof


@query("match_predictions_v2")
def q_match_predictions_v2(spark, sf):
    """The same with the squad-extended (v2) feature vector."""
    return matches_run(spark, sf, v2=True).oof


@query("report_accuracy")
def q_report_accuracy(spark, sf):
    """Accuracy per held-out edition against the always-home-win baseline."""
    p = matches_run(spark, sf).oof
    return p.groupBy("competition_id", "season_id").agg(
        F.count(F.lit(1)).alias("matches"), F.avg(F.col("correct").cast("double")).alias("accuracy"),
        F.avg((F.col("result_home") == 1).cast("double")).alias("home_win_baseline"))


@query("report_upsets")
def q_report_upsets(spark, sf):
    """Matches the home side lost although the model gave it more than 0.65."""
    p = matches_run(spark, sf).oof
    return p.filter((F.col("p_home_win") > 0.65) & (F.col("result_home") == -1))


@query("match_importances")
def q_match_importances(spark, sf):
    """Importance of every feature in the outcome model fitted on all matches."""
    run = matches_run(spark, sf)
    return spark.createDataFrame([(f, float(v)) for f, v in models.feature_importances(run.fitted, run.cols)], "feature string, importance double")


@query("measures_predictor")
def q_measures_predictor(spark, sf):
    return measures_predictor(matches_run(spark, sf).oof)


def _fixture_sql() -> str:
    from fulltime.operators.features import FIXTURE_DEFAULTS

    style = {"xg_per_game": "overall_xg_per_game", "xga_per_game": "overall_xga_per_game", "ppda": "overall_ppda",
             "possession_pct": "overall_possession_pct", "prog_passes": "overall_prog_passes", "dominance_score": "overall_dominance_score"}
    side = ", ".join(f"coalesce(s{x}.{c}, CAST({FIXTURE_DEFAULTS[n]} AS DOUBLE)) AS {p}_{n}"
                     for x, p in (("h", "home"), ("a", "away")) for n, c in style.items())
    return f"""
SELECT fixture_id, home_team_name, away_team_name, elo_home - elo_away AS elo_diff,
       1.0 / (1.0 + pow(10.0, -(elo_home - elo_away) / 400)) AS elo_home_win_prob, elo_home, elo_away,
       home_xg_per_game - away_xg_per_game AS xg_diff, home_ppda - away_ppda AS ppda_diff,
       home_possession_pct - away_possession_pct AS possession_diff, home_dominance_score - away_dominance_score AS dominance_diff,
       {', '.join(f'{p}_{n}' for p in ('home', 'away') for n in style)},
       {', '.join(f'{p}_{n} AS {p}_form_{f}, 0.0 AS {p}_form_wins' if f == 'ppda' else f'{p}_{n} AS {p}_form_{f}'
                  for p in ('home', 'away') for n, f in (('xg_per_game', 'xg'), ('xga_per_game', 'xga'), ('ppda', 'ppda')))},
       home_xg_per_game - away_xg_per_game AS form_xg_diff, 0.0 AS form_wins_diff, stage_ordinal
FROM (
  SELECT m.match_id AS fixture_id, m.away_team_name AS home_team_name, m.home_team_name AS away_team_name,
         coalesce(rh.elo_rating, 1050.0) AS elo_home, coalesce(ra.elo_rating, 1050.0) AS elo_away, {side}, mf.stage_ordinal
  FROM fx_match m JOIN mf ON mf.match_id = m.match_id
  LEFT JOIN rating rh ON rh.team_name = m.away_team_name LEFT JOIN rating ra ON ra.team_name = m.home_team_name
  LEFT JOIN so sh ON sh.team_name = m.away_team_name LEFT JOIN so sa ON sa.team_name = m.home_team_name)"""


@query("fixture_features", with_fixtures(["fx_event", "fx_match", "fx_result"], _fixture_sql(), MF_V1, recursive=True))
def q_fixture_features(spark, sf):
    """Feature rows for fixtures not played yet: the return match of every match, from ratings and overall style."""
    from fulltime.functions import football as fb
    from fulltime.operators import gold

    m = td.fx_match(spark, sf)
    fixtures = m.select(F.col("match_id").alias("fixture_id"), F.col("away_team_name").alias("home_team_name"),
                        F.col("home_team_name").alias("away_team_name"), fb.stage_ordinal("stage_name").alias("stage_ordinal"))
    return fixture_features(fixtures, team_ratings(spark, sf), gold.team_style_overall(tp_frame(spark, sf)))


@query("fixture_predictions")
def q_fixture_predictions(spark, sf):
    """Outcome probabilities of the fixtures by the stored outcome model, read back from its folder."""
    run = matches_run(spark, sf)
    version = run.version
    scored = ModelStore(spark, run.root).load("outcome").score(q_fixture_features(spark, sf))
    return models.outcome_probabilities(scored).select(
        "fixture_id", "home_team_name", "away_team_name", "p_home_win", "p_draw", "p_away_win",
        (F.col("prediction") - 1).cast("int").alias("predicted"), F.lit(version).alias("model_version"))
