"""Shot (xG) and match-outcome models as MLlib pipelines: training and scoring run on executors;
only metrics and feature importances (a handful of numbers) reach the driver."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulltime.operators.quantiles import exact_quantiles
from fulltime.operators.squads import fill_median
from fulltime.session import materialize, stored

# The shot models' features.
SHOT_CATEGORICAL = ("shot_body_part", "shot_technique", "shot_type", "pitch_zone")
SHOT_FLAGS = ("shot_first_time", "shot_one_on_one", "under_pressure", "has_360_data")
SHOT_NUMERIC = ("distance_to_goal", "angle_to_goal", "score_diff_at_event", "period", "minute")
SHOT_FRAME_NUMERIC = ("defenders_in_cone", "distance_nearest_defender", "gk_distance_to_goalline")
LOG_LOSS_EPS = 1e-15


def encoders(df: DataFrame, cols: Sequence[str]) -> PipelineModel:
    """Categorical codes: null -> 'Unknown', labels numbered alphabetically from 0 (``<col>_enc``), a label not
    seen here after them."""
    known = ", ".join(f"coalesce(`{c}`, 'Unknown') AS `{c}`" for c in cols)
    fill = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{c}`' for c in cols)}), {known} FROM __THIS__")
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_enc", stringOrderType="alphabetAsc", handleInvalid="keep") for c in cols]
    return Pipeline(stages=[fill, *idx]).fit(df)


def encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return encoders(df, cols).transform(df)


def shot_preparation(shot_map: DataFrame) -> PipelineModel:
    """Fitted steps from raw shots to the model frame: encoded categories, flags as 0/1, gaps of numeric columns
    filled with the median. Give a stored table: the medians read it several times."""
    numeric = list(SHOT_NUMERIC + SHOT_FRAME_NUMERIC)
    found = exact_quantiles(shot_map, {c: [0.5] for c in numeric})
    fill = {c: found[c, 0.5] for c in numeric if found[c, 0.5] is not None}
    kinds = dict(shot_map.dtypes)
    filled = ", ".join(f"coalesce(`{c}`, CAST('{fill[c]!r}' AS {kinds[c]})) AS `{c}`" if c in fill else f"`{c}`" for c in numeric)
    flags = ", ".join(f"CAST(coalesce(`{c}`, false) AS INT) AS `{c}_int`" for c in SHOT_FLAGS)
    steps = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(f'`{c}`' for c in numeric)}), {filled}, {flags} FROM __THIS__")
    return PipelineModel(stages=[*encoders(shot_map, SHOT_CATEGORICAL).stages, steps])


def prepare_shots(shot_map: DataFrame) -> DataFrame:
    """Model frame of ``shot_preparation`` with the label."""
    return labelled_shots(shot_preparation(shot_map).transform(shot_map))


def labelled_shots(prepared: DataFrame) -> DataFrame:
    return prepared.withColumn("label", F.col("is_goal").cast("double"))


#: What a stored shot model reads.
SHOT_INPUTS = [*SHOT_CATEGORICAL, *SHOT_FLAGS, *SHOT_NUMERIC, *SHOT_FRAME_NUMERIC]


BASE_FEATURES = ["distance_to_goal", "angle_to_goal", "shot_body_part_enc", "shot_technique_enc", "shot_type_enc", "shot_first_time_int",
                 "shot_one_on_one_int", "under_pressure_int", "period", "score_diff_at_event", "pitch_zone_enc"]
FULL_FEATURES = BASE_FEATURES + list(SHOT_FRAME_NUMERIC)


def split_by_group(df: DataFrame, test_editions: Sequence[tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """Hold out whole editions (competition, season) as the test set; an error if the data has none of them."""
    cond = F.lit(False)
    for comp, season in test_editions:
        cond = cond | ((F.col("competition_id") == comp) & (F.col("season_id") == season))
    cond = F.coalesce(cond, F.lit(False))
    train, test = df.filter(~cond), df.filter(cond)
    if test.isEmpty():
        raise ValueError(f"the data has no row of the editions {list(test_editions)} to test on")
    return train, test


#: Rows of a partition of training data. A forest's partitions each send the statistics of all nodes of a level,
#: whatever their rows; boosted trees run a thousand short jobs and more, each of which pays for its tasks.
FOREST_ROWS = 1 << 14
BOOST_ROWS = 1 << 15
#: So many partitions are filled first; with more training rows a partition takes up to ``FULLER`` times its rows.
#: Not the session's number of cores: a model's partitions would follow from the cluster then.
SPREAD = 12
FULLER = 8


def partitions_for(n: int, rows: int) -> int:
    """Partitions of ``n`` training rows: one for every ``rows`` up to ``SPREAD``, beyond that one for ``FULLER * rows``."""
    return max(1, min(-(-n // rows), max(SPREAD, -(-n // (FULLER * rows)))))


def gathered(train: DataFrame, cols: Sequence[str], rows: int) -> DataFrame:
    """``cols`` of the training rows, stored, in as many partitions as the rows need (``partitions_for``), whatever the
    number they come in, with about the same number of rows in each."""
    kept = stored(train.select(*cols), "training")
    parts = partitions_for(kept.count(), rows)
    return kept.coalesce(1) if parts == 1 else materialize(kept.repartition(parts))


def with_class_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced class weights n / (2 n_class): the two class counts come from one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")).first()
    n, pos = int(row["n"]), int(row["pos"])
    w_pos = n / (2.0 * pos) if pos else 1.0
    w_neg = n / (2.0 * (n - pos)) if n - pos else 1.0
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(w_pos)).otherwise(F.lit(w_neg)))


def fit_shot_model(train: DataFrame, kind: str = "gbt", features: Sequence[str] = FULL_FEATURES,
                   max_iter: int = 200, max_depth: int = 4) -> PipelineModel:
    """Scaled, class-weighted logistic regression (``lr``) or boosted trees (``gbt``, 200 x depth 4)."""
    assemble = VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="keep")
    if kind == "lr":
        stages = [assemble, StandardScaler(inputCol="raw_features", outputCol="features"),
                  LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=1000,
                                     regParam=0.0)]
    else:
        stages = [assemble, GBTClassifier(featuresCol="raw_features", labelCol="label", weightCol="weight",
                                          maxIter=max_iter, maxDepth=max_depth, stepSize=0.05, subsamplingRate=0.8,
                                          seed=42)]
    data = with_class_weight(gathered(train, [*features, "label"], BOOST_ROWS)).cache()
    try:
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def goal_probability(scored: DataFrame, out: str = "our_xg") -> DataFrame:
    """Goal probability (second element of the probability vector) in place of the model's own columns."""
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(
        "raw_features", "features", "rawPrediction", "probability", "prediction")


def score(model: PipelineModel, df: DataFrame, out: str = "our_xg") -> DataFrame:
    return goal_probability(model.transform(df), out)


def score_metrics(df: DataFrame, p: str, y: str = "label") -> dict[str, float]:
    """Exact ROC-AUC (distributed sort, ties averaged), Brier score and log loss."""
    auc = BinaryClassificationEvaluator(rawPredictionCol=p, labelCol=y, metricName="areaUnderROC",
                                        numBins=0).evaluate(df.select(F.col(p).cast("double").alias(p),
                                                                      F.col(y).cast("double").alias(y)))
    pc = F.least(F.greatest(F.col(p), F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    row = df.agg(F.avg((F.col(p) - F.col(y)) ** 2).alias("brier"),
                 (-F.avg(F.col(y) * F.log(pc) + (1 - F.col(y)) * F.log(1 - pc))).alias("log_loss"),
                 F.count(F.lit(1)).alias("n")).first()
    return {"auc": float(auc), "brier": float(row["brier"]), "log_loss": float(row["log_loss"]), "n": int(row["n"])}


def feature_importances(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        imp = last.featureImportances.toArray().tolist()
    else:
        imp = [abs(x) for x in last.coefficients.toArray().tolist()]
    return list(zip(features, imp))


# ---------------------------------------------------------------- match outcome model

# The feature sets of the outcome models.
MATCH_FEATURES = [
    "elo_diff", "elo_home_win_prob", "elo_home", "elo_away",
    "xg_diff", "ppda_diff", "possession_diff", "dominance_diff",
    "home_xg_per_game", "home_xga_per_game", "home_ppda", "home_possession_pct", "home_prog_passes", "home_dominance_score",
    "away_xg_per_game", "away_xga_per_game", "away_ppda", "away_possession_pct", "away_prog_passes", "away_dominance_score",
    "home_form_xg", "home_form_xga", "home_form_ppda", "home_form_wins",
    "away_form_xg", "away_form_xga", "away_form_ppda", "away_form_wins",
    "form_xg_diff", "form_wins_diff", "stage_ordinal",
]

MATCH_FEATURES_V2 = [
    "elo_diff", "elo_home_win_prob", "elo_home", "elo_away",
    "xg_diff", "ppda_diff", "possession_diff", "dominance_diff",
    "home_xg_per_game", "home_xga_per_game", "home_ppda", "home_possession_pct", "home_dominance_score",
    "away_xg_per_game", "away_xga_per_game", "away_ppda", "away_possession_pct", "away_dominance_score",
    "home_form_xg", "home_form_xga", "home_form_wins", "away_form_xg", "away_form_xga", "away_form_wins",
    "form_xg_diff", "form_wins_diff", "stage_ordinal",
    "overall_diff", "top11_overall_diff", "att_overall_diff", "def_overall_diff", "gk_overall_diff",
    "home_squad_avg_overall", "away_squad_avg_overall", "home_att_best_overall", "away_att_best_overall",
    "home_gk_best_overall", "away_gk_best_overall",
    "age_diff", "peak_pct_diff", "veteran_pct_diff", "home_squad_avg_age", "away_squad_avg_age",
    "home_squad_peak_pct", "away_squad_peak_pct",
    "recent_form_ppg_diff", "recent_xg_diff_diff", "home_form_ppg", "away_form_ppg", "home_form_xg_diff", "away_form_xg_diff",
    "home_form_win_rate", "away_form_win_rate", "home_form_clean_sheet_pct",
    "squad_value_diff", "depth_score_diff", "home_squad_value_log", "away_squad_value_log",
    "squad_risk_diff", "home_squad_risk_score", "away_squad_risk_score",
]


def labelled_matches(features: DataFrame) -> DataFrame:
    """Label 0/1/2 for away win/draw/home win; matches without a result teach nothing and go."""
    return features.where(F.col("result_home").isNotNull()).withColumn("label", (F.col("result_home") + 1).cast("double"))


def prepare_matches(features: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Labelled matches with their vector, gaps filled with the medians of the labelled ones."""
    d = labelled_matches(features)
    return match_preparation(d, cols).transform(d)


def match_preparation(features: DataFrame, cols: Sequence[str]) -> PipelineModel:
    """Fitted steps from feature rows to the vector: gaps filled with the medians of ``features``."""
    values = features.select(*[F.col(c).cast("double").alias(c) for c in cols])
    found = exact_quantiles(values, {c: [0.5] for c in cols})
    filled = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), CAST('{found[c, 0.5]!r}' AS DOUBLE)) AS `_f_{c}`" if found[c, 0.5] is not None
                       else f"CAST(`{c}` AS DOUBLE) AS `_f_{c}`" for c in cols)
    gone = ", ".join(f"`_f_{c}`" for c in cols)
    return PipelineModel(stages=[SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"), _vector(cols),
                                 SQLTransformer(statement=f"SELECT * EXCEPT ({gone}) FROM __THIS__")])


def _vector(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"_f_{c}" for c in cols], outputCol="features", handleInvalid="keep")


def _forest(trees: int, depth: int) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=42)


def fit_match_model(train: DataFrame, trees: int = 200, depth: int = 6) -> PipelineModel:
    """Three-class random forest on the prepared matches' vectors."""
    return Pipeline(stages=[_forest(trees, depth)]).fit(gathered(train, ["label", "features"], FOREST_ROWS))


PREDICTION_SCHEMA = ("match_id long, competition_id int, season_id int, result_home int, p_home_win double, "
                     "p_draw double, p_away_win double, predicted int, correct int")


def outcome_probabilities(scored: DataFrame) -> DataFrame:
    """p_home_win, p_draw and p_away_win in place of the model's own columns."""
    p = scored.withColumn("_p", vector_to_array("probability"))
    return p.select("*", *[F.col("_p")[i].alias(c) for i, c in ((2, "p_home_win"), (1, "p_draw"), (0, "p_away_win"))]).drop(
        "_p", "features", "rawPrediction", "probability")


def predict_matches(model: Transformer, df: DataFrame) -> DataFrame:
    p = model.transform(df).withColumn("_p", vector_to_array("probability"))
    return p.select("match_id", "competition_id", "season_id", "result_home",
                    F.col("_p")[2].alias("p_home_win"), F.col("_p")[1].alias("p_draw"), F.col("_p")[0].alias("p_away_win"),
                    (F.col("prediction") - 1).cast("int").alias("predicted"),
                    ((F.col("prediction") - 1).cast("int") == F.col("result_home")).cast("int").alias("correct"))


#: Models that are fitted at the same time.
FITS = 4


def leave_one_group_out(prepared: DataFrame, groups: Sequence[tuple[int, int]],
                        min_rows: int = 5, trees: int = 200, depth: int = 6, fits: int = FITS) -> DataFrame:
    """Out-of-fold predictions: each edition is scored by a model trained on all other editions.

    The feature vectors are stored once with the number of their fold; ``fits`` threads of the driver fit the
    folds on it side by side, each in a scheduler pool of its own, so one fit's short jobs fill the gaps of the
    others' (the predictions don't hang on it). Editions of fewer than ``min_rows`` matches are skipped, and
    named in a warning; rows of no given edition (or of a null one) are trained on, not scored.
    """
    spark = prepared.sparkSession
    sizes = {tuple(r[:2]): r[2] for r in prepared.groupBy("competition_id", "season_id").count().collect()}  # editions: few
    known = [g for g in groups if sizes.get(tuple(g), 0) >= min_rows]
    if skipped := [tuple(g) for g in groups if tuple(g) not in {tuple(k) for k in known}]:
        warnings.warn(f"editions of fewer than {min_rows} matches are not scored: {skipped}", stacklevel=2)
    if not known:  # every edition below ``min_rows``: no fold to score
        return spark.createDataFrame([], PREDICTION_SCHEMA)
    fold = F.lit(None).cast("int")
    for i, (comp, season) in enumerate(known):
        fold = F.when((F.col("competition_id") == comp) & (F.col("season_id") == season), i).otherwise(fold)
    vectors = gathered(prepared.withColumn("fold", F.coalesce(fold, F.lit(-1))),
                       ["match_id", "competition_id", "season_id", "result_home", "label", "features", "fold"], FOREST_ROWS)

    def fit(i: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{i % fits}")
        return _forest(trees, depth).fit(vectors.where(F.col("fold") != i))

    with ThreadPoolExecutor(max_workers=max(1, min(fits, len(known)))) as pool:
        models = list(pool.map(inheritable_thread_target(spark)(fit), range(len(known))))
    parts = [predict_matches(m, vectors.where(F.col("fold") == i)) for i, m in enumerate(models)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
