"""Registered model-job queries (rows-only checks: model fits have no SQL twin).

The balanced training rows and the test rows are written once
(:func:`wafercast.plans.ml_queries.model_ready`) and every fit starts there, in
as few partitions as the rows need.  Widths come from the data."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import N_RF, N_RFE, RFE_STEP
from ..operators import anova as A
from ..operators import leaderboard as LB
from ..operators import linear as L
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import sampling as S
from ..operators.expand import chosen_features, project
from ..operators.moments import expanded_moments, width
from ..operators.transformers import FeatureScaler, FeatureVector
from ..session import ensure_checkpoint_dir, write_shared
from ..sources import stages
from ..sources.features import features_to_matrix
from ..sources.wafers import raw_wafers
from . import bakeoff as BO
from .ledger import Ledger
from .ml_queries import model_ready
from .scoring import WaferFeatures, score_with_pipeline
from .tuning_loop import tuning_loop
from .wafer_queries import clean_maps


def _base(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    mr = model_ready(spark, sf_dir)
    train = write_shared(BO.with_folds(mr.where(F.col("split") == "train_balanced").select("id", "label", "features")), "train")
    test = mr.where(F.col("split") == "test").select("id", "label", "features")
    return ML.compact(train), ML.compact(test)


def _fit_row(spark, sf_dir, name: str) -> DataFrame:
    train, test = _base(spark, sf_dir)
    fitted = BO.fit_model(name, train, width(train), Ledger(spark))
    row = BO.evaluate(fitted, train, test)
    return spark.createDataFrame([("4A_Base", name, *row.values())], LB.LEADERBOARD_SCHEMA)


def q_fit_logreg(spark, sf_dir):
    return _fit_row(spark, sf_dir, "LogisticReg")


def q_fit_tree(spark, sf_dir):
    return _fit_row(spark, sf_dir, "DecisionTree")


def q_fit_forest(spark, sf_dir):
    return _fit_row(spark, sf_dir, "RandomForest")


def q_fit_rbf_svm(spark, sf_dir):
    """The calibrated machine's leaderboard row."""
    return _fit_row(spark, sf_dir, "SVM")


def q_fit_gradient_boosting(spark, sf_dir):
    """100 rounds of depth 3 at 0.05."""
    return _fit_row(spark, sf_dir, "GradBoosting")


def q_fit_regularised_boosting(spark, sf_dir):
    """The four points of gamma and alpha, searched over three folds."""
    return _fit_row(spark, sf_dir, "XGBoost")


def _auc(spark, sf_dir, name: str) -> DataFrame:
    """AUC of every class from a model's probabilities on the test rows."""
    train, test = _base(spark, sf_dir)
    scored = write_shared(BO.fit_model(name, train, width(train), Ledger(spark)).predict(test), "scored")
    return M.auc(scored, L.classes_of(train)).select("cls", F.round("auc", 6).alias("auc"))


def q_logreg_auc(spark, sf_dir):
    return _auc(spark, sf_dir, "LogisticReg")


def q_svm_auc(spark, sf_dir):
    return _auc(spark, sf_dir, "SVM")


def _survivors(train: DataFrame, k: int) -> tuple[list[int], DataFrame]:
    """The ids of the ``k`` best expanded features and the rows with only them."""
    d = width(train)
    scores = write_shared(A.anova_f(expanded_moments(train, group="label")), "scores")
    ids = sorted(r["feature_id"] for r in A.top_k(scores, k).collect())     # k rows
    rows = project(train.select("id", "label", "features"), chosen_features(ids, d))
    return ids, ML.compact(write_shared(rows, "survivors"))


def q_lasso_select(spark, sf_dir):
    """L4 + D8 + I6: the ANOVA survivors that L1 logistic regression keeps
    (the first 25 in column order when fewer than 2 do)."""
    ids, rows = _survivors(_base(spark, sf_dir)[0], A.N_PREFILTER)
    keep = ML.lasso_support(rows)
    chosen = [ids[i] for i in keep] if len(keep) >= 2 else ids[:25]
    return spark.createDataFrame([(int(i),) for i in chosen], "feature_id int")


def q_rf_importance(spark, sf_dir):
    """L3 + I3 + I7: forest importances over the whole expansion, ranked; the
    top 25 are the track."""
    train = _base(spark, sf_dir)[0]
    imp = ML.rf_importance(train)
    order = sorted(range(len(imp)), key=lambda i: (-imp[i], i))
    rows = [(int(i), float(imp[i]), r + 1, r < N_RF) for r, i in enumerate(order)]
    return spark.createDataFrame(rows, "feature_id int, importance double, rank int, selected boolean")


def q_rfe_select(spark, sf_dir):
    """L2: recursive elimination over the 1,000 best ANOVA survivors, 50 a round."""
    ids, rows = _survivors(_base(spark, sf_dir)[0], A.N_PREFILTER)
    return spark.createDataFrame([(int(ids[i]),) for i in ML.rfe(rows, N_RFE, RFE_STEP)], "feature_id int")


def q_score_wafers(spark, sf_dir):
    """Scaler and decision tree fitted on the training wafers' 66
    features; with the feature stage before them they are stored as one
    pipeline, read back and applied to all raw wafers."""
    from .features import wafer_features
    feats = write_shared(wafer_features(clean_maps(spark, sf_dir)), "features")
    split = write_shared(S.stratified_split(features_to_matrix(feats)), "split")
    train = split.where(F.col("split") == "train")
    scaler = FeatureScaler().fit(train)
    vector = FeatureVector()
    rows = vector.transform(scaler.transform(train)).withColumn("label_d", F.col("label").cast("double"))
    model = ML.tree(6, 5).fit(ML.compact(rows))
    at = f"{ensure_checkpoint_dir(spark)}/scoring-{uuid.uuid4().hex}"
    stages.write_model(PipelineModel([WaferFeatures(), scaler, vector, model]), at)
    return score_with_pipeline(raw_wafers(spark, sf_dir), stages.read_model(PipelineModel, at))


def q_tuning_loop(spark, sf_dir):
    """A deep tree on the balanced rows, pruned and blurred until it
    overfits less; a row a round."""
    mr = model_ready(spark, sf_dir)
    train = mr.where(F.col("split") == "train_balanced").select("id", "label", "features", "is_synthetic")
    test = write_shared(mr.where(F.col("split") == "test").select("id", "label", "features"), "test")

    def fit(rows):
        model = ML.tree(10, 1).fit(ML.compact(write_shared(ML.with_vector(rows), "fit")))
        return lambda x: ML.predict(model, ML.with_vector(x))

    return tuning_loop(train, test, fit)[0]


def q_model_importance(spark, sf_dir):
    """Importances of the linear and the tree model on the base track,
    keyed by track and model."""
    train = _base(spark, sf_dir)[0]
    d = width(train)
    tv = ML.with_vector(train)
    names = [f"f{i}" for i in range(d)]
    parts = [ML.importance_table(spark, est.fit(tv), names).select(F.lit("4A_Base").alias("track"), F.lit(name).alias("model"), "*")
             for name, est in (("LogisticReg", ML.logistic(0.1, train.count())), ("DecisionTree", ML.tree(6, 20)))]
    return parts[0].unionByName(parts[1])
