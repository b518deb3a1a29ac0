"""Registered stage 3-5 queries over the driver's ``embeddings`` table used
as the labelled feature matrix.  Each takes ``(spark, sf_dir)``.

The input is read once: the split rows are written to the shared folder, and
scaling, balancing and evaluation start from there.  Balancing takes the
median class train size as target, so both the undersampling and the SMOTE
branch have work at every scale; the pipeline default stays 500.  Moments and
ANOVA fit no classifier and see all rows of the split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anova as A
from ..operators import balance as B
from ..operators import knn as K
from ..operators import metrics as M
from ..operators import sampling as S
from ..operators.moments import expanded_moments, width
from ..operators.scale import ScalerModel, scaler_fit
from ..session import write_shared
from ..sources.features import embedding_matrix

R6 = 6
KNN_K = 15


def _r(c: str) -> F.Column:
    return F.round(F.col(c), R6).alias(c)


def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_shared(S.stratified_split(embedding_matrix(spark, sf_dir)), "split")


def scaled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the split, scaled: a narrow step on the written split."""
    sp = split_rows(spark, sf_dir)
    return ScalerModel(scaler_fit(sp.where(F.col("split") == "train"))).transform(sp)


def _train_and_target(rows: DataFrame) -> tuple[DataFrame, list[int], int]:
    train = rows.where(F.col("split") == "train")
    sizes = B.class_sizes(train)
    return train, sizes, B.median_size(sizes)


def balanced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, sizes, target = _train_and_target(scaled_rows(spark, sf_dir))
    return B.balance(train, target, sizes=sizes)


def model_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, split, is_synthetic, label, features): balanced train + test,
    written once."""
    sc = scaled_rows(spark, sf_dir)
    train, sizes, target = _train_and_target(sc)
    test = sc.where(F.col("split") == "test").select("id", "label", "features", F.lit(False).alias("is_synthetic"))
    return write_shared(B.balance(train, target, sizes=sizes).withColumn("split", F.lit("train_balanced"))
                        .unionByName(test.withColumn("split", F.lit("test"))), "model-ready")


def _long(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.posexplode("features").alias("feature_idx", "value")).select(
        *keys, F.col("feature_idx").cast("int").alias("feature_idx"), F.round("value", R6).alias("value"))


def q_class_histogram(spark, sf_dir):
    return embedding_matrix(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def q_stratified_split(spark, sf_dir):
    return split_rows(spark, sf_dir).select("id", "label", "split")


def q_kfold(spark, sf_dir):
    return S.kfold(split_rows(spark, sf_dir)).select("id", "label", "fold")


def q_scaler_fit(spark, sf_dir):
    sp = split_rows(spark, sf_dir)
    return scaler_fit(sp.where(F.col("split") == "train")).select("feature_idx", _r("mean"), _r("std"))


def q_scaler_apply(spark, sf_dir):
    return _long(scaled_rows(spark, sf_dir), ["id", "split"])


def q_undersample(spark, sf_dir):
    sp = split_rows(spark, sf_dir)
    return S.undersample(sp, _train_and_target(sp)[2]).select("id", "label")


def q_smote(spark, sf_dir):
    train, _, target = _train_and_target(scaled_rows(spark, sf_dir))
    return _long(B.smote(train, target), ["id", "label"])


def q_balanced_train(spark, sf_dir):
    return _long(balanced_rows(spark, sf_dir), ["id", "label", "is_synthetic"])


def _moments(spark, sf_dir, ops, include_original, single: bool = False) -> DataFrame:
    """Per expanded feature: count of defined values, mean, population std,
    over all scaled rows, train and test."""
    rows = scaled_rows(spark, sf_dir)
    width(rows)
    m = expanded_moments(rows, ops, include_original, single=single)
    return m.select("feature_id", "n", _r("mean"), F.round(F.sqrt(F.try_divide("m2", "n")), R6).alias("std"))


def q_pair_features(spark, sf_dir):
    return _moments(spark, sf_dir, ["PLUS", "MINUS", "DIV"], False)


def q_interaction_features(spark, sf_dir):
    return _moments(spark, sf_dir, ["MUL"], False)


def q_expand_all(spark, sf_dir):
    return _moments(spark, sf_dir, None, True)


def q_expand_single(spark, sf_dir):
    """The whole expansion in 32-bit floats."""
    return _moments(spark, sf_dir, None, True, single=True)


def _train_scores(spark, sf_dir):
    train = scaled_rows(spark, sf_dir).where(F.col("split") == "train")
    width(train)
    return A.anova_f(write_shared(expanded_moments(train, group="label"), "moments"))


def q_anova_f(spark, sf_dir):
    return _train_scores(spark, sf_dir).select("feature_id", _r("f"))


def q_anova_topk(spark, sf_dir):
    return A.top_k(_train_scores(spark, sf_dir)).select("feature_id", _r("f"))


def knn_test_predictions(spark, sf_dir, k: int = KNN_K) -> DataFrame:
    mr = model_ready(spark, sf_dir)
    train = mr.where(F.col("split") == "train_balanced")
    test = mr.where(F.col("split") == "test")
    return write_shared(K.knn_predict(train, test, k), "predictions")


def q_knn_predict(spark, sf_dir):
    return knn_test_predictions(spark, sf_dir).select("id", "label", "prediction", F.col("votes").cast("long").alias("votes"))


def q_confusion_matrix(spark, sf_dir):
    return M.dense_confusion(knn_test_predictions(spark, sf_dir))


def q_macro_metrics(spark, sf_dir):
    m = M.macro_metrics(knn_test_predictions(spark, sf_dir))
    return m.select(_r("accuracy"), _r("f1_macro"), _r("recall_macro"), _r("precision_macro"),
                    F.col("n").cast("long").alias("n"))


def q_class_report(spark, sf_dir):
    rep = M.class_report(knn_test_predictions(spark, sf_dir))
    return rep.select("row", _r("precision"), _r("recall"), _r("f1"), F.col("support").cast("long").alias("support"))


def _classes(spark, sf_dir) -> list[int]:
    return sorted(r["label"] for r in embedding_matrix(spark, sf_dir).select("label").distinct().collect())


def q_roc_points(spark, sf_dir):
    pts = M.roc_points(knn_test_predictions(spark, sf_dir), _classes(spark, sf_dir))
    return pts.select(F.col("cls").cast("int").alias("cls"), _r("fpr"), _r("tpr"))


def q_auc_ovr(spark, sf_dir):
    return M.auc(knn_test_predictions(spark, sf_dir), _classes(spark, sf_dir)).select(
        F.col("cls").cast("int").alias("cls"), _r("auc"))


def q_prune_train(spark, sf_dir):
    return S.prune_train(split_rows(spark, sf_dir)).select("id", "label")
