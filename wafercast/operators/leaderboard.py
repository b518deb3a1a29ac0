"""Report tables over a
leaderboard ``(Track, Model, Test_F1_Macro, Test_Recall_Macro,
Train_F1_Macro, Overfit_Gap, Test_Accuracy, Best_Params)``.

All are small relational queries (windows, pivot with an explicit value
list, left joins from fixed dimensions) over a table of one row per
(track, model)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.constants import GAP_TABLE_MODELS, MODEL_DISPLAY, MODEL_ORDER, OVERFIT_GAP, TRACK_INFO

LEADERBOARD_SCHEMA = ("Track string, Model string, Test_F1_Macro double, Test_Recall_Macro double, "
                      "Train_F1_Macro double, Overfit_Gap double, Test_Accuracy double, Best_Params string")


def ranked(lb: DataFrame) -> DataFrame:
    """Sorted by test macro F1 descending (Track, Model break ties)."""
    return lb.orderBy(F.desc("Test_F1_Macro"), "Track", "Model")


def winner(lb: DataFrame) -> DataFrame:
    """The overall best row (a top-1 report)."""
    return ranked(lb).limit(1)


def best_per_track(lb: DataFrame) -> DataFrame:
    """H6: the best row of each track."""
    w = Window.partitionBy("Track").orderBy(F.desc("Test_F1_Macro"), "Model")
    return lb.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def f1_pivot(spark: SparkSession, lb: DataFrame, tracks: list[str], models: list[str] = MODEL_ORDER) -> DataFrame:
    """F20 + G4: Model x Track test macro F1 in the fixed model order; a
    model that did not run keeps a row of NULLs."""
    piv = lb.groupBy("Model").pivot("Track", tracks).agg(F.first("Test_F1_Macro"))
    order = spark.createDataFrame([(i, m) for i, m in enumerate(models)], "ord int, Model string")
    return order.join(piv, "Model", "left").orderBy("ord").drop("ord")


def selection_table(spark: SparkSession, lb: DataFrame, feature_counts: DataFrame,
                    info: list[tuple[str, str]] = TRACK_INFO) -> DataFrame:
    """F19 + G3 + C15: per selection track its method, the counted number of
    features and the best test macro F1 (rounded to 3; NULL when the track
    has no result)."""
    dim = spark.createDataFrame([(i, t, m) for i, (t, m) in enumerate(info)],
                                "ord int, Track string, Selection_Method string")
    best = lb.groupBy("Track").agg(F.max("Test_F1_Macro").alias("best"))
    out = dim.join(best, "Track", "left").join(feature_counts, "Track", "left")
    return out.orderBy("ord").select(
        F.regexp_replace("Track", "_", " ").alias("Track_ID"), F.col("Selection_Method"),
        F.col("Feature_Count"), F.bround("best", 3).alias("Best_Model_Macro_F1"))


def gap_table(spark: SparkSession, lb: DataFrame, models: list[str] = GAP_TABLE_MODELS,
              display: dict[str, str] = MODEL_DISPLAY) -> DataFrame:
    """D7 + C14 + C15: best row of each listed model, display names, train /
    test F1 and gap rounded to 2."""
    w = Window.partitionBy("Model").orderBy(F.desc("Test_F1_Macro"), "Track")
    best = lb.where(F.col("Model").isin(models)).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    order = spark.createDataFrame([(i, m) for i, m in enumerate(models)], "ord int, Model string")
    name = F.col("Model")
    for k, v in display.items():
        name = F.when(F.col("Model") == k, F.lit(v)).otherwise(name)
    return order.join(best, "Model").orderBy("ord").select(
        name.alias("Model"), F.bround("Train_F1_Macro", 2).alias("Train_F1_SMOTE"),
        F.bround("Test_F1_Macro", 2).alias("Test_F1_Real"), F.bround("Overfit_Gap", 2).alias("Gap"))


def overfit_trigger(lb: DataFrame, gap: float = OVERFIT_GAP) -> DataFrame:
    """Rows whose train/test gap calls for pruning or jitter."""
    return lb.where(F.col("Overfit_Gap") > gap)
