"""Evaluation tables over a predictions DataFrame
``(id, label, prediction[, share])``.

All are small aggregates (classes x classes at most) after one pass over the
predictions; macro averages run over the classes seen in truth or
prediction, undefined ratios count as 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(pred: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """F14 (sparse): (keys, label, prediction, n) for every non-empty cell."""
    return pred.groupBy(*keys, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def dense_confusion(pred: DataFrame) -> DataFrame:
    """(label, prediction, n) for every pair of classes seen in truth or
    prediction, empty cells with 0.  A square of the few classes."""
    seen = pred.select("label").union(pred.select("prediction")).distinct()
    grid = seen.select("label").crossJoin(seen.select(F.col("label").alias("prediction")))
    return grid.join(confusion(pred), ["label", "prediction"], "left").fillna(0, ["n"])


def per_class(pred: DataFrame) -> DataFrame:
    """(cls, tp, fp, fn, support, precision, recall, f1) per class seen."""
    return class_scores(confusion(pred))


def class_scores(cm: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """:func:`per_class` of confusion cells, for each value of ``keys``."""
    t = cm.groupBy(*keys, F.col("label").alias("cls")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    p = cm.groupBy(*keys, F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    df = t.join(p, [*keys, "cls"], "full").fillna(0, ["support", "tp", "predicted"])
    tp, sup, prd = F.col("tp").cast("double"), F.col("support").cast("double"), F.col("predicted").cast("double")
    prec = F.when(prd > 0, tp / prd).otherwise(0.0)
    rec = F.when(sup > 0, tp / sup).otherwise(0.0)
    f1 = F.when(prd + sup > 0, 2 * tp / (prd + sup)).otherwise(0.0)
    return df.select(*keys, F.col("cls").cast("int").alias("cls"), F.col("tp").cast("long").alias("tp"),
                     (F.col("predicted") - F.col("tp")).cast("long").alias("fp"),
                     (F.col("support") - F.col("tp")).cast("long").alias("fn"),
                     F.col("support").cast("long").alias("support"),
                     prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def macro_metrics(pred: DataFrame) -> DataFrame:
    """one row: accuracy, macro F1, macro recall, macro precision, n."""
    return macro_scores(confusion(pred))


def macro_scores(cm: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """:func:`macro_metrics` of confusion cells, a row for each value of ``keys``."""
    return class_scores(cm, keys).groupBy(*keys).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("f1_macro"),
        F.avg("recall").alias("recall_macro"), F.avg("precision").alias("precision_macro"),
        F.sum("support").alias("n"))


def class_report(pred: DataFrame) -> DataFrame:
    """per-class rows plus 'accuracy', 'macro avg', 'weighted avg'."""
    pc = per_class(pred)
    rows = pc.select(F.col("cls").cast("string").alias("row"), "precision", "recall", "f1",
                     F.col("support").alias("support"))
    acc = pc.agg(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.sum("tp") / F.sum("support")).alias("f1"),
                 F.sum("support").alias("support"))
    mac = pc.agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                 F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    wt = pc.agg(F.lit("weighted avg").alias("row"),
                (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
                (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
                (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"),
                F.sum("support").alias("support"))
    return rows.unionByName(acc).unionByName(mac).unionByName(wt)


SCORE_BUCKETS = 1024


def tie_groups(scored: DataFrame, classes: list[int]) -> DataFrame:
    """(cls, bucket, score, p, q, tps, fps, n_pos, n_neg, next_p, next_q): one
    row per class and distinct score, with its positives and negatives, the
    running counts down to it, and those of the next lower score.

    A class's scores can be as many as the rows, so nothing is ordered per
    class: scores in [0, 1] fall into ``SCORE_BUCKETS`` ranges; running counts
    over that small table give each range its start, and windows run within
    (class, range)."""
    cl = F.array(*[F.lit(int(c)) for c in classes])
    ex = scored.select("label", "share", F.explode(cl).alias("cls"))
    ex = ex.select("cls", F.coalesce(F.col("share")[F.col("cls")], F.lit(0.0)).alias("score"),
                   (F.col("label") == F.col("cls")).cast("int").alias("pos"))
    g = (ex.groupBy("cls", "score").agg(F.sum("pos").alias("p"), F.sum(1 - F.col("pos")).alias("q"))
         .withColumn("bucket", F.floor(F.col("score") * (SCORE_BUCKETS - 1)).cast("int")))
    ranges = g.groupBy("cls", "bucket").agg(F.sum("p").alias("bp"), F.sum("q").alias("bq"),
                                            F.max_by(F.struct("p", "q"), "score").alias("top"))
    down = Window.partitionBy("cls").orderBy(F.desc("bucket"))
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("cls")
    ranges = ranges.select(
        "cls", "bucket", F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("tp0"),
        F.coalesce(F.sum("bq").over(above), F.lit(0)).alias("fp0"), F.sum("bp").over(every).alias("n_pos"),
        F.sum("bq").over(every).alias("n_neg"), F.lead("top").over(down).alias("below"))
    inside = Window.partitionBy("cls", "bucket").orderBy(F.desc("score"))
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return g.join(ranges, ["cls", "bucket"]).select(
        "cls", "bucket", "score", "p", "q", (F.col("tp0") + F.sum("p").over(upto)).alias("tps"),
        (F.col("fp0") + F.sum("q").over(upto)).alias("fps"), "n_pos", "n_neg",
        F.coalesce(F.lead("p").over(inside), F.col("below.p")).alias("next_p"),
        F.coalesce(F.lead("q").over(inside), F.col("below.q")).alias("next_q"))


def roc_points(scored: DataFrame, classes: list[int]) -> DataFrame:
    """H4: one-vs-rest ROC per class from ``share`` (vote fraction).

    Rows ``(cls, fpr, tpr)``: the origin, then one point per distinct score
    (tied scores collapse into one point) but for those in the middle of a
    straight stretch.  A class without a positive or negative row has NULL
    rates."""
    g = tie_groups(scored, classes)
    first = (F.col("tps") == F.col("p")) & (F.col("fps") == F.col("q"))
    bend = (F.col("next_p") != F.col("p")) | (F.col("next_q") != F.col("q"))
    pts = g.where(first | F.col("next_p").isNull() | bend).select(
        "cls", F.try_divide("fps", "n_neg").alias("fpr"), F.try_divide("tps", "n_pos").alias("tpr"))
    origin = scored.sparkSession.createDataFrame([(int(c), 0.0, 0.0) for c in classes], "cls int, fpr double, tpr double")
    return origin.unionByName(pts)


def auc(scored: DataFrame, classes: list[int]) -> DataFrame:
    """H5: the share of (positive, negative) pairs in which the positive has
    the higher score, ties counting half; NULL without either kind."""
    g = tie_groups(scored, classes)
    wins = F.sum(F.col("q") * (F.col("tps") - F.col("p") / 2))
    return g.groupBy("cls").agg(F.try_divide(wins, F.first("n_pos") * F.first("n_neg")).alias("auc"))
