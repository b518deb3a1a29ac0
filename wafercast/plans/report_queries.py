"""Registered report tables: a small bake-off whose every number SQL can
check, over the ``embeddings`` matrix.

Three feature tracks are selected by ANOVA on the expanded training rows; the
exact kNN classifier runs on each with 15, 25 and 35 neighbours.  One neighbour
search per track and side serves all three: the lists are ordered, so fewer
neighbours are a prefix.  The leaderboard and the tables made of it are the
pipeline's own report operators."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anova as A
from ..operators import expand as X
from ..operators import knn as K
from ..operators import leaderboard as LB
from ..operators import metrics as M
from ..operators.moments import expanded_moments, width
from ..session import ensure_checkpoint_dir, write_shared
from ..sources import stages
from .ml_queries import R6, model_ready

#: track -> (how it is selected, features, originals only)
TRACKS = {
    "T1_Anova_25": ("Anova all", 25, False),
    "T2_Anova_39": ("Anova all", 39, False),
    "T3_Base_25": ("Anova base", 25, True),
}
NEIGHBOURS = (15, 25, 35)
MODELS = [f"KNN_{k}" for k in NEIGHBOURS]
DISPLAY = {f"KNN_{k}": f"{k} Nearest Neighbours" for k in NEIGHBOURS}
GAP = 0.05


def track_table(train: DataFrame, d: int) -> DataFrame:
    """(track, feature_id, rk): the selected features, best first."""
    scores = write_shared(A.anova_f(expanded_moments(train, group="label")), "scores")
    order = [F.col("f").desc_nulls_last(), F.col("feature_id").desc()]
    parts = []
    for track, (_, k, base) in TRACKS.items():
        best = scores.where(F.col("feature_id") < d) if base else scores
        # k rows: the top-k is the track
        rows = best.orderBy(*order).limit(k).collect()
        parts += [(track, r["feature_id"], i + 1) for i, r in enumerate(rows)]
    return train.sparkSession.createDataFrame(parts, "track string, feature_id int, rk int")


def _chosen(tracks: DataFrame, track: str, d: int) -> list[tuple[int, str, int, int]]:
    ids = sorted(r["feature_id"] for r in tracks.where(F.col("track") == track).collect())
    return X.chosen_features(ids, d)


def project_track(rows: DataFrame, tracks: DataFrame, track: str, d: int) -> DataFrame:
    """``rows`` with the track's features only; an undefined ratio is 0."""
    out = X.project(rows, _chosen(tracks, track, d))
    return out.withColumn("features", F.transform("features", lambda v: F.coalesce(v, F.lit(0.0))))


def _labels(nn: DataFrame) -> DataFrame:
    """(qid, labels): the neighbours' labels, nearest first."""
    return nn.select("qid", F.transform("nn", lambda x: x["label"]).alias("labels"))


def _votes(labels: DataFrame, rows: DataFrame, numbers: Sequence[int]) -> DataFrame:
    """(id, label, k, prediction) by majority of the first ``k`` neighbours, for
    each of ``numbers``; equal counts go to the smaller label."""
    def majority(k: int) -> str:
        some = f"slice(labels, 1, {k})"
        counted = f"transform(array_distinct({some}), c -> named_struct('n', size(filter({some}, x -> x <=> c)), 'neg', -c))"
        return f"named_struct('k', {k}, 'prediction', cast(-array_max({counted}).neg as int))"

    votes = labels.where("size(labels) > 0").select("qid", F.expr(f"array({', '.join(majority(k) for k in numbers)})").alias("votes"))
    return rows.select(F.col("id").alias("qid"), "label").join(votes, "qid").select(
        F.col("qid").alias("id"), "label", F.inline("votes"))


def _setup(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    mr = model_ready(spark, sf_dir)
    d = width(mr)
    train = mr.where(F.col("split") == "train_balanced").select("id", "label", "features")
    test = mr.where(F.col("split") == "test").select("id", "label", "features")
    return train, test, track_table(train, d), d


def leaderboard(spark: SparkSession, sf_dir: str, setup: tuple[DataFrame, DataFrame, DataFrame, int] | None = None) -> DataFrame:
    """A row a track and number of neighbours.  Each search leaves its confusion
    cells, a small table; all scores are made of these at once."""
    train, test, tracks, d = setup or _setup(spark, sf_dir)
    cells = []
    for track in TRACKS:
        tr, te = (project_track(x, tracks, track, d) for x in (train, test))
        for side, q in (("te", te), ("tr", tr)):
            found = write_shared(_labels(K.neighbours(tr, q, max(NEIGHBOURS))), "neighbours")
            cells.append(write_shared(M.confusion(_votes(found, q, NEIGHBOURS), ["k"]).coalesce(1), "cells")
                         .select(F.lit(track).alias("Track"), F.lit(side).alias("side"), "*"))
    out = cells[0]
    for c in cells[1:]:
        out = out.unionByName(c)
    scores = M.macro_scores(out, ["Track", "side", "k"])
    on_test = scores.where("side = 'te'").select(
        "Track", "k", F.col("f1_macro").alias("Test_F1_Macro"), F.col("recall_macro").alias("Test_Recall_Macro"),
        F.col("accuracy").alias("Test_Accuracy"))
    on_train = scores.where("side = 'tr'").select("Track", "k", F.col("f1_macro").alias("Train_F1_Macro"))
    # a side without rows has no scores
    every = spark.createDataFrame([(t, m, k) for t in TRACKS for k, m in zip(NEIGHBOURS, MODELS)], "Track string, Model string, k int")
    board = every.join(on_test, ["Track", "k"], "left").join(on_train, ["Track", "k"], "left").select(
        "Track", "Model", "Test_F1_Macro", "Test_Recall_Macro", "Train_F1_Macro",
        (F.col("Train_F1_Macro") - F.col("Test_F1_Macro")).alias("Overfit_Gap"), "Test_Accuracy",
        F.concat(F.lit("k="), F.col("k").cast("string")).alias("Best_Params"))
    return write_shared(board, "leaderboard")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, R6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_track_features(spark, sf_dir):
    return _setup(spark, sf_dir)[2]


def q_track_overlap(spark, sf_dir):
    """Features shared by each pair of tracks."""
    tf = q_track_features(spark, sf_dir)
    a, b = tf.alias("a"), tf.alias("b")
    return (a.join(b, (F.col("a.feature_id") == F.col("b.feature_id")) & (F.col("a.track") < F.col("b.track")))
            .groupBy(F.col("a.track").alias("track_a"), F.col("b.track").alias("track_b"))
            .agg(F.count(F.lit(1)).alias("shared")))


def q_track_project(spark, sf_dir):
    """C11: the test rows, projected to the smallest track's features."""
    _, test, tracks, d = _setup(spark, sf_dir)
    out = project_track(test, tracks, "T1_Anova_25", d)
    return out.select("id", F.posexplode("features").alias("pos", "value")).select(
        "id", F.col("pos").cast("int").alias("pos"), F.round("value", R6).alias("value"))


def _cells(rows: DataFrame) -> DataFrame:
    return rows.select("id", F.posexplode("features").alias("pos", "value")).select(
        "id", F.col("pos").cast("int").alias("pos"), F.round("value", R6).alias("value"))


def q_track_by_name(spark, sf_dir):
    """The same rows as ``track_project``, the track given as a table of names."""
    _, test, tracks, d = _setup(spark, sf_dir)
    base = [f"f{i}" for i in range(d)]
    dim = X.expansion_dim(spark, base)
    names = dim.join(tracks.where("track = 'T1_Anova_25'"), "feature_id", "left_semi").select("name")
    out = X.project_names(test, write_shared(names, "names"), base)
    return _cells(out.withColumn("features", F.transform("features", lambda v: F.coalesce(v, F.lit(0.0)))))


def q_expanded_stage(spark, sf_dir):
    """Both splits of a track written as a stage, one read back by partition."""
    train, test, tracks, d = _setup(spark, sf_dir)
    rows = train.withColumn("split", F.lit("train_balanced")).unionByName(test.withColumn("split", F.lit("test")))
    base = f"{ensure_checkpoint_dir(spark)}/stages-{uuid.uuid4().hex}"
    stages.write_stage(project_track(rows, tracks, "T1_Anova_25", d), base, "expanded")
    return _cells(stages.read_stage(spark, base, "expanded", split="test"))


def q_leaderboard_file(spark, sf_dir):
    """The leaderboard through its result file."""
    base = f"{ensure_checkpoint_dir(spark)}/stages-{uuid.uuid4().hex}"
    stages.write_stage(_rounded(leaderboard(spark, sf_dir)), base, "leaderboard")
    return stages.read_stage(spark, base, "leaderboard")


def q_gap_table_file(spark, sf_dir):
    """A report table, written with its own columns."""
    base = f"{ensure_checkpoint_dir(spark)}/stages-{uuid.uuid4().hex}"
    stages.write_stage(q_gap_table(spark, sf_dir), base, "gap_table")
    return stages.read_stage(spark, base, "gap_table")


def q_leaderboard(spark, sf_dir):
    return _rounded(LB.ranked(leaderboard(spark, sf_dir)))


def q_winner(spark, sf_dir):
    return _rounded(LB.winner(leaderboard(spark, sf_dir)))


def q_best_per_track(spark, sf_dir):
    return _rounded(LB.best_per_track(leaderboard(spark, sf_dir)))


def q_f1_pivot(spark, sf_dir):
    # a model that has not run keeps a row
    return _rounded(LB.f1_pivot(spark, leaderboard(spark, sf_dir), list(TRACKS), [*MODELS, "KNN_99"]))


def q_selection_table(spark, sf_dir):
    setup = _setup(spark, sf_dir)
    tracks = setup[2]
    counts = tracks.groupBy(F.col("track").alias("Track")).agg(F.count(F.lit(1)).alias("Feature_Count"))
    return LB.selection_table(spark, leaderboard(spark, sf_dir, setup), counts, [(t, how) for t, (how, _, _) in TRACKS.items()])


def q_gap_table(spark, sf_dir):
    return LB.gap_table(spark, leaderboard(spark, sf_dir), MODELS[:2], DISPLAY)


def q_overfit_trigger(spark, sf_dir):
    return _rounded(LB.overfit_trigger(leaderboard(spark, sf_dir), GAP))
