"""Transformers, stage files by name, projection by names, the tuning loop, the
ragged-map generator's plan."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from wafercast.operators import expand as X
from wafercast.operators import metrics as M
from wafercast.operators import models as ML
from wafercast.operators.clean import clean_wafers
from wafercast.operators.moments import expanded_moments
from wafercast.operators.transformers import FeatureScaler, FeatureVector, TrackFeatures
from wafercast.plans import model_queries as MD
from wafercast.plans import tuning_loop as T
from wafercast.sources import stages
from wafercast.sources.wafers import raw_wafers

from .conftest import SMALL


def rows(spark, n=60, d=4, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    return spark.createDataFrame([(i, int(x[i, 0] > 0), x[i].tolist()) for i in range(n)], "id long, label int, features array<double>")


# ---- transformers

def test_pipeline_round_trip(spark, tmp_path):
    df = rows(spark)
    steps = [FeatureScaler(inputCol="features", outputCol="scaled"), TrackFeatures(inputCol="scaled", outputCol="track", ids=[0, 3, 5, 7, 27], width=4),
             FeatureVector(inputCol="track", outputCol="fvec"), ML.tree(3, 2)]
    model = Pipeline(stages=steps).fit(df.withColumn("label_d", F.col("label").cast("double")))
    want = model.transform(df).select("id", "features", "scaled", "track", "prediction").orderBy("id").collect()
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df)
    assert again.select("id", "features", "scaled", "track", "prediction").orderBy("id").collect() == want
    s = np.array([r.scaled for r in want])
    assert np.allclose(s.mean(0), 0) and np.allclose(s.std(0), 1)
    r = want[0]
    assert r.track == pytest.approx([r.scaled[0], r.scaled[3], r.scaled[0] - r.scaled[1], r.scaled[0] * r.scaled[1], r.scaled[2] * r.scaled[3]])
    with pytest.raises(ValueError, match="outside the expansion"):
        TrackFeatures(ids=[28], width=4).transform(df)


def test_score_wafers_goes_through_a_stored_pipeline(spark):
    got = MD.q_score_wafers(spark, SMALL)
    assert got.columns == ["wafer_id", "label", "prediction"]
    assert got.count() == clean_wafers(raw_wafers(spark, SMALL)).count()


# ---- stages

def test_stage_is_replaced_as_a_whole_and_pruned(spark, tmp_path):
    base = str(tmp_path)
    df = rows(spark).withColumn("split", F.expr("if(id % 3 = 0, 'test', 'train_balanced')")).withColumn("more", F.lit(1))
    stages.write_stage(df, base, "expanded")
    stages.write_stage(df.where("id < 30"), base, "expanded")
    back = stages.read_stage(spark, base, "expanded", split="test")
    assert back.columns == ["id", "label", "features", "split"] and back.count() == 10
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert sorted(p.name for p in tmp_path.iterdir()) == ["expanded"]
    with pytest.raises(ValueError):
        stages.read_stage(spark, base, "leaderboard", split="test")
    with pytest.raises(KeyError):
        stages.write_stage(df, base, "unknown")
    with pytest.raises(Exception, match="(?i)column"):
        stages.write_stage(df, base, "leaderboard")


def test_reports_keep_their_own_columns(spark, tmp_path):
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "label int, prediction int")
    report = M.class_report(pred)
    stages.write_stage(report, str(tmp_path), "class_report")
    assert sorted(stages.read_stage(spark, str(tmp_path), "class_report").collect(), key=str) == sorted(report.collect(), key=str)
    pivot = spark.createDataFrame([("a", 1.0, None)], "Model string, T1 double, T2 double")
    stages.write_stage(pivot, str(tmp_path), "f1_pivot")
    assert stages.read_stage(spark, str(tmp_path), "f1_pivot").collect() == pivot.collect()
    imp = MD.q_model_importance(spark, SMALL)
    stages.write_stage(imp, str(tmp_path), "importance")
    back = stages.read_stage(spark, str(tmp_path), "importance")
    assert back.groupBy("track", "model").count().orderBy("model").collect() == [("4A_Base", "DecisionTree", 64), ("4A_Base", "LogisticReg", 64)]


# ---- projection by names, 32-bit expansion

def test_project_names_equals_project(spark):
    df = rows(spark, n=10)
    names = spark.createDataFrame([("c",), ("a_MINUS_b",), ("b d",), ("c_DIV_d",), ("nobody",)], "name string")
    got = X.project_names(df, names, list("abcd"))
    ids = [r.feature_id for r in X.expansion_dim(spark, list("abcd")).collect() if r.name in ("c", "a_MINUS_b", "b d", "c_DIV_d")]
    assert got.collect() == X.project(df, X.chosen_features(ids, 4)).collect() and got.columns == df.columns


def test_single_precision_moments(spark):
    df = rows(spark, n=50, d=5, seed=2)
    x = np.array([r.features for r in df.collect()]).astype(np.float32)
    got = {r.feature_id: r.mean for r in expanded_moments(df, single=True).collect()}
    plus, div = x[:, 1] + x[:, 3], x[:, 1] / (x[:, 3] + np.float32(1e-6))
    ids = {(op, i, j): f for f, _, op, i, j in X.expansion_dim(spark, list("abcde")).collect()}
    assert got[ids["PLUS", 1, 3]] == pytest.approx(plus.astype(float).mean(), rel=1e-14)
    assert got[ids["DIV", 1, 3]] == pytest.approx(div.astype(float).mean(), rel=1e-14)


# ---- tuning loop

def memoriser(df):
    """Perfect on the rows it has seen, class 0 elsewhere: the worst overfitting."""
    known = df.select(F.col("id").alias("k"), F.col("label").alias("seen"))
    return lambda x: x.join(known, F.col("id") == F.col("k"), "left").select("id", "label", F.coalesce("seen", F.lit(0)).alias("prediction"))


def test_loop_stops_when_no_tactic_helps(spark):
    train = rows(spark, 40).withColumn("is_synthetic", F.lit(True))
    test = rows(spark, 30, seed=5).withColumn("id", F.col("id") + 1000)
    record, left = T.tuning_loop(train, test, memoriser)
    got = record.orderBy("round").collect()
    assert [r.action for r in got] == ["none", "prune", "jitter"] and not any(r.taken for r in got[1:])
    assert got[-1].next == "stop: no tactic helps" and left.count() == 40
    assert got[1].n_train < 40 and got[2].n_train == 40


def test_loop_takes_what_helps_and_stops_below_the_trigger(spark):
    train = rows(spark, 40).withColumn("is_synthetic", F.lit(True))
    sizes = []

    def fit(df):
        n = df.count()
        sizes.append(n)
        # fewer rows, smaller gap: a fixed share of the train labels is right
        share = 1.0 if n == 40 else 0.5
        return lambda x: x.select("id", "label", F.when(F.col("id") % 100 < 100 * share if x is not test else F.lit(False), F.col("label"))
                                  .otherwise(F.lit(0)).alias("prediction"))

    test = rows(spark, 30, seed=5)
    record, left = T.tuning_loop(train, test, fit, trigger=2.0)
    assert record.collect()[0].next == "stop: below trigger" and sizes == [40]
    record, left = T.tuning_loop(train, test, memoriser, rounds=1)
    assert record.count() == 2


def test_tuning_query_has_a_row_a_round(spark):
    got = MD.q_tuning_loop(spark, SMALL).orderBy("round").collect()
    assert got[0].action == "none" and got[0].gap > 0.10 and len(got) >= 2
    assert got[-1].next.startswith("stop") and all(r.next == "go on" for r in got[:-1])


def test_prune_drops_a_share_of_each_class(spark):
    df = spark.createDataFrame([(i, i % 2, [1.0]) for i in range(45)], "id long, label int, features array<double>")
    assert {(r.label, r["count"]) for r in T.prune(df, 0.1).groupBy("label").count().collect()} == {(0, 21), (1, 20)}


# ---- the plan of the map filter

def test_maps_are_made_once(spark):
    plan = clean_wafers(raw_wafers(spark, SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("7919") == 1      # a number of the map's formula
