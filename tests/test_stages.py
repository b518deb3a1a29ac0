"""Stage files are read back as they were written; validation; scoring."""

import pytest
from pyspark.sql import functions as F

from wafercast.functions.constants import FEATURE_NAMES
from wafercast.operators import clean as C
from wafercast.operators import metrics as M
from wafercast.operators.scale import ScalerModel, scaler_fit
from wafercast.plans import model_queries as MD
from wafercast.plans import wafer_queries as W
from wafercast.sources import stages as S
from wafercast.sources.features import embedding_matrix, features_to_matrix
from wafercast.sources.wafers import raw_wafers, read_raw_wafers

from .conftest import SMALL


def same(a, b):
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_raw_and_clean_maps_round_trip(spark, tmp_path):
    raw_wafers(spark, SMALL).drop("h", "w").write.parquet(f"{tmp_path}/raw")
    clean = C.clean_wafers(read_raw_wafers(spark, f"{tmp_path}/raw"))
    S.write_clean_maps(clean, f"{tmp_path}/clean")
    same(S.read_clean_maps(spark, f"{tmp_path}/clean"), W.clean_maps(spark, SMALL))


def test_features_round_trip(spark, tmp_path):
    rows = [(i, *[i + j / 7 for j in range(66)], i % 3) for i in range(5)]
    wide = spark.createDataFrame(rows, S.FEATURE_SCHEMA)
    S.write_features(wide.select(*reversed(wide.columns)), str(tmp_path))
    same(S.read_features(spark, str(tmp_path)), wide)
    same(S.read_feature_csv(spark, str(tmp_path)), wide)
    m = features_to_matrix(S.read_features(spark, str(tmp_path)))
    assert m.columns == ["id", "label", "features"] and m.first()["features"][65] == pytest.approx(m.first()["id"] + 65 / 7)
    with pytest.raises(KeyError):
        features_to_matrix(wide.drop("target"))
    with pytest.raises(KeyError):
        features_to_matrix(wide.drop(FEATURE_NAMES[3]))


def test_scaler_ready_rows_tracks_and_results_round_trip(spark, tmp_path):
    rows = embedding_matrix(spark, SMALL)
    scaler = ScalerModel(scaler_fit(rows))
    S.write_scaler(spark, scaler, f"{tmp_path}/scaler")
    back = S.read_scaler(spark, f"{tmp_path}/scaler")
    assert back.mean == scaler.mean and back.std == scaler.std
    ready = rows.select("id", "label", "features", F.lit(False).alias("is_synthetic"),
                        F.when(F.col("id") % 5 == 0, "test").otherwise("train_balanced").alias("split"))
    S.write_model_ready(ready, f"{tmp_path}/ready")
    same(S.read_model_ready(spark, f"{tmp_path}/ready", ("test",)), ready.where("split = 'test'"))
    tracks = spark.createDataFrame([("a", 3, 1), ("a", 9, 2), ("b", 3, 1)], S.TRACK_SCHEMA)
    S.write_tracks(tracks, f"{tmp_path}/tracks")
    same(S.read_track(spark, f"{tmp_path}/tracks", "a"), tracks.where("track = 'a'"))
    board = spark.createDataFrame([("a", "KNN", 0.5, 0.4, 0.9, 0.4, 0.6, "k=15"), ("b", "KNN", None, None, None, None, None, "error: x, y")],
                                  S.LEADERBOARD_SCHEMA)
    S.write_results(board, f"{tmp_path}/results")
    same(S.read_results(spark, f"{tmp_path}/results"), board)


def test_a_ragged_map_never_becomes_features(spark):
    good = [[2] * 7 for _ in range(6)]
    bad = [[2] * 7, [2, 2], *[[2] * 7 for _ in range(4)]]
    df = spark.createDataFrame([(1, good, [["Loc"]], [["Training"]]), (2, bad, [["Loc"]], [["Training"]]),
                                (3, None, [["Loc"]], [["Training"]]), (4, [], [["Loc"]], [["Training"]])],
                               "wafer_id long, waferMap array<array<tinyint>>, failureType array<array<string>>, "
                               "trianTestLabel array<array<string>>")
    assert [r["wafer_id"] for r in C.clean_wafers(df).select("wafer_id").collect()] == [1]
    assert {r["wafer_id"] for r in C.ragged_wafers(df).select("wafer_id").collect()} == {2, 3, 4}


def test_stored_model_scores_new_wafers(spark):
    got = MD.q_score_wafers(spark, SMALL)
    n = W.clean_maps(spark, SMALL).count()
    assert got.count() == n
    pred = got.select(F.col("wafer_id").alias("id"), "label", "prediction")
    assert M.macro_metrics(pred).first()["f1_macro"] > 0.5


def test_features_are_made_once(spark, tmp_path):
    from pyspark.sql import functions as F
    from wafercast.functions.constants import FEATURE_NAMES
    made = spark.sparkContext.accumulator(0)

    def count(i):
        made.add(1)
        return i

    key = F.udf(count, "long").asNondeterministic()
    wide = spark.range(6).select(key("id").alias("wafer_id"), *[F.lit(0.5).alias(n) for n in FEATURE_NAMES], F.lit(1).alias("target"))
    S.write_features(wide, str(tmp_path))
    assert made.value == 6
    assert sorted(r.wafer_id for r in S.read_feature_csv(spark, str(tmp_path)).collect()) == list(range(6))
