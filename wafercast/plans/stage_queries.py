"""Registered round trips: what a stage writes, read back the way the next
stage does, and compared with the same SQL as the rows before writing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import metrics as M
from ..operators.scale import scaler_fit
from ..session import ensure_checkpoint_dir
from ..sources import stages
from ..sources.wafers import raw_wafers, read_raw_wafers
from . import ml_queries as MQ
from .report_queries import q_track_features
from .wafer_queries import R6, clean_maps


def _base(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/stages-{uuid.uuid4().hex}"


def _through(spark: SparkSession, df: DataFrame, name: str, **only: str) -> DataFrame:
    base = _base(spark)
    stages.write_stage(df, base, name)
    return stages.read_stage(spark, base, name, **only)


def q_raw_wafer_scan(spark, sf_dir):
    """A1: a raw wafer table on disk, scanned with its schema and cleaned."""
    path = f"{_base(spark)}/raw"
    raw_wafers(spark, sf_dir).write.parquet(path)
    return C.clean_wafers(read_raw_wafers(spark, path)).withColumn("map_md5", C.map_digest()).drop("map")


def q_clean_stage(spark, sf_dir):
    """B1, A2: the cleaned maps through their stage."""
    return _through(spark, clean_maps(spark, sf_dir), "clean_maps").withColumn("map_md5", C.map_digest()).drop("map")


def _rounded_features(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, R6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_feature_stage(spark, sf_dir):
    """B2, A3: the 66 features through the stage's CSV file."""
    from .features import wafer_features
    path = f"{_base(spark)}/features"
    stages.write_features(wafer_features(clean_maps(spark, sf_dir)), path)
    return _rounded_features(stages.read_feature_csv(spark, path))


def q_scaler_stage(spark, sf_dir):
    """The scaler's parameters through their stage."""
    fit = scaler_fit(MQ.split_rows(spark, sf_dir).where(F.col("split") == "train"))
    return _through(spark, fit, "scaler").select("feature_idx", MQ._r("mean"), MQ._r("std"))


def q_model_ready_stage(spark, sf_dir):
    """Train and test rows written, the train partition alone read back."""
    rows = _through(spark, MQ.model_ready(spark, sf_dir), "model_ready", split="train_balanced")
    return MQ._long(rows, ["id", "label", "is_synthetic"])


def q_track_stage(spark, sf_dir):
    """The selection tracks, written by track and read as a whole."""
    return _through(spark, q_track_features(spark, sf_dir), "tracks")


def q_class_report_file(spark, sf_dir):
    """The class report through its text file."""
    report = M.class_report(MQ.knn_test_predictions(spark, sf_dir))
    back = _through(spark, report, "class_report")
    return back.select("row", *[MQ._r(c) for c in ("precision", "recall", "f1")], "support")
