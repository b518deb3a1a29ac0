"""Micro-batch feature extraction for newly arriving raw wafers.

Cleaning and all feature groups are per-row and stateless, so each micro-batch
runs the batch plan (:func:`wafercast.plans.features.wafer_features`) through
``foreachBatch``.  Every batch overwrites its own ``batch_id=N`` folder, so a
replayed batch after a failure rewrites the same output instead of
duplicating it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_wafers
from ..plans.features import wafer_features
from ..sources.wafers import RAW_SCHEMA


def raw_wafer_stream(spark: SparkSession, folder: str, max_files: int = 16) -> DataFrame:
    return spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(folder)


def start_feature_stream(spark: SparkSession, raw: DataFrame, sink: str, checkpoint: str, available_now: bool = False):
    def run(batch: DataFrame, batch_id: int) -> None:
        feats = wafer_features(clean_wafers(batch))
        feats.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    w = raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
