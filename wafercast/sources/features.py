"""Feature-matrix sources for stages 3-5: the driver's ``embeddings`` table and
wide feature tables, both as ``(id, label, features array<double>)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import FEATURE_NAMES

#: columns that may hold the class, the preferred one first
CLASS_COLUMNS = ("label", "target")


def embedding_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("id"), F.col("label").cast("int").alias("label"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"))


def features_to_matrix(wide: DataFrame, names: Sequence[str] = FEATURE_NAMES, id_col: str = "wafer_id",
                       class_columns: Sequence[str] = CLASS_COLUMNS) -> DataFrame:
    """C7 + C8: pack the named columns of a wide table into one array beside
    its id and class; the class is the first of ``class_columns`` it has."""
    has = set(wide.columns)
    missing = [n for n in (id_col, *names) if n not in has]
    present = [c for c in class_columns if c in has]
    if missing or not present:
        raise KeyError(f"feature table lacks {missing or ' and '.join(class_columns)}")
    packed = F.array(*[F.col(n).cast("double") for n in names])
    return wide.select(F.col(id_col).alias("id"), F.col(present[0]).cast("int").alias("label"), packed.alias("features"))
