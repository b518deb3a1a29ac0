"""F12 + K1: standard scaling fitted on train rows only.

The fit is one aggregate over the exploded train features (partial
aggregation map-side, one row per feature after the shuffle).  The fitted
parameters -- one mean and one scale per feature, a bound set by the feature
count -- are the model; applying it is a single ``transform`` over each
row's array with the parameters inlined, so scoring needs no join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scaler_fit(train: DataFrame, features: str = "features") -> DataFrame:
    """(feature_idx, mean, std): population std; a constant feature gets 1."""
    long = train.select(F.posexplode(features).alias("feature_idx", "x"))
    agg = long.groupBy("feature_idx").agg(F.avg("x").alias("mean"), F.var_pop("x").alias("var"))
    return agg.select(F.col("feature_idx").cast("int").alias("feature_idx"), "mean",
                      F.when(F.col("var") == 0, F.lit(1.0)).otherwise(F.sqrt("var")).alias("std"))


def scale_column(mean: list[float], std: list[float], features: str = "features") -> F.Column:
    means = F.array(*[F.lit(m) for m in mean])
    stds = F.array(*[F.lit(s) for s in std])
    return F.transform(features, lambda x, i: (x - F.element_at(means, i + 1)) / F.element_at(stds, i + 1))


class ScalerModel:
    """Fitted parameters held as two arrays (length = feature count)."""

    def __init__(self, params: DataFrame):
        rows = sorted(params.collect(), key=lambda r: r["feature_idx"])
        self.mean = [float(r["mean"]) for r in rows]
        self.std = [float(r["std"]) for r in rows]

    def column(self, features: str = "features") -> F.Column:
        return scale_column(self.mean, self.std, features)

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        return df.withColumn(features, self.column(features))

    def to_table(self, spark) -> DataFrame:
        """The scaler as a table (feature_idx, mean, std) for a sink."""
        return spark.createDataFrame([(i, m, s) for i, (m, s) in enumerate(zip(self.mean, self.std))],
                                     "feature_idx int, mean double, std double")
