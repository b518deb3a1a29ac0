"""One-way ANOVA F per feature from per-class moments, and the
top-k pre-filter.

``moments`` holds one (n, mean, M2) per class and feature
(:func:`wafercast.operators.moments.expanded_moments`).  The spread between
classes comes from the class means, the spread within from the M2; both are
centred, so no large sums are subtracted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import N_PREFILTER


def anova_f(moments: DataFrame) -> DataFrame:
    """(feature_id, f); NULL when undefined.  A feature with any undefined
    value is not scored."""
    grand = moments.groupBy("feature_id").agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"), F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("classes"), F.sum("n_null").alias("undefined")).where("undefined = 0")
    off = F.col("mean") - F.col("centre")
    spread = (moments.join(grand, "feature_id").groupBy("feature_id", "rows", "classes")
              .agg(F.sum(F.col("n") * off * off).alias("between"), F.sum("m2").alias("within")))
    return spread.select("feature_id", F.try_divide(
        F.try_divide("between", F.col("classes") - 1), F.try_divide("within", F.col("rows") - F.col("classes"))).alias("f"))


def top_k(scores: DataFrame, k: int = N_PREFILTER) -> DataFrame:
    """I4: the k best F (NULL last, ties to the later feature), all if there
    are no more than k; survivors keep feature order.  A top-k is the feature
    here; the limit is the operator."""
    best = scores.orderBy(F.col("f").desc_nulls_last(), F.col("feature_id").desc()).limit(k)
    return best.orderBy("feature_id")
