"""Registered wafer-stage queries (stage 1 and 2): each takes
``(spark, sf_dir)`` and returns a DataFrame over the whole ``part`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import clean as C
from ..operators.density import zone_density
from ..operators.stats import wafer_stats
from ..sources.wafers import raw_wafers, raw_wafers_from_part, read_part

R6 = 6


def clean_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_wafers(raw_wafers(spark, sf_dir))


def q_clean_wafers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_maps(spark, sf_dir).withColumn("map_md5", C.map_digest()).drop("map")


def q_bad_wafers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.ragged_wafers(raw_wafers(spark, sf_dir)).select("wafer_id", "h", "w")


def q_median_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.valid_maps(C.filter_wafers(C.clean_labels(raw_wafers(spark, sf_dir))))
    return C.row_strings(C.apply_denoise(df), "waferMap")


def q_resize_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.row_strings(clean_maps(spark, sf_dir), "map")


def q_zone_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_density(clean_maps(spark, sf_dir), decimals=R6)


def q_wafer_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wafer_stats(clean_maps(spark, sf_dir), decimals=R6)


# --- regions (F2-F10) --------------------------------------------------------

def _labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.regions import label_regions
    return label_regions(clean_maps(spark, sf_dir))


def q_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 4-connected defect region: area and raster-first cell."""
    from ..operators.regions import region_rows
    return region_rows(_labeled(spark, sf_dir))


def q_region_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + F4: region count and the largest region (ties -> raster-first)."""
    from pyspark.sql import functions as F
    df = _labeled(spark, sf_dir).withColumn("best", F.expr("array_max(regions)"))
    return df.select(
        "wafer_id",
        F.size("regions").alias("num_regions"),
        F.coalesce(F.col("best.area"), F.lit(0)).alias("largest_area"),
        F.expr("IF(best IS NULL, -1, runs[best.label].r)").alias("largest_r"),
        F.expr("IF(best IS NULL, -1, runs[best.label].c0)").alias("largest_c"),
    )


def q_region_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from ..operators.regions import largest_region
    df = largest_region(_labeled(spark, sf_dir))
    return df.select("wafer_id", F.round("perimeter", R6).alias("geom_perimeter"))


def q_region_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from ..operators.regions import axes_cols
    df = _labeled(spark, sf_dir).withColumn("best", F.expr("array_max(regions)"))
    return df.select("wafer_id", *[F.round(c, R6).alias(k) for k, c in axes_cols().items()])


def q_region_solidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    from ..operators.regions import with_solidity
    df = with_solidity(_labeled(spark, sf_dir).withColumn("best", F.expr("array_max(regions)")))
    return df.select("wafer_id", F.col("hull_area").cast("bigint").alias("hull_area"),
                     F.round("geom_solidity", R6).alias("geom_solidity"))


def q_wafer_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.regions import geometry
    return geometry(clean_maps(spark, sf_dir), decimals=R6)


# --- Radon (E4, E5) ------------------------------------------------------------

def q_radon_sinogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sinogram, one row per wafer, angle and bin that is not zero."""
    from pyspark.sql import functions as F
    from ..operators.radon import sinogram
    # the part rows are dealt by wafer and sorted before each becomes a map
    raw = raw_wafers_from_part(read_part(spark, sf_dir).sortWithinPartitions("p_partkey"))
    sino = sinogram(C.clean_wafers(raw), dealt=True)
    return sino.select("wafer_id", "theta_idx", "bin", F.round("s", R6).alias("s"))


def q_radon_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.radon import profile_features
    return profile_features(clean_maps(spark, sf_dir), decimals=R6)


# --- all 66 features (E6, E7, C9, C10, G1, F10) --------------------------------

def q_wafer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.features import wafer_features
    return wafer_features(clean_maps(spark, sf_dir), decimals=R6)
