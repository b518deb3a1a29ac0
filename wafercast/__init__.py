"""wafercast: wafer-map analytics as Spark DataFrame jobs.

Stages (each a function DataFrame -> DataFrame):

* sources    -- raw wafer tables (derived from the driver's ``part`` table),
                feature matrices, parquet/csv readers and sinks
* operators  -- cleaning, stencils, zone density, Radon projection, connected
                regions, statistics, sampling, scaling, balancing, expansion,
                ANOVA, kNN, metrics, leaderboard tables, MLlib model jobs
* plans      -- the composed pipelines (66 features per wafer, model-ready
                data, selection tracks, bake-off)
* streaming  -- micro-batch scoring of newly arriving wafers
"""

__all__ = ["session"]
