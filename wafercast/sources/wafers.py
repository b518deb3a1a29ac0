"""Raw wafer tables.

``raw_wafers_from_part`` derives one variable-size wafer map per ``part`` row
with integer arithmetic only, so the same maps can be rebuilt in plain SQL.
``read_raw_wafers`` is the scan for real raw tables stored as parquet (the
pickle of the original data set is re-aimed as a parquet source with an
explicit schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import CLASS_NAMES, EXCLUDED_CLASS

RAW_SCHEMA = T.StructType([
    T.StructField("wafer_id", T.LongType(), False),
    T.StructField("waferMap", T.ArrayType(T.ArrayType(T.ByteType()))),
    T.StructField("failureType", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("trianTestLabel", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("waferIndex", T.DoubleType()),
])


#: which derived wafers are ragged (the same text in both engines)
RAGGED = "wafer_id % 37 = 5"


def _div(dialect: str) -> str:
    return "div" if dialect == "spark" else "//"


def header_sql(dialect: str = "spark") -> dict[str, str]:
    """Header columns of the derived wafer, as SQL over ``part``."""
    return {
        "wafer_id": "p_partkey",
        "h": "4 + p_size % 29",
        "w": "4 + (p_partkey * 7) % 31",
        "k": "p_partkey % 10",
    }


def cell_sql(dialect: str = "spark", r: str = "r", c: str = "c", h: str = "h", w: str = "w",
             k: str = "k", wid: str = "wafer_id", d_expr: str | None = None, s_expr: str | None = None) -> str:
    """Cell value 0/1/2 of the derived wafer at (r, c) as one SQL expression.

    D <= S is the inside of the disc; inside, a cell is a defect when the class
    pattern or the sparse noise rule holds."""
    div = _div(dialect)
    d = f"(({2}*{r}-{h}+1)*({2}*{r}-{h}+1)*{w}*{w} + ({2}*{c}-{w}+1)*({2}*{c}-{w}+1)*{h}*{h})"
    s = f"({h}*{h}*{w}*{w})"
    d = d_expr or d
    s = s_expr or s
    noise = f"(({r}*31 + {c}*17 + {wid}*13) % 97 = 0)"
    pattern = (
        f"CASE {k} "
        f"WHEN 0 THEN 9*{d} < {s} "
        f"WHEN 1 THEN 9*{d} > {s} AND 25*{d} < 9*{s} "
        f"WHEN 2 THEN 100*{d} > 60*{s} AND 3*{c} > 2*{w} "
        f"WHEN 3 THEN 100*{d} > 72*{s} "
        f"WHEN 4 THEN {r} BETWEEN {h} {div} 4 AND {h} {div} 2 AND {c} BETWEEN {w} {div} 4 AND {w} {div} 2 "
        f"WHEN 5 THEN ({r}*7919 + {c}*104729 + {wid}*31) % 5 = 0 "
        f"WHEN 6 THEN abs({r}*{w} - {c}*{h}) < {h} "
        f"WHEN 8 THEN ({r} + {c} + {wid}) % 11 <> 0 "
        f"ELSE false END"
    )
    return f"CASE WHEN {d} > {s} THEN 0 WHEN {noise} OR ({pattern}) THEN 2 ELSE 1 END"


def failure_names_sql() -> str:
    names = CLASS_NAMES + [EXCLUDED_CLASS]
    return "array(" + ", ".join(f"'{n}'" for n in names) + ")"


def raw_wafers_from_part(part: DataFrame) -> DataFrame:
    """One raw wafer per part row: ``wafer_id, waferMap, failureType,
    trianTestLabel, waferIndex`` plus the flat ``h, w`` columns stored beside
    the map so size filters never touch the array.

    Classes k = p_partkey % 10: 0-7 the eight classes, 8 Near-full, 9 unlabeled
    (empty list).  Narrow: one projection, no shuffle."""
    hdr = header_sql("spark")
    # the disc term D is computed once per cell, S once per wafer; a wafer's class chooses its
    # pattern once, so that a cell meets one pattern
    d = "((2*r-h+1)*(2*r-h+1)*w*w + (2*c-w+1)*(2*c-w+1)*h*h)"

    # every 37th map is ragged: its second row lacks the last cell
    def cells(k: int) -> str:
        return (f"transform(sequence(0, h - 1), r -> transform(transform(sequence(0, w - 1 - IF({RAGGED} AND r = 1, 1, 0)), "
                f"c -> {d}), (d, c) -> CAST({cell_sql('spark', k=str(k), d_expr='d', s_expr='s')} AS TINYINT)))")

    by_class = " ".join(f"WHEN {k} THEN {cells(k)}" for k in range(9))
    base = part.select(
        F.expr(hdr["wafer_id"]).alias("wafer_id"),
        F.expr(hdr["h"]).cast("int").alias("h"),
        F.expr(hdr["w"]).cast("int").alias("w"),
        F.expr(hdr["k"]).cast("int").alias("k"),
    ).withColumn("s", F.expr("h*h*w*w"))
    return base.select(
        "wafer_id",
        "h",
        "w",
        F.expr(f"CASE k {by_class} ELSE {cells(9)} END").alias("waferMap"),
        F.expr(
            f"CASE WHEN k = 9 THEN CAST(array() AS array<array<string>>) "
            f"ELSE array(array(element_at({failure_names_sql()}, k + 1))) END"
        ).alias("failureType"),
        F.expr(
            "CASE WHEN wafer_id % 7 = 3 THEN CAST(array() AS array<array<string>>) "
            "WHEN wafer_id % 5 = 0 THEN array(array('Test')) ELSE array(array('Training')) END"
        ).alias("trianTestLabel"),
        F.col("wafer_id").cast("double").alias("waferIndex"),
    )


def read_raw_wafers(spark: SparkSession, path: str) -> DataFrame:
    """A1: scan a raw wafer table stored as parquet with an explicit schema.
    A missing path raises (Spark's AnalysisException), as the reference's
    loader does."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two ``part`` columns the wafer fixture needs, hash-partitioned by
    key.  ``part`` is a small table (often one file, one split), while each of
    its rows expands into a whole wafer map and all per-wafer work; spreading
    the rows over ``spark.sql.shuffle.partitions`` tasks first makes that work
    parallel, and the partitioning on the wafer key carries through."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size").repartition(n, "p_partkey")


def raw_wafers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_wafers_from_part(read_part(spark, sf_dir))
