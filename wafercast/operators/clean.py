"""Stage 1: label cleaning, filters, 2x2 median filter and nearest-neighbour
resize.  Everything stays in row form (one row per wafer, the map as a nested
array), so the stage is a chain of narrow projections and filters: no shuffle
and no Python worker.  The map expressions are higher-order functions, which
Spark evaluates outside generated code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import CLASS_CODES, EXCLUDED_CLASS, MIN_SIDE_EXCLUSIVE, TARGET_SIZE


def rename_legacy(df: DataFrame) -> DataFrame:
    """C1 + C2: fix the misspelt split column and drop the row index; both are
    no-ops when the column is absent."""
    return df.withColumnRenamed("trianTestLabel", "trainTestLabel").drop("waferIndex")


def add_dimensions(df: DataFrame, map_col: str = "waferMap") -> DataFrame:
    """Map height and width.  Stored ``h``/``w`` columns are kept (they let
    filters run before the array is even built)."""
    if "h" not in df.columns:
        df = df.withColumn("h", F.size(map_col))
    if "w" not in df.columns:
        df = df.withColumn("w", F.size(F.get(F.col(map_col), 0)))
    return df


def unnest_label(col: str) -> F.Column:
    """C4: ``[['x']] -> 'x'``, empty list -> NULL (``get`` never raises)."""
    return F.get(F.get(F.col(col), 0), 0)


def label_code() -> F.Column:
    """Fixed name -> code map; names outside it give NULL."""
    pairs = []
    for name, code in CLASS_CODES.items():
        pairs += [F.lit(name), F.lit(code)]
    return F.create_map(*pairs)[F.col("failure_type")]


def clean_labels(raw: DataFrame) -> DataFrame:
    """C1-C4 + D1: un-nest both label columns, drop unlabeled wafers."""
    df = add_dimensions(rename_legacy(raw))
    return (
        df.withColumn("failure_type", unnest_label("failureType"))
        .withColumn("train_test_label", unnest_label("trainTestLabel"))
        .drop("failureType", "trainTestLabel")
        .where(F.col("failure_type").isNotNull())
    )


def filter_wafers(df: DataFrame) -> DataFrame:
    """D2 + D3: both sides strictly larger than 5; drop the excluded class."""
    return df.where(
        (F.col("h") > MIN_SIDE_EXCLUSIVE) & (F.col("w") > MIN_SIDE_EXCLUSIVE)
        & (F.col("failure_type") != F.lit(EXCLUDED_CLASS))
    )


#: Not a 2-D rectangle: no map, no rows, or rows of different lengths.
RAGGED_MAP = "coalesce(size(array_distinct(transform({}, row -> size(row)))), 0) <> 1"


def _maps_where(df: DataFrame, test: str, map_col: str) -> DataFrame:
    # a generator, not a filter: a filter would sink through the projection that makes the map,
    # below the spreading of the rows, and make every map twice
    others = [c for c in df.columns if c != map_col]
    kept = F.expr(f"filter(array(struct({map_col})), t -> {test})")
    return df.select(*others, F.inline(kept)).select(*df.columns)


def valid_maps(df: DataFrame, map_col: str = "waferMap") -> DataFrame:
    """The rows whose map is a 2-D rectangle."""
    return _maps_where(df, f"NOT ({RAGGED_MAP.format(f't.{map_col}')})", map_col)


def ragged_wafers(raw: DataFrame, map_col: str = "waferMap") -> DataFrame:
    """The maps that :func:`clean_wafers` leaves out, for quarantine."""
    return _maps_where(raw, RAGGED_MAP.format(f"t.{map_col}"), map_col)


# ---------------------------------------------------------------------------
# 2x2 median filter
# ---------------------------------------------------------------------------

def median2x2_expr(map_col: str = "waferMap") -> F.Column:
    """The window of cell (i, j) is rows {i-1, i} x cols {j-1, j}; index -1
    reflects to 0.  The result is the third smallest of the four values (the
    upper median: rank 4 // 2), never an average.

    Written as zips of the map with its shifted copies, so no lambda reads an
    outer column (an outer read inside a lambda re-evaluates per access)."""
    m = map_col

    def shifted(a: str) -> str:   # [a0, a0, a1, ..., a(n-2)]
        return f"concat(slice({a}, 1, 1), slice({a}, 1, size({a}) - 1))"

    # third smallest of {a, b, c, d} = greatest(least(max(a,b), max(c,d)), min(a,b), min(c,d)):
    # native comparisons, no sort
    third = ("greatest(least(greatest(p[0], p[1]), greatest(q[0], q[1])), least(p[0], p[1]), "
             "least(q[0], q[1]))")
    return F.expr(
        f"zip_with({m}, {shifted(m)}, (row, urow) -> "
        f"zip_with(zip_with(row, {shifted('row')}, (x, y) -> array(x, y)), "
        f"zip_with(urow, {shifted('urow')}, (x, y) -> array(x, y)), "
        f"(p, q) -> {third}))"
    )


def apply_denoise(df: DataFrame, map_col: str = "waferMap") -> DataFrame:
    return df.withColumn(map_col, median2x2_expr(map_col))


# ---------------------------------------------------------------------------
# Nearest-neighbour resize
# ---------------------------------------------------------------------------

def resize_expr(map_col: str = "waferMap", size: int = TARGET_SIZE) -> F.Column:
    """Output index i reads source index round(i * (h - 1) / (size - 1)), in
    exact integer form ``(2 i (h - 1) + (size - 1)) div (2 (size - 1))`` (the
    half-way case cannot occur).  The map is bound to a lambda variable once;
    its columns are gathered before its rows are repeated, unless it has more rows
    than the result."""
    n1 = size - 1
    ri = f"transform(sequence(0, {n1}), i -> CAST((2 * i * (h - 1) + {n1}) div {2 * n1} AS INT))"
    ci = f"transform(sequence(0, {n1}), j -> CAST((2 * j * (w - 1) + {n1}) div {2 * n1} AS INT))"
    return F.expr(
        f"element_at(transform(array(struct({map_col} AS m, {ci} AS ci)), t -> "
        f"IF(size(t.m) > {size}, transform(transform({ri}, si -> t.m[si]), row -> transform(t.ci, sj -> row[sj])), "
        f"element_at(transform(array(transform(t.m, row -> transform(t.ci, sj -> row[sj]))), m -> "
        f"transform({ri}, si -> m[si])), 1))), 1)"
    )


def apply_resize(df: DataFrame, map_col: str = "waferMap", size: int = TARGET_SIZE) -> DataFrame:
    return df.withColumn(map_col, resize_expr(map_col, size))


def encode_labels(df: DataFrame) -> DataFrame:
    return df.withColumn("label", label_code())


def clean_wafers(raw: DataFrame) -> DataFrame:
    """Stage 1 end to end: labels -> filters and validation -> denoise at the
    original size -> encode -> resize to 64x64.  Output ``wafer_id, failure_type,
    train_test_label, label, h, w, map`` with ``map`` a 64x64 nested array."""
    df = valid_maps(filter_wafers(clean_labels(raw)))
    df = apply_denoise(df)
    df = encode_labels(df)
    df = apply_resize(df)
    return df.withColumnRenamed("waferMap", "map").select(
        "wafer_id", "failure_type", "train_test_label", "label", "h", "w", "map")


def map_digest(map_col: str = "map") -> F.Column:
    """md5 of the map's cells as one digit string, row by row."""
    return F.md5(F.expr(f"array_join(transform(flatten({map_col}), x -> CAST(x AS STRING)), '')"))


def row_strings(df: DataFrame, map_col: str) -> DataFrame:
    """Long form of a map for checking: one row per map row, the row's cells
    as a digit string (structs built inside the row, exploded once)."""
    rows = F.expr(f"transform({map_col}, (row, r) -> named_struct('r', r, "
                  f"'cells', array_join(transform(row, x -> CAST(x AS STRING)), '')))")
    return df.select("wafer_id", F.inline(rows))
