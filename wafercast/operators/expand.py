"""Pairwise feature expansion, kept lazy.

For features A = x_i and B = x_j with i < j: ``A_PLUS_B``, ``A_MINUS_B``,
``A_DIV_B`` = A / (B + 1e-6) (NULL instead of an infinity when the
denominator is 0) and the interaction ``A B`` = A * B; the originals once.
With d base features that is d + 4 * d(d-1)/2 columns (8,646 for d = 66).

Nothing is ever materialised wide: the expansion is a long table
``(id, label, feature_id, value)`` generated per row from a pair index
computed on the fly, so it feeds aggregates (moments, ANOVA) directly, and
after selection only the chosen features are computed (``project``)."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import RATIO_EPS

OPS = ["PLUS", "MINUS", "DIV", "MUL"]


def expansion_dim(spark: SparkSession, names: list[str]) -> DataFrame:
    """(feature_id, name, op, i, j): originals first (op 'ID', j = -1), then
    for each pair i < j the four ops.  Small: d + 4 d(d-1)/2 rows."""
    d = len(names)
    rows = [(i, names[i], "ID", i, -1) for i in range(d)]
    fid = d
    for i in range(d):
        for j in range(i + 1, d):
            for op in OPS:
                nm = f"{names[i]} {names[j]}" if op == "MUL" else f"{names[i]}_{op}_{names[j]}"
                rows.append((fid, nm, op, i, j))
                fid += 1
    return spark.createDataFrame(rows, "feature_id int, name string, op string, i int, j int")


def _op_value(op: str, a: F.Column, b: F.Column) -> F.Column:
    if op == "PLUS":
        return a + b
    if op == "MINUS":
        return a - b
    if op == "DIV":
        return F.try_divide(a, b + F.lit(RATIO_EPS))
    return a * b


def expand_long(df: DataFrame, d: int, ops: list[str] | None = None, include_original: bool = True,
                features: str = "features") -> DataFrame:
    """(id, label, ..., feature_id, value) for every expanded feature.

    Pairs are generated per row with ``sequence`` (no join with a pair
    table): pair p = (i, j) enumerates i < j in row-major order, and
    feature_id = d + 4 * p + op_index, matching :func:`expansion_dim`."""
    ops = ops or OPS
    keys = [c for c in df.columns if c != features]
    pairs = F.expr(f"flatten(transform(sequence(0, {d - 2}), i -> transform(sequence(i + 1, {d - 1}), j -> "
                   f"named_struct('i', i, 'j', j, 'p', CAST(i * (2 * {d} - i - 1) / 2 AS INT) + j - i - 1))))")
    ex = df.select(*keys, features, F.inline(pairs))
    a = F.element_at(features, F.col("i") + 1)
    b = F.element_at(features, F.col("j") + 1)
    vals = F.array(*[F.struct(F.lit(OPS.index(op)).alias("o"), _op_value(op, a, b).alias("v")) for op in ops])
    out = ex.select(*keys, "p", F.inline(vals)).select(
        *keys, (F.lit(d) + F.col("p") * 4 + F.col("o")).cast("int").alias("feature_id"), F.col("v").alias("value"))
    if include_original:
        orig = df.select(*keys, F.posexplode(features).alias("feature_id", "value")).withColumn(
            "feature_id", F.col("feature_id").cast("int"))
        out = orig.unionByName(out)
    return out


def project(df: DataFrame, chosen: list[tuple[int, str, int, int]], features: str = "features") -> DataFrame:
    """Compute only the chosen expanded features, in the given
    order, as a new ``features`` array.  ``chosen`` = [(feature_id, op, i, j)]."""
    cols = []
    for _, op, i, j in chosen:
        a = F.element_at(features, i + 1)
        cols.append(a if op == "ID" else _op_value(op, a, F.element_at(features, j + 1)))
    return df.withColumn(features, F.array(*cols))


def chosen_features(ids: list[int], d: int) -> list[tuple[int, str, int, int]]:
    """[(feature_id, op, i, j)] of expanded features, for :func:`project`."""
    first = [0]     # number of pairs before those that start with i
    for i in range(d - 1):
        first.append(first[-1] + d - 1 - i)
    out = []
    for f in ids:
        if f < d:
            out.append((f, "ID", f, -1))
            continue
        p, o = divmod(f - d, len(OPS))
        i = bisect_right(first, p) - 1
        out.append((f, OPS[o], i, p - first[i] + i + 1))
    return out


def project_names(df: DataFrame, names: DataFrame, base: list[str], features: str = "features") -> DataFrame:
    """The features that the table ``names`` (name) lists, in the order of
    the expansion: a semi-join of the feature dimension.  What the join leaves
    is a few hundred rows at most (a track), and reaches the rows as the value
    of a scalar subquery; names that are not in the dimension are ignored."""
    dim = expansion_dim(df.sparkSession, base).join(names.select("name"), "name", "left_semi")
    kept = dim.agg(F.array_sort(F.collect_list(F.struct("feature_id", "op", "i", "j"))).alias("kept"))
    value = (f"CASE c.op WHEN 'ID' THEN t.f[c.i] WHEN 'PLUS' THEN t.f[c.i] + t.f[c.j] WHEN 'MINUS' THEN t.f[c.i] - t.f[c.j] "
             f"WHEN 'DIV' THEN try_divide(t.f[c.i], t.f[c.j] + {RATIO_EPS}D) ELSE t.f[c.i] * t.f[c.j] END")
    bound = f"transform(array(named_struct('f', {features}, 'k', _kept)), t -> transform(t.k, c -> {value}))[0]"
    return df.withColumn("_kept", kept.scalar()).withColumn(features, F.expr(bound)).drop("_kept")
