"""Moments of the pairwise expansion without a row per expanded value.

A task expands its rows with NumPy, a bounded number of rows at a time, merges
them into one (n, mean, M2) per group and feature as it goes, and leaves these:
Spark merges the tasks'.  So what is shuffled is tasks x groups x features small
rows, whatever the number of input rows, and the merge works on means and
centred squares (no difference of large sums)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import RATIO_EPS
from .expand import OPS

ROWS_AT_ONCE = 512
GROUPS_AT_ONCE = 64     # moments that a task holds


def width(df: DataFrame, features: str = "features") -> int:
    """The number of features; a ragged matrix is an error."""
    r = df.agg(F.min(F.size(features)).alias("lo"), F.max(F.size(features)).alias("hi")).first()
    if r["lo"] != r["hi"]:
        raise ValueError(f"rows have between {r['lo']} and {r['hi']} features")
    return r["hi"] or 0


def _expand(x: np.ndarray, ops: list[str], include_original: bool) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, values of shape rows x features) in the precision of ``x``;
    an undefined ratio is NaN."""
    d = x.shape[1]
    i, j = np.triu_indices(d, 1)
    a, b = x[:, i], x[:, j]
    ids, values = ([np.arange(d)], [x]) if include_original else ([], [])
    for op in ops:
        ids.append(d + 4 * np.arange(len(i)) + OPS.index(op))
        if op == "PLUS":
            values.append(a + b)
        elif op == "MINUS":
            values.append(a - b)
        elif op == "MUL":
            values.append(a * b)
        else:
            low = b + x.dtype.type(RATIO_EPS)
            with np.errstate(divide="ignore", invalid="ignore"):
                values.append(np.where(low == 0, x.dtype.type(np.nan), a / low))
    return np.concatenate(ids), np.concatenate(values, axis=1)


def expanded_moments(df: DataFrame, ops: list[str] | None = None, include_original: bool = True,
                     group: str | None = None, single: bool = False) -> DataFrame:
    """(grp, feature_id, n, n_null, mean, m2) of every expanded feature over
    the rows ``(features, group)``; ``grp`` is 0 without a group.  A row without
    features is left out; a null value inside is undefined, and so is what is
    made of it; rows of different lengths are an error.  With ``single`` (C13) the
    features are cast to 32-bit floats and expanded in them, as the original
    does; moments are doubles in either case."""
    ops = OPS if ops is None else ops
    rows = df.where(F.col("features").isNotNull()).select((F.col(group) if group else F.lit(0)).cast("int").alias("grp"), "features")

    def rows_of(kept):
        for g, (ids, n, null, mean, m2) in kept.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), g, np.int32)), pa.array(ids.astype(np.int32)), pa.array(n.astype(np.int64)),
                 pa.array(null.astype(np.int64)), pa.array(mean), pa.array(m2)],
                names=["grp", "feature_id", "n", "n_null", "mean", "m2"])

    def partial(batches):
        kept: dict[int, tuple[np.ndarray, ...]] = {}      # a group's moments so far: one row a feature, group and task
        for batch in batches:
            grp = batch.column("grp").to_numpy()
            lengths = set(pc.list_value_length(batch.column("features")).to_pylist())
            if len(lengths) > 1:
                raise ValueError(f"rows have between {min(lengths)} and {max(lengths)} features")
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(len(grp), -1) if len(grp) else np.zeros((0, 0))
            for g in np.unique(grp):
                own = x[grp == g]
                for at in range(0, len(own), ROWS_AT_ONCE):
                    part = own[at:at + ROWS_AT_ONCE]
                    ids, v = _expand(part.astype(np.float32) if single else part, ops, include_original)
                    v = v.astype(np.float64)
                    known = ~np.isnan(v)
                    n = known.sum(axis=0)
                    mean = np.where(known, v, 0.0).sum(axis=0) / np.maximum(n, 1)
                    m2 = (np.where(known, v - mean, 0.0) ** 2).sum(axis=0)
                    null = (~known).sum(axis=0)
                    if int(g) in kept:
                        if len(kept[int(g)][0]) != len(ids):
                            raise ValueError(f"rows have other numbers of features: {len(kept[int(g)][0])} and {len(ids)} expanded")
                        _, n0, null0, mean0, m20 = kept[int(g)]
                        both = np.maximum(n0 + n, 1)
                        gap = mean - mean0
                        m2 = m20 + m2 + np.where((n == 0) | (n0 == 0), 0.0, gap * gap * (n0 * (n / both)))
                        mean = (n0 * mean0 + n * mean) / both
                        n, null = n0 + n, null0 + null
                    kept[int(g)] = ids, n, null, mean, m2
                if len(kept) >= GROUPS_AT_ONCE:
                    yield from rows_of(kept)
                    kept = {}
        yield from rows_of(kept)

    parts = rows.mapInArrow(partial, "grp int, feature_id int, n long, n_null long, mean double, m2 double")
    return merge(parts, ["grp", "feature_id"])


def merge(parts: DataFrame, keys: list[str]) -> DataFrame:
    """One (n, mean, M2) per key from partial ones: M2 is the sum of the parts'
    M2 and of the squares between their means and the whole mean."""
    whole = parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("n_null").alias("n_null"),
        F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean"))
    own = parts.select(*keys, F.col("n").alias("pn"), F.col("mean").alias("pm"), F.col("m2").alias("p2"))
    gap = F.col("pm") - F.col("mean")
    return (own.join(whole, keys).groupBy(*keys, "n", "n_null", "mean")
            .agg(F.sum(F.col("p2") + F.col("pn") * gap * gap).alias("m2")))
