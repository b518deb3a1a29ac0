"""Operator 11: embedding whitening with a bit-sliced scatter matrix.

* Integers: every entry c becomes ``floor(scale * c) + shift`` as a long.  Rows
  whose vector is null or empty, or holds null or non-finite entries, are left
  out; so are rows that differ in length from most (of equally frequent
  lengths the larger counts).  Products beyond 2**60 are held there.
* Fit list: each distinct integer vector once, written to the shared folder.
* Scatter: a batch of the fit list is packed into bit planes: word w of plane p
  of dimension i holds bit p of ``x_i - lo_i`` for 64 rows.  The number of rows
  with bit p of i and bit q of j is the popcount of the AND of two planes, and
  the cross-product of i and j the sum of these counts times 2**(p + q).  Sums
  leave a task in limbs of 16 powers, as longs that cannot overflow, at most
  d * (d + 1) / 2 rows a limb, and Spark adds them up.
* Centring: the driver has d * d sums, whatever the number of rows.  With exact
  integers, ``n * sum(y_i y_j) - T_i * T_j`` over n**2 is the covariance,
  rounded once; ``eigh`` sees nothing else.
* Projection is narrow.  Deviations are exact: in longs where they fit, else in
  Python's integers (null if the result is no long).  The covariance of the
  whitened fit list is measured by a pass over it, merged as means and centred
  products.

Components whose eigenvalue is below ``RANK`` of the largest are rounding and
are left out: a constant dimension or a single distinct vector has nothing to
whiten.  An empty table, or one without valid rows, gives no rows; repeated
rows each get theirs; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shared_table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
LIMB = 16
HELD = 1 << 60
RANK = 1e-11


# ---- integers

def integer_vectors(rows: DataFrame, vector: str = "embedding", id_col: str = "vec_id", scale: int = SCALE,
                    shift: int = SHIFT) -> DataFrame:
    """(id, x) of the rows whose entries are all finite numbers."""
    def whole(c: Column) -> Column:
        at = F.floor(c.cast("double") * scale)
        return F.greatest(F.lit(-HELD), F.least(F.lit(HELD), at)) + F.lit(shift).cast("long")

    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double")) < float("inf")))
    good = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)))
    return good.select(F.col(id_col).alias("id"), F.transform(vector, whole).alias("x"))


def usual_length(vectors: DataFrame) -> int:
    top = (vectors.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.desc("d")).first())
    return top["d"] if top else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


# ---- the scatter matrix

def lows_and_highs(fit: DataFrame, d: int) -> tuple[list[int], list[int], int]:
    """Per dimension the least and the largest value, and the number of rows."""
    def run(batches):
        lo = hi = None
        n = 0
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            if len(x):
                n += len(x)
                lo = x.min(0) if lo is None else np.minimum(lo, x.min(0))
                hi = x.max(0) if hi is None else np.maximum(hi, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(lo), pa.array(hi), pa.array([n] * d)],
                                             names=["dim", "lo", "hi", "n"])

    got = (fit.mapInArrow(run, "dim long, lo long, hi long, n long").groupBy("dim")
           .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).orderBy("dim").collect())
    return [r["lo"] for r in got], [r["hi"] for r in got], got[0]["n"] if got else 0


def bit_planes(y: np.ndarray, planes: list[int]) -> np.ndarray:
    """Bit p of dimension i over the rows, 64 rows a word: dimension by dimension, low bits first."""
    words = -(-len(y) // 64)
    out = np.zeros((sum(planes), words * 8), np.uint8)
    at = 0
    for i, n in enumerate(planes):
        bits = (y[:, i][None, :] >> np.arange(n, dtype=np.uint64)[:, None]) & np.uint64(1)
        packed = np.packbits(bits.astype(np.uint8), axis=1)
        out[at:at + n, :packed.shape[1]] = packed
        at += n
    return out.view(np.uint64)


def _scatter_rows(lo: np.ndarray, planes: list[int]):
    d = len(planes)
    starts = np.concatenate([[0], np.cumsum(planes)[:-1]])
    power = np.concatenate([np.arange(n) for n in planes])
    limbs = (2 * max(planes) - 2) // LIMB + 1

    def run(batches):
        cross, total = np.zeros((limbs, d, d), np.int64), np.zeros((limbs, d), np.int64)
        seen = False
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            if not len(x):
                continue
            seen = True
            bits = bit_planes((x - lo).astype(np.uint64), planes)
            alone = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
            for limb in range(limbs):
                own = power // LIMB == limb
                total[limb] += np.add.reduceat(np.where(own, alone << (power % LIMB), 0), starts)
            for i in range(d):
                first = starts[i]
                for p in range(planes[i]):
                    hits = np.bitwise_count(bits[first:] & bits[first + p]).sum(axis=1, dtype=np.int64)
                    weight = power[first:] + p
                    for limb in range(limbs):
                        own = weight // LIMB == limb
                        cross[limb, i, i:] += np.add.reduceat(np.where(own, hits << (weight % LIMB), 0), starts[i:] - first)
        if seen:
            i, j = np.triu_indices(d)
            for limb in range(limbs):
                # the sums of single dimensions go under row -1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([i, np.full(d, -1)])), pa.array(np.concatenate([j, np.arange(d)])),
                     pa.array(np.full(len(i) + d, limb)), pa.array(np.concatenate([cross[limb][i, j], total[limb]]))],
                    names=["i", "j", "limb", "v"])
    return run


def scatter(fit: DataFrame, lo: list[int], hi: list[int]) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Exact sums of ``x - lo`` per dimension, and of products per pair i <= j."""
    planes = [max(1, (b - a).bit_length()) for a, b in zip(lo, hi)]
    rows = (fit.mapInArrow(_scatter_rows(np.array(lo, np.int64), planes), "i long, j long, limb long, v long")
            .groupBy("i", "j", "limb").agg(F.sum("v").alias("v")))
    sums: dict[tuple[int, int], int] = {}
    for r in rows.collect():        # at most (d * (d + 1) / 2 + d) rows a limb, 8 limbs at the most
        at = (r["i"], r["j"])
        sums[at] = sums.get(at, 0) + (r["v"] << (LIMB * r["limb"]))
    return [sums[-1, j] for j in range(len(lo))], {k: v for k, v in sums.items() if k[0] >= 0}


# ---- the fitted map

@dataclass
class Whitener:
    n: int
    lo: list[int]
    hi: list[int]
    total: list[int]            # sums of x - lo over the fit list
    weights: np.ndarray         # d x components, unit eigenvectors over sqrt(eigenvalue)
    eigenvalues: list[float]
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self._centred(x) @ self.weights

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, in longs if they are sure to hold it."""
        y, total = x - np.array(self.lo, np.int64), np.array(self.total, dtype=object)
        reach = max(int(np.abs(y).max(initial=0)), max(b - a for a, b in zip(self.lo, self.hi)))
        if self.n * reach < 1 << 61:
            return self.n * y - total.astype(np.int64)
        return self.n * y.astype(object) - total

    def _centred(self, x: np.ndarray) -> np.ndarray:
        return (self._scaled(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        v = self._scaled(x)
        if v.dtype != object and len(v) and int(np.abs(v).max()) ** 2 * v.shape[1] >= 1 << 62:
            v = v.astype(object)
        return [int(s) if s < 1 << 63 else None for s in (v * v).sum(axis=1)]


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitener | None:
    """The whitening of the distinct integer vectors ``fit`` (column x, length d)."""
    lo, hi, n = lows_and_highs(fit, d)
    if not n:
        return None
    total, products = scatter(fit, lo, hi)
    cov = np.zeros((d, d))
    for (i, j), s in products.items():
        cov[i, j] = cov[j, i] = (n * s - total[i] * total[j]) / (n * n)
    trace = sum(n * products[i, i] - total[i] ** 2 for i in range(d)) / (n * n)
    values, vectors = np.linalg.eigh(cov)
    order = [k for k in np.argsort(-values, kind="stable") if values[k] > RANK * max(values[-1], 0.0)][:components]
    return Whitener(n, lo, hi, total, vectors[:, order] / np.sqrt(values[order]), values[order].tolist(), trace)


def identity_error(fit: DataFrame, white: Whitener) -> float:
    """The largest entry of the whitened fit list's covariance less the identity."""
    d, k = white.weights.shape
    if not k:
        return 0.0

    def run(batches):
        n, mean, prod = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = white.whitened(_matrix(batch.column("x"), d))
            if len(z):
                gap = z.mean(0) - mean
                c = z - z.mean(0)
                prod += c.T @ c + np.outer(gap, gap) * (n * len(z) / (n + len(z)))
                mean += gap * len(z) / (n + len(z))
                n += len(z)
        if n:
            a, b = (g.ravel() for g in np.indices((k, k)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array([n] * k * k), pa.array(mean[a]),
                                              pa.array(mean[b]), pa.array(prod.ravel())], names=["a", "b", "n", "ma", "mb", "c"])

    parts = shared_table(fit.mapInArrow(run, "a long, b long, n long, ma double, mb double, c double"), "whitened")
    whole = parts.groupBy("a", "b").agg(F.sum("n").alias("all"), (F.sum(F.col("n") * F.col("ma")) / F.sum("n")).alias("wa"),
                                        (F.sum(F.col("n") * F.col("mb")) / F.sum("n")).alias("wb"))
    cov = (parts.join(whole, ["a", "b"]).groupBy("a", "b", "all")
           .agg(F.sum(F.col("c") + F.col("n") * (F.col("ma") - F.col("wa")) * (F.col("mb") - F.col("wb"))).alias("s"))
           .select(F.abs(F.col("s") / F.col("all") - (F.col("a") == F.col("b")).cast("double")).alias("off")))
    return float(cov.agg(F.max("off")).first()[0])


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per row of ``vectors`` (id, x) and component: id, component, n,
    deviation, whitened, explained, identity_error."""
    kind = vectors.schema["id"].dataType
    schema = f"id {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    d = usual_length(vectors)
    used = vectors.where(F.size("x") == d)
    fit = shared_table(used.select("x").distinct(), "fit")
    white = fit_whitening(fit, d, components) if d else None
    if white is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(fit, white)
    k = len(white.eigenvalues)
    share = [e / white.trace for e in white.eigenvalues]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = _matrix(part.column("x"), d)
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, white.n)),
                     pa.array([v for v in white.deviations(x) for _ in range(k)], pa.int64()),
                     pa.array(white.whitened(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return used.mapInArrow(run, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(read_table(spark, sf_dir, "embeddings"))
    return whiten(vectors).withColumnRenamed("id", "vec_id")
