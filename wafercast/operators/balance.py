"""Hybrid class balancing of the scaled train rows.

* classes above ``target`` are undersampled by hash rank (H2);
* classes below ``target`` get ``target - n`` synthetic rows (SMOTE, k = 3):
  synthetic row j of class L picks a base row and one of its 3 nearest
  same-class neighbours, and a gap in [0, 1), all from md5 digits of
  ``(seed, tag, L, j)``; the new row is ``base + gap * (neighbour - base)``;
* if any class to oversample has fewer than k + 1 rows, the whole step falls
  back to the imbalanced rows, as the reference does.

Neighbour search only runs inside classes that are *below* ``target``.  A
class's rows are dealt into blocks of about :data:`knn.BLOCK_ROWS`; each row
meets its class's blocks, keeps its k nearest of each and merges them
(:func:`knn.neighbours`), so no array grows with the class and no pair rows
are emitted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import SMOTE_K, TARGET_PER_CLASS
from ..functions.hashing import uniform
from . import knn as K


def class_neighbours(rows: DataFrame, k: int = SMOTE_K, block_rows: int = K.BLOCK_ROWS) -> DataFrame:
    """For each row: ``nn`` = its k nearest other rows of the same class
    (by squared distance, then id)."""
    nn = K.neighbours(rows, rows, k, block_rows, exclude_self=True, same_label=True)
    return rows.join(nn.withColumnRenamed("qid", "id"), "id")


def smote(train: DataFrame, target: int = TARGET_PER_CLASS, k: int = SMOTE_K) -> DataFrame:
    """K2: synthetic rows ``(id, label, features, is_synthetic)`` for every
    class with fewer than ``target`` train rows.  ``train`` carries
    ``n_train`` and ``trk`` from :func:`stratified_split`."""
    small = train.where(F.col("n_train") < target)
    nb = class_neighbours(small.select("id", "label", "trk", "features"), k)
    plan = (small.select("label", "n_train").distinct()
            .select("label", "n_train", F.explode(F.sequence(F.lit(0), F.lit(target) - F.col("n_train") - 1)).alias("j")))
    plan = (plan.withColumn("base_trk", (F.floor(uniform("label", "j", tag="base") * F.col("n_train")) + 1).cast("int"))
            .withColumn("pick", F.floor(uniform("label", "j", tag="nn") * F.lit(k)).cast("int"))
            .withColumn("gap", uniform("label", "j", tag="gap")))
    base = nb.select("label", F.col("trk").alias("base_trk"), F.col("features").alias("bf"), "nn")
    syn = plan.join(base, ["label", "base_trk"]).withColumn("nn_id", F.expr("nn[pick].id"))
    other = small.select("label", F.col("id").alias("nn_id"), F.col("features").alias("nf"))
    syn = syn.join(other, ["label", "nn_id"])
    feats = F.expr("zip_with(bf, nf, (b, q) -> b + gap * (q - b))")
    return syn.select((-(F.col("label").cast("long") * 1_000_000_000 + F.col("j") + 1)).alias("id"), "label",
                      feats.alias("features"), F.lit(True).alias("is_synthetic"))


def class_sizes(train: DataFrame) -> list[int]:
    """Train rows of each class, ascending (one number a class)."""
    return sorted(r["n_train"] for r in train.select("label", "n_train").distinct().collect())


def median_size(sizes: list[int]) -> int:
    """The (lower) median class size: the target with which both branches of
    the hybrid step have work, whatever the data."""
    return sizes[(len(sizes) - 1) // 2] if sizes else 0


def can_oversample(sizes: list[int], target: int = TARGET_PER_CLASS, k: int = SMOTE_K) -> bool:
    """K3 guard: every class to oversample needs at least k + 1 rows."""
    return all(n >= min(target, k + 1) for n in sizes)


def balance(train: DataFrame, target: int = TARGET_PER_CLASS, k: int = SMOTE_K,
            sizes: list[int] | None = None) -> DataFrame:
    """K3 + J1: undersampled/kept real rows union synthetic rows; falls back
    to the imbalanced rows when SMOTE cannot run."""
    real = train.select("id", "label", "features", F.lit(False).alias("is_synthetic"))
    if not can_oversample(class_sizes(train) if sizes is None else sizes, target, k):
        return real
    kept = (train.where((F.col("n_train") <= target) | (F.col("trk") <= target))
            .select("id", "label", "features", F.lit(False).alias("is_synthetic")))
    return kept.unionByName(smote(train, target, k))


def jitter(rows: DataFrame, sigma: float = 0.01, only_synthetic: bool = True) -> DataFrame:
    """Add N(0, sigma^2) noise per value, reproducible (Box-Muller on two
    md5 uniforms of (id, feature index))."""
    u1 = F.greatest(uniform(F.col("id"), F.col("_i"), tag="j1"), F.lit(1e-300))
    u2 = uniform(F.col("id"), F.col("_i"), tag="j2")
    z = F.sqrt(-2 * F.log(u1)) * F.cos(2 * F.pi() * u2)
    ex = rows.select("*", F.posexplode("features").alias("_i", "_x"))
    cond = F.col("is_synthetic") if only_synthetic else F.lit(True)
    ex = ex.withColumn("_x", F.when(cond, F.col("_x") + F.lit(sigma) * z).otherwise(F.col("_x")))
    keys = [c for c in rows.columns if c != "features"]
    return ex.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_x"))).alias("_p")).select(
        *keys, F.transform("_p", lambda s: s["_x"]).alias("features"))
