"""Hash-ranked, skew-safe sampling within classes.

Every sampling step needs each row's rank inside its class, ordered by
``md5('<seed>|<id>')`` then ``id``.  A plain ``row_number() over (partition
by label)`` would put a whole class -- possibly a third of all rows -- into
one task.  Instead the rank is built in two exact levels:

1. the first 16 bits of the hash give a bucket; a histogram
   ``(label, bucket) -> count`` (at most classes x 65,536 rows, whatever the
   data size) yields each bucket's starting offset by a running sum;
2. a ``row_number`` inside ``(label, bucket)`` -- about n_class / 65,536 rows
   per group -- finishes the rank.

Buckets are hash prefixes, so bucket order agrees with hash order and the
rank equals the global one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import N_FOLDS, SEED, TARGET_PER_CLASS, TEST_FRACTION
from ..functions.hashing import rank_key


def class_rank(df: DataFrame, key: str = "label", id_col: str = "id", seed: int = SEED,
               out: str = "rk") -> DataFrame:
    h = rank_key(id_col, seed)
    df = df.withColumn("_h", h).withColumn("_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    hist = df.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = hist.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    wb = Window.partitionBy(key, "_b").orderBy("_h", id_col)
    return (df.join(offs, [key, "_b"])
            .withColumn(out, (F.col("_off") + F.row_number().over(wb)).cast("int"))
            .drop("_h", "_b", "_off"))


def split_quotas(df: DataFrame, test_fraction: float = TEST_FRACTION, key: str = "label") -> DataFrame:
    """Per-class (label, n, n_train, n_test): n_test_total = ceil(f * n);
    train shares by floor + largest remainder (ties to the smaller label);
    test takes the rest of each class.  A table of one row per class."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    tot = Window.partitionBy(F.lit(1))
    c = counts.withColumn("n_all", F.sum("n").over(tot))
    c = c.withColumn("n_test_all", F.ceil(F.col("n_all") * F.lit(test_fraction)).cast("long"))
    c = c.withColumn("n_train_all", F.col("n_all") - F.col("n_test_all"))
    c = (c.withColumn("fl", F.expr("(n * n_train_all) div n_all"))
         .withColumn("rem", F.expr("(n * n_train_all) % n_all")))
    c = c.withColumn("need", F.col("n_train_all") - F.sum("fl").over(tot))
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("rem"), F.col(key))
    c = c.withColumn("pos", F.row_number().over(order))
    c = c.withColumn("n_train", F.col("fl") + F.when((F.col("pos") <= F.col("need")) & (F.col("rem") > 0), 1).otherwise(0))
    return c.select(key, "n", F.col("n_train").cast("long").alias("n_train"),
                    (F.col("n") - F.col("n_train")).cast("long").alias("n_test"))


def stratified_split(df: DataFrame, test_fraction: float = TEST_FRACTION, key: str = "label",
                     id_col: str = "id") -> DataFrame:
    """H1: adds ``split`` ('train'/'test') and ``trk`` (1-based hash rank
    among the class's train rows).  The first n_test rows of a class by hash
    go to test."""
    q = split_quotas(df, test_fraction, key).select(key, "n_test", "n_train")
    r = class_rank(df, key, id_col)
    r = r.join(F.broadcast(q), key)   # one row per class
    return (r.withColumn("split", F.when(F.col("rk") <= F.col("n_test"), "test").otherwise("train"))
            .withColumn("trk", F.when(F.col("split") == "train", F.col("rk") - F.col("n_test")).cast("int"))
            .drop("rk", "n_test"))


def kfold(split_df: DataFrame, n_folds: int = N_FOLDS) -> DataFrame:
    """H3: fold of each train row, round robin over its hash rank in class,
    so every class is spread evenly over the folds."""
    return (split_df.where(F.col("split") == "train")
            .withColumn("fold", ((F.col("trk") - 1) % n_folds).cast("int")))


def undersample(split_df: DataFrame, target: int = TARGET_PER_CLASS) -> DataFrame:
    """H2: train rows of classes above ``target`` keep their first ``target``
    rows by hash; other classes are kept whole."""
    tr = split_df.where(F.col("split") == "train")
    return tr.where((F.col("n_train") <= target) | (F.col("trk") <= target))


def prune_train(split_df: DataFrame, fraction: float = 0.10) -> DataFrame:
    """Drop ``fraction`` of each class's train rows (the last ones by
    hash rank)."""
    tr = split_df.where(F.col("split") == "train")
    keep = F.col("n_train") - F.floor(F.col("n_train") * F.lit(fraction))
    return tr.where(F.col("trk") <= keep)
