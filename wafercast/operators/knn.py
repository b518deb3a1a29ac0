"""G9 + L6: exact k-nearest-neighbour classification, blocked.

Train rows are dealt into blocks of at most about ``block_rows`` rows and
``BLOCK_BYTES`` of features, query rows into strips of that size (their salt); both
numbers come from counts, so a task's memory is bounded however large the sets are.
Every strip meets every block in one task (:mod:`.nearest`: matrix products, and exact
distances for the few rows that their rounding leaves).  A train row is replicated
once a strip and a query row once a block, never rows by rows, and no (query, train)
pair rows are emitted: k per query row and block, merged by a final group on the query
id.  The comparisons are still all rows by all rows, so from ``PRUNE_FROM`` blocks on
a row only meets the blocks that the triangle inequality cannot rule out
(:mod:`.pivots`), if a sample of queries says that this leaves few; the neighbours are
the same.

Prediction is the majority vote of the k neighbours (ties to the smaller
label); ``share`` holds each class's vote fraction (the probability used for
ROC curves)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .nearest import nearest
from .pivots import pruned_neighbours, worth_pruning

BLOCK_ROWS = 131_072
#: Features of a block or strip in a task's memory.
BLOCK_BYTES = 32 << 20
#: A strip has at least about this many query rows if fewer salts already keep all cores busy.
LEAST_STRIP = 256
#: From this many blocks on, pivots and the triangle inequality choose the blocks to meet.
PRUNE_FROM = 8


def _dist2(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (p, q) -> (p - q) * (p - q)), 0D, (s, v) -> s + v)"


def neighbours(train: DataFrame, query: DataFrame, k: int, block_rows: int = BLOCK_ROWS,
               exclude_self: bool = False, same_label: bool = False) -> DataFrame:
    """(qid, nn array<struct<d, id, label>>) with the k nearest train rows; with
    ``same_label`` blocks are dealt inside labels and a query row only meets its own's."""
    keys = ["label"] if same_label else []
    size = train.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("features")).alias("d")).first()
    block_rows = max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, size["d"] or 1))))
    if size["rows"] > PRUNE_FROM * block_rows and worth_pruning(train, query, k, block_rows, size["rows"], exclude_self, same_label):
        return pruned_neighbours(train, query, k, block_rows, size["rows"], exclude_self, same_label)[0]
    per = F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_rows)).cast("int").alias("blocks")
    counts = train.groupBy(*keys).agg(per)     # a row a label, or one row
    total = max(1, counts.agg(F.sum("blocks")).first()[0] or 0)
    dealt = (lambda df: df.join(F.broadcast(counts), keys)) if keys else (lambda df: df.withColumn("blocks", F.lit(total)))
    asked = query.count()
    busy = min(math.ceil(4 * train.sparkSession.sparkContext.defaultParallelism / total), math.ceil(asked / LEAST_STRIP))
    salts = max(1, busy, math.ceil(asked / block_rows))
    tb = dealt(train).select(*dict.fromkeys([*keys, "id", "label", "features"]),
                             F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
                             F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    q = dealt(query).select(*keys, F.col("id").alias("qid"), F.col("features").alias("qf"),
                            F.pmod(F.xxhash64("id", F.lit("salt")), F.lit(salts)).cast("int").alias("salt"),
                            F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    cand = nearest(q, tb, [*keys, "block", "salt"], ["qid"], k, exclude_self, total * salts)
    return cand.groupBy("qid").agg(F.expr(f"slice(array_sort(flatten(collect_list(nn))), 1, {k})").alias("nn"))


def knn_predict(train: DataFrame, query: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, label, prediction, votes, share map<label, fraction>)."""
    nn = neighbours(train, query, k, block_rows)
    votes = nn.select("qid", F.explode(F.expr("transform(nn, x -> x.label)")).alias("c")).groupBy("qid", "c").count()
    best = votes.groupBy("qid").agg(
        F.max(F.struct("count", (-F.col("c")).alias("neg"))).alias("b"),
        F.map_from_entries(F.collect_list(F.struct("c", (F.col("count") / F.lit(float(k))).alias("s")))).alias("share"))
    pred = best.select("qid", (-F.col("b.neg")).cast("int").alias("prediction"),
                       F.col("b.count").alias("votes"), "share")
    return query.select("id", "label").join(pred, query["id"] == pred["qid"]).drop("qid")
