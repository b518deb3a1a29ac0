"""Operator 10: k-d tree sharding by weighted medians (native).

Metadata dimensions are scaled to [0, 1]: language and source by a hash of
their value, size by its logarithm.  Starting from one node, every level
splits each node at the weighted median (weight: bytes) of its widest
dimension until a leaf is at the target bytes.  A dimension's ties, such as
one source that holds a third of the rows, are split by a hash of the row, so
halves are equal down to a few documents even when a whole node has one value.

The medians are distributed: a row's key is its coordinate and then its tie
hash, in ``DIGITS`` digits of 12 bits.  A histogram of bytes over one digit, of
the rows that share the digits found so far, finds the digit in which half
lies; so three histograms, pre-aggregated and of at most 4,096 entries a node,
give the cut of every node of a level.  Running sums over a node's entries are
a window, and cuts are a table (a row a node) that is joined to the rows:
nothing of it reaches the driver, whatever the number of shards.  Rows move only
for the ranks in shards.

The law is ``bytes``: shard sizes are near equal.  Edge cases: a null text has
no bytes (size 1, crc 0); null language or source is a value of its own;
repeated rows each get a place; an empty table gives no rows; extra columns
are ignored.  Equal texts are free to lie in different shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import OFFSETS, hash_rank, read_table, shared_table, text_or_empty

BITS = 12
DIGITS = 3
DIMS = ("c_lang", "c_source", "c_size")
SHARDS = 16


def _unit_hash(col: Column) -> Column:
    """A value's place in [0, 1), null included."""
    return F.pmod(F.xxhash64(F.coalesce(col, F.lit("\u0000none"))), F.lit(1 << BITS)).cast("int")


def metadata(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    base = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
                       F.col("lang").cast("string").alias("l"), F.col("source").cast("string").alias("s"))
    top = (1 << BITS) - 1
    log_size = F.least(F.lit(top), F.floor(F.log2(F.col("size").cast("double")) / 31 * top)).cast("int")
    return base.select("doc_id", "size", "text_crc32", _unit_hash(F.col("l")).alias("c_lang"),
                       _unit_hash(F.col("s")).alias("c_source"), log_size.alias("c_size"),
                       F.xxhash64("doc_id", "text_crc32", "size").alias("h"))


def _keyed(nodes: DataFrame) -> DataFrame:
    """Adds ``key``: the coordinate of the node's widest dimension, then the tie hash."""
    ties = (DIGITS - 1) * BITS
    tie = F.pmod(F.xxhash64("h", F.lit("tie")), F.lit(1 << ties))
    at = F.get(F.array(*DIMS), F.col("widest"))
    return nodes.withColumn("key", (at.cast("long") * (1 << ties) + tie).cast("long"))


def _of_node(rows: DataFrame, table: DataFrame, count: int) -> DataFrame:
    """``rows`` with a table of one row a node, broadcast for at most OFFSETS nodes."""
    return rows.join(F.broadcast(table) if count <= OFFSETS else table, "node")


def find_cuts(nodes: DataFrame, count: int) -> DataFrame:
    """(node, widest, found): a node's widest dimension (ties: the first) and the
    largest key that goes left; written.  ``count``: how many nodes there are."""
    ranges = [f"max({d}) - min({d})" for d in DIMS]
    widest = F.expr("CASE " + " ".join(
        "WHEN " + " AND ".join(f"{ranges[i]} >= {r}" for r in ranges[i + 1:]) + f" THEN {i}" for i in range(len(DIMS) - 1))
        + f" ELSE {len(DIMS) - 1} END")
    cuts = shared_table(nodes.groupBy("node").agg(widest.alias("widest"), (F.sum("size") / 2).alias("goal"))
                        .withColumn("found", F.lit(0).cast("long")), "cuts")
    for digit in range(DIGITS):
        down = (DIGITS - 1 - digit) * BITS
        rows = _keyed(_of_node(nodes, cuts, count))
        if digit:
            rows = rows.where(F.shiftright("key", down + BITS) == F.col("found"))
        hist = rows.groupBy("node", F.shiftright("key", down).alias("k")).agg(F.sum("size").alias("b"))
        run = hist.withColumn("run", F.sum("b").over(Window.partitionBy("node").orderBy("k")))     # 2**BITS rows a node
        # the first entry that reaches the goal, or the last one there is
        short = F.col("run") < F.col("goal")
        best = F.min(F.struct(short.alias("short"), F.when(short, -F.col("k")).otherwise(F.col("k")).alias("order"), "k", "b", "run"))
        picked = _of_node(run, cuts, count).groupBy("node", "widest", "goal").agg(best.alias("e"))
        left = F.col("goal") - (F.col("e.run") - F.col("e.b"))
        found = F.col("e.k")
        if digit == DIGITS - 1:
            # the entry that crosses half goes to the side that ends nearer to it
            found = F.when(F.col("e.b") - left <= left, found).otherwise(found - 1)
        cuts = shared_table(picked.select("node", "widest", left.alias("goal"), found.alias("found")), "cuts")
    return cuts


def kd_shards(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """One row per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``shards`` (a power of two) or ``target_bytes``: leaves are halved until
    their mean is at or below the target."""
    meta = shared_table(metadata(docs), "meta")
    if shards is None:
        total = meta.agg(F.sum("size")).first()[0] or 0
        depth = max(0, math.ceil(math.log2(max(1, total / target_bytes))))
    else:
        depth = int(math.log2(shards))
        if 1 << depth != shards:
            raise ValueError("shards must be a power of two")
    nodes = meta.withColumn("node", F.lit(0))
    for level in range(depth):
        cuts = find_cuts(nodes, 1 << level).select("node", "widest", "found")
        right = (F.col("key") > F.col("found")).cast("int")
        # written: the next level reads it several times
        nodes = shared_table(_keyed(_of_node(nodes, cuts, 1 << level)).withColumn("node", F.col("node") * 2 + right)
                             .select(*nodes.columns), "nodes")
    leaves = nodes.withColumnRenamed("node", "shard")
    ranked = hash_rank(leaves, "shard", [F.col("h"), F.col("doc_id"), F.col("text_crc32")], "slot", groups=1 << depth)
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                         F.col("shard").cast("int").alias("shard"), "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(read_table(spark, sf_dir, "documents"))
