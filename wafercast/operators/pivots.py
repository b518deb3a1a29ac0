"""Exact nearest neighbours that meet few blocks.

* Pivots: a hash sample of at most ``MAX_PIVOTS`` train rows.  Every row belongs
  to the cell of its nearest pivot (a Voronoi split) and knows its distance r to
  it.  The pivots are all that the driver and every task hold.
* Blocks: a cell is cut into rings of about ``block_rows`` rows by r, from a
  histogram of ``RINGS`` ranges a cell; a ring of equal distances, such as
  thousands of copies, is dealt further by hash.  A block knows its least and
  largest r.
* First bound: the k smallest r of each cell, plus the query's distance to its
  pivot, bound the distance of the k-th neighbour.  The query then meets the
  blocks of its own cell whose ring its distance lies in or next to, which
  tightens the bound.
* Second meeting: by the triangle inequality nothing in a block is nearer than
  ``max(d - r_max, r_min - d)``, with d the query's distance to the block's
  pivot, and by the Voronoi split nothing in another cell is nearer than half
  the difference of the squared distances over the pivots' distance.  Only
  blocks that either leaves below the bound are met.  Bounds are loosened by
  ``SLACK`` against rounding, so results are those of comparing all pairs.

How much is saved depends on the data: clusters leave a few blocks a row, noise in
many dimensions may leave all of them, and then this is the blocked search."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_shared
from .nearest import nearest

MAX_PIVOTS = 1024
RINGS = 1024
SLACK = 1e-9
SALTS = 4
#: Queries that estimate what pruning leaves, and the share of the rows from which on it is not worth its shuffles.
PROBES = 64
OPEN_SHARE = 0.25


def _rows(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    # differences, not products: a row that is a pivot is at distance 0
    out = np.empty((len(x), len(pivots)))
    for j, p in enumerate(pivots):
        out[:, j] = np.sqrt(((x - p) ** 2).sum(1))
    return out


def choose_pivots(train: DataFrame, rows: int, block_rows: int) -> np.ndarray:
    """About twice as many pivots as blocks, at most the square root of the rows and MAX_PIVOTS."""
    want = max(1, min(MAX_PIVOTS, 2 * math.ceil(rows / block_rows), int(math.sqrt(rows))))
    picked = train.select("features", F.xxhash64("id", F.lit("pivot")).alias("h")).orderBy("h").limit(want).collect()
    return np.unique(np.array([r["features"] for r in picked], float), axis=0)


def with_cell(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds cell and r, the nearest pivot and the distance to it."""
    schema = rows.withColumns({"cell": F.lit(0), "r": F.lit(0.0)}).schema

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                d = _distances(_rows(part.column("features"), part.num_rows), pivots)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                                                 names=[*part.schema.names, "cell", "r"])

    return rows.mapInArrow(run, schema)


def ring_blocks(train: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    """Adds block, a row's number of its group, cell, ring and deal; ``train`` has cell and r."""
    cell = [*keys, "cell"]
    span = train.groupBy(*cell).agg(F.max("r").alias("top"))
    ranged = train.join(span, cell).withColumn("range", F.least(
        F.floor(F.coalesce(F.try_divide("r", "top"), F.lit(0.0)) * RINGS), F.lit(RINGS - 1)).cast("int")).drop("top")
    sizes = ranged.groupBy(*cell, "range").agg(F.count(F.lit(1)).alias("own"))
    before = F.expr(f"sum(own) over (partition by {', '.join(cell)} order by range rows between unbounded preceding and current row) - own")
    rings = sizes.select(*cell, "range", F.floor(before / block_rows).alias("ring"), F.ceil(F.col("own") / block_rows).alias("deals"))
    dealt = ranged.join(rings, [*cell, "range"])
    deal = F.when(F.col("deals") > 1, F.pmod(F.xxhash64("id", F.lit("deal")), F.col("deals")) * 1024 + F.col("range") + 1).otherwise(F.lit(0))
    return dealt.withColumn("block", F.xxhash64(*cell, "ring", deal)).drop("range", "ring", "deals")


def pruned_neighbours(train: DataFrame, query: DataFrame, k: int, block_rows: int, rows: int, exclude_self: bool = False,
                      same_label: bool = False, local: str = "") -> tuple[DataFrame, DataFrame]:
    """((qid, nn), (qid, met)): the k nearest train rows, nearest first, and how
    many blocks a query met.  Blocks and queries meet in :func:`.nearest.nearest`;
    ``local``, a query's k nearest in an array, is what it replaced and is not used."""
    keys = ["label"] if same_label else []
    pivots = choose_pivots(train, rows, block_rows)
    placed = write_shared(ring_blocks(with_cell(train.select("id", "label", "features"), pivots), keys, block_rows), "cells")
    rings = write_shared(placed.groupBy(*keys, "cell", "block").agg(F.min("r").alias("r_min"), F.max("r").alias("r_max")), "blocks")
    salts = max(SALTS, math.ceil(query.count() / block_rows))       # bounds the queries that meet a block in one task
    salt = F.pmod(F.xxhash64("qid", F.lit("salt")), F.lit(salts)).cast("int").alias("salt")
    salted = placed.select("block", "id", "label", "features", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    tasks = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # a row a group and cell: its largest distance, its smallest ones (one more for the row itself)
    near = k + 1 if exclude_self else k
    summary: dict = {}
    for c in _cell_summary(placed, keys, near).collect():       # at most labels x MAX_PIVOTS rows of k numbers
        summary.setdefault(c["label"] if same_label else None, []).append((c["cell"], c["top"], c["few"]))
    between = _distances(pivots, pivots)

    def reach(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                d = _distances(_rows(part.column("qf"), part.num_rows), pivots)
                home = d.argmin(1)
                groups = part.column("label").to_pylist() if same_label else [None] * len(d)
                bound = part.column("bound").to_numpy(zero_copy_only=False)
                first = np.isnan(bound)
                row, cell, dist, limit = [], [], [], []
                for i, g in enumerate(groups):
                    own = summary.get(g, [])
                    if not own:
                        continue
                    ids = np.array([c for c, _, _ in own])
                    far = np.array([t for _, t, _ in own])
                    most = bound[i]
                    if first[i]:
                        alls = np.sort(np.concatenate([d[i, c] + np.array(few) for c, _, few in own]))
                        most = alls[near - 1] if len(alls) >= near else np.inf
                    gap = np.maximum(d[i, ids] - far, 0.0)
                    apart = between[home[i], ids]
                    half = np.where(apart > 0, (d[i, ids] ** 2 - d[i, home[i]] ** 2) / (2 * np.where(apart > 0, apart, 1.0)), 0.0)
                    open_ = np.maximum(gap, half) * (1 - SLACK) - SLACK <= most
                    if first[i]:
                        # the first meeting: the query's own cell, or the nearest that has rows
                        pick = ids[[int(np.argmin(d[i, ids]))]]
                    else:
                        pick = ids[open_]
                    row += [i] * len(pick)
                    cell += pick.tolist()
                    dist += d[i, pick].tolist()
                    limit += [most] * len(pick)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("label").take(take), part.column("qid").take(take), part.column("qf").take(take),
                     pa.array(cell, pa.int32()), pa.array(dist, pa.float64()), pa.array(limit, pa.float64())],
                    names=["label", "qid", "qf", "cell", "d", "bound"])

    kinds = {f.name: f.dataType.simpleString() for f in query.schema}
    schema = f"label {kinds['label']}, qid {kinds['id']}, qf {kinds['features']}, cell int, d double, bound double"

    def meet(rows_: DataFrame) -> DataFrame:
        """(qid, block, nn) of the unseen blocks that the bound leaves."""
        least = F.greatest(F.col("d") - F.col("r_max"), F.col("r_min") - F.col("d"), F.lit(0.0))
        pairs = rows_.join(rings, [*keys, "cell"]).where(least * (1 - SLACK) - SLACK <= F.col("bound"))
        pairs = pairs.select("qid", "qf", "block", salt).join(seen.select("qid", "block"), ["qid", "block"], "left_anti")
        return nearest(pairs, salted, ["block", "salt"], ["qid", "block"], k, exclude_self, tasks)

    asked = query.select("label", F.col("id").alias("qid"), F.col("features").alias("qf"), F.lit(float("nan")).alias("bound"))
    start = write_shared(asked.mapInArrow(reach, schema), "asked")
    # of the own cell only the rings at the query's distance, or the nearest one
    gap = F.greatest(F.col("r_min") - F.col("d"), F.col("d") - F.col("r_max"), F.lit(0.0))
    ring = start.join(rings, [*keys, "cell"]).groupBy("qid").agg(F.min_by(F.struct("block"), F.struct(gap, "block")).alias("b"))
    mine = start.join(ring, "qid").select("qid", "qf", "bound", F.col("b.block").alias("block"), salt)
    seen = write_shared(nearest(mine, salted, ["block", "salt"], ["qid", "bound", "block"], k, exclude_self, tasks), "met")
    kth = F.when(F.size("nn") >= k, F.sqrt(F.element_at("nn", k)["d"])).otherwise(F.lit(float("inf")))
    bounds = seen.select("qid", F.least("bound", kth).alias("bound"))
    again = asked.drop("bound").join(bounds, "qid").select("label", "qid", "qf", "bound")
    rest = meet(again.mapInArrow(reach, schema))
    parts = write_shared(seen.select("qid", "nn").unionByName(rest.select("qid", "nn")), "met")
    nn = parts.groupBy("qid").agg(F.expr(f"slice(array_sort(flatten(collect_list(nn))), 1, {k})").alias("nn"))
    return nn, parts.groupBy("qid").agg(F.count(F.lit(1)).alias("met"))


def worth_pruning(train: DataFrame, query: DataFrame, k: int, block_rows: int, rows: int, exclude_self: bool, same_label: bool) -> bool:
    """Whether pivots and the triangle inequality rule out most rows for a sample of
    queries.  Two passes over the train rows: the probes' true k-th distances, then the
    rows that these leave.  It chooses how to search; either way finds the same rows."""
    picked = query.where(F.col("features").isNotNull()).select("id", "label", "features").orderBy(F.xxhash64("id", F.lit("probe"))).limit(PROBES).collect()
    pivots = choose_pivots(train, rows, block_rows)
    d = pivots.shape[1]
    picked = [p for p in picked if len(p["features"]) == d and None not in p["features"]]
    if not picked:
        return True
    x = np.array([p["features"] for p in picked], float)
    mine, group = {p["id"]: i for i, p in enumerate(picked)}, [p["label"] for p in picked]
    to_pivot, between = _distances(x, pivots), _distances(pivots, pivots)
    home = to_pivot.argmin(axis=1)
    fit = train.where(F.size("features") == d).select("id", "label", "features")

    def batches_of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                t = _rows(part.column("features"), part.num_rows)
                other = np.zeros((len(x), len(t)), bool)       # rows a probe does not ask
                if same_label:
                    label = part.column("label").to_pylist()
                    other |= np.array([[g != v for v in label] for g in group])
                if exclude_self:
                    for j, i in enumerate(part.column("id").to_pylist()):
                        if i in mine:
                            other[mine[i], j] = True
                yield t, other

    def nearest_of(batches):
        best = np.full((len(x), k), np.inf)
        for t, other in batches_of(batches):
            near = np.where(other, np.inf, _distances(t, x).T)
            best = np.sort(np.hstack([best, near]), axis=1)[:, :k]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(x)), k).astype(np.int32)), pa.array(best.ravel())], names=["probe", "d"])

    found: list[list[float]] = [[] for _ in picked]
    for r in fit.mapInArrow(nearest_of, "probe int, d double").where("d < double('infinity')").collect():     # probes x k a task
        found[r["probe"]].append(r["d"])
    kth = np.array([sorted(f)[k - 1] if len(f) >= k else np.inf for f in found])

    def open_of(batches):
        left = asked = 0
        for t, other in batches_of(batches):
            far = _distances(t, pivots)
            cell = far.argmin(axis=1)
            least = np.abs(to_pivot[:, cell] - far[np.arange(len(t)), cell])
            apart = between[home][:, cell]
            half = np.where(apart > 0, (to_pivot[:, cell] ** 2 - to_pivot[np.arange(len(x)), home][:, None] ** 2) / (2 * np.where(apart > 0, apart, 1.0)), 0.0)
            left += int((~other & (np.maximum(least, half) <= kth[:, None])).sum())
            asked += int((~other).sum())
        yield pa.RecordBatch.from_arrays([pa.array([left]), pa.array([asked])], names=["left", "asked"])

    r = fit.mapInArrow(open_of, "left long, asked long").agg(F.sum("left").alias("left"), F.sum("asked").alias("asked")).first()
    return (r["left"] or 0) <= OPEN_SHARE * (r["asked"] or 0)


def _cell_summary(placed: DataFrame, keys: list[str], near: int) -> DataFrame:
    """(label, cell, top, few): the largest distance and the ``near`` smallest;
    each block gives its own smallest first, so no group grows with a cell."""
    cell = [*keys, "cell"]
    small = placed.groupBy(*cell, "block").agg(F.slice(F.array_sort(F.collect_list("r")), 1, near).alias("few"), F.max("r").alias("top"))
    return small.groupBy(*cell).agg(F.max("top").alias("top"), F.slice(F.array_sort(F.flatten(F.collect_list("few"))), 1, near).alias("few"))
