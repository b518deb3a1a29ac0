"""Operator 5: best-fit packing by a grouping genetic algorithm on islands.

* Pieces: every document's token ids plus an end id, cut only when longer than
  a sequence.  One pass over the texts leaves (doc_id, piece, start, length,
  crc) in the shared folder.  A piece of full length is a sequence by itself.
* The rest is dealt by hash into groups of about ``GROUP_ITEMS`` pieces.  Each
  group evolves on ``ISLANDS`` islands, each a Spark group of its own.  An
  individual is a list of bins.  Crossover injects whole well-filled bins of
  one parent into the other, removes the bins that hold a duplicate, and puts
  the displaced pieces back by best fit, longest first; mutation opens the
  emptiest bins.  After each epoch every island's elite moves on to the next
  island of its group (a join on small rows).
* The bins of a group that are filled below ``POOL_FILL`` are opened, and
  their pieces go to the next, smaller round, until one group holds them
  all or a round no longer halves the pool.  So cutting the corpus into groups
  costs no more than part of one bin in all.

A group has a fixed size whatever the corpus, groups are dealt by hash, and
nothing but counts reaches the driver.

Edge cases: a null text is empty (the end id alone); repeated rows are packed
each; an empty table gives no rows; extra columns are ignored; equal lengths
are ordered by doc_id and piece, so results repeat.
"""

from __future__ import annotations

import math
import random
import struct
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, shared_table, slices
from .token_counts import vocabulary_path
from .vocab import ChunkReader, load_tokenizer

CAPACITY = 4096
END_ID = 1
GROUP_ITEMS = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
OFFSPRING = 6
POOL_FILL = 0.97


# ---- pieces

@lru_cache(maxsize=4)
def _reader(path: str) -> ChunkReader:
    tok = load_tokenizer(path)
    model = tok.model
    return ChunkReader(tok, lambda p: struct.pack(f"<{len(t := model.tokenize(p))}I", *[x.id for x in t]),
                       lambda s: np.array([tok.token_to_id(s)], "<u4").tobytes(), b"".join)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        reader, end = _reader(path), np.array([end_id], "<u4").tobytes()
        for batch in (part for whole in batches for part in slices(whole)):
            row, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = b"".join(reader.values(text or b"")) + end
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    row.append(k)
                    piece.append(i)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long")


# ---- the genetic algorithm, over one group's lengths (longest first)

def best_fit(items, lengths, bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Put ``items`` one by one into the fullest bin that has room."""
    free = sorted((capacity - sum(lengths[i] for i in b), k) for k, b in enumerate(bins))
    for i in items:
        need = lengths[i]
        at = bisect_left(free, (need, -1))
        if at < len(free):
            room, k = free.pop(at)
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        insort(free, (room - need, k))
    return bins


def fitness(bins, lengths, capacity) -> tuple[int, float]:
    """Fewer bins first, then bins as full (and as empty) as can be."""
    return len(bins), -sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(a, b, lengths, capacity, rng) -> list[list[int]]:
    full = sorted(b, key=lambda x: -sum(lengths[i] for i in x))
    good = full[:max(1, len(full) // 2)]
    injected = rng.sample(good, max(1, len(good) // 2))
    held = {i for x in injected for i in x}
    kept, displaced = [list(x) for x in injected], []
    for x in a:
        if held.isdisjoint(x):
            kept.append(list(x))
        else:
            displaced += [i for i in x if i not in held]
    return best_fit(sorted(displaced), lengths, kept, capacity)


def mutate(bins, lengths, capacity, rng) -> list[list[int]]:
    order = sorted(bins, key=lambda x: sum(lengths[i] for i in x))
    n = max(2, len(order) // 20)
    opened = [i for x in order[:n] for i in x]
    rng.shuffle(opened)
    return best_fit(opened, lengths, [list(x) for x in order[n:]], capacity)


def evolve(lengths: list[int], seeds: list[list[list[int]]], capacity: int, seed: int,
           population: int = POPULATION, offspring: int = OFFSPRING) -> list[list[int]]:
    """One epoch of an island; returns its elite."""
    rng = random.Random(seed)
    least = math.ceil(sum(lengths) / capacity)
    people = [list(map(list, s)) for s in seeds] or [best_fit(range(len(lengths)), lengths, [], capacity)]
    score = lambda p: fitness(p, lengths, capacity)
    while len(people) < population and min(map(len, people)) > least:
        noisy = sorted(range(len(lengths)), key=lambda i: -lengths[i] * (1 + 0.2 * rng.random()))
        people.append(best_fit(noisy, lengths, [], capacity))
    people.sort(key=score)
    for _ in range(offspring):
        if len(people[0]) <= least or len(people) < 2:
            break
        a, b = rng.sample(people, 2)
        child = crossover(a, b, lengths, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, lengths, capacity, rng)
        people = sorted([*people, child], key=score)[:population]
    return people[0]


def _encode(bins, n: int) -> bytes:
    out = np.empty(n, "<u2")
    for k, b in enumerate(bins):
        out[b] = k
    return out.tobytes()


def _decode(blob: bytes) -> list[list[int]]:
    at = np.frombuffer(blob, "<u2")
    order = np.argsort(at, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(at[order])) + 1)] if len(at) else []


def _canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                           kind="stable", ignore_index=True)


ELITE = "grp long, island int, n_bins int, lengths binary, elite binary"


def _start(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        grp, island = int(pdf.grp.iloc[0]), int(pdf.island.iloc[0])
        lengths = _canonical(pdf).length.tolist()
        best = evolve(lengths, [], capacity, seed=grp * 1009 + island)
        return pd.DataFrame([(grp, island, len(best), np.array(lengths, "<u4").tobytes(),
                              _encode(best, len(lengths)))], columns=["grp", "island", "n_bins", "lengths", "elite"])
    return run


def _epoch(capacity: int, epoch: int):
    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                lengths = np.frombuffer(r.lengths, "<u4").tolist()
                best = evolve(lengths, [_decode(r.elite), _decode(r.migrant)], capacity,
                              seed=r.grp * 1009 + r.island + 7919 * epoch)
                rows.append((r.grp, r.island, len(best), r.lengths, _encode(best, len(lengths))))
            yield pd.DataFrame(rows, columns=["grp", "island", "n_bins", "lengths", "elite"])
    return run


def evolve_groups(items: DataFrame, capacity: int) -> DataFrame:
    """(grp, elite): the best packing that the islands of each group found."""
    spread = items.select("grp", "doc_id", "piece", "ids_crc32", "length",
                          F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    elites = shared_table(spread.groupBy("grp", "island").applyInPandas(_start(capacity), ELITE), "elites")
    for epoch in range(1, EPOCHS):
        migrants = elites.select("grp", ((F.col("island") + 1) % ISLANDS).alias("island"),
                                 F.col("elite").alias("migrant"))
        elites = shared_table(elites.join(migrants, ["grp", "island"])
                              .mapInPandas(_epoch(capacity, epoch), ELITE), "elites")
    return elites.groupBy("grp").agg(F.min_by("elite", F.struct("n_bins", "island")).alias("elite"))


def _place(capacity: int, fill: float):
    def run(items: pd.DataFrame, best: pd.DataFrame) -> pd.DataFrame:
        items = _canonical(items)
        items["bin"] = np.frombuffer(best.elite.iloc[0], "<u2").astype("int64") if len(best) else 0
        items = items.sort_values("bin", kind="stable", ignore_index=True)
        total = items.groupby("bin").length.cumsum()
        items["offset"] = total - items.length
        items["poor"] = items.groupby("bin").length.transform("sum") < fill * capacity
        return items[["doc_id", "piece", "start", "length", "ids_crc32", "grp", "bin", "offset", "poor"]]
    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    pieces = shared_table(token_pieces(docs, path, capacity), "pieces")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = pieces.where(F.col("length") == capacity).select(
        *cols, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    parts = [whole]
    pool = pieces.where(F.col("length") < capacity)
    n = pool.count()
    for step in range(1, 64):   # each round at least halves the pool, or it is the last
        if n == 0:
            break
        groups = max(1, math.ceil(n / GROUP_ITEMS))
        items = pool.select(*cols, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(step)),
                                          F.lit(groups)).alias("grp"))
        best = evolve_groups(items, capacity)
        placed = shared_table(
            items.groupBy("grp").cogroup(best.groupBy("grp")).applyInPandas(
                _place(capacity, POOL_FILL if groups > 1 else 0.0),
                f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, grp long, bin long, "
                "offset long, poor boolean"), "placed")
        poor = placed.where("poor").count()
        last = groups == 1 or 2 * poor > n
        done = placed if last else placed.where("not poor")
        # whole pieces have numbers from 0 up, rounds, groups and bins their own digits below 0
        parts.append(done.select(*cols, (F.lit(-(step << 52)) - F.col("grp") * 65536
                                         - F.col("bin")).alias("sequence_id"), "offset"))
        if last:
            break
        pool, n = placed.where("poor").select(*cols), poor
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), vocabulary_path())
