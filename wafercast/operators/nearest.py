"""The k nearest rows of a bounded tile, for many queries at once.

A tile is a group of train rows and the query rows that meet it, both bounded by
the caller; Spark co-groups them and one Arrow function handles each pair.

* Matrix products give each distance up to a bound of their rounding error; only
  rows that may be among the k nearest by those bounds are measured exactly, as
  ``aggregate(zip_with(...))`` does (a sum in the order of the features).
* Train rows are centred and met in the order of their length, so that a few long
  ones do not loosen the bound of the others.
* Of equal train vectors only the first k (by id, label) can be neighbours, so
  thousands of copies count as k.
* Order and edge cases are those of Spark's ``array_sort`` of (d, id, label): a
  vector that is null, holds a null or has another length is at distance null,
  which comes first; NaN comes last; null ids come first, and a row without id
  neither is nor has a neighbour when a row may not meet itself."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES, ROWS = 512, 4096       # of one matrix product
LARGEST = 1e100                 # beyond, squares may overflow


def distance(a: Sequence | None, b: Sequence | None) -> float | None:
    """Squared distance of two vectors as Spark's ``zip_with`` and ``aggregate`` give it."""
    if a is None or b is None or len(a) != len(b) or None in a or None in b:
        return None
    total = 0.0
    for p, q in zip(a, b):
        total += (p - q) * (p - q)
    return total


class Vectors:
    """A column of vectors: ``x`` of the ``plain`` rows (finite, of ``d`` entries),
    ``null`` rows (null, or with a null inside) and the values of all ``other`` ones."""

    def __init__(self, column: pa.ChunkedArray, d: int | None = None):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = size[size >= 0]
        self.d = d if d is not None else int(np.bincount(known).argmax()) if len(known) else 0
        fits = np.flatnonzero(size == self.d)
        x = column.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(fits), self.d)
        fine = (np.abs(x) < LARGEST).all(axis=1)
        self.plain, self.x = fits[fine], x[fine]
        rest = np.setdiff1d(np.arange(len(size)), self.plain)
        values = column.take(pa.array(rest)).to_pylist()
        null = [v is None or None in v for v in values]
        self.null = rest[null] if len(rest) else rest
        self.other = {int(i): v for i, v, n in zip(rest, values, null) if not n}


def first_copies(x: np.ndarray, ids: np.ndarray, k: int, exclude_self: bool) -> np.ndarray:
    """Which rows may be neighbours: the first ``k`` of equal vectors, and with
    ``exclude_self`` the first ``k`` rows of each of its first ``k + 1`` ids.
    ``ids`` are numbers that rise with the rows."""
    if not len(x) or not x.shape[1]:
        group = np.zeros(len(x), np.int64)
    else:
        bits = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
        group = np.unique(bits, return_inverse=True)[1].ravel()
    order = np.argsort(group, kind="stable")
    g, own = group[order], ids[order]
    at = np.arange(len(g))
    new = np.r_[True, g[1:] != g[:-1]][:len(g)]
    start = np.maximum.accumulate(np.where(new, at, 0))
    if exclude_self:
        newid = new | np.r_[True, own[1:] != own[:-1]][:len(g)]
        seen = np.cumsum(newid)
        keep = (seen - seen[start] <= k) & (at - np.maximum.accumulate(np.where(newid, at, 0)) < k) if len(g) else at < 0
    else:
        keep = at - start < k
    return np.sort(order[keep])


def candidates(q: np.ndarray, x: np.ndarray, k: int, own: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, exact squared distance): the k nearest rows of ``x`` of every
    query and possibly others; ``own`` holds pairs that may not meet."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if not len(x) or not len(q):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    mid = x.mean(axis=0)
    xc, qc = x - mid, q - mid
    length = (xc * xc).sum(axis=1)
    order = np.argsort(length, kind="stable")
    length, place = length[order], np.empty(len(x), np.int64)
    place[order] = np.arange(len(x))
    wide = np.vstack([-2.0 * xc[order].T, length])
    err = 8.0 * (x.shape[1] + 8) * np.finfo(float).eps
    ends, s = [], 0
    floor = 1e4 * length[len(x) // 2]
    while s < len(x):
        e = min(s + ROWS, max(s + 1, int(np.searchsorted(length, max(floor, 100 * length[s]), side="right"))))
        ends.append((s, e))
        s = e
    qt, xt = np.ascontiguousarray(q.T), np.ascontiguousarray(x[order].T)
    own_at = np.searchsorted(own[0], np.arange(0, len(q) + QUERIES, QUERIES))
    for b, at in enumerate(range(0, len(q), QUERIES)):
        part = qc[at:at + QUERIES]
        n = len(part)
        left = np.hstack([part, np.ones((n, 1))])
        norm = (part * part).sum(axis=1)
        mine = slice(own_at[b], own_at[b + 1])
        own_row, own_col = own[0][mine] - at, place[own[1][mine]]
        best, most = np.full((n, k), np.inf), np.full(n, np.inf)
        ri, ci, low = [], [], []
        for s, e in ends:
            a = left @ wide[:, s:e]
            here = (own_col >= s) & (own_col < e)
            a[own_row[here], own_col[here] - s] = np.inf
            reach = np.sqrt(norm) + np.sqrt(length[e - 1])
            slack = err * reach ** 2
            if np.isinf(most).any():
                top = np.partition(a, k - 1, axis=1)[:, :k] if e - s > k else a
                best = np.partition(np.hstack([best, top + slack[:, None]]), k - 1, axis=1)[:, :k]
                most = best.max(axis=1)
                i, j = np.nonzero(a <= (most + slack)[:, None])
                v = a[i, j]
            else:
                i, j = np.nonzero(a <= (most + slack)[:, None])
                v = a[i, j]
                count = np.bincount(i, minlength=n)
                if len(i):
                    more = np.full((n, count.max()), np.inf)
                    more[i, np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)] = v + slack[i]
                    best = np.partition(np.hstack([best, more]), k - 1, axis=1)[:, :k]
                    most = best.max(axis=1)
            ri.append(i)
            ci.append(j + s)
            low.append(v - slack[i])
        i, j, v = np.concatenate(ri), np.concatenate(ci), np.concatenate(low)
        stay = (v <= most[i]) & (v < np.inf)
        i, j = i[stay] + at, j[stay]
        d = np.zeros(len(i))
        for c in range(x.shape[1]):
            gap = qt[c][i] - xt[c][j]
            d += gap * gap
        row = order[j]
        # the k nearest of each query; rows are in the order of (id, label)
        by = np.lexsort((row, d, i))
        i, row, d = i[by], row[by], d[by]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        found.append((i[rank < k], row[rank < k], d[rank < k]))
    return tuple(np.concatenate(f) for f in zip(*found))


def _numbers(ids: pa.Array, asked: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids as numbers that rise with them, and the range of rows of each asked id."""
    values = ids.to_numpy(zero_copy_only=False) if pa.types.is_integer(ids.type) else np.array([*ids.to_pylist(), None], object)[:-1]
    change = np.r_[False, values[1:] != values[:-1]][:len(values)]
    if asked is None:
        return np.cumsum(change), np.zeros((0, 2), np.int64)
    span = np.zeros((len(asked), 2), np.int64)
    valid = np.flatnonzero(asked.is_valid().to_numpy(zero_copy_only=False))
    if len(values) and len(valid):
        some = asked.take(pa.array(valid))
        want = some.to_numpy(zero_copy_only=False) if pa.types.is_integer(some.type) and values.dtype != object else np.array([*some.to_pylist(), None], object)[:-1]
        span[valid, 0], span[valid, 1] = np.searchsorted(values, want, "left"), np.searchsorted(values, want, "right")
    return np.cumsum(change), span


def search(query: pa.Table, train: pa.Table, k: int, exclude_self: bool) -> tuple[np.ndarray, pa.Table, np.ndarray, np.ndarray]:
    """(query row, sorted train table, its row, distance; masked where it is null): the
    k nearest rows of ``train`` (id, label, features) for each row of ``query`` (qid, qf)."""
    if exclude_self:
        train = train.filter(pc.is_valid(train["id"]))
    train = train.take(pc.sort_indices(train.select(["id", "label"]), sort_keys=[("id", "ascending"), ("label", "ascending")],
                                       null_placement="at_start"))
    ids = train["id"].combine_chunks()
    asked = query["qid"].combine_chunks()
    number, span = _numbers(ids, asked if exclude_self else None)
    t = Vectors(train["features"])
    v = Vectors(query["qf"], t.d)
    kept = first_copies(t.x, number[t.plain], k, exclude_self)
    rows, x = t.plain[kept], t.x[kept]
    meets = asked.is_valid().to_numpy(zero_copy_only=False) if exclude_self else np.ones(len(asked), bool)
    live = meets[v.plain]
    who, q = v.plain[live], v.x[live]
    if exclude_self:
        lo, hi = np.searchsorted(rows, span[who, 0]), np.searchsorted(rows, span[who, 1])
        pair = np.repeat(np.arange(len(who)), hi - lo)
        own = pair, np.arange(len(pair)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
    else:
        own = np.empty(0, np.int64), np.empty(0, np.int64)
    i, j, d = candidates(q, x, k, own)
    qi, ti, dist, null = [who[i]], [rows[j]], [d], [np.zeros(len(i), bool)]

    def add(at: int, row: np.ndarray, values: list[float | None]) -> None:
        away = (row < span[at, 0]) | (row >= span[at, 1]) if exclude_self else np.ones(len(row), bool)
        row, values = row[away], [x for x, a in zip(values, away) if a]
        qi.append(np.full(len(row), at))
        ti.append(row)
        dist.append(np.array([0.0 if x is None else x for x in values], float))
        null.append(np.array([x is None for x in values], bool))

    def first(row: np.ndarray, at: int) -> np.ndarray:
        """The first k of ``row`` that are not the query itself, and maybe its own."""
        extra = np.searchsorted(row, span[at, 1]) - np.searchsorted(row, span[at, 0]) if exclude_self else 0
        return row[:k + extra]

    other = np.array(sorted(t.other), np.int64)
    for at in who if len(t.null) or len(other) else ():
        some = first(t.null, at)
        add(at, some, [None] * len(some))
        if len(other):
            mine = query["qf"][int(at)].as_py()
            add(at, other, [distance(mine, t.other[int(o)]) for o in other])
    every = np.arange(len(train))
    for at in v.null[meets[v.null]]:
        some = first(every, at)
        add(at, some, [None] * len(some))
    if any(meets[a] for a in v.other):
        vectors = train["features"].to_pylist()
        for at, mine in v.other.items():
            if meets[at]:
                add(at, every, [distance(mine, o) for o in vectors])
    qi, ti, dist, null = (np.concatenate(p) for p in (qi, ti, dist, null))
    by = np.lexsort((ti, dist, ~null, qi))
    qi, ti, dist, null = qi[by], ti[by], dist[by], null[by]
    rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
    short = rank < k
    return qi[short], train, ti[short], np.ma.array(dist[short], mask=null[short])


def nearest(query: DataFrame, train: DataFrame, on: list[str], carry: list[str], k: int, exclude_self: bool, tasks: int) -> DataFrame:
    """``carry`` of each row of ``query`` (qid, qf, ``on``) and ``nn``, its k nearest
    rows of ``train`` (id, label, features) with the same ``on``, as
    array<struct<d, id, label>>, nearest first.  Rows that meet none are left out."""
    kind = {f.name: f.dataType.simpleString() for f in train.schema}
    asked = {f.name: f.dataType.simpleString() for f in query.schema}
    schema = ", ".join([*(f"{c} {asked[c]}" for c in carry), f"nn array<struct<d: double, id: {kind['id']}, label: {kind['label']}>>"])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            left, right = left.slice(0, 0), right.slice(0, 0)
        qi, rows, ti, d = search(left, right, k, exclude_self)
        take = pa.array(ti)
        nn = pa.StructArray.from_arrays(
            [pa.array(d.data, pa.float64(), mask=np.ma.getmaskarray(d)), rows["id"].combine_chunks().take(take),
             rows["label"].combine_chunks().take(take)], ["d", "id", "label"])
        offsets = np.searchsorted(qi, np.arange(left.num_rows + 1)).astype(np.int32)
        return pa.table([*(left[c] for c in carry), pa.ListArray.from_arrays(pa.array(offsets), nn)], names=[*carry, "nn"])

    # names of their own: both sides may come from the same rows
    keys = [f"on_{c}" for c in on]
    sides = ((query, [*carry, "qid", "qf"]), (train, ["id", "label", "features"]))
    left, right = (df.select(*(F.col(c).alias(n) for c, n in zip(on, keys)), *(F.col(c).alias(c) for c in dict.fromkeys(rest)))
                   .repartition(tasks, *keys).groupBy(*keys) for df, rest in sides)
    return left.cogroup(right).applyInArrow(run, schema)
