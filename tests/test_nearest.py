"""The tile search gives what Spark's arrays of (d, id, label) gave, whatever the rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wafercast.operators import knn as K
from wafercast.operators import nearest as N
from wafercast.operators.pivots import worth_pruning


def _plain(query, train, k, exclude_self):
    out = []
    for qid, qf in query:
        rows = []
        for i, label, f in train:
            if exclude_self and (i is None or qid is None or i == qid):
                continue
            d = N.distance(qf, f)
            order = (0, 0.0) if d is None else (2, 0.0) if np.isnan(d) else (1, d)
            rows.append((order, (i is not None, i or 0), (label is not None, label or 0), (d, i, label)))
        out.append([r[3] for r in sorted(rows, key=lambda r: r[:3])[:k]])
    return out


def _found(query, train, k, exclude_self):
    kinds = pa.int64(), pa.int32(), pa.list_(pa.float64())
    q = pa.table({"qid": pa.array([i for i, _ in query], kinds[0]), "qf": pa.array([f for _, f in query], kinds[2])})
    t = pa.table({n: pa.array([r[c] for r in train], kinds[c]) for c, n in enumerate(("id", "label", "features"))})
    at, rows, row, d = N.search(q, t, k, exclude_self)
    ids, labels, null, out = rows["id"].to_pylist(), rows["label"].to_pylist(), np.ma.getmaskarray(d), [[] for _ in query]
    for a, b, v, n in zip(at, row, d.data, null):
        out[a].append((None if n else float(v), ids[b], labels[b]))
    return out


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("exclude_self", [False, True])
def test_tile_search_equals_plain_order(odd, exclude_self):
    rng = np.random.default_rng(5)

    def vector(grid):
        # ties and copies, or lengths of many sizes far from zero
        f = rng.integers(0, 3, 3).astype(float).tolist() if grid else (rng.normal(size=3) * 10.0 ** rng.integers(0, 8) + 1e6).tolist()
        at = rng.integers(0, 20) if odd else 99
        return None if at == 0 else [None, *f[1:]] if at == 1 else f[:2] if at == 2 else [np.nan, *f[1:]] if at == 3 else [np.inf, *f[1:]] if at == 4 else f

    for trial in range(40):
        key = lambda: None if odd and rng.random() < 0.1 else int(rng.integers(0, 30))
        train = [(key(), None if odd and rng.random() < 0.1 else int(rng.integers(0, 3)), vector(trial % 2)) for _ in range(rng.integers(0, 80))]
        query = [(key(), vector(trial % 2)) for _ in range(10)] + [(i, f) for i, _, f in train[:5]]
        k = int(rng.integers(1, 6))
        assert repr(_found(query, train, k, exclude_self)) == repr(_plain(query, train, k, exclude_self))


def test_copies_do_not_multiply():
    """Of equal vectors only k rows are measured, however many there are."""
    x = np.zeros((20_000, 4))
    kept = N.first_copies(x, np.arange(len(x)), 3, True)
    assert kept.tolist() == [0, 1, 2, 3]
    assert _found([(1, [0.0] * 4)], [(i, 0, [0.0] * 4) for i in range(3000)], 3, True) == [[(0.0, 0, 0), (0.0, 2, 0), (0.0, 3, 0)]]


def test_neighbours_hold_no_block_as_one_row(spark):
    """Blocks meet query rows in tasks bounded in bytes; no row holds a block's array."""
    rows = spark.range(3000).select("id", (F.col("id") % 3).cast("int").alias("label"),
                                    F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.sin(F.col("id") * (i + 1))).alias("features"))
    nn = K.neighbours(rows, rows.where("id < 100"), 3, exclude_self=True)
    plan = nn._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "pool" not in plan
    whole = {r["qid"]: r["nn"] for r in nn.collect()}
    some = K.neighbours(rows, rows.where("id < 100"), 3, block_rows=500, exclude_self=True)
    assert whole == {r["qid"]: r["nn"] for r in some.collect()} and len(whole) == 100


def test_pruning_is_chosen_for_clusters_only(spark):
    rng = np.random.default_rng(2)
    near = rng.normal(size=(20, 8))[rng.integers(0, 20, 1000)] * 50 + rng.normal(size=(1000, 8)) * 0.1
    for x, worth in ((near, True), (rng.normal(size=(1000, 40)), False)):
        df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "id long, label int, features array<double>")
        assert worth_pruning(df, df, 3, 50, 1000, True, False) == worth
