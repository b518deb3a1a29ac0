"""Operator 11 against plain NumPy and against products of Python integers."""

import numpy as np
import pytest

from wafercast.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, id string, x string, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash", "clash") for i, v in rows], SCHEMA).repartition(3)


def whitened(spark, rows):
    return W.whiten(W.integer_vectors(table(spark, rows))).toPandas()


def brute(vectors):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = (n * fit - s) / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ vecs / np.sqrt(values), values / values.sum()


def test_matches_numpy_with_bad_and_repeated_rows(spark):
    rng = np.random.default_rng(7)
    vecs = (rng.normal(size=(300, 20)) * np.linspace(0.3, 3, 20)).astype(np.float32).tolist()
    rows = list(enumerate(vecs)) + [(1000 + i, vecs[0]) for i in range(40)]
    bad = [(-1, None), (-2, [None] + vecs[0][1:]), (-3, [float("nan")] + vecs[0][1:]), (-4, [float("inf")] + vecs[0][1:]),
           (-5, []), (-6, [1.0, 2.0])]
    got = whitened(spark, rows + bad)
    n, dev, z, share = brute([v for _, v in rows])
    assert set(got.vec_id if "vec_id" in got else got.id) == {i for i, _ in rows}
    assert len(got) == len(rows) * 16 and set(got.n) == {n}
    wide = got.pivot(index="id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    assert np.allclose(np.abs(wide), np.abs(z[:, :16]), atol=1e-8)
    by = got.drop_duplicates("id").set_index("id").deviation
    assert by.loc[[i for i, _ in rows]].tolist() == dev.tolist()
    assert np.allclose(got[got.id == 0].sort_values("component").explained, share[:16])
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


@pytest.mark.parametrize("top", [3, 1000, 1 << 40, (1 << 58) - 1])
def test_scatter_is_exact(spark, top):
    rng = np.random.default_rng(top % 97)
    x = [[int(rng.integers(-top, top, endpoint=True)) for _ in range(5)] + [17] for _ in range(150)]
    fit = spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(4)
    lo, hi, n = W.lows_and_highs(fit, 6)
    assert (lo, hi, n) == ([min(c) for c in zip(*x)], [max(c) for c in zip(*x)], 150)
    total, products = W.scatter(fit, lo, hi)
    y = [[a - b for a, b in zip(v, lo)] for v in x]
    assert total == [sum(c) for c in zip(*y)]
    assert all(s == sum(v[i] * v[j] for v in y) for (i, j), s in products.items()) and len(products) == 21


def test_large_entries_and_constant_dimensions(spark):
    rows = [(i, [1e30 if i % 2 else -1e30, float(i), 5.0]) for i in range(8)]
    got = whitened(spark, rows)
    assert got.deviation.isna().all() and got.component.max() == 1     # the long overflows, the small dimension is rounding
    rows = [(i, [float(i % 3), float(i % 3), 5.0]) for i in range(9)]
    got = whitened(spark, rows)
    assert got.component.max() == 1 and set(got.n) == {3} and got.identity_error[0] < 1e-9
    assert whitened(spark, [(1, [1.0, 2.0])] * 5).empty
    assert whitened(spark, [(1, None)]).empty and whitened(spark, []).empty


def test_ties_in_length_go_to_the_longer(spark):
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0, 2.0, 3.0]), (4, [3.0, 1.0, 2.0]), (None, [2.0, 2.0, 5.0])]
    got = whitened(spark, rows)
    assert set(got.n) == {3} and got.id.isna().any()
