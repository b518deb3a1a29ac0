"""Regions by whole rows: runs, bitwise perimeter counts and hull corners against plain versions."""

import numpy as np
from pyspark.sql import functions as F

from wafercast.functions.constants import PERIMETER_WEIGHT_HALF, PERIMETER_WEIGHT_ONE, PERIMETER_WEIGHT_SQRT2
from wafercast.operators import regions as G


def _maps(n: int) -> list[np.ndarray]:
    rng = np.random.default_rng(11)
    return [np.where(rng.random((64, 64)) < p, 2, 1) for p in np.linspace(0.02, 1.0, n)]


def _df(spark, maps):
    return spark.createDataFrame([(i, [[int(v) for v in row] for row in m]) for i, m in enumerate(maps)],
                                 "wafer_id long, map array<array<tinyint>>")


def _plain_weights(mask: np.ndarray) -> tuple[int, int, int]:
    """Border cells of weight 1, sqrt 2 and (1 + sqrt 2) / 2 by the code of their eight neighbours."""
    def around(m, shifts):
        p = np.pad(m.astype(int), 1)
        return [p[1 + i:65 + i, 1 + j:65 + j] for i, j in shifts]

    beside, across = ((-1, 0), (1, 0), (0, -1), (0, 1)), ((-1, -1), (-1, 1), (1, -1), (1, 1))
    border = mask & ~np.logical_and.reduce(around(mask, beside))
    code = 1 + 2 * sum(around(border, beside)) + 10 * sum(around(border, across))
    return tuple(int(np.isin(code[border], w).sum()) for w in (PERIMETER_WEIGHT_ONE, PERIMETER_WEIGHT_SQRT2, PERIMETER_WEIGHT_HALF))


def test_perimeter_counts_are_those_of_the_cells(spark):
    maps = _maps(24)
    rows = G.largest_region(G.label_regions(_df(spark, maps))).select(
        "wafer_id", "bruns", *[F.expr(f"aggregate(weights, 0, (n, x) -> n + x.{c})").alias(c) for c in ("one", "sqrt2", "half")]).collect()
    for r in rows:
        mask = np.zeros((64, 64), bool)
        for run in r.bruns:
            mask[run.r, run.c0:run.c1 + 1] = True
        assert (r.one, r.sqrt2, r.half) == _plain_weights(mask)


def test_runs_and_row_starts(spark):
    maps = _maps(6)
    maps[0][3] = 2
    for r in G.label_regions(_df(spark, maps)).select("wafer_id", "runs", "rstart").collect():
        m = np.pad(maps[r.wafer_id] == 2, ((0, 0), (1, 1))).astype(int)
        starts, ends = np.argwhere(np.diff(m, axis=1) == 1), np.argwhere(np.diff(m, axis=1) == -1)
        assert [(x.r, x.c0, x.c1) for x in r.runs] == [(a, b, e - 1) for (a, b), (_, e) in zip(starts.tolist(), ends.tolist())]
        assert r.rstart == [int((starts[:, 0] < i).sum()) for i in range(65)]


def test_null_cells_are_no_defects(spark):
    df = spark.createDataFrame([(0, [[2, None, 2, 2], [None, 1, 2, None]])], "wafer_id long, map array<array<tinyint>>")
    row = G.label_regions(df).select("runs").first()
    assert [(x.r, x.c0, x.c1) for x in row.runs] == [(0, 0, 0), (0, 2, 3), (1, 2, 2)]


def test_points_on_a_straight_side_are_no_corners(spark):
    df = spark.createDataFrame([([(r, 5, 63) for r in range(64)],)], "ext array<struct<r: int, lo: int, hi: int>>")
    points = G._let({"e": "ext"}, G._corners("lo", ""))
    assert [(p.y, p.x) for p in df.select(F.expr(points).alias("p")).first().p] == [(0, 10), (1, 9), (127, 9), (128, 10)]


def test_derived_maps_choose_their_pattern_once(spark):
    """The class chooses among maps, not among patterns at every cell; the cells are those of the one expression."""
    from wafercast.sources.wafers import cell_sql, raw_wafers_from_part

    part = spark.createDataFrame([(k, 3 * k % 50) for k in range(1, 45)], "p_partkey long, p_size int")
    raw = raw_wafers_from_part(part)
    plan = raw.select("waferMap")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN (k#") < plan.index("transform(")
    cells = raw.selectExpr("wafer_id", "h", "w", "cast(wafer_id % 10 as int) as k", "posexplode(waferMap) as (r, row)").selectExpr(
        "*", "posexplode(row) as (c, v)")
    assert cells.where(f"v <> {cell_sql('spark')}").count() == 0
    assert cells.count() == sum(r.h * r.w - (r.wafer_id % 37 == 5) for r in raw.select("h", "w", "wafer_id").collect())


def test_resize_of_tall_and_low_maps(spark):
    from wafercast.operators.clean import resize_expr

    maps = [[[(a * 7 + b) % 3 for b in range(20)] for a in range(h)] for h in (9, 64, 100)]
    df = spark.createDataFrame([(i, len(m), 20, m) for i, m in enumerate(maps)], "i int, h int, w int, waferMap array<array<tinyint>>")
    for r in df.select("i", "h", resize_expr().alias("m")).collect():
        at = [(2 * i * (r.h - 1) + 63) // 126 for i in range(64)]
        assert r.m == [[maps[r.i][a][(2 * j * 19 + 63) // 126] for j in range(64)] for a in at]
