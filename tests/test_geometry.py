"""Library conventions pinned on hand-drawn 64x64 maps: 4-connectivity,
raster-first tie break, perimeter codes, hull inclusiveness, median filter,
resize and the statistics of a flat map."""

import math

import numpy as np
import pytest

from wafercast.operators import regions as G
from wafercast.operators.clean import median2x2_expr, resize_expr
from wafercast.operators.stats import wafer_stats


def _df(spark, maps):
    rows = [(i, [[int(v) for v in row] for row in m]) for i, m in enumerate(maps)]
    return spark.createDataFrame(rows, "wafer_id long, map array<array<tinyint>>")


def blank():
    m = np.ones((64, 64), dtype=int)
    return m


def geo(spark, m):
    return G.geometry(_df(spark, [m])).collect()[0].asDict()


def test_no_defect_gives_zeros(spark):
    g = geo(spark, blank())
    assert all(v == 0 for k, v in g.items() if k != "wafer_id")


def test_single_pixel(spark):
    m = blank()
    m[10, 20] = 2
    g = geo(spark, m)
    assert g["geom_area"] == 1 and g["geom_num_regions"] == 1
    assert g["geom_perimeter"] == 0.0          # isolated cell: code 1, weight 0
    assert g["geom_solidity"] == 1.0


def test_square_block(spark):
    m = blank()
    m[5:8, 5:8] = 2
    g = geo(spark, m)
    assert g["geom_area"] == 9
    assert g["geom_perimeter"] == pytest.approx(8.0)
    assert g["geom_solidity"] == pytest.approx(1.0)
    assert g["geom_eccentricity"] == pytest.approx(0.0)
    # covariance of a 3x3 block: var = 2/3 on both axes -> axis 4 sqrt(2/3)
    assert g["geom_major_axis"] == pytest.approx(4 * math.sqrt(2 / 3))


def test_horizontal_line(spark):
    m = blank()
    m[30, 10:20] = 2
    g = geo(spark, m)
    assert g["geom_area"] == 10 and g["geom_minor_axis"] == 0.0 and g["geom_eccentricity"] == 1.0


def test_diagonal_touch_is_two_regions(spark):
    m = blank()
    m[10, 10] = 2
    m[11, 11] = 2
    assert geo(spark, m)["geom_num_regions"] == 2


def test_u_shape_is_one_region_with_hull(spark):
    m = blank()
    m[10:20, 10] = 2
    m[10:20, 14] = 2
    m[19, 10:15] = 2
    g = geo(spark, m)
    assert g["geom_num_regions"] == 1
    assert g["geom_area"] == 23
    assert 0 < g["geom_solidity"] < 1


def test_equal_blobs_raster_first_wins(spark):
    m = blank()
    m[40:42, 40:42] = 2     # later in raster order
    m[5:7, 50:52] = 2       # first in raster order
    df = G.largest_region(G.label_regions(_df(spark, [m])))
    r = df.selectExpr("runs[best.label].r AS r", "runs[best.label].c0 AS c").collect()[0]
    assert (r["r"], r["c"]) == (5, 50)


def test_ring_region(spark):
    m = blank()
    yy, xx = np.mgrid[0:64, 0:64]
    d = (yy - 32) ** 2 + (xx - 32) ** 2
    m[(d >= 100) & (d <= 144)] = 2
    g = geo(spark, m)
    assert g["geom_num_regions"] == 1
    assert g["geom_solidity"] < 0.5


def plain_hull(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> int:
    """Grid points inside or on the convex hull of the edge midpoints
    (r +- 1/2, c), (r, c +- 1/2) of a region given by its row extents.
    Exact: coordinates doubled to integers, monotone-chain hull, rational
    row intersections."""
    if len(rows) == 0:
        return 0
    pts = set()
    for r, a, b in zip(rows.tolist(), lo.tolist(), hi.tolist()):
        y = 2 * r
        for x in (2 * a, 2 * b):
            pts.add((x, y - 1))
            pts.add((x, y + 1))
        pts.add((2 * a - 1, y))
        pts.add((2 * b + 1, y))
    p = sorted(pts)

    def cross(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    lower, upper = [], []
    for q in p:
        while len(lower) >= 2 and cross(lower[-2], lower[-1], q) <= 0:
            lower.pop()
        lower.append(q)
    for q in reversed(p):
        while len(upper) >= 2 and cross(upper[-2], upper[-1], q) <= 0:
            upper.pop()
        upper.append(q)
    hull = lower[:-1] + upper[:-1]
    ys = [q[1] for q in hull]
    total = 0
    for Y in range(min(ys) + (min(ys) % 2), max(ys) + 1, 2):    # even Y = integer rows
        lo_num, lo_den, hi_num, hi_den = None, 1, None, 1
        k = len(hull)
        for i in range(k):
            (x1, y1), (x2, y2) = hull[i], hull[(i + 1) % k]
            if y1 == y2:
                if y1 == Y:
                    cand = [(min(x1, x2), 1), (max(x1, x2), 1)]
                else:
                    continue
            else:
                if not (min(y1, y2) <= Y <= max(y1, y2)):
                    continue
                if y1 > y2:
                    x1, y1, x2, y2 = x2, y2, x1, y1
                num = x1 * (y2 - y1) + (x2 - x1) * (Y - y1)
                cand = [(num, y2 - y1)]
            for num, den in cand:
                if lo_num is None or num * lo_den < lo_num * den:
                    lo_num, lo_den = num, den
                if hi_num is None or num * hi_den > hi_num * den:
                    hi_num, hi_den = num, den
        if lo_num is None:
            continue
        # integer columns j with lo <= 2j <= hi
        j_lo = -((-lo_num) // (2 * lo_den))
        j_hi = hi_num // (2 * hi_den)
        if j_hi >= j_lo:
            total += j_hi - j_lo + 1
    return total


def test_hull_helper_exact():
    # one cell: the diamond of its edge midpoints covers exactly that cell
    assert plain_hull(np.array([0]), np.array([0]), np.array([0])) == 1
    # a 2 x 3 block
    assert plain_hull(np.array([0, 1]), np.array([0, 0]), np.array([2, 2])) == 6
    # an L: rows 0..2 at col 0, row 2 cols 0..2 -> the hull adds the diagonal cell (1, 1)
    assert plain_hull(np.array([0, 1, 2]), np.array([0, 0, 0]), np.array([0, 0, 2])) == 6


def test_native_hull_equals_plain_hull(spark):
    rng = np.random.default_rng(4)
    ext = [[(0, 0, 0)], [(63, 63, 63)], [(r, 0, 63) for r in range(64)], [(r, r, r) for r in range(64)],
           [(r, 63 - r, 63) for r in range(64)], [(5, 0, 1), (6, 1, 63), (7, 63, 63)]]
    for _ in range(300):        # row extents of connected regions: neighbours overlap
        r0, n = int(rng.integers(0, 60)), int(rng.integers(1, 64))
        lo = int(rng.integers(0, 64))
        hi = int(rng.integers(lo, 64))
        rows = []
        for r in range(r0, min(64, r0 + n)):
            rows.append((r, lo, hi))
            at = int(rng.integers(lo, hi + 1))
            lo, hi = int(rng.integers(0, at + 1)), int(rng.integers(at, 64))
        ext.append(rows)
    df = spark.createDataFrame([(i, e) for i, e in enumerate(ext)], "id int, ext array<struct<r: int, lo: int, hi: int>>")
    got = {r.id: r.n for r in df.selectExpr("id", f"{G.HULL_PIXELS} as n").collect()}
    for i, e in enumerate(ext):
        assert got[i] == plain_hull(*map(np.array, zip(*e))), e


def test_no_python_worker_in_geometry(spark):
    plan = G.geometry(_df(spark, [blank()]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

def test_median_filter_upper_median_and_reflect(spark):
    m = [[2, 0], [0, 0]]
    df = spark.createDataFrame([(0, m)], "wafer_id long, waferMap array<array<tinyint>>")
    out = df.select(median2x2_expr("waferMap").alias("m")).collect()[0]["m"]
    # cell (0,0): window {m00, m00, m00, m00} (index -1 reflects to 0) -> 2
    assert out[0][0] == 2
    # cell (1,1): {0, 0, 0, 2} -> third smallest = 0
    assert out[1][1] == 0
    # cell (0,1): {m01, m00, m01, m00} = {0, 2, 0, 2} -> third smallest = 2
    assert out[0][1] == 2


def test_resize_nearest_corners(spark):
    m = [[r * 10 + c for c in range(7)] for r in range(6)]
    df = spark.createDataFrame([(0, 6, 7, m)], "wafer_id long, h int, w int, waferMap array<array<int>>")
    out = df.select(resize_expr("waferMap").alias("m")).collect()[0]["m"]
    assert len(out) == 64 and all(len(r) == 64 for r in out)
    assert out[0][0] == 0 and out[63][63] == 56 and out[63][0] == 50


def test_flat_map_statistics(spark):
    df = _df(spark, [blank()])
    s = wafer_stats(df).collect()[0]
    assert s["stat_mean"] == 1.0 and s["stat_std"] == 0.0 and s["stat_skew"] == 0.0 and s["stat_median"] == 1.0
