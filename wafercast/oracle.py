"""Plain-SQL twins of the registered queries, written for DuckDB over the same
parquet tables.  They recompute everything from the base tables with
set-oriented SQL (cells as rows, windows, joins), independently of the Spark
code path, and serve as the correctness oracle."""

from __future__ import annotations

import math

from .functions.constants import (CLASS_NAMES, EXCLUDED_CLASS, ZONES)
from .sources.wafers import RAGGED, cell_sql

R6 = 6  # decimals kept for floating-point columns


def _names_case() -> str:
    names = CLASS_NAMES + [EXCLUDED_CLASS]
    return "CASE k " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " ELSE NULL END"


def _codes_case() -> str:
    return "CASE failure_type " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(CLASS_NAMES)) + " ELSE NULL END"


# raw header, raw cells, clean header, median-filtered cells, resized cells
WAFER_CTES = f"""
hdr AS (
  SELECT p_partkey AS wafer_id, CAST(4 + p_size % 29 AS INTEGER) AS h,
         CAST(4 + (p_partkey * 7) % 31 AS INTEGER) AS w, CAST(p_partkey % 10 AS INTEGER) AS k
  FROM part),
hdr_rows AS (SELECT wafer_id, h, w, k, CAST(unnest(range(h)) AS INTEGER) AS r FROM hdr),
raw_cells AS (
  SELECT wafer_id, h, w, k, r, c, CAST({cell_sql('duckdb')} AS INTEGER) AS v
  FROM (SELECT wafer_id, h, w, k, r, CAST(unnest(range(w)) AS INTEGER) AS c FROM hdr_rows)
  WHERE NOT ({RAGGED} AND r = 1 AND c = w - 1)),
row_len AS (SELECT wafer_id, r, count(*) AS len FROM raw_cells GROUP BY wafer_id, r),
ragged AS (SELECT wafer_id FROM row_len GROUP BY wafer_id HAVING count(DISTINCT len) > 1),
labelled AS (
  SELECT wafer_id, h, w, k, {_names_case()} AS failure_type,
         CASE WHEN wafer_id % 7 = 3 THEN NULL WHEN wafer_id % 5 = 0 THEN 'Test' ELSE 'Training' END AS train_test_label
  FROM hdr),
clean_hdr AS (
  SELECT wafer_id, failure_type, train_test_label, CAST({_codes_case()} AS INTEGER) AS label, h, w
  FROM labelled
  WHERE failure_type IS NOT NULL AND h > 5 AND w > 5 AND failure_type <> '{EXCLUDED_CLASS}'
    AND wafer_id NOT IN (SELECT wafer_id FROM ragged)),
clean_ids AS (SELECT wafer_id, label, h, w FROM clean_hdr),
med0 AS (
  SELECT c.wafer_id, c.h, c.w, c.r, c.c, c.v,
         coalesce(lag(c.v) OVER (PARTITION BY c.wafer_id, c.c ORDER BY c.r), c.v) AS up,
         coalesce(lag(c.v) OVER (PARTITION BY c.wafer_id, c.r ORDER BY c.c), c.v) AS lf
  FROM raw_cells c JOIN clean_ids USING (wafer_id)),
med1 AS (
  SELECT *, coalesce(lag(up) OVER (PARTITION BY wafer_id, r ORDER BY c), up) AS dg FROM med0),
med AS (
  SELECT wafer_id, h, w, r, c, list_sort([v, up, lf, dg])[3] AS v FROM med1),
idx64 AS (SELECT CAST(range AS INTEGER) AS i FROM range(64)),
ri AS (SELECT ch.wafer_id, a.i AS r, (2 * a.i * (ch.h - 1) + 63) // 126 AS sr FROM clean_ids ch CROSS JOIN idx64 a),
ci AS (SELECT ch.wafer_id, a.i AS c, (2 * a.i * (ch.w - 1) + 63) // 126 AS sc FROM clean_ids ch CROSS JOIN idx64 a),
rs AS (
  SELECT ri.wafer_id, ri.r, ci.c, m.v
  FROM ri JOIN ci ON ci.wafer_id = ri.wafer_id
  JOIN med m ON m.wafer_id = ri.wafer_id AND m.r = ri.sr AND m.c = ci.sc)
"""


def with_wafers(body: str) -> str:
    return "WITH " + WAFER_CTES.strip() + ",\n" + body


CLEAN_WAFERS = with_wafers("""
dig AS (SELECT wafer_id, md5(string_agg(CAST(v AS VARCHAR), '' ORDER BY r, c)) AS map_md5 FROM rs GROUP BY wafer_id),
q AS (SELECT * FROM clean_hdr JOIN dig USING (wafer_id))
SELECT wafer_id, failure_type, train_test_label, label, h, w, map_md5 FROM q
""")

MEDIAN_FILTER = with_wafers("""
q AS (SELECT wafer_id, r, string_agg(CAST(v AS VARCHAR), '' ORDER BY c) AS cells FROM med GROUP BY wafer_id, r)
SELECT * FROM q
""")

RESIZE_NEAREST = with_wafers("""
q AS (SELECT wafer_id, r, string_agg(CAST(v AS VARCHAR), '' ORDER BY c) AS cells FROM rs GROUP BY wafer_id, r)
SELECT * FROM q
""")


def _zone_cols() -> str:
    cols = []
    for z, r0, r1, c0, c1 in ZONES:
        size = (r1 - r0) * (c1 - c0)
        cols.append(
            f"round(100.0 * sum(CASE WHEN v = 2 AND r >= {r0} AND r < {r1} AND c >= {c0} AND c < {c1} "
            f"THEN 1 ELSE 0 END) / {size}, {R6}) AS density_{z + 1}")
    return ",\n  ".join(cols)


ZONE_DENSITY = with_wafers(f"""
q AS (SELECT wafer_id,
  {_zone_cols()}
  FROM rs GROUP BY wafer_id)
SELECT * FROM q
""")

STATS_CTE = """
cnt AS (
  SELECT wafer_id, CAST(count(*) AS DOUBLE) AS n,
         CAST(sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS n0,
         CAST(sum(CASE WHEN v = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS n1,
         CAST(sum(CASE WHEN v = 2 THEN 1 ELSE 0 END) AS DOUBLE) AS n2
  FROM rs GROUP BY wafer_id),
mom AS (
  SELECT *, (n1 + 2 * n2) / n AS mean FROM cnt),
mom2 AS (
  SELECT *,
    (n0 * pow(0 - mean, 2) + n1 * pow(1 - mean, 2) + n2 * pow(2 - mean, 2)) / n AS m2,
    (n0 * pow(0 - mean, 3) + n1 * pow(1 - mean, 3) + n2 * pow(2 - mean, 3)) / n AS m3,
    (n0 * pow(0 - mean, 4) + n1 * pow(1 - mean, 4) + n2 * pow(2 - mean, 4)) / n AS m4,
    (CASE WHEN n0 > n / 2 - 1 THEN 0 WHEN n0 + n1 > n / 2 - 1 THEN 1 ELSE 2 END
     + CASE WHEN n0 > n / 2 THEN 0 WHEN n0 + n1 > n / 2 THEN 1 ELSE 2 END) / 2.0 AS med
  FROM mom),
stats AS (
  SELECT wafer_id,
    mean AS stat_mean,
    CASE WHEN m2 = 0 THEN 0.0 ELSE sqrt(m2) END AS stat_std,
    CASE WHEN m2 = 0 THEN 0.0 ELSE m2 END AS stat_var,
    CASE WHEN m2 = 0 THEN 0.0 ELSE m3 / pow(m2, 1.5) END AS stat_skew,
    CASE WHEN m2 = 0 THEN 0.0 ELSE m4 / (m2 * m2) - 3 END AS stat_kurt,
    CAST(med AS DOUBLE) AS stat_median
  FROM mom2)
"""

WAFER_STATS = with_wafers(STATS_CTE.strip() + f""",
q AS (SELECT wafer_id, round(stat_mean, {R6}) AS stat_mean, round(stat_std, {R6}) AS stat_std,
  round(stat_var, {R6}) AS stat_var, round(stat_skew, {R6}) AS stat_skew, round(stat_kurt, {R6}) AS stat_kurt,
  round(stat_median, {R6}) AS stat_median FROM stats)
SELECT * FROM q
""")

BAD_WAFERS = with_wafers("""
q AS (SELECT wafer_id, h, w FROM hdr JOIN ragged USING (wafer_id))
SELECT * FROM q
""")


# --- regions -----------------------------------------------------------------

REGION_CTES = """
dcell AS (SELECT wafer_id, r, c FROM rs WHERE v = 2),
runs0 AS (SELECT wafer_id, r, c, c - row_number() OVER (PARTITION BY wafer_id, r ORDER BY c) AS g FROM dcell),
nodes AS (SELECT wafer_id, r, min(c) AS c0, max(c) AS c1, r * 64 + min(c) AS id FROM runs0 GROUP BY wafer_id, r, g),
edges AS (
  SELECT a.wafer_id, a.id AS src, b.id AS dst FROM nodes a JOIN nodes b
    ON a.wafer_id = b.wafer_id AND b.r = a.r + 1 AND b.c0 <= a.c1 AND a.c0 <= b.c1
  UNION ALL
  SELECT a.wafer_id, b.id AS src, a.id AS dst FROM nodes a JOIN nodes b
    ON a.wafer_id = b.wafer_id AND b.r = a.r + 1 AND b.c0 <= a.c1 AND a.c0 <= b.c1),
reach(wafer_id, src, dst) AS (
  SELECT wafer_id, id, id FROM nodes
  UNION
  SELECT e.wafer_id, x.src, e.dst FROM reach x JOIN edges e ON e.wafer_id = x.wafer_id AND e.src = x.dst),
comp AS (SELECT wafer_id, src AS id, min(dst) AS region FROM reach GROUP BY wafer_id, src),
rcell AS (
  SELECT d.wafer_id, cp.region, d.r, d.c
  FROM dcell d JOIN nodes n ON n.wafer_id = d.wafer_id AND n.r = d.r AND d.c BETWEEN n.c0 AND n.c1
  JOIN comp cp ON cp.wafer_id = n.wafer_id AND cp.id = n.id),
reg AS (SELECT wafer_id, region, count(*) AS area FROM rcell GROUP BY wafer_id, region),
best AS (
  SELECT wafer_id, region, area FROM (
    SELECT *, row_number() OVER (PARTITION BY wafer_id ORDER BY area DESC, region) AS rn FROM reg) WHERE rn = 1),
lc AS (SELECT c.wafer_id, c.r, c.c FROM rcell c JOIN best b ON b.wafer_id = c.wafer_id AND b.region = c.region)
"""


def with_regions(body: str) -> str:
    return "WITH RECURSIVE " + WAFER_CTES.strip() + ",\n" + REGION_CTES.strip() + ",\n" + body


REGIONS = with_regions("""
q AS (SELECT wafer_id, area, CAST(region // 64 AS INTEGER) AS first_r, CAST(region % 64 AS INTEGER) AS first_c FROM reg)
SELECT * FROM q
""")

REGION_SUMMARY = with_regions("""
cntr AS (SELECT wafer_id, count(*) AS n FROM reg GROUP BY wafer_id),
q AS (
  SELECT ci.wafer_id, CAST(coalesce(cntr.n, 0) AS INTEGER) AS num_regions,
         CAST(coalesce(b.area, 0) AS BIGINT) AS largest_area,
         CAST(coalesce(b.region // 64, -1) AS INTEGER) AS largest_r,
         CAST(coalesce(b.region % 64, -1) AS INTEGER) AS largest_c
  FROM clean_ids ci LEFT JOIN cntr USING (wafer_id) LEFT JOIN best b USING (wafer_id))
SELECT * FROM q
""")

PERIMETER_CTES = """
off4 AS (SELECT * FROM (VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) t(dr, dc)),
off8 AS (SELECT * FROM (VALUES (-1, 0, 2), (1, 0, 2), (0, -1, 2), (0, 1, 2),
                               (-1, -1, 10), (-1, 1, 10), (1, -1, 10), (1, 1, 10)) t(dr, dc, wt)),
n4 AS (
  SELECT a.wafer_id, a.r, a.c, count(b.r) AS k
  FROM lc a CROSS JOIN off4 o
  LEFT JOIN lc b ON b.wafer_id = a.wafer_id AND b.r = a.r + o.dr AND b.c = a.c + o.dc
  GROUP BY a.wafer_id, a.r, a.c),
bd AS (SELECT wafer_id, r, c FROM n4 WHERE k < 4),
codes AS (
  SELECT a.wafer_id, a.r, a.c, 1 + coalesce(sum(CASE WHEN b.r IS NOT NULL THEN o.wt ELSE 0 END), 0) AS code
  FROM bd a CROSS JOIN off8 o
  LEFT JOIN bd b ON b.wafer_id = a.wafer_id AND b.r = a.r + o.dr AND b.c = a.c + o.dc
  GROUP BY a.wafer_id, a.r, a.c),
per AS (
  SELECT wafer_id,
    sum(CASE WHEN code IN (5, 7, 15, 17, 25, 27) THEN 1 ELSE 0 END) AS n_one,
    sum(CASE WHEN code IN (21, 33) THEN 1 ELSE 0 END) AS n_sqrt2,
    sum(CASE WHEN code IN (13, 23) THEN 1 ELSE 0 END) AS n_half
  FROM codes GROUP BY wafer_id),
perim AS (
  SELECT ci.wafer_id,
    coalesce(CAST(n_one AS DOUBLE) + CAST(n_sqrt2 AS DOUBLE) * sqrt(2.0) + CAST(n_half AS DOUBLE) * ((1.0 + sqrt(2.0)) / 2.0), 0.0) AS geom_perimeter
  FROM clean_ids ci LEFT JOIN per USING (wafer_id))
"""

REGION_PERIMETER = with_regions(PERIMETER_CTES.strip() + f""",
q AS (SELECT wafer_id, round(geom_perimeter, {R6}) AS geom_perimeter FROM perim)
SELECT * FROM q
""")

AXES_CTES = """
amom AS (
  SELECT wafer_id, CAST(count(*) AS DOUBLE) AS a, CAST(sum(r) AS BIGINT) AS sr, CAST(sum(c) AS BIGINT) AS sc,
         CAST(sum(r * r) AS BIGINT) AS srr, CAST(sum(c * c) AS BIGINT) AS scc, CAST(sum(r * c) AS BIGINT) AS src
  FROM lc GROUP BY wafer_id),
amom1 AS (SELECT wafer_id, a, srr, scc, src, sr / a AS mr, sc / a AS mc FROM amom),
amom2 AS (SELECT wafer_id, srr / a - mr * mr AS vrr, scc / a - mc * mc AS vcc, src / a - mr * mc AS vrc FROM amom1),
amom3 AS (SELECT wafer_id, (vrr + vcc) / 2 AS half, sqrt(((vrr - vcc) / 2) * ((vrr - vcc) / 2) + vrc * vrc) AS rad FROM amom2),
eig AS (SELECT wafer_id, greatest(half + rad, 0.0) AS l1, greatest(half - rad, 0.0) AS l2 FROM amom3),
axes AS (
  SELECT ci.wafer_id,
    coalesce(4 * sqrt(l1), 0.0) AS geom_major_axis,
    coalesce(4 * sqrt(l2), 0.0) AS geom_minor_axis,
    CASE WHEN l1 > 0 THEN sqrt(1 - l2 / l1) ELSE 0.0 END AS geom_eccentricity
  FROM clean_ids ci LEFT JOIN eig USING (wafer_id))
"""

REGION_AXES = with_regions(AXES_CTES.strip() + f""",
q AS (SELECT wafer_id, round(geom_major_axis, {R6}) AS geom_major_axis, round(geom_minor_axis, {R6}) AS geom_minor_axis,
  round(geom_eccentricity, {R6}) AS geom_eccentricity FROM axes)
SELECT * FROM q
""")

# hull pixels: every integer row Y of the hull of the pixel-edge midpoints
# spans [L(Y), R(Y)], with R(Y) the largest interpolation over point pairs
# straddling Y (coordinates doubled and shifted by +2 to stay integer > 0)
SOLIDITY_CTES = """
ext AS (SELECT wafer_id, r, min(c) AS lo, max(c) AS hi FROM lc GROUP BY wafer_id, r),
pts AS (
  SELECT wafer_id, 2 * r - 1 AS y, 2 * hi + 2 AS xr, 2 * lo + 2 AS xl FROM ext
  UNION ALL SELECT wafer_id, 2 * r + 1, 2 * hi + 2, 2 * lo + 2 FROM ext
  UNION ALL SELECT wafer_id, 2 * r, 2 * hi + 3, 2 * lo + 1 FROM ext),
lvl AS (SELECT wafer_id, y, max(xr) AS xr, min(xl) AS xl FROM pts GROUP BY wafer_id, y),
yrows AS (SELECT wafer_id, 2 * r AS yy FROM ext),
allrows AS (
  SELECT e.wafer_id, CAST(2 * i.i AS BIGINT) AS yy FROM (SELECT wafer_id, min(r) AS r0, max(r) AS r1 FROM ext GROUP BY wafer_id) e
  JOIN idx64 i ON i.i BETWEEN e.r0 AND e.r1),
pairs AS (
  SELECT p.wafer_id, p.y AS y1, q.y AS y2, p.xr AS r1, q.xr AS r2, p.xl AS l1, q.xl AS l2
  FROM lvl p JOIN lvl q ON q.wafer_id = p.wafer_id AND q.y >= p.y),
spans AS (
  SELECT a.wafer_id, a.yy,
    max(CASE WHEN s.y1 = s.y2 THEN s.r1 // 2
             ELSE (s.r1 * (s.y2 - s.y1) + (s.r2 - s.r1) * (a.yy - s.y1)) // (2 * (s.y2 - s.y1)) END) AS jhi,
    min(CASE WHEN s.y1 = s.y2 THEN (s.l1 + 1) // 2
             ELSE (s.l1 * (s.y2 - s.y1) + (s.l2 - s.l1) * (a.yy - s.y1) + 2 * (s.y2 - s.y1) - 1) // (2 * (s.y2 - s.y1)) END) AS jlo
  FROM allrows a JOIN pairs s ON s.wafer_id = a.wafer_id AND s.y1 <= a.yy AND a.yy <= s.y2
  GROUP BY a.wafer_id, a.yy),
hull AS (SELECT wafer_id, sum(CASE WHEN jhi >= jlo THEN jhi - jlo + 1 ELSE 0 END) AS hull_area FROM spans GROUP BY wafer_id),
solid AS (
  SELECT ci.wafer_id, CAST(coalesce(h.hull_area, 0) AS BIGINT) AS hull_area,
         CASE WHEN h.hull_area > 0 THEN CAST(b.area AS DOUBLE) / h.hull_area ELSE 0.0 END AS geom_solidity
  FROM clean_ids ci LEFT JOIN hull h USING (wafer_id) LEFT JOIN best b USING (wafer_id))
"""

REGION_SOLIDITY = with_regions(SOLIDITY_CTES.strip() + f""",
q AS (SELECT wafer_id, hull_area, round(geom_solidity, {R6}) AS geom_solidity FROM solid)
SELECT * FROM q
""")


# --- Radon -------------------------------------------------------------------

def _radon_ctes(bins: list[int] | None) -> str:
    where = "" if bins is None else "WHERE xs.i IN (" + ", ".join(str(b) for b in bins) + ")"
    return f"""
idx91 AS (SELECT CAST(range AS INTEGER) AS i FROM range(91)),
ang AS (SELECT CAST(range AS INTEGER) AS t FROM range(72)),
grid AS (
  SELECT a.t, xs.i AS x, ys.i AS y, cos(a.t * 2.5 * (pi() / 180.0)) AS ca, sin(a.t * 2.5 * (pi() / 180.0)) AS sa
  FROM ang a CROSS JOIN idx91 xs CROSS JOIN idx91 ys {where}),
src AS (SELECT t, x, ca * x + sa * y - 45.0 * (ca + sa - 1.0) AS sc, -sa * x + ca * y - 45.0 * (ca - sa - 1.0) AS sr FROM grid),
fl AS (SELECT t, x, CAST(floor(sr) AS INTEGER) AS r0, CAST(floor(sc) AS INTEGER) AS c0,
              sr - floor(sr) AS dr, sc - floor(sc) AS dc FROM src),
corner AS (
  SELECT t, x, r0 AS pr, c0 AS pc, (1 - dr) * (1 - dc) AS w FROM fl
  UNION ALL SELECT t, x, r0, c0 + 1, (1 - dr) * dc FROM fl
  UNION ALL SELECT t, x, r0 + 1, c0, dr * (1 - dc) FROM fl
  UNION ALL SELECT t, x, r0 + 1, c0 + 1, dr * dc FROM fl),
proj AS (
  SELECT t AS theta_idx, x AS bin, pr - 13 AS r, pc - 13 AS c, sum(w) AS wt FROM corner
  WHERE pr - 13 BETWEEN 0 AND 63 AND pc - 13 BETWEEN 0 AND 63 AND w > 0
  GROUP BY t, x, pr, pc HAVING sum(w) > 1e-9),
dfc AS (SELECT wafer_id, r, c FROM rs WHERE v = 2),
sino AS (
  SELECT d.wafer_id, p.theta_idx, p.bin, 2.0 * sum(p.wt) AS s
  FROM dfc d JOIN proj p ON p.r = d.r AND p.c = d.c GROUP BY d.wafer_id, p.theta_idx, p.bin),
prof0 AS (SELECT wafer_id, bin, sum(s) / 72.0 AS mean, sum(s * s) / 72.0 AS m2 FROM sino GROUP BY wafer_id, bin),
prof AS (SELECT wafer_id, bin, mean, sqrt(greatest(m2 - mean * mean, 0.0)) AS std FROM prof0)
"""


def _samples() -> list[tuple[int, int, float]]:
    """(k, left bin, weight of the right bin) of the 20 evenly spaced profile
    positions over 91 bins: a position interpolates from the bin below it."""
    out = []
    for k in range(20):
        left = max(0, math.ceil(k * 90 / 19) - 1)
        out.append((k, left, k * 90 / 19 - left))
    return out


_BINS = sorted({b for _, lo, _ in _samples() for b in (lo, lo + 1)})

RADON_SINOGRAM = with_wafers(_radon_ctes(None).strip() + f""",
q AS (SELECT wafer_id, theta_idx, bin, round(s, {R6}) AS s FROM sino)
SELECT * FROM q
""")


def _radon_profile_sql() -> str:
    cols = []
    for stat, prefix in (("mean", "radon_mean_"), ("std", "radon_std_")):
        for k, lo, part in _samples():
            y_lo = f"sum(CASE WHEN bin = {lo} THEN {stat} ELSE 0.0 END)"
            y_hi = f"sum(CASE WHEN bin = {lo + 1} THEN {stat} ELSE 0.0 END)"
            cols.append(f"({y_hi} - {y_lo}) * {repr(part)} + {y_lo} AS {prefix}{k + 1}")
    names = [f"radon_mean_{i}" for i in range(1, 21)] + [f"radon_std_{i}" for i in range(1, 21)]
    outer = ", ".join(f"round(coalesce(f.{n}, 0.0), {R6}) AS {n}" for n in names)
    return with_wafers(_radon_ctes(_BINS).strip() + f""",
feats AS (SELECT wafer_id, {", ".join(cols)} FROM prof GROUP BY wafer_id),
q AS (SELECT ci.wafer_id, {outer} FROM clean_ids ci LEFT JOIN feats f USING (wafer_id))
SELECT * FROM q
""")


RADON_PROFILE = _radon_profile_sql()


# --- all 66 features ----------------------------------------------------------

def _wafer_features_sql() -> str:
    from .functions.constants import FEATURE_NAMES
    rcols = []
    for stat, prefix in (("mean", "radon_mean_"), ("std", "radon_std_")):
        for k, lo, part in _samples():
            y_lo = f"sum(CASE WHEN bin = {lo} THEN {stat} ELSE 0.0 END)"
            y_hi = f"sum(CASE WHEN bin = {lo + 1} THEN {stat} ELSE 0.0 END)"
            rcols.append(f"({y_hi} - {y_lo}) * {repr(part)} + {y_lo} AS {prefix}{k + 1}")
    dens = _zone_cols().replace(f", {R6}) AS", ", 12) AS")
    sel = []
    for n in FEATURE_NAMES:
        src = f"coalesce(rf.{n}, 0.0)" if n.startswith("radon") else n
        sel.append(f"round({src}, {R6}) AS {n}")
    body = (STATS_CTE.strip() + ",\n" + REGION_CTES.strip() + ",\n" + PERIMETER_CTES.strip() + ",\n"
            + AXES_CTES.strip() + ",\n" + SOLIDITY_CTES.strip() + ",\n" + _radon_ctes(_BINS).strip() + f""",
dz AS (SELECT wafer_id, {dens} FROM rs GROUP BY wafer_id),
rf AS (SELECT wafer_id, {", ".join(rcols)} FROM prof GROUP BY wafer_id),
geo AS (
  SELECT ci.wafer_id, CAST(coalesce(b.area, 0) AS DOUBLE) AS geom_area, p.geom_perimeter, a.geom_major_axis,
         a.geom_minor_axis, a.geom_eccentricity, s.geom_solidity,
         CAST(coalesce(nr.n, 0) AS DOUBLE) AS geom_num_regions
  FROM clean_ids ci LEFT JOIN best b USING (wafer_id) JOIN perim p USING (wafer_id) JOIN axes a USING (wafer_id)
  JOIN solid s USING (wafer_id) LEFT JOIN (SELECT wafer_id, count(*) AS n FROM reg GROUP BY wafer_id) nr USING (wafer_id)),
q AS (
  SELECT ci.wafer_id, {", ".join(sel)}, ci.label AS target
  FROM clean_ids ci JOIN dz USING (wafer_id) LEFT JOIN rf USING (wafer_id) JOIN geo USING (wafer_id)
  JOIN stats USING (wafer_id))
SELECT * FROM q
""")
    return "WITH RECURSIVE " + WAFER_CTES.strip() + ",\n" + body


WAFER_FEATURES = _wafer_features_sql()
