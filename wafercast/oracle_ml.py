"""DuckDB twins of the stage 3-5 queries (feature matrix = ``embeddings``).
Plain window-function SQL: a global ``row_number`` per class stands in for
the Spark side's skew-safe two-level rank; kNN is a pairwise self-join."""

from __future__ import annotations

from .plans.ml_queries import KNN_K

R6 = 6
TWO52 = "4503599627370496.0"


def _u(tag: str, *parts: str) -> str:
    cat = ", ".join(["'42'", f"'{tag}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {cat})), 1, 13)) AS BIGINT) / {TWO52})"


def _dist(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])), "
            f"lambda s, v: s + v)")


BASE = f"""
fm AS (SELECT vec_id AS id, CAST(label AS INTEGER) AS label,
              list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS features FROM embeddings),
cnt AS (SELECT label, count(*) AS n FROM fm GROUP BY label),
tot AS (SELECT CAST(sum(n) AS BIGINT) AS n_all FROM cnt),
q0 AS (SELECT c.label, c.n, t.n_all, t.n_all - CAST(ceil(t.n_all * 0.2) AS BIGINT) AS n_train_all
       FROM cnt c CROSS JOIN tot t),
q1 AS (SELECT *, (n * n_train_all) // n_all AS fl, (n * n_train_all) % n_all AS rem FROM q0),
q2 AS (SELECT *, n_train_all - sum(fl) OVER () AS need, row_number() OVER (ORDER BY rem DESC, label) AS pos FROM q1),
quota AS (SELECT label, n, CAST(fl + CASE WHEN pos <= need AND rem > 0 THEN 1 ELSE 0 END AS BIGINT) AS n_train FROM q2),
rk AS (SELECT f.*, row_number() OVER (PARTITION BY f.label ORDER BY md5(concat('42|', CAST(f.id AS VARCHAR))), f.id) AS rk
       FROM fm f),
sp AS (
  SELECT r.id, r.label, r.features, q.n_train,
         CASE WHEN r.rk <= q.n - q.n_train THEN 'test' ELSE 'train' END AS split,
         CAST(CASE WHEN r.rk > q.n - q.n_train THEN r.rk - (q.n - q.n_train) END AS INTEGER) AS trk
  FROM rk r JOIN quota q USING (label)),
lng AS (
  SELECT id, label, split, CAST(unnest(range(len(features))) AS INTEGER) AS feature_idx, unnest(features) AS x FROM sp),
params AS (
  SELECT feature_idx, avg(x) AS mean,
         CASE WHEN var_pop(x) = 0 THEN 1.0 ELSE sqrt(var_pop(x)) END AS std
  FROM lng WHERE split = 'train' GROUP BY feature_idx),
parr AS (SELECT list(mean ORDER BY feature_idx) AS means, list(std ORDER BY feature_idx) AS stds FROM params),
scaled AS (
  SELECT s.id, s.label, s.split, s.n_train, s.trk,
         list_transform(range(len(s.features)), lambda i: (s.features[i + 1] - p.means[i + 1]) / p.stds[i + 1]) AS features
  FROM sp s CROSS JOIN parr p),
tgt AS (SELECT n_train AS target FROM (SELECT n_train, row_number() OVER (ORDER BY n_train) AS k, count(*) OVER () AS c
        FROM quota WHERE n_train > 0) WHERE k = (c + 1) // 2),
small AS (SELECT * FROM scaled WHERE split = 'train' AND n_train < (SELECT target FROM tgt)),
prs AS (
  SELECT a.id, a.label, a.trk, b.id AS oid, {_dist('b.features', 'a.features')} AS d
  FROM small a JOIN small b ON a.label = b.label AND a.id <> b.id),
nnr AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, oid) AS nr FROM prs),
plan0 AS (SELECT label, n_train, unnest(range((SELECT target FROM tgt) - n_train)) AS j FROM (SELECT DISTINCT label, n_train FROM small)),
plan AS (
  SELECT label, n_train, j,
         CAST(floor({_u('base', 'label', 'j')} * n_train) + 1 AS INTEGER) AS base_trk,
         CAST(floor({_u('nn', 'label', 'j')} * 3) AS INTEGER) AS pick,
         {_u('gap', 'label', 'j')} AS gap
  FROM plan0),
syn AS (
  SELECT -(CAST(p.label AS BIGINT) * 1000000000 + p.j + 1) AS id, p.label,
         list_transform(range(len(b.features)), lambda i: b.features[i + 1] + p.gap * (o.features[i + 1] - b.features[i + 1])) AS features,
         true AS is_synthetic
  FROM plan p
  JOIN small b ON b.label = p.label AND b.trk = p.base_trk
  JOIN nnr n ON n.id = b.id AND n.nr = p.pick + 1
  JOIN small o ON o.id = n.oid),
kept AS (
  SELECT id, label, features, false AS is_synthetic FROM scaled
  WHERE split = 'train' AND (n_train <= (SELECT target FROM tgt) OR trk <= (SELECT target FROM tgt))),
bal AS (SELECT * FROM kept UNION ALL SELECT * FROM syn),
mr AS (
  SELECT id, label, features, is_synthetic, 'train_balanced' AS split FROM bal
  UNION ALL SELECT id, label, features, false, 'test' FROM scaled WHERE split = 'test'),
kn0 AS (
  SELECT t.id, t.label, b.id AS tid, b.label AS tl, {_dist('b.features', 't.features')} AS d
  FROM mr t JOIN mr b ON t.split = 'test' AND b.split = 'train_balanced'),
kn1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, tid) AS nr FROM kn0) WHERE nr <= {KNN_K}),
votes AS (SELECT id, label, tl AS c, count(*) AS cnt FROM kn1 GROUP BY id, label, tl),
pred AS (
  SELECT id, label, CAST(c AS INTEGER) AS prediction, cnt AS votes FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY cnt DESC, c) AS rn FROM votes) WHERE rn = 1)
"""


def w(body: str) -> str:
    return "WITH " + BASE.strip() + ",\n" + body


def _long(src: str, keys: str) -> str:
    return (f"SELECT {keys}, CAST(unnest(range(len(features))) AS INTEGER) AS feature_idx, "
            f"round(unnest(features), {R6}) AS value FROM {src}")


CLASS_HISTOGRAM = w("q AS (SELECT label, n FROM cnt) SELECT * FROM q")
STRATIFIED_SPLIT = w("q AS (SELECT id, label, split FROM sp) SELECT * FROM q")
KFOLD = w("q AS (SELECT id, label, CAST((trk - 1) % 3 AS INTEGER) AS fold FROM sp WHERE split = 'train') SELECT * FROM q")
SCALER_FIT = w(f"q AS (SELECT feature_idx, round(mean, {R6}) AS mean, round(std, {R6}) AS std FROM params) SELECT * FROM q")
SCALER_APPLY = w(f"q AS ({_long('scaled', 'id, split')}) SELECT * FROM q")
UNDERSAMPLE = w(f"""q AS (SELECT id, label FROM sp WHERE split = 'train'
  AND (n_train <= (SELECT target FROM tgt) OR trk <= (SELECT target FROM tgt))) SELECT * FROM q""")
SMOTE = w(f"q AS ({_long('syn', 'id, label')}) SELECT * FROM q")
BALANCED_TRAIN = w(f"q AS ({_long('bal', 'id, label, is_synthetic')}) SELECT * FROM q")
PRUNE_TRAIN = w("""q AS (SELECT id, label FROM sp WHERE split = 'train'
  AND trk <= n_train - CAST(floor(n_train * 0.1) AS BIGINT)) SELECT * FROM q""")
KNN_PREDICT = w("q AS (SELECT id, label, prediction, votes FROM pred) SELECT * FROM q")
CONFUSION_MATRIX = w("""seen AS (SELECT label AS c FROM pred UNION SELECT prediction FROM pred),
q AS (SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM pred WHERE label = a.c AND prediction = b.c) AS n
      FROM seen a CROSS JOIN seen b) SELECT * FROM q""")

PER_CLASS = """
cm AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction),
t AS (SELECT label AS cls, sum(n) AS support, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cm GROUP BY label),
p AS (SELECT prediction AS cls, sum(n) AS predicted FROM cm GROUP BY prediction),
pc0 AS (SELECT coalesce(t.cls, p.cls) AS cls, CAST(coalesce(tp, 0) AS DOUBLE) AS tp,
               CAST(coalesce(support, 0) AS DOUBLE) AS support, CAST(coalesce(predicted, 0) AS DOUBLE) AS predicted
        FROM t FULL JOIN p ON t.cls = p.cls),
pc AS (SELECT cls, tp, support,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
         CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0.0 END AS f1 FROM pc0)
"""

MACRO_METRICS = w(PER_CLASS.strip() + f""",
q AS (SELECT round(sum(tp) / sum(support), {R6}) AS accuracy, round(avg(f1), {R6}) AS f1_macro,
  round(avg(recall), {R6}) AS recall_macro, round(avg(precision), {R6}) AS precision_macro,
  CAST(sum(support) AS BIGINT) AS n FROM pc)
SELECT * FROM q""")

CLASS_REPORT = w(PER_CLASS.strip() + f""",
rep AS (
  SELECT CAST(cls AS VARCHAR) AS row, precision, recall, f1, support FROM pc
  UNION ALL SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM pc
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM pc
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM pc),
q AS (SELECT row, round(precision, {R6}) AS precision, round(recall, {R6}) AS recall, round(f1, {R6}) AS f1,
             CAST(support AS BIGINT) AS support FROM rep)
SELECT * FROM q""")

ROC_CTES = f"""
classes AS (SELECT DISTINCT label AS cls FROM fm),
shares AS (SELECT id, label, c, cnt / {float(KNN_K)!r} AS s FROM votes),
ex AS (
  SELECT cl.cls, coalesce(sh.s, 0.0) AS score, CASE WHEN t.label = cl.cls THEN 1 ELSE 0 END AS pos
  FROM (SELECT DISTINCT id, label FROM votes) t CROSS JOIN classes cl
  LEFT JOIN shares sh ON sh.id = t.id AND sh.c = cl.cls),
g0 AS (SELECT cls, score, sum(pos) AS p, sum(1 - pos) AS q FROM ex GROUP BY cls, score),
g1 AS (SELECT *, sum(p) OVER (PARTITION BY cls ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tps,
                 sum(q) OVER (PARTITION BY cls ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps,
                 sum(p) OVER (PARTITION BY cls) AS n_pos, sum(q) OVER (PARTITION BY cls) AS n_neg FROM g0),
g2 AS (SELECT *, lag(tps) OVER wd AS ptp, lead(tps) OVER wd AS ntp, lag(fps) OVER wd AS pfp, lead(fps) OVER wd AS nfp
       FROM g1 WINDOW wd AS (PARTITION BY cls ORDER BY score DESC)),
pts AS (
  SELECT cls, 0.0 AS fpr, 0.0 AS tpr FROM classes
  UNION ALL
  SELECT cls, fps / nullif(n_neg, 0), tps / nullif(n_pos, 0) FROM g2
  WHERE ptp IS NULL OR ntp IS NULL OR (ntp - tps) <> (tps - ptp) OR (nfp - fps) <> (fps - pfp))
"""

ROC_POINTS = w(ROC_CTES.strip() + f""",
q AS (SELECT CAST(cls AS INTEGER) AS cls, round(fpr, {R6}) AS fpr, round(tpr, {R6}) AS tpr FROM pts)
SELECT * FROM q""")

# Mann-Whitney over pairs of distinct scores, not the area under the points
AUC_OVR = w(ROC_CTES.strip() + f""",
mw AS (SELECT a.cls, sum(a.p * b.q * CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)
         / nullif(sum(a.p * b.q), 0) AS auc FROM g0 a JOIN g0 b USING (cls) GROUP BY a.cls),
q AS (SELECT CAST(cls AS INTEGER) AS cls, round(auc, {R6}) AS auc FROM mw)
SELECT * FROM q""")


# --- expansion and ANOVA -----------------------------------------------------

EXPAND_CTES = """
mrl AS (SELECT id, label, split, CAST(unnest(range(len(features))) AS INTEGER) AS i, unnest(features) AS x FROM scaled),
dd AS (SELECT max(len(features)) AS d FROM scaled),
pr AS (
  SELECT a.id, a.label, a.split, a.i, b.i AS j, a.x AS xa, b.x AS xb,
         CAST(a.i * (2 * d - a.i - 1) // 2 + b.i - a.i - 1 AS INTEGER) AS p, d
  FROM dd CROSS JOIN mrl a JOIN mrl b ON a.id = b.id AND a.split = b.split AND a.i < b.i),
ex_orig AS (SELECT id, label, split, i AS feature_id, x AS value FROM mrl),
ex_plus AS (SELECT id, label, split, d + 4 * p + 0 AS feature_id, xa + xb AS value FROM pr),
ex_minus AS (SELECT id, label, split, d + 4 * p + 1 AS feature_id, xa - xb AS value FROM pr),
ex_div AS (SELECT id, label, split, d + 4 * p + 2 AS feature_id,
                  CASE WHEN xb + 1e-6 = 0 THEN NULL ELSE xa / (xb + 1e-6) END AS value FROM pr),
ex_mul AS (SELECT id, label, split, d + 4 * p + 3 AS feature_id, xa * xb AS value FROM pr),
ex_all AS (SELECT * FROM ex_orig UNION ALL SELECT * FROM ex_plus UNION ALL SELECT * FROM ex_minus
           UNION ALL SELECT * FROM ex_div UNION ALL SELECT * FROM ex_mul)
"""


def _moments_sql(src: str) -> str:
    return w(EXPAND_CTES.strip() + f""",
q AS (SELECT CAST(feature_id AS INTEGER) AS feature_id, count(value) AS n, round(avg(value), {R6}) AS mean,
             round(stddev_pop(value), {R6}) AS std FROM {src} GROUP BY feature_id)
SELECT * FROM q""")


PAIR_FEATURES = _moments_sql("(SELECT * FROM ex_plus UNION ALL SELECT * FROM ex_minus UNION ALL SELECT * FROM ex_div)")
INTERACTION_FEATURES = _moments_sql("ex_mul")
EXPAND_ALL = _moments_sql("ex_all")
#: the same in REAL arithmetic, moments in DOUBLE
EXPAND_SINGLE = (EXPAND_ALL.replace("unnest(features) AS x FROM scaled", "CAST(unnest(features) AS REAL) AS x FROM scaled")
                 .replace("1e-6", "CAST(1e-6 AS REAL)").replace("avg(value)", "avg(CAST(value AS DOUBLE))")
                 .replace("stddev_pop(value)", "stddev_pop(CAST(value AS DOUBLE))"))

ANOVA_CTES = """
tr AS (SELECT * FROM ex_all WHERE split = 'train'),
bad AS (SELECT DISTINCT feature_id FROM tr WHERE value IS NULL),
aper AS (SELECT feature_id, label, count(*) AS nk, avg(value) AS mk, var_pop(value) AS vk FROM tr GROUP BY feature_id, label),
aall AS (SELECT feature_id, count(*) AS n, avg(value) AS m FROM tr GROUP BY feature_id),
fs AS (
  SELECT feature_id, (sum(nk * (mk - m) * (mk - m)) / (count(*) - 1)) / nullif(sum(nk * vk) / (max(n) - count(*)), 0) AS f
  FROM aper JOIN aall USING (feature_id) WHERE feature_id NOT IN (SELECT feature_id FROM bad) GROUP BY feature_id)
"""

ANOVA_F = w(EXPAND_CTES.strip() + ",\n" + ANOVA_CTES.strip() + f""",
q AS (SELECT CAST(feature_id AS INTEGER) AS feature_id, round(f, {R6}) AS f FROM fs)
SELECT * FROM q""")

ANOVA_TOPK = w(EXPAND_CTES.strip() + ",\n" + ANOVA_CTES.strip() + f""",
ranked AS (SELECT *, row_number() OVER (ORDER BY f DESC NULLS LAST, feature_id DESC) AS rn FROM fs),
q AS (SELECT CAST(feature_id AS INTEGER) AS feature_id, round(f, {R6}) AS f FROM ranked WHERE rn <= 1000)
SELECT * FROM q""")
