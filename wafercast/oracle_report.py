"""DuckDB twins of the report tables: pairwise distances and windows."""

from __future__ import annotations

from .oracle_ml import BASE, EXPAND_CTES, _dist
from .plans.report_queries import DISPLAY, GAP, MODELS, NEIGHBOURS, TRACKS

R6 = 6

_PICK = "\n  UNION ALL ".join(
    f"SELECT '{t}' AS track, feature_id, CAST(rn AS INTEGER) AS rk FROM (SELECT feature_id, row_number() OVER "
    f"(ORDER BY f DESC NULLS LAST, feature_id DESC) AS rn FROM fs {'WHERE feature_id < (SELECT d FROM dd)' if base else ''}) WHERE rn <= {k}"
    for t, (_, k, base) in TRACKS.items())

TRACK_CTES = BASE.strip() + ",\n" + EXPAND_CTES.strip().replace("FROM scaled", "FROM mr") + f""",
tr AS (SELECT * FROM ex_all WHERE split = 'train_balanced'),
bad AS (SELECT DISTINCT feature_id FROM tr WHERE value IS NULL),
aper AS (SELECT feature_id, label, count(*) AS nk, avg(value) AS mk, var_pop(value) AS vk FROM tr GROUP BY feature_id, label),
aall AS (SELECT feature_id, count(*) AS n, avg(value) AS m FROM tr GROUP BY feature_id),
fs AS (
  SELECT feature_id, (sum(nk * (mk - m) * (mk - m)) / (count(*) - 1)) / nullif(sum(nk * vk) / (max(n) - count(*)), 0) AS f
  FROM aper JOIN aall USING (feature_id) WHERE feature_id NOT IN (SELECT feature_id FROM bad) GROUP BY feature_id),
tracks AS (SELECT track, CAST(feature_id AS INTEGER) AS feature_id, rk FROM ({_PICK})),
vec AS (SELECT t.track, e.id, e.label, e.split, list(coalesce(e.value, 0.0) ORDER BY e.feature_id) AS features
        FROM ex_all e JOIN tracks t USING (feature_id) GROUP BY ALL)
"""

BOARD_CTES = TRACK_CTES.strip() + f""",
pairs AS (
  SELECT q.track, q.id, q.label, q.split, b.id AS tid, b.label AS tl, {_dist('b.features', 'q.features')} AS dist
  FROM vec q JOIN vec b ON q.track = b.track AND b.split = 'train_balanced'),
near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track, split, id ORDER BY dist, tid) AS nr FROM pairs)
         WHERE nr <= {max(NEIGHBOURS)}),
ks AS (SELECT unnest([{', '.join(map(str, NEIGHBOURS))}]) AS k),
v AS (SELECT track, split, k, id, label, tl AS c, count(*) AS cnt FROM near JOIN ks ON nr <= k GROUP BY ALL),
pr2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track, split, k, id ORDER BY cnt DESC, c) AS rn FROM v) WHERE rn = 1),
grp AS (SELECT DISTINCT track, split, k FROM pr2),
seen2 AS (SELECT DISTINCT track, split, k, label AS c FROM pr2 UNION SELECT DISTINCT track, split, k, c FROM pr2),
cls AS (SELECT s.track, s.split, s.k, s.c,
          count(*) FILTER (p.label = s.c AND p.c = s.c) AS tp, count(*) FILTER (p.label = s.c) AS sup,
          count(*) FILTER (p.c = s.c) AS prd FROM seen2 s JOIN pr2 p USING (track, split, k) GROUP BY ALL),
agg AS (SELECT track, split, k, avg(CASE WHEN sup + prd > 0 THEN 2.0 * tp / (sup + prd) ELSE 0 END) AS f1,
          avg(CASE WHEN sup > 0 THEN tp / sup ELSE 0 END) AS rec, sum(tp) / sum(sup) AS acc FROM cls GROUP BY ALL),
lb AS (SELECT te.track AS "Track", 'KNN_' || te.k AS "Model", te.f1 AS "Test_F1_Macro", te.rec AS "Test_Recall_Macro",
         tr.f1 AS "Train_F1_Macro", tr.f1 - te.f1 AS "Overfit_Gap", te.acc AS "Test_Accuracy", 'k=' || te.k AS "Best_Params"
       FROM agg te JOIN agg tr ON te.track = tr.track AND te.k = tr.k AND te.split = 'test' AND tr.split = 'train_balanced'),
lbr AS (SELECT "Track", "Model", round("Test_F1_Macro", {R6}) AS "Test_F1_Macro", round("Test_Recall_Macro", {R6}) AS "Test_Recall_Macro",
         round("Train_F1_Macro", {R6}) AS "Train_F1_Macro", round("Overfit_Gap", {R6}) AS "Overfit_Gap",
         round("Test_Accuracy", {R6}) AS "Test_Accuracy", "Best_Params",
         row_number() OVER (ORDER BY "Test_F1_Macro" DESC, "Track", "Model") AS place,
         row_number() OVER (PARTITION BY "Track" ORDER BY "Test_F1_Macro" DESC, "Model") AS in_track,
         row_number() OVER (PARTITION BY "Model" ORDER BY "Test_F1_Macro" DESC, "Track") AS in_model, "Overfit_Gap" AS gap FROM lb)
"""

_COLS = '"Track", "Model", "Test_F1_Macro", "Test_Recall_Macro", "Train_F1_Macro", "Overfit_Gap", "Test_Accuracy", "Best_Params"'


def _t(body: str) -> str:
    return "WITH " + TRACK_CTES.strip() + "\n" + body


def _b(body: str) -> str:
    return "WITH " + BOARD_CTES.strip() + "\n" + body


TRACK_FEATURES = _t("SELECT * FROM tracks")
TRACK_OVERLAP = _t("""SELECT a.track AS track_a, b.track AS track_b, count(*) AS shared
FROM tracks a JOIN tracks b ON a.feature_id = b.feature_id AND a.track < b.track GROUP BY ALL""")
TRACK_PROJECT = _t(f"""SELECT id, CAST(unnest(range(len(features))) AS INTEGER) AS pos, round(unnest(features), {R6}) AS value
FROM vec WHERE split = 'test' AND track = 'T1_Anova_25'""")
LEADERBOARD = _b(f"SELECT {_COLS} FROM lbr")
WINNER = _b(f"SELECT {_COLS} FROM lbr WHERE place = 1")
BEST_PER_TRACK = _b(f"SELECT {_COLS} FROM lbr WHERE in_track = 1")
F1_PIVOT = _b("SELECT m AS \"Model\", " + ", ".join(
    f"max(\"Test_F1_Macro\") FILTER (\"Track\" = '{t}') AS \"{t}\"" for t in TRACKS)
    + f" FROM (SELECT unnest([{', '.join(repr(m) for m in [*MODELS, 'KNN_99'])}]) AS m) LEFT JOIN lbr ON \"Model\" = m GROUP BY m")
SELECTION_TABLE = _b(f"""SELECT replace(t.name, '_', ' ') AS "Track_ID", t.how AS "Selection_Method",
  (SELECT count(*) FROM tracks WHERE track = t.name) AS "Feature_Count",
  (SELECT round_even(max("Test_F1_Macro"), 3) FROM lb WHERE "Track" = t.name) AS "Best_Model_Macro_F1"
FROM (VALUES {', '.join(f"('{t}', '{how}')" for t, (how, _, _) in TRACKS.items())}) AS t(name, how)""")
GAP_TABLE = _b(f"""SELECT CASE "Model" {' '.join(f"WHEN '{m}' THEN '{DISPLAY[m]}'" for m in MODELS)} END AS "Model",
  round_even("Train_F1_Macro", 2) AS "Train_F1_SMOTE", round_even("Test_F1_Macro", 2) AS "Test_F1_Real",
  round_even("Overfit_Gap", 2) AS "Gap" FROM (SELECT lb.*, row_number() OVER (PARTITION BY "Model" ORDER BY "Test_F1_Macro" DESC, "Track") AS r FROM lb)
WHERE r = 1 AND "Model" IN ({', '.join(repr(m) for m in MODELS[:2])})""")
OVERFIT_TRIGGER = _b(f"SELECT {_COLS} FROM lbr WHERE gap > {GAP}")

ALL = {"track_features": TRACK_FEATURES, "track_overlap": TRACK_OVERLAP, "track_project": TRACK_PROJECT,
       "leaderboard": LEADERBOARD, "winner": WINNER, "best_per_track": BEST_PER_TRACK, "f1_pivot": F1_PIVOT,
       "selection_table": SELECTION_TABLE, "gap_table": GAP_TABLE, "overfit_trigger": OVERFIT_TRIGGER,
       # the same rows by another way: a table of names, stage files
       "track_by_name": TRACK_PROJECT, "expanded_stage": TRACK_PROJECT, "leaderboard_file": LEADERBOARD,
       "gap_table_file": GAP_TABLE}
