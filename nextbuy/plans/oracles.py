"""SQL twins (DuckDB dialect) of the registered queries.

Written independently of the DataFrame code: where the Spark side uses the
one-window form (lag/lead over the client), the twin uses the join form
(events table, snapshot pairs, left join of first purchases), so agreement
checks the rewrite, not just the translation.
"""

from __future__ import annotations

from ..operators import panel as P
from ..products import PRODUCTS
from ..sources.adapter import PANEL_COLUMNS, PANEL_CTES

CUTOFF = P.TEST_CUTOFF.isoformat()

# CTE chain shared by the oracles: panel -> events -> pairs -> target panel.
BASE = PANEL_CTES + f""",
events AS (
  SELECT ncodpers, fecha_dato, q, code AS purchase FROM (
    SELECT ncodpers, fecha_dato, q, prev_owned, unnest(owned) AS code FROM (
      SELECT ncodpers, fecha_dato, q, owned,
             lag(owned) OVER (PARTITION BY ncodpers ORDER BY q) AS prev_owned
      FROM panel))
  WHERE prev_owned IS NULL OR NOT list_contains(prev_owned, code)
),
pairs AS (
  SELECT q, fecha_dato, lead(q) OVER (ORDER BY q) AS next_q,
         lead(fecha_dato) OVER (ORDER BY q) AS target_date
  FROM (SELECT DISTINCT q, fecha_dato FROM panel)
),
first_buy AS (SELECT ncodpers, q, min(purchase) AS code FROM events GROUP BY ncodpers, q),
target AS (
  SELECT p.*, d.fecha_dato AS snapshot_date, d.target_date, d.next_q,
         CAST(coalesce(f.code, 0) AS INTEGER) AS purchase
  FROM panel p JOIN pairs d ON p.q = d.q AND d.next_q IS NOT NULL
  LEFT JOIN first_buy f ON f.ncodpers = p.ncodpers AND f.q = d.next_q
),
share AS (
  SELECT purchase, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
  FROM events WHERE fecha_dato <= DATE '{CUTOFF}' GROUP BY purchase
),
ranked AS (
  SELECT purchase, share, row_number() OVER (ORDER BY share DESC, purchase) AS rank
  FROM share WHERE share >= {P.MIN_PURCHASE_SHARE}
),
shortlist AS (SELECT CAST(purchase AS INTEGER) AS code FROM ranked WHERE rank <= {P.MAX_TARGET_PRODUCTS}),
folded AS (
  SELECT t.*, CASE WHEN snapshot_date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split,
         CASE WHEN t.purchase <> 0 AND t.purchase NOT IN (SELECT code FROM shortlist)
              THEN 99 ELSE t.purchase END AS label0
  FROM target t
),
rare AS (
  SELECT label0 AS code FROM folded WHERE split = 'train' GROUP BY label0
  HAVING count(*) < {P.MIN_CLASS_SUPPORT} AND label0 NOT IN (0, 99)
),
frame AS (
  SELECT * EXCLUDE (label0, purchase),
         CAST(CASE WHEN label0 IN (SELECT code FROM rare) THEN 99 ELSE label0 END AS INTEGER) AS purchase
  FROM folded
)"""


def _q(body: str) -> str:
    return "WITH " + BASE + "\n" + body


def _d(col: str) -> str:
    return f"CAST({col} AS VARCHAR) AS {col}"


_PANEL_SELECT = ", ".join(_d(c) if c in ("fecha_dato", "fecha_alta") else c for c in PANEL_COLUMNS)

ORACLES: dict[str, str] = {
    "a1_panel": _q(f"SELECT {_PANEL_SELECT} FROM panel"),
    "c1_purchase_events": _q(
        "SELECT ncodpers, CAST(fecha_dato AS VARCHAR) AS fecha_dato, q, "
        "CAST(purchase AS INTEGER) AS purchase FROM events"),
    "c2_purchase_share": _q("SELECT purchase, n, share FROM share"),
    "c3_shortlist": _q(
        f"SELECT purchase, share, rank, rank <= {P.MAX_TARGET_PRODUCTS} AS selected FROM ranked"),
    "c5_target_panel": _q(
        "SELECT ncodpers, CAST(snapshot_date AS VARCHAR) AS snapshot_date, "
        "CAST(target_date AS VARCHAR) AS target_date, purchase FROM target"),
    "c6_panel_diagnostics": _q("""
SELECT CAST(d.fecha_dato AS VARCHAR) AS snapshot_date, CAST(d.target_date AS VARCHAR) AS target_date,
       r.rows, r.clients, coalesce(b.buyers, 0) AS purchasers_in_target,
       r.purchasers_in_snapshot, coalesce(m.missing, 0) AS purchasers_missing_in_snapshot,
       r.purchasers_in_snapshot / r.rows AS purchase_share
FROM pairs d
JOIN (SELECT q, count(*) AS rows, count(DISTINCT ncodpers) AS clients,
             count(*) FILTER (WHERE purchase <> 0) AS purchasers_in_snapshot
      FROM target GROUP BY q) r ON r.q = d.q
LEFT JOIN (SELECT q, count(DISTINCT ncodpers) AS buyers FROM events GROUP BY q) b ON b.q = d.next_q
LEFT JOIN (SELECT d2.q, count(*) AS missing FROM pairs d2
           JOIN (SELECT DISTINCT ncodpers, q FROM events) e ON e.q = d2.next_q
           WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.ncodpers = e.ncodpers AND p.q = d2.q)
           GROUP BY d2.q) m ON m.q = d.q
WHERE d.next_q IS NOT NULL"""),
    "c7_panel_summary": _q("""
SELECT (SELECT count(*) FROM pairs WHERE next_q IS NOT NULL) AS snapshots,
       count(*) AS rows, count(DISTINCT ncodpers) AS clients,
       count(*) FILTER (WHERE purchase <> 0) AS purchasers,
       (count(*) FILTER (WHERE purchase <> 0)) / count(*) AS purchase_share,
       (SELECT count(*) FROM pairs d2 JOIN (SELECT DISTINCT ncodpers, q FROM events) e ON e.q = d2.next_q
        WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.ncodpers = e.ncodpers AND p.q = d2.q))
         AS unpredictable_purchasers,
       (SELECT count(*) FROM pairs d2 JOIN (SELECT DISTINCT ncodpers, q FROM events) e ON e.q = d2.next_q
        WHERE NOT EXISTS (SELECT 1 FROM panel p WHERE p.ncodpers = e.ncodpers AND p.q = d2.q))
       / greatest((SELECT count(*) FROM pairs d2 JOIN (SELECT DISTINCT ncodpers, q FROM events) e
                   ON e.q = d2.next_q), 1) AS unpredictable_purchaser_share
FROM target"""),
    "c12_class_distribution": _q("SELECT split, purchase, count(*) AS n FROM frame GROUP BY ALL"),
}


# --- C10 / D11 / J twins: long form with windows, instead of in-row arrays ----

EVAL = """,
classes AS (SELECT DISTINCT purchase AS code FROM frame WHERE split = 'train'),
cands AS (SELECT code, CAST(row_number() OVER (ORDER BY code) - 1 AS INTEGER) AS pos
          FROM shortlist WHERE code IN (SELECT code FROM classes)),
test AS (SELECT ncodpers, q, purchase FROM frame WHERE split = 'test'),
train AS (SELECT ncodpers, q, purchase FROM frame WHERE split = 'train'),
tscore AS (
  SELECT t.ncodpers, t.q, t.purchase, c.code,
         CAST((t.ncodpers * 7919 + CAST(t.q AS BIGINT) * 104729 + CAST(c.code AS BIGINT) * 1299709) % 10007
              AS DOUBLE) / CAST(10007 AS DOUBLE) AS score
  FROM test t CROSS JOIN classes c
),
ranked_cands AS (
  SELECT s.ncodpers, s.q, s.code,
         row_number() OVER (PARTITION BY s.ncodpers, s.q ORDER BY s.score DESC, c.pos) AS rn
  FROM tscore s JOIN cands c ON c.code = s.code
),
stats AS (
  SELECT t.ncodpers, t.q, t.purchase, CAST(coalesce(r.rn, 0) AS INTEGER) AS rank,
         r.rn IS NOT NULL AS relevant, t.purchase <> 0 AS purchased
  FROM test t LEFT JOIN ranked_cands r
    ON r.ncodpers = t.ncodpers AND r.q = t.q AND r.code = t.purchase
),
ks AS (SELECT * FROM (VALUES (1), (3), (5), (10)) v(k)),
popord AS (
  SELECT c.code, coalesce(f.freq, 0) AS freq,
         row_number() OVER (ORDER BY coalesce(f.freq, 0) DESC, c.pos) AS pop_rank
  FROM cands c LEFT JOIN (SELECT purchase AS code, count(*) AS freq FROM train GROUP BY 1) f
    ON f.code = c.code
),
popstats AS (
  SELECT t.ncodpers, t.q, t.purchase, CAST(coalesce(p.pop_rank, 0) AS INTEGER) AS rank,
         p.pop_rank IS NOT NULL AS relevant, t.purchase <> 0 AS purchased
  FROM test t LEFT JOIN popord p ON p.code = t.purchase
),
pred AS (
  SELECT ncodpers, q, purchase, code AS pred FROM (
    SELECT *, row_number() OVER (PARTITION BY ncodpers, q ORDER BY score DESC, code) AS rn
    FROM tscore) WHERE rn = 1
),
report AS (
  SELECT cls AS class, support, predicted, tp,
         CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall
  FROM (
    SELECT CAST(u.cls AS INTEGER) AS cls,
           (SELECT count(*) FROM pred p WHERE p.purchase = u.cls) AS support,
           (SELECT count(*) FROM pred p WHERE p.pred = u.cls) AS predicted,
           (SELECT count(*) FROM pred p WHERE p.pred = u.cls AND p.purchase = u.cls) AS tp
    FROM (SELECT purchase AS cls FROM pred UNION SELECT pred FROM pred) u)
),
report_f1 AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM report
),
midrank AS (  -- one-vs-rest scores grouped by (class, score), ranks ascending
  SELECT code, score, cnt, tp,
         coalesce(sum(cnt) OVER (PARTITION BY code ORDER BY score
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           + (cnt + 1) / 2.0 AS mid
  FROM (SELECT code, score, count(*) AS cnt, count(*) FILTER (WHERE purchase = code) AS tp
        FROM tscore GROUP BY code, score)
),
curve AS (
  SELECT code, sum(tp) AS P, sum(cnt) AS n, sum(tp * mid) AS rank_sum FROM midrank GROUP BY code
),
prgrid AS (
  SELECT code, tp, sum(tp) OVER w AS ctp, sum(cnt) OVER w AS ccnt FROM (
    SELECT code, score, count(*) AS cnt, count(*) FILTER (WHERE purchase = code) AS tp
    FROM tscore GROUP BY code, score)
  WINDOW w AS (PARTITION BY code ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
per_class AS (
  SELECT CAST(c.code AS INTEGER) AS class, c.P AS support, c.P / c.n AS share,
         round(a.ap, 9) AS pr_auc,
         round((c.rank_sum - c.P * (c.P + 1) / 2.0) / (c.P * (c.n - c.P)), 9) AS roc_auc_ovr
  FROM curve c JOIN (SELECT code, sum(tp * (ctp / ccnt)) / sum(tp) AS ap FROM prgrid GROUP BY code) a
    ON a.code = c.code
  WHERE c.P > 0
)"""


def _e(body: str) -> str:
    return "WITH " + BASE + EVAL + "\n" + body


_METRICS = """
SELECT scope, k{extra},
       CAST(hits AS DOUBLE) / users / k AS {p}precision_at_k,
       CAST(hits AS DOUBLE) / purchasers AS {p}recall_at_k,
       CAST(hits AS DOUBLE) / users AS {p}hit_rate_at_k,
       CASE WHEN users = 0 THEN 'NaN'::DOUBLE ELSE round(coalesce(gain, 0.0) / users, 9) END AS {p}ndcg_at_k
FROM (
  SELECT scope, k, count(rank) AS users, count(*) FILTER (WHERE relevant) AS purchasers,
         count(*) FILTER (WHERE rank > 0 AND rank <= k) AS hits,
         sum(CASE WHEN rank > 0 AND rank <= k THEN 1 / log2(rank + 1) ELSE 0 END) AS gain
  FROM (SELECT g.scope, ks.k, s.rank, s.relevant
        FROM (VALUES ('shortlist_purchasers'), ('purchasers_any'), ('all_rows')) g(scope)
        CROSS JOIN ks
        LEFT JOIN (SELECT 'shortlist_purchasers' AS scope, * FROM {src} WHERE relevant
                   UNION ALL SELECT 'purchasers_any', * FROM {src} WHERE purchased
                   UNION ALL SELECT 'all_rows', * FROM {src}) s ON s.scope = g.scope)
  GROUP BY scope, k)"""


def _metrics(src: str, p: str = "") -> str:
    extra = "" if p else ", users, purchasers, CAST(purchasers AS DOUBLE) / users AS purchase_share"
    return _METRICS.format(src=src, p=p, extra=extra)


_RANDOM = """
SELECT scope, k, share / m AS random_precision_at_k, k / m AS random_recall_at_k,
       share * k / m AS random_hit_rate_at_k,
       round(share * ((SELECT sum(1 / log2(i + 1)) FROM range(1, k + 1) r(i)) / m), 9) AS random_ndcg_at_k
FROM (
  SELECT scope, k, count(*) FILTER (WHERE relevant) / count(*) AS share,
         (SELECT count(*) FROM cands) AS m
  FROM (SELECT 'shortlist_purchasers' AS scope, * FROM stats WHERE relevant
        UNION ALL SELECT 'purchasers_any', * FROM stats WHERE purchased
        UNION ALL SELECT 'all_rows', * FROM stats) s CROSS JOIN ks
  GROUP BY scope, k)"""

_LABELS = " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in {
        "shortlist_purchasers": "clients who bought a shortlist product",
        "purchasers_any": "all buyers (a purchase outside the shortlist is a miss)",
        "all_rows": "all test rows, including clients without a purchase"}.items())

ORACLES.update({
    "c10_candidate_classes": _e("SELECT code FROM cands"),
    "d11_popularity_order": _e("SELECT code, freq, pop_rank FROM popord"),
    "j6_candidate_availability": _e(
        "SELECT code, code IN (SELECT code FROM classes) AS available FROM shortlist"),
    "j7_top3_products": _e(
        "SELECT ncodpers, q, string_agg(CAST(code AS VARCHAR), ',' ORDER BY rn) AS top3 "
        "FROM ranked_cands WHERE rn <= 3 GROUP BY ncodpers, q"),
    "j8_ranking_stats": _e("SELECT ncodpers, q, purchase, rank, relevant, purchased FROM stats"),
    "j9_scope_metrics": _e(_metrics("stats")),
    "j10_random_baseline": _e(_RANDOM),
    "j11_popularity_baseline": _e(_metrics("popstats", "popularity_")),
    "j12_topk_report": _e(f"""
SELECT m.*, r.* EXCLUDE (scope, k), p.* EXCLUDE (scope, k),
       CASE m.scope {_LABELS} ELSE m.scope END AS scope_label
FROM ({_metrics('stats')}) m
LEFT JOIN ({_RANDOM}) r ON r.scope = m.scope AND r.k = m.k
LEFT JOIN ({_metrics('popstats', 'popularity_')}) p ON p.scope = m.scope AND p.k = m.k"""),
    "j1_macro_roc_auc": _e("""
, kept AS (SELECT * FROM tscore WHERE purchase IN (SELECT code FROM classes)),
norm AS (
  SELECT k.ncodpers, k.q, k.purchase, k.code,
         k.score / CASE WHEN t.total = 0 THEN 1.0 ELSE t.total END AS score
  FROM kept k JOIN (SELECT ncodpers, q, list_sum(list(score ORDER BY code)) AS total
                    FROM kept GROUP BY ncodpers, q) t ON t.ncodpers = k.ncodpers AND t.q = k.q
),
mr AS (
  SELECT code, cnt, tp,
         coalesce(sum(cnt) OVER (PARTITION BY code ORDER BY score
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           + (cnt + 1) / 2.0 AS mid
  FROM (SELECT code, score, count(*) AS cnt, count(*) FILTER (WHERE purchase = code) AS tp
        FROM norm GROUP BY code, score)
),
auc AS (
  SELECT code, (sum(tp * mid) - sum(tp) * (sum(tp) + 1) / 2.0) / (sum(tp) * (sum(cnt) - sum(tp))) AS a
  FROM mr GROUP BY code HAVING sum(tp) > 0
)
SELECT round(CASE WHEN (SELECT count(*) FROM auc) = 2
                  THEN (SELECT a FROM auc ORDER BY code LIMIT 1 OFFSET 1)
                  ELSE (SELECT avg(a) FROM auc) END, 9) AS roc_auc_ovr_macro""".replace(
        "\n, kept", ",\nkept", 1)),
    "j5_class_report": _e("SELECT class, support, predicted, tp, precision, recall, f1 FROM report_f1"),
    "j2_classification_summary": _e("""
SELECT sum(tp) / sum(support) AS accuracy,
       round(avg(precision), 9) AS precision_macro, round(avg(recall), 9) AS recall_macro,
       round(avg(f1), 9) AS f1_macro,
       round(sum(precision * support) / sum(support), 9) AS precision_weighted,
       round(sum(recall * support) / sum(support), 9) AS recall_weighted,
       round(sum(f1 * support) / sum(support), 9) AS f1_weighted
FROM report_f1"""),
    "j3_per_class_pr_auc": _e("SELECT * FROM per_class"),
    "j4_baseline_comparison": _e("""
SELECT b.no_purchase_accuracy,
       round((s.accuracy - b.no_purchase_accuracy) * 100, 9) AS accuracy_lift_pp,
       b.product_classes_mean_pr_auc, b.product_classes_mean_random_pr_auc,
       round(b.product_classes_mean_pr_auc / b.product_classes_mean_random_pr_auc, 6)
         AS product_classes_pr_auc_lift
FROM (SELECT max(share) FILTER (WHERE class = 0) AS no_purchase_accuracy,
             round(avg(pr_auc) FILTER (WHERE class NOT IN (0, 99) AND support > 0), 9)
               AS product_classes_mean_pr_auc,
             round(avg(share) FILTER (WHERE class NOT IN (0, 99) AND support > 0), 9)
               AS product_classes_mean_random_pr_auc
      FROM per_class) b,
     (SELECT sum(tp) / sum(support) AS accuracy FROM report_f1) s"""),
})


# --- E / F / G / H twins -----------------------------------------------------

_FLAG_SUM = " + ".join(PRODUCTS)
_MODE_COLS = ["fecha_alta", "segmento", "pais_residencia", "canal_entrada", *PRODUCTS]

PREP = f""",
ftrain AS (SELECT * FROM frame WHERE split = 'train'),
ftest AS (SELECT * FROM frame WHERE split = 'test'),
ctrain AS (SELECT * REPLACE (CASE WHEN antiguedad = -999999 THEN NULL ELSE antiguedad END AS antiguedad)
           FROM ftrain),
med AS (SELECT quantile_cont(age, 0.5) AS ma, quantile_cont(antiguedad, 0.5) AS mt,
               quantile_cont(renta, 0.5) AS mr FROM ctrain),
work AS (
  SELECT c.* REPLACE (coalesce(c.age, m.ma) AS age, coalesce(c.antiguedad, m.mt) AS antiguedad,
                      coalesce(c.renta, m.mr) AS renta),
         CAST({_FLAG_SUM} AS DOUBLE) AS total_products
  FROM ctrain c CROSS JOIN med m
),
ah AS (SELECT age, sum(total_products) AS tp FROM work GROUP BY age),
ac AS (SELECT age, sum(tp) OVER (ORDER BY age) AS cum, sum(tp) OVER () AS total,
              min(age) OVER () AS amin, max(age) OVER () AS amax FROM ah),
up AS (SELECT i, coalesce(min(age) FILTER (WHERE cum > i * total / 9), max(amax)) AS upper,
              max(amin) AS amin, max(amax) AS amax
       FROM ac CROSS JOIN (SELECT range AS i FROM range(1, 9)) r GROUP BY i),
ivs AS (
  SELECT CAST(i AS INTEGER) AS i, CAST(lo AS INTEGER) AS lo, CAST(hi AS INTEGER) AS hi FROM (
    SELECT i, coalesce(lag(upper) OVER (ORDER BY i) + 1, amin) AS lo, upper AS hi FROM up
    UNION ALL
    SELECT 9, (SELECT upper FROM up WHERE i = 8) + 1, (SELECT max(amax) FROM up))
),
iv_edges AS (
  SELECT i, lo, hi, lo || '-' || hi AS label,
         coalesce(lead(lo) OVER (ORDER BY i), hi) AS edge,
         min(lo) OVER () AS bmin, max(hi) OVER () AS bmax
  FROM ivs
),
dbase AS (SELECT min(fecha_alta) AS base FROM work),
wdays AS (SELECT CAST(w.fecha_alta - b.base AS BIGINT) AS d FROM work w CROSS JOIN dbase b),
sd AS (SELECT list_sort(list(d)) AS v, count(*) AS nn, least(12, count(DISTINCT d)) AS nq FROM wdays),
qpos AS (SELECT i, (nn - 1) * (i / nq) AS pos, v, nn FROM sd
         CROSS JOIN (SELECT range AS i FROM range(0, 13)) r WHERE i <= nq),
qedge AS (
  SELECT DISTINCT CASE WHEN floor(pos) = ceil(pos) THEN CAST(v[CAST(floor(pos) AS BIGINT) + 1] AS DOUBLE)
         ELSE (ceil(pos) - pos) * v[CAST(floor(pos) AS BIGINT) + 1]
              + (pos - floor(pos)) * v[CAST(ceil(pos) AS BIGINT) + 1] END AS e
  FROM qpos
),
qe AS (SELECT e, row_number() OVER (ORDER BY e) - 1 AS j, count(*) OVER () AS ne FROM qedge),
wbin AS (SELECT d, (SELECT count(*) FROM qe WHERE j >= 1 AND e < d) AS b FROM wdays),
bins_obs AS (SELECT b, min(d) AS l, max(d) AS r FROM wbin GROUP BY b),
cohort AS (
  SELECT row_number() OVER (ORDER BY o.b) - 1 AS i,
         o.b, o.r AS right_days,
         strftime((SELECT base FROM dbase) + CAST(round_even(a.e, 0) - CASE WHEN o.b = 0 THEN 1 ELSE 0 END AS INTEGER), '%Y-%m-%d')
         || ' – ' ||
         strftime((SELECT base FROM dbase) + CAST(round_even(z.e, 0) AS INTEGER), '%Y-%m-%d') AS label
  FROM bins_obs o JOIN qe a ON a.j = o.b JOIN qe z ON z.j = o.b + 1
),
cohort_spec AS (
  SELECT CAST(i AS INTEGER) AS i,
         CAST(coalesce(lag(right_days) OVER (ORDER BY i),
                       (SELECT l FROM bins_obs ORDER BY b LIMIT 1) - 1) AS INTEGER) AS left_days,
         CAST(right_days AS INTEGER) AS right_days, label
  FROM cohort
),
clip AS (SELECT quantile_cont(renta, 0.01) AS rlo, quantile_cont(renta, 0.96) AS rhi,
                quantile_cont(antiguedad, 0.01) AS tlo, quantile_cont(antiguedad, 0.96) AS thi FROM work),
ctest AS (SELECT * REPLACE (CASE WHEN antiguedad = -999999 THEN NULL ELSE antiguedad END AS antiguedad)
          FROM ftest),
applied AS (
  SELECT t.ncodpers, t.q,
         coalesce(t.age, m.ma) AS age,
         (SELECT label FROM iv_edges e
          WHERE greatest(least(coalesce(t.age, m.ma), e.bmax), e.bmin) <= e.edge
          ORDER BY e.i LIMIT 1) AS age_interval,
         coalesce((SELECT s.label FROM cohort_spec s
                   WHERE CAST(t.fecha_alta - (SELECT base FROM dbase) AS BIGINT) > s.left_days
                     AND CAST(t.fecha_alta - (SELECT base FROM dbase) AS BIGINT) <= s.right_days),
                  'unknown') AS fecha_alta,
         CASE WHEN coalesce(t.antiguedad, m.mt) < c.tlo THEN c.tlo
              WHEN coalesce(t.antiguedad, m.mt) > c.thi THEN c.thi
              ELSE coalesce(t.antiguedad, m.mt) END AS antiguedad,
         CASE WHEN coalesce(t.renta, m.mr) < c.rlo THEN c.rlo
              WHEN coalesce(t.renta, m.mr) > c.rhi THEN c.rhi
              ELSE coalesce(t.renta, m.mr) END AS renta,
         t.segmento, t.pais_residencia, t.canal_entrada,
         CAST({_FLAG_SUM} AS DOUBLE) AS total_products
  FROM ctest t CROSS JOIN med m CROSS JOIN clip c
),
applied_train AS (
  SELECT w.pais_residencia, w.segmento,
         CASE WHEN w.antiguedad < c.tlo THEN c.tlo WHEN w.antiguedad > c.thi THEN c.thi
              ELSE w.antiguedad END AS antiguedad,
         CASE WHEN w.renta < c.rlo THEN c.rlo WHEN w.renta > c.rhi THEN c.rhi ELSE w.renta END AS renta
  FROM work w CROSS JOIN clip c
)"""


def _p(body: str) -> str:
    return "WITH " + BASE + PREP + "\n" + body


_MODES_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", (SELECT CAST(v AS VARCHAR) FROM (SELECT {c} AS v, count(*) AS n "
    f"FROM ftrain WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v ASC LIMIT 1)) AS mode"
    for c in _MODE_COLS)


def _ln(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN ln({x}) ELSE 0.0 END"


def _sq(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN sqrt({x}) ELSE 0.0 END"


def _dv(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 OR {b} IS NULL THEN 0.0 ELSE {a} / {b} END"


_FEATURES_SQL = f"""
, gstat AS (SELECT pais_residencia AS k, avg(renta) AS mr FROM applied_train GROUP BY 1),
gdef AS (SELECT avg(renta) AS mr FROM applied_train),
feat AS (
  SELECT a.ncodpers, a.q, a.antiguedad AS t, a.renta AS r,
         coalesce(g.mr, (SELECT mr FROM gdef)) AS cm
  FROM applied a LEFT JOIN gstat g ON g.k = a.pais_residencia
)
SELECT ncodpers, q, round(t, 6) AS antiguedad, round(r, 6) AS renta,
       round(t + r, 6) AS antiguedad_plus_renta,
       round({_dv('t', 'r')}, 6) AS antiguedad_div_renta,
       round({_dv('r', 't')}, 6) AS renta_div_antiguedad,
       round(t * r, 6) AS antiguedad_times_renta,
       round({_ln('t')}, 6) AS ln_antiguedad, round({_ln('r')}, 6) AS ln_renta,
       round({_sq('t')}, 6) AS sqrt_antiguedad, round({_sq('r')}, 6) AS sqrt_renta,
       round({_dv('r', '(t + 1)')}, 6) AS renta_antiguedad_ratio,
       round(CASE WHEN r > -1 THEN ln(1 + r) ELSE 0.0 END, 6) AS log_renta,
       round({_dv('r', 'cm')}, 6) AS renta_vs_country_mean
FROM feat"""

ORACLES.update({
    "f1_coerce_numeric": _q(
        "SELECT ncodpers, q, age, CASE WHEN antiguedad = -999999 THEN NULL ELSE antiguedad END "
        "AS antiguedad, renta FROM panel"),
    "f2_medians": _p("SELECT ma AS median_age, mt AS median_antiguedad, mr AS median_renta FROM med"),
    "f3_modes": _p(_MODES_SQL),
    "f5_total_products": _q(f"SELECT ncodpers, q, CAST({_FLAG_SUM} AS DOUBLE) AS total_products FROM panel"),
    "f6_age_intervals": _p("SELECT i, lo, hi FROM ivs"),
    "f7_date_cohorts": _p("SELECT i, left_days, right_days, label FROM cohort_spec"),
    "f9_rare_values": _p("""
SELECT "column", value, share FROM (
  SELECT "column", value, count(*) / sum(count(*)) OVER (PARTITION BY "column") AS share FROM (
    SELECT 'segmento' AS "column", coalesce(segmento, 'nan') AS value FROM work
    UNION ALL SELECT 'pais_residencia', coalesce(pais_residencia, 'nan') FROM work
    UNION ALL SELECT 'canal_entrada', coalesce(canal_entrada, 'nan') FROM work
    UNION ALL SELECT 'fecha_alta', coalesce((SELECT s.label FROM cohort_spec s
        WHERE CAST(w.fecha_alta - (SELECT base FROM dbase) AS BIGINT) > s.left_days
          AND CAST(w.fecha_alta - (SELECT base FROM dbase) AS BIGINT) <= s.right_days), 'unknown')
      FROM work w)
  GROUP BY 1, 2) WHERE share < 0.04"""),
    "f10_clip_bounds": _p(
        "SELECT 'renta' AS \"column\", round(rlo, 6) AS lo, round(rhi, 6) AS hi FROM clip "
        "UNION ALL SELECT 'antiguedad', round(tlo, 6), round(thi, 6) FROM clip"),
    "g6_apply_preprocessing": _p(
        "SELECT ncodpers, q, age, age_interval, fecha_alta, antiguedad, renta, segmento, "
        "pais_residencia, canal_entrada, total_products FROM applied"),
    "h3_group_stats": _p(
        "SELECT pais_residencia, round(avg(renta), 6) AS mean_renta, "
        "quantile_cont(antiguedad, 0.5) AS median_antiguedad FROM applied_train GROUP BY 1"),
    "h5_features": _p(_FEATURES_SQL.replace("\n, gstat", ",\ngstat", 1)),
    "h8_quality_check": _p(
        "SELECT " + ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in [
            "antiguedad", "renta", "antiguedad_plus_renta", "antiguedad_div_renta",
            "renta_div_antiguedad", "antiguedad_times_renta", "ln_antiguedad", "ln_renta",
            "sqrt_antiguedad", "sqrt_renta", "renta_antiguedad_ratio", "log_renta",
            "renta_vs_country_mean"]) + " FROM (SELECT count(*) FROM applied)"),
    "e1_calendar_split": _q(
        "SELECT split, count(*) AS rows, count(DISTINCT ncodpers) AS clients, "
        "CAST(min(snapshot_date) AS VARCHAR) AS first_snapshot, "
        "CAST(max(snapshot_date) AS VARCHAR) AS last_snapshot FROM frame GROUP BY split"),
    "e2_cohort_split": _q("""
, cut AS (SELECT DATE '1970-01-01' + CAST(floor(quantile_cont(CAST(fecha_alta - DATE '1970-01-01' AS BIGINT), 0.7)) AS INTEGER) AS c FROM frame)
SELECT CAST((SELECT c FROM cut) AS VARCHAR) AS cutoff,
       CASE WHEN fecha_alta > (SELECT c FROM cut) THEN 'test' ELSE 'train' END AS part,
       count(*) AS rows
FROM frame GROUP BY 2""".replace("\n, cut", ",\ncut", 1)),
    "e3_stratified_sample": _q("""
SELECT purchase, CAST(greatest(round_even(count(*) * 0.15, 0), least(count(*), 50)) AS BIGINT) AS n
FROM frame WHERE split = 'train' GROUP BY purchase"""),
})


# --- B twins -------------------------------------------------------------------

_SLICE = "DATE '1999-10-01'"


def _null_union() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS s FROM panel"
        for c in PANEL_COLUMNS)


def _summary(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_unique, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
  round(avg({c}), 6) AS mean,
  round(avg(power({c} - (SELECT avg({c}) FROM panel), 3)) /
        power(avg(power({c} - (SELECT avg({c}) FROM panel), 2)), 1.5), 6) AS skew,
  round(kurtosis_pop({c}), 6) AS kurt, count({c}) AS count, round(stddev_samp({c}), 6) AS std,
  min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(quantile_cont({c}, 0.95), 6) AS p95,
  round(quantile_cont({c}, 0.99), 6) AS p99, max({c}) AS max
FROM panel"""


_PEN = "\nUNION ALL\n".join(
    f"SELECT '{p}' AS product, avg(CAST({p} AS DOUBLE)) * 100 AS pen FROM panel" for p in PRODUCTS)


def _pen_by(by: str, where: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {by}, '{p}' AS product, round(avg(CAST({p} AS DOUBLE)) * 100, 6) AS penetration "
        f"FROM panel {where} GROUP BY {by}" for p in PRODUCTS)


_VS_COLS = [c for c in PANEL_COLUMNS if c != "ncodpers"]
_VS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM panel WHERE fecha_dato = {_SLICE}"
    for c in _VS_COLS)
_DUP_COLS = ", ".join(c for c in PANEL_COLUMNS if c not in ("ncodpers", "q"))
_LABELS_SQL = " UNION ALL ".join(
    f"SELECT '{k}' AS \"column\", '{v}' AS label" for k, v in {
        "ncodpers": "client id", "fecha_dato": "snapshot date",
        "q": "snapshot index (quarters since 1995)", "age": "age",
        "fecha_alta": "date of the first contract", "antiguedad": "tenure in months",
        "renta": "household income", "segmento": "client segment",
        "pais_residencia": "country of residence", "canal_entrada": "acquisition channel",
        **{p: f"owns product {p[-2:]}" for p in PRODUCTS}}.items())

ORACLES.update({
    "b1_null_share": _q(f"SELECT \"column\", round(s, 9) AS null_share FROM ({_null_union()}) WHERE s > 0"),
    "b2_date_range": _q(
        "SELECT 'fecha_alta' AS \"column\", CAST(min(fecha_alta) AS VARCHAR) AS min_date, "
        "CAST(max(fecha_alta) AS VARCHAR) AS max_date, count(*) FILTER (WHERE fecha_alta IS NULL) AS nulls, "
        "avg(CASE WHEN fecha_alta IS NULL THEN 1 ELSE 0 END) AS null_share FROM panel"),
    "b3_monthly_counts": _q(
        "SELECT CAST(date_trunc('month', fecha_alta) AS DATE)::VARCHAR AS month, count(*) AS n "
        "FROM panel GROUP BY 1"),
    "b4_numeric_summary": _q("\nUNION ALL\n".join(_summary(c) for c in ("age", "antiguedad", "renta"))),
    "b5_histogram": _q("""
, mm AS (SELECT min(renta) AS mn, max(renta) AS mx, (max(renta) - min(renta)) / 10 AS w FROM panel)
SELECT 'renta' AS "column", CAST(bin AS INTEGER) AS bin, round(mn + bin * w, 6) AS lo,
       round(mn + (bin + 1) * w, 6) AS hi, count(*) AS n
FROM (SELECT least(floor((renta - mn) / w), 9) AS bin, mn, w FROM panel CROSS JOIN mm
      WHERE renta IS NOT NULL)
GROUP BY bin, mn, w""".replace("\n, mm", ",\nmm", 1)),
    "b6_penetration": _q(f"SELECT product, round(pen, 6) AS penetration, pen < 1.0 AS below_1pct FROM ({_PEN})"),
    "b7_penetration_selection": _q(
        f"SELECT product, round(pen, 6) AS penetration, round(pen, 6) > 5.0 AS selected, "
        f"round(pen, 6) < 0.25 AS outsider FROM ({_PEN})"),
    "b8_penetration_by_segment": _q(_pen_by("segmento", f"WHERE fecha_dato = {_SLICE}")),
    "b8_penetration_by_snapshot": _q(
        f"SELECT CAST(fecha_dato AS VARCHAR) AS fecha_dato, product, penetration FROM ({_pen_by('fecha_dato')})"),
    "b9_value_shares": _q(f"""
SELECT "column", value, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY "column") AS share
FROM ({_VS}) GROUP BY 1, 2"""),
    "b10_exact_duplicates": _q(
        f"SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT {_DUP_COLS} FROM panel)) AS distinct_rows, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {_DUP_COLS} FROM panel)) AS duplicates FROM panel"),
    "b11_functional_dependency": _q("""
SELECT 'ncodpers->segmento' AS direction, count(*) AS violations FROM (
  SELECT ncodpers FROM panel GROUP BY 1 HAVING count(DISTINCT segmento) > 1)
UNION ALL
SELECT 'segmento->ncodpers', count(*) FROM (
  SELECT segmento FROM panel GROUP BY 1 HAVING count(DISTINCT ncodpers) > 1)"""),
    "b13_active_periods": _q(
        "SELECT ncodpers, code, CAST(min(fecha_dato) AS VARCHAR) AS start, "
        "CAST(max(fecha_dato) AS VARCHAR) AS \"end\" FROM (SELECT ncodpers, fecha_dato, unnest(owned) AS code FROM panel) "
        "GROUP BY 1, 2"),
    "b15_snapshot_slice": _q(f"SELECT {_PANEL_SELECT} FROM panel WHERE fecha_dato = {_SLICE}"),
    "b16_panel_volume": _q(
        f"SELECT count(*) AS rows, {len(PANEL_COLUMNS)} AS columns, count(DISTINCT fecha_dato) AS snapshots, "
        "count(DISTINCT ncodpers) AS clients, (SELECT count(DISTINCT ncodpers) FROM events) AS event_clients FROM panel"),
    "b17_column_dictionary": _q(f"""
SELECT l."column", l.label, round(coalesce(n.s, 0.0), 9) AS null_share
FROM ({_LABELS_SQL}) l LEFT JOIN (SELECT * FROM ({_null_union()}) WHERE s > 0) n ON n."column" = l."column\""""),
})


# --- K twins ---------------------------------------------------------------------

_REF_END = "TIMESTAMP '2024-01-16 00:00:00'"
_DECILES = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"

DRIFT = f"""
obs AS (
  SELECT event_id, ts, feature, v FROM (
    SELECT event_id, ts, 'value' AS feature, CAST(value AS DOUBLE) AS v FROM events
    UNION ALL
    SELECT event_id, ts, 'k', TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) FROM events)
  WHERE v IS NOT NULL AND isfinite(v)
),
refv AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(v, {_DECILES}))) AS e
  FROM obs WHERE ts < {_REF_END} GROUP BY feature
  HAVING count(DISTINCT v) >= 2 AND len(list_distinct(quantile_cont(v, {_DECILES}))) >= 3
),
binned AS (
  SELECT o.event_id, o.ts, o.feature, o.v, len(list_filter(r.e[2:len(r.e) - 1], lambda x: x <= o.v)) AS bin
  FROM obs o JOIN refv r ON r.feature = o.feature
),
refs AS (
  SELECT feature, bin, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS share
  FROM binned WHERE ts < {_REF_END} GROUP BY feature, bin
),
allbins AS (SELECT feature, CAST(unnest(range(0, len(e) - 1)) AS INTEGER) AS bin FROM refv),
later AS (SELECT * FROM binned WHERE ts >= {_REF_END})"""


def _psi_sql(src: str, keys: str = "") -> str:
    """PSI per (keys, feature) of binned rows in ``src`` (columns keys..., feature, bin)."""
    k = (keys + ", ") if keys else ""
    kj = " AND ".join(f"g.{x.strip()} = c.{x.strip()}" for x in keys.split(",")) if keys else ""
    return f"""
SELECT {k}feature, sum((r - o) * ln(r / o)) AS psi, sum(n) AS samples FROM (
  SELECT {k}feature, n, r / sum(r) OVER (PARTITION BY {k}feature) AS r,
         o / sum(o) OVER (PARTITION BY {k}feature) AS o FROM (
    SELECT {', '.join('g.' + x.strip() for x in keys.split(',')) + ', ' if keys else ''}g.feature, g.bin,
           coalesce(c.n, 0) AS n, greatest(coalesce(rs.share, 0), 0.001) AS r,
           greatest(coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY {', '.join('g.' + x.strip() for x in keys.split(',')) + ', ' if keys else ''}g.feature), 0.001) AS o
    FROM (SELECT DISTINCT {k}s.feature, a.bin FROM {src} s JOIN allbins a ON a.feature = s.feature) g
    LEFT JOIN (SELECT {k}feature, bin, count(*) AS n FROM {src} GROUP BY ALL) c
      ON c.feature = g.feature AND c.bin = g.bin {('AND ' + kj) if kj else ''}
    LEFT JOIN refs rs ON rs.feature = g.feature AND rs.bin = g.bin))
GROUP BY ALL"""


def _k(body: str) -> str:
    return "WITH " + DRIFT + "\n" + body


_LASTN = """, lastn AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY ts DESC, event_id DESC) AS rn
                 FROM later) WHERE rn <= 2000),
win AS (
  SELECT f.feature, coalesce(p.samples, 0) AS samples,
         CASE WHEN coalesce(p.samples, 0) >= 200 THEN round(p.psi, 9) END AS psi,
         CASE WHEN coalesce(p.samples, 0) < 200 THEN 'collecting'
              WHEN p.psi >= 0.25 THEN 'significant' WHEN p.psi >= 0.1 THEN 'moderate'
              ELSE 'ok' END AS status
  FROM refv f LEFT JOIN (""" + _psi_sql("lastn") + """) p ON p.feature = f.feature)"""

_LOG = """
log AS (
  SELECT event_id, ts, event_type AS endpoint, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         value AS latency_ms, event_type <> 'error' AS success,
         CASE WHEN event_type = 'error' THEN 'HTTP 500' END AS error
  FROM events
),
slide AS (
  SELECT time_bucket(INTERVAL '1 minute', ts) - i * INTERVAL '1 minute' AS window_start, *
  FROM log CROSS JOIN (SELECT range AS i FROM range(0, 5)) r
)"""

ORACLES.update({
    "k1_psi": _k("SELECT feature, round(psi, 9) AS psi, samples FROM (" + _psi_sql("later") + ")"),
    "k2_valid_observations": _k(
        "SELECT feature, count(*) AS n FROM obs GROUP BY feature "
        "UNION ALL SELECT 'observed_total', count(DISTINCT event_id) FROM obs"),
    "k3_window_psi": _k(_LASTN.replace(", lastn AS", ",\nlastn AS", 1)
                        + "\nSELECT feature, samples, psi, status FROM win"),
    "k4_drift_report": _k(_LASTN.replace(", lastn AS", ",\nlastn AS", 1) + """
SELECT CASE WHEN count(*) = 0 THEN 'no_reference'
            WHEN count(*) FILTER (WHERE status = 'significant') > 0 THEN 'significant'
            WHEN count(*) FILTER (WHERE status = 'moderate') > 0 THEN 'moderate'
            WHEN count(*) FILTER (WHERE status = 'collecting') > 0 THEN 'collecting'
            ELSE 'ok' END AS status, count(*) AS features FROM win"""),
    "k5_drift_alert": _k(""",
tw AS (SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start, feature, bin FROM later),
pw AS (""" + _psi_sql("tw", "window_start") + """)
SELECT CAST(window_start AS VARCHAR) AS window_start, feature, round(psi, 9) AS psi,
       count(*) OVER w = 3 AND min(psi) OVER w > 0.25 AS alert
FROM pw WINDOW w AS (PARTITION BY feature ORDER BY window_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""
                          .replace(",\ntw AS", ",\ntw AS", 1)),
    "k6_request_counters": "WITH " + _LOG + """
SELECT CAST(time_bucket(INTERVAL '5 minutes', ts) AS VARCHAR) AS window_start, endpoint, status,
       count(*) AS requests FROM log GROUP BY ALL""",
    "k7_latency_p95": "WITH " + _LOG + """
SELECT CAST(window_start AS VARCHAR) AS window_start, round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms,
       quantile_cont(latency_ms, 0.95) > 2000.0 AS over_slo FROM slide GROUP BY window_start""",
    "k8_error_rate": "WITH " + _LOG + """
SELECT CAST(window_start AS VARCHAR) AS window_start, count(*) FILTER (WHERE status >= 500) AS errors,
       count(*) AS requests, count(*) FILTER (WHERE status >= 500) / count(*) AS error_rate,
       count(*) FILTER (WHERE status >= 500) / count(*) > 0.01 AS over_slo FROM slide GROUP BY window_start""",
    "k9_slo_report": "WITH " + _LOG + """
SELECT total_requests, round(success_rate, 9) AS success_rate, round(coalesce(avg_latency, 0.0), 6) AS avg_latency,
       round(coalesce(p95, 0.0), 6) AS p95_latency, round(coalesce(p99, 0.0), 6) AS p99_latency,
       round(CASE WHEN span_us > 0 THEN total_requests / (span_us / 1e6) END, 6) AS rps,
       success_rate + 1e-9 >= 99.0 AND coalesce(p95, 0.0) + 1e-9 < 5000.0 AS slo_ok,
       concat_ws('; ', CASE WHEN NOT (success_rate + 1e-9 >= 99.0) THEN 'success rate below target' END,
                 CASE WHEN NOT (coalesce(p95, 0.0) + 1e-9 < 5000.0) THEN 'p95 at or above target' END) AS failures
FROM (SELECT count(*) AS total_requests, avg(CASE WHEN success THEN 1.0 ELSE 0.0 END) * 100 AS success_rate,
             avg(latency_ms) FILTER (WHERE success) AS avg_latency,
             quantile_cont(latency_ms, 0.95) FILTER (WHERE success) AS p95,
             quantile_cont(latency_ms, 0.99) FILTER (WHERE success) AS p99,
             epoch_us(max(ts)) - epoch_us(min(ts)) AS span_us FROM log)""",
    "k9_error_distribution": "WITH " + _LOG + "\nSELECT error, count(*) AS n FROM log WHERE error IS NOT NULL GROUP BY error",
})


# --- D / J13 / J14 twins -----------------------------------------------------

_POPLISTS = """,
hist AS (SELECT ncodpers, list(DISTINCT purchase) AS h FROM events
         WHERE fecha_dato <= DATE '""" + CUTOFF + """' GROUP BY ncodpers),
rel AS (SELECT ncodpers, list_sort(list(DISTINCT 'prod_' || lpad(CAST(purchase AS VARCHAR), 2, '0'))) AS relevant
        FROM events WHERE fecha_dato > DATE '""" + CUTOFF + """' GROUP BY ncodpers),
poplist AS (
  SELECT r.ncodpers, r.relevant,
         coalesce(list('prod_' || lpad(CAST(p.code AS VARCHAR), 2, '0') ORDER BY p.pop_rank)
                  FILTER (WHERE p.code IS NOT NULL AND (h.h IS NULL OR NOT list_contains(h.h, p.code))),
                  []) AS rec_all
  FROM rel r LEFT JOIN hist h ON h.ncodpers = r.ncodpers LEFT JOIN popord p ON TRUE
  GROUP BY r.ncodpers, r.relevant
),
lists AS (SELECT ncodpers, relevant, rec_all[1:10] AS recommended FROM poplist)"""


def _j13() -> str:
    return """
, firsthit AS (
  SELECT coalesce(list_filter(list_transform(range(1, len(recommended) + 1),
                                             lambda i: CASE WHEN list_contains(relevant, recommended[i]) THEN i END),
                              lambda x: x IS NOT NULL)[1], 0) AS rank,
         len(relevant) AS nrel
  FROM lists
)
SELECT k, count(*) AS users, count(*) FILTER (WHERE nrel > 0) AS purchasers,
       (count(*) FILTER (WHERE nrel > 0)) / count(*) AS purchase_share,
       avg(CASE WHEN rank > 0 AND rank <= k THEN 1.0 ELSE 0.0 END) / k AS precision_at_k,
       round(avg(CASE WHEN nrel > 0 THEN (CASE WHEN rank > 0 AND rank <= k THEN 1.0 ELSE 0.0 END) / nrel END), 9)
         AS recall_at_k,
       avg(CASE WHEN rank > 0 AND rank <= k THEN 1.0 ELSE 0.0 END) AS hit_rate_at_k,
       round(avg(CASE WHEN rank > 0 AND rank <= k THEN 1 / log2(rank + 1) ELSE 0.0 END), 9) AS ndcg_at_k,
       avg(nrel) AS relevant_per_user
FROM firsthit CROSS JOIN (VALUES (1), (3), (5), (10)) v(k) GROUP BY k"""


ORACLES.update({
    "d1_dense_codes": _q(
        "SELECT count(DISTINCT ncodpers) AS n, CAST(0 AS INTEGER) AS min_code, "
        "CAST(count(DISTINCT ncodpers) - 1 AS INTEGER) AS max_code, "
        "count(DISTINCT ncodpers) AS distinct_codes FROM panel"),
    "d2_interactions": _q(
        f"SELECT ncodpers, CAST(purchase AS INTEGER) AS item, count(*) AS rating FROM events "
        f"WHERE fecha_dato <= DATE '{CUTOFF}' GROUP BY 1, 2"),
    "j13_list_metrics": _e(_POPLISTS + _j13().replace("\n, firsthit AS", ",\nfirsthit AS", 1)),
    "j14_hit_trace": _e(_POPLISTS + """
SELECT ncodpers, array_to_string(recommended[1:5], ',') AS top_k,
       array_to_string(relevant, ',') AS relevant,
       len(list_intersect(recommended[1:5], relevant)) > 0 AS hit
FROM lists"""),
})

ORACLES.update({
    "i3_class_weights": _q(
        "SELECT purchase, count(*) AS n_c, round(sum(count(*)) OVER () / "
        "(count(*) OVER () * count(*)), 9) AS weight FROM frame WHERE split = 'train' GROUP BY purchase"),
})

ORACLES.update({
    "a2_schema_audit": _q(
        "SELECT 'ind_actividad_cliente' AS missing, 'q' AS extra, count(*) AS n_rows FROM panel"),
    "a5_lookup_dedupe": _q("""
SELECT ncodpers, q, recommended_product_id FROM (
  SELECT *, row_number() OVER (PARTITION BY ncodpers ORDER BY recommended_product_id IS NULL, q) AS rn
  FROM (SELECT ncodpers, q, CASE WHEN q % 3 = 0 THEN NULL
                                 ELSE 'prod_' || lpad(CAST(list_min(owned) AS VARCHAR), 2, '0') END
                            AS recommended_product_id FROM panel))
WHERE rn = 1"""),
    "a9_profile_ingest": "WITH " + PANEL_CTES + """
, r AS (SELECT CASE WHEN ncodpers % 7 = 1 AND age IS NOT NULL THEN 'malformed or wrong type' WHEN ncodpers % 11 = 1 THEN 'missing ncodpers' END AS reason,
               renta IS NOT NULL AND ncodpers % 5 <> 1 AS income, len(owned) AS flags FROM panel
        UNION ALL SELECT 'missing ncodpers', false, 0 FROM events)
SELECT CASE WHEN reason IS NULL THEN 'ok' ELSE 'rejected' END AS status, reason, count(*) AS n,
       count(*) FILTER (reason IS NULL AND income) AS incomes, CAST(sum(CASE WHEN reason IS NULL THEN flags ELSE 0 END) AS BIGINT) AS flags
FROM r GROUP BY ALL
""",
})

ORACLES.update({
    "c4_label_map": _q("""
SELECT CAST(code AS INTEGER) AS code,
       CASE WHEN code = 0 THEN 'no_purchase' WHEN code = 99 THEN 'other'
            ELSE 'prod_' || lpad(CAST(code AS VARCHAR), 2, '0') END AS name,
       is_candidate
FROM (SELECT code, true AS is_candidate FROM shortlist
      UNION ALL SELECT 0, false UNION ALL SELECT 99, false)"""),
    "c8_fold_to_other": _q("SELECT CAST(label0 AS INTEGER) AS purchase, count(*) AS n FROM folded GROUP BY 1"),
    "c9_rare_classes": _q(f"""
SELECT CAST(label0 AS INTEGER) AS rare_code, count(*) AS support FROM folded WHERE split = 'train'
GROUP BY label0 HAVING count(*) < {P.MIN_CLASS_SUPPORT} AND label0 NOT IN (0, 99)"""),
    "c11_relevant_products": _q("""
SELECT ncodpers, array_to_string(list_sort(list(DISTINCT 'prod_' || lpad(CAST(purchase AS VARCHAR), 2, '0'))), ',')
       AS products FROM events GROUP BY ncodpers"""),
    "c13_owned_products": _q("SELECT ncodpers, q, unnest(owned) AS code FROM panel"),
    "e4_stratified_folds": _q("""
SELECT purchase, CAST(f AS INTEGER) AS fold, CAST((n - f + 2) // 3 AS BIGINT) AS n
FROM (SELECT purchase, count(*) AS n FROM frame WHERE split = 'train' GROUP BY purchase)
CROSS JOIN (SELECT range AS f FROM range(3)) r WHERE n > f"""),
    "f4_imputation": _p("""
SELECT t.ncodpers, t.q, coalesce(t.age, m.ma) AS age, coalesce(t.antiguedad, m.mt) AS antiguedad,
       coalesce(t.renta, m.mr) AS renta
FROM ctest t CROSS JOIN med m"""),
    "f8_cohort_mismatches": _p("SELECT CAST(0 AS BIGINT) AS mismatches, count(*) AS rows FROM work"),
    "g1_age_interval": _p(
        "SELECT age_interval, count(*) AS n, min(age) AS min_age, max(age) AS max_age "
        "FROM applied GROUP BY 1"),
    "g2_date_cohort": _p("SELECT fecha_alta, count(*) AS n FROM applied GROUP BY 1"),
    "g5_clipping": _p(
        "SELECT min(renta) AS min_renta, max(renta) AS max_renta, min(antiguedad) AS min_antiguedad, "
        "max(antiguedad) AS max_antiguedad FROM applied"),
    "a8_report_sink": ORACLES["b6_penetration"],
})

ORACLES["b12_near_duplicates"] = """
WITH v AS (SELECT DISTINCT p_brand AS v FROM part WHERE p_brand IS NOT NULL),
s AS (SELECT a.v AS a, b.v AS b,
             1 - levenshtein(a.v, b.v) / greatest(length(a.v), length(b.v)) AS sim
      FROM v a CROSS JOIN v b WHERE a.v <> b.v)
SELECT a AS value, b AS match, round(sim, 9) AS similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b DESC) AS r FROM s WHERE sim >= 0.8)
WHERE r = 1"""


# --- twins of the single-item reports -----------------------------------------------

from ..functions.prep import LEGACY_DATE_INTERVALS  # noqa: E402

_A3_COLS = ["age", "fecha_alta", "antiguedad", "renta", "segmento", "pais_residencia",
            "canal_entrada", *PRODUCTS]


def _fixed_case(col: str, intervals: list[str]) -> str:
    whens = []
    for text in intervals:
        start, end = text.split(" – ")
        whens.append(f"WHEN {col} BETWEEN DATE '{start}' AND DATE '{end}' THEN '{text}'")
    return "CASE " + " ".join(whens) + " END"


def _sub(key: str, cols: list[str]) -> str:
    return f"SELECT ncodpers, q, {', '.join(cols)} FROM ({ORACLES[key]})"


ORACLES.update({
    "a3_column_pruning": _q(
        "SELECT " + ", ".join(_d(c) if c == "fecha_alta" else c for c in _A3_COLS)
        + " FROM frame WHERE split = 'test'"),
    "g3_fixed_intervals": _q(
        f"SELECT {_fixed_case('fecha_alta', LEGACY_DATE_INTERVALS['fecha_alta'])} AS interval, "
        "count(*) AS n FROM frame WHERE split = 'test' GROUP BY 1"),
    "g4_rare_folding": _p(""",
rare3 AS (
  SELECT "column", value FROM (
    SELECT "column", value, count(*) / sum(count(*)) OVER (PARTITION BY "column") AS share FROM (
      SELECT 'segmento' AS "column", coalesce(segmento, 'nan') AS value FROM work
      UNION ALL SELECT 'pais_residencia', coalesce(pais_residencia, 'nan') FROM work
      UNION ALL SELECT 'canal_entrada', coalesce(canal_entrada, 'nan') FROM work)
    GROUP BY 1, 2)
  WHERE share < 0.04
),
tv AS (
  SELECT 'pais_residencia' AS "column", CAST(pais_residencia AS VARCHAR) AS v FROM ftest
  UNION ALL SELECT 'canal_entrada', CAST(canal_entrada AS VARCHAR) FROM ftest
  UNION ALL SELECT 'segmento', CAST(segmento AS VARCHAR) FROM ftest
)
SELECT t."column", CASE WHEN r.value IS NOT NULL THEN 'other' ELSE t.v END AS value,
       count(*) AS n
FROM tv t LEFT JOIN rare3 r ON r."column" = t."column" AND r.value = t.v
GROUP BY 1, 2"""),
    "h1_pair_arithmetic": _sub("h5_features", [
        "antiguedad_plus_renta", "antiguedad_div_renta", "renta_div_antiguedad",
        "antiguedad_times_renta", "ln_antiguedad", "ln_renta", "sqrt_antiguedad", "sqrt_renta"]),
    "h2_ratio_log": _sub("h5_features", ["renta_antiguedad_ratio", "log_renta"]),
    "h4_relative_income": _sub("h5_features", ["renta_vs_country_mean"]),
    "h6_dedupe_columns": _p(
        "SELECT a.ncodpers, a.q, a.segmento, a.pais_residencia FROM applied a "
        "JOIN customer c ON c.c_custkey = a.ncodpers"),
})

# the cohort chain of PREP once more: over the whole panel, with 30 cohorts
_PANEL_COHORTS = PREP[PREP.index("dbase AS"):PREP.index("clip AS")].rstrip().rstrip(",").replace(
    "FROM work", "FROM panel").replace("least(12,", "least(30,").replace("range(0, 13)", "range(0, 31)")

ORACLES.update({
    "b14_eda_date_cohorts": "WITH " + BASE + ",\n" + _PANEL_COHORTS
    + "\nSELECT i, left_days, right_days, label FROM cohort_spec",
    "f11_drift_reference": "WITH " + BASE + PREP + """,
dvals AS (SELECT 'age' AS feature, CAST(age AS DOUBLE) AS v FROM ctrain WHERE age IS NOT NULL
          UNION ALL SELECT 'antiguedad', antiguedad FROM ctrain WHERE antiguedad IS NOT NULL
          UNION ALL SELECT 'renta', renta FROM ctrain WHERE renta IS NOT NULL),
dedges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(v, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
  FROM dvals GROUP BY feature HAVING min(v) < max(v)),
dbins AS (SELECT r.feature, len(list_filter(r.e[2:len(r.e) - 1], lambda x: x <= o.v)) AS bin
          FROM dvals o JOIN dedges r ON r.feature = o.feature),
dcount AS (SELECT feature, bin, count(*) AS n FROM dbins GROUP BY ALL),
dgrid AS (SELECT feature, e, unnest(range(0, len(e) - 1)) AS bin FROM dedges WHERE len(e) >= 3)
SELECT g.feature, CAST(g.bin AS INTEGER) AS bin, CASE WHEN g.bin > 0 THEN e[g.bin + 1] END AS lo,
       CASE WHEN g.bin < len(e) - 2 THEN e[g.bin + 2] END AS hi,
       round(coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY g.feature), 9) AS share
FROM dgrid g LEFT JOIN dcount c ON c.feature = g.feature AND c.bin = g.bin""",
})

# --- I1: prefix sums over the permutation, by window frames ------------------------

_TS_COLUMNS = ("segmento", "canal_entrada", "pais_residencia")
ORACLES["i1_ordered_target_stats"] = _q("""
, t AS (SELECT *, (ncodpers * 7919 + q * 104729) % 10007 AS place FROM frame WHERE split = 'train'),
cl AS (SELECT purchase, row_number() OVER (ORDER BY purchase) - 1 AS pos FROM (SELECT DISTINCT purchase FROM t)),
y AS (SELECT t.*, pos, CASE WHEN pos = 0 THEN 1 ELSE 0 END AS none FROM t JOIN cl USING (purchase)),
prior AS (SELECT avg(none) AS p0, avg(pos) AS pm FROM y)
SELECT ncodpers, q, """ + ", ".join(
    f"round((coalesce(sum({v}) OVER w_{c}, 0) + {p}) / (count(*) OVER w_{c} + 1), 9) AS {c}_{n}"
    for c in _TS_COLUMNS for v, p, n in (("none", "p0", "none"), ("pos", "pm", "mean"))) + " FROM y, prior WINDOW " + ", ".join(
    f"w_{c} AS (PARTITION BY {c} ORDER BY place, ncodpers, q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in _TS_COLUMNS))

# --- A1, B5, K5, K7, K8: raw files, box and Q-Q tables, held alerts -----------------

ORACLES["a1_csv_ingest"] = _q("""
SELECT CAST(fecha_dato AS VARCHAR) AS part, count(*) AS records, CAST(sum(ncodpers) AS BIGINT) AS clients, round(sum(CAST(renta AS DOUBLE)), 2) AS income
FROM panel WHERE ncodpers % 97 <> 0 AND ncodpers % 89 <> 0 AND ncodpers % 83 <> 0 GROUP BY fecha_dato
UNION ALL
SELECT CASE WHEN ncodpers % 97 = 0 OR ncodpers % 89 = 0 THEN 'malformed' ELSE 'no client' END, count(*), NULL, NULL
FROM panel WHERE ncodpers % 97 = 0 OR ncodpers % 89 = 0 OR ncodpers % 83 = 0 GROUP BY 1""")

ORACLES["b5_box"] = _q("\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
       round(min(x) FILTER (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
       round(max(x) FILTER (x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
       count(*) FILTER (x < q1 - 1.5 * (q3 - q1)) AS outliers_lo, count(*) FILTER (x > q3 + 1.5 * (q3 - q1)) AS outliers_hi
FROM (SELECT TRY_CAST({c} AS DOUBLE) AS x FROM panel) v,
     (SELECT quantile_cont(TRY_CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(TRY_CAST({c} AS DOUBLE), 0.5) AS q2,
             quantile_cont(TRY_CAST({c} AS DOUBLE), 0.75) AS q3 FROM panel) q""" for c in ("age", "antiguedad", "renta")))


def _horner(x: str, coefficients) -> str:
    out = "0.0"
    for c in coefficients:
        out = f"({out} * {x} + ({c!r}))"
    return out


from ..operators import profile as _B  # noqa: E402

_TAIL_SQL = lambda t: f"{_horner(t, _B._NORMAL_C)} / {_horner(t, _B._NORMAL_D)}"
_QQ = f""",
grid AS (SELECT i / 100.0 AS p FROM range(1, 100) AS r(i)),
inv AS (SELECT p, CASE WHEN p < {_B._NORMAL_TAIL} THEN {_TAIL_SQL('sqrt(-2 * ln(p))')}
                       WHEN p > 1 - {_B._NORMAL_TAIL} THEN -({_TAIL_SQL('sqrt(-2 * ln(1 - p))')})
                       ELSE (p - 0.5) * {_horner('((p - 0.5) * (p - 0.5))', _B._NORMAL_A)} / {_horner('((p - 0.5) * (p - 0.5))', _B._NORMAL_B)} END AS z FROM grid),
vals AS (SELECT list_sort(list(CAST(renta AS DOUBLE))) AS v, count(renta) AS nn FROM panel WHERE renta IS NOT NULL),
qq AS (SELECT 'renta' AS "column", round(p, 6) AS p, round(z, 6) AS theoretical,
              round(v[CAST(floor((nn - 1) * p) AS BIGINT) + 1] + ((nn - 1) * p - floor((nn - 1) * p))
                    * (v[CAST(ceil((nn - 1) * p) AS BIGINT) + 1] - v[CAST(floor((nn - 1) * p) AS BIGINT) + 1]), 6) AS sample
       FROM inv, vals)
"""
ORACLES["b5_qq_points"] = _q(_QQ.replace(",\ngrid", "\n, grid", 1) + "SELECT * FROM qq")
ORACLES["b5_qq_fit"] = _q(_QQ.replace(",\ngrid", "\n, grid", 1) + """SELECT "column", round(regr_slope(sample, theoretical), 6) AS slope,
  round(regr_intercept(sample, theoretical), 6) AS intercept, round(corr(theoretical, sample), 6) AS r FROM qq GROUP BY "column" """)

from ..functions import alerts as _L  # noqa: E402


def _held(points: str, hold: int, step: int, digits: int) -> str:
    """States of evaluations ``points`` (at in seconds, value, breached): an unbroken row of breaches by differences of numbers."""
    return f"""
, hits AS (SELECT moment, value, moment // {step} - row_number() OVER (ORDER BY moment) AS island FROM {points} WHERE breached),
since AS (SELECT moment, value, min(moment) OVER (PARTITION BY island) AS since FROM hits)
SELECT CAST(make_timestamp(p.moment * 1000000) AS VARCHAR) AS evaluated_at, round(p.value, {digits}) AS value,
       CASE WHEN s.since IS NULL THEN 'inactive' WHEN p.moment - s.since >= {hold} THEN 'firing' ELSE 'pending' END AS state,
       CAST(make_timestamp(s.since * 1000000) AS VARCHAR) AS since
FROM {points} p LEFT JOIN since s ON s.moment = p.moment"""


_BUCKET_SQL = "(SELECT count(*) FROM (VALUES " + ", ".join(f"({b})" for b in _L.LATENCY_BOUNDS) + ") AS t(b) WHERE b < latency_ms)"
ORACLES["k7_latency_hold"] = "WITH " + _LOG + f"""
, bounds AS (SELECT unnest(range({len(_L.LATENCY_BOUNDS)})) AS i, unnest([{", ".join(map(str, _L.LATENCY_BOUNDS))}]) AS upper),
wide AS (SELECT (epoch_us(ts) // 60000000 + k) * 60 AS moment, {_BUCKET_SQL} AS i FROM log, range(1, 6) AS r(k) WHERE latency_ms IS NOT NULL),
counted AS (SELECT moment, i, count(*) AS n FROM wide GROUP BY ALL),
run AS (SELECT moment, i, n, sum(n) OVER (PARTITION BY moment ORDER BY i) AS upto, sum(n) OVER (PARTITION BY moment) AS total FROM counted),
hit AS (SELECT moment, min(i) AS i FROM run WHERE upto >= 0.95 * total GROUP BY moment),
pts AS (SELECT moment, value, value > 100.0 AS breached FROM (
  SELECT run.moment, CASE WHEN run.i = {len(_L.LATENCY_BOUNDS)} THEN {_L.LATENCY_BOUNDS[-1]}
                      ELSE coalesce(b0.upper, 0.0) + (b1.upper - coalesce(b0.upper, 0.0)) * (0.95 * total - (upto - n)) / n END AS value
  FROM run JOIN hit ON hit.moment = run.moment AND hit.i = run.i LEFT JOIN bounds b1 ON b1.i = run.i LEFT JOIN bounds b0 ON b0.i = run.i - 1))""" + _held("pts", 600, 60, 6)
ORACLES["k8_error_hold"] = "WITH " + _LOG + """
, wide AS (SELECT (epoch_us(ts) // 60000000 + k) * 60 AS moment, status FROM log, range(1, 6) AS r(k)),
pts AS (SELECT moment, count(*) FILTER (status >= 500) / count(*) AS value, count(*) FILTER (status >= 500) / count(*) > 0.01 AS breached FROM wide GROUP BY moment)""" + _held("pts", 600, 60, 9)
ORACLES["k5_drift_hold"] = _k(""",
stepped AS (SELECT epoch_us(ts) // 600000000 AS step, feature, bin FROM later),
ends AS (SELECT min(step) AS a, max(step) AS b FROM stepped),
tw AS (SELECT (step + k + 1) * 600 AS moment, feature, bin FROM stepped, ends, range(0, 144) AS r(k) WHERE step + k <= b),
pw AS (""" + _psi_sql("tw", "moment") + """),
pts AS (SELECT moment, max(psi) AS value, max(psi) > 0.05 AS breached FROM pw WHERE samples >= 200 GROUP BY moment)""" + _held("pts", 1800, 600, 9))
