"""Score monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models, monitor, score_counts
from ..sources.writers import shared_folder
from .base import query

Q = [i / 10 for i in range(11)]
BASE, CUR = "(SELECT * FROM f_score WHERE side = 'base')", "(SELECT * FROM f_score WHERE side = 'cur')"


def _summary(src):
    ps = ", ".join(f"quantile_cont(score, {q}) AS p{i * 10}" for i, q in enumerate(Q))
    return f"""SELECT count(*) AS count, avg(score) AS mean, stddev_pop(score) AS std, min(score) AS min, max(score) AS max,
        quantile_cont(score, 0.5) AS median, {ps} FROM {src} s"""


PS = [f"p{i * 10}" for i in range(11)]


@query("Q1", _summary("f_score"), ["mean", "std", "median", *PS], digits=9)
def score_summary(t):
    return monitor.summarise(t.f_score, "score")


DECILES = f"""SELECT CAST(i AS INTEGER) AS decile, b[i + 1] AS base, c[i + 1] AS current, c[i + 1] - b[i + 1] AS diff
    FROM (SELECT unnest(range(11)) AS i, (SELECT quantile_cont(score, {Q}) FROM {BASE} x) AS b, (SELECT quantile_cont(score, {Q}) FROM {CUR} y) AS c)"""


@query("Q2", DECILES, ["base", "current", "diff"], digits=9)
def decile_shift(t):
    return monitor.decile_shift(t.base, t.cur, "score")


PSI = f"""SELECT sum((e - a) * ln(e / a)) AS psi FROM (
    SELECT CASE WHEN b = 0 THEN 1e-8 ELSE b / (sum(b) OVER () + 1e-8) END AS e, CASE WHEN c = 0 THEN 1e-8 ELSE c / (sum(c) OVER () + 1e-8) END AS a
    FROM (SELECT k, CAST(count(*) FILTER (WHERE side = 'base') AS DOUBLE) AS b, CAST(count(*) FILTER (WHERE side = 'cur') AS DOUBLE) AS c
          FROM (SELECT side, least(len(list_filter(cuts, lambda x: x <= score)), len(cuts) - 1) AS k
                FROM f_score, (SELECT list_sort(list_distinct(quantile_cont(score, {Q}))) AS cuts FROM {BASE} x)
                WHERE score BETWEEN cuts[1] AND cuts[len(cuts)]) GROUP BY k))"""


@query("Q3", PSI, ["psi"], digits=9)
def psi(t):
    return monitor.psi(t.base, t.cur, "score")


KS = """SELECT max(abs(CAST(cb AS DOUBLE) / nb - CAST(cc AS DOUBLE) / nc)) AS ks_stat, max(nb) AS nb, max(nc) AS nc FROM (
    SELECT sum(b) OVER (ORDER BY score) AS cb, sum(c) OVER (ORDER BY score) AS cc, sum(b) OVER () AS nb, sum(c) OVER () AS nc
    FROM (SELECT score, count(*) FILTER (WHERE side = 'base') AS b, count(*) FILTER (WHERE side = 'cur') AS c FROM f_score GROUP BY score))"""
KS_FULL = f"""SELECT ks_stat, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest(
    (SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * lam * lam)) FROM (SELECT unnest(range(1, 101)) AS k)), 0.0), 1.0) END AS ks_pvalue
    FROM (SELECT ks_stat, sqrt(CAST(nb AS DOUBLE) * nc / (nb + nc)) * ks_stat AS lam FROM ({KS}) k) l"""


@query("Q4", KS_FULL, ["ks_stat", "ks_pvalue"], digits=9)
def ks(t):
    return monitor.ks(t.base, t.cur, "score")


def _auc(by):
    part, lead = (f"PARTITION BY {by}", f"{by}, ") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {lead}CASE WHEN max(p) > 0 AND max(n) > 0 THEN sum(pos * (cn - neg * 0.5)) / (CAST(max(p) AS DOUBLE) * max(n)) END AS roc_auc,
      2 * CASE WHEN max(p) > 0 AND max(n) > 0 THEN sum(pos * (cn - neg * 0.5)) / (CAST(max(p) AS DOUBLE) * max(n)) END - 1 AS gini FROM (
      SELECT *, CAST(sum(neg) OVER ({part} ORDER BY score) AS DOUBLE) AS cn, sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n
      FROM (SELECT {lead}score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM f_score GROUP BY {lead}score)) {group}"""


@query("Q5 Q9", _auc(""), ["roc_auc", "gini"], digits=9)
def roc_auc(t):
    return monitor.roc_auc(t.f_score, "score", "label")


@query("Q5 Q9", _auc("side"), ["roc_auc", "gini"], digits=9)
def roc_auc_by_side(t):
    return monitor.roc_auc(t.f_score, "score", "label", ["side"])


def _cells(by=""):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""(SELECT {lead}count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
      count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp FROM f_score {group})"""


def _metrics(by=""):
    lead = f"{by}, " if by else ""
    return f"""SELECT {lead}CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS "precision",
      CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS recall,
      CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM {_cells(by)} c"""


PRF = ['"precision"', "recall", "f1"]


@query("Q6", f"SELECT round(\"precision\", 9) AS \"precision\", round(recall, 9) AS recall, round(f1, 9) AS f1 FROM ({_metrics()}) m")
def classification_metrics(t):
    m = monitor.classification_metrics(t.f_score, "score", "label")
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("Q7", f"SELECT side, tn, fp, fn, tp FROM {_cells('side')} c")
def confusion(t):
    return monitor.confusion(t.f_score, "score", "label", by=["side"])


REPORT = f"""SELECT class, round("precision", 9) AS "precision", round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM (
  WITH k AS (SELECT CAST(tn AS DOUBLE) tn, CAST(fp AS DOUBLE) fp, CAST(fn AS DOUBLE) fn, CAST(tp AS DOUBLE) tp FROM {_cells()} c),
  d AS (SELECT '0' AS class, tn / (tn + fn) AS "precision", tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fn + fp) AS f1, CAST(tn + fp AS BIGINT) AS support FROM k
        UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fn + fp), CAST(fn + tp AS BIGINT) FROM k)
  SELECT * FROM d
  UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), CAST(tp + tn + fp + fn AS BIGINT) FROM k
  UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM d
  UNION ALL SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM d) r"""


@query("Q7", REPORT)
def classification_report(t):
    r = monitor.classification_report(t.f_score, "score", "label")
    return r.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("Q8", """
    SELECT side, score AS threshold, CAST(n - coalesce(bn, 0) AS DOUBLE) / n AS fpr, CAST(p - coalesce(bp, 0) AS DOUBLE) / p AS tpr FROM (
      SELECT *, sum(pos) OVER w AS bp, sum(neg) OVER w AS bn, sum(pos) OVER (PARTITION BY side) AS p, sum(neg) OVER (PARTITION BY side) AS n
      FROM (SELECT side, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM f_score GROUP BY side, score)
      WINDOW w AS (PARTITION BY side ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    UNION ALL SELECT DISTINCT side, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM f_score""", ["fpr", "tpr"], digits=9)
def roc_curve(t):
    return monitor.roc_curve(t.f_score, "score", "label", ["side"])


@query("T5 Q5 Q6", f"""SELECT a.side, round(roc_auc, 9) AS roc_auc, round(gini, 9) AS gini, round("precision", 9) AS "precision", round(recall, 9) AS recall,
    round(f1, 9) AS f1 FROM ({_auc('side')}) a JOIN ({_metrics('side')}) m ON m.side = a.side""")
def evaluate_by_split(t):
    e = monitor.evaluate(t.f_score, "score", "label", ["side"])
    return e.select("side", *[F.round(c, 9).alias(c) for c in ("roc_auc", "gini", "precision", "recall", "f1")])


MOVED = "(SELECT * REPLACE (score + (row_id % 3) * CAST(0.25 AS DOUBLE) AS score) FROM f_score)"


@query("T7 K4 T5", f"""SELECT max_by(model, roc_auc) AS best_model, max(roc_auc) AS roc_auc FROM (
    SELECT 'plain' AS model, side, roc_auc FROM ({_auc('side')}) a UNION ALL
    SELECT 'moved', side, roc_auc FROM ({_auc('side').replace('f_score', MOVED)}) b) c WHERE side = 'base'""", ["roc_auc"], digits=9)
def best_of_fixed_scores(t):
    rows = t.f_score.withColumnRenamed("side", "split")
    moved = rows.withColumn("score", F.col("score") + F.col("row_id") % 3 * F.lit(0.25))
    table = models.compare({n: monitor.evaluate(df, "score", "label") for n, df in (("plain", rows), ("moved", moved))})
    return models.best_model(table, "base")


@query("Q10", f"""SELECT psi, CASE WHEN psi >= 0.3 THEN 'critical' WHEN psi >= 0.2 THEN 'warning' ELSE 'ok' END AS status,
    CASE WHEN psi >= 0.3 THEN 2 WHEN psi >= 0.2 THEN 1 ELSE 0 END AS code FROM ({PSI}) p""", ["psi"], digits=9)
def drift_status(t):
    return monitor.drift_status(monitor.psi(t.base, t.cur, "score"))


# Purchases score twice as high on the current side: a drift past the critical bound.
SHIFTED = PSI.replace("FROM f_score,", "FROM (SELECT side, CASE WHEN side = 'cur' THEN score * score ELSE score END AS score FROM f_score) f,")


@query("Q10 Q3", f"""SELECT psi, CASE WHEN psi >= 0.3 THEN 'critical' WHEN psi >= 0.2 THEN 'warning' ELSE 'ok' END AS status,
    CASE WHEN psi >= 0.3 THEN 2 WHEN psi >= 0.2 THEN 1 ELSE 0 END AS code FROM ({SHIFTED}) p""", ["psi"], digits=9)
def drift_status_shifted(t):
    shifted = t.cur.withColumn("score", F.col("score") * F.col("score"))
    return monitor.drift_status(monitor.psi(t.base, shifted, "score"))


@query("J12", """SELECT p.msno, p.snapshot_date, p.row_id, l.is_churn AS label, l.msno IS NOT NULL AS matched
    FROM f_score p LEFT JOIN f_label l ON l.msno = p.msno AND l.snapshot_date = p.snapshot_date""")
def score_vs_label(t):
    return monitor.score_vs_label(t.f_score.select("msno", "snapshot_date", "row_id"), t.f_label, "is_churn")


def _melt(section, sql, cols):
    return " UNION ALL ".join(f"SELECT '{section}' AS section, '{c}' AS metric, CAST(\"{c}\" AS DOUBLE) AS value FROM ({sql}) x" for c in cols)


STATS = ["count", "mean", "std", "min", "max", "median", *PS]
MATCHED = """(SELECT p.score, l.is_churn AS label FROM f_score p JOIN f_label l ON l.msno = p.msno AND l.snapshot_date = p.snapshot_date WHERE p.side = 'cur')"""
UNMATCHED = f"SELECT (SELECT count(*) FROM {MATCHED} m) AS matched, (SELECT count(*) FROM {CUR} c) - (SELECT count(*) FROM {MATCHED} m) AS unmatched"


@query("Q11 Q1 Q2 Q3 Q4 Q10 J12", " UNION ALL ".join([
    _melt("baseline_summary", _summary(BASE), STATS), _melt("current_summary", _summary(CUR), STATS),
    _melt("drift", KS_FULL, ["ks_stat", "ks_pvalue"]),
    _melt("drift", f"SELECT psi, CASE WHEN psi >= 0.3 THEN 2 WHEN psi >= 0.2 THEN 1 ELSE 0 END AS code FROM ({PSI}) p", ["psi", "code"]),
    *[f"SELECT 'deciles' AS section, '{c}_d' || CAST(decile AS VARCHAR) AS metric, {c} AS value FROM ({DECILES}) d" for c in ("base", "current", "diff")],
    _melt("label_metrics", UNMATCHED, ["matched", "unmatched"]),
    _melt("label_metrics", _auc("").replace("f_score", MATCHED), ["roc_auc", "gini"]),
    _melt("label_metrics", _metrics().replace("f_score", MATCHED), ["precision", "recall", "f1"]),
]), ["value"], digits=8)
def monitoring_report(t):
    return monitor.monitor(t.base, t.cur, "score", t.f_label)


COUNTED = """SELECT 'm' AS model_file, snapshot_date, score, count(score) AS n, count(*) FILTER (WHERE score IS NOT NULL AND label = 1) AS pos,
    count(*) FILTER (WHERE score IS NOT NULL AND label = 0) AS neg, count(*) FILTER (WHERE label IS NOT NULL) AS matched, count(*) AS rows
    FROM f_score GROUP BY snapshot_date, score"""


def _counts_path(t):
    """State of all scoring runs: a first run without labels, then one that knows them and replaces it."""
    path, scored = shared_folder(t.spark), t.f_score.withColumn("model_file", F.lit("m"))
    score_counts.write_counts(scored.where(F.dayofmonth("snapshot_date") <= 15), path, "score")
    score_counts.write_counts(scored, path, "score", "label")
    return path


@query("Q1 Q11 S8 S11", COUNTED)
def score_counts_state(t):
    return t.spark.read.parquet(_counts_path(t)).select("model_file", "snapshot_date", "score", *score_counts.COUNTS)


DAY, FIRST, LAST = "2024-01-20", "2024-01-08", "2024-01-14"
ONE_DAY = f"(SELECT * FROM f_score WHERE snapshot_date = DATE '{DAY}')"
BASE_DAYS = f"(SELECT * FROM f_score WHERE snapshot_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}')"
SIDES = f"(SELECT *, 'base' AS side FROM (SELECT * EXCLUDE side FROM f_score) x WHERE snapshot_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}' UNION ALL SELECT *, 'cur' AS side FROM (SELECT * EXCLUDE side FROM f_score) x WHERE snapshot_date = DATE '{DAY}')"


def _on_days(sql):
    return sql.replace("f_score", SIDES)


@query("Q1 Q2 Q3 Q4 Q5 Q6 Q9 Q10 Q11 Q12", f"""SELECT 'm' AS model_file, DATE '{DAY}' AS snapshot_date, DATE '{FIRST}' AS baseline_start,
    DATE '{LAST}' AS baseline_end, section, metric, value FROM (""" + " UNION ALL ".join([
    _melt("baseline_summary", _summary(BASE_DAYS), STATS), _melt("current_summary", _summary(ONE_DAY), STATS),
    _melt("drift", _on_days(KS_FULL), ["ks_stat", "ks_pvalue"]),
    _melt("drift", _on_days(f"SELECT psi, CASE WHEN psi >= 0.3 THEN 2 WHEN psi >= 0.2 THEN 1 ELSE 0 END AS code FROM ({PSI}) p"), ["psi", "code"]),
    *[f"SELECT 'deciles' AS section, '{c}_d' || CAST(decile AS VARCHAR) AS metric, {c} AS value FROM ({_on_days(DECILES)}) d" for c in ("base", "current", "diff")],
    _melt("label_metrics", f"SELECT count(*) AS matched, 0 AS unmatched FROM {ONE_DAY} x", ["matched", "unmatched"]),
    _melt("label_metrics", _auc("").replace("f_score", ONE_DAY), ["roc_auc", "gini"]),
    _melt("label_metrics", _metrics().replace("f_score", ONE_DAY), ["precision", "recall", "f1"]),
]) + ") r", ["value"], digits=8)
def monitoring_report_of_a_date(t):
    return score_counts.monitor_counts(t.spark, _counts_path(t), "m", DAY, (FIRST, LAST))


@query("T9", """SELECT msno, snapshot_date, 1 / (1 + exp(-(-1.5 + coalesce(CAST(plan_list_price AS DOUBLE), 0) * 0.002 + coalesce(CAST(is_cancel AS DOUBLE), 0) * 1.25)))
    AS churn_proba, 'linear' AS model_file FROM (SELECT *, transaction_date AS snapshot_date FROM f_txn) f""", ["churn_proba"], digits=9)
def score_linear(t):
    df = t.f_txn.withColumn("snapshot_date", F.col("transaction_date"))
    return models.score_linear(df, {"plan_list_price": 0.002, "is_cancel": 1.25}, -1.5)
