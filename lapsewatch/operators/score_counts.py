"""Counts per distinct score: the state that monitoring keeps between scoring runs.

A scoring run adds one partition per (model, snapshot date): how many rows have each score and, once labels are
known, how many of them are positive, negative and matched. Counts of several dates add up, so every statistic of a
report (summary, deciles, PSI, KS, AUC, threshold metrics) comes from these tables alone, whatever the number of
predictions behind them, and a report for another date reads only that date's partition.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import running_counts
from ..sources.writers import materialise, write_table

KEYS = ("model_file", "snapshot_date")
DECILES = [i / 10 for i in range(11)]
COUNTS = ("n", "pos", "neg", "matched", "rows")


def count_scores(
    preds: DataFrame, score: str, keys: Sequence[str] = KEYS, label: str | None = None, matched: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """keys..., score, n, pos, neg, matched, rows: one row per distinct score, NULL scores included with n = 0.

    ``n`` counts scored rows, ``pos`` and ``neg`` those with label 1 and 0, ``matched`` rows whose label was found,
    scored or not, ``rows`` all rows. Without a label column these counts are 0. Partial counts meet before the shuffle.
    With ``digits`` scores are rounded first, which bounds the table.
    """
    s = F.col(score).cast("double")
    s = s if digits is None else F.round(s, digits)
    y = F.when(s.isNotNull(), F.col(label).cast("int")) if label else F.lit(None).cast("int")
    found = F.coalesce(F.col(matched), F.lit(False)) if matched else (F.col(label).isNotNull() if label else F.lit(False))
    return preds.groupBy(*keys, s.alias("score")).agg(
        F.count(s).alias("n"), F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"),
        F.count_if(found).alias("matched"), F.count(F.lit(1)).alias("rows"))


def write_counts(preds: DataFrame, path: str, score: str = "churn_proba", label: str | None = None, matched: str | None = None) -> None:
    """Add the counts of a scoring run; a rerun, or a run that knows the labels, replaces its own models and dates."""
    write_table(count_scores(preds, score, KEYS, label, matched), path, KEYS, "overwrite_partitions")


def read_counts(spark: SparkSession, path: str, model: str, first: str, last: str | None = None) -> DataFrame:
    """Counts of one model on one date or a range of dates, added up; only those partitions are read."""
    day = F.col("snapshot_date")
    rows = spark.read.parquet(path).where(
        (F.col("model_file") == model) & day.between(F.lit(first).cast("date"), F.lit(last or first).cast("date")))
    return rows.groupBy("score").agg(*[F.sum(c).alias(c) for c in COUNTS])


def compared(base: DataFrame, cur: DataFrame) -> DataFrame:
    """Counts of two sides side by side: s, b, c, and the label counts of the current side."""
    left = base.selectExpr("score AS s", "n AS b", "0L AS c", "0L AS pos", "0L AS neg", "0L AS matched", "0L AS rows")
    right = cur.selectExpr("score AS s", "0L AS b", "n AS c", "pos", "neg", "matched", "rows")
    return left.unionByName(right).groupBy("s").agg(*[F.sum(c).alias(c) for c in ("b", "c", "pos", "neg", "matched", "rows")])


def deciles_sql(n: str, probs: Sequence[float] = DECILES) -> str:
    """Aggregate over ranked counts: quantiles of one side as an array, each interpolated between its two neighbours."""
    values = []
    for p in probs:
        pos = f"({p}D * (n{n}_total - 1))"
        at = "max(CASE WHEN {r}({pos}) >= n{n}_before AND {r}({pos}) < n{n}_before + {n} THEN s END)"
        lo, hi = at.format(r="floor", pos=pos, n=n), at.format(r="ceil", pos=pos, n=n)
        frac = f"max({pos} - floor({pos}))"
        values.append(f"CASE WHEN {lo} = {hi} THEN {lo} ELSE {lo} * (1 - {frac}) + {hi} * {frac} END")
    return f"array({', '.join(values)})"


def _ratio(a: float, b: float) -> float:
    return a / b if b > 0 else 0.0


def _ks_pvalue(stat: float | None, n1: float, n2: float) -> float | None:
    if stat is None:
        return None
    lam = math.sqrt(n1 * n2 / (n1 + n2)) * stat
    if lam < 0.2:
        return 1.0
    series = sum((2.0 if k % 2 else -2.0) * math.exp(-2.0 * k * k * lam * lam) for k in range(1, 101))
    return min(max(series, 0.0), 1.0)


def _psi(bins: list, eps: float) -> float | None:
    """From the rows (bin, b, c); the bin of scores outside the base range is NULL."""
    if not sum(r["b"] for r in bins) or not sum(r["c"] for r in bins):
        return None
    inside = [r for r in bins if r["bin"] is not None]
    nb, nc = sum(r["b"] for r in inside), sum(r["c"] for r in inside)
    shares = [(r["b"] / (nb + eps) if r["b"] else eps, r["c"] / (nc + eps) if r["c"] else eps) for r in inside]
    return sum((p - a) * math.log(p / a) for p, a in shares)


def drift_code(psi: float | None, warn: float = 0.2, crit: float = 0.3) -> int:
    return 0 if psi is None else 2 if psi >= crit else 1 if psi >= warn else 0


#: Aggregates over ranked counts that one pass answers: sizes, sums, ends, KS, and the cells of the label metrics.
_FIRST = """
    max(nb_total) AS n_b, max(nc_total) AS n_c, sum(s * b) AS sum_b, sum(s * c) AS sum_c,
    min(CASE WHEN b > 0 THEN s END) AS min_b, max(CASE WHEN b > 0 THEN s END) AS max_b,
    min(CASE WHEN c > 0 THEN s END) AS min_c, max(CASE WHEN c > 0 THEN s END) AS max_c,
    max(CASE WHEN nb_total > 0 AND nc_total > 0 THEN abs((nb_before + b) / nb_total - (nc_before + c) / nc_total) END) AS ks,
    sum(pos * (neg_before + neg * 0.5D)) AS area, sum(pos) AS p, sum(neg) AS n, sum(matched) AS matched, sum(rows) AS rows,
    sum(CASE WHEN s >= {threshold}D THEN pos ELSE 0 END) AS tp, sum(CASE WHEN s >= {threshold}D THEN neg ELSE 0 END) AS fp"""


def report(
    counts: DataFrame, eps: float = 1e-8, labels: bool = True, identity: dict[str, object] | None = None, threshold: float = 0.5
) -> DataFrame:
    """The monitoring report of :func:`compared` counts: identity columns, section, metric, value.

    Two aggregates over the written counts: ranks first, then what depends on their result (PSI bins at the base deciles, squared
    deviations from the mean). Each gives a dozen rows at most; the report is a local table of some seventy lines.
    """
    spark = counts.sparkSession
    counts = materialise(counts)
    sums = {"nb": F.col("b"), "nc": F.col("c"), "neg": F.col("neg")}
    a = running_counts(counts, [], "s", sums).selectExpr(
        f"{deciles_sql('b')} AS qb", f"{deciles_sql('c')} AS qc",
        *[f.strip() for f in _split(_FIRST.format(threshold=threshold))]).first()
    mean = {x: a[f"sum_{x}"] / a[f"n_{x}"] if a[f"n_{x}"] else None for x in "bc"}
    cuts = sorted({q for q in a["qb"] if q is not None})
    edges = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<double>")
    s = F.col("s")
    at = F.least(F.size(F.filter(edges, lambda e: e <= s)), F.lit(max(len(cuts) - 1, 1)))
    inside = s.between(F.lit(cuts[0]), F.lit(cuts[-1])) if cuts else F.lit(False)
    square = lambda x: F.sum(F.col(x) * F.pow(s - F.lit(mean[x]).cast("double"), 2)).alias(f"dev_{x}")
    bins = counts.where(s.isNotNull()).groupBy(F.when(inside, at).alias("bin")).agg(
        F.sum("b").alias("b"), F.sum("c").alias("c"), square("b"), square("c")).collect()
    psi = _psi(bins, eps)
    ks = a["ks"]
    lines = [("drift", "ks_stat", ks), ("drift", "ks_pvalue", _ks_pvalue(ks, a["n_b"], a["n_c"])),
             ("drift", "psi", psi), ("drift", "code", drift_code(psi))]
    for section, x, q in (("baseline_summary", "b", a["qb"]), ("current_summary", "c", a["qc"])):
        n = a[f"n_{x}"] or 0
        std = math.sqrt(sum(r[f"dev_{x}"] for r in bins) / n) if n else None
        lines += [(section, "count", n), (section, "mean", mean[x]), (section, "std", std), (section, "min", a[f"min_{x}"]),
                  (section, "max", a[f"max_{x}"]), (section, "median", q[5])]
        lines += [(section, f"p{i * 10}", v) for i, v in enumerate(q)]
    for i, (v, w) in enumerate(zip(a["qb"], a["qc"])):
        lines += [("deciles", f"base_d{i}", v), ("deciles", f"current_d{i}", w),
                  ("deciles", f"diff_d{i}", None if v is None or w is None else w - v)]
    if labels:
        p, n, tp, fp = (a[x] or 0 for x in ("p", "n", "tp", "fp"))
        auc = a["area"] / (p * n) if p and n else None
        lines += [("label_metrics", name, value) for name, value in (
            ("matched", a["matched"] or 0), ("unmatched", (a["rows"] or 0) - (a["matched"] or 0)), ("roc_auc", auc),
            ("gini", None if auc is None else 2 * auc - 1), ("precision", _ratio(tp, tp + fp)), ("recall", _ratio(tp, p)),
            ("f1", _ratio(2 * tp, 2 * tp + fp + p - tp)))]
    out = spark.createDataFrame(
        [(a, b, None if v is None else float(v)) for a, b, v in lines], "section string, metric string, value double")
    if not identity:
        return out
    return out.select(*[F.lit(v).alias(k) for k, v in identity.items()], "section", "metric", "value")


def _split(aggregates: str) -> list[str]:
    """Aggregates of a text, cut at the commas outside parentheses."""
    parts, depth = [""], 0
    for ch in aggregates:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth:
            parts.append("")
        else:
            parts[-1] += ch
    return parts


def monitor_counts(spark: SparkSession, path: str, model: str, date: str, baseline: tuple[str, str], labels: bool = True) -> DataFrame:
    """Report of one model and date against the dates of ``baseline``, from the stored counts alone."""
    cur = read_counts(spark, path, model, date)
    base = read_counts(spark, path, model, *baseline)
    day = dt.date.fromisoformat
    identity = {"model_file": model, "snapshot_date": day(date), "baseline_start": day(baseline[0]), "baseline_end": day(baseline[1])}
    return report(compared(base, cur), labels=labels, identity=identity)
