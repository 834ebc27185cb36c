"""Score monitoring: summaries, drift and threshold metrics, all as Spark aggregates.

Everything that depends on the order of scores reads a table of counts per distinct score, which is built in
one pass and written once; running sums over very many scores are spread over buckets (see ``functions.ordering``).
``operators.score_counts`` keeps such tables between runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import quantiles, running_counts
from .score_counts import compared, count_scores, deciles_sql, report

DECILES = [i / 10 for i in range(11)]


def summarise(df: DataFrame, score: str, exact: bool = True) -> DataFrame:
    """count, mean, population std, min, max, median and p0..p100 in steps of ten, as one row."""
    s = F.col(score).cast("double")
    stats = df.where(s.isNotNull()).agg(
        F.count(F.lit(1)).alias("count"), F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"),
        F.min(s).alias("min"), F.max(s).alias("max"))
    if exact:
        counts = df.where(s.isNotNull()).groupBy(s.alias("s")).agg(F.count(F.lit(1)).alias("b"))
        row = running_counts(counts, [], "s", {"nb": F.col("b")}).selectExpr(f"{deciles_sql('b')} AS q")
    else:
        row = df.agg(F.percentile_approx(s, DECILES, 1000).alias("q"))
    ps = [f"_q[{i}] AS p{i * 10}" for i in range(11)]
    return stats.withColumn("_q", row.scalar()).selectExpr("count", "mean", "std", "min", "max", "_q[5] AS median", *ps)


def decile_shift(base: DataFrame, cur: DataFrame, score: str, exact: bool = True) -> DataFrame:
    """decile 0..10 with its base value, current value and difference."""
    b = quantiles(base, [score], DECILES, (), exact).select("prob", F.col("value").alias("base"))
    c = quantiles(cur, [score], DECILES, (), exact).select("prob", F.col("value").alias("current"))
    return b.join(c, "prob", "inner").select(
        F.round(F.col("prob") * 10).cast("int").alias("decile"), "base", "current",
        (F.col("current") - F.col("base")).alias("diff"))


def _tagged(base: DataFrame, cur: DataFrame, score: str) -> DataFrame:
    s = F.col(score).cast("double").alias("s")
    both = base.select(s, F.lit(1).alias("b"), F.lit(0).alias("c")).unionByName(
        cur.select(s, F.lit(0).alias("b"), F.lit(1).alias("c")))
    return both.where(F.col("s").isNotNull())


def _bin_index(e: Column, s: Column) -> Column:
    """1-based bin of a score between sorted edges; the last bin is closed, a single edge is one bin."""
    return F.least(F.size(F.filter(e, lambda x: x <= s)), F.greatest(F.size(e) - 1, F.lit(1)))


def _psi(counts: DataFrame, cuts: Column, eps: float) -> DataFrame:
    """PSI of per-score counts (s, b, c) over the given edges."""
    e, s = F.col("_e"), F.col("s")
    binned = (
        counts.withColumn("_e", cuts)
        .withColumn("_inside", s.between(F.element_at(e, 1), F.element_at(e, -1)))
        .groupBy(F.when(F.col("_inside"), _bin_index(e, s)).alias("bin"))
        .agg(F.sum("b").alias("b"), F.sum("c").alias("c"))
    )
    # one row per bin and one for scores outside, from here on
    inside = F.col("bin").isNotNull()
    bags = binned.agg(
        F.collect_list(F.when(inside, F.struct("b", "c"))).alias("bins"),
        F.sum(F.when(inside, F.col("b"))).alias("nb"), F.sum(F.when(inside, F.col("c"))).alias("nc"),
        ((F.sum("b") > 0) & (F.sum("c") > 0)).alias("both"))

    def share(n: Column, total: Column) -> Column:
        return F.when(n == 0, F.lit(eps)).otherwise(n / (total + F.lit(eps)))

    def term(x: Column) -> Column:
        p, a = share(x["b"], F.col("nb")), share(x["c"], F.col("nc"))
        return (p - a) * F.log(p / a)

    value = F.aggregate(F.transform("bins", term), F.lit(0.0), lambda acc, t: acc + t)
    return bags.select(F.when(F.col("both"), value).alias("psi"))


def psi(base: DataFrame, cur: DataFrame, score: str, bins: int = 10, eps: float = 1e-8, exact: bool = True) -> DataFrame:
    """Population stability index over bins cut at the base quantiles.

    Equal quantiles merge; the last bin is closed; current scores outside the base range are left
    out; an empty bin counts as ``eps``. A constant base gives one closed bin. NULL if a side is empty.
    """
    probs = [i / bins for i in range(bins + 1)]
    counts = _score_counts(base, cur, score)
    if exact:
        counts = _ranked(counts)
        cuts = counts.selectExpr(f"sort_array(array_distinct({deciles_sql('b', probs)})) AS e").scalar()
    else:
        q = quantiles(base, [score], probs, (), exact)
        cuts = q.agg(F.sort_array(F.collect_set("value")).alias("e")).scalar()
    return _psi(counts, cuts, eps)


def _score_counts(base: DataFrame, cur: DataFrame, score: str) -> DataFrame:
    """One row per distinct score with its number of base and current rows."""
    return _tagged(base, cur, score).groupBy("s").agg(F.sum("b").alias("b"), F.sum("c").alias("c"))


def _ranked(counts: DataFrame) -> DataFrame:
    return running_counts(counts, [], "s", {"nb": F.col("b"), "nc": F.col("c")})


def _gap() -> Column:
    nb, nc = F.col("nb_total"), F.col("nc_total")
    gap = F.abs((F.col("nb_before") + F.col("b")) / nb - (F.col("nc_before") + F.col("c")) / nc)
    return F.when((nb > 0) & (nc > 0), gap)


def _ks_pvalue(stat: Column, n1: Column, n2: Column) -> Column:
    lam = F.sqrt(n1 * n2 / (n1 + n2)) * stat
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam))
    p = F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))
    return F.when(stat.isNotNull(), p)


def ks(base: DataFrame, cur: DataFrame, score: str) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and its asymptotic p-value."""
    stat = _ranked(_score_counts(base, cur, score)).agg(
        F.max(_gap()).alias("ks_stat"), F.max("nb_total").alias("n1"), F.max("nc_total").alias("n2"))
    return stat.select("ks_stat", _ks_pvalue(F.col("ks_stat"), F.col("n1"), F.col("n2")).alias("ks_pvalue"))


def _by_score(df: DataFrame, score: str, label: str, by: Sequence[str]) -> DataFrame:
    y = F.col(label).cast("int")
    counts = (
        df.where(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("s"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )
    return running_counts(counts, by, "s", {"p": F.col("pos"), "n": F.col("neg")})


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve and Gini, ties counted half; NULL where only one class is present."""
    by = list(by)
    run = _by_score(df, score, label, by)
    area = F.sum(F.col("pos") * (F.col("n_before") + F.col("neg") * 0.5))
    pairs = F.max("p_total").cast("double") * F.max("n_total")
    out = run.groupBy(*by).agg(F.when(pairs > 0, area / pairs).alias("roc_auc"))
    return out.withColumn("gini", 2 * F.col("roc_auc") - 1)


def roc_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """One point per distinct threshold (score >= threshold), plus the origin with a NULL threshold."""
    by = list(by)
    run = _by_score(df, score, label, by)

    def rate(total: str, before: str) -> Column:
        return F.when(F.col(total) > 0, (F.col(total) - F.col(before)) / F.col(total))

    points = run.select(*by, F.col("s").alias("threshold"), rate("n_total", "n_before").alias("fpr"),
                        rate("p_total", "p_before").alias("tpr"))
    origin = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    start = origin.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
                          F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def _cells(df: DataFrame, score: str, label: str, threshold: float, by: Sequence[str]) -> DataFrame:
    y = F.col(label).cast("int")
    pred = F.col(score) >= threshold
    return df.where(y.isNotNull() & F.col(score).isNotNull()).groupBy(*by).agg(
        F.count_if((y == 0) & ~pred).alias("tn"), F.count_if((y == 0) & pred).alias("fp"),
        F.count_if((y == 1) & ~pred).alias("fn"), F.count_if((y == 1) & pred).alias("tp"))


def _div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion(df: DataFrame, score: str, label: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    return _cells(df, score, label, threshold, by)


def _prf(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column, Column]:
    return _div(tp, tp + fp), _div(tp, tp + fn), _div(2 * tp, 2 * tp + fp + fn)


def classification_metrics(
    df: DataFrame, score: str, label: str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall and F1 of the positive class; 0 where a denominator is 0."""
    p, r, f = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    return _cells(df, score, label, threshold, by).select(
        *by, p.alias("precision"), r.alias("recall"), f.alias("f1"))


def classification_report(
    df: DataFrame, score: str, label: str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """Per-class precision, recall, F1 and support with accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p0, r0, f0 = _prf(tn, fn, fp)
    p1, r1, f1 = _prf(tp, fp, fn)
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    acc = _div(tp + tn, n)

    def line(name: str, p: Column, r: Column, f: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        support.alias("support"))

    def weighted(a: Column, b: Column) -> Column:
        return _div(a * s0 + b * s1, n)

    lines = F.array(
        line("0", p0, r0, f0, s0), line("1", p1, r1, f1, s1), line("accuracy", acc, acc, acc, n),
        line("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        line("weighted avg", weighted(p0, p1), weighted(r0, r1), weighted(f0, f1), n))
    return _cells(df, score, label, threshold, by).select(*by, F.explode(lines).alias("l")).select(*by, "l.*")


def evaluate(df: DataFrame, score: str, label: str, by: Sequence[str] = ("split",), threshold: float = 0.5) -> DataFrame:
    """AUC, Gini, precision, recall and F1 per split."""
    by = list(by)
    auc = roc_auc(df, score, label, by)
    rest = classification_metrics(df, score, label, threshold, by)
    return auc.join(rest, by, "inner")


def drift_status(psi_row: DataFrame, warn: float = 0.2, crit: float = 0.3) -> DataFrame:
    """Status and code of a PSI: 2 critical, 1 warning, 0 ok or unknown."""
    p = F.col("psi")
    return psi_row.select(
        "psi",
        F.when(p >= crit, "critical").when(p >= warn, "warning").when(p.isNull(), "unknown").otherwise("ok")
        .alias("status"),
        F.when(p >= crit, 2).when(p >= warn, 1).otherwise(0).alias("code"))


def score_vs_label(preds: DataFrame, labels: DataFrame, label: str, keys=("msno", "snapshot_date")) -> DataFrame:
    """Predictions with their label; ``matched`` tells whether one was found."""
    known = labels.select(*keys, F.col(label).cast("int").alias("label"), F.lit(True).alias("matched"))
    return preds.drop("label", "matched").join(known, list(keys), "left").na.fill({"matched": False})


def monitor(
    base: DataFrame, cur: DataFrame, score: str, labels: DataFrame | None = None, label: str = "is_churn",
    exact: bool = True, eps: float = 1e-8, identity: dict[str, object] | None = None,
) -> DataFrame:
    """The whole report in long form: the columns of ``identity``, then section, metric, value.

    Both sides are counted by distinct score in one pass each; the report reads nothing but these counts.
    Without ``exact`` scores are counted to six decimals, so probabilities give a million counts at most.
    """
    digits = None if exact else 6
    known = None if labels is None else "label"
    if labels is not None:
        cur = score_vs_label(cur, labels, label)
    counted = count_scores(cur, score, (), known, known and "matched", digits)
    return report(compared(count_scores(base, score, (), digits=digits), counted), eps, labels is not None, identity)


def read_predictions(spark: SparkSession, path: str, model: str, date: str) -> DataFrame:
    """Predictions of one model and snapshot date, by partition pruning."""
    rows = spark.read.parquet(path).where(
        (F.col("model_file") == model) & (F.col("snapshot_date") == F.lit(date).cast("date")))
    if rows.isEmpty():
        raise FileNotFoundError(f"no predictions of {model} for {date} under {path}")
    return rows
