"""Profiles, distributions and quality counters. Each is one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_col
from ..functions.ordering import quantiles


def distribution(df: DataFrame, col: str, within: Sequence[str] = ()) -> DataFrame:
    """Count and percentage of each value, overall or within groups, most frequent first."""
    counts = df.groupBy(*within, col).agg(F.count(F.lit(1)).alias("count"))
    share = lambda total: F.round(F.col("count") / total * 100, 2).alias("percentage")
    if not within:
        # one row per value
        out = counts.select(col, "count", share(F.sum("count").over(Window.partitionBy())))
    else:
        totals = counts.groupBy(*within).agg(F.sum("count").alias("_total"))
        out = counts.join(totals, list(within), "inner").select(*within, col, "count", share(F.col("_total")))
    return out.orderBy(*within, F.desc("count"), col)


def top_categories(df: DataFrame, col: str, value: Column | None = None, k: int = 5) -> DataFrame:
    """The k categories with the most rows, or with the greatest ``value`` aggregate."""
    measure = F.count(F.lit(1)) if value is None else value
    return df.groupBy(col).agg(measure.alias("measure")).orderBy(F.desc("measure"), col).limit(k)


def _long(row: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One wide row of aggregates named ``<field>__<column>`` to one row per column."""
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{f}__{c}").alias(f) for f in fields]) for c in cols]
    return row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample standard deviation, min and max per numeric column."""
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"count__{c}"), F.avg(v).alias(f"mean__{c}"), F.stddev_samp(v).alias(f"std__{c}"),
                 F.min(v).alias(f"min__{c}"), F.max(v).alias(f"max__{c}")]
    return _long(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])


def ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Smallest and largest value per column, as text, so dates and numbers fit one table."""
    aggs = [f(c).cast("string").alias(f"{n}__{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))]
    return _long(df.agg(*aggs), cols, ["min", "max"])


def quantile_profile(df: DataFrame, cols: Sequence[str], exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """min, median, p99 and max per column."""
    q = quantiles(df, cols, [0.0, 0.5, 0.99, 1.0], (), exact, accuracy)
    pick = lambda p, n: F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
    return q.groupBy("column").agg(pick(0.0, "min"), pick(0.5, "median"), pick(0.99, "p99"), pick(1.0, "max"))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """NULL and distinct counts per column; NULL counts as one distinct value, as ``distinct`` does."""
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        nulls = F.count_if(F.col(c).isNull())
        distinct = F.approx_count_distinct(c) if approx else F.countDistinct(c)
        aggs += [nulls.alias(f"nulls__{c}"), distinct.alias(f"distinct__{c}")]
    row = df.agg(*aggs)
    with_null = {f"distinct__{c}": F.col(f"distinct__{c}") + F.when(F.col(f"nulls__{c}") > 0, 1).otherwise(0)
                 for c in cols}
    return _long(row.withColumns(with_null), cols, ["nulls", "distinct"])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total, unique and duplicate row counts for a key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("unique_rows")
    ).withColumn("duplicate_rows", F.col("total_rows") - F.col("unique_rows"))


def qc(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows and rule hits, one column per rule."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(cond).alias(name) for name, cond in rules.items()])


def log_quality_rules(metrics: Sequence[str]) -> dict[str, Column]:
    """Counters for user logs: any negative measure, more than a day of listening."""
    negative = F.lit(False)
    for m in metrics:
        negative = negative | (F.col(m) < 0)
    return {"n_negative": negative, "n_over_day": F.col("total_secs") > 86400}


def rate_by_missing(df: DataFrame, feature: str, label: str) -> DataFrame:
    """Label rate of rows with and without a value of ``feature``."""
    return df.groupBy(F.col(feature).isNull().alias("is_missing")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("label_rate"))


def count_by(df: DataFrame, keys: Sequence[str], distinct: str | None = None) -> DataFrame:
    extra = [F.countDistinct(distinct).alias(f"distinct_{distinct}")] if distinct else []
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), *extra)


def window_coverage(
    facts: DataFrame, date: str, horizons: Sequence[int] = (30, 7), col: str = "date", key: str = "msno"
) -> DataFrame:
    """Expected range, actual first and last date and distinct entities of each window ending on ``date``.

    The facts are cut to the widest window first, so all horizons share one scan.
    """
    today = F.lit(date).cast("date")
    d = F.col(col)
    aggs = []
    for h in horizons:
        inside = d >= F.date_sub(today, h - 1)
        aggs += [
            F.min(F.when(inside, d)).alias(f"actual_start__{h}"), F.max(F.when(inside, d)).alias(f"actual_end__{h}"),
            F.countDistinct(F.when(inside, F.col(key))).alias(f"entities__{h}"),
        ]
    row = facts.where(d.between(F.date_sub(today, max(horizons) - 1), today)).agg(*aggs)
    rows = [
        F.struct(
            F.lit(h).alias("horizon"), F.date_sub(today, h - 1).alias("expected_start"), today.alias("expected_end"),
            *[F.col(f"{n}__{h}").alias(n) for n in ("actual_start", "actual_end", "entities")])
        for h in horizons
    ]
    return row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
