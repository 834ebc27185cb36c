"""Inter-quartile fences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import parse_yyyymmdd
from ..functions.ordering import quantiles
from .timeline import METRICS


def iqr_fences(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: float = 1.5, exact: bool = False,
    accuracy: int = 1000,
) -> DataFrame:
    """Quartiles and fences per column and group: by..., column, q1, q3, iqr, lower, upper.

    The default uses mergeable sketches with rank error 1/accuracy, in one pass for all groups and
    columns; ``exact`` ranks the distinct values instead.
    """
    q = quantiles(df, cols, [0.25, 0.75], by, exact, accuracy)
    quart = q.groupBy(*by, "column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    return quart.select(
        *by, "column", "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - k * iqr).alias("lower"), (F.col("q3") + k * iqr).alias("upper"))


def _with_fences(df: DataFrame, fences: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    wide = fences.groupBy(*by).agg(*[
        F.max(F.when(F.col("column") == c, F.struct("lower", "upper"))).alias(f"_f_{c}") for c in cols])
    if not by:
        row = wide.select(F.struct(*wide.columns).alias("f")).scalar()
        return df.withColumn("_f", row).withColumns({f"_f_{c}": F.col(f"_f._f_{c}") for c in cols}).drop("_f")
    keyed = wide.withColumnsRenamed({c: f"_g_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]
    return df.join(keyed, same, "inner")


def iqr_clean(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), k: float = 1.5, exact: bool = False,
    accuracy: int = 1000,
) -> DataFrame:
    """Rows inside the fences of their group in every column."""
    fenced = _with_fences(df, iqr_fences(df, cols, by, k, exact, accuracy), cols, by)
    for c in cols:
        fenced = fenced.where(F.col(c).between(F.col(f"_f_{c}.lower"), F.col(f"_f_{c}.upper")))
    return fenced.select(*df.columns)


def iqr_outliers(
    df: DataFrame, cols: Sequence[str], keep: Sequence[str], by: Sequence[str] = (), k: float = 1.5,
    exact: bool = False, accuracy: int = 1000,
) -> DataFrame:
    """Values beyond a fence, one row per value: keep..., column, value."""
    fenced = _with_fences(df, iqr_fences(df, cols, by, k, exact, accuracy), cols, by)
    hits = F.filter(
        F.array(*[
            F.when((F.col(c) < F.col(f"_f_{c}.lower")) | (F.col(c) > F.col(f"_f_{c}.upper")),
                   F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")))
            for c in cols]),
        lambda x: x.isNotNull())
    return fenced.select(*keep, F.explode(hits).alias("h")).select(*keep, "h.column", "h.value")


def clean_user_logs(raw: DataFrame, exact: bool = False) -> DataFrame:
    """Logs without negative listening time and without outliers of their month, dated."""
    d = parse_yyyymmdd("date")
    logs = raw.where(F.col("total_secs") >= 0).withColumns({"year": F.year(d), "month": F.month(d)})
    kept = iqr_clean(logs, METRICS, ["year", "month"], exact=exact)
    return kept.withColumn("date", parse_yyyymmdd("date"))
