"""Distinct counts that add up, from states by date.

The exact state (:func:`store_values`, ``*_exact``) has one row per date, column and value. Any window is counted from it by
grouping its values, at any size and without the facts; a value that a date holds many times is one row.

The sketched state has one mergeable sketch per date instead of the values themselves. A theta sketch holds all hashes of a column up to 2^``lg`` different values, so its count is exact there; beyond, it keeps
a uniform part of the hashes with a relative standard error of 1 / sqrt(2^``lg``), about 0.4 % at the default. Sketches
of different dates unite and intersect without the rows, so any window reads one small row per date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.merge import replace_dates

LG = 16


def _sketch(col: str | Column, lg: int) -> Column:
    """Sketch of a column's values as text; NULL is no value."""
    return F.theta_sketch_agg((F.col(col) if isinstance(col, str) else col).cast("string"), lg)


def _estimate(sketch: Column) -> Column:
    """Count of a sketch; no sketch at all counts nothing."""
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")


def day_state(facts: DataFrame, cols: Sequence[str], date: str = "date", lg: int = LG) -> DataFrame:
    """One row per date: rows, and for every column its NULLs and the sketch of its values.

    Sketches are built before the shuffle, so a date that holds most rows moves as one sketch per task.
    """
    aggs = [a for c in cols for a in (F.count_if(F.col(c).isNull()).alias(f"nulls__{c}"), _sketch(c, lg).alias(f"sketch__{c}"))]
    return facts.groupBy(F.col(date).cast("date").alias("date")).agg(F.count(F.lit(1)).alias("rows"), *aggs)


def store_days(facts: DataFrame, path: str, cols: Sequence[str], start: str, end: str, date: str = "date", lg: int = LG) -> None:
    """Write the state of the dates start..end, replacing those dates; facts outside are not read into it."""
    inside = facts.where(F.col(date).cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    state = day_state(inside, cols, date, lg).withColumn("month", F.date_format("date", "yyyy-MM"))
    replace_dates(state, path, ["month"], "date", start, end)


def distinct_by(state: DataFrame, groups: dict[str, Column], col: str, lg: int = LG) -> DataFrame:
    """Rows and distinct values of ``col`` per group of dates, such as year and month."""
    united = state.groupBy(*[expr.alias(name) for name, expr in groups.items()]).agg(
        F.sum("rows").alias("count"), F.theta_union_agg(f"sketch__{col}", lg).alias("_sketch"))
    return united.withColumn(f"distinct_{col}", _estimate(F.col("_sketch"))).drop("_sketch")


def null_profile(state: DataFrame, cols: Sequence[str], lg: int = LG) -> DataFrame:
    """NULL and distinct counts per column over all dates of ``state``; NULL counts as one value."""
    row = state.agg(*[a for c in cols for a in (
        F.sum(f"nulls__{c}").alias(f"n__{c}"), F.theta_union_agg(f"sketch__{c}", lg).alias(f"s__{c}"))])
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.coalesce(F.col(f"n__{c}"), F.lit(0)).alias("nulls"),
        (_estimate(F.col(f"s__{c}")) + F.when(F.col(f"n__{c}") > 0, 1).otherwise(0)).alias("distinct")) for c in cols])
    return row.select(F.explode(rows).alias("r")).select("r.*")


def _between(last: Column, days: int) -> Column:
    return F.col("date").between(F.date_sub(last, days - 1), last)


def window_coverage(state: DataFrame, date: str, horizons: Sequence[int] = (30, 7), key: str = "msno", lg: int = LG) -> DataFrame:
    """Expected range, first and last date and distinct entities of each window ending on ``date``, from the sketches."""
    last = F.lit(date).cast("date")
    aggs = []
    for h in horizons:
        inside = _between(last, h)
        aggs += [F.min(F.when(inside, F.col("date"))).alias(f"first__{h}"), F.max(F.when(inside, F.col("date"))).alias(f"last__{h}"),
                 F.theta_union_agg(F.when(inside, F.col(f"sketch__{key}")), lg).alias(f"sketch__{h}")]
    rows = F.array(*[F.struct(
        F.lit(h).alias("horizon"), F.date_sub(last, h - 1).alias("expected_start"), last.alias("expected_end"),
        F.col(f"first__{h}").alias("actual_start"), F.col(f"last__{h}").alias("actual_end"),
        _estimate(F.col(f"sketch__{h}")).alias("entities")) for h in horizons])
    return state.where(_between(last, max(horizons))).agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")


def retention(state: DataFrame, date: str, days: int, key: str = "msno", lg: int = LG) -> DataFrame:
    """Entities of the window ending on ``date`` and of the one before it, those in both, and those lost and won."""
    last = F.lit(date).cast("date")
    before = F.date_sub(last, days)
    sketch = F.col(f"sketch__{key}")
    row = state.where(_between(last, 2 * days)).agg(
        F.theta_union_agg(F.when(_between(before, days), sketch), lg).alias("a"),
        F.theta_union_agg(F.when(_between(last, days), sketch), lg).alias("b"))
    both = _estimate(F.theta_intersection("a", "b"))
    return row.select(
        last.alias("window_end"), F.lit(days).alias("days"), _estimate(F.col("a")).alias("before"), _estimate(F.col("b")).alias("now"),
        both.alias("retained"), _estimate(F.theta_difference("a", "b")).alias("lost"), _estimate(F.theta_difference("b", "a")).alias("won"))


def day_values(facts: DataFrame, cols: Sequence[str], date: str = "date") -> DataFrame:
    """One row per date, column and value (as text, NULL included): its rows. Counted before the shuffle, so a hot value moves once per task."""
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    return facts.select(F.col(date).cast("date").alias("date"), F.explode(each).alias("v")).groupBy(
        "date", F.col("v.column").alias("column"), F.col("v.value").alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def store_values(facts: DataFrame, path: str, cols: Sequence[str], start: str, end: str, date: str = "date") -> None:
    """Write the values of the dates start..end, replacing those dates; facts outside are not read into it."""
    inside = facts.where(F.col(date).cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    state = day_values(inside, cols, date).withColumn("month", F.date_format("date", "yyyy-MM"))
    replace_dates(state, path, ["month"], "date", start, end)


def _values(state: DataFrame, col: str) -> DataFrame:
    return state.where(F.col("column") == col)


def distinct_by_exact(state: DataFrame, groups: dict[str, Column], col: str) -> DataFrame:
    """:func:`distinct_by` from stored values. Values are grouped with their group, so a group that holds most rows is spread."""
    once = _values(state, col).groupBy(*[expr.alias(name) for name, expr in groups.items()], "value").agg(F.sum("rows").alias("rows"))
    return once.groupBy(*groups).agg(F.sum("rows").alias("count"), F.count("value").alias(f"distinct_{col}"))


def null_profile_exact(state: DataFrame, cols: Sequence[str]) -> DataFrame:
    """:func:`null_profile` from stored values."""
    once = state.groupBy("column", "value").agg(F.sum("rows").alias("rows"))
    of = lambda c: F.col("column") == c
    row = once.agg(*[a for c in cols for a in (
        F.sum(F.when(of(c) & F.col("value").isNull(), F.col("rows"))).alias(f"n__{c}"), F.count_if(of(c)).alias(f"d__{c}"))])
    rows = F.array(*[F.struct(
        F.lit(c).alias("column"), F.coalesce(F.col(f"n__{c}"), F.lit(0)).alias("nulls"), F.col(f"d__{c}").alias("distinct")) for c in cols])
    return row.select(F.explode(rows).alias("r")).select("r.*")


def window_coverage_exact(state: DataFrame, date: str, horizons: Sequence[int] = (30, 7), key: str = "msno") -> DataFrame:
    """:func:`window_coverage` from stored values."""
    last = F.lit(date).cast("date")
    inside = {h: F.when(_between(last, h), F.col("date")) for h in horizons}
    once = _values(state, key).where(_between(last, max(horizons))).groupBy("value").agg(
        *[f(d).alias(f"{n}__{h}") for h, d in inside.items() for n, f in (("first", F.min), ("last", F.max))])
    row = once.agg(*[a for h in horizons for a in (
        F.min(f"first__{h}").alias(f"first__{h}"), F.max(f"last__{h}").alias(f"last__{h}"),
        F.count_if(F.col(f"last__{h}").isNotNull() & F.col("value").isNotNull()).alias(f"n__{h}"))])
    rows = F.array(*[F.struct(
        F.lit(h).alias("horizon"), F.date_sub(last, h - 1).alias("expected_start"), last.alias("expected_end"),
        F.col(f"first__{h}").alias("actual_start"), F.col(f"last__{h}").alias("actual_end"), F.col(f"n__{h}").alias("entities"))
        for h in horizons])
    return row.select(F.explode(rows).alias("r")).select("r.*")


def retention_exact(state: DataFrame, date: str, days: int, key: str = "msno") -> DataFrame:
    """:func:`retention` from stored values."""
    last = F.lit(date).cast("date")
    once = _values(state, key).where(_between(last, 2 * days) & F.col("value").isNotNull()).groupBy("value").agg(
        F.bool_or(_between(F.date_sub(last, days), days)).alias("a"), F.bool_or(_between(last, days)).alias("b"))
    a, b = F.col("a"), F.col("b")
    return once.agg(
        F.count_if(a).alias("before"), F.count_if(b).alias("now"), F.count_if(a & b).alias("retained"), F.count_if(a & ~b).alias("lost"),
        F.count_if(b & ~a).alias("won")).select(last.alias("window_end"), F.lit(days).alias("days"), "*")
