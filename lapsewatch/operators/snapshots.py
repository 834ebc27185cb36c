"""Observation dates: grids, selection, incremental builds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: str, end: str, name: str = "snapshot_date") -> DataFrame:
    """One row per day of the range."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias(name)
    )


def month_starts(spark: SparkSession, start: str, end: str) -> DataFrame:
    """First day of every month from the month of ``start`` up to ``end``."""
    first = F.trunc(F.lit(start).cast("date"), "MM")
    return spark.range(1).select(
        F.explode(F.sequence(first, F.lit(end).cast("date"), F.expr("interval 1 month"))).alias("snapshot_date"))


def snapshot_grid(entities: DataFrame, start: str, end: str, not_before: str | None = None) -> DataFrame:
    """Every entity on every day of the range, from ``not_before`` (a date column) on.

    Each row expands in place; there is no join and no shuffle.
    """
    first = F.lit(start).cast("date")
    last = F.lit(end).cast("date")
    if not_before is not None:
        entities = entities.where(F.col(not_before) <= last)
        first = F.greatest(first, F.col(not_before))
    return entities.withColumn("snapshot_date", F.explode(F.sequence(first, last, F.expr("interval 1 day"))))


def new_snapshots(snaps: DataFrame, existing: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """Snapshots whose date is not yet built.

    The built dates are reduced to one row per date first; their number is bounded by the calendar, so
    they are broadcast and the snapshots are not shuffled.
    """
    done = existing.select(F.col(date).cast("date").alias(date)).where(F.col(date).isNotNull()).distinct()
    return snaps.join(F.broadcast(done), date, "left_anti")


def select_snapshots(
    df: DataFrame,
    mode: str = "all",
    start: str | None = None,
    end: str | None = None,
    existing: DataFrame | None = None,
    date: str = "snapshot_date",
) -> DataFrame:
    """Snapshot choice: ``all``, ``date`` (start), ``range`` (start..end) or ``incremental``."""
    d = F.col(date)
    if mode == "all":
        return df
    if mode == "date":
        return df.where(d == F.lit(start).cast("date"))
    if mode == "range":
        return df.where(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if mode == "incremental":
        return df if existing is None else new_snapshots(df, existing, date)
    raise ValueError(f"unknown snapshot mode {mode!r}")


def keep_known(facts: DataFrame, dim: DataFrame, key: str = "msno") -> DataFrame:
    """Facts of entities that occur in ``dim``."""
    return facts.join(dim.select(key), key, "left_semi")


def attach_members(snaps: DataFrame, members: DataFrame, key: str = "msno") -> DataFrame:
    """Member attributes of the same entity and the same snapshot date."""
    return snaps.join(members, [key, "snapshot_date"], "left")


def assemble(base: DataFrame, blocks: Sequence[DataFrame], keys: Sequence[str] = ("msno", "snapshot_date")) -> DataFrame:
    """Left-join feature blocks onto the observations; all joins share one partitioning."""
    for block in blocks:
        base = base.join(block, list(keys), "left")
    return base


def registered_asof(members: DataFrame, date: str | Column) -> DataFrame:
    """Members registered on or before a date, with tenure on that date."""
    d = F.lit(date).cast("date") if isinstance(date, str) else date
    return members.where(F.col("registration_date") <= d).withColumn(
        "tenure_days_at_snapshot", F.datediff(d, F.col("registration_date")))
